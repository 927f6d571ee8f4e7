from curvelab.llm import chat


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, prompt string, n int")


def render(turns):
    return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)


def apply_mask(text, mask):
    """The trained part of a completion."""
    at, out = 0, ""
    for part in mask.split(",") if mask else []:
        train, n = part.split("x")
        out += text[at : at + int(n)] if train == "1" else ""
        at += int(n)
    assert at == len(text)
    return out


def test_whole_table(spark, small):
    conversations = spark.read.parquet(f"{small}/conversations.parquet")
    by = {}
    for r in sorted(conversations.collect(), key=lambda r: (r["conv_id"], r["turn"], r["role"], r["text"])):
        by.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    ended = {}
    for c, turns in by.items():
        said = [i for i, (role, _) in enumerate(turns) if role == "assistant"]
        if said:
            ended[c] = turns[: said[-1] + 1], said
    want = {}
    order = sorted(ended)
    for c, follower in zip(order, [*order[1:], order[0]]):
        (turns, said), (others, other_said) = ended[c], ended[follower]
        place = c % len(said)
        other = turns[: said[place]] + others[other_said[min(place, len(other_said) - 1)] :]
        n = next((i for i, (x, y) in enumerate(zip(turns, other)) if x != y), min(len(turns), len(other)))
        want[c] = (n, render(turns[:n]), render(turns[n:]), render(other[n:]))
    assert len(want) == len(ended) and len({n - len(ended[c][0]) for c, (n, *_) in want.items()}) > 2  # they part at many turns
    got = chat.format_preferences(chat.following_pairs(conversations)).collect()
    assert {r["pair_id"]: (r["n_prompt_turns"], r["prompt"], r["chosen"], r["rejected"]) for r in got} == want
    trained = lambda turns: "".join(f"{t}<|im_end|>\n" for role, t in turns if role == "assistant")
    for r in got:
        assert apply_mask(r["chosen"], r["chosen_mask"]) == trained(ended[r["pair_id"]][0][r["n_prompt_turns"] :])
        apply_mask(r["rejected"], r["rejected_mask"])


def test_pairs_of_unlike_length(spark):
    turn = "array<struct<role:string,text:string>>"
    rows = [
        (1, [("user", "q"), ("assistant", "a"), ("user", "r"), ("assistant", "b")], [("user", "q"), ("assistant", "a"), ("user", "s")]),
        (2, [("user", "q")], [("user", "q")]),
        (3, None, [("user", "q")]),
        (4, [("system", "q")], [("user", "q")]),
        (None, [], []),
    ]
    got = {r["pair_id"]: r for r in chat.format_preferences(spark.createDataFrame(rows, f"pair_id long, chosen {turn}, rejected {turn}")).collect()}
    assert got[1]["n_prompt_turns"] == 2 and got[1]["prompt"] == render(rows[0][1][:2])
    assert got[1]["chosen"] == render(rows[0][1][2:]) and apply_mask(got[1]["chosen"], got[1]["chosen_mask"]) == "b<|im_end|>\n"
    assert got[1]["rejected"] == render(rows[0][2][2:]) and apply_mask(got[1]["rejected"], got[1]["rejected_mask"]) == ""
    assert (got[2]["prompt"], got[2]["chosen"], got[2]["rejected"], got[2]["chosen_mask"]) == (render(rows[1][1]), "", "", "")
    assert got[3]["n_prompt_turns"] == 0 and got[3]["chosen"] == "" and got[3]["rejected"] == render(rows[2][2])
    assert got[4]["n_prompt_turns"] == 0 and got[None]["prompt"] == ""


def test_edges(spark):
    rows = [
        (0, 0, "user", None), (0, 1, None, "x"), (0, 2, "assistant", "y"), (0, 3, "user", "later"),
        (1, 0, "assistant", "é" * 50_000), (2, 0, "user", "alone"), (3, None, "assistant", "z"), (3, 0, "user", "u"),
        (None, 0, "assistant", "n"), (4, 1, "assistant", "b"), (4, 1, "assistant", "a"), (5, 0, "assistant", "b"), (5, 0, "assistant", "b"),
    ]
    df = table(spark, rows)
    got = {r["pair_id"]: r for r in chat.format_preferences(chat.following_pairs(df)).collect()}
    assert set(got) == {0, 1, 3, 4, 5}  # 2 has no answer; 5 is followed by 0
    assert got[0]["prompt"] == render([("user", ""), ("", "x")]) and got[0]["rejected"] == render([("assistant", "é" * 50_000)])
    assert got[1]["rejected"] == render([("assistant", "z")]) and got[1]["n_prompt_turns"] == 0
    assert got[4]["n_prompt_turns"] == 0 and got[4]["chosen"] == render([("assistant", "a"), ("assistant", "b")])
    assert got[5]["n_prompt_turns"] == 1 and got[5]["rejected"] == render([("assistant", "y")])
    assert chat.format_preferences(chat.following_pairs(df.where("false"))).count() == 0
    assert chat.following_pairs(df.where("conv_id = 1")).count() == 0  # nothing to pair it with


def test_followers(spark):
    for ids in ([], [7], [3, -5, 10, 2**40], list(range(0, 3000, 7))):
        got = {r["conv_id"]: r["follower"] for r in chat.followers(spark.createDataFrame([(i,) for i in ids], "conv_id long")).collect()}
        order = sorted(ids)
        assert got == {a: b for a, b in zip(order, [*order[1:], *order[:1]]) if a != b}


def test_no_python_in_the_plan(spark, small):
    df = chat.format_preferences(chat.following_pairs(spark.read.parquet(f"{small}/conversations.parquet")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
