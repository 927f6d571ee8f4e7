import random
import time

import pytest

from curvelab.llm import decontamination as D


def distance_to_passage(item, text):
    """Sellers' dynamic program: edits of the item to the best passage."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (x != c)))
        row = new
        best = min(best, row[-1])
    return best


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("abcdef")
        elif kind == 1:
            chars.insert(at, rng.choice("abcdef"))
        else:
            del chars[at]
    return "".join(chars)


def test_myers_is_the_dynamic_program():
    rng = random.Random(3)
    for _ in range(200):
        item = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 90)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randrange(0, 120))) + edited(rng, item + "abc", 2)
        distance, end = D.Myers(item).best(text)
        assert distance == distance_to_passage(item, text)
        if distance < len(item):
            assert distance_to_passage(item, text[:end]) == distance


def test_same_as_all_pairs(spark, table):
    rng = random.Random(7)
    items = [(r["item_id"], r["text"]) for r in table("benchmark").limit(12).collect()]
    docs = [(r["doc_id"], r["text"][:600]) for r in table("documents").limit(15).collect()]
    for k in range(36):
        item = items[k % 12][1]
        noise = docs[k % 15][1]
        docs.append((1000 + k, noise[:200] + " " + edited(rng, item, k // 2).upper().replace(" ", "\n\t") + " " + noise[200:400]))
    got = D.find_passages(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    want = set()
    for d, text in docs:
        for i, item in items:
            p = D.plain(item)
            if (e := distance_to_passage(p, D.plain(text))) <= D.errors(len(p), 12):
                want.add((d, i, e))
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in got.collect()} == want
    assert len(want) > 12


def test_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame(
        [(1, None), (2, " "), (3, "another text under the SAME id"), (None, "a text without an id, seven words"), (4, "one"), (4, "one"), (5, "on")],
        "item_id long, text string",
    )
    got = {(r["doc_id"], r["item_id"]) for r in D.find_passages(edge_docs, items).collect()}
    assert got == {(7, 3), (None, None), (4, 4), (5, 4)}
    assert D.find_passages(no_docs, items).count() == 0
    assert D.find_passages(edge_docs, items.where("false")).count() == 0
    kept = D.keep_uncontaminated(edge_docs, items)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "2", "3", "6", "6", "7", "8", "9"])


def test_more_groups_change_nothing(table):
    docs, items = table("documents"), table("benchmark")
    one = {tuple(r) for r in D.find_passages(docs, items).collect()}
    assert one == {tuple(r) for r in D.find_passages(docs, items, group_chars=500).collect()} and one


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_pieces_cover_the_item(parts):
    item = "a benchmark item of some length"
    assert "".join(p for _, p in D.cut(item, parts)) == item
    assert all(item[a : a + len(p)] == p for a, p in D.cut(item, parts))


def test_one_pass_however_many_groups(spark, table):
    """One Python pass over the documents, and no text of the benchmark in the plan or on the driver."""
    docs, items = table("documents"), table("benchmark")
    kept = D.keep_uncontaminated(docs, items, group_chars=400)
    assert D.written_items(items, 400, 12).groups > 5
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    want = {r["doc_id"] for r in D.keep_uncontaminated(docs, items).collect()}
    assert {r["doc_id"] for r in kept.collect()} == want
    assert {r["doc_id"] for r in D.keep_uncontaminated(docs, items, group_chars=400, buffer_bytes=1).collect()} == want


def test_a_repeated_piece_is_compared_once():
    """A text that repeats a piece of a long item: one comparison a character, not one a hit."""
    item = " ".join(f"word{i}" for i in range(70))
    finder = D.Finder([(1, item)], 12)
    text = (item[100:130] + " and ") * 6000
    start = time.process_time()
    assert finder.matches(text) == []
    assert time.process_time() - start < 5
    assert finder.matches(text + item[:200] + item[203:])[0][:2] == (1, 3)
