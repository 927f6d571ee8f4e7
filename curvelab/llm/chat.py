"""Preference pairs from chosen and rejected conversations (operator 7), with built-in functions only.

A conversation is an array of turns (role, text).  For a chosen and a rejected one the longest
common prefix of turns (equal role and text) is rendered once, as the prompt; what follows is
rendered as two completions.  A completion's mask lists its parts in order as
``<train>x<characters>``: 1 for what the assistant says (with its end mark), 0 for role headers
and for other roles' turns.

Defined results: a null role or text counts as empty; turns are ordered by (turn, role, text), so
repeated turn numbers have a fixed order and null turns come first; equal conversations
give the whole as prompt and two empty completions; a null conversation counts as empty; an empty
table gives an empty table; other columns are ignored.  One conversation is one row, as
large as its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvelab.llm.common import staged

HEAD, TAIL = "<|im_start|>", "<|im_end|>\n"


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns) with turns in order, of a table (conv_id, turn, role, text); null conv_ids are left out."""
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    grouped = conversations.where("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return grouped.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(HEAD), turn["role"], F.lit("\n"))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(TAIL))), "")


def mask(turns: Column) -> Column:
    def parts(t: Column) -> Column:
        train = F.when(t["role"] == "assistant", F.lit("1x")).otherwise(F.lit("0x"))
        return F.concat(F.lit("0x"), F.length(_head(t)).cast("string"), F.lit(","), train, (F.length(t["text"]) + len(TAIL)).cast("string"))

    return F.array_join(F.transform(turns, parts), ",")


def common_turns(a: Column, b: Column) -> Column:
    """How many leading turns are equal."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, False).cast("int")
    return F.when(first > 0, first - 1).otherwise(F.least(F.size(a), F.size(b)))


def format_preferences(pairs: DataFrame, key: str = "pair_id", chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Rendered prompt and masked completions of every row of ``pairs``: a key and two arrays of
    struct<role, text>."""
    empty = F.array().cast("array<struct<role:string,text:string>>")
    a, b = F.coalesce(F.col(chosen), empty), F.coalesce(F.col(rejected), empty)
    split = pairs.select(F.col(key).alias("pair_id"), a.alias("a"), b.alias("b")).withColumn("n", common_turns(F.col("a"), F.col("b")))
    rest = lambda c: F.slice(F.col(c), F.col("n") + 1, F.size(c))
    return split.select(
        "pair_id",
        F.col("n").cast("int").alias("n_prompt_turns"),
        rendered(F.slice("a", F.lit(1), F.col("n"))).alias("prompt"),
        rendered(rest("a")).alias("chosen"),
        mask(rest("a")).alias("chosen_mask"),
        rendered(rest("b")).alias("rejected"),
        mask(rest("b")).alias("rejected_mask"),
    )


def answered(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns up to the last assistant turn, spots: places of the assistant turns) of the
    conversations that have one."""
    said = F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i + 1))
    spots = turns_of(conversations).withColumn("spots", F.filter(said, lambda i: i.isNotNull())).where(F.size("spots") > 0)
    return spots.select("conv_id", F.slice("turns", F.lit(1), F.element_at("spots", -1)).alias("turns"), "spots")


def followers(ids: DataFrame) -> DataFrame:
    """(conv_id, follower): the next larger conv_id, the smallest for the largest; none for an only one.

    The ids are dealt by ranges; inside a range the next one is a window's, and the last of a range
    is followed by the first of the next (one row a range)."""
    ranged = staged(ids.repartitionByRange("conv_id").select("conv_id", F.spark_partition_id().alias("range")), "ranges")
    heads = ranged.groupBy("range").agg(F.min("conv_id").alias("head"))
    after = F.lead("head").over(Window.orderBy("range"))
    heads = heads.select("range", F.coalesce(after, F.min("head").over(Window.partitionBy())).alias("after"))
    inside = F.lead("conv_id").over(Window.partitionBy("range").orderBy("conv_id"))
    followed = ranged.withColumn("inside", inside).join(heads, "range")
    return followed.select("conv_id", F.coalesce("inside", "after").alias("follower")).where("follower <> conv_id")


def following_pairs(conversations: DataFrame) -> DataFrame:
    """Preference pairs (pair_id, chosen, rejected) out of plain conversations, one for each that has an
    assistant turn, as long as two have.

    Chosen is a conversation up to its last assistant turn.  Rejected parts from it at its assistant turn
    number ``conv_id mod their count`` and goes on as the next answered conversation (by conv_id; the
    first after the last) does from its assistant turn of that number, or its last: an answer to something else.
    Conversations without an assistant turn have no pair."""
    ended = staged(answered(conversations), "answered")
    place = F.pmod("conv_id", F.size("spots")).cast("int")
    mine = ended.join(followers(ended.select("conv_id")), "conv_id").withColumn("place", place)
    other = ended.select(F.col("conv_id").alias("follower"), F.col("turns").alias("others"), F.col("spots").alias("other_spots"))
    start = F.element_at("other_spots", F.least(F.col("place"), F.size("other_spots") - 1) + 1)
    return mine.join(other, "follower").select(
        F.col("conv_id").alias("pair_id"),
        F.col("turns").alias("chosen"),
        F.concat(
            F.slice("turns", F.lit(1), F.element_at("spots", F.col("place") + 1) - 1), F.slice("others", start, F.size("others"))
        ).alias("rejected"),
    )
