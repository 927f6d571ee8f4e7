"""Per-class ordinal: ``row_number() over (partition by class order by key)``.

A plain window partitioned by class puts every row of a class into one task;
with ten classes and one of them holding a third of the table, that does not
survive a large input.  The operators here give the same numbers with bounded
tasks:

1. The ordering columns, taken together, are cut into ``P`` ranges at the quantiles of
   about 16 sampled rows a range.  The ``P - 1`` borders are a sorted literal array in which
   every row finds its range by binary search, so the cost of a row grows with ``log P``.
   The map from key to range is monotone, so ordering by ``(range, key)`` equals ordering
   by ``key``.
2. ``groupBy(class, range).count()`` -- partial aggregation, ``K x P`` rows,
   written to the shared folder.
3. A running sum over that small table gives each (class, range) its offset.
4. ``offset + row_number() over (partition by class, range order by key)``.
   Every (class, range) window group holds about ``N / P`` rows whatever the
   class sizes.

``class_ordinal`` numbers every row.  ``class_ordinal_head`` serves consumers
that only compare the ordinal with thresholds up to ``n`` (quota splits, learning
curves): ranges that begin after the ``n``-th row of their class are settled by
their offset alone, so their (wide) rows meet no shuffle; only the ranges that
hold the first ``n`` rows are numbered, whatever ``n`` is.

Rows are numbered in place, never joined back by key, so repeated keys neither
multiply nor share a number.  Rows with equal keys get an arbitrary but complete
numbering, as with ``row_number``.  Where a key fills whole ranges (seen as a border that
occurs twice), a hash of the other columns becomes the last ordering column and the key
is cut by it; only rows equal in every column stay together.  Numbers are bigint.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvelab.session import materialize

_RANGE = "_ord_range"
_TIE = "_ord_tie"
_SCRATCH = [_RANGE, _TIE, "_ord_off", "_ord_cls", "_ord_r"]
# Rows drawn to place the borders: at least BORDER_SAMPLE, SAMPLES_PER_RANGE for each range.
# Borders decide how even the ranges are, never the numbers.
BORDER_SAMPLE = 4096
SAMPLES_PER_RANGE = 16
BORDER_SEED = 7


def default_buckets(df: DataFrame) -> int:
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(4, 4 * parts)


def _key(order_cols) -> Column:
    return F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order_cols)])


def _key_type(df: DataFrame, order_cols) -> str:
    return df.select(_key(order_cols).alias("k")).schema["k"].dataType.simpleString()


def range_borders(df: DataFrame, order_cols, buckets: int | None = None) -> tuple[str, bool]:
    """Borders of about ``buckets`` ranges of nearly equal size over the ordering columns, as
    JSON text, and whether some key fills a whole range or more."""
    p = buckets or default_buckets(df)
    keys = df.select(_key(order_cols).alias("k"))
    total = keys.count()
    if p < 2 or total == 0:
        return "[]", False
    wanted = max(BORDER_SAMPLE, SAMPLES_PER_RANGE * p)
    drawn = keys if total <= wanted else keys.sample(wanted / total, BORDER_SEED)
    ranked = drawn.agg(F.sort_array(F.collect_list("k")).alias("all")).where(F.size("all") > 0)
    place = lambda i: F.get("all", F.floor(F.size("all").cast("bigint") * i / p).cast("int"))
    cuts = ranked.select(F.transform(F.sequence(F.lit(1), F.lit(p - 1)), place).alias("cuts"), F.size("all").alias("n"))
    row = cuts.select(
        F.to_json(F.array_distinct("cuts")).alias("borders"),
        # fewer rows than ranges repeat borders without any key being frequent
        ((F.size(F.array_distinct("cuts")) < F.size("cuts")) & (F.col("n") >= 2 * p)).alias("tied"),
    ).first()
    return (row["borders"], row["tied"]) if row else ("[]", False)


def with_borders(df: DataFrame, order_cols, borders: str) -> DataFrame:
    """``df`` with the range of each row: the number of borders at or below its key, found by
    binary search.  Null keys sort first, as in ``orderBy``."""
    # folded into one literal; sorted by Spark's own order, whatever the round trip through text did
    cuts = F.sort_array(F.from_json(F.lit(borders), f"array<{_key_type(df, order_cols)}>"))
    count = len(json.loads(borders))

    def halve(found, width):
        last = found["lo"] + width
        here = (last <= count) & (F.get(cuts, last - 1) <= found["key"])
        return F.struct(F.when(here, last).otherwise(found["lo"]).alias("lo"), found["key"].alias("key"))

    widths = F.array(*[F.lit(1 << i) for i in reversed(range(count.bit_length()))]) if count else F.array(F.lit(1))
    start = F.struct(F.lit(0).alias("lo"), _key(order_cols).alias("key"))
    return df.withColumn(_RANGE, F.aggregate(widths, start, halve, lambda found: found["lo"].cast("bigint")))


def _tie_hash(df: DataFrame, order_cols) -> Column | None:
    """A hash of the columns that do not order the rows; None where there is none to hash."""
    unhashable = ("map<", "variant")
    rest = [f.name for f in df.schema if f.name not in order_cols and not any(t in f.dataType.simpleString() for t in unhashable)]
    return F.xxhash64(*[F.col(f"`{c}`") for c in rest]) if rest else None


def with_ranges(df: DataFrame, order_cols, buckets: int | None = None) -> tuple[DataFrame, list[str]]:
    """``df`` with a range column that is monotone in the ordering columns and takes about
    ``buckets`` values of nearly equal size, and the columns that order the rows inside a range."""
    order = list(order_cols)
    borders, tied = range_borders(df, order, buckets)
    tie = _tie_hash(df, order) if tied else None
    if tie is not None:
        df, order = df.withColumn(_TIE, tie), [*order, _TIE]
        borders, _ = range_borders(df, order, buckets)
    return with_borders(df, order, borders), order


def _offsets(ranged: DataFrame, class_col: str) -> DataFrame:
    """(class, range, offset): rows of the class in earlier ranges."""
    counts = ranged.groupBy(class_col, _RANGE).agg(F.count(F.lit(1)).alias("_ord_n"))
    before = Window.partitionBy(class_col).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        F.col(class_col).alias("_ord_cls"),
        F.col(_RANGE).alias("_ord_r"),
        F.coalesce(F.sum("_ord_n").over(before), F.lit(0)).cast("bigint").alias("_ord_off"),
    )


def _numbered(rows: DataFrame, class_col: str, order_cols, out_col: str) -> DataFrame:
    within = Window.partitionBy(class_col, _RANGE).orderBy(*[F.col(c) for c in order_cols])
    return rows.withColumn(out_col, F.col("_ord_off") + F.row_number().over(within))


def class_ordinal(
    df: DataFrame,
    class_col: str,
    order_cols,
    out_col: str = "num",
    buckets: int | None = None,
) -> DataFrame:
    """Add ``out_col`` = 1-based position of each row inside its class by ``order_cols``."""
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    ranged, order = with_ranges(df, order_cols, buckets)
    offsets = materialize(_offsets(ranged.select(class_col, _RANGE), class_col), "range_offsets", cluster_by=None)
    # null-safe keys: rows with a null class are numbered like row_number does
    on = F.col(class_col).eqNullSafe(F.col("_ord_cls")) & (F.col(_RANGE) == F.col("_ord_r"))
    # the offsets are left to AQE: broadcast when the written counts are small, otherwise a
    # shuffle join co-partitioned with the window
    placed = ranged.join(offsets, on, "inner")
    return _numbered(placed, class_col, order, out_col).drop(*_SCRATCH)


def class_ordinal_head(
    df: DataFrame,
    class_col: str,
    order_cols,
    n: int,
    out_col: str = "num",
    buckets: int | None = None,
) -> DataFrame:
    """Ordinal for consumers that compare it only with thresholds ``<= n``.

    The first ``n`` rows of each class get their exact 1-based position by ``order_cols``;
    every later row gets ``n + 1``, which compares with every threshold ``t <= n`` exactly as
    its true position does (``> t``).  No row is dropped.  A learning curve with sizes up to
    ``n`` gives the same result on this column as on the full ordinal.

    A row of a range that begins after its
    class's ``n``-th row is settled by a join with the small offsets table; only rows
    of the ranges before (about ``n + N / P`` a class) are shuffled and numbered.
    """
    n = int(n)
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    ranged, order = with_ranges(df, order_cols, buckets)
    offsets = _offsets(ranged.select(class_col, _RANGE), class_col)
    early = materialize(offsets.where(F.col("_ord_off") < n), "early_ranges", cluster_by=None)
    on = F.col(class_col).eqNullSafe(F.col("_ord_cls")) & (F.col(_RANGE) == F.col("_ord_r"))
    head = _numbered(ranged.join(early, on, "inner"), class_col, order, out_col)
    head = head.withColumn(out_col, F.least(F.col(out_col), F.lit(n + 1).cast("bigint"))).drop(*_SCRATCH)
    rest = ranged.join(early, on, "left_anti").drop(_RANGE, _TIE).withColumn(out_col, F.lit(n + 1).cast("bigint"))
    return head.unionByName(rest)


def dense_index(df: DataFrame, col: str, out_col: str = "label_idx") -> DataFrame:
    """(out_col, col): 0-based position of every distinct non-null value in ascending order.

    The values are range-partitioned, numbered per partition and shifted by the counts of
    the partitions before, so no task holds them all."""
    values = df.select(col).where(F.col(col).isNotNull()).distinct().repartitionByRange(col)
    parts = materialize(
        values.sortWithinPartitions(col).select(
            col, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_id")
        ),
        "values",
        cluster_by=None,
    )
    first = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    shift = first.select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return parts.join(shift, "_part").select((F.col("_id") + F.col("_shift")).cast("int").alias(out_col), col)
