"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables (operator 9).

1.  *Codes.*  Vectors are normalised and centred; principal directions and a rotation learned by
    iterative quantisation (alternate between the signs and the orthogonal map that fits
    them best) give balanced bits.  Several rotations from different starts give more
    bits than dimensions.  The fit sees at most ``sample`` vectors; every vector is indexed.
2.  *Tables.*  The code is cut into strings of ``width`` bits, one hash table each.  Two
    vectors are candidates if they agree on a whole string and differ in at most ``radius`` of the
    first ``SKETCH`` bits.  Width, tables and radius are measured: pairs of the sample at the
    threshold, and pairs planted there, are coded, and tables added until at most the share ``miss``
    of either kind meets in none.  Of the widths, and of codes with and without centring
    (centring widens the angle of a pair by as much as the vectors have in common), the
    cheapest by entries and expected meetings is taken.  Its far end, one table with strings of
    no bits, compares all vectors of a label; only data that tables cannot part go there.
3.  *Groups of near copies.*  In some tables each vector is compared with the smallest vector of its
    bucket, its hub.  Vectors within half the threshold's angle of one hub are linked with one
    another, whatever their number, so they form a cluster whose links are counted and never
    listed; only pairs of different clusters are.
4.  *Rerank.*  Candidates' cosines are computed in double precision on the original vectors.

Equal vectors of a label are one node with a count, so copies are never paired.  Links are
counted per row: the node's other copies and the copies of linked nodes.  A group that is wider than
the clusters is listed pair by pair across them.

Defined results: a vector that is null, empty, zero, or holds null or non-finite components, or
whose label or vec_id is null, links with nothing and is its own component (null for a null
vec_id); vectors of different length never link; every input row gives one row, repeated ones
too (rows of one label that share vec_id and vector count as copies of each other); an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelab.llm.common import staged
from curvelab.llm.components import components

#: Bits that decide which candidates are reranked; tables that look for hubs; members of a list of near copies.
SKETCH, HUB_TABLES, LIST = 64, 4, 256
#: Most code bits for each dimension, and what a meeting in a bucket costs in units of a table's entry.
MOST_BITS, MEETING = 128, 1 / 30
LEAST_WIDTH = 4


class Quantiser:
    """Mean, and the projections whose signs are the code bits."""

    def __init__(self, vectors: np.ndarray, bits: int, centred: bool = True, rounds: int = 40, seed: int = 5):
        rng = np.random.default_rng(seed)
        x = unit(vectors)
        self.mean = x.mean(axis=0) if centred else np.zeros(x.shape[1])
        x = x - self.mean
        _, axes = np.linalg.eigh(x.T @ x)
        maps, d = [], x.shape[1]
        while sum(m.shape[1] for m in maps) < bits:
            v = x @ axes
            r = np.linalg.qr(rng.normal(size=(d, d)))[0]
            for _ in range(rounds):
                u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
                r = (u @ w).T
            maps.append(axes @ r)
        self.map = np.concatenate(maps, axis=1)[:, :bits]

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Bits (vectors, bits) as 0 and 1."""
        x = unit(vectors) - self.mean
        return (x @ self.map >= 0).astype(np.uint8)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def pairs_at(x: np.ndarray, threshold: float, seed: int = 7) -> list[tuple[np.ndarray, np.ndarray]]:
    """Kinds of pairs of unit vectors at the threshold: planted ones, whose difference points
    anywhere, then to another vector of ``x``; and those of ``x`` itself that lie little above it."""
    rng = np.random.default_rng(seed)
    most = min(8192, max(1024, (1 << 19) // x.shape[1]))
    x = unit(x)
    one = np.tile(x, (-(-most // len(x)), 1))[:most]
    kinds = []
    for b in (rng.normal(size=one.shape), x[rng.integers(len(x), size=len(one))]):
        b = b - np.einsum("ij,ij->i", one, b)[:, None] * one
        size = np.linalg.norm(b, axis=1)
        ok = size > 1e-6
        kinds.append((one[ok], threshold * one[ok] + math.sqrt(1 - threshold**2) * b[ok] / size[ok, None]))
    found = []
    for start in range(0, len(x), 512):
        cosine = x[start : start + 512] @ x.T
        a, b = np.nonzero((cosine >= threshold) & (cosine <= threshold + (1 - threshold) / 4))
        later = np.flatnonzero(a + start < b)
        if len(later) > most:
            later = rng.choice(later, most, replace=False)
        found.append(np.stack([a[later] + start, b[later]]))
    near = np.concatenate(found, axis=1)
    if near.shape[1] > most:
        near = near[:, rng.choice(near.shape[1], most, replace=False)]
    kinds.append((x[near[0]], x[near[1]]))
    return [k for k in kinds if len(k[0])]


@dataclass
class Plan:
    quantiser: Quantiser
    width: int
    tables: int
    radius: int  # of candidates, on the sketch
    hub_radius: int  # of vectors within half the threshold's angle
    cost: float


def tables_for(differ: list[np.ndarray], width: int, miss: float, most: int) -> int:
    """Tables of ``width``-bit strings by which the pairs, given by their shares of different bits, meet
    but for the share ``miss`` of each kind; more than ``most`` where that does not suffice."""

    def missed(t: int) -> float:
        return max(float(((1 - (1 - p) ** width) ** t).mean()) for p in differ)

    low, high = 0, 1
    while missed(high) > miss:
        if high > most:
            return high
        low, high = high, 2 * high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if missed(middle) > miss else (low, middle)
    return high


def _plan(x: np.ndarray, kinds, near, strangers, n: float, miss: float, centred: bool) -> Plan | None:
    all_bits = MOST_BITS * x.shape[1]
    quantiser = Quantiser(x, min(512, all_bits), centred)
    apart = lambda pairs: quantiser.codes(pairs[0]) != quantiser.codes(pairs[1])
    share = [apart(k).mean(axis=1) for k in kinds]
    alike = 1 - apart(strangers).mean(axis=1)
    best = None
    for width in range(LEAST_WIDTH, LEAST_WIDTH + math.ceil(math.log2(max(2, n)))):
        most = all_bits // width
        tables = tables_for(share, width, miss, most)
        cost = tables * (1 + n * (alike**width).mean() * MEETING)
        if tables <= most and (best is None or cost < best[0]):
            best = cost, width, tables
    if best is None and centred:
        return None
    _, width, tables = best or (0, 0, 1)
    while True:
        bits = max(SKETCH, width * tables)
        if len(quantiser.map.T) < bits:
            quantiser = Quantiser(x, bits, centred)
        strings = [apart(k)[:, : width * tables].reshape(len(k[0]), tables, width) for k in kinds]
        if all(s.any(axis=2).all(axis=1).mean() <= miss for s in strings):
            break
        tables += 1 + tables // 16
        if width * tables > all_bits:
            width, tables = 0, 1
    radius = 1 + max(int(apart(k)[:, :SKETCH].sum(axis=1).max()) for k in kinds)
    hub_radius = 1 + max(int(apart(k)[:, :SKETCH].sum(axis=1).max()) for k in near)
    quantiser.map = quantiser.map[:, :bits]
    return Plan(quantiser, width, tables, min(radius, SKETCH), min(hub_radius, SKETCH), tables * (1 + n * (alike**width).mean() * MEETING))


def measured_plan(x: np.ndarray, n: float, threshold: float, miss: float) -> Plan:
    """The cheapest plan for vectors of which ``x`` is a sample; ``n`` is how many share a label, on average
    over the vectors."""
    rng = np.random.default_rng(11)
    kinds, near = pairs_at(x, threshold), pairs_at(x, half_angle(threshold))
    one, two = unit(x)[rng.integers(len(x), size=(2, 4096))]
    apart = np.einsum("ij,ij->i", one, two) < threshold
    strangers = (one[apart], two[apart]) if apart.any() else (one, two)
    plans = [_plan(x, kinds, near, strangers, n, miss, centred) for centred in (True, False)]
    return min((p for p in plans if p is not None), key=lambda p: p.cost)


def half_angle(cosine: float) -> float:
    return math.cos(math.acos(cosine) / 2)


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _encode(nodes: DataFrame, plan: Plan) -> DataFrame:
    """(label, node, sketch, strings as longs) of every node."""
    quantiser, width, tables = plan.quantiser, plan.width, plan.tables

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            bits = quantiser.codes(_matrix(batch.column("embedding")))
            strings = bits[:, : width * tables].reshape(len(bits), tables, width) @ (1 << np.arange(width, dtype=np.int64))
            sketch = np.packbits(bits[:, :SKETCH], axis=1, bitorder="little").view("<i8").ravel()
            offsets = pa.array(np.arange(len(bits) + 1, dtype=np.int32) * tables)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("label"),
                    batch.column("node"),
                    pa.array(sketch.astype(np.int64)),
                    pa.ListArray.from_arrays(offsets, pa.array(strings.ravel().astype(np.int64))),
                ],
                names=["label", "node", "sketch", "strings"],
            )

    return nodes.select("label", "node", "embedding").mapInArrow(run, "label int, node long, sketch long, strings array<long>")


def _entries(coded: DataFrame, *columns: str) -> DataFrame:
    """(bucket, columns) of every vector in every table."""
    rows = coded.select("label", *columns, F.posexplode("strings").alias("t", "s"))
    return rows.select(F.xxhash64("label", "t", "s").alias("bucket"), *columns)


def _apart(a, b):
    return F.bit_count(a.bitwiseXOR(b))


def _near_hubs(coded: DataFrame, radius: int) -> DataFrame:
    """(a: hub, b: vector) that may lie within ``radius`` bits, from some of the tables."""
    some = coded.withColumn("strings", F.slice("strings", 1, HUB_TABLES))
    entries = _entries(some, "node", "sketch")
    hubs = entries.groupBy("bucket").agg(F.min(F.struct("node", "sketch")).alias("hub"), F.count("*").alias("n")).where("n > 1")
    met = entries.join(hubs.select("bucket", "hub"), "bucket")
    met = met.where((F.col("node") != F.col("hub.node")) & (_apart(F.col("sketch"), F.col("hub.sketch")) <= radius))
    return met.select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct()


def _candidates(coded: DataFrame, clusters: DataFrame, radius: int) -> DataFrame:
    """(a, b) that share a bucket, lie in different clusters and differ in at most ``radius`` bits of the
    sketch.  ``clusters``: (node, cluster, size) of the vectors in clusters of several."""
    placed = coded.join(clusters, "node", "left")
    single = _entries(placed.where("cluster is null"), "node", "sketch")
    # the members of a cluster in a bucket, in lists of about LIST
    chunk = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / LIST)).alias("chunk")
    several = placed.where("cluster is not null").select("label", "node", "sketch", "strings", "cluster", chunk)
    lists = (
        _entries(several, "node", "sketch", "cluster", "chunk")
        .groupBy("bucket", "cluster", "chunk")
        .agg(F.collect_list(F.struct("node", "sketch")).alias("members"))
        .drop("chunk")
    )
    left, right = single.toDF("bucket", "a", "sa"), single.toDF("bucket", "b", "sb")
    close = _apart(F.col("sa"), F.col("sb")) <= radius
    ones = left.join(right, "bucket").where((F.col("a") < F.col("b")) & close).select("a", "b")
    member = F.explode("members").alias("m")
    one_list = left.join(lists, "bucket").select("a", "sa", member).select("a", "sa", F.col("m.node").alias("b"), F.col("m.sketch").alias("sb"))
    first, second = lists.toDF("bucket", "ca", "members"), lists.toDF("bucket", "cb", "others")
    two = first.join(second, "bucket").where("ca < cb").select(member, "others").select("m", F.explode("others").alias("o"))
    two = two.select(F.col("m.node").alias("a"), F.col("m.sketch").alias("sa"), F.col("o.node").alias("b"), F.col("o.sketch").alias("sb"))
    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    listed = one_list.union(two.select("a", "sa", "b", "sb")).where(close).select(*ordered)
    return ones.union(listed).distinct()


def _rerank(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    vectors = nodes.select("node", "embedding")
    both = pairs.join(vectors.toDF("a", "va"), "a").join(vectors.toDF("b", "vb"), "b").select("a", "b", "va", "vb")

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x, y = _matrix(batch.column("va")), _matrix(batch.column("vb"))
            dots = np.einsum("ij,ij->i", x, y)
            cosine = dots / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y)))
            keep = pa.array(cosine >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def usable(vector: str):
    """True for vectors that can link: not null, empty or zero, all components finite."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def linked_vectors(vectors: DataFrame, threshold: float = 0.93, sample: int = 4096, miss: float = 1e-3) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label)."""
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    good = rows.where(usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    # minus zero is zero: equal vectors must be equal values
    good = good.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0)))
    nodes = staged(
        good.groupBy("label", "embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("node")),
        "nodes",
    )
    links, clusters = None, None
    sizes = nodes.groupBy(F.size("embedding").alias("length"), "label").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("length").agg((F.sum(F.col("n").cast("double") * F.col("n")) / F.sum("n")).alias("n"))
    tight = half_angle(threshold) + 1e-6
    for length, n in sorted((r[0], r[1]) for r in sizes.collect()):
        mine = nodes.where(F.size("embedding") == length)
        some = mine.orderBy(F.xxhash64("embedding"), "label").limit(sample).select("embedding").toPandas()["embedding"]
        plan = measured_plan(np.array([np.asarray(v, float) for v in some]), n, threshold, miss)
        coded = staged(_encode(mine, plan), "codes")
        stars = _rerank(_near_hubs(coded, plan.hub_radius), mine, tight)
        own = stars.groupBy("b").agg(F.min("a").alias("cluster")).withColumnRenamed("b", "node")
        # a hub that stands in no other cluster is in its own
        hubs = own.select(F.col("cluster").alias("node"), "cluster").distinct()
        own = staged(own.union(hubs.join(own.select("node"), "node", "left_anti")), "clusters")
        own = own.join(own.groupBy("cluster").agg(F.count("*").alias("size")), "cluster").select("node", "cluster", "size")
        found = _rerank(staged(_candidates(coded, own, plan.radius), "candidates"), mine, threshold)
        links = found if links is None else links.union(found)
        clusters = own if clusters is None else clusters.union(own)
    spark = nodes.sparkSession
    if links is None:
        links, clusters = spark.createDataFrame([], "a long, b long"), spark.createDataFrame([], "node long, cluster long, size long")
    links, clusters = staged(links, "links"), staged(clusters, "clusters")
    both = links.union(links.select("b", "a")).toDF("node", "other")
    copies = nodes.select(F.col("node").alias("other"), "copies")
    inside = clusters.join(nodes.select("node", "copies"), "node")
    total = inside.groupBy("cluster").agg(F.sum("copies").alias("all"))
    inside = inside.join(total, "cluster").select("node", (F.col("all") - F.col("copies")).alias("linked"))
    counted = both.join(copies, "other").select("node", F.col("copies").alias("linked")).union(inside)
    counted = counted.groupBy("node").agg(F.sum("linked").alias("linked"))
    links = links.union(clusters.select("node", "cluster"))
    groups = components(links, "a", "b")
    known = (
        nodes.join(counted, "node", "left")
        .join(groups, "node", "left")
        .select(
            "label",
            "embedding",
            (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    key = rows.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0)))
    out = key.withColumn("ok", usable("embedding") & F.col("vec_id").isNotNull()).join(
        known.withColumn("ok", F.lit(True)), ["label", "embedding", "ok"], "left"
    )
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
