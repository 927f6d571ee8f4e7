"""Near-duplicate groups by min-max hashing (operator 1).

``near_duplicates`` links two documents whose shingle sets have a Jaccard similarity
of at least ``percent`` / 100 and returns the connected components of the links.

1.  *Sketch.*  One pass over the whole texts gives each document the digest of its
    shingle set, its min-max signature and its band keys (``sketch.MinMax``).
2.  *Equal sets* share a digest: they are one class, represented by its smallest
    document, and never compared again.  A class of a third of all rows costs one
    pre-aggregated row.
3.  *Star.*  In every bucket (equal band key) each member is paired with one hub: the
    member that shares most buckets with most others.  The pair is decided on the full
    shingle sets, and leaves behind in which shingles the member differs from its hub.
    Pairs grow with the rows of the buckets, not with their square.
4.  *Rest.*  Two members of a bucket that the links so far have not put into one component
    may still be linked.  Both differ from the bucket's hub in known shingles, and these
    differences alone give the exact size of their intersection: with D the difference of
    a set from the hub B and r the part of B it lacks, ``|X & Y| = |B| - r(X) - r(Y) + |D(X) & D(Y)|``.
    So members are compared inside the tasks, hub by hub and block by block, over an inverted
    index of the differences, without their texts; a task puts out a link only where it joins
    two components.  So every pair that shares a bucket is decided, and no pairs are emitted.

With 64 permutations (128 values, 32 bands of 4) two sets of similarity 0.8 share no
bucket with probability (1 - 0.8^4)^32 < 1e-7, and agree on less than ``floor`` of the
values at five standard deviations.

Defined results: null text or text without words -> no shingles, linked with nothing;
rows that share a doc_id are one document for linking; a null doc_id is linked with
nothing (null component, kept); an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelab.llm.common import staged, wide_input
from curvelab.llm.components import components
from curvelab.llm.sketch import MinMax, shingle_sets

SKETCH_SCHEMA = "doc_id long, n_shingles long, digest binary, bands array<long>, signature binary"
SLICE_ROWS = 256


def _slices(batches, rows: int = SLICE_ROWS):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sketch_documents(docs: DataFrame, width: int, permutations: int, rows: int) -> DataFrame:
    """One sketch a row; digest, bands and signature are null where there are no shingles."""

    def run(batches):
        minmax = MinMax(permutations, rows)
        for batch in _slices(batches):
            sets = shingle_sets(batch.column("text"), width)
            live = np.array([len(s) > 0 for s in sets], dtype=bool)
            signatures = minmax.signatures(sets)
            keys = minmax.band_keys(signatures)
            marks = (signatures & np.uint32(0xFF)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([k if ok else None for k, ok in zip(keys, live)], pa.list_(pa.int64())),
                    pa.array([m.tobytes() if ok else None for m, ok in zip(marks, live)], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "digest", "bands", "signature"],
            )

    return wide_input(docs, "doc_id", "text").mapInArrow(run, SKETCH_SCHEMA)


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal values; one byte a value, so 1/256 of the unequal ones agree by chance."""
    return (a == b).mean(axis=-1)


STARS = "hub long, doc_id long, linked boolean, n_hub long, n long, lacks long, far boolean, shingles binary"


def compare_with_hubs(star: DataFrame, docs: DataFrame, signatures: DataFrame, width: int, percent: int, floor: float) -> DataFrame:
    """Step 3.  ``star``: hub, doc_id, members (how many members the hub has).

    Gives one row per pair that may be linked or whose hub has other members: whether the
    full sets reach ``percent``, the sizes of both sets, how many of the hub's shingles the member
    lacks, and for hubs with other members the shingles in which it differs from the hub (of a ``far``
    member, with less than ``FAR`` in common, all its own)."""
    marks = signatures.select(F.col("doc_id"), F.col("signature").alias("sig"))
    near = star.join(marks, "doc_id").join(marks.toDF("hub", "sig_hub"), "hub")

    def screen(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            sig = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sig", "sig_hub")]
            keep = (_agreement(*sig) >= floor) | (batch.column("members").to_numpy() > 1)
            yield batch.filter(pa.array(keep)).select(["hub", "doc_id", "members"])

    near = staged(near.mapInArrow(screen, "hub long, doc_id long, members long"), "star_pairs")
    # the ids grow with the documents: one plan at every size, which shuffles the texts once
    wanted = near.select("doc_id").union(near.select("hub")).distinct().hint("merge")
    texts = staged(wide_input(docs, "doc_id", "text").join(wanted, "doc_id", "left_semi").distinct(), "star_texts")
    both = (
        near.join(texts, "doc_id")
        .join(texts.toDF("hub", "hub_text"), "hub")
        .select("hub", "doc_id", "members", "text", "hub_text")
    )

    def compare(batches):
        # the join leaves rows of one hub together: its set is made once
        last, hub_set = None, None
        for batch in _slices(batches):
            out = []
            hub_texts = batch.column("hub_text")
            for i, (hub, doc, members, mine) in enumerate(
                zip(
                    batch.column("hub").to_pylist(),
                    batch.column("doc_id").to_pylist(),
                    batch.column("members").to_pylist(),
                    shingle_sets(batch.column("text"), width),
                )
            ):
                text = hub_texts[i].as_py()
                if last != text:
                    last, hub_set = text, shingle_sets(pa.array([text], pa.string()), width)[0]
                common = len(np.intersect1d(mine, hub_set, assume_unique=True))
                far = common < FAR * max(len(mine), len(hub_set))
                shingles = None
                if members > 1:
                    shingles = (mine if far else np.setxor1d(mine, hub_set, assume_unique=True)).tobytes()
                linked = common > 0 and 100 * common >= percent * (len(mine) + len(hub_set) - common)
                out.append((hub, doc, linked, len(hub_set), len(mine), len(hub_set) - common, far, shingles))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), _STAR_TYPES)], names=_STAR_NAMES)

    return both.mapInArrow(compare, STARS)


#: A member with less than this share of shingles in common is kept by its own set, which is then the shorter one.
FAR = 0.3
_STAR_NAMES = [c.split()[0] for c in STARS.split(", ")]
_STAR_TYPES = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]


class _Index:
    """Members by shingle, for shingles that at least two of them hold."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = len(sets)
        flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(self.n), [len(s) for s in sets])
        order = np.argsort(flat, kind="stable")
        self.values, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.owners = owner[order]

    def overlaps(self, one: np.ndarray) -> np.ndarray:
        """How many shingles each member shares with this set."""
        at = np.searchsorted(self.values, one)
        at[at == len(self.values)] = 0
        at = at[self.values[at] == one] if len(self.values) else at[:0]
        at = at[self.count[at] > 1]
        hits = [self.owners[f : f + c] for f, c in zip(self.first[at].tolist(), self.count[at].tolist())]
        return np.bincount(np.concatenate(hits), minlength=self.n) if hits else np.zeros(self.n, np.int64)


def _linked_across(ids, comp, own, sizes, lacks, far, sets, n_hub, hub_set, percent, cross) -> list[tuple[int, int]]:
    """Links between different components among a hub's members.  ``cross``: only pairs of different ``own``."""
    place = {c: c for c in comp.tolist()}

    def root(c):
        while place[c] != c:
            place[c] = place[place[c]]
            c = place[c]
        return c

    values, counts = np.unique(comp, return_counts=True)
    minor = comp != values[counts.argmax()]
    found: list[tuple[int, int]] = []

    def take(x: int, rows: np.ndarray, both: np.ndarray) -> None:
        ok = 100 * both >= percent * (sizes[x] + sizes[rows] - both)
        if cross:
            ok &= own[rows] != own[x]
        for y in rows[ok].tolist():
            a, b = root(int(comp[x])), root(int(comp[y]))
            if a != b:
                place[max(a, b)] = min(a, b)
                found.append((int(ids[x]), int(ids[y])))

    close = np.flatnonzero(~far)
    if minor[close].any():
        # near members: intersections from the differences alone
        index = _Index([sets[i] for i in close])
        for x in close[minor[close]]:
            take(x, close, n_hub - lacks[x] - lacks[close] + index.overlaps(sets[x]))
    if far.any():
        # far members: against everyone's full sets
        full = [s if f else np.setxor1d(s, hub_set, assume_unique=True) for s, f in zip(sets, far)]
        index = _Index(full)
        everyone = np.arange(len(ids))
        for x in np.flatnonzero(far):
            take(x, everyone, index.overlaps(full[x]))
    return found


def rest_links(members: DataFrame, hub_sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Step 4: links (a, b) between different components of one hub's members.

    ``members``: the rows of ``STARS`` with component and members; ``hub_sets``: hub, shingles.  A hub
    of more than ``block`` members is cut into blocks by a hash of the document, and each pair
    of blocks is one group, so no task holds more than two blocks."""
    blocks = F.ceil(F.col("members") / block).cast("int")
    dealt = (
        members.withColumn("own", F.pmod(F.xxhash64("doc_id"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            "hub",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            "own",
            "doc_id",
            "component",
            "n_hub",
            "n",
            "lacks",
            "far",
            "shingles",
        )
    )
    counts = members.groupBy("hub").agg(F.max(blocks).alias("k"))
    centres = (
        hub_sets.join(counts, "hub")
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        .withColumn("j", F.explode(F.sequence(F.col("i"), F.col("k") - 1)))
        .selectExpr(
            "hub", "i", "j", "-1 AS own", "hub AS doc_id", "hub AS component", "0L AS n_hub", "0L AS n", "0L AS lacks", "true AS far", "shingles"
        )
    )

    def compare(group: pa.Table) -> pa.Table:
        own = group.column("own").to_numpy()
        get = lambda c: group.column(c).to_numpy()[own >= 0]
        sets = [np.frombuffer(b, np.uint64) for b in group.column("shingles").to_pylist()]
        hub_set = next((s for s, o in zip(sets, own) if o < 0), np.empty(0, np.uint64))
        sets = [s for s, o in zip(sets, own) if o >= 0]
        cross = group.column("i")[0].as_py() != group.column("j")[0].as_py()
        links = []
        if len(sets) > 1:
            links = _linked_across(
                get("doc_id"), get("component"), get("own"), get("n"), get("lacks"), get("far"), sets, get("n_hub").max(), hub_set, percent, cross
            )
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.union(centres).groupBy("hub", "i", "j").applyInArrow(compare, "a long, b long")


def _sets_of(hubs: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(hub, shingles) of the hubs' texts."""
    texts = wide_input(docs, "doc_id", "text").join(hubs.select(F.col("hub").alias("doc_id")), "doc_id", "left_semi")

    def run(batches):
        for batch in _slices(batches):
            sets = [s.tobytes() for s in shingle_sets(batch.column("text"), width)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], names=["hub", "shingles"])

    return texts.mapInArrow(run, "hub long, shingles binary").dropDuplicates(["hub"])


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    permutations: int = 64,
    rows: int = 4,
    block: int = 4096,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    spread = math.sqrt(percent / 100 * (1 - percent / 100) / (2 * permutations))
    floor = percent / 100 - 5 * spread
    sketch = staged(sketch_documents(docs, width, permutations, rows), "sketch")

    live = sketch.where("digest is not null and doc_id is not null")
    classes = staged(live.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    reps = live.join(classes, "digest").where("doc_id = rep").dropDuplicates(["digest"])
    reps = staged(reps.select("doc_id", "bands", "signature"), "reps")
    keyed = reps.select("doc_id", F.explode("bands").alias("key"))
    crowded = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = staged(keyed.join(crowded, "key"), "buckets")

    weight = buckets.groupBy("doc_id").agg(F.sum("n").alias("weight"))
    weighed = buckets.join(weight, "doc_id")
    hubs = weighed.groupBy("key").agg(F.max(F.struct("weight", (-F.col("doc_id")).alias("neg"))).alias("top"))
    hubs = hubs.select("key", (-F.col("top.neg")).alias("hub"))
    star = staged(buckets.join(hubs, "key").where("doc_id <> hub").select("hub", "doc_id").distinct(), "star")
    star = star.join(star.groupBy("hub").agg(F.count("*").alias("members")), "hub")
    signatures = reps.select("doc_id", "signature")
    stars = staged(compare_with_hubs(star, docs, signatures, width, percent, floor), "stars")
    links = stars.where("linked").select(F.col("hub").alias("a"), F.col("doc_id").alias("b"))
    groups = components(links, "a", "b")

    placed = (
        stars.where("shingles is not null")
        .join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .withColumn("component", F.coalesce("component", "doc_id"))
    )
    open_hubs = placed.groupBy("hub").agg(
        F.count("*").alias("members"), F.min("component").alias("lo"), F.max("component").alias("hi")
    )
    open_hubs = staged(open_hubs.where("lo <> hi").select("hub", "members"), "open_hubs")
    more = staged(rest_links(placed.join(open_hubs, "hub"), _sets_of(open_hubs, docs, width), percent, block), "more_links")
    groups = components(links.union(more), "a", "b")

    labels = classes.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("component_id")
    )
    found = sketch.select("doc_id", "n_shingles", "digest").join(labels, "digest", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        own.alias("component_id"),
        F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay when one row of each near-duplicate group does: the one of the
    smallest doc_id (null behind all others); of repeated rows any one.  Every row counts as a document
    of its own here, also one that shares its doc_id or has none."""
    row = "row"
    while any(c.lower() == row for c in docs.columns):
        row = "_" + row
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    groups = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), **options)
    groups = groups.select(F.col("doc_id").alias("member"), "component_id")
    several = groups.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1")
    groups = groups.join(several.select("component_id"), "component_id")
    ids = rows.select(F.col(row).alias("member"), F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(row).alias("member")).alias("order"))
    groups = staged(groups.join(ids, "member"), "groups")
    first = groups.groupBy("component_id").agg(F.min("order").alias("first"))
    gone = groups.join(first, "component_id").where(F.col("member") != F.col("first.member"))
    return rows.join(gone.select(F.col("member").alias(row)), row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
