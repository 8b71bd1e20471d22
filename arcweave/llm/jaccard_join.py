"""N-gram Jaccard join: texts whose sets of five-word shingles are alike.

1. Each text becomes its set of shingles; texts with equal sets are one class,
   combined before the shuffle, so thousands of copies cost one row a task.
2. MinHash bands of each class's set are shuffled on band and hash. With
   ``BANDS`` bands of ``ROWS`` rows a pair at the threshold 0.8 shares a band with
   probability 1 - (1 - 0.8^4)^20 = 0.99997, one at 0.9 with 1 - 4e-10.
3. Classes that share bands, directly or through others, form clusters. All
   pairs within a cluster are verified on their full sets, so LSH can lose a
   pair only if no chain of bands connects it. A cluster is cut into blocks of
   ``BLOCK`` classes; each pair of blocks is one unit of work that emits one row
   for each class, not for each pair: its number of verified links and its
   root among them.
4. Roots are joined into groups of documents; the group's id is its smallest
   document id.

The number of links inside one group of near copies is quadratic by its
nature; so are the comparisons. Rows made are not, but rows moved are: each class of
a cluster of n is shuffled with its set once for each of the ceil(n / BLOCK) blocks.

Defined results: a null text is an empty one; a text without words links with
nothing; one of fewer than five words has one shingle, all its words; a null
document id sorts first and is reported as null; rows repeated with all columns
count as copies of each other. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arcweave.llm.components import components
from arcweave.llm.words import Words, column, mixed, slices, words_of
from arcweave.scratch import Scratch

SHINGLE = 5
BANDS, ROWS = 20, 4
BLOCK = 256
#: Up to this many rows (of 60 bytes) the clusters' members are broadcast, else shuffled.
BROADCAST_ROWS = 500_000
_SEEDS = np.random.default_rng(5).integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(words: Words, size: int = SHINGLE) -> list[np.ndarray]:
    """Each text's sorted set of shingle hashes."""
    found, first = words.shingles(size)
    return [np.unique(found[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]


def class_key(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def band_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """One row of band hashes for each set; the sets are not empty."""
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    joined = np.concatenate(sets)
    least = np.empty((BANDS * ROWS, len(sets)), np.uint64)
    for k, seed in enumerate(_SEEDS):
        least[k] = np.minimum.reduceat((joined * seed) >> np.uint64(16), first)
    bands = np.empty((len(sets), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(sets), b + 1, np.uint64)
        for row in least[b * ROWS : (b + 1) * ROWS]:
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + row)
        bands[:, b] = key
    return bands


def _signed(docs: DataFrame) -> DataFrame:
    """(doc_id, class, bands) of each row; class and bands are null without words."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(words_of(column(batch, "text")))
            keys = [class_key(s) for s in sets]
            some = [s for s in sets if len(s)]
            rows = iter(band_hashes(some).view(np.int64) if some else ())
            bands = [next(rows) if k else None for k in keys]
            arrays = [column(batch, "doc_id"), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "class", "bands"])

    return docs.mapInArrow(signed, f"doc_id {dict(docs.dtypes)['doc_id']}, class binary, bands array<long>")


def _linked(members: list[tuple[bytes, int, int, np.ndarray]], left: int, right: int, percent: int) -> Iterator[tuple[bytes, int, bytes]]:
    """(class, links, root) of the classes in one pair of blocks of a cluster."""
    members = sorted({m[0]: m for m in members}.values(), key=lambda m: (m[2] != left, m[0]))
    n, sets = len(members), [m[3] for m in members]
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    shingle, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.cumsum(times > 1) - 1
    shared = times[place] > 1
    owner, place = owner[shared], rank[place[shared]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    common = np.zeros((n, n), np.float32)
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, 4096):
        a, b = np.searchsorted(place, [low, low + 4096])
        dense = np.zeros((n, 4096), np.float32)
        dense[owner[a:b], place[a:b] - low] = 1
        common += dense @ dense.T
    common = common.astype(np.int64)
    like = common * 100 >= percent * (sizes[:, None] + sizes[None, :] - common)
    np.fill_diagonal(like, False)
    if left != right:
        side = np.array([m[2] == left for m in members])
        like &= side[:, None] != side[None, :]
    weight = np.array([m[1] for m in members], np.int64)
    links = like @ weight
    root = np.arange(n)
    while True:
        lowest = np.minimum(root, np.where(like, root[None, :], n).min(1, initial=n))
        lowest = np.minimum(lowest, lowest[lowest])
        if (lowest == root).all():
            break
        root = lowest
    for i, m in enumerate(members):
        if links[i]:
            yield m[0], int(links[i]), members[root[i]][0]


def _verified(members: DataFrame, percent: int) -> DataFrame:
    """(class, links, root) of rows (cluster, left, right, class, copies, block, shingles), sorted by unit of work."""

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def units():
            unit, held = None, []
            for batch in batches:
                for at in range(0, batch.num_rows, 128):
                    for r in batch.slice(at, 128).to_pylist():
                        own = (r["cluster"], r["left"], r["right"])
                        if own != unit:
                            if held:
                                yield unit, held
                            unit, held = own, []
                        held.append((r["class"], r["copies"], r["block"], np.frombuffer(r["shingles"], np.uint64)))
            if held:
                yield unit, held

        found: list[tuple] = []
        for (_, left, right), held in units():
            found += _linked(held, left, right, percent)
            if len(found) >= 4096:
                yield _columns(found)
                found = []
        yield _columns(found)

    def _columns(rows):
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.binary()), strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["class", "links", "root"])

    return members.mapInArrow(verified, "class binary, links long, root binary")


def jaccard_groups(docs: DataFrame, scratch: Scratch, percent: int = 80) -> DataFrame:
    """One row (doc_id, class_id, n_links) for each row (doc_id, text).

    ``class_id`` is the smallest doc_id that is linked, directly or through
    others; ``n_links`` counts the rows at a Jaccard similarity of at least
    ``percent`` / 100, copies included.
    """
    docs = docs.select("doc_id", "text")
    signed = scratch.save(_signed(docs), "signed")
    classes = scratch.save(
        signed.where(F.col("class").isNotNull())
        .groupBy("class")
        .agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")),
        "classes",
    )
    first = classes.select("class", F.col("least").alias("doc_id"))
    # One row of bands for each class; null ids do not join and are added back below.
    bands = signed.select("class", F.posexplode("bands").alias("band", "hash"))
    heads = scratch.save(
        bands.groupBy("band", "hash")
        .agg(F.min("class").alias("a"), F.max("class").alias("last"))
        .where(F.col("a") != F.col("last"))
        .select("band", "hash", "a"),
        "heads",
    )
    # Each class is linked to the least head of its buckets, and that to its other heads: in a
    # large group of near copies the heads repeat, so there are few links more than classes.
    near = scratch.save(
        bands.join(heads, ["band", "hash"]).groupBy("class").agg(F.array_sort(F.collect_set("a")).alias("heads")), "near"
    )
    near = near.select(F.col("heads")[0].alias("a"), F.col("class").alias("b")).unionByName(
        near.select(F.col("heads")[0].alias("a"), F.explode(F.slice("heads", 2, BANDS)).alias("b")).distinct()
    )
    clusters = scratch.save(components(near, scratch).withColumnsRenamed({"node": "class", "root": "cluster"}), "clusters")
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("size"))
    members = scratch.save(
        clusters.join(sizes, "cluster")
        .join(classes, "class")
        .select(
            "cluster",
            "class",
            "copies",
            F.col("least").alias("doc_id"),
            F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"),
            F.pmod(F.xxhash64("class"), F.ceil(F.col("size") / BLOCK)).cast("int").alias("block"),
        ),
        "members",
    )
    few = members.count() <= BROADCAST_ROWS
    wanted = (F.broadcast(members) if few else members).withColumnRenamed("doc_id", "_id")
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id", "doc_id")
    placed = _with_sets(texts).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )
    units = placed.select(
        "cluster",
        F.least("block", "other").alias("left"),
        F.greatest("block", "other").alias("right"),
        "class",
        "copies",
        "block",
        "shingles",
    )
    order = ["cluster", "left", "right"]
    links = scratch.save(_verified(units.repartition(*order).sortWithinPartitions(*order), percent), "links")
    counts = links.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(links.select(F.col("class").alias("a"), F.col("root").alias("b")), scratch)
    named = first.join(roots.withColumnRenamed("node", "class"), "class").groupBy("root").agg(F.min("doc_id").alias("class_id"))
    group = roots.join(named, "root").select(F.col("node").alias("class"), "class_id")
    result = scratch.save(
        classes.join(group, "class", "left")
        .join(counts, "class", "left")
        .select(
            "class",
            F.coalesce("class_id", "least").alias("class_id"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        ),
        "result",
    )
    return (
        signed.select("doc_id", "class")
        .join(result, "class", "left")
        .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    )


def _with_sets(texts: DataFrame) -> DataFrame:
    """Replace text by its shingles, where they are the class's own (ids may repeat with other texts)."""
    names = [n for n in texts.columns if n != "text"]
    fields = ", ".join(f"`{n}` {t}" for n, t in texts.dtypes if n != "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = shingle_sets(words_of(column(batch, "text")))
            own = [class_key(s) == k for s, k in zip(found, column(batch, "class").to_pylist(), strict=True)]
            arrays = [*(column(batch, n) for n in names), pa.array([s.tobytes() for s in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "shingles"]).filter(pa.array(own))

    return texts.mapInArrow(sets, f"{fields}, shingles binary")


def one_of_each_group(docs: DataFrame, scratch: Scratch, percent: int = 80) -> DataFrame:
    """The rows whose id is their group's smallest; rows that repeat that id once."""
    groups = jaccard_groups(docs, scratch, percent)
    kept = scratch.save(
        groups.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("doc_id").agg(F.count("*").alias("_times")), "kept"
    )
    wanted = kept.withColumnRenamed("doc_id", "_id")
    # Few ids go to the texts; the texts move to their ids only beyond that.
    wanted = F.broadcast(wanted) if kept.count() <= BROADCAST_ROWS else wanted
    rows = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id")
    once = rows.where(F.col("_times") == 1).drop("_times")
    if kept.where(F.col("_times") > 1).isEmpty():
        return once
    return once.unionByName(rows.where(F.col("_times") > 1).drop("_times").dropDuplicates(["doc_id", "text"]))
