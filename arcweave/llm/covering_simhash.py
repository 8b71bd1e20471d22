"""SimHash near duplicates by covering locality-sensitive hashing.

A text's 64-bit fingerprint is the majority of its shingles' hashes, bit by bit.
Equal fingerprints are one row from then on. Two fingerprints link at ``RADIUS``
or fewer differing bits, and all such pairs are found, with certainty:

Each bit position gets a code, a vector of RADIUS + 1 bits that is not zero; a
mask for each non-zero vector v keeps the positions whose code has an odd number
of ones in common with v. The codes of RADIUS differing bits span less than the
whole space, so some v has none in common with all of them: its mask keeps no
differing bit, and both fingerprints meet in its table. 15 masks for 3 bits, each
keeping about half of the positions.

A bucket of a table holds fingerprints that agree on the kept positions. One of
more than ``BUCKET`` members, as a large group of near copies makes, is hashed
again by masks over the positions that are still free: any pair in it differs
in these only, so the guarantee holds again. Three levels leave at most 8 free
positions, so at most 256 different fingerprints: every bucket that is compared
is bounded without a cap. A bucket yields one row for each member, the smallest
member it is linked to directly or through others there, not one for each pair.

Defined results: a null text is an empty one; a text without words has the
fingerprint zero and links like any other; one of fewer words than a shingle has
one shingle, all its words. A null document id takes part and is reported as null;
it is nobody's component id unless the component has no other. Repeated rows
stay, with equal results. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arcweave.llm.components import components
from arcweave.llm.words import column, slices
from arcweave.operators.skew import join_unique
from arcweave.scratch import Scratch

SHINGLE, SEED = 3, 42
BITS, RADIUS, LEVELS = 64, 3, 3
#: A bucket of up to this many different fingerprints is compared as it is.
BUCKET = 256
#: Hashes whose bits are counted at once.
BLOCK = 1 << 16
FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """The majority of the shingles' hashes; words are parted by ASCII white space."""
    words = (text or b"").translate(FOLD).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    last = ends[size - 1 :] - 1 if len(words) >= size else ends[-1:] - 1
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(last), BLOCK):
        spans = zip(starts[at : at + BLOCK].tolist(), last[at : at + BLOCK].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(last), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of each row (doc_id, text); the 64 bits as a signed number."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = column(batch, "text").cast(pa.large_binary()).to_pylist()
            found = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(found)], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(marked, f"doc_id {dict(docs.dtypes)['doc_id']}, fingerprint long")


def covering_masks(free: int, radius: int = RADIUS) -> list[int]:
    """Masks over the positions set in ``free``: some mask misses any ``radius`` of these."""
    places = [b for b in range(BITS) if free >> b & 1]
    codes = range(1, 1 << (radius + 1))
    masks = []
    for v in codes:
        mask = 0
        for i, b in enumerate(places):
            if (codes[i % len(codes)] & v).bit_count() % 2:
                mask |= 1 << b
        masks.append(mask)
    return masks


def mask_paths(level: int) -> list[list[int]]:
    """For each bucket family of the level before, the masks of this level, those before it included."""
    everything = (1 << BITS) - 1
    paths = [0]
    for _ in range(level - 1):
        paths = [kept | m for kept in paths for m in covering_masks(everything & ~kept)]
    return [[kept | m for m in covering_masks(everything & ~kept)] for kept in paths]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _table_rows(rows: DataFrame, level: int) -> DataFrame:
    """(path, key, fingerprint): each row (path, fingerprint) in every table of its family."""
    spark = rows.sparkSession
    families = [(i, [_signed(m) for m in masks]) for i, masks in enumerate(mask_paths(level))]
    masks = F.broadcast(spark.createDataFrame(families, "path int, masks array<long>"))  # 15 ** (level - 1) rows
    dealt = rows.join(masks, "path").select("path", "fingerprint", F.posexplode("masks").alias("table", "mask"))
    return dealt.select(
        (F.col("path") * ((1 << (RADIUS + 1)) - 1) + F.col("table")).cast("int").alias("path"),
        F.col("fingerprint").bitwiseAND(F.col("mask")).alias("key"),
        "fingerprint",
    )


def bucket_roots(sizes: np.ndarray, members: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each member the smallest one it is linked to within its bucket, through others too.

    ``members`` holds the buckets one after the other, each sorted and without repeats.
    """
    roots = members.copy()
    first = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        rows = first[sizes == size][:, None] + np.arange(size)
        step = max(1, (1 << 21) // int(size) ** 2)
        for at in range(0, len(rows), step):
            own = members[rows[at : at + step]]
            bits = own.view(np.uint64)
            like = np.bitwise_count(bits[:, :, None] ^ bits[:, None, :]) <= radius
            label = np.broadcast_to(np.arange(size), own.shape)
            while True:
                lower = np.where(like, label[:, None, :], size).min(2)
                lower = np.take_along_axis(lower, lower, 1)
                if (lower == label).all():
                    break
                label = lower
            roots[rows[at : at + step]] = np.take_along_axis(own, label, 1)
    return roots


def _bucket_links(buckets: DataFrame) -> DataFrame:
    """(a, b): members of rows (members) with their root in the bucket, where that is another."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = column(batch, "members")
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            members = lists.flatten().to_numpy(zero_copy_only=False)
            roots = bucket_roots(sizes, members)
            other = roots != members
            yield pa.RecordBatch.from_arrays([pa.array(members[other]), pa.array(roots[other])], ["a", "b"])

    return buckets.select("members").mapInArrow(linked, "a long, b long")


def fingerprint_links(found: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b) that join all of the different values of ``fingerprint`` that link, directly or through others.

    A bucket is counted before it is gathered, in the same tasks' partial
    aggregates, so none of more than ``BUCKET`` members ever is. In the last
    level no bucket can be larger.
    """
    rows = found.select(F.lit(0).alias("path"), "fingerprint").distinct()
    links = None
    for level in range(1, LEVELS + 1):
        dealt = scratch.save(_table_rows(rows, level), "dealt")
        sizes = dealt.groupBy("path", "key").agg(F.count("*").alias("size")).where(F.col("size") > 1)
        sizes = scratch.save(sizes.select(F.xxhash64("path", "key").alias("bucket"), "size"), "sizes")
        # Buckets whose 64-bit names agree have their sizes added; keys are compared again below.
        sizes = sizes.groupBy("bucket").agg(F.sum("size").alias("size"))
        placed = join_unique(dealt.withColumn("bucket", F.xxhash64("path", "key")), sizes, "bucket")
        placed = scratch.save(placed.drop("bucket"), "placed")
        small = placed if level == LEVELS else placed.where(F.col("size") <= BUCKET)
        gathered = small.groupBy("path", "key").agg(F.array_sort(F.collect_list("fingerprint")).alias("members"))
        here = scratch.save(_bucket_links(gathered.where(F.size("members") > 1)), "links")
        links = here if links is None else links.unionByName(here)
        if level == LEVELS:
            break
        rows = placed.where(F.col("size") > BUCKET).select("path", "fingerprint")
        if rows.isEmpty():
            break
    return links


def near_duplicates(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row (doc_id, text)."""
    marked = scratch.save(fingerprints(docs), "marked")
    least = scratch.save(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "least")
    roots = components(fingerprint_links(least, scratch), scratch).withColumnRenamed("node", "fingerprint")
    linked = scratch.save(least.join(roots, "fingerprint"), "linked")
    named = scratch.save(linked.groupBy("root").agg(F.min("least").alias("component_id")), "named")
    known = join_unique(linked.select("fingerprint", "root"), named, "root").select("fingerprint", "component_id")
    whole = scratch.save(
        least.join(known, "fingerprint", "left").select("fingerprint", F.coalesce("component_id", "least").alias("component_id")), "whole"
    )
    shown = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return join_unique(marked, whole, "fingerprint").select("doc_id", shown.alias("fingerprint"), "component_id")
