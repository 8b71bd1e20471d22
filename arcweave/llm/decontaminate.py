"""Benchmark decontamination: a prefix-filtered set join on word shingles.

Each benchmark item is cut into windows of ten consecutive words (a shorter item
is one window). A window is contained in a text only if all its shingles of
three words are, so a prefix of one shingle is enough for the join; the rarest
over all documents is taken. Occurrences of those shingles in the documents are
joined with the windows, bounded by position and length, and verified word by
word over a window of the item's size.

The documents are read twice, in place: once to count how often the
benchmark's shingles occur, once to find candidates. Only candidates (a few
words around each) are shuffled. The benchmark's shingles go to the tasks in
blocks of at most ``KEYS_AT_ONCE``, 8 bytes each; a larger benchmark takes
more passes.

Defined results: a null text has no words, a null item no windows; of items
that repeat an id all windows count, for that id; ties of rarity go to the
smaller hash. Texts are told apart by their content, so repeated rows get equal
results. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arcweave.llm.words import Words, column, slices, words_of
from arcweave.scratch import Scratch

WINDOW = 10
SHINGLE = 3
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
KEYS_AT_ONCE = 4_000_000
#: Windows are broadcast up to this many (of about 200 bytes).
BROADCAST_WINDOWS = 100_000


def _window_rows(items: DataFrame) -> DataFrame:
    """(item_id, n, words, keys): every window with the hashes of its shingles, in order."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = words_of(column(batch, "text"))
            size = {k: words.runs(k).view(np.int64) for k in range(1, SHINGLE + 1)}
            rows = []
            for item, a, b in zip(column(batch, "item_id").to_pylist(), words.first[:-1], words.first[1:], strict=True):
                said = [words.text(w) for w in range(a, b)]
                n = min(WINDOW, b - a)
                k = min(SHINGLE, n)
                for at in range(0, b - a - n + 1 if n else 0):
                    rows.append((item, int(n), said[at : at + n], size[k][a + at : a + at + n - k + 1].tolist()))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            types = [batch.schema.field("item_id").type, pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["item_id", "n", "words", "keys"])

    fields = f"item_id {dict(items.dtypes)['item_id']}, n int, words array<string>, keys array<long>"
    return items.select("item_id", "text").mapInArrow(windows, fields)


def _occurring(words: Words, keys: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shingle size, word positions, hashes) of the shingles among the sorted ``keys``, inside one text each."""
    text_end = np.repeat(words.first[1:], np.diff(words.first))
    for size in sizes:
        runs = words.runs(size)
        at = np.minimum(np.searchsorted(keys, runs), len(keys) - 1)
        hit = np.flatnonzero(keys[at] == runs)
        hit = hit[hit + size <= text_end[hit]]
        yield size, hit, runs[hit]


def _key_blocks(keys: DataFrame) -> Iterator[np.ndarray]:
    """The distinct keys as sorted arrays of at most KEYS_AT_ONCE, split by value."""
    blocks = max(1, -(-keys.count() // (KEYS_AT_ONCE // 2)))
    for block in range(blocks):
        part = keys.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block)
        found = np.array([r[0] for r in part.toLocalIterator()], np.int64).view(np.uint64)
        if len(found):
            yield np.sort(found)


def _counted(docs: DataFrame, keys: np.ndarray, sizes: list[int]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(keys)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for batch in slices(batches, "text"):
            for _, _, found in _occurring(words_of(column(batch, "text")), shared.value, sizes):
                total += np.bincount(np.searchsorted(shared.value, found), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(shared.value[some].view(np.int64)), pa.array(total[some])], ["key", "times"])

    return docs.select("text").mapInArrow(counts, "key long, times long").groupBy("key").agg(F.sum("times").alias("times"))


def _candidates(docs: DataFrame, keys: np.ndarray, sizes: list[int]) -> DataFrame:
    """(doc_id, text_key, n_words, found): occurrences of the keys with the words around them."""
    shared = docs.sparkSession.sparkContext.broadcast(keys)
    found_type = pa.list_(pa.struct([("key", pa.int64()), ("at", pa.int32()), ("before", pa.int32()), ("around", pa.list_(pa.string()))]))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = words_of(column(batch, "text"))
            found: list[list] = [[] for _ in range(batch.num_rows)]
            for _, at, hashes in _occurring(words, shared.value, sizes):
                texts = np.searchsorted(words.first, at, "right") - 1
                for text, word, key in zip(texts.tolist(), at.tolist(), hashes.view(np.int64).tolist(), strict=True):
                    low = max(int(words.first[text]), word - WINDOW + 1)
                    high = min(int(words.first[text + 1]), word + WINDOW)
                    around = [words.text(w) for w in range(low, high)]
                    found[text].append({"key": key, "at": word - int(words.first[text]), "before": word - low, "around": around})
            arrays = [
                column(batch, "doc_id"),
                column(batch, "text_key"),
                pa.array(np.diff(words.first).astype(np.int64)),
                pa.array(found, found_type),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_key", "n_words", "found"])

    fields = "n_words long, found array<struct<key: long, at: int, before: int, around: array<string>>>"
    return docs.mapInArrow(candidates, f"doc_id {dict(docs.dtypes)['doc_id']}, text_key binary, {fields}")


def contamination(docs: DataFrame, items: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, items) of each row (doc_id, text).

    ``n_hit`` counts the words inside any occurrence of a window; ``items`` are
    the distinct ids of the items with windows that occur.
    """
    docs = docs.select("doc_id", "text", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("text_key"))
    windows = scratch.save(_window_rows(items), "windows")
    sizes = sorted({min(SHINGLE, r["n"]) for r in windows.select("n").distinct().collect()})
    keys = windows.select(F.explode("keys").alias("key")).distinct()
    counts = None
    for block in _key_blocks(keys):
        part = _counted(docs, block, sizes)
        counts = part if counts is None else counts.unionByName(part)
    if counts is None:
        empty = scratch.save(_candidates(docs, np.zeros(1, np.uint64), []), "candidates")
        none = F.lit(0).cast("long").alias("n_hit"), F.array().cast(f"array<{dict(items.dtypes)['item_id']}>").alias("items")
        return empty.select("doc_id", "text_key", "n_words", *none)
    # A window with a shingle that no document has cannot occur.
    counts = scratch.save(counts, "counts")
    each = windows.distinct().select("item_id", "n", "words", F.size("keys").alias("m"), F.posexplode("keys").alias("offset", "key"))
    rarest = (
        each.join(counts, "key")
        .groupBy("item_id", "n", "words", "m")
        .agg(F.min(F.struct("times", "key", "offset")).alias("rarest"), F.count("*").alias("known"))
        .where(F.col("known") == F.col("m"))
        .select("item_id", "n", "words", "rarest.key", "rarest.offset")
    )
    rarest = scratch.save(rarest, "rarest")
    found = None
    for block in _key_blocks(rarest.select("key").distinct()):
        part = scratch.save(_candidates(docs, block, sizes), "candidates")
        found = part if found is None else found.unionByName(part.where(F.size("found") > 0).withColumn("n_words", F.lit(None).cast("long")))
    if found is None:
        found = scratch.save(_candidates(docs, np.zeros(1, np.uint64), []), "candidates")
    each = found.where(F.size("found") > 0).dropDuplicates(["text_key", "found"]).select("text_key", F.explode("found").alias("f")).select("text_key", "f.*")
    few = rarest.count() <= BROADCAST_WINDOWS
    start = F.col("before") - F.col("offset")
    inside = (start >= 0) & (start + F.col("n") <= F.size("around"))
    same = F.when(inside, F.slice("around", start + 1, F.col("n")) == F.col("words")).otherwise(F.lit(False))
    hits = (
        each.join(F.broadcast(rarest) if few else rarest, "key")
        .where(same)
        .select("text_key", "item_id", (F.col("at") - F.col("offset")).alias("start"), "n")
        .distinct()
    )
    merged = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end")))),
        F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n")),
        lambda so_far, hit: F.struct(
            F.greatest(so_far["upto"], hit["end"]).alias("upto"),
            (so_far["n"] + F.greatest(F.lit(0), hit["end"] - F.greatest(so_far["upto"], hit["start"]))).alias("n"),
        ),
    )["n"]
    per_text = scratch.save(
        hits.groupBy("text_key").agg(merged.alias("n_hit"), F.array_sort(F.collect_set("item_id")).alias("items")), "hits"
    )
    none = F.array().cast(f"array<{dict(items.dtypes)['item_id']}>")
    return (
        found.where(F.col("n_words").isNotNull())
        .select("doc_id", "text_key", "n_words")
        .join(per_text, "text_key", "left")
        .select("doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items"))
    )
