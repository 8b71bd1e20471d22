"""Groups of spelling variants by an index of variable-length grams.

1. Words are counted over all texts: tasks find the runs of letters of a slice of
   texts as arrays and send each distinct one once.
2. The gram dictionary. All substrings of ``SHORTEST`` to ``LONGEST`` code points
   are counted over the words. One in more than ``FREQUENT`` places is too common
   to be a list by itself and is extended, so only those are kept (there are
   fewer than substrings / FREQUENT): the gram of a word at a position is the
   shortest one from there on that is not frequent, or the longest there is.
3. Affected grams. A gram depends on its own characters, and one that ran into
   the word's end on where it ends. For each place where a word can be edited
   (each of its characters, each gap) the grams that place can affect are struck
   out; the others stand in the edited word too, at the same distance from its
   start (before the edit) or its end (after it). Both words of a pair strike out
   the same grams, so they are left with the same ones.
4. List merging. Of what an edit leaves, the first gram that is not frequent, with
   its place, names the list in which the two words must meet; such a list has at
   most FREQUENT members. Where only frequent grams are left, the word stands in the
   merge of the lists of all shortest grams that the edit leaves. So a word stands
   in at most one list for each place of an edit, and no pair with one edit is lost.
5. Words that share a list and differ in length by at most one are verified by
   their edit distance.

Defined results: a null text has no words; a null doc_id is an empty string in the
digest; repeated rows count again; extra columns are ignored; an empty table, or one
without words, gives no rows. Work and memory grow in proportion to a word's length. Of near words of equal count the first in code-point
order is the form. A form has at least twice its word's count, so chains of forms end.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arcweave.llm.words import column, slices
from arcweave.scratch import Scratch

SHORTEST, LONGEST, FREQUENT = 2, 6, 64
LEAST_LENGTH, LEAST_COUNT = 5, 3
MODULUS = 97
FORM_RATIO = 2
#: Text taken at once by a task that counts words.
SLICE = 4 << 20
#: Up to this many frequent grams (of some 40 bytes) are broadcast.
BROADCAST_GRAMS = 500_000


def _crc_table() -> np.ndarray:
    row = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        row = np.where(row & 1, (row >> np.uint32(1)) ^ np.uint32(0xEDB88320), row >> np.uint32(1))
    return row


_CRC = _crc_table()
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)


def _runs(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the maximal runs of A-Z, a-z and U+00C0 to U+00FF within each text.

    Of UTF-8, the latter are the byte C3 and one more, which no other character uses.
    """
    letter = (raw >= 0x61) & (raw <= 0x7A)
    lead = raw == 0xC3
    letter |= lead
    letter[1:] |= lead[:-1]
    before = np.zeros(len(raw) + 1, bool)
    before[1:] = letter
    before[bounds] = False
    after = np.zeros(len(raw) + 1, bool)
    after[:-1] = letter
    after[bounds] = False
    return np.flatnonzero(letter & ~before[:-1]), np.flatnonzero(letter & ~after[1:]) + 1


def _digests(raw: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray) -> np.ndarray:
    """crc32 of each span, going on from ``state``, byte by byte over all spans at once."""
    state = state ^ np.uint32(0xFFFFFFFF)
    size = end - start
    active = np.arange(len(start))
    for k in range(int(size.max(initial=0))):
        active = active[size[active] > k]
        own = state[active]
        state[active] = _CRC[(own ^ raw[start[active] + k]) & np.uint32(0xFF)] ^ (own >> np.uint32(8))
    return state ^ np.uint32(0xFFFFFFFF)


def _slice_words(ids: list, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The distinct words of some texts and their counts."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    bounds = offsets - offsets[0]
    raw = _LOWER[raw]
    start, end = _runs(raw, bounds)
    more = np.concatenate([[0], np.cumsum(raw == 0xC3)])
    length = end - start - (more[end] - more[start])
    long_ = length >= LEAST_LENGTH
    start, end, length = start[long_], end[long_], length[long_]
    own = np.searchsorted(bounds, start, "right") - 1
    seeds = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids] or [0], np.uint32)
    digest = _digests(raw, start, end, seeds[own] if len(own) else np.zeros(0, np.uint32))
    struck = digest % MODULUS == 0
    kept = np.flatnonzero(~struck)
    size = (end - start)[kept]
    ends = np.cumsum(size)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[kept] - (ends - size), size)
    words = pa.StringArray.from_buffers(
        len(kept), pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(raw[at].tobytes())
    )
    shortened = []
    for i in np.flatnonzero(struck & (length > LEAST_LENGTH)):
        word = raw[start[i] : end[i]].tobytes().decode()
        place = int(digest[i]) % len(word)
        shortened.append(word[:place] + word[place + 1 :])
    found = pc.value_counts(pa.concat_arrays([words, pa.array(shortened, pa.string())]))
    return found.field("values"), found.field("counts")


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n, key) of the words of all texts with enough code points and occurrences."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", most_rows=1 << 14, most_bytes=SLICE):
            words, n = _slice_words(column(batch, "doc_id").to_pylist(), column(batch, "text"))
            yield pa.RecordBatch.from_arrays([words, n], ["word", "n"])

    parts = docs.select("doc_id", "text").mapInArrow(counted, "word string, n long")
    whole = parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)
    return whole.select("word", "n", F.unhex(F.md5(F.col("word").cast("binary"))).alias("key"))


def _substrings(words: DataFrame) -> DataFrame:
    """(key, at, gram) of each substring of SHORTEST to LONGEST code points; ``at`` holds place and size."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ats, grams = [], [], []

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(keys, pa.binary()), pa.array(ats, pa.int64()), pa.array(grams, pa.string())]
            for full in (keys, ats, grams):
                full.clear()
            return pa.RecordBatch.from_arrays(arrays, ["key", "at", "gram"])

        for batch in batches:
            for key, word in zip(column(batch, "key").to_pylist(), column(batch, "word").to_pylist(), strict=True):
                for size in range(SHORTEST, LONGEST + 1):
                    for low in range(0, len(word) - size + 1, 1 << 16):
                        places = range(low, min(low + (1 << 16), len(word) - size + 1))
                        keys.extend([key] * len(places))
                        ats.extend([_at(place, size) for place in places])
                        grams.extend([word[place : place + size] for place in places])
                        if len(grams) > 1 << 16:
                            yield flush()
        yield flush()

    return words.select("key", "word").mapInArrow(cut, "key binary, at long, gram string")


def _at(place: int, size: int) -> int:
    return place * (LONGEST + 1) + size


def frequent_grams(words: DataFrame, most: int = FREQUENT) -> DataFrame:
    """The grams in more than ``most`` places."""
    return _substrings(words).groupBy("gram").agg(F.count("*").alias("times")).where(F.col("times") > most).select("gram")


def decompose(word: str, frequent: set[int]) -> list[tuple[int, int, bool]]:
    """(start, end, rare) of the gram at each place; ``frequent`` has the word's frequent grams by place and size."""
    grams = []
    for place in range(len(word) - SHORTEST + 1):
        size = SHORTEST
        while _at(place, size) in frequent and size < LONGEST and place + size < len(word):
            size += 1
        grams.append((place, place + size, _at(place, size) not in frequent))
    return grams


def list_names(word: str, frequent: set[int]) -> set[int]:
    """The lists in which a word stands: one for each set of grams that an edit leaves."""
    length = len(word)
    # The first of the rare grams that end by each place, and of those that start from it on.
    before: list = [None] * (length + 1)
    after: list = [None] * (length + 2)
    for start, end, rare in decompose(word, frequent):
        if rare:
            before[end] = _first(before[end], (word[start:end], "s", start))
            after[start] = (word[start:end], "e", length - start)
    for i in range(length):
        before[i + 1] = _first(before[i], before[i + 1])
        after[length - 1 - i] = _first(after[length - i], after[length - 1 - i])
    # All shortest grams that end by a place are the text up to it, those that start from it on the text after it.
    heads, tails = [_digest("")], [_digest("")]
    head, tail = xxhash.xxh64(), xxhash.xxh64()
    for i in range(length):
        head.update(word[i].encode())
        tail.update(word[length - 1 - i].encode())
        heads.append(head.intdigest() if i + 1 >= SHORTEST else heads[0])
        tails.append(tail.intdigest() if i + 1 >= SHORTEST else tails[0])
    names = set()
    for place in range(length + 1):
        for gap in (place, place + 1) if place < length else (place,):
            rare = _first(before[place], after[gap])
            names.add(_digest(rare or (heads[place], tails[length - gap])))
    return names


def _first(a, b):
    return b if a is None or b is not None and b < a else a


def _digest(name) -> int:
    return xxhash.xxh64_intdigest(repr(name))


def word_lists(words: DataFrame, frequent: DataFrame, few: bool) -> DataFrame:
    """(list, word, n, length) of each word in its lists."""
    hits = _substrings(words).join(F.broadcast(frequent) if few else frequent, "gram").select("key", "at")
    rows = words.select("key", "word", "n", F.lit(None).cast("long").alias("at")).unionByName(hits, allowMissingColumns=True)
    known = rows.groupBy("key").agg(F.max("word").alias("word"), F.max("n").alias("n"), F.collect_list("at").alias("hits"))

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                lists, rows = [], []
                for i, (word, hits) in enumerate(zip(column(part, "word").to_pylist(), column(part, "hits").to_pylist(), strict=True)):
                    names = list_names(word, set(hits))
                    lists += names
                    rows += [i] * len(names)
                own = [column(part, c).take(pa.array(rows, pa.int64())) for c in ("word", "n")]
                yield pa.RecordBatch.from_arrays([pa.array(np.array(lists, np.uint64).view(np.int64)), *own], ["list", "word", "n"])

    named = known.select("word", "n", "hits").mapInArrow(filed, "list long, word string, n long")
    return named.select("list", "word", "n", F.char_length("word").alias("length"))


def near_words(lists: DataFrame) -> DataFrame:
    """(word, n, near, near_n), both ways, of the pairs with one edit between them."""
    other = lists.select(*(F.col(c).alias(f"near_{c}") for c in lists.columns))
    pairs = lists.join(
        other,
        (F.col("list") == F.col("near_list"))
        & (F.col("word") < F.col("near_word"))
        & (F.abs(F.col("length") - F.col("near_length")) <= 1)
        & (F.levenshtein("word", "near_word", 1) == 1),
    )
    one_way = pairs.select("word", "n", F.col("near_word").alias("near"), "near_n").distinct()
    both = F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )
    return one_way.select(F.inline(both))


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of rows (word, form), following forms to words that have none."""
    reach = forms.select("word", F.col("form").alias("root"))
    while True:
        jump = reach.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = reach.join(jump, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        jumped = scratch.save(jumped, "roots")
        reach = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            return reach


def spelling_variants(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of the texts."""
    words = scratch.save(count_words(docs), "words")
    frequent = scratch.save(frequent_grams(words), "frequent")
    few = frequent.count() <= BROADCAST_GRAMS
    lists = scratch.save(word_lists(words, frequent, few), "lists")
    near = scratch.save(near_words(lists), "near")
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best")
    )
    joined = words.drop("key").join(best, "word", "left")
    enough = -F.col("best.minus") >= FORM_RATIO * F.col("n")
    known = scratch.save(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.minus")).alias("form_n"),
        ),
        "known",
    )
    roots = _roots(known.where(F.col("form").isNotNull()).select("word", "form"), scratch)
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
