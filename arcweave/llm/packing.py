"""Best-fit packing of documents into sequences, by bin completion.

Texts are encoded in place; only lengths move. What the search sees is how many
pieces there are of each length, at most ``capacity`` numbers for any number of
documents. It yields fillings (lists of lengths) with the number of sequences
that use each; pieces take their places by their rank among the pieces of their
length, counted per task and summed over tasks, so no length and no task is
ever gathered or sorted as a whole.

Search: branch and bound by bin completion. Around the largest length left,
fillings that no other filling dominates are enumerated, fullest first, and
applied to as many sequences as their rarest length allows; of them one for each
room left, ``TRIED`` steps and ``CHILDREN`` in all, so the search is not exact. A
branch is cut when the sequences used plus the tokens left over capacity reach
the incumbent. The first incumbent is
best-fit decreasing; the search stops when an incumbent meets the lower bound of the
whole or after ``NODES`` nodes, and then keeps the best so far.

Defined results: a null text is an empty one and has one piece, its end id; only
documents longer than the capacity are cut, the first piece being the shorter
one; repeated rows are packed each. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arcweave.llm.tokens import ENCODED_TOGETHER, TEXTS_TOGETHER, encoder, give_back
from arcweave.llm.words import column, slices
from arcweave.scratch import Scratch

CAPACITY = 2048
VOCABULARY = "byte_bpe_50k.json"
NODES = 20_000
CHILDREN = 4
#: Fillings looked at around one length, at most.
TRIED = 400
#: Rows of the table of places that are broadcast; it has at most one row for each length and filling.
BROADCAST_PLACES = 200_000

Filling = tuple[int, ...]


def pieces(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of rows (doc_id, text); no shuffle."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    fields = f"doc_id {dict(docs.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, keeps_space=True).encode
        for batch in slices(batches, "text", most_rows=TEXTS_TOGETHER, most_bytes=ENCODED_TOGETHER):
            rows, whose = [], []
            for i, ids in enumerate(encode(t or "" for t in column(batch, "text").to_pylist())):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    rows.append((piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
                    whose.append(i)
            arrays = [column(batch, "doc_id").take(pa.array(whose))]
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays += [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32"])
        give_back()

    return docs.select("doc_id", "text").mapInArrow(cut, fields)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    tokens = sum(length * n for length, n in counts.items())
    return max(-(-tokens // capacity), sum(n for length, n in counts.items() if 2 * length > capacity))


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Fillings by putting each length, largest first, where the least room is left; equal bins go together."""
    bins: dict[int, list[tuple[Filling, int]]] = {}
    rooms: list[int] = []

    def put(filling: Filling, n: int) -> None:
        room = capacity - sum(filling)
        if room not in bins:
            insort(rooms, room)
        bins.setdefault(room, []).append((filling, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_right(rooms, length - 1)
            if at == len(rooms):
                each = capacity // length
                if left >= each:
                    put((length,) * each, left // each)
                if left % each:
                    put((length,) * (left % each), 1)
                break
            room = rooms[at]
            filling, n = bins[room].pop()
            if not bins[room]:
                del bins[room]
                rooms.pop(at)
            fit = room // length
            if left >= fit:
                uses, more = min(n, left // fit), fit
            else:
                uses, more = 1, left
            if n > uses:
                put(filling, n - uses)
            put(filling + (length,) * more, uses)
            left -= uses * more
    return [found for room in rooms for found in bins[room]]


def completions(counts: dict[int, int], lengths: list[int], largest: int, capacity: int) -> list[Filling]:
    """Undominated fillings around ``largest``, fullest first, then those with fewer pieces.

    ``lengths`` are the lengths left, ascending. A filling that leaves room for
    one more piece is dominated by the filling with it; one of several pieces
    where a single length of the same sum or closer to the room is left, by that.
    """
    room = capacity - largest
    found: dict[int, Filling] = {}
    tried = 0

    def longest(limit: int, own: Filling) -> Iterator[int]:
        at = bisect_right(lengths, limit)
        while at:
            at -= 1
            length = lengths[at]
            if counts[length] > own.count(length) + (length == largest):
                yield length

    def extend(own: Filling, left: int, most: int) -> None:
        nonlocal tried
        tried += 1
        fits = longest(min(left, most), own)
        first = next(fits, None)
        if first is None:
            if left not in found or len(own) < len(found[left]):
                # Maximal only if nothing at all fits, not just nothing below ``most``.
                if next(longest(left, own), None) is None:
                    found[left] = own
            return
        while first is not None and tried < TRIED and 0 not in found:
            extend((*own, first), left - first, first)
            first = next(fits, None)

    extend((), room, room)
    if not found:
        own: Filling = ()
        left = room
        while (fit := next(longest(left, own), None)) is not None:
            own, left = (*own, fit), left - fit
        found[left] = own
    return [(largest, *found[left]) for left in sorted(found)]


def complete_bins(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[tuple[Filling, int]]:
    """Fillings and how many sequences use each, for ``counts`` pieces of each length."""
    counts = {length: n for length, n in counts.items() if n}
    best = best_fit_decreasing(counts, capacity)
    fewest = sum(n for _, n in best)
    least = lower_bound(counts, capacity)
    left = dict(counts)
    lengths = sorted(left)
    tokens = sum(length * n for length, n in left.items())
    chosen: list[tuple[Filling, int]] = []
    used = 0
    budget = nodes

    def use(filling: Filling, times: int) -> None:
        nonlocal tokens, used
        for length in filling:
            left[length] -= times
        for length in set(filling):
            if not left[length]:
                lengths.remove(length)
        tokens -= times * sum(filling)
        used += times
        chosen.append((filling, times))

    def undo() -> None:
        nonlocal tokens, used
        filling, times = chosen.pop()
        for length in set(filling):
            if not left[length]:
                insort(lengths, length)
        for length in filling:
            left[length] += times
        tokens += times * sum(filling)
        used -= times

    stack: list[Iterator[Filling] | None] = []

    def branches() -> Iterator[Filling]:
        return iter(completions(left, lengths, lengths[-1], capacity)[:CHILDREN])

    if not lengths:
        return []
    stack.append(branches())
    while stack and budget and fewest > least:
        filling = next(stack[-1], None)
        if filling is None:
            stack.pop()
            if stack:
                undo()
            continue
        budget -= 1
        times = min(left[length] // filling.count(length) for length in set(filling))
        use(filling, times)
        if used + -(-tokens // capacity) >= fewest:
            undo()
        elif not lengths:
            best, fewest = list(chosen), used
            undo()
        else:
            stack.append(branches())
    return best


def pack(pieces: DataFrame, scratch: Scratch, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to rows with ``length`` (1 to ``capacity``).

    ``pieces`` must be a written table: it is read twice and must not change.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places: list[tuple[int, int, int, int, int, int]] = []  # length, first rank, end rank, first sequence, pieces of the length in it, offset
    taken = dict.fromkeys(counts, 0)
    sequence = 0
    for filling, times in complete_bins(counts, capacity):
        offset = 0
        for length in sorted(set(filling), reverse=True):
            each = filling.count(length)
            places.append((length, taken[length], taken[length] + times * each, sequence, each, offset))
            taken[length] += times * each
            offset += each * length
        sequence += times
    session = pieces.sparkSession
    spots = session.createDataFrame(places, "length long, low long, high long, first long, each long, at long")
    ranked = _ranked(pieces, scratch)
    few = len(places) <= BROADCAST_PLACES
    inside = (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    nth = F.col("rank") - F.col("low")
    return (
        ranked.join(F.broadcast(spots) if few else spots, (ranked["length"] == spots["length"]) & inside)
        .select(
            *(ranked[name] for name in pieces.columns),
            (F.col("first") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
            (F.col("at") + F.pmod(nth, F.col("each")) * ranked["length"]).cast("long").alias("offset"),
        )
    )


def _ranked(pieces: DataFrame, scratch: Scratch) -> DataFrame:
    """Number the rows of each length from 0: by chunk, then inside the chunk."""
    order = Window.partitionBy("length", "_chunk").orderBy("_row")
    chunked = scratch.save(
        pieces.withColumn("_row", F.monotonically_increasing_id()).withColumn("_chunk", F.shiftright("_row", 16)), "chunked"
    )
    sizes = chunked.groupBy("length", "_chunk").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = sizes.select("length", "_chunk", before.alias("_base"))
    numbered = chunked.withColumn("_in", F.row_number().over(order) - 1)
    return numbered.join(bases, ["length", "_chunk"]).withColumn("rank", F.col("_base") + F.col("_in")).drop("_row", "_chunk", "_base", "_in")
