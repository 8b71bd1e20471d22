"""Token ids in binary blocks: an adaptive context-mixing range coder.

A block holds the ids of whole documents and can be decoded alone: its model
starts empty, and a checksum covers its ids. The ids of a block are cut into
lanes that are coded in lockstep, one id of every lane a step, so that each step
is a handful of array operations; all lanes share one adaptive model.

Model: the last two ids predict one id (order 2) and the last id predicts one
(order 1), each with a count of how often it has been right lately; order 0 is
the distribution of the ids so far. The three are mixed by weights that are
learned, for each pair of counts, from how often either prediction was right:

    P(x) = w2 [x = a] + w1 [x = b] + w0 P0(x)

The interval of an id drives a range coder with 64-bit low and range and 32-bit
output words per lane; carries go into the words already written.

Block layout, little-endian: magic ``TKB1``, format version (1 byte), lanes (4
bytes), ids (8), vocabulary size (4), documents (4), CRC-32 of the ids (4), the
documents' lengths as LEB128, the lanes' word counts as LEB128, the lanes' words
one lane after the other.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

MAGIC, VERSION = b"TKB1", 1
HEADER = struct.Struct("<4sBIQIII")
LANES = 4096
#: Ids in a block at most, unless one document alone has more.
BLOCK_IDS = 1 << 21
TOTAL_BITS = 24
SURE_BITS = 4
SURE = (1 << SURE_BITS) - 1
CELLS = (SURE + 1) * (SURE + 1)
ORDER2_BITS = 18

_T = np.uint64(TOTAL_BITS)
_32 = np.uint64(32)
_LOW32 = np.uint64(0xFFFFFFFF)
_SMALL = np.uint64(1) << _32


def _changes() -> tuple[np.ndarray, ...]:
    """By counts and by which predictions were right: how a count changes, and whether its id gives way."""
    right2, right1 = np.arange(4 * CELLS) // CELLS & 1 > 0, np.arange(4 * CELLS) // CELLS & 2 > 0
    sure2, sure1 = np.arange(4 * CELLS) % CELLS // (SURE + 1), np.arange(4 * CELLS) % (SURE + 1)
    change = lambda sure, right: np.where(right, np.minimum(sure + 1, SURE), sure >> 1) - sure
    return change(sure2, right2), ~right2 & (sure2 == 0), change(sure1, right1), ~right1 & (sure1 == 0)


CHANGE2, GIVES_WAY2, CHANGE1, GIVES_WAY1 = _changes()


class Model:
    """The shared adaptive model; encoder and decoder call it with the same ids in the same order.

    A context's entry is its predicted id and, in the lowest bits, the count of how often that was right.
    """

    def __init__(self, vocabulary: int, lanes: int):
        self.vocabulary = vocabulary
        self.bits = max(12, (4 * vocabulary - 1).bit_length())
        if self.bits > TOTAL_BITS - 3:
            raise ValueError(f"a vocabulary of {vocabulary} ids is too large for {TOTAL_BITS} bits")
        self.order1 = np.zeros(vocabulary, np.int64)
        self.order2 = np.zeros(1 << ORDER2_BITS, np.int64)
        self.seen = np.full(CELLS, 4.0)
        self.right2 = np.full(CELLS, 1.0)
        self.right1 = np.full(CELLS, 0.5)
        self.counts = np.zeros(vocabulary, np.int64)
        self.last = np.zeros(lanes, np.int64)
        self.before = np.zeros(lanes, np.int64)
        self._pending: list[np.ndarray] = []
        self._steps = 0
        self._next_refresh = 1
        self._refresh_order0()
        self._refresh_weights()

    def _refresh_order0(self) -> None:
        if self._pending:
            self.counts += np.bincount(np.concatenate(self._pending), minlength=self.vocabulary)
            self._pending = []
        room = (1 << self.bits) - self.vocabulary
        total = int(self.counts.sum())
        share = 1 + (self.counts * room // total if total else np.full(self.vocabulary, room // self.vocabulary))
        share[int(share.argmax())] += (1 << self.bits) - int(share.sum())
        self.edges = np.concatenate([[0], np.cumsum(share)]).astype(np.int64)
        self.slots = None

    def _refresh_weights(self) -> None:
        most = (1 << TOTAL_BITS) - (1 << self.bits)
        w2 = (self.right2 / self.seen * (1 << TOTAL_BITS)).astype(np.int64)
        w1 = (self.right1 / self.seen * (1 << TOTAL_BITS)).astype(np.int64)
        over = np.maximum(w2 + w1, 1)
        scale = np.minimum(1.0, (most - 2) / over)
        self.w2 = np.maximum(1, (w2 * scale).astype(np.int64))
        self.w1 = np.maximum(1, (w1 * scale).astype(np.int64))

    def _predict(self) -> tuple[np.ndarray, ...]:
        """Interval weights of each lane's predictions a and b, and of all else."""
        self.slot = ((self.before * 0x2545F491 + self.last * 0x9E3779B1) >> 7) & ((1 << ORDER2_BITS) - 1)
        self.entry2, self.entry1 = self.order2.take(self.slot), self.order1.take(self.last)
        self.a, self.b = self.entry2 >> SURE_BITS, self.entry1 >> SURE_BITS
        self.cell = (self.entry2 & SURE) << SURE_BITS | self.entry1 & SURE
        w2, w1 = self.w2.take(self.cell), self.w1.take(self.cell)
        return w2, w1, (1 << TOTAL_BITS) - w2 - w1

    def _intervals(self, ids: np.ndarray, w2: np.ndarray, w1: np.ndarray, w0: np.ndarray, in2: np.ndarray, in1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the ids' intervals; those told by a prediction (``in2``, ``in1``) have its interval."""
        low = (self.edges.take(ids) * w0) >> self.bits
        size = ((self.edges.take(ids + 1) * w0) >> self.bits) - low
        start = low + w2 + w1
        start[in1], size[in1] = w2[in1], w1[in1]
        start[in2], size[in2] = 0, w2[in2]
        return start.view(np.uint64), size.view(np.uint64)

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weights = self._predict()
        return self._intervals(ids, *weights, np.flatnonzero(ids == self.a), np.flatnonzero(ids == self.b))

    def find(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids whose intervals hold ``code``, and the intervals."""
        w2, w1, w0 = self._predict()
        rest = code - w2 - w1
        if self.slots is None:
            self.slots = np.repeat(np.arange(self.vocabulary), np.diff(self.edges))
        # Both are positive, and unsigned division is the faster one.
        at = (((np.maximum(rest, 0) + 1 << self.bits) - 1).view(np.uint64) // w0.view(np.uint64)).view(np.int64)
        ids = self.slots.take(np.minimum(at, (1 << self.bits) - 1))
        in2, in1 = np.flatnonzero(code < w2), np.flatnonzero((code >= w2) & (rest < 0))
        start, size = self._intervals(ids, w2, w1, w0, in2, in1)
        ids[in1], ids[in2] = self.b[in1], self.a[in2]
        return ids, start, size

    def update(self, ids: np.ndarray) -> None:
        """Learn one step's ids; must follow interval() or find()."""
        case = self.cell + CELLS * (ids == self.a) + 2 * CELLS * (ids == self.b)
        wrong, only2, only1, both = np.bincount(case, minlength=4 * CELLS).reshape(4, CELLS)
        self.seen += wrong + only2 + only1 + both
        self.right2 += only2 + both
        self.right1 += only1
        # A prediction that was right grows surer; a wrong one loses half, and gives way at none.
        fresh = ids << SURE_BITS
        self.order2[self.slot] = np.where(GIVES_WAY2.take(case), fresh, self.entry2 + CHANGE2.take(case))
        self.order1[self.last] = np.where(GIVES_WAY1.take(case), fresh, self.entry1 + CHANGE1.take(case))
        self._pending.append(ids)
        self.before, self.last = self.last, ids
        self._steps += 1
        if self._steps >= self._next_refresh:
            self._refresh_order0()
            self._next_refresh = self._steps + min(32, max(1, self._steps))
        self._refresh_weights()

    def narrow(self, lanes: int) -> None:
        """Go on with the first ``lanes`` lanes only."""
        self.last, self.before = self.last[:lanes], self.before[:lanes]


def _lanes_of(n: int) -> int:
    return max(1, min(LANES, n // 256))


def _by_lane(ids: np.ndarray, table: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The ids of all lanes beside their places in a table with a row for each step.

    The first lanes have one id more than the others, where the ids do not fill all
    steps. Few lanes at a time, since lines of a cache that hold a column are few.
    """
    lanes = table.shape[1]
    steps, more = divmod(len(ids), lanes)
    cut = more * (steps + 1)
    longer, others = ids[:cut].reshape(more, steps + 1), ids[cut:].reshape(lanes - more, steps)
    for own, places in ((longer, table[:, :more]), (others, table[:steps, more:])):
        for at in range(0, len(own), 32):
            yield own[at : at + 32].T, places[:, at : at + 32]


def _leb128(values: np.ndarray) -> bytes:
    out = bytearray()
    for v in values.tolist():
        while v >= 0x80:
            out.append(v & 0x7F | 0x80)
            v >>= 7
        out.append(v)
    return bytes(out)


def _read_leb128(data: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    out = np.zeros(n, np.int64)
    for i in range(n):
        v = shift = 0
        while True:
            byte = data[at]
            at += 1
            v |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                break
        out[i] = v
    return out, at


def encode_block(documents: list[np.ndarray], vocabulary: int) -> bytes:
    """One block of the documents' ids, all below ``vocabulary``."""
    ids = np.concatenate([np.zeros(0, np.uint32), *documents]).astype("<u4")
    if len(ids) and int(ids.max()) >= vocabulary:
        raise ValueError(f"id {int(ids.max())} is not in a vocabulary of {vocabulary}")
    lengths = np.array([len(d) for d in documents], np.int64)
    lanes = _lanes_of(len(ids))
    steps, more = divmod(len(ids), lanes)
    lane_words, words = np.zeros(lanes, np.int64), np.zeros((0, lanes), np.uint32)
    if len(ids):
        table = np.zeros((steps + 1, lanes), np.uint32)
        for part, of_lanes in _by_lane(ids, table):
            of_lanes[:] = part
        words = np.zeros((steps + 4, lanes), np.uint32)
        low = np.zeros(lanes, np.uint64)
        width = np.full(lanes, np.uint64(2**64 - 1))
        model = Model(vocabulary, lanes)
        for step in range(steps + bool(more)):
            live = lanes if step < steps else more
            if live < lanes:
                model.narrow(live)
            now = table[step, :live].astype(np.int64)
            start, size = model.interval(now)
            unit = width[:live] >> _T
            moved = low[:live] + start * unit
            _carry(words, lane_words, np.flatnonzero(moved < low[:live]))
            low[:live] = moved
            width[:live] = unit * size
            due = np.flatnonzero(width[:live] < _SMALL)
            words[lane_words[due], due] = low[due] >> _32
            lane_words[due] += 1
            low[due] <<= _32
            width[due] <<= _32
            model.update(now)
        for _ in range(2):
            words[lane_words, np.arange(lanes)] = low >> _32
            lane_words += 1
            low <<= _32
    head = HEADER.pack(
        MAGIC, VERSION, lanes, len(ids), vocabulary, len(documents), zlib.crc32(ids)
    )
    body = words.T[np.arange(len(words))[None, :] < lane_words[:, None]].astype("<u4").tobytes()
    return head + _leb128(lengths) + _leb128(lane_words) + body


def _carry(words: np.ndarray, lane_words: np.ndarray, lanes: np.ndarray) -> None:
    at = lane_words[lanes] - 1
    while len(lanes):
        words[at, lanes] += np.uint32(1)
        over = words[at, lanes] == 0
        lanes, at = lanes[over], at[over] - 1


def decode_block(data: bytes) -> list[np.ndarray]:
    """The documents' ids of one block; raises if it is damaged."""
    magic, version, lanes, n, vocabulary, documents, check = HEADER.unpack_from(data)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a token block of this version")
    lengths, at = _read_leb128(data, HEADER.size, documents)
    lane_words, at = _read_leb128(data, at, lanes)
    stored = np.frombuffer(data, "<u4", offset=at).astype(np.uint64)
    if len(stored) != lane_words.sum() or lengths.sum() != n:
        raise ValueError("a token block is cut short")
    ids = np.zeros(n, "<u4")
    if n:
        steps, more = divmod(n, lanes)
        table = np.zeros((steps + 1, lanes), np.uint32)
        stored = np.concatenate([stored, np.zeros(2, np.uint64)])
        place = np.cumsum(lane_words) - lane_words
        value = (stored[place] << _32) | stored[place + 1]
        place = place + 2
        width = np.full(lanes, np.uint64(2**64 - 1))
        model = Model(vocabulary, lanes)
        for step in range(steps + bool(more)):
            live = lanes if step < steps else more
            if live < lanes:
                model.narrow(live)
            unit = width[:live] >> _T
            code = np.minimum(value[:live] // unit, np.uint64((1 << TOTAL_BITS) - 1)).astype(np.int64)
            now, start, size = model.find(code)
            value[:live] -= start * unit
            width[:live] = unit * size
            due = np.flatnonzero(width[:live] < _SMALL)
            value[due] = (value[due] << _32) | stored[np.minimum(place[due], len(stored) - 1)]
            place[due] += 1
            width[due] <<= _32
            table[step, :live] = now
            model.update(now)
        for part, of_lanes in _by_lane(ids, table):
            part[:] = of_lanes
    if zlib.crc32(ids) != check:
        raise ValueError("a token block does not have its checksum")
    ends = np.cumsum(lengths)
    return np.split(ids, ends[:-1]) if documents else []
