"""Token ids of whole texts, with a bounded memory of words already encoded.

The vocabularies used here never join characters across an ASCII space that
stands between two other characters: the byte-level one starts a piece at a
single space before a non-space, the word one drops white space. ASCII marks but
the apostrophe, between a letter or digit and white space, are a piece of their
own in both. So a text's ids are the ids of its parts, one after the other. Parts
repeat a lot; the library encodes each only when a worker does not remember it.
What is remembered lies in arrays, and so cutting, telling parts apart, looking
them up and putting ids together are array operations over a slice of texts;
Python touches only parts that are new. Texts with white space of
other shapes, or with the string of a special token, are encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts remembered, up to twice as many for a while; about 60 bytes each. A worker keeps
#: them from task to task, so that it encodes a common part once, not once a task.
REMEMBERED = 1 << 17
#: Bytes of a part that is remembered, so that the bytes of all are bounded too.
LONGEST_REMEMBERED = 64
#: What a meeting counts after one more slice.
FADES = 0.9
#: Bytes and rows of text whose parts are told apart together.
ENCODED_TOGETHER = 1 << 22
TEXTS_TOGETHER = 4096
#: Parts put in place by one call.
MOVED = 1 << 15
#: New parts encoded in one call.
TOGETHER = 512


#: Marks between a letter or digit and white space are a piece of their own.
_MARKS = re.compile(r"[!-&(-/:-@\[-`{-~](?<=[0-9A-Za-zß-öø-ÿ].)[!-&(-/:-@\[-`{-~]*(?=[ \n]|\Z)")
#: For Arrow's regular expressions; the count of ids tells if the library sees it otherwise.
_WORD = r"^ ?\pL+$"
_OTHER_BLANKS = re.compile(r"\s\s|[^\S \n]|[\0\x1c-\x1f]")


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _runs(values: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of runs of ``sizes`` values that lie one after the other, those numbered ``at``."""
    starts = np.cumsum(sizes) - sizes
    found = [values[:0]]
    for some in (at[i : i + MOVED] for i in range(0, len(at), MOVED)):
        n = sizes[some]
        moved = np.repeat(starts[some] - (np.cumsum(n) - n), n)
        moved += np.arange(len(moved))
        found.append(values.take(moved))
    return np.concatenate(found)


@lru_cache(maxsize=1)
def _library(path: str):
    """The tokenizer of a file; a worker reads it once for all its tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def encoder(path: str, keeps_space: bool) -> Encoder:
    """This worker's encoder of a vocabulary file."""
    return Encoder(path, keeps_space)


def give_back() -> None:
    """Return what Arrow holds unused to the system: a worker lives on after its task."""
    pa.default_memory_pool().release_unused()


class Encoder:
    """Ids of texts under one vocabulary file of the tokenizers library.

    ``keeps_space``: parts carry the space before them (byte-level vocabularies);
    otherwise white space is dropped before encoding.
    """

    def __init__(self, path: str, keeps_space: bool):
        self._library = _library(path)
        self._keeps_space = keeps_space
        self._between = "\0" if keeps_space else " "
        vocabulary = self._library.get_vocab(with_added_tokens=False)
        # The strings of special tokens are found before anything is cut, so texts with one are encoded whole.
        special = [token.content for token in self._library.get_added_tokens_decoder().values()]
        self._special_starts = {s[:2] for s in special}
        self._special = re.compile("|".join(map(re.escape, special)), re.IGNORECASE)
        # The last id of a piece: the line end after it, or an id that ends a word.
        self._is_last = np.zeros(max(vocabulary.values()) + 1, bool)
        if keeps_space:
            self._is_last[self._ids("\n")] = True
        else:
            self._is_last[[i for name, i in vocabulary.items() if name.endswith("</w>")]] = True
        # The parts remembered, their ids one after the other, how many each has, and how often it was met.
        self._parts = pa.array([], pa.large_string())
        self._part_ids = np.zeros(0, np.uint32)
        self._sizes = np.zeros(0, np.int64)
        self._met = np.zeros(0)

    def _marked(self, text: str) -> str | None:
        """The text with ``_between`` wherever no piece can reach across; None if it must be encoded whole."""
        if any(start in text for start in self._special_starts) and self._special.search(text):
            return None
        if not self._keeps_space:
            # Lower-casing comes first in this vocabulary; outside Latin-1 it is left to the library.
            folded = text.lower() if _is_latin(text) else text
            return _MARKS.sub(r" \g<0>", folded).replace("\n", " ")
        # " x" is a part of its own if neither side of its space is white space; so is a
        # line end. Where white space of other shapes occurs, the text is encoded whole.
        plain = "\0" not in text and " ".join(text.split()) == text.replace("\n", " ")
        if not plain and _OTHER_BLANKS.search(text):
            return None
        return _MARKS.sub("\0\\g<0>", text).replace("\n", "\0\n\0").replace(" ", "\0 ")

    def _is_plain(self, part: str) -> bool:
        """Is it one run of other characters, that can be encoded next to others?"""
        word = part[1:] if self._keeps_space and part[:1] == " " else part
        return word.split() == [word]

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self._library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _together(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some plain parts, encoded as one text of lines, and how many each has."""
        found = self._library.encode_batch_fast(["\n".join(parts)], add_special_tokens=False)[0]
        ids = np.array(found.ids, np.uint32)
        last = np.flatnonzero(self._is_last[ids])
        if self._keeps_space:
            starts, ends = np.concatenate([[0], last + 1]), np.append(last, len(ids))
        else:
            starts, ends = np.concatenate([[0], last + 1])[:-1], last + 1
        # A part of several words has several last ids: then halves are tried, at last one alone.
        if len(ends) != len(parts):
            if len(parts) == 1:
                return ids, np.array([len(ids)])
            half = len(parts) // 2
            (ids1, sizes1), (ids2, sizes2) = self._together(parts[:half]), self._together(parts[half:])
            return np.concatenate([ids1, ids2]), np.concatenate([sizes1, sizes2])
        return (np.delete(ids, last) if self._keeps_space else ids), ends - starts

    def _encoded(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each of some different parts, one after the other, and how many each has."""
        is_word = pc.match_substring_regex(parts, _WORD).to_numpy(zero_copy_only=False)
        places, found = [], []
        words = np.flatnonzero(is_word)
        texts = parts.take(pa.array(words)).to_pylist()
        for at in range(0, len(words), TOGETHER):
            places.append(words[at : at + TOGETHER])
            found.append(self._together(texts[at : at + TOGETHER]))
        plain = []
        for place in np.flatnonzero(~is_word).tolist():
            part = parts[place].as_py()
            if self._is_plain(part):
                plain.append((place, part))
            else:
                ids = self._ids(part)
                places.append(np.array([place]))
                found.append((ids, np.array([len(ids)])))
        for at in range(0, len(plain), TOGETHER):
            some, texts = zip(*plain[at : at + TOGETHER], strict=True)
            places.append(np.array(some))
            found.append(self._together(list(texts)) if self._keeps_space else self._by_offsets(list(texts)))
        if not found:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        ids, sizes = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(np.concatenate(places))
        return _runs(ids, sizes, order), sizes[order]

    def _remember(self, parts: pa.Array, ids: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> None:
        """Keep the shorter parts, or of too many those met most; what was met long ago counts less."""
        met = np.zeros(len(parts))
        met[at] = 1
        met[: len(self._met)] += self._met * FADES
        keep = np.flatnonzero(pc.binary_length(parts).to_numpy() <= LONGEST_REMEMBERED)
        if len(keep) > 2 * REMEMBERED:
            keep = np.sort(keep[np.argpartition(-met[keep], REMEMBERED)[:REMEMBERED]])
        if len(keep) < len(parts):
            parts, ids, sizes, met = parts.take(pa.array(keep)), _runs(ids, sizes, keep), sizes[keep], met[keep]
        self._parts, self._part_ids, self._sizes, self._met = parts, ids, sizes, met

    def _by_offsets(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for parts of any number of words, told apart by where their ids start."""
        found = self._library.encode("\n".join(parts), add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        starts = np.array([start for start, _ in found.offsets], np.int64)
        ends = np.cumsum([len(part) + 1 for part in parts])
        return ids, np.diff(np.searchsorted(starts, ends - 1), prepend=0)

    def encode(self, texts: Iterable[str]) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers."""
        texts = list(texts)
        if not texts:
            return []
        marked = [self._marked(text) for text in texts]
        lists = pc.split_pattern(pa.array([m or "" for m in marked], pa.large_string()), self._between)
        # The parts remembered come first, so their numbers are their places in the memory.
        n = len(self._parts)
        parts = pa.concat_arrays([self._parts, lists.flatten()]).dictionary_encode()
        at = parts.indices.to_numpy()[n:]
        new_ids, new_sizes = self._encoded(parts.dictionary[n:])
        ids, sizes = np.concatenate([self._part_ids, new_ids]), np.concatenate([self._sizes, new_sizes])
        ends = np.concatenate([[0], np.cumsum(sizes[at])])
        out = np.split(_runs(ids, sizes, at), ends[lists.offsets.to_numpy()[1:-1]])
        self._remember(parts.dictionary, ids, sizes, at)
        return [self._ids(text) if m is None else own for text, m, own in zip(texts, marked, out, strict=True)]
