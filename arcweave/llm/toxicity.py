"""Toxicity: a linear classifier, regularised by counterfactual identity terms.

Features are the words of a text and their first five and six bytes, present or
not, as 64-bit hashes. The classifier is fitted on a bounded sample of the
labelled rows (``MOST_LABELLED``, by a hash of the id): features that occur in
one class much more often than in the other are kept, and a logistic regression
is fitted on them. Sentences of labelled texts that name an identity are taken
twice, once with the terms swapped for others of their kind. As such sentences
may be few or none, each labelled text also gives one of its own: some of its
words as they stand, and the same with a term put between them. The difference
of both logits is penalised, so that a neutral mention of a group does not move
the score; ``mention_shift`` measures by how much it still does. Everything else covers all rows: texts are scored whole, in place, with
the fitted weights as the only shared data.

Defined results: a null or empty text scores as the bias alone; without labelled
rows of both classes every text scores the share of toxic ones (0 without any); labels other
than 0 and 1 are ignored; rows repeated count each. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arcweave.llm.words import Words, column, slices, words_of
from arcweave.scratch import Scratch

#: Labelled rows in the sample at most; the only bound of the operator.
MOST_LABELLED = 8_000
PREFIXES = (5, 6)
#: Log-likelihood ratio of a kept feature; about one chance find in a million features.
LEAST_EVIDENCE = 24.0
RIDGE = 1e-3
COUNTERFACTUAL = 1.0
STEPS = 400
BIAS = 0
FILTER_BITS = 22

#: Terms of one kind are swapped for each other.
IDENTITIES = (
    ("women", "men", "girls", "boys", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
    ("woman", "man", "girl", "boy", "frau", "mann", "femme", "homme", "mujer", "hombre"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "roma"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("immigrants", "refugees", "foreigners", "locals", "migrants"),
    ("deaf", "blind", "disabled", "elderly", "young", "old"),
)
TERMS = tuple(term for kind in IDENTITIES for term in kind)
#: Words of a text on either side of a term put into it.
SLOT_WORDS = 5
_SWAP = {term: kind[(i + 1) % len(kind)] for kind in IDENTITIES for i, term in enumerate(kind)}
_TERM = re.compile(r"(?i)\b(" + "|".join(sorted(_SWAP, key=len, reverse=True)) + r")\b")


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and prefixes, and the text of each."""
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    kinds = [words.hashes] + [words.prefixes(n) + np.uint64(n) for n in PREFIXES]
    return np.concatenate(kinds), np.tile(text, len(kinds))


def _sets(texts: pa.Array) -> list[np.ndarray]:
    words = words_of(texts)
    found, text = features(words)
    order = np.argsort(text, kind="stable")
    found, cuts = found[order], np.searchsorted(text[order], np.arange(1, len(texts)))
    return [np.unique(x) for x in np.split(found, cuts)]


def swapped(sentence: str) -> str | None:
    """The sentence with every identity term replaced, or None if it names none."""
    return _TERM.sub(lambda m: _SWAP[m[0].lower()], sentence) if _TERM.search(sentence) else None


def slotted(text: str) -> tuple[str, str] | None:
    """Some words of a text with an identity term between them, and without; None if it has no words."""
    words = text.split()
    if not words:
        return None
    number = zlib.crc32(text.encode())
    place = number // len(TERMS) % (len(words) + 1)
    before, after = words[max(place - SLOT_WORDS, 0) : place], words[place : place + SLOT_WORDS]
    return " ".join([*before, TERMS[number % len(TERMS)], *after]), " ".join(before + after)


def _pairs(text: str) -> list[tuple[str, str]]:
    """Counterfactual sentences of one labelled text."""
    named = [(s, t) for s in re.split(r"[.!?\n]", text) if (t := swapped(s)) is not None]
    own = slotted(text)
    return named if own is None else [*named, own]


def _rows(labelled: DataFrame) -> DataFrame:
    """(toxic, own, other): features of each labelled text, and of its counterfactual sentences in both forms.

    ``toxic`` is null for sentences; ``other`` is null for texts.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = pa.list_(pa.int64())
        for batch in slices(batches, "text"):
            texts = column(batch, "text")
            own: list = [s.view(np.int64) for s in _sets(texts)]
            labels: list = column(batch, "toxic").to_pylist()
            other: list = [None] * len(own)
            pairs = [pair for text in texts.to_pylist() for pair in _pairs(text or "")]
            if pairs:
                own += [s.view(np.int64) for s in _sets(pa.array([s for s, _ in pairs]))]
                other += [s.view(np.int64) for s in _sets(pa.array([t for _, t in pairs]))]
                labels += [None] * len(pairs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels, pa.int32()), pa.array(own, lists), pa.array(other, lists)], ["toxic", "own", "other"]
            )

    return labelled.mapInArrow(rows, "toxic int, own array<long>, other array<long>")


def _evidence(toxic: np.ndarray, clean: np.ndarray, bad: int, good: int) -> np.ndarray:
    """Twice the log-likelihood ratio of a feature's rows in both classes against their shares."""

    def term(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0.0)

    share = (toxic + clean) / (bad + good)
    parts = ((toxic, bad * share), (clean, good * share), (bad - toxic, bad * (1 - share)), (good - clean, good * (1 - share)))
    return 2 * sum(term(seen, expected) for seen, expected in parts)


def fit_weights(labels: np.ndarray, sets: list[np.ndarray], pairs: list[tuple[np.ndarray, np.ndarray]]) -> dict[int, float]:
    """Weights by feature; the bias is that of ``BIAS``."""
    n, bad = len(labels), int(labels.sum())
    if not n or not bad or bad == n:
        share = bad / n if n else 0.0
        return {BIAS: 30.0 if share == 1 else -30.0}
    joined = np.concatenate(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    keys, place = np.unique(joined, return_inverse=True)
    toxic = np.bincount(place, labels[row], len(keys))
    clean = np.bincount(place, minlength=len(keys)) - toxic
    chosen = np.flatnonzero(_evidence(toxic, clean, bad, n - bad) >= LEAST_EVIDENCE)
    index = np.full(len(keys), -1)
    index[chosen] = np.arange(len(chosen))
    place = index[place]
    row, place = row[place >= 0], place[place >= 0]
    keys = keys[chosen]

    def difference(own, other):
        a, b = np.searchsorted(keys, own), np.searchsorted(keys, other)
        a, b = (np.minimum(x, max(len(keys) - 1, 0)) for x in (a, b))
        a, b = a[keys[a] == own] if len(keys) else a[:0], b[keys[b] == other] if len(keys) else b[:0]
        return np.concatenate([a, b]), np.concatenate([np.ones(len(a)), -np.ones(len(b))])

    swaps = [difference(*pair) for pair in pairs]
    swap_place = np.concatenate([p for p, _ in swaps]) if swaps else np.zeros(0, np.int64)
    swap_sign = np.concatenate([s for _, s in swaps]) if swaps else np.zeros(0)
    swap_row = np.repeat(np.arange(len(swaps)), [len(p) for p, _ in swaps])
    weight, bias = np.zeros(len(keys)), float(np.log(bad / (n - bad)))
    moment, bias_moment = np.zeros(len(keys)), 0.0
    second, bias_second = np.zeros(len(keys)), 0.0
    for step in range(1, STEPS + 1):
        logit = bias + np.bincount(row, weight[place], n)
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels) / n
        slope = np.bincount(place, error[row], len(keys)) + RIDGE * weight / n
        if swaps:
            moved = np.bincount(swap_row, swap_sign * weight[swap_place], len(swaps))
            slope += COUNTERFACTUAL * 2 / len(swaps) * np.bincount(swap_place, swap_sign * moved[swap_row], len(keys))
        moment, bias_moment = 0.9 * moment + 0.1 * slope, 0.9 * bias_moment + 0.1 * error.sum()
        second, bias_second = 0.99 * second + 0.01 * slope**2, 0.99 * bias_second + 0.01 * error.sum() ** 2
        scale = 0.1 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        weight = weight - scale * moment / (np.sqrt(second) + 1e-9)
        bias -= scale * bias_moment / (bias_second**0.5 + 1e-9)
    found = dict(zip(keys.tolist(), weight.tolist(), strict=True))
    return {k: w for k, w in found.items() if abs(w) > 1e-3} | {BIAS: bias}


def _parts(lists: pa.ListArray) -> list[np.ndarray]:
    """Each row's features; a null row has none."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    return np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []


def fit(docs: DataFrame, labels: DataFrame, scratch: Scratch, most: int = MOST_LABELLED) -> DataFrame:
    """Weights (feature, weight) from rows (doc_id, text) and (doc_id, toxic)."""
    known = labels.where(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    sample = scratch.save(known.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(most), "sample")
    labelled = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("toxic", "text")
    rows = scratch.save(_rows(labelled), "labelled")

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, sets, pairs = [], [], []
        for batch in batches:
            toxic = column(batch, "toxic").to_pylist()
            # Rows are parts of one array a batch: small arrays would stay with the worker for good.
            own, other = _parts(column(batch, "own")), _parts(column(batch, "other"))
            for label, mine, swap in zip(toxic, own, other, strict=True):
                if label is None:
                    pairs.append((mine, swap))
                else:
                    labels.append(label)
                    sets.append(mine)
        # The order of rows must not change the sums.
        digest = lambda features: hashlib.blake2b(features, digest_size=16).digest()
        order = sorted(range(len(sets)), key=lambda i: (labels[i], digest(sets[i])))
        pairs.sort(key=lambda pair: (digest(pair[0]), digest(pair[1])))
        found = fit_weights(np.array([labels[i] for i in order], np.float64), [sets[i] for i in order], pairs)
        keys = np.array(list(found), np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(list(found.values()))], ["feature", "weight"])

    return scratch.save(rows.repartition(1).mapInArrow(fitted, "feature long, weight double"), "weights")


def score(docs: DataFrame, weights: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` and toxicity_score, 0 to 1, of each row's whole text."""
    found = {r["feature"]: r["weight"] for r in weights.collect()}  # bounded by the sample
    bias = found.pop(BIAS, 0.0)
    keys = np.array(list(found), np.int64).view(np.uint64)
    order = np.argsort(keys)
    model = docs.sparkSession.sparkContext.broadcast((keys[order], np.array(list(found.values()), np.float64)[order], bias))
    types = dict(docs.dtypes)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, weight, bias = model.value
        low = np.uint64((1 << FILTER_BITS) - 1)
        maybe = np.zeros(1 << FILTER_BITS, bool)
        maybe[(keys & low).astype(np.int64)] = True
        for batch in slices(batches, text):
            found, whose = features(words_of(column(batch, text)))
            near = np.flatnonzero(maybe[(found & low).astype(np.int64)])
            at = np.minimum(np.searchsorted(keys, found[near]), max(len(keys) - 1, 0))
            hit = keys[at] == found[near] if len(keys) else np.zeros(len(near), bool)
            pairs = np.unique(np.stack([whose[near[hit]], at[hit]]), axis=1) if hit.any() else np.zeros((2, 0), np.int64)
            logit = bias + np.bincount(pairs[0], weight[pairs[1]], batch.num_rows)
            value = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            yield pa.RecordBatch.from_arrays([*(column(batch, n) for n in keep), pa.array(value)], [*keep, "toxicity_score"])

    fields = "".join(f"`{n}` {types[n]}, " for n in keep)
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(scored, fields + "toxicity_score double")


def mention_shift(docs: DataFrame, weights: DataFrame) -> DataFrame:
    """One row (texts, mean_shift, most_shift): how far a neutral mention moves the scores of rows (doc_id, text).

    Each text is scored as it is and with one identity term, by turns, put after it.
    """
    terms = F.array(*(F.lit(t) for t in TERMS))
    term = F.element_at(terms, (F.crc32(F.coalesce("text", F.lit("")).cast("binary")) % len(TERMS) + 1).cast("int"))
    mentioned = docs.select(F.col("text").alias("plain"), F.concat_ws(" ", "text", term).alias("mention"))
    plain = score(mentioned, weights, keep=("mention",), text="plain").withColumnRenamed("toxicity_score", "as_it_is")
    both = score(plain, weights, keep=("as_it_is",), text="mention")
    shift = F.abs(F.col("toxicity_score") - F.col("as_it_is"))
    return both.agg(F.count("*").alias("texts"), F.avg(shift).alias("mean_shift"), F.max(shift).alias("most_shift"))


def held_out(doc_id: str = "doc_id"):
    """Is the row kept from learning? Crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0
