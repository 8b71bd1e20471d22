"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from arcweave.llm import spelling
from arcweave.llm.queries import op13_spelling_variants

SF = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def brute_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near_of(words):
    """All pairs with one edit, by what is left when a character goes."""
    left, near = {}, {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            left.setdefault(w[:i] + "?" + w[i + 1 :], set()).add(w)
            short = w[:i] + w[i + 1 :]
            if short in near:
                near[w].add(short)
                near[short].add(w)
    for group in left.values():
        for w in group:
            near[w] |= group - {w}
    return near


def brute(words):
    near = near_of(words)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return rows


def same(got, wanted):
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, wanted))


@pytest.mark.parametrize("frequent", [64, 2])
def test_query_matches_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(spelling.frequent_grams, "__defaults__", (frequent,))
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    words = brute_words(rows)
    got = op13_spelling_variants(spark, SF).collect()
    assert any(r.form for r in got)
    same(got, brute(words))


def test_no_near_pair_is_lost_whatever_is_frequent():
    rng = random.Random(6)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(5, 10))) for _ in range(700)}
    words |= {"a" * k for k in range(5, 80)} | {"ab" * k for k in range(3, 30)}
    times = Counter(w[p : p + q] for w in words for q in range(2, 7) for p in range(len(w) - q + 1))
    near = near_of(words)
    for most in (0, 3, 20, 60, 10**9):
        names = {}
        for w in words:
            hits = {spelling._at(p, q) for q in range(2, 7) for p in range(len(w) - q + 1) if times[w[p : p + q]] > most}
            names[w] = spelling.list_names(w, hits)
            assert len(names[w]) <= 2 * len(w) + 1
        for w in words:
            assert all(names[w] & names[o] for o in near[w]), (most, w)


def test_odd_rows(spark, scratch):
    rng = random.Random(7)
    rows = [(1, None), (2, ""), (3, "12 ,."), (None, "garden garden gardén Garden"), (4, "x" * 3000 + " " + "y" * 3000)]
    rows += [(4, "x" * 3000 + " " + "y" * 3000)] * 3 + [(5, "x" * 2999 + "z gardens ×÷×÷× ÿÿÿÿÿ ÿÿÿÿÿĀÿÿÿÿÿ")] * 4
    rows += [(i, " ".join(rng.choice(["flower", "flowr", "flowers", "Flüwer", "flo-wer", "straße", "STRASSE"]) for _ in range(80))) for i in range(10, 40)]
    docs = spark.createDataFrame([(*r, 1, "y") for r in rows], "doc_id long, text string, n int, word string")
    words = brute_words(rows)
    assert "x" * 3000 in words and "ÿ" * 5 in words
    same(spelling.spelling_variants(docs, scratch).collect(), brute(words))
    assert spelling.spelling_variants(docs.where("false"), scratch).collect() == []
