"""Covering SimHash against all pairs."""

import itertools
import random
import re

import numpy as np
import xxhash

from arcweave.llm import covering_simhash as cs
from arcweave.llm.queries import op12_covering_simhash

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def brute_fingerprint(text):
    words = WORD.findall((text or "").translate(FOLD))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    different = sorted(set(prints))
    at = {f: i for i, f in enumerate(different)}
    values = np.array(different, np.uint64)
    root = list(range(len(different)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 3):
            root[find(i)] = find(int(j))
    least = {}
    for (doc, _), f in zip(rows, prints, strict=True):
        r = find(at[f])
        known = [x for x in (least.get(r), doc) if x is not None]
        least[r] = min(known) if known else None
    return [(doc, f"{f:016x}", least[find(at[f])]) for (doc, _), f in zip(rows, prints, strict=True)]


def same(got, wanted):
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, wanted))


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    same(op12_covering_simhash(spark, SF).collect(), brute(rows))


def test_masks_cover_every_pair_within_the_radius():
    masks = cs.covering_masks((1 << 64) - 1)
    assert len(masks) == 15
    for bits in itertools.combinations(range(64), 3):
        differing = sum(1 << b for b in bits)
        assert any(not differing & m for m in masks)
    for level in (2, 3):
        for family in cs.mask_paths(level)[::7]:
            free = ~family[0] | ~family[1]
            places = [b for b in range(64) if not all(m >> b & 1 for m in family)]
            for bits in itertools.islice(itertools.combinations(places, 3), 300):
                assert any(not sum(1 << b for b in bits) & m for m in family)
            assert free
    assert all(64 - m.bit_count() <= 8 for family in cs.mask_paths(3) for m in family)
    assert 1 << 8 <= cs.BUCKET


def test_bucket_roots():
    rng = random.Random(4)
    buckets = [sorted({rng.getrandbits(6) << 50 | rng.getrandbits(3) for _ in range(rng.randrange(2, 40))}) for _ in range(60)]
    members = np.array([m for b in buckets for m in b], np.int64)
    got = cs.bucket_roots(np.array([len(b) for b in buckets]), members)
    at = 0
    for bucket in buckets:
        root = {m: m for m in bucket}
        for _ in bucket:
            for a in bucket:
                root[a] = min(root[b] for b in bucket if (a ^ b).bit_count() <= 3)
        assert list(got[at : at + len(bucket)]) == [root[m] for m in bucket]
        at += len(bucket)


def _components(values):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in itertools.combinations(values, 2):
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3:
            root[max(find(a), find(b))] = min(find(a), find(b))
    groups = {}
    for v in values:
        groups.setdefault(find(v), []).append(v)
    return sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_large_buckets_are_hashed_again(spark, scratch, monkeypatch):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    values = {cs._signed(base ^ (rng.getrandbits(9) << rng.randrange(55))) for _ in range(900)}
    values |= {cs._signed(rng.getrandbits(64)) for _ in range(100)} | {0, -1, 7}
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    for bucket in (256, 4):
        monkeypatch.setattr(cs, "BUCKET", bucket)
        roots = cs.components(cs.fingerprint_links(frame, scratch), scratch).collect()
        groups = {}
        for r in roots:
            groups.setdefault(r.root, []).append(r.node)
        assert sorted(sorted(g) for g in groups.values()) == _components(values)


def test_odd_rows(spark, scratch):
    long_text = " ".join(f"w{i % 977}" for i in range(200_000))
    near = "the quick brown fox jumps over the lazy dog and then some more words follow here until the end " * 20
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "One"), (5, "one two"), (5, "ONE\ttwo"), (6, "ÀÉ x\xa0y z"), (None, near), (7, near + "x"), (None, "alone with null id")]
    rows += [(8, long_text), (9, long_text), (9, long_text)]
    docs = spark.createDataFrame([(*r, 1, "y") for r in rows], "doc_id long, text string, fingerprint int, root string")
    same(cs.near_duplicates(docs, scratch).collect(), brute(rows))
    assert cs.near_duplicates(docs.where("false"), scratch).collect() == []
