"""The Jaccard join, decontamination and the secret scan against brute force."""

import hashlib
import random
import re

import pyarrow as pa

from arcweave.llm import decontaminate, jaccard_join, secrets
from arcweave.llm.components import components
from arcweave.llm.queries import op1_jaccard_join, op3_decontamination, op9_secret_scan
from arcweave.llm.words import words_of

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def shingles(text):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute_groups(rows):
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((doc, least[find(i)], links[i]) for i, (doc, _) in enumerate(rows))


def test_words_are_those_of_the_pattern():
    texts = ["", None, "Abc déf\n1x-ÀÉ", "x" * 5, "😀 b", "\x7f\x80a"]
    found = words_of(pa.array(texts).slice(0))
    for i, t in enumerate(texts):
        assert [found.text(w) for w in range(found.first[i], found.first[i + 1])] == words(t)
    again = words_of(pa.array(["zz", *texts]).slice(1))
    assert (again.hashes == found.hashes).all() and (again.first == found.first).all()
    a = words_of(pa.array(["p q r s t", "r s t u v w"]))
    got, first = a.shingles(3)
    assert list(first) == [0, 3, 7] and got[2] == got[3]


def test_jaccard_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in op1_jaccard_join(spark, SF).collect()) == brute_groups(rows)


def test_jaccard_of_odd_rows_and_a_large_group(spark, scratch, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = [(1, None), (2, ""), (3, "!!"), (4, "one two"), (5, "One, two"), (6, "one two three four five"), (6, "one two three four five"), (6, "other text altogether with words")]
    for i in range(90):
        text = list(base)
        for _ in range(i % 4):
            text[rng.randrange(60)] = f"z{rng.randrange(1000)}"
        rows.append((100 + i, " ".join(text)))
    docs = spark.createDataFrame([(*r, "x", b"y") for r in rows], "doc_id long, text string, cluster string, class binary")
    got = sorted(tuple(r) for r in jaccard_join.jaccard_groups(docs, scratch).collect())
    assert got == brute_groups(rows)
    kept = jaccard_join.one_of_each_group(docs, scratch)
    assert kept.columns == docs.columns
    want = sorted({(d, t) for d, t in rows if (d, d) in {(g[0], g[1]) for g in got}}, key=str)
    assert sorted({(r.doc_id, r.text) for r in kept.collect()}, key=str) == want
    empty = docs.limit(0)
    assert jaccard_join.jaccard_groups(empty, scratch).count() == 0


def test_components_of_a_long_chain(spark, scratch):
    pairs = [(i, i + 1) for i in range(200)] + [(500, 501), (None, 3), (7, 7)]
    found = components(spark.createDataFrame(pairs, "a long, b long"), scratch)
    assert {(r.node, r.root) for r in found.collect()} == {(i, 0) for i in range(201)} | {(500, 500), (501, 500)}


def test_components_of_hubs_and_random_links(spark, scratch):
    drawn = random.Random(3)
    hub = [(1000, i) for i in range(300)]
    zigzag = [pair for i in range(2000, 2200) for pair in ((i, 9000 - i), (9000 - i, i + 1))]
    scattered = [(10_000 + drawn.randrange(300), 10_000 + drawn.randrange(300)) for _ in range(200)]
    pairs = hub + zigzag + scattered + scattered[:20]
    root = {n: n for pair in pairs for n in pair if pair[0] != pair[1]}
    for _ in range(len(root)):
        before = dict(root)
        for a, b in pairs:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    found = components(spark.createDataFrame(pairs, "a long, b long"), scratch)
    assert sorted((r.node, r.root) for r in found.collect()) == sorted(root.items())
    assert components(spark.createDataFrame([], "a long, b long"), scratch).count() == 0


def brute_hits(text, items):
    w = words(text)
    hit, found = set(), set()
    for item, t in items:
        v = words(t)
        size = min(10, len(v))
        if not size:
            continue
        windows = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)}
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(item)
    return len(w), len(hit), sorted(found)


def test_decontamination_query_matches_brute_force(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r.doc_id: r for r in op3_decontamination(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        n, hit, found = brute_hits(d.text, items)
        r = got[d.doc_id]
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(found), digest, hit > 0)
        some += hit > 0
    assert some


def test_decontamination_of_odd_rows(spark, scratch, monkeypatch):
    monkeypatch.setattr(decontaminate, "KEYS_AT_ONCE", 8)
    item = " ".join(f"q{i % 7}" for i in range(25))
    items = [(1, item), (2, None), (3, ""), (4, "Solo"), (5, "two words"), (6, "a b c"), (7, "never seen anywhere at all"), (8, "a b c"), (1, "x y"), (9, "same " * 14)]
    texts = [None, "", item, item.upper() + " tail " + item[:40], "solo, SOLO two  words", "two", "a b\nc a b c", "x y", "same " * 30, "same " * 9, "filler " * 20000 + "a b c", "q0 q1 q2 q3"]
    data = [(i, t, 9) for i, t in enumerate(texts)] + [(2, item, 9), (2, "a b c", 9)]
    docs = spark.createDataFrame(data, "doc_id long, text string, n int")
    bench = spark.createDataFrame([(*x, "k") for x in items], "item_id long, text string, keys string")
    got = decontaminate.contamination(docs, bench, scratch).collect()
    found = sorted((r.doc_id, r.n_words, r.n_hit, sorted(r["items"])) for r in got)
    assert found == sorted((d, *brute_hits(t, items)) for d, t, _ in data)
    none = decontaminate.contamination(docs, bench.limit(0), scratch).collect()
    assert len(none) == len(data) and all(r.n_hit == 0 and r["items"] == [] for r in none)
    assert decontaminate.contamination(docs.limit(0), bench, scratch).count() == 0


def brute_secrets(text):
    text = text or ""
    found = []
    pattern = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found += [(m.start(), 0, m.end()) for m in re.finditer(pattern, text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    kinds = ("assign", "access", "hex")
    return [f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(found)]


def test_secret_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op9_secret_scan(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = brute_secrets(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == base
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex"))


def test_secrets_in_odd_texts(spark):
    key = "AKIA" + "B7" * 8
    random_key = "h9Xk2PqLz7VbN4cTqW8rYd3JmZs5"
    texts = [
        None, "", f"ÀÉ😀 API_KEY='{'a1' * 8}' passwd: short", f"{key} AKIAshort {key}{key}", "ToKeN = \"0123456789abcdef0123\"", "ſecret=aaaaaaaaaaaaaaaa",
        f"key {random_key} end", "d41d8cd98f00b204e9800998ecf8427e", "123e4567-e89b-12d3-a456-426614174000", "2024-01-31/2024-02-29/00", "a_very_long_name_of_words_and_more",
        f"user@{random_key}", "secret=" * 9 + "x" * 100000,
    ]
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    rows = {r.doc_id: r for r in secrets.scan(docs).collect()}
    for i, t in enumerate(texts):
        assert [s for s in rows[i].scan_spans.split(",") if s and not s.startswith("random")] == brute_secrets(t)
    assert [i for i, r in rows.items() if "random" in r.scan_spans] == [3, 6] or [i for i, r in rows.items() if "random" in r.scan_spans] == [6]
    assert rows[6].scan_text == "key [SECRET] end"
    assert rows[2].scan_text.startswith("ÀÉ😀 [SECRET]") and rows[0].scan_text is None
    assert secrets.scan(docs.limit(0)).count() == 0
