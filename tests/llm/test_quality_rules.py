import re
from collections import Counter

from pyspark.sql import functions as F

from arcweave.llm import quality_rules as qr
from arcweave.llm.queries import op10_quality_rules

SF = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    hit = set()
    for i, window in enumerate(windows):
        if seen[window] > 1:
            hit.update(range(i, i + 8))
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(hit),
    )


def counts_of(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    rows = qr.text_statistics(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return {r.doc_id: tuple(r[n] for n in names) for r in rows}


def test_counts_match_brute_force_on_odd_texts(spark):
    unit = "a b c d e f g h "
    texts = [
        None, "", " \t\r\n\x0b\x0c", "one", "é b c|#*", "x\n\nx\n x\nx", unit * 2, unit + "z " + unit,
        "a " * 40, unit * 3 + "q r s t u v w x y", "w\n" * 9, ("p q r s t u v w x " * 2) + unit, "long " * 30000,
        "😀 b\x85c d",
    ]
    found = counts_of(spark, texts)
    assert {i: brute(t) for i, t in enumerate(texts)} == found


def test_counts_match_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = {r.doc_id: r for r in op10_quality_rules(spark, SF).collect()}
    assert len(rows) == len(docs)
    for d in docs:
        r, want = rows[d.doc_id], brute(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def labelled(spark, rows):
    fill = {name: 0.0 for name in qr.STATISTICS}
    data = [(i, q, *({**fill, **s}[n] for n in qr.STATISTICS)) for i, (q, s) in enumerate(rows)]
    names = ", ".join(f"{n} double" for n in qr.STATISTICS)
    return spark.createDataFrame(data, f"doc_id long, quality int, {names}")


def test_a_conjunction_is_found_and_good_rows_are_kept(spark):
    rows = []
    for i in range(600):
        symbols, words = (i % 5) / 2, 50 + 100 * (i % 3)
        rows.append((0 if symbols >= 1.5 and words < 100 else 1, {"symbols_per_word": symbols, "n_words": float(words)}))
    data = labelled(spark, rows)
    rules = qr.learn_rules(data)
    assert rules and {t.statistic for t in rules[0]} == {"symbols_per_word", "n_words"}
    kept = data.select((F.col("quality") == 1).alias("good"), qr.verdict(rules).alias("kept")).distinct().collect()
    assert {(r.good, r.kept) for r in kept} == {(True, True), (False, False)}


def test_noise_and_no_labels_teach_nothing(spark):
    noise = labelled(spark, [(0 if i * 2654435761 % 97 < 10 else 1, {"n_words": float(i % 50)}) for i in range(500)])
    assert qr.learn_rules(noise) == []
    assert qr.learn_rules(labelled(spark, [(None, {}), (7, {})])) == []
    empty = labelled(spark, [(1, {})]).limit(0)
    assert qr.learn_rules(empty) == []
    assert empty.select(qr.verdict([]).alias("kept")).count() == 0


def test_bins_agree_with_thresholds_at_the_edges(spark):
    edges = [(2.0 ** (b / qr.STEPS) - 1) / qr.SCALE for b in range(0, 150, 7)]
    rows = labelled(spark, [(1, {"n_words": e}) for e in edges])
    for b, r in zip(range(0, 150, 7), rows.select("doc_id", qr._bin("n_words").alias("b")).sort("doc_id").collect(), strict=True):
        assert r.b == b


def test_native_plan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = qr.text_statistics(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan
