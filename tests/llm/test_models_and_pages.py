"""Toxicity on held-out rows, HTML extraction, and the pipeline."""

import html as escaping
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from arcweave.llm import html_text, toxicity
from arcweave.llm.queries import op7_toxicity, op8_html_text, pipeline

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def test_toxicity_on_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    rows = op7_toxicity(spark, SF01).collect()
    assert len(rows) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == t for p, t in held) / len(held) > 0.93
    assert sum(p and not t for p, t in held) <= 0.02 * len(held)


def sets_of(texts):
    return toxicity._sets(pa.array(texts))


def score_of(weights, text):
    return weights[0] + sum(weights.get(int(f), 0.0) for f in sets_of([text])[0])


def test_swapping_terms_lowers_the_score_of_neutral_mentions(monkeypatch):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    texts, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        named = rng.random() < (0.8 if bad else 0.1)
        texts.append(" ".join(rng.sample(words, 8) + ["muslim"] * named + ["vile"] * (bad and rng.random() < 0.7)))
        labels.append(float(bad))
    pairs = [(a, b) for t in texts if (s := toxicity.swapped(t)) for a, b in [sets_of([t, s])]]
    weights = {}
    for strength in (0.0, 5.0):
        monkeypatch.setattr(toxicity, "COUNTERFACTUAL", strength)
        weights[strength] = toxicity.fit_weights(np.array(labels), sets_of(texts), pairs)
    plain, fair = (score_of(weights[s], "w1 w2 muslim") - score_of(weights[s], "w1 w2 jewish") for s in (0.0, 5.0))
    assert plain > 1 and abs(fair) < 0.3 * plain
    assert score_of(weights[5.0], "w1 vile") > score_of(weights[5.0], "w1 w2") + 1


def test_every_labelled_text_gives_a_counterfactual():
    assert toxicity.slotted(" \n") is None and toxicity._pairs("") == []
    for text in ("one", "one two three. Four five six seven eight nine ten eleven twelve"):
        own, other = toxicity.slotted(text)
        added = [w for w in own.split() if w not in other.split()]
        assert len(added) == 1 and added[0] in toxicity.TERMS and len(other.split()) <= 2 * toxicity.SLOT_WORDS
    assert len(toxicity._pairs("The muslim came. Nobody else")) == 2


def test_weights_score_as_an_independent_sum_and_mentions_hardly_move_them(spark, scratch):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet").where(~toxicity.held_out())
    weights = toxicity.fit(docs, labels, scratch)
    found = {r.feature: r.weight for r in weights.collect()}
    by_hash = {k % (1 << 64): w for k, w in found.items()}
    bias = by_hash.pop(toxicity.BIAS, 0.0)
    rows = {r.doc_id: r.toxicity_score for r in toxicity.score(docs, weights).collect()}
    for r in docs.limit(60).collect():
        logit = bias + sum(by_hash.get(int(f), 0.0) for f in sets_of([r.text])[0])
        assert abs(rows[r.doc_id] - 1 / (1 + np.exp(-np.clip(logit, -30, 30)))) < 1e-9
    neutral = docs.join(spark.read.parquet(f"{SF01}/labels.parquet").where(toxicity.held_out()).where("toxic = 0"), "doc_id")
    shift = toxicity.mention_shift(neutral, weights).first()
    assert shift.texts > 20 and shift.mean_shift < 0.01


def test_toxicity_of_odd_rows(spark, scratch):
    docs = spark.createDataFrame([(1, None, "l", 1), (2, "", "l", 1), (3, "vile " * 50000, "l", 1), (3, "fine", "l", 0), (None, "x", "l", 0)], "doc_id long, text string, lang string, toxic int")
    none = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"), scratch)
    assert all(r.toxicity_score < 0.01 for r in toxicity.score(docs, none).collect())
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (3, None), (4, 7), (None, 1)], "doc_id long, toxic int")
    found = toxicity.score(docs, toxicity.fit(docs, labels, scratch)).collect()
    assert len(found) == 5 and all(0 <= r.toxicity_score <= 1 for r in found)
    assert toxicity.score(docs.limit(0), none).count() == 0


def brute_text(page):
    """Main text of the test tables' one kind of page."""
    found = re.search(r"(?s)<article>(.*?)(?:</article>|<footer|$)", page or "")
    if not found:
        return ""
    blocks = re.split(r"</?(?:p|h1|article)>", re.sub(r"(?s)<[a-zA-Z/!][^<>]*$", "", found[1]))
    plain = [" ".join(escaping.unescape(re.sub(r"</?b>", "", b.replace("<br>", " "))).split()) for b in blocks]
    return "\n\n".join(b for b in plain if b)


@pytest.mark.parametrize("where", [SF, SF01])
def test_pages_match_brute_force(spark, where):
    pages = {r.page_id: r for r in spark.read.parquet(f"{where}/pages.parquet").collect()}
    rows = op8_html_text(spark, where).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text)
        assert r.text == brute_text(pages[r.page_id].html), r.page_id


def kept(page):
    return [text for text, prior, _ in html_text.parse(page)[0] if prior != 0]


def test_markup_cases():
    page = """<!DOCTYPE html><body><header>Top</header><nav><ul><li>a<li>b</ul></nav><div class="cookie-notice">Eat</div>
    <main><article><h1>Title &lt;1&gt;</h1><p>One<b> two</b>
    three<br>four <a href="x">link</a><script>if (a < b) "<p>"</script><p>Five<div class="ad">Buy</div><ul><li>x<li>y</ul>
    <section id="comments"><p>First!</section><form><p>Mail</form><aside>Side</aside><p>1 < 2 &am &copy;</article></main><footer>End</footer>"""
    assert kept(page) == ["Title <1>", "One two three four link", "Five", "x", "y", "1 < 2 &am ©"]
    assert kept("") == [] and kept("<p") == [] and kept("just text") == ["just text"]
    assert kept("<article>a <!-- <p>no --> b<p>c &amp") == ["a b", "c &"]
    assert len(kept("<div>" * 3000 + "deep")) == 1


def test_site_tree_removes_what_repeats(spark, scratch):
    pages = []
    for i in range(20):
        body = f"<div class='box'><p>Same line on every page</p></div><div class='story'><h2>Story {i}</h2><p>Text number {i} of {i * 7}</p>{'<p>more</p>' * (i % 3)}</div>"
        pages.append((i, f"http://Site.example/{i}", f"<html><body>{body}</body></html>"))
    pages += [(100, None, None), (101, "http://lone.example/", "<body><p>Alone</p></body>"), (101, "http://lone.example/", None), (102, "odd", "<b>x")]
    data = spark.createDataFrame([(*p, "t", 5) for p in pages], "page_id long, url string, html string, text string, row int")
    rows = html_text.extract(data, scratch).collect()
    assert len(rows) == len(pages)
    for r in rows:
        if r.page_id < 20:
            assert "Same line" not in r.text and r.text.startswith(f"Story {r.page_id}\n\nText number {r.page_id}")
    assert {r.text for r in rows if r.page_id >= 100} == {"", "Alone", "x"}
    assert html_text.extract(data.limit(0), scratch).count() == 0


def test_pipeline_stages_keep_what_they_should(spark, scratch):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    flagged = {r.doc_id for r in op7_toxicity(spark, SF01).collect() if r.predicted}
    own = spark.createDataFrame(
        [(10**9, "token = abcdefghij0123456789 in a text", "en", "s", 38), (10**9 + 1, None, None, None, None), (10**9 + 2, "", "en", "s", 0)], docs.schema
    )
    given = docs.unionByName(own)
    before = {r.doc_id for r in given.collect()}
    for name, stage in cp.STAGES:
        made = stage(spark, given, SF01)
        if name != "packing":
            assert made.columns == docs.columns
        given = scratch.save(made, name)
        after = {r.doc_id for r in given.select("doc_id").collect()}
        if name == "toxicity":
            assert before - after == flagged
        if name in ("near_duplicates", "decontamination"):
            assert after < before
        if name == "secrets":
            assert after == before
            row = given.where(f"doc_id = {10**9}").first()
            assert row.text == "[SECRET] in a text" and row.n_chars == 18
        if name == "packing":
            assert after == before
        before = after
    assert {10**9, 10**9 + 1, 10**9 + 2} <= before


def test_pipeline_query_runs(spark):
    assert pipeline(spark, SF).count() > 100
