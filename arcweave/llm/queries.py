"""The registered query of each operator, over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcweave.llm import (
    centroids,
    chat_format,
    covering_simhash,
    decontaminate,
    html_text,
    jaccard_join,
    packing,
    quality_rules,
    secrets,
    spelling,
    token_files,
    toxicity,
    warc,
)
from arcweave.scratch import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's group of near duplicates and its number of links."""
    return jaccard_join.jaccard_groups(_table(spark, sf_dir, "documents"), Scratch(spark))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written in coded blocks and read back from them."""
    scratch = Scratch(spark)
    blocks = token_files.write_token_files(_table(spark, sf_dir, "documents"), scratch)
    found = scratch.save(token_files.digests(blocks), "digests")
    return token_files.with_starts(found).select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's words inside benchmark windows, and the items they come from."""
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), Scratch(spark))
    ids = F.array_join(F.array_sort(F.transform("items", lambda item: item.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of at most 2048 tokens."""
    scratch = Scratch(spark)
    pieces = scratch.save(packing.pieces(_table(spark, sf_dir, "documents")), "pieces")
    return packing.pack(pieces, scratch).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation, and conversation -1, formatted, written and read back."""
    scratch = Scratch(spark)
    rows = _table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    written = scratch.save(chat_format.format_conversations(rows.unionByName(own), scratch), "formatted")
    read = written.select(
        "conv_id",
        "formatted",
        chat_format.parse_turns(F.col("formatted")).alias("turns"),
        chat_format.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    said_again = F.array_join(
        F.transform("turns", lambda turn: F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said_again, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back from the archives."""
    scratch = Scratch(spark)
    pages = _table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("key"), "url", F.encode("html", "UTF-8").alias("payload")
    )
    path = scratch.folder("warc")
    warc.archive(pages, scratch, path)
    blocks = warc.reassemble(warc.read_records(spark, path))
    found = scratch.save(warc.payloads(blocks, with_payload=False).drop("payload"), "read")
    return warc.resolve_revisits(found).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's toxicity by a classifier fitted on four fifths of the labels."""
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").where(~toxicity.held_out())
    weights = toxicity.fit(docs, labels, Scratch(spark))
    return toxicity.score(docs, weights).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        F.col("toxicity_score").alias("score"),
        (F.col("toxicity_score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page."""
    found = html_text.extract(_table(spark, sf_dir, "pages"), Scratch(spark))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stages of corpus_pipeline, one after the other."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in each document: the fixed patterns and the token-efficiency test."""
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.col("scan_n_assign").alias("n_assign"),
        F.col("scan_n_access").alias("n_access"),
        F.col("scan_n_hex").alias("n_hex"),
        F.col("scan_base_sha256").alias("base_sha256"),
        F.col("scan_spans").alias("spans"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each text, the fixed rules, and the learned list's verdict."""
    scratch = Scratch(spark)
    counts = scratch.save(quality_rules.text_statistics(_table(spark, sf_dir, "documents")), "counts")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    rows = scratch.save(counts.join(labels, "doc_id").where(~quality_rules.base_failed()), "labelled")
    rules = quality_rules.learn_rules(rows)
    return counts.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        quality_rules.base_failed().alias("base_failed"),
        (~quality_rules.base_failed() & quality_rules.verdict(rules)).alias("kept"),
    )


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector's cluster after five rounds, with its distance and the clusters' inertia."""
    return centroids.cluster(_table(spark, sf_dir, "embeddings"), Scratch(spark))


def op12_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's fingerprint and the component of near duplicates it is in."""
    return covering_simhash.near_duplicates(_table(spark, sf_dir, "documents"), Scratch(spark))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each word of the documents with the form it is a variant of."""
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"), Scratch(spark))


QUERIES = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_token_files": op2_token_files,
    "op3_decontamination": op3_decontamination,
    "op4_packing": op4_packing,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_warc": op6_warc,
    "op7_toxicity": op7_toxicity,
    "op8_html_text": op8_html_text,
    "op9_secret_scan": op9_secret_scan,
    "op10_quality_rules": op10_quality_rules,
    "op11_centroids": op11_centroids,
    "op12_covering_simhash": op12_covering_simhash,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": pipeline,
}
