"""Token-id files: all documents' ids in ascending order of document id.

Documents are range-partitioned and sorted by id; each task encodes its texts
and codes them in blocks of whole documents (token_coder). A file's rows are
(part, block_no, doc_ids, data): the ids of a block's documents and the block
itself. Spark's writer commits the files, so blocks of lost executors are
written once more and only once counted. Reading decodes every block in place
and checks its sum.

Defined results: a null text is an empty one, only its end id; a null document id
comes first; equal ids stand in order of their texts; an empty table gives no
blocks. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arcweave.llm.token_coder import BLOCK_IDS, decode_block, encode_block
from arcweave.llm.tokens import ENCODED_TOGETHER, TEXTS_TOGETHER, encoder, give_back
from arcweave.llm.words import column, slices
from arcweave.scratch import Scratch

VOCABULARY = "word_bpe_49k.json"
VOCABULARY_IDS = 49_408


def coded(docs: DataFrame, vocabulary: str | None = None, vocabulary_ids: int = VOCABULARY_IDS, end_id: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks (part, block_no, doc_ids, data) of rows (doc_id, text), in ascending order of doc_id."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    kind = dict(docs.dtypes)["doc_id"]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, keeps_space=False).encode
        ids_type = None
        held: list[np.ndarray] = []
        whose: list = []
        size = number = 0

        def block():
            data = encode_block(held, vocabulary_ids)
            arrays = [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([whose], pa.list_(ids_type)), pa.array([data], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["part", "block_no", "doc_ids", "data"])

        for batch in slices(batches, "text", most_rows=TEXTS_TOGETHER, most_bytes=ENCODED_TOGETHER):
            part = column(batch, "part")[0].as_py()
            ids_type = column(batch, "doc_id").type
            texts = encode(t or "" for t in column(batch, "text").to_pylist())
            for doc, ids in zip(column(batch, "doc_id").to_pylist(), texts, strict=True):
                ids = np.append(ids, np.uint32(end_id))
                if held and size + len(ids) > block_ids:
                    yield block()
                    held, whose, size, number = [], [], 0, number + 1
                held.append(ids)
                whose.append(doc)
                size += len(ids)
        if held:
            yield block()
        give_back()

    placed = (
        docs.select("doc_id", "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )
    return placed.mapInArrow(blocks, f"part int, block_no int, doc_ids array<{kind}>, data binary")


def decoded(blocks: DataFrame) -> DataFrame:
    """(part, block_no, doc_no, doc_id, ids) of every document in the blocks."""
    kind = dict(blocks.dtypes)["doc_ids"][len("array<") : -1]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = decode_block(column(batch, "data")[i].as_py())
                whose = column(batch, "doc_ids")[i].values
                for at in range(0, len(found), 256):
                    some = found[at : at + 256]
                    lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, some)]).astype(np.int32), pa.array(np.concatenate(some).astype(np.int32)))
                    arrays = [
                        pa.array(np.full(len(some), column(batch, "part")[i].as_py(), np.int32)),
                        pa.array(np.full(len(some), column(batch, "block_no")[i].as_py(), np.int32)),
                        pa.array(np.arange(at, at + len(some), dtype=np.int32)),
                        whose[at : at + len(some)],
                        lists,
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, ["part", "block_no", "doc_no", "doc_id", "ids"])

    return blocks.mapInArrow(documents, f"part int, block_no int, doc_no int, doc_id {kind}, ids array<int>")


def digests(blocks: DataFrame) -> DataFrame:
    """(part, block_no, doc_no, doc_id, n_tokens, ids_crc32, before) of every document, decoded in place.

    ``before`` are the ids of the documents before it in its block.
    """
    kind = dict(blocks.dtypes)["doc_ids"][len("array<") : -1]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                documents = decode_block(column(batch, "data")[i].as_py())
                sizes = np.array([len(d) for d in documents], np.int64)
                n = len(documents)
                arrays = [
                    pa.array(np.full(n, column(batch, "part")[i].as_py(), np.int32)),
                    pa.array(np.full(n, column(batch, "block_no")[i].as_py(), np.int32)),
                    pa.array(np.arange(n, dtype=np.int32)),
                    column(batch, "doc_ids")[i].values,
                    pa.array(sizes),
                    pa.array([zlib.crc32(d) for d in documents], pa.int64()),
                    pa.array(np.cumsum(sizes) - sizes),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["part", "block_no", "doc_no", "doc_id", "n_tokens", "ids_crc32", "before"])

    return blocks.mapInArrow(
        found, f"part int, block_no int, doc_no int, doc_id {kind}, n_tokens long, ids_crc32 long, before long"
    )


def with_starts(found: DataFrame) -> DataFrame:
    """Add ``start``: the ids of all documents before, in all files.

    Blocks' totals (one row for each two million ids) are summed per file, then
    over files: two windows, each over as many rows as one file has blocks, or
    as there are files.
    """
    earlier = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    sizes = found.groupBy("part", "block_no").agg(F.sum("n_tokens").alias("n"))
    inside = sizes.select("part", "block_no", F.coalesce(F.sum("n").over(earlier("part").orderBy("block_no")), F.lit(0)).alias("in_part"))
    files = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    files = files.select("part", F.coalesce(F.sum("n").over(earlier(F.lit(0)).orderBy("part")), F.lit(0)).alias("of_part"))
    bases = inside.join(files, "part").select("part", "block_no", (F.col("in_part") + F.col("of_part")).alias("base"))
    return found.join(bases, ["part", "block_no"]).select("*", (F.col("base") + F.col("before")).alias("start"))


def write_token_files(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Write the blocks of rows (doc_id, text) and return the written table."""
    return scratch.save(coded(docs), "token_blocks")
