"""Token files and packing against the library's ids."""

import gc
import hashlib
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from arcweave.llm import packing, token_coder, token_files, tokens
from arcweave.llm.queries import op2_token_files, op4_packing
from arcweave.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "a  b", " a", "x\ny", "x \n y", "a\n\nb c", "  z", "é ̀b ΑΣ", "<|endoftext|> </s>", "ab<|EndOfText|>cd ef", "a b <|startoftext|>. x", "<| endoftext |>", "it's 'll  \t", "😀   b", "w" * 5000, "a " * 30000]


def library(name):
    found = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name,keeps", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_remembered_parts_give_the_library_ids(name, keeps):
    plain, own = library(name), Encoder(public_tokenizers.path(name), keeps)

    @settings(max_examples=150, deadline=None)
    @given(st.text(alphabet="ab .'\n\t\r\x0b\x1c  éΣ1😀<|>", max_size=30))
    def same(text):
        assert own.encode([text])[0].tolist() == plain(text)

    same()
    for text in ODD:
        assert own.encode([text or ""])[0].tolist() == plain(text)


@pytest.mark.parametrize("name,keeps", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_marks_after_words_are_parts_of_their_own(name, keeps):
    plain, own = library(name), Encoder(public_tokenizers.path(name), keeps)

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet="asté1S.,$'%_- \n\u0301😀", max_size=20))
    def same(text):
        assert own.encode([text])[0].tolist() == plain(text)

    same()
    own = Encoder(public_tokenizers.path(name), keeps)
    own.encode(["maße$$$ maße... maße.%% maße\nmaße!"])
    assert sum("maße" in part for part in own._parts.to_pylist()) == 1 + keeps  # with and without the space


@pytest.mark.parametrize("name,keeps", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_forgotten_parts_are_encoded_anew(name, keeps, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    monkeypatch.setattr(tokens, "TOGETHER", 8)
    monkeypatch.setattr(tokens, "MOVED", 7)
    plain, own = library(name), Encoder(public_tokenizers.path(name), keeps)
    rng = random.Random(3)
    for _ in range(60):
        texts = [" ".join(rng.choice(["the", "a1b", "x.y", "é", "zwei.", "  "]) + "abc"[i % 3] * rng.randint(0, 60) for i in range(30)) for _ in range(3)]
        assert [ids.tolist() for ids in own.encode(texts)] == [plain(text) for text in texts]
        assert len(own._parts) == len(own._sizes) == len(own._met) <= 100 and len(own._part_ids) == own._sizes.sum()


def test_remembered_parts_take_little_memory():
    rng = random.Random(5)
    text = " ".join({"".join(rng.choices("abcdefghij", k=9)) for _ in range(60_000)})
    own = Encoder(public_tokenizers.path("word_bpe_49k.json"), False)
    own.encode(["a b"])
    gc.collect()
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    own.encode([text])
    gc.collect()
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert held < 100 * 60_000  # as Python objects they took over 130 bytes a part
    own.encode(["ab" * 40 + " " + "ab" * 32])
    assert own._parts.to_pylist().count("ab" * 40) == 0 and own._parts.to_pylist().count("ab" * 32) == 1


def test_blocks_keep_their_bytes():
    rng = np.random.default_rng(11)
    documents = [rng.zipf(1.3, n).clip(0, 49407).astype(np.uint32) for n in (0, 1, 300, 70001, 12, 30000)]
    documents.append(np.tile(np.arange(500, dtype=np.uint32), 200))
    assert hashlib.sha256(token_coder.encode_block(documents, 49408)).hexdigest() == "9363c20f48eb4b4c54011ad8f65f64288b54c32856ba0ec03b41f66478e08fc6"


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    cases = [
        [], [np.zeros(0, np.uint32)], [np.array([7], np.uint32)], [rng.integers(0, 49408, 70000).astype(np.uint32)],
        [np.full(90000, 49407, np.uint32), np.zeros(0, np.uint32), np.arange(49408, dtype=np.uint32)],
        [rng.zipf(1.3, n).clip(0, 49407).astype(np.uint32) for n in (0, 1, 5, 63, 64, 65, 4000, 30000)],
    ]
    for documents in cases:
        data = token_coder.encode_block(documents, 49408)
        back = token_coder.decode_block(data)
        assert len(back) == len(documents) and all((a == b).all() for a, b in zip(back, documents, strict=True))
    repeated = token_coder.encode_block([np.tile(rng.integers(0, 49408, 500), 400).astype(np.uint32)], 49408)
    assert len(repeated) * 8 / 200000 < 5
    damaged = bytearray(repeated)
    damaged[-500] ^= 1
    with pytest.raises(ValueError):
        token_coder.decode_block(bytes(damaged))
    with pytest.raises(ValueError):
        token_coder.encode_block([np.array([49408], np.uint32)], 49408)


def test_carries_reach_back():
    words = np.array([[0xFFFFFFFE], [0xFFFFFFFF], [0xFFFFFFFF]], np.uint32)
    token_coder._carry(words, np.array([3]), np.array([0]))
    assert words[:, 0].tolist() == [0xFFFFFFFF, 0, 0]


def test_token_query_matches_the_library(spark):
    ids = library("word_bpe_49k.json")
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    start, want = 0, []
    for doc, text in docs:
        own = np.array([*ids(text), 2], "<u4")
        want.append((doc, start, len(own), zlib.crc32(own.tobytes())))
        start += len(own)
    assert sorted(tuple(r) for r in op2_token_files(spark, SF).collect()) == want


def test_token_files_of_odd_rows(spark, scratch, monkeypatch):
    ids = library("word_bpe_49k.json")
    rows = [(i * 7 % 20, t) for i, t in enumerate(ODD)] + [(None, "null id"), (3, "same"), (3, "same")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, part int")
    blocks = scratch.save(token_files.coded(docs, block_ids=1000), "blocks")
    got = sorted(((r.doc_id, r.ids) for r in token_files.decoded(blocks).collect()), key=str)
    assert got == sorted(((d, [*ids(t), 2]) for d, t in rows), key=str)
    starts = token_files.with_starts(token_files.digests(blocks)).sort("start").collect()
    assert [r.start for r in starts] == np.cumsum([0, *(r.n_tokens for r in starts)])[:-1].tolist()
    order = [r.doc_id for r in starts]
    assert order[0] is None and order[1:] == sorted(order[1:])
    empty = scratch.save(token_files.coded(docs.limit(0)), "none")
    assert token_files.with_starts(token_files.digests(empty)).count() == 0


def check_packing(rows, capacity=2048):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_query(spark):
    ids = library("byte_bpe_50k.json")
    rows = op4_packing(spark, SF).collect()
    want, tokens = set(), 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        own = np.array([*ids(r.text), 0], "<u4")
        tokens += len(own)
        first = len(own) % 2048 or 2048
        edges = [0, *range(first, len(own) + 1, 2048)]
        want |= {(r.doc_id, i, a, b - a, zlib.crc32(own[a:b].tobytes())) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))}
    assert len(rows) == len(want) and {tuple(r)[:5] for r in rows} == want
    assert check_packing(rows) <= -(-tokens // 2048) + 2


def test_packing_of_odd_rows(spark, scratch):
    docs = spark.createDataFrame([(i % 4, t, "x") for i, t in enumerate(ODD + ["same", "same"])], "doc_id long, text string, length string")
    pieces = scratch.save(packing.pieces(docs), "pieces")
    rows = packing.pack(pieces, scratch).collect()
    assert len(rows) == pieces.count() >= len(ODD) + 2
    check_packing(rows)
    none = scratch.save(packing.pieces(docs.limit(0)), "pieces")
    assert packing.pack(none, scratch).count() == 0


def exact(items, capacity):
    best = len(items)

    def go(at, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if at == len(items):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + items[at] <= capacity and bins[i] not in bins[:i]:
                bins[i] += items[at]
                go(at + 1, bins)
                bins[i] -= items[at]
        go(at + 1, [*bins, items[at]])

    items = sorted(items, reverse=True)
    go(0, [])
    return best


def test_search_finds_the_optimum_of_small_cases():
    rng = random.Random(7)
    gain = 0
    for _ in range(150):
        items = [rng.randint(2, 60) for _ in range(rng.randint(1, 11))]
        counts = Counter(items)
        found = packing.complete_bins(counts, 100)
        placed = Counter()
        for filling, n in found:
            assert sum(filling) <= 100
            for length in filling:
                placed[length] += n
        assert placed == counts
        n = sum(n for _, n in found)
        assert n == exact(items, 100)
        gain += n < sum(n for _, n in packing.best_fit_decreasing(counts, 100))
    assert packing.complete_bins({}, 100) == []
