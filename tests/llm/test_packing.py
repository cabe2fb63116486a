import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from retainspark.llm import packing
from retainspark.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 1]


def check(pieces, window=2048):
    """Every id in one piece, sequences gapless and full or a power of two."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p.doc].append((p.start, p.length))
        sequences[p.sequence_id].append((p.offset, p.length))
    for got in docs.values():
        at = 0
        for start, length in sorted(got):
            assert start == at and length > 0
            at += length
    for got in sequences.values():
        at = 0
        for offset, length in sorted(got):
            assert offset == at
            at += length
        assert at == window or (at < window and at & (at - 1) == 0)
    return {d: sum(n for _, n in v) for d, v in docs.items()}, sequences


class Piece:
    def __init__(self, r, doc):
        self.doc, self.start, self.length, self.sequence_id, self.offset = doc, r.start, r.length, r.sequence_id, r.offset


@pytest.mark.parametrize("lengths", [
    [], [1], [2048], [2048 * 3], [2047] * 9, [1, 31, 32, 33, 64] * 40, [1024] * 7 + [5], [100] * 300, list(range(1, 400, 7)) * 3 + [70_001, 4096, 0, None]])
def test_lengths_are_packed_whole(spark, lengths):
    df = spark.createDataFrame(list(enumerate(lengths)), "row long, n long").repartition(3)
    rows = packing.pack(df).collect()
    sizes, sequences = check([Piece(r, r.row) for r in rows])
    assert sizes == {i: n for i, n in enumerate(lengths) if n}
    assert len(sequences) - sum(n or 0 for n in lengths) // 2048 <= 11


def test_small_window(spark):
    df = spark.createDataFrame([(i, i % 23 + 1) for i in range(500)], "row long, n long")
    sizes, _ = check([Piece(r, r.row) for r in packing.pack(df, window=16, grain=2, depth=3).collect()], 16)
    assert sizes == {i: i % 23 + 1 for i in range(500)}


def test_least_squares_against_normal_conditions():
    rng = np.random.default_rng(1)
    for _ in range(20):
        a, b = rng.random((8, 30)), rng.normal(size=8)
        x = packing.nnls(a, b)
        gain = a.T @ (b - a @ x)
        assert (x >= 0).all() and gain.max() < 1e-8 and np.abs(gain[x > 0]).max(initial=0) < 1e-8


def test_counts_solve_a_histogram_that_combinations_make():
    plans = packing.combinations(16, 3)
    assert len(plans) == len(set(plans)) and all(sum(p) == 16 and 2 <= len(p) <= 3 for p in plans)
    assert set(plans) == {tuple(sorted((a, b, 16 - a - b), reverse=True)) if 16 - a - b else (max(a, b), min(a, b))
                          for a in range(1, 16) for b in range(1, 17 - a)}
    histogram = np.zeros(16, dtype=np.int64)
    for plan, n in zip(plans[3:9], (5, 1, 7, 2, 30, 4), strict=True):
        for k in plan:
            histogram[k] += n
    used = Counter()
    for plan, n in packing.repeat_counts(histogram):
        for k in plan:
            used[k] += n
    assert all(used[k] <= histogram[k] for k in used)
    left = sum(int(histogram[k] - used[k]) * k for k in range(16))
    assert left <= 32  # nearly all of it goes into full windows
    assert packing.repeat_counts(np.zeros(16, dtype=np.int64)) == []


def test_ids_are_the_librarys(library):
    texts = ["", "Hello, World's 12 don't", " \t a b  c\x1cd\n", "ÀÉ é ́x ΣΑΣ Σ İstanbul Å", "<|endoftext|> x<|startoftext|>",
             "漢字かな交じり文" * 30, "x" * 5000, "a\r\nb\x0bc\x0cd", "!\x1cx", "né, n't’s -\x1cm ß's 12a3 a1", "İ̇ ǅ ﬁ 1234½ ͅ 😀!? --__"]
    own = packing.ChunkEncoder(PATH)
    for _ in range(2):  # with and without remembered chunks
        got = own.encode(pa.array(texts))
        for t, g in zip(texts, got, strict=True):
            assert np.frombuffer(g, dtype="<u4").tolist() == library(t)[:-1], t
    with pytest.raises(ValueError):
        packing.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_documents(spark, documents, library):
    texts = [None, "", "one two three", "one two three", "word " * 9000, "", "x\ty", *[f"some text {i} " * (i % 90) for i in range(120)]]
    rows = packing.pack_documents(documents([(None if i == 2 else i // 2, t) for i, t in enumerate(texts)], extra=("row", "n", "start", "ids")), PATH).collect()
    sequences = defaultdict(list)
    whole = defaultdict(int)
    for r in rows:
        assert len(r.ids) == 4 * r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        whole[r.doc_id] += r.length
    for got in sequences.values():
        at = 0
        for offset, length in sorted(got):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0
    want = defaultdict(int)
    for i, t in enumerate(texts):
        want[None if i == 2 else i // 2] += len(library(t))
    assert dict(whole) == dict(want)
    long = sorted((r.start, bytes(r.ids)) for r in rows if r.doc_tokens == len(library(texts[4])))
    assert np.frombuffer(b"".join(x for _, x in long), dtype="<u4").tolist() == library(texts[4])
    assert packing.pack_documents(documents([]), PATH).collect() == []


def test_query_over_the_whole_table(spark, sf_dir, library):
    rows = QUERIES["op13_nnls_packing"](spark, sf_dir).collect()
    sizes, sequences = check([Piece(r, r.doc_id) for r in rows])
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    ids = {d: library(t) for d, t in texts.items()}
    assert sizes == {d: len(x) for d, x in ids.items()}
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start:r.start + r.length], dtype="<u4").tobytes())
    assert max(sequences) == len(sequences) - 1
