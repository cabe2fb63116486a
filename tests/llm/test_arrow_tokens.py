import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from retainspark.llm import arrow_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "!", "a  b\n\n c's don't 123 x²½", " nbsp em", "漢字 😀", "tab\t\r\n end ", "<|endoftext|> x", "É'LL we'll 'S",
       "x\x1cy\x85z", "  lead", "a" * 5000, "Straße über alles … „quoted“"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_encoder_equals_the_library(library):
    texts = [*ODD, *[" ".join(f"w{i}é{i % 3}" for i in range(n)) for n in (1, 50, 400)]]
    got = arrow_tokens.Encoder(PATH).encode(texts)
    assert [g.tolist() for g in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    other = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(other)
    whole.encode_special_tokens = True
    assert not arrow_tokens.Encoder(other).by_piece
    assert [g.tolist() for g in arrow_tokens.Encoder(other).encode(ODD)] == [
        e.ids for e in whole.encode_batch(ODD, add_special_tokens=False)]


@pytest.fixture
def folder(tmp_path):
    return f"file://{tmp_path}/tokens"


def test_files_hold_the_stream(spark, documents, library, folder):
    rows = [*[(i * 2, t) for i, t in enumerate(ODD)], *[(1000 + i, f"text {i} " * (i % 40)) for i in range(120)], (7, None),
            (None, "no id"), (1000, "again"), (1001, f"text {1} "), (1001, f"text {1} ")]
    docs = documents(rows, extra=("ids", "t", "k0"))
    files = arrow_tokens.write_sequences(docs, folder, PATH, length=8)
    stream, ids, batches = [], [], 0
    for f in sorted(files.collect(), key=lambda f: f.file):
        s = arrow_tokens.Sequences(f"{folder}/{f.file}")
        total, batches = 0, max(batches, s.file.num_record_batches)
        for i in range(len(s)):
            row, mask = s[i]
            assert len(row) == 8 and len(mask) == 1 and not row.flags.owndata
            real = np.unpackbits(mask, bitorder="little").astype(bool)
            assert real.all() or i == len(s) - 1
            stream += row[real].tolist()
            total += int(real.sum())
        own = list(s.documents())
        assert (len(own), total) == (f.documents, f.tokens)
        ids += [d for d, _ in own]
        with pytest.raises(IndexError):
            s[len(s)]
    assert batches > 1
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert ids == [i for i, _ in sorted(rows, key=key)]
    got = arrow_tokens.read_documents(spark, folder, files).collect()
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, 0])
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        own = stream[at:at + r.n_tokens]
        assert r.start == at and own in want[r.doc_id]
        want[r.doc_id].remove(own)
        assert r.ids_crc32 == zlib.crc32(np.array(own, dtype="<u4").tobytes())
        at += r.n_tokens
    assert at == len(stream) and not any(want.values())


def test_views_are_into_the_mapped_file(spark, documents, folder):
    files = arrow_tokens.write_sequences(documents([(1, "word " * 3000)]), folder, PATH, length=128)
    s = arrow_tokens.Sequences(f"{folder}/{files.first().file}")
    before = pa.total_allocated_bytes()
    row, _ = s[3]
    assert pa.total_allocated_bytes() - before < 1000 and row.dtype == np.uint16


def test_empty_table(spark, documents, folder):
    files = arrow_tokens.write_sequences(documents([]), folder, PATH)
    assert files.count() == 0 and arrow_tokens.read_documents(spark, folder, files).count() == 0
