import random

import public_tokenizers
import pytest

import __spark_entry__ as E
import corpus_pipeline
from retainspark.llm import pieces, quality, queries

from .test_quality import BAD, plain_counts
from .test_simhash import plain_components, plain_fingerprint
from .test_substring import plain as plain_repeats

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A small corpus with junk, copies, a shared passage and benchmark text."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["ka", "mo", "ti", "ra", "no", "su", "el"]) for _ in range(rng.randint(1, 4)))
    line = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    prose = lambda n: "\n".join(line(rng.randint(8, 14)) for _ in range(n))
    item, passage = " ".join(word() for _ in range(15)), " ".join(word() for _ in range(60))
    docs = {i: prose(rng.randint(8, 20)) for i in range(40)}
    docs |= {100 + i: BAD.replace("item", f"it{i}x") for i in range(20)}
    docs |= {200: docs[3], 201: docs[3], 202: docs[5] + " ", 203: None, 204: "", 205: "short one"}
    docs |= {300 + i: f"{prose(6)} {passage} {prose(6)}" for i in range(3)}
    docs |= {400: f"{prose(8)} {item.upper()} {prose(4)}"}
    at = tmp_path_factory.mktemp("corpus")
    rows = [(i, t, "xx", "s", None if t is None else len(t)) for i, t in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    labels = [(i, int(i < 100), 0) for i in docs if i < 200 and i % 2]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, item), (2, line(12))], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at), docs, passage, item


def test_stages_are_what_they_should_be():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "substring dedup", "decontamination", "sentencepiece"]
    assert E.queries()["pipeline"] is corpus_pipeline.run
    assert {q.split("_")[0] for q in queries.QUERIES if q.startswith("op")} == {f"op{n}" for n in range(1, 14)}


def test_every_stage_against_brute_force(spark, tables):
    at, docs, passage, item = tables
    frame = spark.read.parquet(f"{at}/documents.parquet")
    model = quality.fit(frame, spark.read.parquet(f"{at}/labels.parquet"))
    good = {i: t for i, t in docs.items() if t and quality.judge([t.encode()], model)["kept"][0]}
    assert set(range(40)) | {200, 201, 202, 300, 301, 302, 400} == set(good)

    label = plain_components(sorted({plain_fingerprint(t.encode()) for t in good.values()}), 2)
    first = {}
    for i in sorted(good):
        first.setdefault(label[plain_fingerprint(good[i].encode())], i)
    one = {i: good[i] for i in first.values()}
    assert not {200, 201, 202} & set(one)

    gone = plain_repeats(list(one.items()), 20)
    cut = {}
    for i, t in one.items():
        kept = " ".join(w for w, g in zip(t.split(), gone[i, t]) if not g)
        cut[i] = kept if any(gone[i, t]) else t
    assert sum(passage in " ".join(t.split()) for t in cut.values()) == 1
    clean = {i: t for i, t in cut.items() if i != 400}

    want = [good, one, cut, clean]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        frame = stage(spark, frame, at)
        assert frame.columns == DOCUMENT
        rows = frame.collect()
        assert {r.doc_id: r.text for r in rows} == want[k]
        assert all(r.n_chars == len(r.text) for r in rows)
        frame = spark.createDataFrame(rows, frame.schema)

    out = corpus_pipeline.run(spark, at)
    model = public_tokenizers.path("piece_bpe_32k.model")
    got = pieces.decode_ids(out, model).collect()
    assert {r.doc_id: r.decoded for r in got} == clean
    assert len({(r.doc_id, r.ids) for r in got}) == len(got) == 2 * len(clean)


def test_contract_columns_of_the_fixed_queries(spark, tables):
    at, docs, _, _ = tables
    run = lambda name: {r.doc_id: r for r in E.queries()[name](spark, at).collect()}
    one = run("op1_crf_line_labels")
    for i, t in docs.items():
        assert all(one[i][c] == v for c, v in plain_counts(t or "").items()), i
        assert not (one[i].base_failed and one[i].kept)
    two = run("op2_simhash_pivots")
    prints = {i: plain_fingerprint((t or "").encode()) for i, t in docs.items()}
    label = plain_components(sorted(set(prints.values())), 2)
    for i, f in prints.items():
        assert two[i].fingerprint == f"{f:016x}"
        assert two[i].component_id == min(j for j, g in prints.items() if label[g] == label[f])
    nine = run("op9_crf_language")
    import zlib
    for i, r in nine.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.lang_pred == ("xx" if docs[i] and any(c.isalpha() for c in docs[i]) else "und")
    five = run("op5_rabin_karp_spans")
    gone = plain_repeats(list(docs.items()), 20)
    import hashlib
    for i, t in docs.items():
        kept = b" ".join(w for w, g in zip((t or "").encode().split(), gone[i, t]) if not g)
        assert (five[i].n_removed, five[i].kept_sha256) == (sum(gone[i, t]), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_empty_tables_and_odd_rows(spark, sf_dir, name, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row int, __id int, `a.b` int"
    long = " ".join(f"w{i}" for i in range(1000, 21000))
    words = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"w{i}" for i in range(500, 570))
    rows = [(1, words, "en", "s", 1, 1, 1, 1), (1, words, "en", "s", 1, 1, 1, 1), (None,) * 8, (3, "", "en", "s", 0, 1, 1, 1),
            (None, other, None, None, None, 2, 2, 2), (5, long, "en", "s", 9, 3, 3, 3)]
    empty = stage(spark, spark.createDataFrame([], schema), sf_dir)
    full = stage(spark, spark.createDataFrame(rows, schema).repartition(3), sf_dir)
    assert empty.collect() == [] and empty.columns == full.columns
    got = sorted((-1 if r.doc_id is None else r.doc_id) for r in full.collect())
    assert got == {"quality rules": [-1, 1, 1, 5], "near duplicates": [-1, -1, 1, 5], "substring dedup": [-1, 1, 1, 5],
                   "decontamination": [-1, -1, 1, 1, 3, 5]}.get(name, got)
    if name == "sentencepiece":
        assert set(got) == {-1, 1, 3, 5}
    else:
        assert full.columns == corpus_pipeline.COLUMNS
