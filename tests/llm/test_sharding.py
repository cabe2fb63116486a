import random

import pytest

from retainspark.llm import sharding


def check(docs, shards=16, **more):
    rows = sharding.shard_by_bytes(docs, shards=shards, **more).collect()
    assert len(rows) == docs.count()
    rows.sort(key=lambda r: (r.shard, r.slot))
    for s in range(shards):
        assert [r.slot for r in rows if r.shard == s] == list(range(sum(r.shard == s for r in rows)))
    assert all(r["size"] == len((r.text or "").encode()) + 1 for r in rows)
    ids = [(r.doc_id is not None, r.doc_id or 0) for r in rows]
    assert ids == sorted(ids)
    return rows


def expected(rows, shards):
    """A row belongs where it starts among all bytes."""
    total, at, out = sum(r["size"] for r in rows), 0, []
    for r in rows:
        out.append(at * shards // total)
        at += r["size"]
    return out


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_rows_lie_where_they_start(documents, shards):
    rng = random.Random(shards)
    docs = documents([(rng.randrange(-2**63, 2**63), "é" * rng.randrange(400)) for _ in range(300)])
    rows = check(docs, shards)
    assert [r.shard for r in rows] == expected(rows, shards)


def test_hot_ids_equal_rows_nulls_and_extra_columns(documents):
    docs = documents([(5, "same text")] * 120 + [(7, f"t{i}") for i in range(120)] + [(None, None)] * 60 + [(9, "x" * 20_000)],
                     extra=("shard", "slot", "size", "c0", "__key"))
    rows = check(docs)
    assert [r.shard for r in rows] == expected(rows, 16)
    assert rows[0].c0 == 0 and rows[0]["__key"] == 0


def test_tolerance_is_met_with_fewer_rounds(documents, monkeypatch):
    rounds = []
    probe = sharding._probe
    monkeypatch.setattr(sharding, "_probe", lambda *a: rounds.append(1) or probe(*a))
    docs = documents([(i * 1000, "x" * 99) for i in range(640)])
    rows = check(docs, 4, tolerance=1600)
    fewer, rounds[:] = len(rounds), []
    sizes = [sum(r["size"] for r in rows if r.shard == s) for s in range(4)]
    assert max(sizes) - min(sizes) <= 2 * 1600
    check(docs, 4)
    assert fewer <= len(rounds)


def test_empty_table_and_fewer_rows_than_shards(documents):
    assert check(documents([])) == []
    assert len({r.shard for r in check(documents([(1, "a"), (2, "b")]))}) == 2


@pytest.mark.parametrize("range_bytes", [200, 5000])
def test_shards_do_not_depend_on_the_ranges(documents, range_bytes):
    rng = random.Random(7)
    rows = [(rng.randrange(-2**63, 2**63), "y" * rng.randrange(300)) for _ in range(400)]
    rows += [(2**63 - 1, "last")] * 40 + [(-2**63, None)] * 40 + [(3, "z" * 60)] * 300
    docs = documents(rows)
    got = check(docs, 3, range_bytes=range_bytes)
    assert [r.shard for r in got] == expected(got, 3)
    parts = sharding.shard_by_bytes(docs, 3, range_bytes=range_bytes).rdd.glom().map(lambda p: sum(r["size"] for r in p)).collect()
    assert max(parts) <= range_bytes + 301  # a range's rows and none else are in its task


def test_few_probes_find_the_same_splitters(documents, monkeypatch):
    docs = documents([(i % 50, "x" * (i % 97)) for i in range(500)])
    want = [(r.doc_id, r.text, r.shard, r.slot) for r in check(docs, 8, range_bytes=500)]
    monkeypatch.setattr(sharding, "ALL_PROBES", 200)
    assert [(r.doc_id, r.text, r.shard, r.slot) for r in check(docs, 8, range_bytes=500)] == want
