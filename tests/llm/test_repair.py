import hashlib
import itertools
import random
import re
from collections import defaultdict

import pytest

from retainspark.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def brute(rows):
    """Cheapest edits by search over all of them, shortest cost first."""
    seen, kinds = set(), []
    counts = {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        core = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
        seen.add((role, text))
        kinds.append(fault)
        if fault:
            counts[fault] += 1
    best = None

    def options(i):
        role = rows[i][1]
        if kinds[i] not in ("blank", "duplicate"):
            extra = kinds[i] == "truncated"
            yield "K", (role,), extra
            yield "R", ("user",), 2 + extra
            yield "R", ("assistant",), 2 + extra
        yield "D", (), 3

    steps = [("I", ("user",), 2), ("I", ("assistant",), 2)]
    limit = 3 * len(rows)
    todo = [(0, "", (), 0)]
    while todo:
        i, letters, roles, cost = todo.pop()
        if cost > limit or not any(GRAMMAR.match("".join(r[:1] for r in roles) + more) for more in ("", "a", "ua")):
            continue
        if i == len(rows) and GRAMMAR.match("".join(r[:1] for r in roles)):
            best = min(best, (cost, letters, roles)) if best else (cost, letters, roles)
        if letters[-2:] != "II":
            todo += [(i, letters + a, roles + r, cost + c) for a, r, c in steps]
        if i < len(rows):
            todo += [(i + 1, letters + a, roles + r, cost + c) for a, r, c in options(i)]
    turns = [t for t, _, _ in rows if t is not None]
    cost, letters, _ = best
    parts, left, state = [], iter(rows), 0
    for a in letters:
        if a in "IR":
            role = "assistant" if state == 2 else "user"
            parts.append((role, "" if a == "I" else next(left)[2]))
        elif a == "K":
            parts.append(next(left)[1:])
        else:
            next(left)
            continue
        state = {"s": 1, "u": 2, "a": 3}[parts[-1][0][0]]
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, letters,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in parts).encode()).hexdigest())


def run(spark, rows, conversations=None, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    planned = repair.plans(df, conversations, **more)
    out = planned.join(repair.digests(df, planned).withColumnRenamed("conv_id", "c"), planned["conv_id"].eqNullSafe(repair.F.col("c")))
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in out.collect()}


def test_against_search_over_all_edits(spark):
    rnd, rows = random.Random(5), []
    texts = ["Yes.", "no", "A b!", " \t\n", "", "x? \n", "more", "Yes."]
    for c in range(160):
        for _ in range(rnd.randint(1, 5)):
            turn = rnd.choice([None, *range(9)])
            if any(r[0] == c and r[1] == turn for r in rows):
                continue
            rows.append((c, turn, rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", " "]), rnd.choice(texts) + rnd.choice(["", " "])))
    got = run(spark, rows, spill=2)
    want = defaultdict(list)
    for c, turn, role, text in rows:
        want[c].append((turn, role, text))
    for c, v in want.items():
        v.sort(key=lambda r: (r[0] is not None, r[0]))
        assert got[c] == brute(v), v


def test_special_rows(spark):
    long = [(9, i, "user" if i % 2 == 0 else "assistant", "word " * 3000 + f"{i}.") for i in range(300)]
    rows = [(1, 0, "user", "a."), (1, 0, "user", "a."), (1, 1, "assistant", "b."),
            (2, 0, None, None), (2, 5, "user", "q?"), (None, 0, "system", "s."), (None, 1, "user", "u."), (None, 2, "assistant", "v."),
            (4, None, "user", "a."), (4, 3, "user", "a."), (4, 4, "assistant", "b."), *long]
    names = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 9, None)], "conv_id long")
    got = run(spark, rows, names, spill=7)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1] == (0, 0, 1, 0, 1, 3, "KDK", sha("user:a.\nassistant:b."))
    assert got[2] == (4, 1, 0, 0, 1, 5, "DKI", sha("user:q?\nassistant:"))
    assert got[3] == (0, 0, 0, 0, 0, 0, "", sha(""))
    assert got[None] == (0, 0, 0, 0, 0, 0, "KKK", sha("system:s.\nuser:u.\nassistant:v."))
    assert got[4] == (0, 0, 1, 0, 1, 3, "KDK", sha("user:a.\nassistant:b."))
    assert got[9][5:] == (0, "K" * 300, sha("\n".join(f"{r}:{t}" for _, _, r, t in long)))


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "q?"), (1, 1, "user", "r?"), (1, 2, "tool", "t."), (2, 0, "assistant", "")]
    df = spark.createDataFrame([(*r, 7, 8) for r in rows], SCHEMA + ", key int, place int")
    planned = repair.plans(df)
    out = sorted(tuple(r) for r in repair.apply(df, planned).collect())
    audit = {r.conv_id: (r.audit, r.cost) for r in planned.collect()}
    assert audit == {1: ("KIKR", 4), 2: ("D", 3)}
    assert [r[1] for r in out] == list(range(len(out))) and [r[3][0] for r in out] == list("ua" * (len(out) // 2))


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    planned = repair.plans(df)
    assert planned.collect() == [] and repair.apply(df, planned).collect() == [] and repair.digests(df, planned).collect() == []


@pytest.mark.parametrize("n", [5, 6, 7])
def test_steps_stay_few(n):
    steps = repair.Steps()
    rnd, vector = random.Random(n), 0
    for _ in range(20000):
        _, vector, _ = steps.step(vector, rnd.randrange(9))
    assert len(steps.vectors) < 200 and len(steps.back) < 2000
