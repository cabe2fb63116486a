import pytest

from retainspark.llm import preference

SCHEMA = "pair_id long, turn long, role string, text string"


@pytest.fixture
def fmt(spark):
    def run(chosen, rejected, extra=False):
        make = lambda rows: spark.createDataFrame([(*r, 0) for r in rows], SCHEMA + ", n int") if extra else spark.createDataFrame(rows, SCHEMA)
        return {r.pair_id: r for r in preference.format_preferences(make(chosen), make(rejected)).collect()}
    return run


def one(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def spans(mask, text):
    return [text[int(a):int(b)] for a, b in (s.split("-") for s in mask.split(",") if s)]


def test_prefix_completions_and_masks(fmt):
    c = [(1, 0, "user", "hi"), (1, 1, "assistant", "é1"), (1, 2, "user", "more"), (1, 3, "assistant", "good")]
    r = [*c[:2], (1, 2, "user", "more"), (1, 3, "assistant", "bad"), (1, 4, "user", "why"), (1, 5, "assistant", "😀x")]
    got = fmt(c, r, extra=True)[1]
    assert got.prompt == one("user", "hi") + one("assistant", "é1") + one("user", "more")
    assert (got.n_prompt, got.n_chosen, got.n_rejected) == (3, 1, 3)
    assert got.chosen == one("assistant", "good")
    assert spans(got.chosen_mask, got.chosen) == ["good<|im_end|>\n"]
    assert spans(got.rejected_mask, got.rejected) == ["bad<|im_end|>\n", "😀x<|im_end|>\n"]


def test_special_rows(fmt):
    long = [(6, i, "user" if i % 2 == 0 else "assistant", "x" * 300) for i in range(400)]
    c = [(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "user", "a"), (3, 0, None, None), (3, 1, "assistant", ""), (None, 0, "user", "lost"),
         (5, None, "system", "s"), (5, 0, "user", "q"), *long, (7, 0, "user", "a"), (7, 0, "user", "b")]
    r = [(2, 0, "user", "a"), (3, 0, "", ""), (4, 0, "assistant", "only"), (5, None, "system", "s"), (5, 0, "assistant", "q"), *long,
         (7, 0, "user", "a"), (7, 0, "user", "c")]
    got = fmt(c, r)
    assert set(got) == {1, 2, 3, 4, 5, 6, 7}
    assert (got[1].n_prompt, got[1].prompt, got[1].chosen, got[1].rejected) == (0, "", one("user", "a"), "")
    assert (got[2].n_prompt, got[2].chosen, got[2].rejected, got[2].chosen_mask) == (1, "", "", "")
    assert (got[3].n_prompt, got[3].n_chosen) == (1, 1) and spans(got[3].chosen_mask, got[3].chosen) == ["<|im_end|>\n"]
    assert (got[4].n_chosen, got[4].rejected) == (0, one("assistant", "only"))
    assert (got[5].n_prompt, got[5].chosen, got[5].rejected) == (1, one("user", "q"), one("assistant", "q"))
    assert (got[6].n_prompt, got[6].chosen) == (400, "") and len(got[6].prompt) == sum(len(one(x[2], x[3])) for x in long)
    assert (got[7].n_prompt, got[7].chosen, got[7].rejected) == (1, one("user", "b"), one("user", "c"))


def test_empty_tables(fmt):
    assert fmt([], []) == {}
    assert fmt([], [(1, 0, "assistant", "x")])[1].rejected_mask == "22-34"
