import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A small documents table from (id, text) pairs."""
    def make(rows, extra=()):
        cells = [(i, t, "en", "s", None if t is None else len(t), *(0 for _ in extra)) for i, t in rows]
        schema = ", ".join([SCHEMA, *[f"`{c}` int" for c in extra]])
        return spark.createDataFrame(cells, schema).repartition(3)
    return make


@pytest.fixture
def words():
    """``words(n, k)``: n different words, starting at the k-th."""
    return lambda n, k=0: " ".join(f"w{i}" for i in range(k, k + n))
