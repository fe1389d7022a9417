import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from texts, or from (doc_id, text[, lang, source]) rows."""
    def make(rows, extra=False):
        full = []
        for i, r in enumerate(rows):
            r = r if isinstance(r, tuple) else (i, r)
            r = (*r, *("en", "a")[len(r) - 2:])[:4] if len(r) < 4 else r[:4]
            full.append((*r, None if r[1] is None else len(r[1])))
        df = spark.createDataFrame(full, DOCS)
        # columns whose names the operators use inside
        return df.selectExpr("*", "1 AS okey", "'x' AS size", "2 AS n", "3 AS h", "'y' AS score", "4 AS spans", "5 AS part") if extra else df
    return make


@pytest.fixture
def words():
    import random
    rng = random.Random(5)
    stock = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(4000)]

    def make(n, seed):
        r = random.Random(seed)
        return " ".join(r.choice(stock) for _ in range(n))
    return make
