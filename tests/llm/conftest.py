import pytest

EXTRA = ", size long, part string, kind string, fp string, quality string, cell int, hashes string, k string"


@pytest.fixture()
def make(spark):
    """Documents from (doc_id, text[, source]) rows, with extra columns whose names the operators use inside."""

    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 7, "p", "q", "r", "s", 1, "h", "k") for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long" + EXTRA)

    return build


@pytest.fixture(scope="session")
def words():
    import random

    rng = random.Random(3)
    return lambda n, size=400: " ".join(f"w{rng.randrange(size)}" for _ in range(n))
