import pytest

from modelweave.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(name="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = [f"{a}{b}{c}" for a in ("ba", "ko", "mi", "tu") for b in ("la", "ne", "ro", "si", "va") for c in ("d", "m", "n", "rt", "st", "x")]


def words(random, n):
    return " ".join(random.choice(VOCABULARY) for _ in range(n))


def frame(spark, rows, schema=DOCS):
    """Rows of (doc_id, text) or (doc_id, text, lang) as documents."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1]) if r[1] else 0) for r in rows]
    return spark.createDataFrame(full, schema)
