import pytest

from daygrid.llm.common import prepare

LONG = "word%d " * 3000


@pytest.fixture(scope="module")
def session(spark):
    return prepare(spark)


@pytest.fixture(scope="module")
def odd_docs(session):
    """Nulls, empty, blank, very long, repeated and odd texts, with columns whose names clash."""
    text = "Ab cd ef gh ij kl mn op qr st uv wx yz " * 2
    rows = [
        (1, None), (2, ""), (3, "  "), (4, text), (5, text.upper()), (6, text + "extra"), (7, "Short one"),
        (8, "short ONE"), (8, "short ONE"), (9, "x" * 5000), (10, " ".join(f"w{i}" for i in range(3000))),
        (11, " ".join(f"w{i}" for i in range(1, 3001))), (12, "ÄÖ  ß\t\nΣΣ ΑΣ İ é   x \n y"), (13, "1 2 3"),
        (14, "a <|endoftext|> b<|startoftext|>c  "), (15, "\U0001f600 \U0001f600\U0001f600 don't we'll"),
    ]
    full = [(i, t, None, "s", 0, "clash", 1.0, 2, "k") for i, t in rows]
    return session.createDataFrame(
        full, "doc_id long, text string, lang string, source string, n_chars long, name string, score double, length int, digest string"
    )


@pytest.fixture(scope="module")
def no_docs(odd_docs):
    return odd_docs.limit(0)
