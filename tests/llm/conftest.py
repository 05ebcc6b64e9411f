import pytest


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with extra columns whose names clash with internal ones."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "x", 1, "k") for i, t in rows],
            "doc_id bigint, text string, rk string, n_words int, _lx_rk string")
    return make


EDGE_ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, "one two three four five six"),
    (None, None), (5, "one two three four five six"), (5, "one two three four five six"),
    (6, "ONE two three four five six"), (7, "é ü \U0001f600 ß " * 40), (8, "word " * 30000),
    (9, " ".join(f"w{i}" for i in range(400))), (10, " ".join(f"w{i}" for i in range(400))),
    (11, " ".join(f"w{i}" for i in range(399)) + " changed"), (12, "a\x00b  c\r\nd\x1fe"),
]


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    return make_docs(EDGE_ROWS)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])


@pytest.fixture(scope="session")
def edge_rows():
    return EDGE_ROWS
