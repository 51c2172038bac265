import pytest

CLASHES = "score double, secrets string, v string, c int, bucket int, key string, place int, h int, y int"
DOCS = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHES}"


def doc(doc_id, text, lang="en", source="a"):
    n = None if text is None else len(text)
    return (doc_id, text, lang, source, n, 1.0, "x", "x", 1, 1, "x", 1, 1, 1)


LONG = " ".join(f"word{i}" for i in range(60_000))

#: Nulls, empty and odd texts, repeated rows and ids, one very long text.
EDGES = [
    doc(1, None),
    doc(2, "", lang=None, source=None),
    doc(3, " \t\n\r\x0b\x0c "),
    doc(4, "one"),
    doc(5, "the cat sat on the mat and it was not the only cat there"),
    doc(5, "the cat sat on the mat and it was not the only cat there"),
    doc(None, "the cat sat on the mat and it was not the only cat there"),
    doc(None, None, lang=None, source=None),
    doc(7, "\U0001f600 \U0001f600 naïve ŒUVRE   x"),
    doc(8, LONG, source="b"),
    doc(9, "!!! ??? ### %%%"),
]


@pytest.fixture(scope="session")
def docs_of(spark):
    return lambda rows: spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def edges(docs_of):
    return docs_of(EDGES)


@pytest.fixture(scope="session")
def nothing(docs_of):
    return docs_of([])


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"
