import pytest

SMALL = "/root/testdata/sf0.001"

#: (doc_id, text): null and blank texts, a null id, repeated rows, ties, one very long text.
EDGE_DOCS = [
    (1, None),
    (2, ""),
    (3, "  \n\t "),
    (4, "one"),
    (5, "One two three"),
    (None, "a text without an id, seven words"),
    (6, "the same row twice, word for word"),
    (6, "the same row twice, word for word"),
    (7, "tie"),
    (7, "another text under the same id"),
    (8, "é ß 日本語 x́ İ <|endoftext|> it's fine now  \x00 \x0b end "),
    (9, "long " * 30_000 + "tail"),
]


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Documents of awkward content with extra columns whose names the operators use inside."""
    rows = [(i, t, "x", "x", 1, 2, 3.0, "y", [1]) for i, t in EDGE_DOCS]
    schema = (
        "doc_id long, text string, lang string, part string, n long, component_id long, score double, key string, bands array<int>"
    )
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")


@pytest.fixture(scope="session")
def table(spark):
    return lambda name, folder=SMALL: spark.read.parquet(f"{folder}/{name}.parquet")
