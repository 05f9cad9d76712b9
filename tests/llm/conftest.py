import pytest
from brute import edge_texts, sentence


@pytest.fixture(scope="session")
def docs(spark):
    """The edge texts, a repeated row, an id with two texts, a null id, and columns with clashing names."""
    rows = list(enumerate(edge_texts())) + [(9, sentence(2, 60) + " " + sentence(3, 12)), (10, "another text of id ten"), (None, sentence(6, 50)), (None, None)]
    rows = [(i, t, ["en", None, "fr"][k % 3], k, k, "x", 1.0) for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words long, row long, set string, score double")
    return df.repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
