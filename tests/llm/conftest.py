import pytest
from helpers_llm import prose

from sessionloom.llm.shipping import ship_package

@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def edge_docs(spark):
    """Nulls, empty, blank and repeated texts, missing ids, and columns with clashing names."""
    text = prose(3)
    rows = [
        (1, text), (2, text), (2, text), (None, text), (3, None), (4, ""), (5, " \n\t "), (6, "one two"),
        (7, prose(5)), (8, None), (None, None), (9, prose(11, 3000)),
    ]
    return spark.createDataFrame(
        [(i, t, "x", "y", -1, "z") for i, t in rows],
        "doc_id long, text string, row string, kept string, n_words int, component_id string",
    )


@pytest.fixture
def no_docs(edge_docs):
    return edge_docs.where("false")
