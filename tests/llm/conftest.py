import pytest


@pytest.fixture
def docs(spark):
    """Documents from ``(doc_id, text)`` pairs, with a column whose name the operators also use."""

    def make(rows):
        return spark.createDataFrame([(i, t, "x", i) for i, t in rows], "doc_id bigint, text string, rid string, row bigint")

    return make


@pytest.fixture
def tokenizer():
    pytest.importorskip("public_tokenizers")
    from tidebars.llm.tokens import default_tokenizer

    return default_tokenizer()
