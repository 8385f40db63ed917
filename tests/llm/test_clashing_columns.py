"""Stages that return documents leave every column as it is, whatever its name."""

import pytest
from helpers import edge_docs, same_rows

from lexigrove.llm.decontamination import remove_contaminated
from lexigrove.llm.mixing import mix_documents
from lexigrove.llm.near_dedup import drop_near_duplicates
from lexigrove.llm.toxicity import drop_toxic


@pytest.fixture
def docs(spark):
    return edge_docs(spark)


def test_decontamination(spark, docs):
    items = spark.createDataFrame([(1, "same text here twice over the lazy dog again"), (2, "one")], "item_id long, text string")
    out = remove_contaminated(docs, items, size=5)
    assert same_rows(out, docs) and 0 < out.count() < docs.count()
    cut = remove_contaminated(docs, items, size=5, mode="spans")
    assert cut.columns == docs.columns and same_rows(cut.drop("text"), docs.drop("text")) and cut.count() == docs.count()


def test_mixing(docs):
    out = mix_documents(docs)
    assert same_rows(out, docs, times=3) and out.count() > 0


def test_toxicity(spark, docs):
    labels = spark.createDataFrame([(i, int(i == 9)) for i in range(11)], "doc_id long, toxic int")
    assert same_rows(drop_toxic(docs, labels), docs)


def test_near_dedup(docs):
    assert same_rows(drop_near_duplicates(docs), docs)
