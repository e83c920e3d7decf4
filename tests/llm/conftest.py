import os

import pytest

from quarry.sources.tables import table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small(spark):
    if not os.path.isdir(SMALL):
        pytest.skip("no test tables")
    return lambda name: table(spark, SMALL, name)


def frame(spark, texts, extra=True):
    """(doc_id, text) rows with columns of clashing names beside them."""
    rows = [(i, t) for i, t in (texts.items() if isinstance(texts, dict) else enumerate(texts))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:
        from pyspark.sql import functions as F
        for name in ("id", "label", "band", "n_words", "spans", "piece"):
            docs = docs.withColumn(name, F.lit("x"))
    return docs


ODD = {0: None, 1: "", 2: " \n\t ", 3: "one", 4: "word " * 3000, 5: "x" * 70_000, 6: "a b ́c \U0001f642 ÀÉ"}
