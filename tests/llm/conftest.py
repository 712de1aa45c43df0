import pytest

from foldwright.llm.shipping import ship_code

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_code(spark)


@pytest.fixture()
def documents(spark):
    """Makes a documents table of (doc_id, text, lang, source) rows, with an extra column of a clashing name."""

    def make(rows, parts=3, extra=("size", "score", "key", "label")):
        from pyspark.sql import functions as F

        full = [(*(list(r) + [None] * (4 - len(r))), None) for r in rows]
        table = spark.createDataFrame(full, DOCUMENT).repartition(parts)
        return table.withColumns({name: F.lit("own") for name in extra})

    return make
