import pytest
from pyspark.sql import functions as F


@pytest.fixture
def documents(spark):
    """Rows with nulls, empty texts, repeats, a long text, and columns that clash with internal names."""

    def make(rows):
        plain = spark.createDataFrame(
            [(d, t, lang, s) for d, t, lang, s in rows], "doc_id bigint, text string, lang string, source string"
        )
        clashing = ["size", "key", "node", "copies", "taken", "h", "n", "a", "b", "component", "score", "held_out"]
        return plain.select("*", *[F.lit("x").alias(c) for c in clashing])

    return make
