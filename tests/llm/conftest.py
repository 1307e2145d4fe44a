import pytest
from pyspark.sql import functions as F

LONG = "the quick brown fox jumps " * 4000


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls, empty and very long texts, repeated rows and clashing columns."""
    rows = [
        (1, "the cat sat on the mat and the dog ran", "en"),
        (2, "the cat sat on the mat and the dog ran", "en"),
        (2, "the cat sat on the mat and the dog ran", "en"),
        (3, None, None),
        (4, "", "en"),
        (None, "le chat est sur la table et le chien court", "fr"),
        (5, LONG, "en"),
        (6, "12 34 !!", None),
        (7, "one", "fr"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    clashing = ("score", "result", "kept_0", "key", "print", "rate", "p0", "spans", "h", "draw", "tie")
    return docs.withColumns({name: F.lit("x") for name in ("source", *clashing)}).withColumn(
        "n_chars", F.length("text").cast("long")
    )


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
