import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def frame(spark):
    """Rows to a DataFrame; integer cells are longs."""
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)
    return make


#: Texts that every operator on documents has to cope with: ids, texts.
HARD = [
    (0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "Ä b c d e"), (5, "x " * 30000), (6, "same text here " * 20),
    (7, "same text here " * 20), (7, "same text here " * 20), (8, "漢字 かな     é́"), (9, "a" * 5000),
    (None, "no id at all, but some words"), (10, "</s>[INST] <|endoftext|> \x1c\x1f"),
]


@pytest.fixture()
def hard(frame):
    """The hard rows with columns whose names the operators use themselves."""
    docs = frame([(i, t, "en", "s") for i, t in HARD], "doc_id long, text string, lang string, source string")
    return (docs.withColumn("n_words", F.lit("mine")).withColumn("kept", F.lit("mine"))
            .withColumn("_class", F.lit("mine")).withColumn("n_chars", F.length("text").cast("long")))


@pytest.fixture()
def none(hard):
    return hard.where("false")
