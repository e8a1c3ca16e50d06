import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
TURNS = "conv_id long, turn long, role string, text string"
ITEMS = "item_id long, text string"
PROSE = "the cat of the house and the dog in the garden was with that man from the hill. "


def edge_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows."""
    long = " ".join(f"word{k % 997}x{k}" for k in range(60_000))
    texts = [None, "", " \t\n ", "one", "two words", PROSE * 4, PROSE * 4, PROSE * 4 + "tail", long, "A" * 50_000, "x\x00y   é ß 日本語 𠀀", PROSE.upper()]
    rows = [(k, t, "en", "src0", len(t or "")) for k, t in enumerate(texts)]
    return rows + [(5, texts[5], "en", "src0", len(texts[5])), (None, "no id here at all", None, None, None), (None, None, None, None, None), (100, texts[5], None, None, None)]


@pytest.fixture(scope="session")
def edge(spark):
    """The edge rows with further columns named like the operators' own."""
    docs = spark.createDataFrame(edge_rows(), DOCS)
    for name in ("n_words", "kept", "score", "row", "matches", "node", "place", "id", "word", "shard", "tie", "label", "redacted", "spans", "component_id"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sample(spark):
    """The smallest supplied documents."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
