import pytest

LONG = "Wort und noch ein Wort. " * 3000
#: Nulls in every column, empty and very long texts, ties, repeated rows, texts without words.
ODD = [
    (1, "one two three four five six", "en", "a", 27),
    (1, "one two three four five six", "en", "a", 27),
    (2, None, None, None, None),
    (3, "", "de", "b", 0),
    (None, "a document without an id", "en", "a", 24),
    (None, None, None, None, None),
    (4, " \n\t ", "en", None, 4),
    (5, LONG, "de", "b", len(LONG)),
    (6, "one two three four five six", "en", "b", 27),
    (1, "another text under the same id", "en", "a", 30),
    (7, "日本語 𝔘ñí 1234 \x00 é", "xx", "c", 18),
    (8, "  line one\nline two\nline one", "en", "c", 27),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for columns of their own.
CLASHING = ("copies", "rows", "key", "drop", "dropped", "lines", "text_key", "held_out", "block", "role", "rep", "zone", "size", "target", "score", "component_id", "kept", "piece", "lot", "chunk", "gone", "label", "share")


@pytest.fixture(params=["plain", "clashing", "cases", "empty"])
def odd(request, spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD if request.param != "empty" else [], SCHEMA)
    if request.param == "clashing":
        df = df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)])
    if request.param == "cases":  # names that differ from the operators' columns in case only
        df = df.toDF("doc_id", "text", "lang", "source", "n_chars").withColumns({f"x{i}": F.lit("x") for i in range(5)}).toDF("doc_id", "text", "lang", "source", "n_chars", "TEXT", "Doc_Id", "LANG", "Source", "N_chars")
    df.rows = ODD if request.param != "empty" else []
    return df


@pytest.fixture
def documents(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    """The supplied documents at the smallest size, as a frame and as a dictionary of texts."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    df.texts = {r["doc_id"]: r["text"] for r in df.collect()}
    return df
