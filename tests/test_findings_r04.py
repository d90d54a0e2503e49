"""Tables on which registered queries once differed from their SQL counterparts."""

from pathlib import Path

import pytest

from pyspark.sql.types import StringType, StructField, StructType

from lexwarrant.functions.text import LETTERS, fold, own_letters
from lexwarrant.operators.scan import word_counts
from lexwarrant.plans import queries
from lexwarrant.sources import formats

from .compare import TABLES, differences

SF = Path("/root/testdata/sf0.001")


def tables(spark, folder, documents, benchmark=("alpha",)):
    """A folder of tables: documents (source, text) and texts of the benchmark; the others are the supplied ones."""
    for t in TABLES:
        if t not in ("documents", "benchmark"):
            (folder / f"{t}.parquet").symlink_to(SF / f"{t}.parquet")
    rows = [(i, text, "xx", source, len(text)) for i, (source, text) in enumerate(documents)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(list(enumerate(benchmark)), "item_id long, text string").coalesce(1).write.parquet(str(folder / "benchmark.parquet"))
    return str(folder)


def same(spark, name, folder):
    query, sql = queries.REGISTRY[name]
    assert differences(query(spark, folder), sql, folder) == ([], [])


@pytest.mark.parametrize("thin", [0, 2, 5, 7])
def test_conformance_of_few_or_no_thin_words(spark, tmp_path, thin):
    words = [f"thin{c}" for c in "abcdefg"[:thin]]
    docs = [(f"src{i}", "alpha") for i in range(3)] + [("src1", w) for w in words]
    folder = tables(spark, tmp_path, docs, ["alpha", *words])
    same(spark, "conformance_failures", folder)
    found = {r["check"]: r["detail"] for r in queries.REGISTRY["conformance_failures"][0](spark, folder).collect()}
    assert (found["every shipped word has 3 independent sources"] is None) == (thin == 0)


def test_order_of_words_that_differ_by_marks(spark, tmp_path):
    words = "COÍQUE ÇOIQUE ÇOÍQUE COIQUE NÉE ÑEÉ ÑEE ONÈ ONÉ ONÊ L'AB L’AA"
    folder = tables(spark, tmp_path, [("src1", words), ("src2", words)], [words])
    for name in ("words_in_order", "drop_order"):
        same(spark, name, folder)
    (tmp_path / "kept").mkdir()
    folder = tables(spark, tmp_path / "kept", [(f"src{i}", words) for i in range(3)], [words])
    same(spark, "kept_order", folder)


def test_ranges_stay_few_and_of_the_kind_asked_for(tmp_path):
    for ending in formats.LEIPZIG_KINDS.values():
        with (tmp_path / f"x-{ending}").open("wb") as file:
            file.truncate(1 << 30)
    reader = lambda **more: formats.Leipzig({"path": str(tmp_path), "splitBytes": str(1 << 16), **more}).reader(StructType([StructField("key", StringType())]))
    links = reader(kind="links").partitions()
    assert len(links) <= formats.MOST_RANGES + 1 and {p.files[p.file][0].rpartition("-")[2] for p in links} == {"inv_so.txt"}
    assert sum(p.end - p.start for p in links) == 1 << 30 and len(links[0].files) == 3
    assert len(reader().partitions()) <= formats.MOST_RANGES + 3


def test_words_of_all_documents_are_counted_in_one_shuffle(spark):
    docs = spark.createDataFrame([("a", 1, "x", "one two two"), ("b", 2, "y", "two ısı")], "source string, seq long, locator string, text string")
    counts = word_counts(docs, "tr", by=())
    assert counts._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") == 1
    assert {tuple(r) for r in counts.collect()} == {("ONE", 1), ("TWO", 3), ("ISI", 1)}
    assert {tuple(r) for r in word_counts(docs, by=("source",)).where("word = 'TWO'").collect()} == {("a", "TWO", 2), ("b", "TWO", 1)}


def test_languages_with_the_same_own_letters_share_a_fold(spark):
    assert own_letters("ÆØÅ") == own_letters(LETTERS["no"]) == "Å" and own_letters(LETTERS["sr"]) == ""
    df = spark.createDataFrame([(w,) for w in ("ångström", "señor", "façade", "été", "Straße")], "word string")
    by_letters = {}
    for tag in ("da", "no", "es", "gl", "fr", "sw", "ca", "pt"):
        keys = [r[0] for r in df.select(fold(df.word, tag)).collect()]
        assert by_letters.setdefault(own_letters(LETTERS[tag]), keys) == keys
    assert len(by_letters) == 4
