"""Crawl files and greedy choice: tasks that keep their size, and one pass over the attestations."""

from pathlib import Path

from lexwarrant.operators import curve as K
from lexwarrant.plans import further, queries

SF = Path("/root/testdata/sf0.001")


def test_crawl_has_as_many_files_as_the_table_has_splits(spark, tmp_path, monkeypatch, request):
    for p in SF.iterdir():
        if p.name != "documents.parquet":
            (tmp_path / p.name).symlink_to(p)
    spark.read.parquet(str(SF / "documents.parquet")).limit(80).repartition(16).write.parquet(str(tmp_path / "documents.parquet"))
    # small files are put together, up to this size
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.files.maxPartitionBytes"))
    splits = spark.read.parquet(str(tmp_path / "documents.parquet")).rdd.getNumPartitions()
    seen, read = [], queries.X.crawl_documents
    monkeypatch.setattr(queries.X, "crawl_documents", lambda spark, path: seen.append(len(spark.read.parquet(path).inputFiles())) or read(spark, path))
    queries.crawl_sample_locators(spark, str(tmp_path)).count()
    assert splits > 5 and seen == [splits]


def test_attestations_are_made_once_for_the_greedy_choice(spark):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = [(f"w{i}", f"f{j}") for i in range(10) for j in range(3)]
    found = spark.createDataFrame(rows, "word string, family string").mapInArrow(count, "word string, family string")
    assert K.distributed_greedy(found) == [("f0", 0, 0), ("f1", 0, 0), ("f2", 10, 10)]
    assert made.value == len(rows)


def test_many_families_ask_for_no_counts_by_document(spark, monkeypatch):
    monkeypatch.setattr(further, "_counts", None)
    assert further._many_families(spark, str(SF)).count() > 0
