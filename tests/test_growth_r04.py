"""Steps of registered queries whose tasks once grew with the table."""

from pathlib import Path

from lexwarrant.plans import further
from lexwarrant.streaming import incremental as I

SF = Path("/root/testdata/sf0.001")


def test_words_that_are_no_candidates_leave_before_pages_are_counted(spark, tmp_path, monkeypatch):
    plans, append = [], I.commits.append

    def seen(rows, path, lost=None):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return append(rows, path, lost)

    monkeypatch.setattr(I.commits, "append", seen)
    pages = spark.createDataFrame([("u1", "x", "alpha beta alpha"), ("u2", "x", "gamma"), ("u3", "x", None), (None, "x", "beta")], "url string, domain string, text string")
    words = spark.createDataFrame([("ALPHA",), ("BETA",), (None,)], "word string")
    I.append_harvest(pages, words, str(tmp_path / "harvest"))
    got = {r["url"]: [tuple(w) for w in r["words"]] for r in I.harvested(spark, str(tmp_path / "harvest")).collect()}
    assert got == {"u1": [("ALPHA", 2), ("BETA", 1)], "u2": [], "u3": [], None: [("BETA", 1)]}
    assert any("Filter" in line and "_in" in line and "isnull(word" in line for line in plans[0].splitlines())


def test_parts_of_a_stream_have_as_many_files_as_the_table_has_splits(spark, tmp_path, monkeypatch):
    for p in SF.iterdir():
        if p.name != "documents.parquet":
            (tmp_path / p.name).symlink_to(p)
    docs = spark.read.parquet(str(SF / "documents.parquet")).limit(80)
    docs.repartition(8).write.parquet(str(tmp_path / "documents.parquet"))
    splits = spark.read.parquet(str(tmp_path / "documents.parquet")).rdd.getNumPartitions()
    asked, stream = [], I.document_stream
    monkeypatch.setattr(further.I, "document_stream", lambda spark, path, **more: asked.append(more["files"]) or stream(spark, path, **more))
    further._streamed(spark, str(tmp_path))
    assert splits > 2 and asked == [splits, splits]
