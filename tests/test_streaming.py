from pyspark.sql import functions as F

from lexwarrant.operators import scan as S
from lexwarrant.streaming import incremental as I

DOC = "source string, seq long, locator string, text string"


def test_counts_follow_the_files(spark, tmp_path):
    docs, cands = str(tmp_path / "in"), spark.createDataFrame([("HAUS",), ("SCHADE",)], "word string")
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    batches = [[("a", 1, "1", "Haus Haus schade"), ("b", 1, "1", "Haus")], [("a", 2, "2", "Haus und"), ("c", 1, "1", "Katze")]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, DOC).coalesce(1).write.mode("append").parquet(docs)
        q = I.write_counts(I.stream_counts(I.document_stream(spark, docs), cands), out, mark)
        q.awaitTermination(120)
        assert q.exception() is None
    got = {(r["source"], r["word"]): r["n"] for r in spark.read.parquet(f"{out}/epoch=1").collect()}
    whole = spark.read.parquet(docs)
    assert got == {(r["source"], r["word"]): r["count"] for r in S.scan(whole, cands).hits.collect()}


def test_only_scanned_sources_are_replaced(spark, tmp_path):
    cands, path = spark.createDataFrame([("HAUS",)], "word string"), str(tmp_path / "evidence")
    scan = lambda rows: S.scan(spark.createDataFrame(rows, DOC), cands)
    I.record(scan([("a", 1, "1", "Haus"), ("b", 1, "1", "Haus Haus")]), path)
    I.record(scan([("b", 1, "9", "Haus Haus Haus")]), path)
    found = I.recorded(spark, path)
    assert {r["source"]: (r["count"], r["locators"]) for r in found.hits.collect()} == {"a": (1, ["1"]), "b": (3, ["9"])}
    assert {r["source"]: r["tokens"] for r in found.totals.collect()} == {"a": 1, "b": 3}


def test_harvest_resumes(spark, tmp_path):
    cands, path = spark.createDataFrame([("HAUS",)], "word string"), str(tmp_path / "harvest")
    page = "url string, domain string, text string"
    I.append_harvest(spark.createDataFrame([("u1", "x.de", "Haus Haus Tür"), ("u2", "x.de", "")], page), cands, path)
    done = I.harvested(spark, path)
    assert {r["url"]: [(w["word"], w["n"]) for w in r["words"]] for r in done.collect()} == {"u1": [("HAUS", 2)], "u2": []}
    found = spark.createDataFrame([("u1",), ("u3",), ("u3",)], "url string")
    assert [r["url"] for r in I.new_pages(found, done).collect()] == ["u3"]


def test_stream_of_pages_has_each_address_once(spark, tmp_path):
    folder = str(tmp_path / "pages")
    spark.createDataFrame([("u1", 1), ("u1", 2), ("u2", 3)], "url string, n long").withColumn("fetched", F.timestamp_seconds("n")).write.parquet(folder)
    stream = spark.readStream.schema("url string, n long, fetched timestamp").parquet(folder)
    q = I.deduplicated_stream(stream).writeStream.format("memory").queryName("pages").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r["url"] for r in spark.sql("SELECT url FROM pages").collect()) == ["u1", "u2"]
    totals = I.stream_totals(spark.createDataFrame([("a", 1, "1", "Haus ab"), ("a", 2, "2", None)], DOC))
    assert totals.first()["tokens"] in (1, 0)
