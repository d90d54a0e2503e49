"""What meets a stream's state are sums by source, not words; places are kept without text in any exchange."""

import random

from pyspark.sql import functions as F

from lexwarrant.streaming import evidence as E, incremental as I

DOC = "source string, seq long, locator string, text string"


def test_first_places_in_columns_are_those_of_lists(spark):
    rnd = random.Random(5)
    rows = [[(rnd.randrange(12), f"l{rnd.randrange(6)}") for _ in range(rnd.randrange(9))] for _ in range(60)]
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, p array<struct<seq:bigint,locator:string>>")
    found = {r["i"]: [tuple(x) for x in r["p"]] for r in frame.select("i", E._first(F.col("p")).alias("p")).collect()}
    assert found == {i: E.first_places([], r) for i, r in enumerate(rows)}


def test_only_sums_meet_the_state(spark, tmp_path, monkeypatch):
    """Many documents of one word give a batch one row a source, and changes go on from the state of the batch before."""
    met, merged = [], E._merged
    monkeypatch.setattr(E, "_merged", lambda held, new: met.append((held.count(), new.count())) or merged(held, new))
    candidates = spark.createDataFrame([("HAUS",)], "word string")
    sources = spark.createDataFrame([("a", "f"), ("b", "f")], "id string, family string")
    for first in (0, 400):
        rows = [("ab"[i % 2], first + 399 - i, f"l{(first + 399 - i) // 4}", "Haus und Haus" if i else None) for i in range(400)]
        spark.createDataFrame(rows, DOC).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        run = E.write_changes(E.evidence_changes(I.document_stream(spark, f"{tmp_path}/in"), candidates, sources), f"{tmp_path}/out", f"{tmp_path}/mark")
        run.awaitTermination(300)
        assert run.exception() is None
    assert met == [(0, 2), (2, 2)]
    found = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").where("epoch = 1").select("word", "source", "family", "count", "locators", "families").collect())
    assert found == [("HAUS", "a", "f", 796, ["l0", "l1"], 1), ("HAUS", "b", "f", 800, ["l0", "l1"], 1)]
    assert sorted(p.name for p in (tmp_path / "mark/evidence").iterdir() if p.name[0] != ".") == ["epoch=0", "epoch=1"]


def test_independence_cuts_texts_once(spark, tmp_path, monkeypatch):
    from lexwarrant.plans import queries

    from .compare import differences

    monkeypatch.setattr(E.S, "first_located", lambda _: (_ for _ in ()).throw(AssertionError("places of independence")))
    query, sql = queries.REGISTRY["streamed_independence"]
    assert differences(query(spark, "/root/testdata/sf0.001"), sql, "/root/testdata/sf0.001") == ([], [])
