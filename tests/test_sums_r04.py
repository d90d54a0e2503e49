"""Sums by source: what a scan gives without a second look at the counts of documents."""

from lexwarrant.operators import scan as S
from lexwarrant.plans import queries

COUNTS = "source string, seq long, locator string, word string, n long"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_locators_by_sums_are_the_first_distinct_ones(spark):
    # equal locators, equal and absent places, a null locator, one locator alone, and a word with many
    found = [("a", i, f"l{i % 7}", "W", 1) for i in range(40)] + [("a", 5, "same", "ONE", 1), ("a", 6, "same", "ONE", 2)]
    found += [("b", 1, x, "TIE", 1) for x in "zyxwv"] + [("b", None, "none", "NIL", 1), ("b", 9, "late", "NIL", 1), ("b", 3, "none", "NIL", 1), ("b", 4, "mid", "NIL", 1)]
    found += [("c", None, "q", "GONE", 1), ("c", 2, "r", "GONE", 1), ("c", 1, None, "GONE", 1), ("c", 7, "x", None, 5), ("d", 7, "x", None, 3)]
    counts = spark.createDataFrame(found, COUNTS)
    hits = counts.where("word is not null")
    scan = S.scan_of(counts, counts)
    assert rows(scan.totals) == [("a", 43), ("b", 9), ("c", 8), ("d", 3)]
    assert rows(scan.hits.select("source", "word", "locators")) == rows(S.sample_locators(hits))
    assert rows(scan.hits.select("source", "word", "count")) == rows(hits.groupBy("source", "word").agg({"n": "sum"}))


def test_hits_without_locators_read_sums_alone(spark):
    counts = spark.createDataFrame([("a", 1, "l1", "W", 2), ("a", 2, "l2", "W", 3)], COUNTS)
    scan = S.scan_of(counts, counts)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan(scan.hits.select("source", "word", "count")) and "locator" not in plan(scan.hits.select("source", "word", "count"))
    assert "Join" in plan(scan.hits)


def test_queries_of_a_session_share_the_sums(spark):
    d = "/root/testdata/sf0.001"
    assert queries._scan(spark, d) is queries._scan(spark, d)
    assert queries._scan(spark, d) is not queries._scan(spark, d, 0.25)


def test_scans_without_a_floor_shuffle_no_document(spark):
    docs = spark.createDataFrame([("a", 1, "l1", "one two two"), ("a", 2, "l2", "two xyz"), ("b", 3, "l3", None)], "source string, seq long, locator string, text string")
    words = spark.createDataFrame([("ONE",), ("TWO",)], "word string")
    plan = S.summed(S.found_words(docs, words))._jdf.queryExecution().executedPlan().toString()
    assert [x for x in plan.splitlines() if "hashpartitioning(source" in x] and not [x for x in plan.splitlines() if "Exchange" in x and "seq" in x]
    scan = S.scan(docs, words)
    assert rows(scan.hits.select("source", "word", "count", "locators")) == [("a", "ONE", 1, ["l1"]), ("a", "TWO", 3, ["l1", "l2"])]
    assert rows(scan.totals) == [("a", 5), ("b", 0)]


def test_more_bounds_than_are_broadcast_give_the_same(spark, monkeypatch):
    counts = spark.createDataFrame([("a", i, f"l{i}", "W", 1) for i in range(9)], COUNTS)
    monkeypatch.setattr(S, "BROADCAST_BOUNDS", 0)
    assert rows(S.scan_of(counts, counts).hits.select("source", "word", "count", "locators")) == [("a", "W", 9, ["l0", "l1"])]
