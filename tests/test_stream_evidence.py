import random

import pytest

from lexwarrant.operators import rule, scan as S
from lexwarrant.streaming import evidence as E, incremental as I

DOC = "source string, seq long, locator string, text string"


def documents():
    """Documents of few words in many sources; locators that come again, out of order, in other batches."""
    rnd = random.Random(6)
    vocabulary = ["Haus", "Maus", "Straße", "und", "ab", "Tür", "Weg", "Zug"]
    rows = [(f"s{rnd.randrange(5)}", i, f"l{rnd.randrange(40)}", rnd.choice([None, "", " ".join(rnd.choice(vocabulary) for _ in range(6))]) if i % 9 == 0 else " ".join(rnd.choice(vocabulary) for _ in range(6))) for i in range(120)]
    rnd.shuffle(rows)
    return rows


def run(spark, tmp_path, docs, cands, sources):
    changes = E.evidence_changes(I.document_stream(spark, f"{tmp_path}/in", files=1), cands, sources)
    q = E.write_changes(changes, f"{tmp_path}/out", f"{tmp_path}/mark")
    q.awaitTermination(300)
    assert q.exception() is None


@pytest.mark.parametrize("cuts", [[], [1, 2, 60], [40, 80]])
def test_any_batches_give_what_a_scan_gives(spark, tmp_path, cuts):
    rows, cands = documents(), spark.createDataFrame([(w,) for w in ("HAUS", "STRASSE", "TÜR", "WEG", "NIE")], "word string")
    sources = spark.createDataFrame([("s0", "f"), ("s1", "f"), ("s2", "g")], "id string, family string")
    for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        spark.createDataFrame(rows[a:b], DOC).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        if k != 1:  # two files for one run, and a new query for each other: the state comes from the checkpoint
            run(spark, tmp_path, rows, cands, sources)
    run(spark, tmp_path, rows, cands, sources)
    whole = S.scan(spark.createDataFrame(rows, DOC), cands)
    plain = lambda df: sorted((r["word"], r["source"], r["count"], tuple(r["locators"])) for r in df.collect())
    found = E.current_evidence(spark, f"{tmp_path}/out")
    assert plain(found) == plain(whole.hits)
    attested = rule.with_family(whole.hits, sources.selectExpr("*", "true AS ranks"))
    want = {r["word"]: r["families"] for r in rule.independence(cands, attested).collect() if r["families"]}
    assert {r["word"]: r["families"] for r in E.current_independence(spark, f"{tmp_path}/out").collect()} == want
    assert {(r["source"], r["family"]) for r in found.collect()} == {("s0", "f"), ("s1", "f"), ("s2", "g"), ("s3", "s3"), ("s4", "s4")}


def test_first_places_in_parts_are_those_of_the_whole():
    rnd = random.Random(7)
    for _ in range(300):
        rows = [(rnd.randrange(12), f"l{rnd.randrange(6)}") for _ in range(rnd.randrange(12))]
        k = rnd.randrange(len(rows) + 1)
        assert E.first_places(E.first_places([], rows[:k]), rows[k:]) == E.first_places([], rows)


def test_without_sources_and_without_documents(spark, tmp_path):
    cands = spark.createDataFrame([("HAUS",)], "word string")
    spark.createDataFrame([("a", 1, "x", None)], DOC).write.parquet(f"{tmp_path}/in")
    run(spark, tmp_path, [], cands, None)
    spark.createDataFrame([("a", 2, "y", "Haus Haus")], DOC).write.mode("append").parquet(f"{tmp_path}/in")
    run(spark, tmp_path, [], cands, None)
    assert [tuple(r) for r in E.current_evidence(spark, f"{tmp_path}/out").collect()] == [("HAUS", "a", "a", 2, ["y"])]
