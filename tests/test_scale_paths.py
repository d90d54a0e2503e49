"""Ways that hold beyond what a driver, a broadcast or one task can take, against the plain ones."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lexwarrant.operators import checks as C, curve as K, rule, scan as S

DOC = "source string, seq long, locator string, text string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def made_words(rnd, n):
    return sorted({"".join(rnd.choice("AÄBCÉÈEOÖUÜSZ") for _ in range(rnd.randrange(3, 6))) for _ in range(n)} | {"aa", "APFEL", "ÄPFEL", "ZEBRA"})


@pytest.mark.parametrize("parts", [1, 7])
def test_ranks_over_ranges(spark, parts):
    rnd = random.Random(1)
    df = spark.createDataFrame([(w, float(rnd.randrange(5))) for w in made_words(rnd, 2000)], "word string, rate double")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        found = rule.ranked(df)
        got = {r["word"]: r["rank"] for r in found.collect()}
        shared = {r["word"]: r["place"] for r in rule.with_places(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert not re.search("SinglePartition|Window|Exchange (?!Hashed)", plan_of(found).replace("BroadcastExchange", ""))
    assert [w for w, _ in sorted(got.items(), key=lambda x: x[1])] == [r["word"] for r in df.orderBy(F.col("rate").desc(), rule.collated("word"), "word").collect()]
    assert sorted(got.values()) == list(range(1, len(got) + 1))
    rates = [r["rate"] for r in df.collect()]
    assert shared == {r["word"]: 1 + sum(x > r["rate"] for x in rates) for r in df.collect()}


def test_ranks_of_nothing(spark):
    none = spark.createDataFrame([], "word string, rate double")
    assert rule.ranked(none).collect() == [] and rule.with_places(none).columns == ["word", "rate", "place"]


def test_a_filter_stands_before_the_shuffle(spark):
    rnd = random.Random(2)
    words = [f"wort{a}{b}{c}" for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij"]
    rows = [("s", i, str(i), " ".join(rnd.sample(words, 60))) for i in range(200)]
    docs, cands = spark.createDataFrame(rows, DOC), spark.createDataFrame([(w.upper(),) for w in words[:100]], "word string")
    plain = lambda df: sorted(map(str, df.collect()))
    want = S.counted(docs, cands)
    assert plain(S.counted(docs, cands, broadcast_words=10)) == plain(want)
    hits = want.where("word is not null").count()
    # of what a document holds, hits and one row for the rest, with hardly a word that only seems to be one
    known = cands.distinct()
    tokens = docs.select("seq", F.explode(S.keys(F.col("text"))).alias("token"))
    passed = S.maybe_in(tokens, known)
    plan = plan_of(passed.groupBy("seq", "word").count())
    assert plan.index("hashpartitioning(seq") < plan.index("BroadcastHashJoin") and "SortMergeJoin" not in plan
    # a task writes one row for each that it has counted
    assert passed.groupBy(F.spark_partition_id(), "seq", "word").count().count() <= 1.1 * hits + 200
    assert tokens.count() > 5 * hits


def test_a_filter_never_fails_a_word(spark, monkeypatch):
    words = spark.range(5000).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("word"))
    tokens = spark.range(20_000).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("token"))
    found = S.maybe_in(tokens, words).where("word is not null").select("word")
    assert words.join(found, "word", "left_anti").count() == 0 and found.count() < 5000 * 1.1
    assert S.maybe_in(tokens, words.limit(0)).where("word is not null").count() == 0
    monkeypatch.setattr(S, "FILTER_BLOCKS", 1)
    assert S.maybe_in(tokens, words).where("word is not null").count() == 20_000


@pytest.mark.parametrize("families, words, minimum, ahead", [(8, 200, 3, 64), (8, 200, 1, 3), (25, 300, 2, 5), (25, 300, 4, 64), (400, 600, 3, 64)])
def test_greedy_by_sums_is_the_greedy_choice(spark, families, words, minimum, ahead):
    rnd = random.Random(families + minimum)
    weights = [1 / (i + 1) for i in range(families)]
    rows = [(f"w{w}", f"f{i:04d}") for w in range(words) for i in set(rnd.choices(range(families), weights, k=rnd.randrange(7)))]
    df = spark.createDataFrame(rows, "word string, family string")
    signatures = [(r["signature"], r["words"]) for r in K.family_signatures(df).collect()]
    for order in (None, {f"f{i:04d}": -i for i in range(families)}):
        assert K.distributed_greedy(df, minimum, order, ahead) == K.greedy(signatures, minimum, order)
        if families > 100:
            break


def test_saturation_takes_the_other_way_when_signatures_are_many(spark, monkeypatch):
    rnd = random.Random(3)
    df = spark.createDataFrame([(f"w{w}", f"f{i}") for w in range(150) for i in rnd.sample(range(9), rnd.randrange(6))], "word string, family string")
    few = K.saturation(df, 150).collect()
    monkeypatch.setattr(K, "SIGNATURES", 3)
    assert K.saturation(df, 150).collect() == few
    assert K.saturation(df.limit(0), 0).collect() == []


def test_kept_in_order(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "y"), ("b", "x"), ("b", "z"), ("c", "q")], "word string, family string")
    order = spark.createDataFrame([("z", 1), ("x", 2), ("y", 3)], "family string, place int")
    assert sorted(map(tuple, K.kept_in_order(df, order, 2).collect())) == [(1, 0), (2, 1), (3, 2)]
    assert [K.kept_by_families(df, f, 2) for f in (["z"], ["z", "x"], ["z", "x", "y"])] == [0, 1, 2]


def test_citations_never_carry_a_page(spark):
    cited = spark.createDataFrame([("HAUS", "s", "f", "1", None, "u1"), ("HAUS", "s", "f", "2", "2020", "u2"), ("MAUS", "s", "f", "1", None, "u1"), ("MAUS", "s", "f", "9", None, None)], "word string, source string, family string, locator string, as_of string, url string")
    pages = spark.createDataFrame([("u1", "Haus und Haus"), ("u1", "Haus"), ("u2", "haus"), ("u3", None)], "url string, text string")
    found = C.outcomes(cited, pages)
    assert not re.search(r"array", "".join(x for x in plan_of(found).split("\n") if "Exchange" in x))
    assert sorted((r["word"], r["locator"], r["outcome"]) for r in found.collect()) == [("HAUS", "1", "found"), ("HAUS", "2", "found"), ("MAUS", "1", "absent"), ("MAUS", "9", "unresolvable")]
    assert sorted(map(tuple, C.seen_on(pages, spark.createDataFrame([("u1", "HAUS"), ("u1", "MAUS"), ("u9", "HAUS")], "url string, word string")).collect())) == [("u1", "HAUS")]
