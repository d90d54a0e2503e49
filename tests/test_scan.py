import pytest
from pyspark.sql import functions as F

from lexwarrant.functions.text import fold, keys, nfc
from lexwarrant.operators import scan as S

WORDS = ["SCHADE", "HAUS", "MÄDCHEN", "ABSEITS"]


def run(spark, texts, floor=0.0):
    docs = spark.createDataFrame([("s", i, loc, t) for i, (loc, t) in enumerate(texts)], "source string, seq long, locator string, text string")
    cands = spark.createDataFrame([(w,) for w in WORDS], "word string")
    found = S.scan(docs, cands, floor)
    return {r["source"]: r["tokens"] for r in found.totals.collect()}, {r["word"]: (r["count"], r["locators"]) for r in found.hits.collect()}


@pytest.mark.parametrize(
    "texts, tokens, word, expected",
    [
        ([("1", "Schade, schade."), ("2", "Wirklich schade!")], 4, "SCHADE", (3, ["1", "2"])),
        ([("1", "schade schade schade"), ("2", "schade"), ("3", "schade")], 5, "SCHADE", (5, ["1", "2"])),
        ([(str(i), "haus") for i in range(4)], 4, "HAUS", (4, ["0", "1"])),
        ([("1", "er is am Haus zu")], 1, "HAUS", (1, ["1"])),
        ([("1", "mädchen MÄDCHEN Mädchen")], 3, "MÄDCHEN", (3, ["1"])),
        ([("1", "Mädchen")], 1, "MÄDCHEN", (1, ["1"])),
    ],
)
def test_counts(spark, texts, tokens, word, expected):
    totals, hits = run(spark, texts)
    assert totals == {"s": tokens}
    assert hits[word] == expected


def test_only_candidates_are_hits(spark):
    assert run(spark, [("1", "Katze Hund Schade")]) == ({"s": 3}, {"SCHADE": (1, ["1"])})


def test_illegible_documents_go_whole(spark):
    texts = [("good", "schade haus okay schade haus"), ("noise", "schade qwe rty uio asd fgh")]
    assert run(spark, texts, 0.35) == ({"s": 5}, {"SCHADE": (2, ["good"]), "HAUS": (2, ["good"])})
    assert run(spark, texts)[0] == {"s": 11}


def test_a_source_without_words_has_a_total(spark):
    assert run(spark, [("1", ""), ("2", None), ("3", "ab cd")], 0.35) == ({"s": 0}, {})


def test_by_domain(spark):
    pages = spark.createDataFrame([(1, "https://blog.example.co.uk/a", "Haus Haus"), (2, "https://www.example.co.uk/b", "Haus"), (3, "https://x.org/", "Schade")], "seq long, locator string, text string")
    cands = spark.createDataFrame([(w,) for w in WORDS], "word string")
    found = {(r["source"], r["word"]): r["count"] for r in S.scan_by_domain(pages, cands).hits.collect()}
    assert found == {("web:example.co.uk", "HAUS"): 3, ("web:x.org", "SCHADE"): 1}


def test_merge_takes_the_last_total(spark):
    one = S.Scan(spark.createDataFrame([("a", 5)], "source string, tokens long"), spark.createDataFrame([("a", "X", 1, ["1"])], "source string, word string, count long, locators array<string>"))
    two = S.Scan(spark.createDataFrame([("a", 7), ("b", 1)], "source string, tokens long"), spark.createDataFrame([("b", "X", 2, ["2"])], "source string, word string, count long, locators array<string>"))
    totals, evidence = S.merge(one, two)
    assert {r["source"]: r["tokens"] for r in totals.collect()} == {"a": 7, "b": 1}
    assert [a["source"] for a in evidence.first()["attestations"]] == ["a", "b"]


def test_result_doesnt_depend_on_partitions(spark):
    docs = spark.createDataFrame([("s", i, str(i), "haus schade " * (i % 5)) for i in range(60)], "source string, seq long, locator string, text string")
    cands = spark.createDataFrame([(w,) for w in WORDS], "word string")
    rows = [sorted(map(tuple, S.scan(docs.repartition(n), cands).hits.collect())) for n in (1, 7)]
    assert rows[0] == rows[1]


@pytest.mark.parametrize(
    "language, word, expected",
    [("de", "Straße", "STRASSE"), ("tr", "istanbulı", "İSTANBULI"), ("ka", "ქართული", "ქართული"), ("ko", "닭", "ㄷㅏㄹㄱ"), ("ja", "ガッコウ", "かつこう"), ("he", "שלום", "שלומ"), ("ru", "мой", "МОЙ"), ("el", "λόγος", "ΛΟΓΟΣ"), ("vi", "hoà bình", "HOÀBÌNH"), ("et", "šokk", "ŠOKK")],
)
def test_folds(spark, language, word, expected):
    assert spark.createDataFrame([(word,)], "w string").select(fold(F.col("w"), language)).first()[0] == expected


@pytest.mark.parametrize(
    "language, word, expected",
    [("de", "Stra\u00dfe", "STRASSE"), ("tr", "istanbul", "İSTANBUL"), ("ko", "\u1103\u1161\u11b0가나", "ㄷㅏㄹㄱㄱㅏㄴㅏ"), ("ja", "カ\u3099ッコウ", "かつこう"), ("ru", "еще\u0308 мой", "ЕЩЕ"), ("fi", "a\u030Angstro\u0308m", "ÅNGSTRÖM"), ("und", "\u212bngstrom", "ÅNGSTROM"), ("de", "\u212bngstrom", "ANGSTROM")],
)
def test_keys_fold_by_language(spark, language, word, expected):
    """Composed and decomposed words alike; a scan takes the language."""
    import unicodedata

    for form in ("NFC", "NFD"):
        df = spark.createDataFrame([("s", 1, "1", unicodedata.normalize(form, word))], "source string, seq long, locator string, text string")
        assert df.select(keys(F.col("text"), language)).first()[0][0] == expected
        assert S.scan(df, spark.createDataFrame([(expected,)], "word string"), fold=language).hits.first()["count"] == 1


def test_no_python_in_a_scan(spark):
    df = spark.createDataFrame([("s", 1, "1", "Haus")], "source string, seq long, locator string, text string")
    plan = S.word_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_keys_and_nfc(spark):
    df = spark.createDataFrame([("l'été d’un no 3x a'b'c",), (None,)], "t string")
    assert df.select(keys(F.col("t"))).first()[0] == ["L'ÉTÉ", "D’UN", "A'B'C"]
    assert spark.createDataFrame([("é",)], "t string").select(nfc(F.col("t"))).first()[0] == "é"


def test_large_candidate_lists_are_joined_after_counting(spark, monkeypatch):
    texts = [("1", "Haus Haus Katze"), ("2", "schade ab Hund")]
    small = run(spark, texts, 0.2)
    monkeypatch.setattr(S, "BROADCAST_WORDS", 0)
    assert run(spark, texts, 0.2) == small == ({"s": 5}, {"HAUS": (2, ["1"]), "SCHADE": (1, ["2"])})
