import pytest

from lexwarrant.functions.registry import source_for, sources_table, validate_id, year_in
from lexwarrant.operators import build as B, curve as K, reports as R, rule
from lexwarrant.operators.scan import Scan
from lexwarrant.sources import evidence_files as E

HITS = "source string, word string, count long, locators array<string>"


def frames(spark, totals, hits, cands):
    return (
        Scan(spark.createDataFrame(totals, "source string, tokens long"), spark.createDataFrame([(s, w, n, ["1"]) for s, w, n in hits], HITS)),
        spark.createDataFrame([(c,) for c in cands], "word string"),
    )


def sources(spark, *ids):
    return sources_table(spark, list(ids))


THREE = [("tat", 1000), ("lz:news", 1000), ("gut", 1000)]


def test_three_families_keep_a_word(spark):
    scan, cands = frames(spark, THREE, [("tat", "OKAY", 40), ("lz:news", "OKAY", 30), ("gut", "OKAY", 20), ("tat", "PIZZA", 10), ("gut", "PIZZA", 8)], ["OKAY", "PIZZA", "ERFUNDEN"])
    built = B.build(cands, scan, sources(spark, "tat", "lz:news", "gut"))
    lines = [r["line"] for r in B.word_list_lines(built.kept).orderBy("rank").collect()]
    assert E.word_list("de", lines, 1) == "#lexwarrant/wordlist/2 language=de common=1 full=1\nOKAY\n"
    drops = [r["line"] for r in B.drop_list_lines(built.dropped).orderBy("families", ascending=False).collect()]
    assert drops == ["PIZZA\t2\tgut,tat\t8,10", "ERFUNDEN\t0\t\t"]
    assert E.drop_list(drops).startswith("#lexwarrant/dropped/1 words=2\n")
    assert E.word_list("de", [], 5).endswith("full=0\n\n")


def test_families_not_sources_count(spark):
    scan, cands = frames(spark, [(s, 10) for s in ("wiki:de", "wikisource:de", "lz:a_2020_1M", "lz:b_2021_1M", "own")], [(s, "X", 1) for s in ("wiki:de", "wikisource:de", "lz:a_2020_1M", "lz:b_2021_1M", "own")], ["X"])
    built = B.build(cands, scan, sources(spark, "wiki:de", "wikisource:de", "lz:a_2020_1M", "lz:b_2021_1M", "own"))
    assert built.verdicts.first()["families"] == 3


@pytest.mark.parametrize("totals, hits, expected", [([("cc", 1_000_000, True), ("gut", 1_000_000, True), ("tat", 1_000_000, True)], [("cc", 3)], 1.0), ([("cc", 0, True), ("gut", 1000, True)], [("cc", 3), ("gut", 1)], 500.0), ([], [("cc", 3)], 0.0), ([("cc", 100, False)], [("cc", 1)], 0.0)])
def test_rate(spark, totals, hits, expected):
    t = spark.createDataFrame(totals, "source string, tokens long, ranks boolean")
    a = spark.createDataFrame([(s, "X", n) for s, n in hits], "source string, word string, count long")
    assert rule.rates(spark.createDataFrame([("X",)], "word string"), a, t).first()["rate"] == pytest.approx(expected)


def test_rank_is_by_rate_then_dictionary_order(spark):
    rated = spark.createDataFrame([("ZEBRA", 1.0), ("ÄPFEL", 1.0), ("APFEL", 1.0), ("B", 2.0)], "word string, rate double")
    assert [r["word"] for r in rule.ranked(rated).orderBy("rank").collect()] == ["B", "APFEL", "ÄPFEL", "ZEBRA"]


def test_reuse_of_records(spark):
    record, _ = frames(spark, [("gut", 1000), ("wiki:de", 5000), ("tat", 9)], [("gut", "OKAY", 1), ("wiki:de", "OKAY", 2), ("wiki:de", "PIZZA", 1), ("tat", "OLD", 4), ("gut", "OLD", 1)], [])
    fresh, cands = frames(spark, [("tat", 1000)], [("tat", "OKAY", 5)], ["OKAY", "PIZZA"])
    built = B.build(cands, fresh, sources(spark, "tat", "gut", "wiki:de"), record)
    assert {r["source"]: r["tokens"] for r in built.totals.collect()} == {"tat": 1000, "gut": 1000, "wiki:de": 5000}
    assert {r["word"]: r["families"] for r in built.verdicts.collect()} == {"OKAY": 3, "PIZZA": 1}
    assert sorted(r["source"] for r in built.reused.collect()) == ["gut", "wiki:de"]
    empty, _ = frames(spark, [("gut", 0)], [("gut", "OKAY", 1)], [])
    with pytest.raises(B.EmptyScan):
        B.build(cands, empty, sources(spark, "gut"), record)


def test_spellings(spark):
    rows = [(f"W{i}", "abadía") for i in range(3)] + [("X", "ātt"), ("Y", "bab")]
    df = spark.createDataFrame(rows, "word string, written string")
    assert {r["word"] for r in rule.trusted_spellings(df, list("abdt"), 3).collect()} == {"W0", "W1", "W2", "Y"}


def test_self_evidence(spark):
    a, b = spark.createDataFrame([("A",), ("B",)], "word string"), spark.createDataFrame([("B",), ("A",)], "word string")
    assert B.same_as_output(a, b) and not B.same_as_output(a, b.limit(1))


def evidence(words, totals=None):
    return E.Evidence("de", "2026-01-01", words, totals or {})


def test_evidence_line_and_round_trip():
    word = ("SCHADE", [("gut", 7, ["21034"]), ("cc", 412, ["https://example.de/artikel"]), ("dewiki", 88, ["9912847", "7740221"])])
    assert E.evidence_line(*word) == "SCHADE\tcc,dewiki,gut\t412,88,7\tcc:https://example.de/artikel dewiki:9912847 dewiki:7740221 gut:21034"
    whole = evidence([("A", []), ("SCHADE", sorted(word[1])), ("B", [("wiki:fr", 1, ["2"]), ("wiki", 2, [])])], {"gut": 5, "cc": 1})
    whole.words[2][1].sort()
    text = E.format_evidence(whole)
    assert text.split("\n")[0].startswith("#lexwarrant/attestations/2 language=de words=3 sources=5 built=2026-01-01 digest=")
    assert text.split("\n")[1] == "#tokens cc=1 gut=5"
    back = E.parse_evidence(text, verify=True)
    assert (back.words, back.totals) == (whole.words, whole.totals)
    assert E.parse_evidence("#x/attestations/1 language=de words=1\nA\tb\t1\n").totals == {}


@pytest.mark.parametrize(
    "text",
    ["", "A\tb\t1\n", "#x/attestations/2 words=2\nA\tb\t1\n", "#x/attestations/2 words=1\nA\tb\n", "#x/attestations/2 words=1\nA\tb,c\t1\n", "#x/attestations/2 words=1\nA\tb\tx\n", "#x/attestations/2 words=1\nA\tb\t-1\n", "#x/attestations/2 words=1\nA\tb\t1\tc:2\n", "#x/attestations/2 words=0\n#tokens a=x\n"],
)
def test_malformed_evidence(text):
    with pytest.raises(E.Malformed):
        E.parse_evidence(text)


def test_spaces_in_locators_are_refused():
    with pytest.raises(E.Malformed):
        E.evidence_line("A", [("b", 1, ["x y"])])


def test_shards(tmp_path):
    whole = evidence([(f"WORD{i}", [("gut", i, [str(i)])]) for i in range(40)], {"gut": 9})
    paths = E.write_evidence(tmp_path, whole, most=400)
    assert len(paths) > 5 and all(p.stat().st_size <= 400 for p in paths)
    back = E.read_evidence(tmp_path)
    assert back.words == whole.words and back.totals == whole.totals and back.digest.count("+") == len(paths) - 1
    (tmp_path / "ATTESTATIONS.tsv").write_text("x")
    with pytest.raises(E.Malformed):
        E.evidence_paths(tmp_path)
    E.write_evidence(tmp_path, whole)
    assert [p.name for p in E.evidence_paths(tmp_path)] == ["ATTESTATIONS.tsv"]
    with pytest.raises(FileNotFoundError):
        E.evidence_paths(tmp_path / "none")


def test_evidence_from_frames(spark):
    scan, cands = frames(spark, THREE, [("tat", "OKAY", 40), ("gut", "OKAY", 1)], ["OKAY", "NIE"])
    found = E.evidence_from("de", "d", B.evidence(cands, scan.hits), scan.totals)
    assert found.words == [("NIE", []), ("OKAY", [("gut", 1, ["1"]), ("tat", 40, ["1"])])]
    assert E.attestation_frame(spark, found).count() == 2 and E.totals_frame(spark, found).count() == 3


def test_registry():
    assert source_for("gut").checkability == "durable" and source_for("cc").checkability == "crawled"
    assert source_for("web:a.de").ranks is False and source_for("web:a.de").checkability == "live"
    assert source_for("lz:deu_news_2021_1M").as_of == "2021" and year_in("x12021") is None
    assert source_for("ud:UD_X@abc").family == "UD_X"
    for bad in ("dewiki", "ud:X", "ud:@a", "wiki:", "nope:x"):
        with pytest.raises(LookupError):
            source_for(bad)
    for bad in ("", "a b", "a,b", "a\tb"):
        with pytest.raises(ValueError):
            validate_id(bad)


def attested(spark, sets):
    return spark.createDataFrame([(w, f) for w, fs in sets.items() for f in fs], "word string, family string")


@pytest.mark.parametrize("sets, kept", [({"A": "xyz", "B": "xyz"}, [0, 0, 2]), ({"A": "xyz", "B": "xyw"}, [0, 0, 1, 2]), ({"A": "x"}, [0])])
def test_saturation(spark, sets, kept):
    rows = K.saturation(attested(spark, sets), 4).orderBy("families").collect()
    assert [r["kept"] for r in rows] == kept and sum(r["gained"] for r in rows) == kept[-1]
    assert rows[-1]["share"] == kept[-1] / 4


def test_best_family_first_and_fixed_sets(spark):
    sets = {"A": ["x", "y", "big"], "B": ["x", "y", "big", "small"], "C": ["x"]}
    rows = K.saturation(attested(spark, sets), 3).orderBy("families").collect()
    assert [r["added"] for r in rows] == ["x", "big", "y", "small"] and [r["kept"] for r in rows] == [0, 0, 2, 2]
    assert K.kept_by_families(attested(spark, sets), {"x", "y", "big"}) == 2
    assert [f for f, _, _ in K.greedy([(["a", "b"], 1)], order={"b": 0, "a": 1})] == ["b", "a"]


def test_knee_and_chart(spark):
    steps = [("de", i, k, g) for i, (k, g) in enumerate([(0, 0), (0, 0), (30000, 30000), (34000, 4000), (35725, 1725), (35800, 75)], 1)]
    df = spark.createDataFrame(steps, "language string, families int, kept long, gained long")
    assert K.knee(df).first()["knee"] == 6
    assert K.knee(df.where("families < 6")).first() is None
    svg = K.chart([("de & co", [(1, 0.0), (2, 0.5)], "yes"), ("x", [(1, 0.5)], "held"), ("y", [], "pending")])
    assert "de &amp; co" in svg and "stroke-dasharray" in svg and svg.count("polyline") == 2


def test_reports(spark):
    state = R.status("de", "d", spark.createDataFrame([("A", True)], "word string, kept boolean"), spark.createDataFrame([("de", 1, "x", 1, 1.0, 1)], "language string, families int, added string, kept long, share double, gained long"), spark.createDataFrame([("x", True)], "family string, checkable boolean"), spark.createDataFrame([], "language string, knee int"), True, {"ships": "maybe", "why": "w"})
    assert state["ships"] == "pending" and state["knee"] is None and state["why"] == "w"
    assert "| 1 | x | 1 | 100.0% | 1 |" in R.saturation_markdown(state)
    rolled = R.roll_up(spark.createDataFrame([state], R.STATUS), spark.createDataFrame([dict(state, language="fr")], R.STATUS))
    assert "| fr |" in R.languages_markdown(rolled) and '"language": "de"' in R.languages_json(rolled, "d")
    claimed = R.cache_claims(spark.createDataFrame([("f", 5), ("g", 7)], "file string, bytes long"), spark.createDataFrame([("f", "de")], "file string, language string"))
    assert tuple(R.cache_totals(claimed).first()) == (5, 7) and R.exclusively(claimed, "de").first()["file"] == "f"
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    found = spark.createDataFrame([("a", 1), ("b", 9), ("c", 5), ("d", 7)], "id string, downloads long")
    assert [r["id"] for r in R.held_or_new(found, ids("a"), ids("b")).collect()] == ["d", "c"]
