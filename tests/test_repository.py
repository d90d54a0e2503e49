import json

import pytest

from lexwarrant.functions.registry import sources_table
from lexwarrant.operators import build as B, reports, repository as P, scan as S
from lexwarrant.sources import ingest as I

DOC = "source string, seq long, locator string, text string"
SOURCES = ["tat", "gut", "wiki:de", "lz:deu_news_2021_1M"]


@pytest.fixture
def folder(spark, tmp_path):
    docs = spark.createDataFrame([(s, i, f"https://x/{i}" if s.startswith("lz") else str(i), t) for s in SOURCES for i, t in enumerate(["Haus und Schade", "Haus Tür"])] + [("tat", 9, "9", "Nur hier Mond")], DOC)
    (tmp_path / "words.in").write_text("#candidates\nHAUS\tHaus\nSCHADE\n\nMOND\tMond\nNIE\n")
    cands = P.candidates(spark, tmp_path / "words.in")
    built = B.build(cands, S.scan(docs, cands), sources_table(spark, SOURCES))
    P.save(tmp_path / "de", "de", "2026-01-01", built, cands, 1, cands.where("written is not null"))
    return tmp_path / "de"


def test_saved_folder(spark, folder):
    assert (folder / P.LIST).read_text() == "#lexwarrant/wordlist/2 language=de common=1 full=2\nHAUS\tHaus\nSCHADE\n"
    assert (folder / P.DROPS).read_text() == "#lexwarrant/dropped/1 words=2\nMOND\t1\ttat\t1\nNIE\t0\t\t\n"
    assert P.conform(spark, folder) == []
    state = P.save_status(spark, folder)
    assert (state["candidates"], state["shipped"], state["families"], state["checkable"], state["conforms"]) == (4, 2, 4, 3, True)
    assert [s["kept"] for s in state["steps"]] == [0, 0, 2, 2]
    assert P.may_retire(spark, folder, SOURCES + ["archive-x"]) == []
    assert P.may_retire(spark, folder, ["gut", "cc"]) == ["cc has no recorded total"]


def test_decisions_stay_and_roll_up(spark, folder):
    (folder / P.STATUS).write_text(json.dumps({"ships": "held", "why": "thin"}))
    state = P.save_status(spark, folder)
    assert (state["ships"], state["why"]) == ("held", "thin")
    rolled = P.roll_up(spark, [folder], [state | {"language": "fr"}, state | {"language": "de", "shipped": 99}])
    assert {r["language"]: r["shipped"] for r in rolled.collect()} == {"de": 2, "fr": 2}
    assert "| de | 4 | 2 | 50.0% | 4 | 3 | 4 | held |" in reports.languages_markdown(rolled)


def test_broken_folder(spark, folder):
    path = folder / "ATTESTATIONS.tsv"
    path.write_text(path.read_text().replace("words=4", "words=5"))
    assert [c for c, _ in P.conform(spark, folder)] == ["evidence parses"]


def test_weeding(spark):
    docs = spark.createDataFrame([("s", 1, "a", "haus haus okay"), ("s", 2, "b", "qwe rtz uio haus"), ("s", 3, "c", "..."), ("s", 4, "d", None)], DOC)
    cands = spark.createDataFrame([("HAUS",)], "word string")
    assert sorted((r["locator"], round(r["share"], 2)) for r in S.weeded(docs, cands).collect()) == [("b", 0.25), ("c", 0.0), ("d", 0.0)]
    assert S.weeded(docs, cands, chars=4).where("locator = 'a'").count() == 0


def test_fetching(tmp_path):
    listing = {"response": {"docs": [{"identifier": i} for i in ("old", "bad", "gone", "short", "a b", "more")]}}
    meta = lambda name: json.dumps({"files": [{"name": "x.pdf", "format": "PDF"}, {"name": name, "format": I.TEXT_FORMAT}]})
    pages = {I.search_address("scans", 2): json.dumps(listing), "https://archive.org/metadata/short": meta("s.txt"), "https://archive.org/download/short/s.txt": "x", "https://archive.org/metadata/a b": meta("ä.txt"), "https://archive.org/download/a b/%C3%A4.txt": "w" * 20_000}
    (tmp_path / "old.txt").write_text("x")
    (tmp_path / "rejected.tsv").write_text("bad\n")
    assert I.fetch_archive(tmp_path, "scans", 1, pages.get, 0) == 1
    assert (tmp_path / "files.tsv").read_text() == "a b\tä.txt\n" and not list(tmp_path.glob("*.part"))
    pages["https://archive.org/metadata/old"] = meta("o.txt")
    assert I.backfill_names(tmp_path, pages.get, 0) == 1 and "old\to.txt" in (tmp_path / "files.tsv").read_text()
    with pytest.raises(ConnectionError):
        I.fetch_archive(tmp_path, "nothing", 1, pages.get, 0)
    books = {"https://www.gutenberg.org/cache/epub/7/pg7.txt": "b" * 2000, "https://www.gutenberg.org/cache/epub/8/pg8.txt": "b"}
    assert I.fetch_books(tmp_path, ["6", "7", "8"], books.get, 5, 0) == 1 and I.fetch_books(tmp_path, ["7"], books.get, 5, 0) == 0


def test_remote_status():
    address = "https://host/{tag}/status.json"
    answers = {"https://host/de/status.json": (200, '{"ships": "yes", "shipped": 5}'), "https://host/fr/status.json": (404, ""), "https://host/ru/status.json": (500, "")}
    assert I.remote_status("de", answers.get, address)["ships"] == "yes"
    assert I.remote_status("fr", answers.get, address)["built"] is False
    with pytest.raises(I.Unreachable):
        I.remote_status("ru", answers.get, address)


def test_a_build_is_refused_while_a_harvest_runs(spark, folder):
    with P.harvesting(spark, folder):
        with pytest.raises(P.HarvestRunning, match="is harvesting into"):
            P.refuse_running_harvest(spark, folder)
        with pytest.raises(P.HarvestRunning, match="holds"), P.harvesting(spark.newSession(), folder):
            pass
    P.refuse_running_harvest(spark, folder)
    (folder / P.RUNNING).write_text('{"owner": "one that died", "until": 5}')
    P.refuse_running_harvest(spark, folder)
    with P.harvesting(spark, folder):
        pass
    assert not (folder / P.RUNNING).exists()


def test_a_repository_must_be_clean(spark, folder):
    import subprocess

    P.save_status(spark, folder)
    git = lambda *a: subprocess.run(["git", "-C", str(folder), "-c", "user.name=x", "-c", "user.email=x@x", *a], check=True, capture_output=True)
    git("init", "-q")
    assert [b for b in P.may_retire(spark, folder, SOURCES) if b.startswith("not committed")]
    git("add", "-A")
    git("commit", "-qm", "all")
    assert P.may_retire(spark, folder, SOURCES) == []


def test_verify_and_harvest(spark, folder, tmp_path):
    from lexwarrant.functions.registry import FIXED

    checked, proofs = P.verify(spark, folder, 1, lambda url: "Haus und Schade")
    assert [r["holds"] for r in proofs.collect()] == [True] and checked.count() > 0
    page = "<p>" + "Haus " * 60 + "</p>"
    pages = {"https://x.de/sitemap.xml": "<loc>https://x.de/1</loc><loc>https://x.de/2</loc>", "https://x.de/1": page, "https://x.de/2": "<p>kurz</p>"}
    cands = P.candidates(spark, tmp_path / "words.in")
    assert P.harvest(spark, folder, ["x.de"], cands, pages.get, delay=0) == 1
    assert P.harvest(spark, folder, ["x.de"], cands, (pages | {"https://x.de/2": page}).get, delay=0) == 1
    rows = P.incremental.harvested(spark, str(folder / P.HARVEST)).collect()
    assert sorted((r["url"], [tuple(w) for w in r["words"]]) for r in rows) == [("https://x.de/1", [("HAUS", 60)]), ("https://x.de/2", [("HAUS", 60)])]
    assert FIXED and not (folder / P.RUNNING).exists()


def test_strict_and_listing(spark):
    claimed = reports.cache_claims(spark.createDataFrame([("a", 1), ("b", 2)], "file string, bytes long"), spark.createDataFrame([("a", "de")], "file string, language string"))
    assert (reports.strict_exit(claimed), reports.strict_exit(claimed, False), reports.strict_exit(claimed.where("file = 'a'"))) == (1, 0, 0)
    pages = {"https://h/1": (200, '[{"name": "words-fr"}, {"name": "other"}]'), "https://h/2": (200, '[{"name": "words-de"}]'), "https://h/3": (200, "[]")}
    assert I.published_languages(pages.get, "https://h/{page}", "words-") == ["de", "fr"]
    with pytest.raises(I.Unreachable):
        I.published_languages(lambda url: (500, ""), "https://h/{page}", "words-")
