import bz2

import pytest
from pyspark.sql import functions as F

from lexwarrant.functions.text import gutenberg_body, readable_text, strip_wikitext
from lexwarrant.sources import readers as R


def lines(spark, *rows):
    return spark.createDataFrame(list(enumerate(rows)), "n long, line string")


def pairs(df):
    return [(r["locator"], r["text"]) for r in df.orderBy("seq").collect()]


def one(spark, f, text):
    return spark.createDataFrame([(text,)], "t string").select(f(F.col("t"))).first()[0]


def test_tatoeba(spark, tmp_path):
    rows = ["230\tdeu\tEs ist schade.", "", "1\tdeu", "5\tdeu\tzwei\tteile"]
    assert pairs(R.tatoeba_rows(lines(spark, *rows))) == [("230", "Es ist schade."), ("5", "zwei")]
    (tmp_path / "s.tsv").write_text("\n".join(rows))
    assert pairs(R.tatoeba_documents(spark, str(tmp_path / "s.tsv"))) == [("230", "Es ist schade."), ("5", "zwei")]


WIKI = """<mediawiki>
<page>
<title>A</title><ns>0</ns>
<id>12</id>
<revision><id>99999</id><text bytes="3">Ein Haus
mit <ns>1</ns> Tür</text></revision>
</page>
<page><ns>1</ns><id>13</id><text>Diskussion</text></page>
<page><ns>0</ns><id>14</id><text>unclosed
</page>
<page><ns>0</ns><text>no id</text></page>
<page><ns>0</ns><id>15</id><text /></page>
<page><ns>0</ns><id>16</id><text>Wort</text></page>
</mediawiki>
"""


@pytest.mark.parametrize("packed", [False, True])
def test_wiki_dump(spark, tmp_path, packed):
    path = tmp_path / ("d.xml.bz2" if packed else "d.xml")
    path.write_bytes(bz2.compress(WIKI.encode()) if packed else WIKI.encode())
    assert pairs(R.wiki_documents(spark, str(path), "wiki:de")) == [("12", "Ein Haus\nmit   1  Tür".replace("  1 ", " 1 ")), ("16", "Wort")]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Ein {{Infobox|x=1}} Haus", "Ein   Haus"), ("a<ref name='x'>b</ref>c", "a c"), ("[[Ziel|Wort]] und [[Ort]]", "Wort und Ort"),
        ("== Titel ==\nText", " \nText"), ("a&nbsp;b", "a b"), ("siehe https://x.org/y z", "siehe   z"), ("{|\n| t\n|}x", " x"), ("a<br/>b", "a b"),
    ],
)
def test_wikitext(spark, text, expected):
    assert one(spark, strip_wikitext, text) == expected


START, END = "*** START OF THE PROJECT GUTENBERG EBOOK X ***", "*** END OF THIS PROJECT GUTENBERG EBOOK X ***"


@pytest.mark.parametrize(
    "text, expected",
    [(f"a\n{START}\nbody\n{END}\nlicence", "\nbody\n"), (f"{START}\nbody", "\nbody"), (f"{END}\n{START}\nbody", "\nbody"), ("body", ""), ("", "")],
)
def test_gutenberg(spark, text, expected):
    assert one(spark, gutenberg_body, text) == expected


def test_books(spark, tmp_path):
    (tmp_path / "pg10.txt").write_text(f"{START}\n{'Wort ' * 500}\n{END}")
    (tmp_path / "pg11.txt").write_text(f"{START}\nkurz\n{END}")
    assert [r["locator"] for r in R.gutenberg_documents(spark, str(tmp_path)).collect()] == ["10"]
    manifest = spark.createDataFrame([("pg10", "file.txt")], "id string, name string")
    assert [r["locator"] for r in R.archive_documents(spark, str(tmp_path), manifest, 100).collect()] == ["pg10/file.txt"]


def test_documents_follow_file_names_and_rows(spark, tmp_path):
    """Book files by name, crawl rows by file and place; ``take`` and sample locators follow."""
    from lexwarrant.operators import scan as S

    for name in ("c.txt", "a b.txt", "ä.txt", "b.txt"):
        (tmp_path / name).write_text("Haus " * 500)
    docs = R.file_documents(spark, str(tmp_path), "s")
    assert [r["locator"] for r in S.take(docs, 4).collect()] == ["a b", "b", "c", "ä"]
    cands = spark.createDataFrame([("HAUS",)], "word string")
    assert list(S.scan(docs, cands).hits.first()["locators"]) == ["a b", "b"]
    folder = tmp_path / "crawl"
    for k in (2, 0, 1):
        rows = [("Haus", f"u{k}-{i}") for i in (3, 1, 2)]
        spark.createDataFrame(rows, "text string, url string").coalesce(1).write.parquet(str(tmp_path / f"part{k}"))
        folder.mkdir(exist_ok=True)
        next((tmp_path / f"part{k}").glob("*.parquet")).rename(folder / f"{k}.parquet")
    crawled = R.crawl_documents(spark, str(folder))
    assert [r["locator"] for r in S.take(crawled, 5).collect()] == ["u0-3", "u0-1", "u0-2", "u1-3", "u1-1"]


def test_verse_runs_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(R, "LINES_A_BLOCK", 4)
    names = ["GEN 1", "GEN 1", "GEN 2", "EXO 1"]
    import random

    rnd = random.Random(3)
    chapters = [rnd.choice(names) for _ in range(60)]
    docs = R.verses_by_chapter(lines(spark, *[f"{c}:{i} v{i}" for i, c in enumerate(chapters, 1)]), "s")
    expected = []
    for i, c in enumerate(chapters, 1):
        if i == 1 or chapters[i - 2] != c:
            expected.append((c[:3] + "0" + c[4:], []))
        expected[-1][1].append(f"v{i}")
    assert pairs(docs) == [(c, " ".join(v)) for c, v in expected]


def test_leipzig(spark):
    links = lines(spark, "1\t10", "2\t11", "999\t12", "3\t10", "bad")
    urls = lines(spark, "1\tkleinezeitung.at/old", "1\tkleinezeitung.at/a", "2\theise.de/b", "3\torf.at/c")
    docs = R.leipzig_sentences(lines(spark, "10\tEins", "11\tZwei\tdrei", "12\tVier", "ohne", "\tleer"), R.leipzig_locators(links, urls), "lz:x")
    assert pairs(docs) == [("orf.at/c", "Eins"), ("heise.de/b", "Zwei\tdrei")]


def test_crawl(spark, tmp_path):
    rows = [("a", "u1"), ("", "u2"), ("b", ""), (None, "u3"), ("c", None), ("d", "u4")]
    spark.createDataFrame(rows, "text string, url string").withColumn("more", F.lit(1)).write.parquet(str(tmp_path / "p"))
    docs = R.crawl_documents(spark, str(tmp_path / "p"))
    assert sorted((r["locator"], r["text"]) for r in docs.collect()) == [("u1", "a"), ("u4", "d")]


def test_verses(spark):
    docs = R.verses_by_chapter(lines(spark, "GEN 1:1 Am Anfang", "GEN 1:2 schuf", "note", "GEN 2:1 Also", "EXO 12:14 Tag", "GEN 1:3 wieder"), "ebible:x")
    assert pairs(docs) == [("GEN01", "Am Anfang schuf"), ("GEN02", "Also"), ("EXO12", "Tag"), ("GEN01", "wieder")]


def test_harvest_log(spark):
    log = lines(spark, "https://x/a\tGOOD:2 NOCOUNT BAD:0 NEG:-1", "https://x/b\tA:B:3", "", "https://x/c", "https://x/d\tNONE")
    found = {r["url"]: r["text"] for r in R.harvested_pages(log).collect()}
    assert found == {"https://x/a": "GOOD GOOD", "https://x/b": "A:B A:B A:B"}


def test_candidates_and_catalogue(spark, tmp_path):
    rows = R.candidate_list(lines(spark, "#header", "HAUS\tHaus", "", "IST")).orderBy("word").collect()
    assert [tuple(r) for r in rows] == [("HAUS", "Haus"), ("IST", None)]
    (tmp_path / "c.csv").write_text('Text#,Type,Language,Title\r\n1,Text,de,"a ""b"", c\nd"\r\n2,Sound,de,x\r\n3,Text,"en; de",y\r\n')
    assert [(r["Text#"], r["Title"]) for r in R.catalogue(spark, str(tmp_path / "c.csv"), "de").collect()] == [("1", 'a "b", c\nd')]


def test_readings(spark):
    docs = spark.createDataFrame([("s", 1, "a", "kon\tni\nchi"), ("s", 2, "b", ""), ("s", 3, "b", "x"), ("s", 4, "c", None)], R.DOCUMENT)
    assert pairs(R.with_readings(docs, lambda: str.upper)) == [("a", "KON NI CHI"), ("b", "X")]

    def broken():
        def fail(text):
            raise RuntimeError("analyser ended with 3")

        return fail

    with pytest.raises(Exception, match="analyser ended with 3"):
        R.with_readings(docs, broken).collect()
    assert R.reading_chunks("aa bb cc", 5) == ["aa bb", "cc"] and R.reading_chunks("") == []
    long = "語" * 30_000 + " " + "word " * 9_000
    parts = R.reading_chunks(long)
    assert max(len(p.encode()) for p in parts) <= 20_000 and "".join(parts).replace(" ", "") == long.replace(" ", "") and all(p.strip().endswith("word") or "語" in p for p in parts if p.strip())
    assert R.reading_chunks("日本語", 4) == ["日", "本", "語"]


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<p>Gr&ouml;&szlig;e</p>", "Gr e"), ("a<script>var x</script>b<STYLE>p{}</STYLE>c<noscript>n</noscript>", "a b c"), ("<!-- x > y -->a&amp;b &quot;c&quot;", 'a&b "c"'),
        ("&#8217;s&#65;", "’sA"), ("a&nbsp; 　b", "a b"), ("", ""), ("&amp;lt;", ""),
    ],
)
def test_readable(spark, html, expected):
    assert one(spark, readable_text, html) == expected
