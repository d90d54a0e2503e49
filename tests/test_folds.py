import unicodedata

import pytest
from pyspark.sql import functions as F

from lexwarrant.functions import text as T, urls as U


def plainly(word, letters):
    """The rule by characters: composed, upper case, marks only on letters of the alphabet."""
    out = ""
    for c in unicodedata.normalize("NFC", word).replace("ß", "ss").upper():
        out += c if c in letters else "".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.category(x).startswith("M"))
    return out


WORDS = ["Straße", "Ärger", "naïve", "Łódź", "Žižek", "Ørsted", "piñón", "İstanbul", "Čeština", "fête", "ĳs", "мой", "ёлка", "їжак", "ѓорѓи", "ᾳδω", "ô̂x", "Đorđe", "þing", "ÇA", "ăâîșț", "ĀČĒ", "ἄλφα", "d’été", "أنا", "آب", "", "abc"]


@pytest.mark.parametrize("form", ["NFC", "NFD"])
def test_folds_of_all_alphabets(spark, form):
    tags = [t for t in T.LETTERS if t not in T.FOLDS]
    df = spark.createDataFrame([(i, unicodedata.normalize(form, w)) for i, w in enumerate(WORDS)], "i int, w string")
    got = df.select("i", *[T.fold(F.col("w"), t).alias(f"k{k}") for k, t in enumerate(tags)]).collect()
    for k, tag in enumerate(tags):
        assert {WORDS[r["i"]]: r[f"k{k}"] for r in got} == {w: plainly(w, T.LETTERS[tag]) for w in WORDS}, tag


def test_languages_with_rules_of_their_own(spark):
    one = lambda w, tag: spark.createDataFrame([(w,)], "w string").select(T.fold(F.col("w"), tag)).first()[0]
    assert one("ţară şi țara", "ro") == one("țară și țara", "ro") == "ȚARĂ ȘI ȚARA"
    assert one("ёлка мой", "ru") == "ЕЛКА МОЙ" and one("ქართული", "ka") == "ქართული" and one("ırmak iyi", "tr") == "IRMAK İYİ"
    assert one("Größe é", "de") == "GRÖSSE E" and one("Größe é", T.PLAIN) == "GRÖSSE É" and one("Größe é", "xx") == "GRÖSSE É"
    assert T.alphabet_fold("AÄßOÖ") is not None and one("hòa hoà", "vi") == "HÒAHOÀ"


def test_every_published_language_has_a_fold():
    published = "af ar bg ca cs cy da de el en es et eu fa fi fr ga gl he hr hu hy id is it ja ka ko lt lv mk ms nl no pcm pl pt pt-BR ro ru sk sl sr sv sw tl tr uk vi"
    assert [t for t in published.split() if t not in T.LETTERS and t not in T.FOLDS] == []


BASE = "https://Ex.de/dir/page?q=1"


@pytest.mark.parametrize(
    "href, base, want",
    [
        ("/a?p=2", BASE, "https://ex.de/a?p=2"), ("b", BASE, "https://ex.de/dir/b"), ("./b", BASE, "https://ex.de/dir/b"), ("../b", BASE, "https://ex.de/b"),
        ("../../../b", BASE, "https://ex.de/b"), ("?x=2", BASE, "https://ex.de/dir/page?x=2"), ("//Other.ORG", BASE, "https://other.org/"),
        ("//other.org/a/./b/../c", BASE, "https://other.org/a/c"), ("http://Y.com:80/p", BASE, "http://y.com/p"), ("https://y.com:8080/p/..", BASE, "https://y.com:8080/"),
        ("http://[", BASE, None), ("http://ho st/", BASE, None), ("/x", "nourl", None), ("/é x", BASE, "https://ex.de/%C3%A9%20x"), ("/%C3%A9+1", BASE, "https://ex.de/%C3%A9+1"),
        ("a/b/..", BASE, "https://ex.de/dir/a/"), ("a/.", BASE, "https://ex.de/dir/a/"), (" /s ", BASE, "https://ex.de/s"), ("x.html", "https://ciudadseva.com/", "https://ciudadseva.com/x.html"),
        ("x", "https://h.de", "https://h.de/x"), ("data:text/x", BASE, "data:text/x"), ("https:rel", BASE, "https://ex.de/dir/rel"), ("\\a\\b", BASE, "https://ex.de/a/b"),
        ("/a?q=é&r='", BASE, "https://ex.de/a?q=%C3%A9&r=%27"), ("ftp://F.de/x", BASE, "ftp://f.de/x"), ("/%2e%2E/x", BASE, "https://ex.de/x"), ("/a{b}`", BASE, "https://ex.de/a%7Bb%7D%60"),
        ("/..", BASE, "https://ex.de/"), ("http://u:p@H.de/", BASE, "http://u:p@h.de/"), ("/a\nb", BASE, "https://ex.de/ab"), ("/a*b~c.d", BASE, "https://ex.de/a*b~c.d"), (None, BASE, None),
        ("/...//.x/", BASE, "https://ex.de/...//.x/"),
    ],
)
def test_references(spark, href, base, want):
    df = spark.createDataFrame([(href, base)], "h string, b string")
    assert df.select(U.absolute(F.col("h"), F.col("b"))).first()[0] == want


def test_links_stay_in_the_jvm(spark):
    df = spark.createDataFrame([('<a href="/t#n">a</a><a href="/t">b</a><a href="MAILTO:a@b.c">m</a><a href="http://[">x</a><a href="t">c</a>', "https://x.es/")], "h string, b string")
    found = df.select(U.page_links(F.col("h"), F.col("b")).alias("l"))
    assert found.first()["l"] == ["https://x.es/t"]
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
