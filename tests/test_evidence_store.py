import random

import pytest
from lexwarrant.operators import evidence_store as S
from lexwarrant.sources import evidence_files as E

KIND = "word string, attestations array<struct<source:string,count:bigint,locators:array<string>>>"


def made(n, seed=1):
    rnd = random.Random(seed)
    sources = ["tat", "wiki:de", "wiki", "lz:a_2020_1M", "web:x.org"]
    words = sorted({"".join(rnd.choice("ABCÄÖß'Ω") for _ in range(rnd.randrange(2, 9))) for _ in range(n)})
    return [(w, [(s, rnd.randrange(1, 999), [f"l:{rnd.randrange(99)}" for _ in range(rnd.randrange(4))]) for s in rnd.sample(sources, rnd.randrange(5))]) for w in words]


TOTALS = {"tat": 5, "wiki:de": 700, "gut": 0}


def plain(root):
    return {p.name: p.read_text("utf-8") for p in E.evidence_paths(root)}


@pytest.mark.parametrize("n, most, block", [(0, 10**6, 4096), (1, 10**6, 4096), (300, 10**6, 4096), (300, 4000, 4096), (300, 4000, 16), (300, 1500, 1), (300, 10, 7), (300, 30_000, 100)])
def test_files_are_those_of_the_plain_writer(spark, tmp_path, monkeypatch, n, most, block):
    monkeypatch.setattr(S, "BLOCK", block)
    rows = made(n) if n else []
    E.write_evidence(tmp_path, E.Evidence("de", "2020-01-02", rows, TOTALS), most)
    want = plain(tmp_path)
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "ATTESTATIONS.tsv").write_text("old")
    shards = S.write_evidence(str(tmp_path / "b"), "de", "2020-01-02", spark.createDataFrame(rows, KIND).repartition(3), spark.createDataFrame(list(TOTALS.items()), "source string, tokens long"), most)
    assert plain(tmp_path / "b") == want
    assert not [p for p in (tmp_path / "b").iterdir() if "writing" in p.name]
    told = sorted(tuple(r) for r in shards.collect())
    assert [t[0] for t in told] == list(range(len(want))) and [t[3] for t in told] == [len(x.encode()) for _, x in sorted(want.items())]
    found = S.read_evidence(spark, str(tmp_path / "b"), verify=True)
    back = E.read_evidence(tmp_path / "b")
    assert (found.language, found.built, found.digest) == (back.language, back.built, back.digest)
    assert {r["source"]: r["tokens"] for r in found.totals.collect()} == TOTALS
    key = lambda rows: sorted(rows, key=str)
    assert key((r["word"], r["source"], r["count"], list(r["locators"])) for r in found.attestations.collect()) == key((w, *a) for w, attested in back.words for a in attested)
    assert sorted(r["word"] for r in found.words.collect()) == [w for w, _ in back.words]


def test_a_locator_with_a_space_fails(spark, tmp_path):
    with pytest.raises(Exception, match="a locator has a space: a b"):
        S.write_evidence(str(tmp_path), "de", "x", spark.createDataFrame([("W", [("s", 1, ["a b"])])], KIND), spark.createDataFrame([], "source string, tokens long"))


def test_layouts(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        S.layout(spark, str(tmp_path))
    (tmp_path / "attestations").mkdir()
    with pytest.raises(FileNotFoundError):
        S.layout(spark, str(tmp_path))
    (tmp_path / "attestations" / "000.tsv").write_text("x")
    (tmp_path / "ATTESTATIONS.tsv").write_text("x")
    with pytest.raises(E.Malformed, match="twice"):
        S.layout(spark, str(tmp_path))


HEAD = "#any/attestations/2 language=de words=1 sources=1 built=x digest=0"


@pytest.mark.parametrize(
    "text, said",
    [
        ("W\ts\t1\t\n", "not an evidence file"), (HEAD + "\n", "the header says 1 words, the file has 0"), (HEAD.replace("words=1", "words=x") + "\nW\ts\t1\n", "no count: x"),
        (HEAD + "\nW\ts\n", "a line has 2 columns"), (HEAD + "\nW\ts,t\t1\n", "W: 2 sources and 1 counts"), (HEAD + "\nW\ts\t1x\n", "W: no count: 1x"), (HEAD + "\nW\ts\t-1\n", "no count: -1"),
        (HEAD + "\nW\ts\t1\tt:5\n", "belongs to no source: t:5"), (HEAD + "\n#tokens s=5 t\nW\ts\t1\ts:5\n", "a token total is malformed: t"), (HEAD + "\n#tokens s=-5\nW\ts\t1\ts:5\n", "malformed: s=-5"),
        (HEAD + "\nW\ts\t1\ts:5\nV\ts\t1\n", "says 1 words, the file has 2"), (HEAD + "\nW\ts\t1\ts:5\n", "the digest is another one"),
    ],
)
def test_refusals(spark, tmp_path, text, said):
    (tmp_path / "ATTESTATIONS.tsv").write_text(text)
    with pytest.raises(E.Malformed, match=said):
        S.read_evidence(spark, str(tmp_path), verify=True)
    if "digest" not in said:
        with pytest.raises(E.Malformed):
            E.parse_evidence(text)


def test_first_version_without_totals_and_words_without_sources(spark, tmp_path):
    (tmp_path / "ATTESTATIONS.tsv").write_text("#old/attestations/1 language=de words=2 sources=2 built=x digest=0\nNIE\t\t\t\nW\ta:b,a\t1,2\ta:b:5 a:c a:b:x\n")
    found = S.read_evidence(spark, str(tmp_path))
    assert found.totals.count() == 0 and sorted(r["word"] for r in found.words.collect()) == ["NIE", "W"]
    assert sorted(map(tuple, found.attestations.collect())) == [("W", "a", 2, ["c"]), ("W", "a:b", 1, ["5", "x"])]


def test_cuts_come_from_sums(spark):
    rnd = random.Random(3)
    for n in (1, 5, 40):
        costs = [rnd.randrange(1, 30) for _ in range(n)]
        want, held = [1], 0
        for i, c in enumerate(costs, 1):
            if held and held + c > 50:
                want.append(i)
                held = 0
            held += c
        df = spark.createDataFrame([(i, c) for i, c in enumerate(costs, 1)], "place long, cost long")
        S_BLOCK = S.BLOCK
        try:
            S.BLOCK = 6
            assert S.shard_starts(df, 50) == want
            got = S.with_shards(df, want).select("place", "shard").orderBy("place").collect()
        finally:
            S.BLOCK = S_BLOCK
        assert [r["shard"] for r in got] == [sum(w <= i for w in want[1:]) for i in range(1, n + 1)]
    assert S.shard_starts(df.limit(0), 50) == [1]


def test_digests(spark):
    rows = [(1, "abc\n"), (2, None), (3, "ä𝔘x")]
    assert {r["id"]: r["digest"] for r in S.digests(spark.createDataFrame(rows, "id long, text string")).collect()} == {i: E.digest_of(t or "") for i, t in rows}
