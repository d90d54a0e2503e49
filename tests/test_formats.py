import bz2
import random

import pytest

from lexwarrant.sources import formats as R, readers as X


def read(spark, name, path, split, schema=None):
    reader = R.register(spark).read.format(name).option("splitBytes", split)
    return (reader.schema(schema) if schema else reader).load(str(path))


def size(folder):
    return sum(p.stat().st_size for p in ([folder] if folder.is_file() else folder.iterdir()))


def splits_of(path, n):
    return max(1, -(-size(path) // n))


def runs_of(lines):
    """Runs of verses by a plain loop."""
    out = []
    for line in lines:
        if m := R._VERSE.fullmatch(line):
            chapter = m[1] + m[2].rjust(2, "0")
            if not out or out[-1][0] != chapter:
                out.append((chapter, []))
            out[-1][1].append(m[4])
    return [(c, " ".join(v)) for c, v in out]


@pytest.fixture(scope="module")
def verses():
    rnd = random.Random(4)
    lines, n = [], 0
    while len(lines) < 900:
        chapter = rnd.choice(["GEN 1", "GEN 2", "EXO 12", "1SA 3"])
        for _ in range(rnd.choice([1, 2, 3, 30, 120])):
            n += 1
            lines.append(rnd.choice(["note", "", f"{chapter}:{n} é{n} " + "w" * rnd.randrange(90)]) if rnd.random() < 0.2 else f"{chapter}:{n} v{n}")
    return lines


@pytest.mark.parametrize("n", [1, 2, 16, 300])
def test_verses_in_any_number_of_splits(spark, tmp_path, verses, n):
    path = tmp_path / "v.txt"
    path.write_text("\n".join(verses) + "\n", encoding="utf-8")
    found = read(spark, "verse_chapters", path, splits_of(path, n))
    assert n == 1 or found.rdd.getNumPartitions() >= 0.9 * n
    got = [(r["locator"], r["text"]) for r in sorted(found.collect(), key=lambda r: r["seq"])]
    assert got == runs_of(verses)
    assert got == [(r["locator"], r["text"]) for r in X.verse_documents(spark, str(path), "s").orderBy("seq").collect()]


@pytest.mark.parametrize("n", [1, 16])
def test_runs_go_on_into_other_files(spark, tmp_path, verses, n):
    """Files cut within runs, one of them empty, one without a verse, one packed, the last without a line end."""
    parts = [verses[:7], [], verses[7:300], ["note"], verses[300:301], verses[301:]]
    for k, lines in enumerate(parts):
        raw = ("".join(x + "\r\n" for x in lines) if k < 5 else "\n".join(lines)).encode()
        (tmp_path / f"{k}.txt{'.bz2' if k == 2 else ''}").write_bytes(bz2.compress(raw) if k == 2 else raw)
    (tmp_path / "_SUCCESS").write_text("GEN 9:9 no")
    found = read(spark, "verse_chapters", tmp_path, splits_of(tmp_path, n))
    assert [(r["locator"], r["text"]) for r in sorted(found.collect(), key=lambda r: r["seq"])] == runs_of(verses)


def test_blocks_smaller_than_lines(monkeypatch, tmp_path, verses):
    path = tmp_path / "v.txt"
    path.write_bytes("\n".join(verses).encode())
    monkeypatch.setattr(R, "_BLOCK", 5)
    offsets = [0]
    for line in verses:
        offsets.append(offsets[-1] + len(line.encode()) + 1)
    for start in (0, 1, offsets[5], offsets[5] + 1, offsets[5] - 1, offsets[-1] - 2):
        want = [(o, x) for o, x in zip(offsets, verses) if o >= start and x + "x" and (o < offsets[-2] or x)]
        assert list(R._lines_of(str(path), start)) == want
    for k in (0, 1, 2, 10):
        assert list(R._lines_before(str(path), offsets[k])) == verses[:k][::-1]


@pytest.mark.parametrize("n", [1, 16])
def test_harvest_log(spark, tmp_path, n):
    rnd = random.Random(5)
    path = tmp_path / "h.tsv"
    pair = lambda: rnd.choice(["GOOD:2", "NOCOUNT", "BAD:0", "NEG:-1", "A:B:3", ":4", "É:12"])
    path.write_text("".join(f"https://x/{i}\t{' '.join(pair() for _ in range(rnd.randrange(5)))}\n" if rnd.random() < 0.9 else "\n" for i in range(500)), encoding="utf-8")
    found = read(spark, "harvest_log", path, splits_of(path, n))
    key = lambda rows: sorted((r["url"], r["word"], r["times"]) for r in rows)
    assert key(found.collect()) == key(X.harvested_counts(X.numbered_lines(spark, str(path))).collect())
    pruned = read(spark, "harvest_log", path, splits_of(path, n), "times bigint, word string")
    assert sorted(map(tuple, pruned.collect())) == sorted((r["times"], r["word"]) for r in found.collect())
    with pytest.raises(Exception, match="has no column"):
        read(spark, "harvest_log", path, 99, "page string").collect()


@pytest.mark.parametrize("split", [1 << 20, 7])
def test_leipzig(spark, tmp_path, split):
    (tmp_path / "x-inv_so.txt").write_text("1\t10\n2\t11\n999\t12\n3\t10\nbad\n")
    (tmp_path / "x-sources.txt").write_text("1\tkleinezeitung.at/old\n1\tkleinezeitung.at/a\n2\theise.de/b\tmore\n3\torf.at/c")
    (tmp_path / "x-sentences.txt").write_text("10\tEins\n11\tZwei\tdrei\n12\tVier\nohne\n\tleer\n")
    got = R.leipzig_documents(spark, str(tmp_path), "lz:x", split).orderBy("seq").collect()
    assert [(r["locator"], r["text"]) for r in got] == [("orf.at/c", "Eins"), ("heise.de/b", "Zwei\tdrei")]


def test_nothing_there(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert read(spark, "verse_chapters", tmp_path / "empty", 9).count() == 0
    with pytest.raises(Exception, match="FileNotFound"):
        read(spark, "verse_chapters", tmp_path / "none", 9).collect()
    with pytest.raises(Exception, match="positive"):
        read(spark, "verse_chapters", tmp_path / "empty", 0).collect()
