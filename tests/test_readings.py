import random
import sys

import pytest

from lexwarrant.sources import readings as R
from lexwarrant.sources.readers import DOCUMENT

_LOOP = "import sys\nfor line in sys.stdin:\n    locator, _, text = line.rstrip('\\n').partition('\\t')\n"


def child(*body):
    return [sys.executable, "-c", _LOOP + "".join(f"    {line}\n" for line in body)]


UPPER = child("print(locator, text.upper(), sep='\\t', flush=True)")


def answers(rows, command, strict=False):
    return [row for found in R.exchange(rows, command, strict) for row in found]


def test_ten_thousand_documents_by_brute_force(spark):
    """Equal locators, odd white space, null and empty texts, answers out of order and strays among them."""
    rnd = random.Random(1)
    rows = [(f"s{i % 3}", i, f"loc{rnd.randrange(9000)}", rnd.choice([None, "", "ab\tc", "x\r\n\ny", f"wort {i} é", "z" * rnd.randrange(50)])) for i in range(10_000)]
    script = "import sys\nheld = []\n" + _LOOP.split("\n", 1)[1] + (
        "    held.append(locator + '\\t' + text.swapcase())\n    if len(held) == 7:\n        print('nonsense', 'stray\\tline', *held[::-1], sep='\\n', flush=True)\n        held = []\n"
        "print(*held, sep='\\n')\n"
    )
    got = R.readings_by_process(spark.createDataFrame(rows, DOCUMENT), [sys.executable, "-c", script]).collect()
    flat = lambda t: R.re.sub(r"[\t\n\r]+", " ", t or "")
    # of documents with one locator answers come in the child's order, so they are compared as sets of texts
    want = sorted((locator, flat(t).swapcase()) for _, _, locator, t in rows if flat(t))
    assert sorted((r["locator"], r["text"]) for r in got) == want
    assert len({(r["source"], r["seq"]) for r in got}) == len(got)


def test_places_stay_with_their_documents(spark):
    rows = [("s", i, f"l{i}", f"t{i}") for i in range(3000)]
    got = R.readings_by_process(spark.createDataFrame(rows, DOCUMENT), UPPER, strict=True).collect()
    assert sorted(map(tuple, got)) == sorted((s, i, at, t.upper()) for s, i, at, t in rows)


def test_order_of_one_partition():
    assert [r[2] for r in answers([("s", i, c, c) for i, c in enumerate("abcd")], UPPER)] == list("abcd")


def test_texts_far_larger_than_a_pipe():
    """A megabyte each, from a child that answers at once and from one that reads all before it says a word."""
    rows = [("s", i, str(i), "wort " * 200_000) for i in range(30)]
    late = [sys.executable, "-c", "import sys\nfor line in sys.stdin.readlines():\n    sys.stdout.write(line)"]
    for command in (UPPER, late):
        assert sorted(r[2] for r in answers(rows, command)) == sorted(str(i) for i in range(30))


def test_a_child_that_says_much_and_reads_slowly():
    loud = child("print(*['stray\\t' + 'x' * 1000] * 50, locator + '\\t' + text, sep='\\n', flush=True)")
    assert len(answers([("s", i, str(i), "y" * 5000) for i in range(400)], loud)) == 400


@pytest.mark.parametrize("line", ["'extra\\tnoise'", "'nope'", "'https://invented/\\ttext'"])
def test_strays(line):
    chatty = child("print(locator, text, sep='\\t')", f"print({line})")
    rows = [("s", 1, "a", "one"), ("s", 2, "b", "two")]
    assert answers(rows, chatty) == rows
    with pytest.raises(R.ReaderFailed, match="wasn't asked"):
        answers(rows, chatty, strict=True)


def test_answers_beyond_what_was_asked_are_strays():
    twice = child("print(locator, text, sep='\\t')", "print(locator, 'again', sep='\\t')")
    assert answers([("s", 1, "a", "one"), ("s", 2, "b", "two")], twice) == [("s", 1, "a", "one"), ("s", 2, "b", "two")]


def test_nothing_read():
    assert answers([("s", 1, "a", ""), ("s", 2, "b", None), ("s", 3, None, "x"), ("s", 4, "", "x")], UPPER) == []
    assert answers([], UPPER) == []
    assert answers([("s", 1, "a", "x")], child("print('nope', flush=True)")) == []


@pytest.mark.parametrize("rows", [0, 1, 5000])
def test_a_broken_reader_fails(rows):
    bad = [sys.executable, "-c", "import sys\nsys.stderr.write('no dictionary')\nsys.exit(3)"]
    with pytest.raises(R.ReaderFailed, match="exited 3: no dictionary"):
        answers([("s", i, str(i), "x" * 1000) for i in range(rows)], bad)


def test_one_that_ends_late_or_early_or_by_a_signal():
    rows = [("s", i, str(i), "x" * 1000) for i in range(3000)]
    for ends, said in (("sys.exit(4) if locator == '2999' else None", "exited 4"), ("sys.exit(5) if locator == '7' else None", "exited 5"), ("import os; os.kill(os.getpid(), 9)", "exited -9")):
        with pytest.raises(R.ReaderFailed, match=said):
            answers(rows, child("print(locator, text, sep='\\t')", ends))


def test_errors_reach_the_job(spark):
    docs = spark.createDataFrame([("s", 1, "a", "x")], DOCUMENT)
    with pytest.raises(Exception, match="exited 3"):
        R.readings_by_process(docs, [sys.executable, "-c", "raise SystemExit(3)"]).collect()
    with pytest.raises(Exception, match="can't be asked about"):
        R.readings_by_process(spark.createDataFrame([("s", 1, "a\tb", "x")], DOCUMENT), UPPER).collect()
    with pytest.raises(R.ReaderFailed, match="decode"):
        answers([("s", 1, "a", "x")], child("sys.stdout.buffer.write(b'a\\t\\xff\\n')"))
