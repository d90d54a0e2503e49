import hashlib
import random
import re

import numpy as np
import pytest

from lexwarrant.llm import fim
from pyspark.sql import functions as F


def plainly(text, doc_id):
    """The rule by lists of units."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return len(units), form, len(p), len(m), out


def test_rank_and_select_by_brute_force():
    rnd = np.random.default_rng(3)
    for n in (0, 1, 63, 64, 65, 511, 512, 513, 5000):
        for density in (0.0, 0.02, 0.5, 1.0):
            bits = rnd.random(n) < density
            v, ones = fim.BitVector(bits), np.nonzero(bits)[0].tolist()
            assert v.total == len(ones)
            assert [v.select(k) for k in range(len(ones) + 2)] == [*ones, n, n]
            assert [v.rank(i) for i in range(n + 2)] == [*np.concatenate([[0], np.cumsum(bits)]).tolist(), len(ones)][: n + 2]


def test_odd_rows(odd):
    got = fim.fill_in_middle(odd).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(((r[0], *plainly(r[1], r[0])) for r in odd.rows), key=key)


def test_whole_sample_and_round_trip(sample):
    found = fim.fill_in_middle(sample)
    got = {r["doc_id"]: r for r in found.withColumn("again", fim.restored(F.col("output"), F.col("form"))).collect()}
    assert {r["form"] for r in got.values()} == {"plain", "psm", "spm"}
    for i, text in sample.texts.items():
        r = got[i]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plainly(text, i)
        assert r["again"] == (text or "")
        if r["form"] != "plain":
            raw = (text or "").encode()
            assert raw[: r["middle_from"]].decode() + raw[r["middle_from"] :].decode() == text and len(raw[r["middle_from"] : r["middle_to"]].decode()) == r["middle_chars"]


def test_texts_around_marks_and_long_ones(documents):
    rnd, pieces = random.Random(5), ["<", "P", ">", "<P", "<S", "S>", "M>", "\n", "é", "𝔘", "word", "0", " "]
    rows = [(i, "".join(rnd.choice(pieces) for _ in range(rnd.randrange(12))), "en", "s", 1) for i in range(400)]
    rows += [(1000, "<M>", "en", "s", 1), (1001, "ab 日本語 " * 100_000, "en", "s", 1), (1002, "x" * 300_000, "en", "s", 1), (1002, "x" * 300_000, "en", "s", 1)]
    got = fim.digests(documents(rows)).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = sorted(((i, n, form, a, m, sha(out), sha(t)) for i, t, *_ in rows for n, form, a, m, out in [plainly(t, i)]), key=str)
    assert sorted(map(tuple, got), key=str) == want


@pytest.mark.parametrize("rate,spm", [(0, 20), (100, 0), (100, 100)])
def test_rates(documents, rate, spm):
    got = {r["form"] for r in fim.fill_in_middle(documents([(i, "some words here", "en", "s", 1) for i in range(50)]), rate=rate, spm_rate=spm).collect()}
    assert got == {"plain" if not rate else "spm" if spm else "psm"}
