import random
import string

import numpy as np
import pytest

from lexwarrant.llm import jaccard_join as J
from lexwarrant.llm.shingles import shingle_set


def words_of(text):
    low = "".join(c.lower() if c in string.ascii_uppercase else c for c in text or "")
    return [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in low).split(" ") if w]


def plain_set(text, width=4):
    w = words_of(text)
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def plainly(rows, needed=85):
    """(id, n_shingles, component) of (id, text) rows by all pairs."""
    sets = [plain_set(t) for _, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, _) in enumerate(rows):
        for m in range(k):
            j = rows[m][0]
            if i is None or j is None or not sets[k] or not sets[m]:
                continue
            common = len(sets[k] & sets[m])
            if 100 * common >= needed * (len(sets[k]) + len(sets[m]) - common):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted(((i, len(s), None if i is None else find(i)) for (i, _), s in zip(rows, sets)), key=str)


def found(df):
    return sorted((tuple(r) for r in J.jaccard_join(df).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_odd_rows(odd):
    assert found(odd) == plainly([(r[0], r[1]) for r in odd.rows])


def edited(rnd, words, share, vocabulary):
    return [rnd.choice(vocabulary) if rnd.random() < share else w for w in words]


def family(rnd, size, length, share, vocabulary):
    base = [rnd.choice(vocabulary) for _ in range(length)]
    return [" ".join(edited(rnd, base[: length - rnd.randrange(1 + length // 6)], share, vocabulary)) for _ in range(size)]


@pytest.fixture
def mixed_rows():
    """Families of copies from close to loose, small and large, short and long, a passage that all share, and strangers."""
    rnd = random.Random(11)
    vocabulary = [a + b + c for a in "bdgklmnprst" for b in "aeiou" for c in string.ascii_lowercase]
    texts, passage = [], " ".join(rnd.choice(vocabulary) for _ in range(60))
    for size, length, share in ((40, 120, 0.01), (90, 100, 0.02), (60, 150, 0.03), (3, 30, 0.01), (5, 6, 0.02), (12, 800, 0.004), (8, 4, 0.0), (30, 40, 0.005)):
        texts += family(rnd, size, length, share, vocabulary)
    texts += [passage + " " + " ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 60))) for _ in range(120)]
    texts += [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 80))) for _ in range(100)]
    texts += rnd.choices(texts, k=60)
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("few,many,sparse,tile,parts", [(64, 512, 4, 512, 4), (4, 20, 0, 16, 7), (8, 8, 1000, 12, 3), (1, 1000, 0, 4, 1)])
def test_all_ways_give_the_links_of_all_pairs(documents, mixed_rows, monkeypatch, spark, few, many, sparse, tile, parts):
    """Pairs and crowds, whole and many tiles, ranges that cut runs."""
    monkeypatch.setattr(J, "FEW", few)
    monkeypatch.setattr(J, "MANY", many)
    monkeypatch.setattr(J, "SPARSE", sparse)
    monkeypatch.setattr(J, "LEAST", 16 * sparse)
    monkeypatch.setattr(J, "TILE", tile)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = found(documents([(i, t, "en", "s", 1) for i, t in mixed_rows]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = plainly(mixed_rows)
    assert got == want
    assert len({c for *_, c in want}) < len(want) - 100


def test_order_of_any_kind_gives_the_same(documents, mixed_rows, monkeypatch):
    monkeypatch.setattr(J, "COMMON", 2)
    monkeypatch.setattr(J, "MOST_COMMON", 50)
    rows = mixed_rows[:300]
    assert found(documents([(i, t, "en", "s", 1) for i, t in rows])) == plainly(rows)


def test_a_bitmap_never_fails_a_link():
    rnd = np.random.default_rng(5)
    for n in (1, 5, 40, 500, 9000):
        pool = rnd.integers(0, 1 << 63, 2 * n + 2, dtype=np.uint64)
        for _ in range(40):
            k = int(rnd.integers(0, max(1, n // 5) + 1))
            x, y = np.unique(pool[:n]), np.unique(pool[k : n + k])
            bx, by = (J.bitmap(s, J.bitmap_bits(len(s))) for s in (x, y))
            size = min(len(bx), len(by))
            differ = int(np.bitwise_count(J.folded(bx, size) ^ J.folded(by, size)).sum())
            assert differ <= len(np.setxor1d(x, y))
            for needed in (60, 85, 100):
                assert J.can_link(differ, len(x), len(y), needed) or not J.linked_sets(x, y, needed)
    assert np.array_equal(J.folded(J.bitmap(pool, 1024), 4), J.bitmap(pool, 256))


def test_links_share_a_shingle_looked_at():
    rnd = random.Random(2)
    common = np.zeros((2, 0), np.int64)
    for n in range(1, 60):
        base = [f"w{i}" for i in range(n + 3)]
        x, y = (shingle_set(" ".join(edited(rnd, base, 0.03, ["q", "r"])), 4) for _ in range(2))
        if J.linked_sets(x, y, 85):
            assert set(J.first_shingles(x, common, 85).tolist()) & set(J.first_shingles(y, common, 85).tolist())
