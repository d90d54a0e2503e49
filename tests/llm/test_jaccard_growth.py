"""Steps of the Jaccard join whose rows once grew with the square of the table."""

import random

import numpy as np
import pytest

from lexwarrant.llm import jaccard_join as J
from lexwarrant.llm.shingles import shingle_set


def text_of(words):
    return " ".join(words)


def test_strangers_that_share_a_shingle_are_no_candidates(documents, monkeypatch):
    """60 texts that share one shingle of four words each with all others, and two that are near copies."""
    texts = [text_of([f"w{i}x{k}" for k in range(12)] + ["all", "share", "these", "words"] + [f"v{i}x{k}" for k in range(12)]) for i in range(60)]
    long = [f"u{k}" for k in range(60)]
    texts += [text_of(long), text_of(long[:-1] + ["other"])]
    seen, bounded = [], J.within_bounds
    monkeypatch.setattr(J, "within_bounds", lambda pairs, *more: seen.append(pairs.collect()) or bounded(pairs, *more))
    got = {r["doc_id"]: r["component_id"] for r in J.jaccard_join(documents([(i, t, "en", "s", 1) for i, t in enumerate(texts)])).collect()}
    assert got == {i: i for i in range(61)} | {61: 60}
    assert [tuple(r) for r in seen[0]] == [(60, 61)]


@pytest.mark.parametrize("needed", [1, 60, 85, 100])
def test_links_share_as_many_shingles_as_are_agreed(needed):
    rnd, links = random.Random(3), 0
    common = np.zeros((2, 0), np.int64)
    for n in [*range(1, 30)] * 12:
        base = [f"w{i}" for i in range(n + 3)]
        x, y = (shingle_set(text_of([rnd.choice("qr") if rnd.random() < 0.04 else w for w in base[: n + 3 - rnd.randrange(1 + n // 6)]]), 4) for _ in range(2))
        if J.linked_sets(x, y, needed):
            links += 1
            first, second = (J.first_shingles(s, common, needed).tolist() for s in (x, y))
            both, least = sorted(set(first) & set(second)), min(J.agreed(len(s), needed) for s in (x, y))
            assert len(both) >= least
            # each of the first ones passes the bound by sizes and places
            for k in both[:least]:
                a, b = (np.array([(len(s) << 32) + f.index(k)]) for s, f in ((x, first), (y, second)))
                assert J.in_bounds(a, b, needed, J.AGREE - 1).all()
    assert links > 50


def test_the_share_of_documents_drawn_has_a_least(documents, monkeypatch):
    """Shingles that 20 of 400 documents share are known as common, however few documents would do."""
    monkeypatch.setattr(J, "SAMPLE", 16)
    monkeypatch.setattr(J, "EVERY", 2, raising=False)
    rows = [(i, text_of([f"g{i % 20}a", f"g{i % 20}b", f"g{i % 20}c", f"g{i % 20}d", *[f"w{i}x{k}" for k in range(8)]]), "en", "s", 1) for i in range(400)]
    known = set(J.common_shingles(documents(rows), 4)[0].view(np.uint64).tolist())
    shared = {int(shingle_set(f"g{k}a g{k}b g{k}c g{k}d", 4)[0]) for k in range(20)}
    assert shared <= known
