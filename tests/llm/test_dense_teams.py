import random

from lexwarrant.llm import near_dedup

from .test_near_and_lines import check


def test_a_small_dense_team_is_compared_whole_at_the_first_level(documents, monkeypatch):
    """Partners of 0.80 to 0.83 among 40 documents alike at about 0.5, dense at ten: one pass finds all links."""
    monkeypatch.setattr(near_dedup, "DENSE", 10)
    rnd, texts, passes = random.Random(9), {}, []
    shared = [f"s{k}" for k in range(125)]
    for i in range(0, 40, 2):
        w = shared + [f"o{i}x{k}" for k in range(62)]
        texts[i] = " ".join(w)
        for k in (5, 70, 150):
            w[k] = f"z{i}{rnd.randrange(9)}"
        texts[i + 1] = " ".join(w)
    look = near_dedup.looked_through
    monkeypatch.setattr(near_dedup, "looked_through", lambda rows, needed: passes.append(needed) or look(rows, needed))
    check(documents([(i, t, "en", "s", len(t)) for i, t in texts.items()]), texts, 4)
    assert len(passes) == 1
