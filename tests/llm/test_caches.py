from lexwarrant.llm import language_id, vocabularies
from lexwarrant.llm.vocabularies import Cache


def test_generations():
    asked = []
    cache = Cache(lambda k: asked.append(k) or k * 2, limit=4)
    assert [cache[k] for k in (1, 2, 3)] == [2, 4, 6]
    cache.trim()
    assert not cache and cache[2] == 4 and asked == [1, 2, 3]
    assert [cache[k] for k in (7, 8)] == [14, 16]
    cache.trim()  # 1 and 3 go, 2 was asked for again
    assert cache[2] == 4 and asked == [1, 2, 3, 7, 8] and cache[1] == 2 and asked[-1] == 1


def test_other_operators_are_emptied():
    one, two, beside = (Cache(lambda k: k) for _ in range(3))
    one[1], two[1], beside[1] = 1, 1, 1
    two.trim(beside=(beside,))
    assert not one and two and beside


def test_results_dont_depend_on_the_limit(monkeypatch):
    model = language_id.fit([("de", w, 3) for w in "der die das und nicht haus".split()] + [("en", w, 3) for w in "the and of house not".split()])
    rows = [f"das haus und der {a}{b} {a}" for a in "abcdefgh" for b in "klmnop"]
    free = [language_id.Scorer(model, language_id.pieces()).predict(rows)]
    tight = language_id.Scorer(model, language_id.pieces())
    tight._row.limit = 30
    assert [tight.predict([r])[0] for r in rows] == free[0]
    bpe = vocabularies.WordBpe(vocabularies.vocab_path(vocabularies.WORD_BPE))
    expected = [bpe.ids(r) for r in rows]
    bpe._units.limit = 6
    for r, ids in zip(rows, expected):
        assert bpe.ids(r) == ids
        bpe.trim()
