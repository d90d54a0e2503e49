import math
import zlib

import numpy as np
import pytest

from lexwarrant.llm import language_id, toxicity


@pytest.fixture(scope="module")
def model():
    counts = [("de", w, 5) for w in "der die das und nicht schön straße haus".split()] + [("en", w, 5) for w in "the and of house street nice not".split()]
    return language_id.fit(counts)


def every_segmentation(word, probability, names):
    if not word:
        return 1.0
    total = 0.0
    for k in range(1, len(word) + 1):
        if word[:k] in names:
            total += probability[names[word[:k]]] * every_segmentation(word[k:], probability, names)
        elif k == 1:
            total += language_id.OTHER * every_segmentation(word[1:], probability, names)
    return total


@pytest.mark.parametrize("word", ["haus", "thehouse", "ꙮa", "z", "ungöver", "ß"])
def test_forward_sums_all_segmentations(model, word):
    pieces = language_id.pieces()
    names = {n: i for i, n in enumerate(pieces.names)}
    got = language_id.word_scores([word, "and"], model, pieces)[0]
    expected = [math.log(every_segmentation("▁" + word, model.probability[:, l], names)) for l in range(len(model.languages))]
    assert got == pytest.approx(expected)


def test_long_words_and_probabilities(model):
    got = language_id.word_scores(["a" * 3000, "a" * 6000], model, language_id.pieces())
    assert np.isfinite(got).all() and got[1] == pytest.approx(2 * got[0], rel=0.02)
    assert model.probability.sum(axis=0) == pytest.approx(1)


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def test_languages_held_out(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r["doc_id"]: r for r in language_id.predict_languages(df).collect()}
    langs = {r["doc_id"]: r["lang"] for r in df.collect()}
    assert all(r["held_out"] == held(i) and 0 <= r["score"] <= 1 for i, r in rows.items())
    test = [i for i in rows if held(i)]
    assert sum(rows[i]["lang_pred"] == langs[i] for i in test) / len(test) > 0.98


def test_language_ignores_labels_of_held_out(documents):
    german, english = "der hund und die katze sind nicht in das haus gegangen", "the dog and the cat have not gone into the house"
    rows = [(i, german if i % 2 else english, "de" if i % 2 else "en", "s", 1) for i in range(40)]
    lied = [(i, t, "xx" if held(i) else l, s, n) for i, t, l, s, n in rows]
    predict = lambda r: sorted((x["doc_id"], x["lang_pred"], round(x["score"], 9)) for x in language_id.predict_languages(documents(r)).collect())
    assert predict(rows) == predict(lied) and {x[1] for x in predict(lied)} == {"de", "en"}


def test_languages_of_odd_rows(odd):
    got = language_id.predict_languages(odd).collect()
    assert len(got) == len(odd.rows)
    for r in got:
        if r["doc_id"] in (2, 3, 4):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    kept = language_id.with_known_language(odd, 0.0)
    assert kept.columns == odd.columns
    assert sorted(str(r["text"]) for r in kept.collect()) == sorted(str(t) for _, t, *_ in odd.rows if t and any(c.isalpha() for c in t))


def test_languages_without_labels(documents):
    df = documents([(1, "text", None, "s", 1), (2, "1234", None, "s", 1)])
    assert {r["lang_pred"] for r in language_id.predict_languages(df).collect()} == {"und"}
    assert [r["doc_id"] for r in language_id.with_known_language(df, 0.5).collect()] == [1]


def test_toxicity_held_out(spark):
    df, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = {r["doc_id"]: r for r in toxicity.score_documents(df, labels).collect()}
    assert all(r["held_out"] == held(i) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for i, r in rows.items())
    test = [(rows[r["doc_id"]], r["toxic"]) for r in labels.collect() if held(r["doc_id"])]
    hit = sum(p["predicted"] and t for p, t in test)
    assert hit / sum(t for _, t in test) > 0.75 and hit / sum(p["predicted"] for p, _ in test) > 0.8
    good = [p["score"] for p, t in test if t]
    bad = [p["score"] for p, t in test if not t]
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad) > 0.93


def toxic_rows(n=400):
    import random

    rnd = random.Random(4)
    words = [a + b + c for a in ("an", "er", "on", "th") for b in ("ti", "es", "ou", "re") for c in ("nd", "le", "st", "ha")]
    rows, labels = [], []
    for i in range(n):
        w = [rnd.choice(words) for _ in range(60)]
        if i % 4 == 0:
            for _ in range(3):
                w.insert(rnd.randrange(60), rnd.choice(["wretchface", "blorkhead", "scumgrub"]))
        rows.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, int(i % 4 == 0)))
    return rows, labels


def test_toxicity_ignores_labels_of_held_out(spark, documents):
    rows, labels = toxic_rows()
    frame = lambda l: spark.createDataFrame(l, "doc_id long, toxic int")
    score = lambda l: {r["doc_id"]: r["score"] for r in toxicity.score_documents(documents(rows), frame(l)).collect()}
    got = score(labels)
    assert got == pytest.approx(score([(i, 1 - t if held(i) else t) for i, t in labels]))
    test = [(got[i] >= 0.3, t) for i, t in labels if held(i)]
    assert sum(p == bool(t) for p, t in test) / len(test) > 0.95


def test_toxicity_of_odd_rows(spark, odd):
    for labels in ([], [(1, 1), (5, 0), (6, 0), (None, 1), (8, None), (1, 0)]):
        got = toxicity.score_documents(odd, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
        assert len(got) == len(odd.rows) and all(0 <= r["score"] <= 1 for r in got)
        assert len({r["score"] for r in got if r["doc_id"] in (2, 3, 4)}) <= 1
