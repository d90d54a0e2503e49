"""Cases that an earlier round left out."""

import random
import re
import string

import pytest

from lexwarrant.llm import language_id, line_templates, secret_scan as S


@pytest.mark.parametrize("letters", [string.ascii_letters + string.digits, string.ascii_letters])
def test_every_long_run_is_encoded(letters):
    """Random strings whose only digit is among their last characters, or that have none."""
    rnd, scan = random.Random(4), S.token_efficiency()
    runs = ["kJdhSgTqWmZxPvBnLr7aB", "kJdhSgTqWmZxPvBnLraB"] + ["".join(rnd.choice(letters) for _ in range(n)) for n in (16, 20, 24, 32) for _ in range(200)]
    for run in runs:
        text = f"use {run}, now"
        base = S.base_spans(text)
        assert S.random_spans(text, base, scan) == ([(4, 3, 4 + len(run))] if not base else []), run


def test_words_and_rules_of_signs_are_not_random():
    scan = S.token_efficiency()
    for text in ("internationalization", "a ---------------- line", "Donaudampfschifffahrtsgesellschaft", "see section_of_the-annual_report", "=" * 40):
        assert re.search(S._RUN, text) and S.random_spans(text, [], scan) == []


def test_a_passage_that_is_most_of_its_documents_goes_and_copies_keep_their_lines(documents):
    rnd = random.Random(8)
    words = [f"w{a}{b}" for a in string.ascii_lowercase for b in string.ascii_lowercase]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    rows, passages, family = [], [], []
    for _ in range(20):
        passages.append(text(60))
        rows += [passages[-1] + "\n" + text(40) for _ in range(4)]
    lines = [text(10) for _ in range(80)]
    for _ in range(30):  # near copies: some lines are other ones in each
        family.append("\n".join(text(10) if rnd.random() < 0.05 else x for x in lines))
    # one line stands in three more documents, so in four classes
    rows += family + [lines[0] + "\n" + text(60) for _ in range(3)]
    got = line_templates.without_templates(documents([(i, t, "en", "s", 1) for i, t in enumerate(rows)])).collect()
    left = {r["doc_id"]: r["text"].split("\n") for r in got}
    assert not any(p in x for p in passages for x in left.values())
    for i, t in enumerate(rows[80:110], 80):
        assert left[i] == [x for x in t.split("\n") if x != lines[0]]


def test_long_labelled_documents_are_learned_from(documents):
    rows = [(1, "lang wort " * 3000, "xx", "s", 1), (2, "short text", "yy", "s", 1)]
    found = language_id.sample_counts(documents(rows).select("doc_id", "text", "lang"))
    assert {f[0] for f in found} == {"xx", "yy"} and sum(n for lang, _, n in found if lang == "xx") == 4000
