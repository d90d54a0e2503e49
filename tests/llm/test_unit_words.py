"""Units of the word-end BPE, looked up by the model alone, give what the whole library gives."""

import random
import struct

import pytest

from lexwarrant.llm.vocabularies import WORD_BPE, WordBpe, vocab_path


@pytest.fixture(scope="module")
def vocabulary():
    return WordBpe(vocab_path(WORD_BPE))


def ids_of(vocabulary, text):
    return list(struct.unpack(f"<{len(vocabulary.ids(text)) // 4}I", vocabulary.ids(text)))


def by_library(vocabulary, text):
    return vocabulary._library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    "aȺb! Ⱦ?", "ȺȾ", "it's 2020, they'll--'s ''t", "\x00\x01a\x7f b\x0bc\x0cd", "¡ñandú! ª µ º ²³¹¼½¾ \xad ÿ Ǆ ǅ ǆ Ɐ", "</w>x</w>", "ß ẞ straße", "@@##$$ %%^^&&", "",
])
def test_odd_units(vocabulary, text):
    assert ids_of(vocabulary, text) == by_library(vocabulary, text)


def test_each_character_of_the_fast_path_and_random_words(vocabulary):
    rnd = random.Random(4)
    chars = [chr(c) for c in [*range(0x20), *range(0x20, 0x250)]]
    for c in chars:
        for text in (c, f"a{c}b", f"-{c}-", f"1{c} {c}{c}"):
            assert ids_of(vocabulary, text) == by_library(vocabulary, text), (c, text)
    for _ in range(2000):
        text = "".join(rnd.choices(chars, k=rnd.randrange(1, 30)))
        assert ids_of(vocabulary, text) == by_library(vocabulary, text), text


def test_units_need_no_pipeline(vocabulary):
    class Closed:
        def encode(self, *args, **more):
            raise AssertionError("the whole library was asked for a unit")

    text = "Plain words, and some naïve ones nobody has written: qwxzyv-rstbl."
    want, held = by_library(vocabulary, text), vocabulary._library
    vocabulary._units.clear()
    vocabulary._library = Closed()
    try:
        assert ids_of(vocabulary, text) == want
    finally:
        vocabulary._library = held
