"""Text expressions: tokens, folds, wikitext and HTML to prose."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Fixed values of the counting rule: what a word is (a letter, then letters, marks and apostrophes), the
# folded characters a token must have to count, which define every denominator, and what counts as space
# in HTML and wikitext (Java's own class lacks the last ones).
TOKEN = r"\p{L}[\p{L}\p{M}'’]*"
SHORTEST = 3
SPACE = r"[ \t\r\n\f\x0b\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"


def tokens(text: Column) -> Column:
    """All words of a text, in order."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def _normalised(method: str, text: Column) -> Column:
    """A form of Unicode by the library that Spark itself carries; no Python."""
    return F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit(method), text, F.lit(False))


def nfc(text: Column) -> Column:
    """Composed form. A text of Latin letters and signs before U+0300 alone is in it already."""
    return F.when(text.rlike(r"[^\x00-\x{2FF}]"), _normalised("compose", text)).otherwise(text)


def nfd(text: Column) -> Column:
    return F.when(text.rlike(r"[^\x00-\x7F]"), _normalised("decompose", text)).otherwise(text)


def upper_ss(word: Column) -> Column:
    """The default fold: sharp s as two letters, then upper case."""
    return F.upper(F.replace(word, F.lit("ß"), F.lit("ss")))


def _bare(word: Column) -> Column:
    return F.regexp_replace(nfd(word), r"\p{M}+", "")


def _unmarked(word: Column, keep: str = "") -> Column:
    """Upper case without marks, except on letters that are letters of their own."""
    aside = "".join(chr(0xE000 + i) for i in range(len(keep)))  # private characters, which have no other form
    held = F.translate(upper_ss(nfc(word)), keep, aside) if keep else upper_ss(nfc(word))
    bare = _bare(held)
    return F.translate(bare, aside, keep) if keep else bare


def _korean(word: Column) -> Column:
    """Compatibility jamo; a compound final is its two letters."""
    leads, vowels = "ㄱㄲㄴㄷㄸㄹㅁㅂㅃㅅㅆㅇㅈㅉㅊㅋㅌㅍㅎ", "ㅏㅐㅑㅒㅓㅔㅕㅖㅗㅘㅙㅚㅛㅜㅝㅞㅟㅠㅡㅢㅣ"
    finals = ["ㄱ", "ㄲ", "ㄱㅅ", "ㄴ", "ㄴㅈ", "ㄴㅎ", "ㄷ", "ㄹ", "ㄹㄱ", "ㄹㅁ", "ㄹㅂ", "ㄹㅅ", "ㄹㅌ", "ㄹㅍ", "ㄹㅎ", "ㅁ", "ㅂ", "ㅂㅅ", "ㅅ", "ㅆ", "ㅇ", "ㅈ", "ㅊ", "ㅋ", "ㅌ", "ㅍ", "ㅎ"]
    word = nfd(nfc(word))
    for i, final in enumerate(finals):
        if len(final) > 1:
            word = F.replace(word, F.lit(chr(0x11A8 + i)), F.lit(final))
    single = [(chr(0x11A8 + i), f) for i, f in enumerate(finals) if len(f) == 1]
    parts = [(chr(0x1100 + i), c) for i, c in enumerate(leads)] + [(chr(0x1161 + i), c) for i, c in enumerate(vowels)] + single
    return F.translate(word, "".join(a for a, _ in parts), "".join(b for _, b in parts))


def _japanese(word: Column) -> Column:
    """Hiragana without voicing or small size; the long mark stays."""
    katakana = "".join(map(chr, range(ord("ァ"), ord("ヶ") + 1)))
    plain = F.regexp_replace(nfd(F.translate(nfc(word), katakana, "".join(chr(ord(c) - 0x60) for c in katakana))), "[\u3099\u309a]", "")
    return F.translate(plain, "ぁぃぅぇぉっゃゅょゎゕゖ", "あいうえおつやゆよわかけ")


#: Letters of their own, by language: of what decomposes to a letter and marks, these keep their marks. Letters that
#: don't decompose (as in Danish, Icelandic, Polish or Serbian) are kept in any case. Where all marks go, there are none.
LETTERS: dict[str, str] = {
    "af": "", "ar": "أإآؤئ", "arz": "أإآؤئ", "bg": "Й", "ca": "Ç", "cs": "ÁČĎÉĚÍŇÓŘŠŤÚŮÝŽ", "cy": "", "da": "Å", "de": "ÄÖÜ", "el": "", "en": "", "es": "Ñ", "et": "ÄÖÜÕŠŽ",
    "eu": "Ñ", "fa": "آ", "fi": "ÄÖÅ", "fr": "", "ga": "ÁÉÍÓÚ", "gl": "Ñ", "he": "", "hr": "ČĆŠŽ", "hu": "ÁÉÍÓÖŐÚÜŰ", "hy": "", "id": "", "is": "ÁÉÍÓÖÚÝ",
    "it": "", "la": "", "lt": "ĄČĘĖĮŠŲŪŽ", "lv": "ĀČĒĢĪĶĻŅŠŪŽ", "mk": "ЃЌ", "ms": "", "nl": "", "no": "Å", "pcm": "", "pl": "ĄĆĘŃÓŚŹŻ", "pt": "Ç", "pt-BR": "Ç",
    "ro": "ĂÂÎȘȚ", "ru": "Й", "sk": "ÁÄČĎÉÍĹĽŇÓÔŔŠŤÚÝŽ", "sl": "ČŠŽ", "sr": "", "sv": "ÅÄÖ", "sw": "", "tl": "Ñ", "uk": "ЇЙ",
}


def own_letters(letters: str) -> str:
    """Those of an alphabet's ``letters`` that decompose, which alone make its fold differ from another's."""
    return "".join(c for c in letters if unicodedata.normalize("NFD", c) != c)


def alphabet_fold(letters: str) -> Callable[[Column], Column]:
    """The fold of an alphabet: composed, in upper case, without marks but on ``letters``, which are given in upper case.

    A mark on a letter that isn't of the alphabet goes, and the letter stays.
    """
    marked = own_letters(letters)
    return lambda word: _unmarked(word, marked)


#: Folds that an alphabet alone doesn't tell, by language tag. What is neither here nor in ``LETTERS`` folds by ``upper_ss``.
FOLDS: dict[str, Callable[[Column], Column]] = {
    "tr": lambda w: F.upper(F.translate(nfc(w), "iı", "İI")),
    "el": lambda w: _unmarked(F.translate(w, "ς", "σ")),
    "ka": F.lower,
    "ko": _korean,
    "ja": _japanese,
    "he": lambda w: F.translate(_bare(w), "ךםןףץ", "כמנפצ"),
    "ru": lambda w: _unmarked(F.translate(nfc(w), "ёЁ", "еЕ"), LETTERS["ru"]),
    # Romanian letters with a comma below are also written with a cedilla
    "ro": lambda w: _unmarked(F.translate(nfc(w), "şţŞŢ", "șțȘȚ"), LETTERS["ro"]),
    "vi": lambda w: F.replace(F.upper(nfc(w)), F.lit(" "), F.lit("")),
}


#: The tag of no language: sharp s and upper case, marks stay.
PLAIN = "und"


def fold(word: Column, language: str = PLAIN) -> Column:
    """The key of a word; of several words too, line by line."""
    if language in FOLDS:
        return FOLDS[language](word)
    return alphabet_fold(LETTERS[language])(word) if language in LETTERS else upper_ss(word)


def keys(text: Column, language: str = PLAIN) -> Column:
    """One folded key per word of a text: an array, in order, keys that are too short left out.

    All words of a text are folded in one go, a line each, so that a fold is a few calls a text.
    """
    folded = F.split(fold(F.array_join(tokens(nfc(text)), "\n"), language), "\n")
    return F.filter(folded, lambda k: F.length(k) >= SHORTEST)


def strip_wikitext(text: Column) -> Column:
    """Prose of wikitext as dumps hold it, entities undecoded. The order of steps is part of the rule."""
    steps = (
        (r"(?s)<ref[^>]*>.*?</ref>", " "),
        (r"<[^>]+>", " "),
        (r"(?s)\{\{.*?\}\}", " "),
        (r"(?s)\{\|.*?\|\}", " "),
        (r"\[\[(?:[^|\]]*\|)?([^\]]*)\]\]", "$1"),
        (r"(?m)^={2,}[^\n\r\u2028\u2029]*$", " "),
        (r"&[a-z]+;", " "),
        (rf"https?://(?:(?!{SPACE}).)+", " "),
    )
    for pattern, by in steps:
        text = F.regexp_replace(text, pattern, by)
    return text


def _numeric_entities(text: Column) -> Column:
    """``&#233;`` and the like as their characters; a number beyond Unicode is an error."""
    between = F.split(text, "&#[0-9]+;", -1)
    numbers = F.transform(F.regexp_extract_all(text, F.lit("&#([0-9]+);"), F.lit(1)), lambda n: n.cast("decimal(38,0)"))
    known = lambda n: F.when((n <= 0x10FFFF), n.cast("long")).otherwise(F.raise_error(F.concat(F.lit("no code point "), n.cast("string"))).cast("long"))
    letters = F.transform(numbers, lambda n: F.decode(F.unhex(F.lpad(F.hex(known(n)), 8, "0")), "UTF-32"))
    return F.array_join(F.zip_with(between, F.concat(letters, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")


def readable_text(html: Column) -> Column:
    """Readable text of a page. Scripts and the like go first, then tags, then entities."""
    for name in ("script", "style", "noscript"):
        html = F.regexp_replace(html, rf"(?is)<{name}\b[^>]*>.*?</{name}>", " ")
    for pattern, by in ((r"(?s)<!--.*?-->", " "), (r"<[^>]+>", " "), (r"(?i)&nbsp;", " "), (r"(?i)&amp;", "&"), (r"(?i)&quot;", '"')):
        html = F.regexp_replace(html, pattern, by)
    # only pages that have any go through Python
    html = F.when(html.rlike("&#[0-9]+;"), _numeric_entities(html)).otherwise(html)
    html = F.regexp_replace(html, r"(?i)&[a-z]+;", " ")
    return F.trim(F.regexp_replace(html, rf"{SPACE}+", " "))


def escaped(text: Column) -> Column:
    """``text`` as it may stand in markup."""
    for sign, by in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(sign), F.lit(by))
    return text


def gutenberg_body(text: Column) -> Column:
    """A book without the licence around it; no start line, no text."""
    start = r"(?m)^\*\*\*+ ?START OF (?:THE|THIS) PROJECT GUTENBERG EBOOK[^\n\r\u2028\u2029]*$"
    end = r"(?m)^\*\*\*+ ?END OF (?:THE|THIS) PROJECT GUTENBERG EBOOK[^\n\r\u2028\u2029]*$"
    opened, closed = F.regexp_substr(text, F.lit(start)), F.regexp_substr(text, F.lit(end))
    first = F.instr(text, opened) + F.length(opened)
    last = F.instr(text, closed)
    rest = F.substring(text, first, F.length(text))
    return F.when(text.isNull(), F.lit(None)).when(opened.isNull(), F.lit("")).when(closed.isNull() | (last < first), rest).otherwise(F.substring(text, first, last - first))
