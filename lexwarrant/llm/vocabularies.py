"""Public tokenizer files, found by name, and caches of what their units encode to.

The folder is a parameter everywhere (``vocab_dir``); left out, it is that of the installed
``public_tokenizers`` module. Files are read where a task runs and never copied.
"""

from __future__ import annotations

import array
import ctypes
import functools
import os
import re
import sys
import weakref

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"
BYTE_RANKS = "byte_bpe_50k.tiktoken"

#: Entries the caches of a worker may hold before they are emptied; about 250 bytes each.
CACHE_ENTRIES = 600_000


def vocab_path(name: str, vocab_dir: str | None = None) -> str:
    if vocab_dir:
        return os.path.join(vocab_dir, name)
    import public_tokenizers

    return public_tokenizers.path(name)


_caches: weakref.WeakSet = weakref.WeakSet()


def _give_back() -> None:
    """Return freed memory to the system, where the C library can: a worker lives on after its task."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


class Cache(dict):
    """A dictionary that computes what it lacks.

    Entries are in two generations: once there are too many, the younger becomes the older and what was
    older goes; an older entry that is asked for is young again. A worker process is used for one task
    after another, so ``trim`` also empties the caches that tasks of other operators have left in it;
    ``beside`` are caches of the same operator.
    """

    __hash__ = object.__hash__

    def __init__(self, compute, limit: int = CACHE_ENTRIES):
        super().__init__()
        self.compute, self.limit, self.older = compute, limit, {}
        _caches.add(self)

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value

    def clear(self) -> None:
        super().clear()
        self.older = {}

    def trim(self, beside: tuple[Cache, ...] = ()) -> None:
        own = (self, *beside)
        left = [c for c in _caches if (c or c.older) and all(c is not o for o in own)]
        for cache in left:
            cache.clear()
        if full := sum(map(len, own)) > self.limit // 2:
            for cache in own:
                young = dict(cache)
                cache.clear()
                cache.older = young
        if left or full:
            _give_back()


class WordBpe:
    """Token ids of the lower-casing word-end BPE, as little-endian unsigned 32-bit bytes.

    The library's pre-tokenizer cuts a normalised text into units that merges never cross, so the
    ids of a text are those of its units in a row. Texts of printable ASCII and Latin letters are
    cut here by the same pattern and their units looked up in a cache that the library's model fills: a
    unit is one of its words, with bytes written as characters. Any other text (marks that compose,
    other scripts, special tokens) goes through the library whole.
    """

    #: Letters that leave the range in lower case: the dotted capital I, which becomes two, and such as Ɓ.
    _LEAVING = "".join(c for c in map(chr, range(0xA1, 0x250)) if len(c.lower()) > 1 or c.lower() > "ɏ")
    #: What the fast path can't take: these and other characters, and the start of special tokens.
    _OTHER = re.compile(f"[^\n\r\t\x20-\x7e¡-ɏ]|[{_LEAVING}]|<\\|")
    #: The tokenizer's own split pattern, spelled out for that range after lower-casing; letters, which
    #: none of the other parts can begin with, are tried first.
    _UNIT = re.compile(
        "[a-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+"
        "|[0-9\u00b2\u00b3\u00b9\u00bc-\u00be]"
        "|'s|'t|'re|'ve|'m|'ll|'d"
        "|[^\\s0-9a-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u00b2\u00b3\u00b9\u00bc-\u00be]+"
    )

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._model = self._library.model
        # bytes that are no visible character are the 256th character and those that follow it
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        self._bytes = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in shown)}
        self._units = Cache(self._encode_unit)

    @staticmethod
    def _little(ids: list[int]) -> bytes:
        packed = array.array("I", ids)
        if packed.itemsize != 4 or sys.byteorder != "little":
            return b"".join(i.to_bytes(4, "little") for i in ids)
        return packed.tobytes()

    def _encode(self, text: str) -> bytes:
        return self._little(self._library.encode(text, add_special_tokens=False).ids)

    def _encode_unit(self, unit: str) -> bytes:
        if not (unit.isascii() and unit.isprintable()):
            unit = unit.encode().decode("latin-1").translate(self._bytes)
        return self._little([token.id for token in self._model.tokenize(unit)])

    def _plain(self, text: str) -> bool:
        """Whether the fast path can take a text; that of ASCII only costs next to nothing."""
        if text.isascii():
            # what this language's white space has beside the tokenizer's, and the start of special tokens
            return not any(mark in text for mark in ("<|", "\x1c", "\x1d", "\x1e", "\x1f"))
        return not self._OTHER.search(text)

    def ids(self, text: str) -> bytes:
        if not self._plain(text):
            return self._encode(text)
        return b"".join(map(self._units.__getitem__, self._UNIT.findall(text.lower())))

    def trim(self) -> None:
        self._units.trim()


@functools.lru_cache(maxsize=2)
def word_bpe(vocab_dir: str | None = None) -> WordBpe:
    return WordBpe(vocab_path(WORD_BPE, vocab_dir))
