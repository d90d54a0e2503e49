"""Secret spans: three fixed patterns, and random strings that a token vocabulary finds inefficient.

Words of a language take few tokens for their length; random strings take many. Every maximal run of
credential characters is encoded by a byte-level vocabulary where it has a letter, with or without digits, and
a low number of characters per token marks it as random. What isn't random as a whole is looked at in its parts:
between the slashes and equal signs of a path, then between other separators, and at last in windows of what has none,
which must be more inefficient still. Known digests are left out where their text says that they are digests
(``sha256-...``, ``checksum: ...``), UUIDs always, and identifiers (parts that are words or numbers) where their words
are no random strings themselves.
"""

from __future__ import annotations

import functools
import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .arrow import columns_of, slices, spread, texts, type_of
from .vocabularies import BYTE_RANKS, vocab_path

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A maximal run of 16 or more; a shorter run fails the length test anyway.
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")
LEAST = {"assign": 12, "access": 18, "hex": 16}

#: Where a random string may stand: every maximal run of these characters that is long enough.
_SHORTEST = 16
_RUN = re.compile(rf"[A-Za-z0-9_+/=.-]{{{_SHORTEST},}}")
#: At most so many characters per token; words and identifiers have more.
CHARS_PER_TOKEN = 2.0
#: Characters that are encoded at once, as encoding takes longer than in proportion; a longer run is several such parts.
_AT_ONCE = 2_048
#: Windows of a run must be longer and have fewer characters per token, as parts of long words may.
WINDOW, WINDOW_CHARS_PER_TOKEN = 20, 1.5
_DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_DIGEST = re.compile(r"(sha\d+[-_=.:]?|md5[-_=.:]?)?([0-9a-fA-F]+)\Z")
#: What a text says before a digest, within so many characters.
_SAYS_DIGEST = re.compile(r"(?:sha-?\d*|md5|digest|checksum|hash|commit|revision|etag|integrity|fingerprint)[^A-Za-z0-9]{0,4}\Z", re.IGNORECASE)
_BEFORE = 24
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_SEGMENT, _BETWEEN = re.compile(r"[^/=]+"), re.compile(r"[^-_.+]+")


class TokenEfficiency:
    def __init__(self, path: str):
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._lengths = {i: len(b) for b, i in ranks.items()}
        self._encode = tiktoken.Encoding("ranks", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def lengths(self, run: str) -> list[int]:
        """Characters of each token; runs are ASCII."""
        return [self._lengths[t] for i in range(0, len(run), _AT_ONCE) for t in self._encode(run[i : i + _AT_ONCE])]

    def chars_per_token(self, run: str) -> float:
        return len(run) / len(self.lengths(run))

    def random(self, run: str, before: str = "") -> bool:
        """Whether a run is random as a whole; ``before`` is the text in front of it."""
        if len(run) < _SHORTEST or not any(c.isalpha() for c in run) or known(run, before):
            return False
        # an identifier, separated parts each of which is one word or one number, is what its words are
        parts = re.split(r"[-_./=+]", run)
        if len(parts) > 1 and all(not p or _PART.fullmatch(p) for p in parts):
            run = "".join(parts)
        return self.chars_per_token(run) <= CHARS_PER_TOKEN

    def windows(self, run: str) -> list[tuple[int, int]]:
        """(start, end) of stretches of whole tokens that are long and inefficient enough.

        A token counts by how far it is below the limit. Stretches are the ones with the highest sums: none can be
        shortened at an end, or put together with another, without losing. One pass finds them all.
        """
        if len(run) < WINDOW:
            return []
        ends, total = [0, *accumulate(self.lengths(run))], 0.0
        held: list[tuple[int, int, float, float]] = []  # first and last token, sums before and up to its end
        for k in range(len(ends) - 1):
            before, total = total, total + WINDOW_CHARS_PER_TOKEN - (ends[k + 1] - ends[k])
            if total <= before:
                continue
            first, start = k, before
            while True:
                at = next((i for i in range(len(held) - 1, -1, -1) if held[i][2] < start), None)
                if at is None or held[at][3] >= total:
                    break
                first, start = held[at][0], held[at][2]
                del held[at:]
            held.append((first, k + 1, start, total))
        return [(ends[i], ends[j]) for i, j, *_ in held if ends[j] - ends[i] >= WINDOW]

    def spans(self, run: str, before: str = "") -> list[tuple[int, int]]:
        """(start, end) of a run's random stretches: the whole, or segments, or parts of segments, or windows of these."""
        said_before = lambda at: (before + run[:at])[-_BEFORE:]
        segments = [(m.span(), m[0], said_before(m.start())) for m in _SEGMENT.finditer(run)]
        told = [known(segment, said) for _, segment, said in segments]
        # one that holds a digest isn't random for that
        if not any(told) and self.random(run, before):
            return [(0, len(run))]
        if known(run, before):
            return []
        out = []
        for ((start, end), segment, said), is_known in zip(segments, told):
            if is_known:
                continue
            if self.random(segment, said):
                out.append((start, end))
                continue
            for part in _BETWEEN.finditer(segment):
                at = start + part.start()
                said = said_before(at)
                if self.random(part[0], said):
                    out.append((at, at + len(part[0])))
                elif not known(part[0], said) and any(c.isalpha() for c in part[0]):
                    out += [(at + s, at + e) for s, e in self.windows(part[0])]
        return out


def known(run: str, before: str) -> bool:
    """Whether a run is a UUID, or a digest by its length and by what it or the text in front of it says."""
    found = _DIGEST.match(run)
    return bool(_UUID.match(run) or found and len(found[2]) in _DIGEST_LENGTHS and (found[1] or _SAYS_DIGEST.search(before)))


@functools.lru_cache(maxsize=2)
def token_efficiency(vocab_dir: str | None = None) -> TokenEfficiency:
    return TokenEfficiency(vocab_path(BYTE_RANKS, vocab_dir))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three patterns, in order."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def random_spans(text: str, taken: list[tuple[int, int, int]], scan: TokenEfficiency) -> list[tuple[int, int, int]]:
    """(start, kind, end) of inefficient stretches of runs; runs that a span of ``taken`` (in order) overlaps aren't looked at."""
    starts = [s for s, _, _ in taken]
    furthest = list(accumulate((e for _, _, e in taken), max))  # spans of different kinds may overlap
    found = []
    for m in _RUN.finditer(text):
        run = m[0].rstrip(".-=")
        start, end = m.start(), m.start() + len(run)
        before = bisect_left(starts, end)  # these begin before the run ends
        if not (before and furthest[before - 1] > start):
            found += [(start + s, 3, start + e) for s, e in scan.spans(run, text[max(0, start - _BEFORE) : start])]
    return found


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_documents(docs: DataFrame, vocab_dir: str | None = None) -> DataFrame:
    """doc_id, counts per kind, the digest of the base spans and all spans of every text.

    A null text is an empty one: no spans, the digest of the empty string. Null and repeated ids are
    rows of their own; an empty table gives an empty result; further columns are ignored. Narrow: no
    shuffle, texts of any length are scanned whole.
    """
    schema = T.StructType([
        T.StructField("doc_id", type_of(docs, "doc_id")),
        *(T.StructField(n, T.LongType()) for n in ("n_assign", "n_access", "n_hex")),
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("n_random", T.LongType()),
    ])

    def scan(batches):
        efficiency = token_efficiency(vocab_dir)
        for batch in slices(batches):
            counts, digests, joined = [], [], []
            for text in texts(batch):
                base = base_spans(text)
                more = random_spans(text, base, efficiency)
                kinds = [k for _, k, _ in base]
                counts.append([kinds.count(0), kinds.count(1), kinds.count(2), len(more)])
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                joined.append(_joined(sorted(base + more)))
            n = [pa.array([c[i] for c in counts], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *n[:3], pa.array(digests, pa.string()), pa.array(joined, pa.string()), n[3]], names=schema.names)

    return spread(columns_of(docs, "doc_id", "text")).mapInArrow(scan, schema)
