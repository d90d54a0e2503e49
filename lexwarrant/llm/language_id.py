"""Language identification by unigrams over vocabulary pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. The probability of a
word is the sum, over all ways to cut it into pieces, of the product of the pieces' probabilities; a
forward pass over the word gives it. Expectation maximisation on word counts of labelled texts learns
the probabilities. A text's score per language is the sum over its words.

Words are runs of letters, lower-cased, with the vocabulary's word mark before them. A run of more than
``LONGEST_WORD`` letters, as scripts without spaces have, is several words of that length and its rest,
so that a word's table stays small and can be met again; no letter is left out.
"""

from __future__ import annotations

import functools
import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .arrow import columns_of, held_out, slices, spread, texts, told_apart, type_of
from .vocabularies import PIECE_BPE, Cache, vocab_path

#: Labelled documents learned from, per language, about; and the longest of them, in characters.
SAMPLE_DOCUMENTS = 400
SAMPLE_CHARS = 20_000
ROUNDS = 3
#: Added to the expected count of each piece.
SMOOTHING = 0.05
#: Probability of a character outside the vocabulary.
OTHER = 1e-7
UNDETERMINED = "und"
#: Letters of one word at most; longer runs are cut.
LONGEST_WORD = 64
_BAR = "▁"
_WORD = re.compile(rf"[^\W\d_]{{1,{LONGEST_WORD}}}")
_BASE = np.uint64(0x100000001B3)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def has_letters(words: list[str]) -> bool:
    return any(c.isalpha() for w in words for c in w)


class Pieces:
    """The vocabulary's pieces, found in many words at once by hashes of their spans."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.names = sorted({n for n in (n.lower() for n in names) if n == _BAR or any(c.isalpha() for c in n)})
        self.longest = max(map(len, self.names))
        self._by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k in range(1, self.longest + 1):
            ids = np.array([i for i, n in enumerate(self.names) if len(n) == k], np.int64)
            if len(ids):
                hashes = self._hash(self.codes([self.names[i] for i in ids], k))
                order = np.argsort(hashes)
                self._by_length[k] = (hashes[order], ids[order])

    @staticmethod
    def codes(words: list[str], width: int) -> np.ndarray:
        """Code points, one row a word, zeros after its end."""
        joined = "".join(w.ljust(width, "\0") for w in words)
        return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), width).astype(np.uint64)

    @staticmethod
    def _hash(codes: np.ndarray) -> np.ndarray:
        h = np.zeros(len(codes), np.uint64)
        for column in codes.T:
            h = h * _BASE + column * np.uint64(0x9E3779B97F4A7C15)
        return h

    def spans(self, codes: np.ndarray) -> dict[int, np.ndarray]:
        """length -> matrix whose entry (w, end) is the piece of that length ending before ``end``, or -1."""
        n, width = codes.shape
        found, running = {}, np.zeros((n, width + 1), np.uint64)
        scaled = codes * np.uint64(0x9E3779B97F4A7C15)
        for k in range(1, min(self.longest, width) + 1):
            shifted = np.zeros_like(running)
            shifted[:, k:] = running[:, k - 1 : -1] * _BASE + scaled[:, k - 1 :]
            running = shifted
            if k in self._by_length:
                hashes, ids = self._by_length[k]
                at = np.minimum(np.searchsorted(hashes, running[:, k:]), len(hashes) - 1)
                hit = np.where(hashes[at] == running[:, k:], ids[at], -1)
                if (hit >= 0).any():
                    found[k] = np.pad(hit, ((0, 0), (k, 0)), constant_values=-1)
        return found


@functools.lru_cache(maxsize=2)
def pieces(vocab_dir: str | None = None) -> Pieces:
    return Pieces(vocab_path(PIECE_BPE, vocab_dir))


@dataclass
class Model:
    languages: list[str]
    #: One row a piece, one column a language.
    probability: np.ndarray

    @functools.cached_property
    def key(self) -> str:
        return hashlib.sha256("\0".join(self.languages).encode() + self.probability.tobytes()).hexdigest()


def _forward(spans: dict[int, np.ndarray], lengths: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(alpha, log of the scale) at every place of every word; alpha has words, places, languages."""
    n, width = len(lengths), int(lengths.max())
    alpha = np.zeros((n, width + 1, table.shape[1]))
    scale = np.zeros((n, width + 1))
    alpha[:, 0] = 1
    for end in range(1, width + 1):
        known = np.zeros(n, bool)
        now = alpha[:, end]
        for k, at in spans.items():
            if k <= end:
                column = at[:, end]
                now += alpha[:, end - k] * table[column] * np.exp(scale[:, end - k] - scale[:, end - 1])[:, None]
                if k == 1:
                    known = column >= 0
        now += np.where(known, 0, OTHER)[:, None] * alpha[:, end - 1]
        top = now.max(axis=1)
        top[top <= 0] = 1
        now /= top[:, None]
        scale[:, end] = scale[:, end - 1] + np.log(top)
    return alpha, scale


def word_scores(words: list[str], model: Model, vocabulary: Pieces) -> np.ndarray:
    """Log probabilities, one row a word, one column a language."""
    out = np.zeros((len(words), len(model.languages)))
    table = np.vstack([model.probability, np.zeros(len(model.languages))])  # the place -1
    marked = [_BAR + w for w in words]
    order = sorted(range(len(marked)), key=lambda i: len(marked[i]))
    start = 0
    while start < len(order):
        # words of like length together, about a million cells at once
        width = len(marked[order[start]])
        stop = start + 1
        while stop < len(order) and len(marked[order[stop]]) <= max(8, width + width // 4) and (stop - start) * len(marked[order[stop]]) < 60_000:
            stop += 1
        part = order[start:stop]
        lengths = np.array([len(marked[i]) for i in part])
        spans = vocabulary.spans(vocabulary.codes([marked[i] for i in part], int(lengths.max())))
        alpha, scale = _forward(spans, lengths, table)
        rows = np.arange(len(part))
        out[part] = np.log(np.maximum(alpha[rows, lengths], 1e-300)) + scale[rows, lengths][:, None]
        start = stop
    return out


def fit(counts: list[tuple[str, str, int]], vocab_dir: str | None = None, rounds: int = ROUNDS) -> Model:
    """Learn from (language, word, count) by expectation maximisation."""
    vocabulary = pieces(vocab_dir)
    languages = sorted({c[0] for c in counts})
    column = {l: i for i, l in enumerate(languages)}
    words = sorted({c[1] for c in counts})
    row = {w: i for i, w in enumerate(words)}
    weight = np.zeros((len(words), len(languages)))
    for language, word, n in counts:
        weight[row[word], column[language]] += n
    size = len(vocabulary.names)
    probability = np.full((size, len(languages)), 1.0)
    probability *= np.array([0.02 ** min(3, 1 / len(n)) for n in vocabulary.names])[:, None]
    probability /= probability.sum(axis=0)
    marked = [_BAR + w for w in words]
    order = sorted(range(len(marked)), key=lambda i: len(marked[i]))
    batches = []
    for start in range(0, len(order), 8192):
        part = order[start : start + 8192]
        lengths = np.array([len(marked[i]) for i in part])
        batches.append((part, lengths, vocabulary.spans(vocabulary.codes([marked[i] for i in part], int(lengths.max())))))
    for _ in range(rounds):
        table = np.vstack([probability, np.zeros(len(languages))])
        expected = np.zeros((size + 1, len(languages)))
        for part, lengths, spans in batches:
            n, width, rows = len(part), int(lengths.max()), np.arange(len(part))
            alpha, scale = _forward(spans, lengths, table)
            total, share = alpha[rows, lengths], weight[part]
            beta = np.zeros((n, width + 1, len(languages)))
            beta[rows, lengths] = 1  # relative to the scale at a word's end
            for end in range(width, 0, -1):
                live = end <= lengths
                for k, at in spans.items():
                    if k <= end:
                        ids = np.where(live, at[:, end], -1)
                        used = np.nonzero(ids >= 0)[0]
                        if len(used):
                            step = table[ids[used]] * beta[used, end] * np.exp(scale[used, end - k] - scale[used, end])[:, None]
                            beta[used, end - k] += step
                            gain = alpha[used, end - k] * step * share[used] / np.maximum(total[used], 1e-300)
                            for l in range(len(languages)):
                                expected[:, l] += np.bincount(ids[used], gain[:, l], size + 1)
                single = spans.get(1)
                unknown = live & ((single[:, end] < 0) if single is not None else True)
                if unknown.any():
                    beta[unknown, end - 1] += OTHER * beta[unknown, end] * np.exp(scale[unknown, end - 1] - scale[unknown, end])[:, None]
        probability = expected[:size] + SMOOTHING
        probability /= probability.sum(axis=0)
    return Model(languages, probability)


def sample_counts(labelled: DataFrame, per_language: int = SAMPLE_DOCUMENTS, chars: int = SAMPLE_CHARS) -> list[tuple[str, str, int]]:
    """(language, word, count) of about ``per_language`` documents of each language, chosen by a hash;
    of a longer one the first ``chars`` letters.

    Bounded by per_language * chars letters a language, which is what the driver may come to hold. Rows
    are drawn as they are read: the driver knows how many each language has, so no text is shuffled.
    """
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not sizes:
        return []
    share = F.element_at(F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], float(per_language) / r["n"])]), F.col("lang"))
    draw = F.pmod(F.xxhash64(F.lit("language sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.where(draw < share).withColumn("text", F.substring("text", 1, chars))
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])

    def count(batches):
        from collections import Counter

        for batch in batches:
            found: Counter = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch)):
                found.update((lang, w) for w in words_of(text))
            keys = list(found)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(list(found.values()), pa.int64())], names=schema.names)

    counted = chosen.select("lang", "text").mapInArrow(count, schema).groupBy("lang", "word").agg(F.sum("n").alias("n")).orderBy("lang", "word")
    columns = counted.toArrow()
    return list(zip(*(columns.column(c).to_pylist() for c in ("lang", "word", "n"))))


def learn(docs: DataFrame, vocab_dir: str | None = None, per_language: int = SAMPLE_DOCUMENTS) -> Model:
    """A model of the languages of documents that are not held out."""
    labelled = columns_of(docs, "doc_id", "text", "lang").where(~held_out())
    return fit(sample_counts(labelled, per_language), vocab_dir)


class Scorer:
    """Scores texts under a model; words met before are looked up."""

    def __init__(self, model: Model, vocabulary: Pieces):
        self._model, self._vocabulary = model, vocabulary
        self._row = Cache(None)
        self._scores = self._older = np.zeros((0, len(model.languages)))

    def _add(self, words: list[str], scores: np.ndarray) -> None:
        first = len(self._row)
        self._row.update(zip(words, range(first, first + len(words))))
        if first + len(words) > len(self._scores):
            grown = np.zeros((1024 + (first + len(words)) * 3 // 2, self._scores.shape[1]))
            grown[:first] = self._scores[:first]
            self._scores = grown
        self._scores[first : first + len(words)] = scores

    def _learn(self, wanted: set[str]) -> None:
        """Add the words of ``wanted`` that aren't known; those of the older generation by their old scores."""
        self._row.trim()
        if not self._row:
            self._older, self._scores = self._scores, np.zeros((0, self._scores.shape[1]))
        missing = wanted - self._row.keys()
        again = [w for w in missing if w in self._row.older]
        self._add(again, self._older[[self._row.older[w] for w in again]])
        new = list(missing - self._row.keys())
        self._add(new, word_scores(new, self._model, self._vocabulary))

    def predict(self, rows: list[str]) -> list[tuple[str, float]]:
        if not self._model.languages:
            return [(UNDETERMINED, 0.0)] * len(rows)
        cut = [words_of(t) for t in rows]
        wanted = set().union(*cut) if cut else set()
        if wanted - self._row.keys():
            self._learn(wanted)
        out = []
        for words in cut:
            if not has_letters(words):
                out.append((UNDETERMINED, 0.0))
                continue
            total = self._scores[np.fromiter(map(self._row.__getitem__, words), np.int64, len(words))].sum(axis=0)
            # words of a text depend on each other, so evidence grows as the root of their number
            relative = np.exp((total - total.max()) / np.sqrt(len(words)))
            best = int(total.argmax())
            out.append((self._model.languages[best], float(relative[best] / relative.sum())))
        return out


_scorers: dict[str, Scorer] = {}


def scorer_of(model: Model, vocab_dir: str | None) -> Scorer:
    """The scorer of this worker for the model, kept from task to task with the words it has met."""
    if model.key not in _scorers:
        _scorers.clear()
        _scorers[model.key] = Scorer(model, pieces(vocab_dir))
    return _scorers[model.key]


def predict_languages(docs: DataFrame, model: Model | None = None, vocab_dir: str | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every text; without a model, one is learned from ``docs``.

    ``und`` with score 0 where a text is null or has no letters, or where nothing was learned. Ties
    between languages go to the first by name. Null and repeated ids are rows of their own (a null id
    is not held out); an empty table gives an empty result; further columns are ignored. Scoring is
    narrow: no shuffle, texts of any length are read whole.
    """
    model = model or learn(docs, vocab_dir)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # vocabulary pieces times languages
    schema = T.StructType([
        T.StructField("doc_id", type_of(docs, "doc_id")),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ])

    def predict(batches):
        scorer = scorer_of(shared.value, vocab_dir)
        for batch in slices(batches):
            found = scorer.predict(texts(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=schema.names)

    return spread(columns_of(docs, "doc_id", "text")).withColumn("held_out", held_out()).mapInArrow(predict, schema)


def with_known_language(docs: DataFrame, least_score: float, wanted: frozenset[str] | None = None, model: Model | None = None, vocab_dir: str | None = None) -> DataFrame:
    """The rows of ``docs`` whose text has a language of at least this score, with it in ``lang``.

    With ``wanted``, only texts of these languages go on. The rows themselves pass through the scorer,
    so rows that share an id are judged one by one; ``lang`` becomes the language found, which fills in
    nulls and mends wrong labels, and further columns are kept. Where no language was learned (no
    labelled text at all) no text is rejected but those without letters, and ``lang`` stays.
    """
    model = model or learn(docs, vocab_dir)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs, names = told_apart(docs, "text", "lang")
    at = docs.columns.index("lang")

    def keep(batches):
        scorer = scorer_of(shared.value, vocab_dir)
        for batch in slices(batches):
            rows = texts(batch)
            if shared.value.languages:
                found = scorer.predict(rows)
                good = [language != UNDETERMINED and score >= least_score and (wanted is None or language in wanted) for language, score in found]
                batch = batch.set_column(at, batch.schema.field(at), pa.array([language for language, _ in found], batch.schema.field(at).type))
            else:
                good = [has_letters(words_of(t)) for t in rows]
            yield batch.filter(pa.array(good, pa.bool_()))

    return spread(docs).mapInArrow(keep, docs.schema).toDF(*names)
