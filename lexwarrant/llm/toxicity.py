"""Toxicity by compression distance between trained dictionaries of ordinary and of toxic text.

One zstandard dictionary is trained on windows of ordinary documents. The other is trained on what
windows of toxic documents hold beyond that: words that the ordinary dictionary can't compress and that
stand in more different surroundings in toxic documents than ordinary ones let expect (a word counts
once for each word it follows, so copies of a document don't count again). A window of a text is
compressed with the ordinary dictionary alone and with both; the bytes saved are the distance. Where
a window saves some, its words are compressed one by one between two stretches that both sides know,
which gives for each word the bytes it saves and the bytes it still costs. A logistic model of a
document's best savings, fitted on labelled documents that the dictionaries weren't trained on, turns
them into a probability.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from ..storage import write_table
from .arrow import columns_of, held_out, slices, spread, texts, type_of
from .vocabularies import Cache

#: Labelled documents of either class the dictionaries are made from, and those for calibration, at most about.
SAMPLE_DOCUMENTS = 6_000
CALIBRATION_DOCUMENTS = 4_000
#: Characters of a document the dictionaries are trained on.
SAMPLE_CHARS = 20_000
#: Ordinary windows a dictionary is trained on, about, and the largest size of either dictionary.
SAMPLE_WINDOWS = 20_000
DICTIONARY_BYTES = 65_536
WINDOW_WORDS = 8
#: Bytes a window must save to be looked at word by word.
WINDOW_SAVES = 2
#: Bytes a word must cost under the ordinary dictionary to be unknown to it.
UNKNOWN = 3
#: How far the use of an unknown word in toxic documents must exceed the expected, in deviations and as a ratio.
LEAST_Z, LEAST_RATIO, LEAST_CONTEXTS = 4.0, 8.0, 3
THRESHOLD = 0.3
_MARK = b"\x01"
_STRIP = b".,!?;:\"'()[]"


def windows_of(text: str) -> list[bytes]:
    words = text.lower().encode("utf-8", "surrogatepass").split()
    return [b" " + b" ".join(words[i : i + WINDOW_WORDS]) + b" " for i in range(0, len(words), WINDOW_WORDS)]


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...] = ()

    @functools.cached_property
    def key(self) -> str:
        return hashlib.sha256(self.ordinary + self.toxic + repr(self.weights).encode()).hexdigest()


class Compressor:
    """Lengths of short strings under a dictionary."""

    def __init__(self, content: bytes):
        params = zstandard.ZstdCompressionParameters(
            window_log=18, hash_log=17, chain_log=17, search_log=1, min_match=4, target_length=1, strategy=zstandard.STRATEGY_DFAST,
            write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        )
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(compression_params=params)
        self._compress = zstandard.ZstdCompressor(dict_data=data, compression_params=params).compress

    def lengths(self, parts: list[bytes]) -> np.ndarray:
        compress = self._compress
        return np.fromiter((len(compress(p)) for p in parts), np.int64, len(parts))


class Scorer:
    """Features and probabilities of texts under a model."""

    def __init__(self, model: Model):
        self.model = model
        self._ordinary, self._toxic = Compressor(model.ordinary), Compressor(model.ordinary + model.toxic)
        at = max(0, len(model.ordinary) - 3000)
        # both dictionaries know these; the finder doesn't begin a match in the last bytes of its input
        self._before, self._after = model.ordinary[at : at + 60], model.ordinary[at + 100 : at + 124]
        empty = [self._before + _MARK + b"  " + _MARK + self._after]
        self._base = int(self._ordinary.lengths(empty)[0]), int(self._toxic.lengths(empty)[0])
        self._seen: Cache = Cache(None)

    def unknown(self, words: list[bytes]) -> list[bool]:
        """Whether each word costs ``UNKNOWN`` bytes or more under the ordinary dictionary."""
        framed = [self._before + _MARK + b" " + w + b" " + _MARK + self._after for w in words]
        return (self._ordinary.lengths(framed) - self._base[0] >= UNKNOWN).tolist()

    def _gains(self, words: list[bytes]) -> np.ndarray:
        """For each word: bytes saved, less twice the bytes it still costs."""
        self._seen.trim()
        if new := [w for w in dict.fromkeys(words) if w not in self._seen and w not in self._seen.older]:
            framed = [self._before + _MARK + b" " + w + b" " + _MARK + self._after for w in new]
            costs0, costs1 = self._ordinary.lengths(framed) - self._base[0], self._toxic.lengths(framed) - self._base[1]
            self._seen.update(zip(new, (costs0 - costs1 - 2.0 * np.maximum(costs1, 0)).tolist()))
        return np.fromiter(map(self._seen.__getitem__, words), float, len(words))

    def features(self, text: str) -> np.ndarray:
        """Best and second best word gain, number of good ones, windows, and what the best windows save, as
        numbers of like size."""
        parts = windows_of(text)
        best, second, good, top, next_ones = 0.0, 0.0, 0, 0, 0
        if parts and self.model.toxic:
            framed = [p + self._after for p in parts]
            saved = self._ordinary.lengths(framed) - self._toxic.lengths(framed)
            order = np.sort(np.maximum(saved, 0))[::-1]
            top, next_ones = int(order[0]), int(order[1:4].sum())
            words = [w.strip(_STRIP) for i in np.nonzero(saved >= WINDOW_SAVES)[0] for w in parts[i].split()]
            if words:
                gains = np.maximum(self._gains(words), 0)
                high = np.sort(gains)[-2:]
                best, second, good = float(high[-1]), float(high[0]) if len(high) > 1 else 0.0, int((gains >= 3).sum())
        return np.array([
            1.0, min(best, 8) / 4, min(second, 8) / 4, np.log1p(good), np.log1p(len(parts)) / 4, np.log1p(good) / np.log1p(len(parts) + 1),
            min(top, 12) / 6, min(next_ones, 24) / 12,
        ])

    def probability(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(features @ np.array(self.model.weights), -30, 30))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights of a logistic model by Newton steps, with a small penalty."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _sampled(rows: DataFrame, name: str, most: int) -> DataFrame:
    """About ``most`` rows of either class at most, chosen by a hash of the id."""
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.lit(name), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, most / max(1, counts.get(1, 0))).otherwise(most / max(1, counts.get(0, 0)))
    return rows.where(draw < share)


def words_of(text: str) -> list[bytes]:
    return [w.strip(_STRIP) for w in text.lower().encode("utf-8", "surrogatepass").split()]


def _trained(samples: list[bytes]) -> bytes:
    """A dictionary of the samples; too few to train on are one as they are."""
    if len(samples) < 100:
        return b"".join(samples)
    return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 4 + 256), samples, k=64, d=6).as_bytes()


def _ordinary_dictionary(sample: DataFrame) -> bytes:
    """Trained on windows of ordinary documents, drawn by a hash."""
    rows = sample.where("toxic = 0")
    share = SAMPLE_WINDOWS / max(1, rows.agg(F.sum(F.length("text"))).first()[0] or 0) * 6 * WINDOW_WORDS

    def draw(batches):
        for batch in batches:
            found = {w for t in texts(batch) for i, w in enumerate(windows_of(t)) if zlib.crc32(b"%d:" % i + w) < share * (1 << 32)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.binary())], names=["window"])

    found = {bytes(r["window"]) for r in rows.select("text").mapInArrow(draw, "window binary").collect()}
    return _trained(sorted(found, key=lambda w: (zlib.crc32(w), w)))  # training wants samples in no order


def unknown_words(sample: DataFrame, ordinary: bytes) -> list[bytes]:
    """Words unknown to the ordinary dictionary that toxic documents use in more surroundings than
    ordinary ones let expect. They come from a bounded sample, so they are few."""
    none = Model(ordinary, b"")

    def look(batches):
        scorer = scorer_of(none)
        for batch in slices(batches, 64):
            found = set()
            for toxic, text in zip(batch.column("toxic").to_pylist(), texts(batch)):
                words = words_of(text)
                distinct = [w for w in set(words) if len(w) >= 3]
                strange = {w for w, u in zip(distinct, scorer.unknown(distinct)) if u}
                found |= {(toxic, before, w) for before, w in zip([b"", *words], words) if w in strange}
            columns = list(zip(*found)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=["toxic", "before", "word"])

    contexts = sample.select("toxic", "text").mapInArrow(look, "toxic int, before binary, word binary").distinct()
    used = contexts.groupBy("word").agg(F.count_if(F.col("toxic") == 1).alias("c1"), F.count_if(F.col("toxic") == 0).alias("c0"))
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.sum(F.length("text")).alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return []
    expected = (F.col("c0") + 0.5) * (sizes[1] / sizes[0])
    strong = used.where((F.col("c1") - expected >= LEAST_Z * F.sqrt(expected + 1)) & (F.col("c1") >= LEAST_CONTEXTS) & (F.col("c1") >= LEAST_RATIO * expected))
    return sorted(bytes(r["word"]) for r in strong.select("word").collect())


def _toxic_dictionary(sample: DataFrame, ordinary: bytes) -> bytes:
    """Trained on the stretches of toxic windows that are made of such words, marked off at both ends."""
    held = frozenset(unknown_words(sample, ordinary))
    if not held:
        return b""

    def stretches(batches):
        for batch in slices(batches, 256):
            found = []
            for text in texts(batch):
                for part in windows_of(text):
                    run: list[bytes] = []
                    for w in [*(x.strip(_STRIP) for x in part.split()), b""]:
                        if w in held:
                            run.append(w)
                        elif run:
                            found.append(_MARK + b" " + (b" " + _MARK + b" ").join(run) + b" " + _MARK)
                            run = []
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["stretch"])

    found = sample.where("toxic = 1").select("text").mapInArrow(stretches, "stretch binary").groupBy("stretch").agg(F.count(F.lit(1)).alias("n")).collect()
    times = {bytes(r["stretch"]): int(r["n"]) for r in found}
    # a stretch that copies repeat counts less than one that many documents use
    trained = _trained([s for s in sorted(times) for _ in range(1 + times[s].bit_length())])
    # training chooses segments that may begin or end inside a stretch; those it has cut follow whole, the
    # most used last, as far as the dictionary's size allows
    whole, room = [], DICTIONARY_BYTES - len(trained)
    for s in sorted(times, key=lambda s: (-times[s], s)):
        if s not in trained and len(s) <= room:
            whole.append(s)
            room -= len(s)
    return trained + b"".join(reversed(whole))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Dictionaries and calibration from labelled documents that are not held out; two thirds make the
    dictionaries, one third the calibration. Labels other than 0 and 1 are left out.

    The ids drawn are bounded by the sample sizes, so they are broadcast and no text is shuffled.
    """
    docs = columns_of(docs, "doc_id", "text")
    labels = columns_of(labels, "doc_id", "toxic")
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.where(~held_out()).where(F.col("text").isNotNull())
    third = F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / 4) % 3
    both = write_table(known.join(docs.select("doc_id").where(~held_out()), "doc_id", "left_semi").withColumn("third", third), "labelled")
    chosen = _sampled(both.where("third <> 0"), "dictionary", SAMPLE_DOCUMENTS).unionByName(_sampled(both.where("third = 0"), "calibration", CALIBRATION_DOCUMENTS))
    sample = write_table(rows.join(F.broadcast(chosen), "doc_id"), "toxic-sample")
    training = sample.where("third <> 0").withColumn("text", F.substring("text", 1, SAMPLE_CHARS))
    ordinary = _ordinary_dictionary(training)
    model = Model(ordinary, _toxic_dictionary(training, ordinary))
    size = len(Scorer(model).features(""))
    schema = T.StructType([T.StructField("toxic", T.IntegerType()), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def measure(batches):
        scorer = Scorer(model)
        for batch in slices(batches):
            found = [scorer.features(t).tolist() for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.float64()))], names=schema.names)

    measured = sorted((r["toxic"], r["x"]) for r in sample.where("third = 0").select("toxic", "text").mapInArrow(measure, schema).collect())
    y = np.array([t for t, _ in measured], float)
    x = np.array([v for _, v in measured], float).reshape(len(y), size)
    if len(y):
        # the classes count as often as they do among labelled documents, not in the sample
        true = {r["toxic"]: r["n"] for r in both.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        weights = logistic(x, y)
        if 0 < y.sum() < len(y) and true.get(0) and true.get(1):
            weights[0] += np.log(true[1] / true[0]) - np.log(y.sum() / (len(y) - y.sum()))
    else:
        weights = np.array([-4.0, 2.0, 1.0, 1.0, 0.0, 0.0, 0.5, 0.5])
    model.weights = tuple(weights.tolist())
    return model


_scorers: dict[str, Scorer] = {}


def scorer_of(model: Model) -> Scorer:
    """This worker's scorer for the model, kept from task to task."""
    if model.key not in _scorers:
        _scorers.clear()
        _scorers[model.key] = Scorer(model)
    return _scorers[model.key]


def score_documents(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, score and predicted of every text.

    A null or empty text has the score of a document without any window. Null and repeated ids are rows
    of their own (a null id is not held out and has no label); without labels a fixed calibration
    holds and dictionaries are empty; an empty table gives an empty result; further columns are
    ignored. Scoring is narrow and reads texts of any length whole.
    """
    model = model or learn(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of bounded size
    schema = T.StructType([
        T.StructField("doc_id", type_of(docs, "doc_id")),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("predicted", T.IntegerType()),
    ])

    def score(batches):
        scorer = scorer_of(shared.value)
        for batch in slices(batches):
            found = [scorer.probability(scorer.features(t)) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(found, pa.float64()), pa.array([int(p >= THRESHOLD) for p in found], pa.int32())], names=schema.names)

    return spread(columns_of(docs, "doc_id", "text")).withColumn("held_out", held_out()).mapInArrow(score, schema)
