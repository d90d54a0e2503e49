"""Evidence kept up to date over a stream of documents, with state by word.

The state of a word holds, for each source it was seen in, its family, its count and the two first places
to look. That is all that counts, first locators and independence need, so documents themselves are never
kept, and whatever batches they come in, the evidence is that of a scan of all of them. A batch's words are
summed by source as they are cut, so that only sums meet the state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import keys
from ..operators import scan as S
from ..operators.scan import SAMPLES
from ..storage import delete, exists, file_system, write_table

#: Sources up to this many are broadcast, so that no text is shuffled to meet them.
BROADCAST_SOURCES = 100_000
_PLACES = "array<struct<seq:bigint,locator:string>>"
_STATE = "word string, source string, family string, count long, places " + _PLACES + ", families long, changed boolean"
#: A row for each source of a word that a batch changed; ``families`` is how many the word has by then.
CHANGES = "word string, source string, family string, count long, locators array<string>, families long"


def first_places(held: list[tuple[int, str]], new: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """The first ``SAMPLES`` locators in document order, each by the first document that has it."""
    first: dict[str, int] = {}
    for seq, locator in (*held, *new):
        first[locator] = min(seq, first.get(locator, seq))
    return sorted((s, x) for x, s in first.items())[:SAMPLES]


def _first(places: Column) -> Column:
    """``first_places`` of an array of (seq, locator)."""
    new = lambda held, x: ~F.exists(held, lambda y: y["locator"].eqNullSafe(x["locator"])) & (F.size(held) < SAMPLES)
    return F.aggregate(F.array_sort(places), F.array().cast(_PLACES), lambda held, x: F.when(new(held, x), F.array_append(held, x)).otherwise(held))


def evidence_changes(docs: DataFrame, candidates: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """(source, family, seq, locator, word): each candidate word of a stream of documents (source, seq, locator, text), as they
    are cut; ``write_changes`` sums them.

    ``candidates`` (word) and ``sources`` (id, family) are plain frames; a source without a row is its own
    family. Text that is null has no words. Words that are no candidates leave before anything is shuffled.
    """
    if sources is None:
        marked = docs.withColumn("family", F.col("source"))
    else:
        known = sources.select(F.col("id").alias("_id"), F.col("family").alias("_family"))
        known = F.broadcast(known) if S.is_short(known.select(F.col("_id").alias("word")), BROADCAST_SOURCES) else known
        marked = docs.join(known, F.col("source") == F.col("_id"), "left").withColumn("family", F.coalesce("_family", "source"))
    words = candidates.select("word").distinct()
    cut = marked.select("source", "family", "seq", "locator", F.explode(keys(F.col("text"))).alias("word"))
    return cut.join(F.broadcast(words) if S.is_short(words) else words, "word", "left_semi").select("source", "family", "seq", "locator", "word")


def _sums(batch: DataFrame, places: bool = True) -> DataFrame:
    """(word, source, family, count, places) of a batch: sums first, then of what can be a first place the places."""
    of = F.struct("source", "family").alias("source")
    rows = batch.where("source is not null").select(of, "seq", "locator", "word", F.lit(1).cast("long").alias("n"))
    if not places:
        counts = rows.groupBy("source", "word").agg(F.sum("n").alias("count"))
        return counts.select("word", "source.source", "source.family", "count", F.array().cast(_PLACES).alias("places"))
    sums = write_table(S.summed(rows), "sums")
    first = S.first_located(S.early(rows, sums)).groupBy("source", "word").agg(F.collect_list(F.struct("seq", "locator")).alias("places"))
    return sums.join(first, ["source", "word"], "left").select("word", "source.source", "source.family", F.col("n").alias("count"), "places")


def _held(spark: SparkSession, states: str, epoch: int) -> DataFrame:
    """The state before a batch; older ones than that are deleted, which no batch that is run again can ask for."""
    files, where = file_system(spark, states)
    found = sorted(int(f.getPath().getName().removeprefix("epoch=")) for f in files.listStatus(where)) if exists(spark, states) else []
    before = [e for e in found if e < epoch]
    for old in before[:-1]:
        delete(spark, f"{states}/epoch={old}")
    return spark.read.schema(_STATE).parquet(f"{states}/epoch={before[-1]}") if before else spark.createDataFrame([], _STATE)


def _merged(held: DataFrame, new: DataFrame) -> DataFrame:
    """``_STATE`` with a batch's sums added; a source keeps the family it came with."""
    columns = ["word", "source", "family", "count", "places"]
    both = held.select(*columns, F.lit(False).alias("new")).union(new.select(*columns, F.lit(True)))
    added = both.groupBy("word", "source").agg(
        F.min_by("family", "new").alias("family"), F.sum("count").alias("count"), _first(F.flatten(F.collect_list("places"))).alias("places"), F.bool_or("new").alias("changed"),
    )
    # a word has as many rows as sources, which is few
    words = added.groupBy("word").agg(F.collect_list(F.struct("source", "family", "count", "places", "changed")).alias("of"), F.count_distinct("family").alias("families"))
    return words.select("word", F.explode("of").alias("of"), "families").select("word", "of.source", "of.family", "of.count", "of.places", "families", "of.changed")


def write_changes(changes: DataFrame, path: str, checkpoint: str, places: bool = True) -> StreamingQuery:
    """Run over what has arrived; the changes of each batch (``CHANGES``) are a folder of their own, which a batch that
    is run again after a failure replaces. The state lies in the checkpoint, one for each of the last two batches.
    Without ``places`` no locators are kept, for which a text is cut a second time."""
    states = f"{checkpoint}/evidence"

    def save(batch: DataFrame, epoch: int) -> None:
        spark, state = batch.sparkSession, f"{states}/epoch={epoch}"
        _merged(_held(spark, states, epoch), _sums(batch, places)).write.mode("overwrite").parquet(state)
        changed = spark.read.schema(_STATE).parquet(state).where("changed")
        locators = F.transform("places", lambda x: x["locator"]).alias("locators")
        changed.select("word", "source", "family", "count", locators, "families").write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return changes.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(save).start()


def current_evidence(spark: SparkSession, path: str) -> DataFrame:
    """(word, source, family, count, locators): the last change of each word and source."""
    rows = spark.read.schema(f"{CHANGES}, epoch long").parquet(path)
    last = rows.groupBy("word", "source").agg(F.max_by(F.struct("family", "count", "locators"), "epoch").alias("r"))
    return last.select("word", "source", "r.family", "r.count", "r.locators")


def current_independence(spark: SparkSession, path: str) -> DataFrame:
    """(word, families) of the words seen; families are never lost again, so the most is the last."""
    return spark.read.schema(f"{CHANGES}, epoch long").parquet(path).groupBy("word").agg(F.max("families").alias("families"))
