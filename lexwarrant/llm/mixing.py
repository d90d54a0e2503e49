"""Mixing sources to target weights by pivotal dependent rounding. DataFrame operations only.

Sources share the words of all documents by weight, none above ``cap`` times its own words. A
document of a source is to be taken target / source size times: a whole number of copies each
document gets, and a fraction left over. Fractions are rounded in pairs: of two documents one gives
words to the other until one of the two fractions is 0 or 1, the direction drawn so that each keeps
its expected value; the words of the two together stay the same. The other goes on to the next pair.

Pairs form a reduction tree: the documents of a source are dealt into chunks of bounded size, a chunk
is folded to one remaining document, and the remaining ones are dealt into chunks again. The last one
of a source is rounded to the nearer side, so the words taken miss the target by half a document.

All draws are md5 values of (seed, level, document), so reruns agree.

Cases: a null text or one without words has size 0 and takes 0 words (one copy where rows are
emitted, as it costs nothing); a null source is a source of its own, ordered last; null and repeated
ids are rows of their own; an empty table gives an empty result; further columns are ignored by
``mix`` and kept by ``mixed_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..storage import write_table
from .arrow import columns_of, free_names, told_apart

WEIGHTS = (5, 2, 1)
CAP = 3
WORD = r"[^\x20\x09-\x0D]+"
#: Documents in a chunk of the reduction tree, on average.
CHUNK = 128
SEED = 20


def _draw(*parts: Column) -> Column:
    """A number in [0, 1) from a digest of the parts."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def sized(docs: DataFrame, *keep: Column) -> DataFrame:
    docs = columns_of(docs, "doc_id", "source", "text")
    return docs.select("doc_id", "source", *keep, F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size, documents, target. One row a source, so the windows here are small.

    Sources reach their limit in the order of limit / weight. With the first k at their limits the
    others share the rest at one rate per weight; k is the least that keeps them all below theirs.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    rows = by_source.withColumn("place", place).withColumn("weight", weight).withColumn("limit", F.col("source_size") * cap)
    order = W.orderBy((F.col("limit") / F.col("weight")).asc(), F.col("place").asc())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rate = (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    rows = rows.withColumn("rate", rate)
    # in this order all before the first source below its limit are at theirs
    fits = F.when(F.col("rate") * F.col("weight") <= F.col("limit"), F.col("rate"))
    level = F.first(fits, ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    target = F.least(F.col("limit").cast("double"), F.coalesce(level, F.lit(0.0)) * F.col("weight"))
    return rows.select("source", "source_size", "documents", F.round(target, 6).alias("target"))


def _pivot(state: Column, item: Column) -> Column:
    """One pair of the fold: ``state`` holds the remaining document and the list of settled ones."""
    a, b = state["left"], item
    pa, pb, sa, sb = a["p"], b["p"], a["size"].cast("double"), b["size"].cast("double")
    up = F.least(1 - pa, pb * sb / sa)  # how far a can rise while b gives
    down = F.least(pa, (1 - pb) * sb / sa)
    rise = a["u"] * (up + down) < down
    new_a = F.when(rise, pa + up).otherwise(pa - down)
    # whichever side ran into its bound is set to it exactly
    a_done = F.when(rise, up == 1 - pa).otherwise(down == pa)
    a_bound = F.when(rise, 1.0).otherwise(0.0)
    b_bound = F.when(rise, 0.0).otherwise(1.0)
    new_b = F.when(rise, pb - up * sa / sb).otherwise(pb + down * sa / sb)
    clean = lambda p: F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))
    settled = F.when(a_done, a.withField("p", a_bound)).otherwise(b.withField("p", b_bound))
    left = F.when(a_done, b.withField("p", clean(new_b))).otherwise(a.withField("p", clean(new_a)).withField("u", b["u"]))
    return F.struct(left.alias("left"), F.concat(state["settled"], F.array(settled)).alias("settled"))


def _fold(rows: DataFrame, level: int, seed: int, chunks: Column, last: bool, extra: list[str]) -> DataFrame:
    """Fold each chunk; ``left`` marks the remaining document, ``p`` of the others is 0 or 1."""
    key = [F.lit(seed), F.lit(level), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("size"), *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in extra]]
    item = F.struct("u", "doc_id", "size", "source_size", "target", "whole", "p", *extra)
    dealt = rows.withColumn("u", _draw(*key)).withColumn("chunk", F.floor(_draw(F.lit("chunk"), *key) * chunks).cast("long"))
    lists = dealt.groupBy("source", "chunk").agg(F.array_sort(F.collect_list(item)).alias("items"))
    first = F.struct(F.element_at("items", 1).alias("left"), F.slice("items", 1, 0).alias("settled"))
    folded = lists.select("source", F.aggregate(F.slice("items", 2, F.size("items")), first, _pivot).alias("f"))
    remaining = F.col("f")["left"]
    if last:
        remaining = remaining.withField("p", F.when(remaining["p"] >= 0.5, 1.0).otherwise(0.0))
    marked = F.concat(
        F.transform(F.col("f")["settled"], lambda x: F.struct(x.alias("x"), F.lit(False).alias("left"))),
        F.array(F.struct(remaining.alias("x"), F.lit(not last).alias("left"))),
    )
    return folded.select("source", F.explode(marked).alias("m")).select("source", "m.x.*", "m.left").drop("u")


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED, chunk: int = CHUNK, keep: tuple[tuple[str, Column], ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target and ``copies`` of every document, and columns of ``keep``."""
    extra = [name for name, _ in keep]
    sizes = write_table(sized(docs, *[c.alias(n) for n, c in keep]), "sizes")
    targets = write_table(source_targets(sizes, weights, cap), "targets")
    most = targets.agg(F.max("documents")).first()[0] or 0
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # null-safe, since a null source is one of the sources
    joined = sizes.withColumn("_s", F.col("source")).drop("source").join(
        targets.withColumnRenamed("source", "_t"), F.col("_s").eqNullSafe(F.col("_t"))
    ).withColumnRenamed("_s", "source").drop("_t")
    rows = joined.withColumn("share", share).withColumn("whole", F.floor("share").cast("long")).withColumn("p", F.col("share") - F.col("whole"))
    plain = (F.col("size") == 0) | (F.col("p") <= 1e-12)
    columns = ["doc_id", "source", "size", "source_size", "target", *extra]
    done = rows.where(plain).select(*columns, F.when(F.col("size") == 0, 1).otherwise(F.col("whole")).cast("long").alias("copies"))
    rest = rows.where(~plain).select("doc_id", "source", "size", "source_size", "target", "whole", "p", "documents", *extra)
    level, held = 0, most
    counts = F.greatest(F.lit(1), F.ceil(F.col("documents") / chunk))
    while True:
        last = held <= chunk
        folded = _fold(rest, level, seed, F.lit(1) if last else counts, last, extra)
        if not last:
            folded = write_table(folded, "folded")
        settled = folded if last else folded.where(~F.col("left"))
        done = done.unionByName(settled.select(*columns, (F.col("whole") + F.when((F.col("p") >= 0.5), 1).otherwise(0)).cast("long").alias("copies")))
        if last:
            return done
        rest = folded.where("left").where((F.col("p") > 0) & (F.col("p") < 1)).select("doc_id", "source", "size", "source_size", "target", "whole", "p", *extra)
        done = done.unionByName(folded.where("left").where((F.col("p") <= 0) | (F.col("p") >= 1)).select(*columns, (F.col("whole") + F.col("p")).cast("long").alias("copies")))
        per_source = rest.groupBy("source").agg(F.count(F.lit(1)).alias("documents"))
        held = per_source.agg(F.max("documents")).first()[0] or 0
        rest = rest.withColumn("_s", F.col("source")).drop("source").join(per_source.withColumnRenamed("source", "_t"), F.col("_s").eqNullSafe(F.col("_t"))).withColumnRenamed("_s", "source").drop("_t")
        level += 1


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED, chunk: int = CHUNK) -> DataFrame:
    """doc_id, size, source_size, target and taken (copies times size) of every document."""
    found = copies(docs, weights, cap, seed, chunk)
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), F.col("copies"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED, chunk: int = CHUNK) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Rows that agree in id, source and text share their copies: the copies of such a group together
    are what ``copies`` gives its rows, dealt to one row of the group.
    """
    docs, names = told_apart(docs, "doc_id", "source", "text")
    text_key = F.xxhash64("text")
    found = copies(docs, weights, cap, seed, chunk, keep=(("text_key", text_key),))
    wanted = found.groupBy("doc_id", "source", "text_key").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    n, rows, key, of_id, of_source, of_text, copy = free_names(docs, "copies", "rows", "key", "of_id", "of_source", "of_text", "copy")
    wanted = wanted.where("copies > 0").select(*[F.col(c).alias(a) for c, a in zip(("copies", "rows", "doc_id", "source", "text_key"), (n, rows, of_id, of_source, of_text))])
    keyed = docs.withColumn(key, text_key)
    same = keyed["doc_id"].eqNullSafe(F.col(of_id)) & keyed["source"].eqNullSafe(F.col(of_source)) & keyed[key].eqNullSafe(F.col(of_text))
    joined = keyed.join(wanted, same)
    single = joined.where(F.col(rows) == 1)
    repeated = joined.where(F.col(rows) > 1).dropDuplicates([of_id, of_source, of_text])
    return single.unionByName(repeated).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*docs.columns).toDF(*names)
