"""What each family adds: saturation by greedy choice, its knee, and a chart."""

from __future__ import annotations

from collections.abc import Iterable
from html import escape

from pyspark.sql import DataFrame, functions as F

from ..storage import write_table
from .rule import MINIMUM

#: Gains are counted as returns from this many families on, and below this part of the best gain they have stopped.
KNEE_AFTER, KNEE_PART = 3, 20
#: Sets of families that the driver takes, and families whose effects one pass over the words sums.
SIGNATURES, AHEAD = 20_000, 64


def family_signatures(attestations: DataFrame) -> DataFrame:
    """(signature, words): the sets of families that words have, and how many words have each.

    A signature is a subset of the families; this is all the greedy choice needs, so the words stay
    where they are.
    """
    sets = attestations.groupBy("word").agg(F.array_sort(F.collect_set("family")).alias("signature"))
    return sets.groupBy("signature").agg(F.count(F.lit(1)).alias("words"))


def kept_by_families(attestations: DataFrame, chosen: Iterable[str], minimum: int = MINIMUM) -> int:
    """Words that reach the minimum with these families alone."""
    inside = attestations.where(F.col("family").isin(sorted(chosen)))
    return inside.select("word", "family").distinct().groupBy("word").count().where(F.col("count") >= minimum).count()


def kept_in_order(attestations: DataFrame, order: DataFrame, minimum: int = MINIMUM) -> DataFrame:
    """(families, kept): words kept with the first families of ``order`` (family, place from 1), for each number of them.

    A word is kept from its ``minimum``-th family in that order on, so all steps follow from one sum by that place.
    """
    places = attestations.select("word", "family").distinct().join(order.select("family", F.col("place").cast("int").alias("place")), "family")
    # a word has as many places as families
    at = places.groupBy("word").agg(F.array_sort(F.collect_list("place")).alias("places")).where(F.size("places") >= minimum).select(F.element_at("places", minimum).alias("at"))
    new = at.groupBy("at").agg(F.count(F.lit(1)).alias("n"))
    steps = order.select(F.col("place").cast("int").alias("families")).distinct()
    # a row a place on either side
    return steps.join(new, F.col("at") <= F.col("families"), "left").groupBy("families").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("kept"))


def greedy(signatures: list[tuple[list[str], int]], minimum: int = MINIMUM, order: dict[str, int] | None = None) -> list[tuple[str, int, int]]:
    """(family, kept, gained) step by step: the family that keeps most words, then the larger, then the first.

    ``order`` gives each family's place for the last tie; without it, names decide.
    """
    sizes: dict[str, int] = {}
    for families, n in signatures:
        for f in families:
            sizes[f] = sizes.get(f, 0) + n
    place = order or {f: i for i, f in enumerate(sorted(sizes))}
    missing = [[minimum, set(families), n] for families, n in signatures]
    steps, kept = [], 0
    while sizes:
        # a family gains the words that lack one more and have it
        gain = dict.fromkeys(sizes, 0)
        for lacks, families, n in missing:
            if lacks == 1:
                for f in families:
                    gain[f] += n
        best = min(sizes, key=lambda f: (-gain[f], -sizes[f], place[f]))
        kept += gain[best]
        steps.append((best, kept, gain[best]))
        for row in missing:
            if best in row[1]:
                row[0] -= 1
                row[1].discard(best)
        del sizes[best]
    return steps


def gains_of(words: DataFrame, chosen: list[int], candidates: list[int], minimum: int) -> list[tuple[int, int, int, int]]:
    """(f, g, change, shared) for each of ``candidates`` f and other family g that isn't chosen: by how much choosing f
    changes what g gains, and how many words both have that aren't kept yet. ``words`` has families, an array of numbers.

    Words are read where they lie, and sums by pairs of families are shuffled.
    """
    numbers = lambda x: F.array(*map(F.lit, x)).cast("array<int>")
    have = F.size(F.array_intersect("families", numbers(chosen)))
    rows = words.select("families", F.array_intersect("families", numbers(candidates)).alias("now"), have.alias("have")).where((F.size("now") > 0) & (F.col("have") < minimum))
    # a word that lacks two begins to count for its other families, one that lacks one is kept and counts no more
    change = F.when(F.col("have") == minimum - 2, 1).when(F.col("have") == minimum - 1, -1).otherwise(0)
    pairs = rows.select(change.alias("change"), F.array_except("families", numbers(chosen)).alias("rest"), F.explode("now").alias("f")).select("f", F.explode("rest").alias("g"), "change").where("f <> g")
    return [tuple(r) for r in pairs.groupBy("f", "g").agg(F.sum("change"), F.count(F.lit(1))).collect()]  # at most candidates by families


def distributed_greedy(attestations: DataFrame, minimum: int = MINIMUM, order: dict[str, int] | None = None, ahead: int = AHEAD) -> list[tuple[str, int, int]]:
    """The steps of ``greedy`` for families of any number, without a word or signature on the driver.

    What each family would gain is kept up by changes, which Spark sums over the words of the family chosen. Those
    of the ``ahead`` best families are asked for together: as long as the next choice is one of them and shares no
    unkept word with those made since, its changes still hold and no other pass is needed.
    """
    # a row a word and family, made from all attestations only once
    seen = write_table(attestations.select("word", "family").distinct(), "seen")
    sizes = {r["family"]: r["n"] for r in seen.groupBy("family").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a family
    place = order or {f: i for i, f in enumerate(sorted(sizes))}
    names = sorted(sizes, key=lambda f: (place[f], f))
    spark = attestations.sparkSession
    numbers = spark.createDataFrame(list(enumerate(names)), "number int, family string")
    listed = seen.join(numbers, "family").groupBy("word").agg(F.collect_list("number").alias("families"))
    # words of too few families are never kept
    words = write_table(listed.where(F.size("families") >= minimum).select(F.array_sort("families").alias("families")), "families")
    by_number = [sizes[f] for f in names]
    gain = [0] * len(names)
    if minimum <= 1:
        gain = list(by_number)
    left, chosen, steps, kept = set(range(len(names))), [], [], 0
    best_first = lambda i: (-gain[i], -by_number[i], i)
    while left:
        asked = sorted(left, key=best_first)[:ahead]
        changes: dict[int, dict[int, tuple[int, int]]] = {f: {} for f in asked}
        for f, g, change, shared in gains_of(words, chosen, asked, minimum):
            changes[f][g] = (change, shared)
        since: list[int] = []
        while left:
            best = min(left, key=best_first)
            if best not in changes or any(best in changes[f] for f in since):
                break
            kept += gain[best]
            steps.append((names[best], kept, gain[best]))
            left.discard(best)
            for g, (change, _) in changes[best].items():
                gain[g] += change
            since.append(best)
        chosen += since
    return steps


def saturation(attestations: DataFrame, total: int, minimum: int = MINIMUM, language: str = "", order: dict[str, int] | None = None) -> DataFrame:
    """(language, families, added, kept, share, gained).

    Where families are few, their signatures (at most ``SIGNATURES``) go to the driver; where they are many, as with
    one for each site, only sums by families do.
    """
    signatures = write_table(family_signatures(attestations), "signatures")
    if signatures.limit(SIGNATURES + 1).count() <= SIGNATURES:
        chosen = greedy([(r["signature"], r["words"]) for r in signatures.collect()], minimum, order)
    else:
        chosen = distributed_greedy(attestations, minimum, order)
    steps = [(language, i, f, k, k / total if total else 0.0, g) for i, (f, k, g) in enumerate(chosen, 1)]
    return attestations.sparkSession.createDataFrame(steps, "language string, families int, added string, kept long, share double, gained long")


def first_seen(attestations: DataFrame, position: str = "position") -> dict[str, int]:
    """Each family's place by first appearance, for ties decided in evidence order."""
    rows = attestations.groupBy("family").agg(F.min(position).alias("at")).orderBy("at", "family").collect()  # families are few
    return {r["family"]: i for i, r in enumerate(rows)}


def knee(steps: DataFrame) -> DataFrame:
    """(language, knee): the first step past the minimum whose gain is below a part of the best; none, no row."""
    best = steps.groupBy("language").agg(F.max("gained").alias("best"))
    late = steps.join(best, "language").where((F.col("families") > KNEE_AFTER) & (F.col("gained") < F.col("best") / KNEE_PART))
    return late.groupBy("language").agg(F.min("families").alias("knee"))


#: Strokes by whether a list ships.
_DASH = {"yes": "", "held": ' stroke-dasharray="6 4"', "pending": ' stroke-dasharray="2 4"'}


def chart(curves: list[tuple[str, list[tuple[int, float]], str]], width: int = 960, height: int = 540) -> str:
    """An SVG of share against families; a curve is (language, [(families, share)], ships)."""
    left, top, right, bottom = 60, 30, 120, 50
    most = max([1, *(n for _, steps, _ in curves for n, _ in steps)])
    x = lambda n: left + (width - left - right) * n / most
    y = lambda share: top + (height - top - bottom) * (1 - share)
    parts = [f'<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 {width} {height}" font-family="sans-serif" font-size="12">']
    for tenth in range(0, 11, 2):
        at = y(tenth / 10)
        parts.append(f'<line x1="{left}" y1="{at:.1f}" x2="{width - right}" y2="{at:.1f}" stroke="#ddd"/><text x="{left - 8}" y="{at + 4:.1f}" text-anchor="end">{tenth * 10}%</text>')
    for n in range(1, most + 1):
        parts.append(f'<text x="{x(n):.1f}" y="{height - bottom + 18}" text-anchor="middle">{n}</text>')
    labels: list[float] = []
    for i, (language, steps, ships) in enumerate(sorted(curves, key=lambda c: -(c[1][-1][1] if c[1] else 0))):
        if not steps:
            continue
        colour = f"hsl({i * 137 % 360} 60% 42%)"
        points = " ".join(f"{x(n):.1f},{y(s):.1f}" for n, s in steps)
        parts.append(f'<polyline points="{points}" fill="none" stroke="{colour}" stroke-width="2"{_DASH[ships]}/>')
        at = y(steps[-1][1]) + 4
        while any(abs(at - other) < 13 for other in labels):  # labels below one another, none on another
            at += 13
        labels.append(at)
        parts.append(f'<text x="{x(steps[-1][0]) + 6:.1f}" y="{at:.1f}" fill="{colour}">{escape(language, quote=False)}</text>')
    return "\n".join([*parts, "</svg>"]) + "\n"
