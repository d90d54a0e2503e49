"""What is known of a source: family, citation, checkability. A dimension table made from source ids."""

from __future__ import annotations

import re
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SCHEMA = "id string, family string, name string, attribution string, locator_kind string, template string, ranks boolean, as_of string, checkability string"


@dataclass(frozen=True)
class Source:
    id: str
    family: str
    name: str
    attribution: str
    locator_kind: str  # template or url
    template: str | None = None
    ranks: bool = True
    as_of: str | None = None

    @property
    def checkability(self) -> str:
        """durable: a lasting identifier; live: a page fetched; crawled: a page someone else fetched."""
        if self.as_of is not None or self.family == "commoncrawl":
            return "crawled"
        return "live" if self.id.startswith("web:") else "durable"


def year_in(name: str) -> str | None:
    found = re.search(r"(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)", name)
    return found[1] if found else None


# Sources whose id says nothing, and the address templates of those whose id does.
FIXED = {
    s.id: s
    for s in (
        Source("gut", "gutenberg", "Project Gutenberg", "Project Gutenberg contributors", "template", "https://www.gutenberg.org/cache/epub/{id}/pg{id}.txt"),
        Source("ia", "internetarchive", "Internet Archive", "Internet Archive contributors", "template", "https://archive.org/download/{id}"),
        Source("tat", "tatoeba", "Tatoeba", "Tatoeba contributors", "template", "https://tatoeba.org/en/sentences/show/{id}"),
        Source("fw2", "commoncrawl", "FineWeb-2", "FineWeb-2, from Common Crawl", "url"),
        Source("cc", "commoncrawl", "Common Crawl", "Common Crawl Foundation", "url"),
    )
}


def validate_id(source: str) -> str:
    """Refuses an id that the evidence format could not hold."""
    if not source:
        raise ValueError("a source id is empty")
    if re.search(r"[\t, ]", source):
        raise ValueError(f"source id {source!r} has a character that separates fields")
    return source


def valid_id(source: Column) -> Column:
    """Whether the evidence format can hold an id: not empty, without what separates fields."""
    return F.coalesce((source != "") & ~source.rlike("[\t, ]"), F.lit(False))


def source_for(source: str) -> Source:
    """The source of an id, or LookupError."""
    if source in FIXED:
        return FIXED[source]
    kind, colon, rest = source.partition(":")
    if colon and rest:
        if kind in ("wiki", "wikisource"):
            host = f"{rest}.{'wikipedia' if kind == 'wiki' else 'wikisource'}.org"
            return Source(source, "wikimedia", host, f"{host} contributors", "template", f"https://{host}/?curid={{id}}")
        if kind == "lz":
            return Source(source, "leipzig", f"Leipzig {rest}", f"Leipzig Corpora, {rest}", "url", as_of=year_in(rest))
        if kind == "ebible":
            return Source(source, "ebible", f"eBible {rest}", f"eBible.org, {rest}", "template", f"https://ebible.org/{rest}/{{id}}.htm")
        if kind == "ud":
            bank, at, commit = rest.partition("@")
            if not (bank and at and commit):
                raise LookupError(f"{source!r} must name a treebank and a commit")
            return Source(source, bank, f"Universal Dependencies {bank}", f"Universal Dependencies, {bank} contributors", "template", f"https://raw.githubusercontent.com/UniversalDependencies/{bank}/{commit}/{{id}}")
        if kind == "web":
            return Source(source, rest, rest, rest, "url", ranks=False)
    raise LookupError(f"no source is registered as {source!r}")


def sources_table(spark: SparkSession, ids: list[str]) -> DataFrame:
    """One row per registered id; unregistered ids have none. The ids of a build are few by nature."""
    rows = []
    for i in sorted(set(ids)):
        try:
            s = source_for(i)
        except LookupError:
            continue
        rows.append((*astuple(s), s.checkability))
    return spark.createDataFrame(rows, SCHEMA)


def expand_locator(kind: Column, template: Column, locator: Column) -> Column:
    """The address a locator stands for; a template names the id once or more."""
    return F.when(kind == "url", locator).otherwise(F.replace(template, F.lit("{id}"), locator))


def archive_url(url: Column, when: Column | None = None) -> Column:
    return F.concat(F.lit("https://web.archive.org/web/"), F.coalesce(when, F.lit("2020")) if when is not None else F.lit("2020"), F.lit("/"), url)


def year_column(name: Column) -> Column:
    """The year in a package name, null if there is none."""
    found = F.regexp_extract(name, r"(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)", 1)
    return F.when(found != "", found)


def checkability(source: Column, family: Column, as_of: Column) -> Column:
    return F.when(as_of.isNotNull() | (family == "commoncrawl"), "crawled").when(F.startswith(source, F.lit("web:")), "live").otherwise("durable")
