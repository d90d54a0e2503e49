"""More registered queries: file readers, orders, reports, guards and renderings."""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.registry import sources_table, valid_id
from ..functions.text import escaped
from ..functions.urls import is_sitemap_index
from ..operators import build as B, checks as C, curve as K, reports as R, rule, scan as S
from ..sources import readers as X
from ..storage import fresh_path
from ..streaming import incremental as I
from . import corpus
from .corpus import table
from .queries import _FLAT, _GREEDY, _HARVEST, _PRE, _STEPS, MINIMUM, _attested, _built, _counts, _flat, _prose_sql, _rated, _scan, _steps, query

_GREEDY_PRE = _PRE.replace("WITH", "WITH RECURSIVE", 1).rstrip() + "," + _GREEDY


# Files


def _lines_in(spark, rows: DataFrame, name: str, **options) -> str:
    """The folder of text files that hold ``line``."""
    path = fresh_path(spark, name)
    rows.select("line").write.options(**options).text(path)
    return path


def _one_file_each(spark, rows: DataFrame, name: str) -> list[str]:
    """The folders of files of rows(name, text), one each, written by tasks.

    An attempt of a task has a folder of its own, so that one given up can't touch what another has written.
    """
    path = fresh_path(spark, name)

    def write(batches):
        folder = f"{path}/{uuid.uuid4().hex}"
        system, inside = fs.FileSystem.from_uri(folder) if re.match("[a-z0-9]+:", folder) else (fs.LocalFileSystem(), folder)
        system.create_dir(inside, recursive=True)
        for batch in batches:
            for file, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist()):
                with system.open_output_stream(f"{inside}/{file}") as out:
                    out.write((text or "").encode())
        yield pa.RecordBatch.from_arrays([pa.array([folder])], names=["folder"])

    return [r["folder"] for r in rows.select("name", "text").mapInArrow(write, "folder string").collect()]  # a row a task


@query(f"SELECT CAST(doc_id AS VARCHAR) AS locator, {_FLAT} AS text FROM documents WHERE doc_id % 3 <> 0", pre=False)
def tatoeba_file(spark, d):
    line = F.when(F.col("doc_id") % 3 == 0, F.concat_ws("\t", F.col("doc_id").cast("string"), F.lit("de"))).otherwise(F.concat_ws("\t", F.col("doc_id").cast("string"), F.lit("de"), _flat()))
    return X.tatoeba_documents(spark, _lines_in(spark, table(spark, d, "documents").select(line.alias("line")), "tatoeba")).select("locator", "text")


@query(f"SELECT CAST(doc_id AS VARCHAR) AS locator, {_prose_sql('text')} AS text FROM documents WHERE doc_id % 5 <> 0", pre=False)
def wiki_dump_packed(spark, d):
    """Documents as pages of a packed dump; every fifth is no article."""
    page = F.concat(
        F.lit("<page>\n<title>t</title>\n<ns>"), F.when(F.col("doc_id") % 5 == 0, "1").otherwise("0"), F.lit("</ns>\n<id>"), F.col("doc_id").cast("string"),
        F.lit('</id>\n<revision><id>99</id><text bytes="1">'), "text", F.lit("</text></revision>\n</page>"),
    )
    path = _lines_in(spark, table(spark, d, "documents").select(page.alias("line")), "dump", compression="bzip2")
    return X.wiki_documents(spark, path, "wiki:xx").select("locator", "text")


@query("SELECT 'b' || doc_id AS locator, text FROM documents", pre=False)
def book_files(spark, d):
    """Documents as files of their own, of one name but for the ending where ids come again; what has no name or no text can't be a file."""
    locator = F.concat(F.lit("b"), F.col("doc_id").cast("string")).alias("locator")
    docs = table(spark, d, "documents").select(locator, "text")
    filed = F.col("locator").isNotNull() & F.col("text").isNotNull()
    named = docs.where(filed).select(F.concat("locator", F.lit(".txt"), F.monotonically_increasing_id().cast("string")).alias("name"), "text")
    return X.file_documents(spark, _one_file_each(spark, named, "books"), "books").select("locator", "text").union(docs.where(~filed))


@query("SELECT CASE WHEN doc_id % 4 = 0 THEN 'b' || doc_id ELSE 'b' || doc_id || '/scan ' || doc_id || '.txt' END AS locator, text FROM documents WHERE length(text) >= 1500", pre=False)
def long_scanned_books(spark, d):
    """Scans that are long enough, cited by the file their manifest names; every fourth isn't in it."""
    docs = table(spark, d, "documents")
    item = F.concat(F.lit("b"), F.col("doc_id").cast("string"))
    folder = _one_file_each(spark, docs.select(F.concat(item, F.lit(".txt")).alias("name"), "text"), "scans")
    manifest = docs.where("doc_id % 4 <> 0").select(item.alias("id"), F.concat(F.lit("scan "), F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"))
    return X.archive_documents(spark, folder, manifest, 1500).select("locator", "text")


@query(f"""SELECT 'web:example.org' AS source, u.url AS locator, string_agg(repeat(word || ' ', CAST(n AS INT)), '' ORDER BY word) AS words FROM dw JOIN ({_HARVEST.replace("'.example.org/p'", "'.example.org/q'")}) u ON u.doc_id = dw.doc_id
  WHERE word IN (SELECT word FROM cand) GROUP BY 2""")
def harvest_file(spark, d):
    """A harvest log's files as documents of their domains, each word as often as it is counted."""
    pairs = F.array_join(F.collect_list(F.concat("word", F.lit(":"), F.col("n").cast("string"))), " ")
    url = F.concat(F.lit("https://"), "source", F.lit(".example.org/q"), "locator")
    lines = _counts(spark, d).where("word is not null").groupBy("source", "locator").agg(pairs.alias("pairs")).select(F.concat(url, F.lit("\t"), "pairs").alias("line"))
    found = X.harvest_documents(spark, _lines_in(spark, lines, "harvest"))
    return found.select("source", "locator", F.concat(F.array_join(F.array_sort(F.split("text", " ")), " "), F.lit(" ")).alias("words"))


_LISTED = "SELECT word, CASE WHEN length(word) % 2 = 0 THEN lower(word) END AS written FROM cand"


def _list_file(spark, d) -> DataFrame:
    words = corpus.candidates(spark, d).select("word", F.when(F.length("word") % 2 == 0, F.lower("word")).alias("written"))
    lines = words.select(F.concat_ws("\t", "word", "written").alias("line")).union(spark.createDataFrame([("",)], "line string"))
    # a list is one file, and its header the first line
    head = spark.createDataFrame([("!header\tone line",)], "line string")
    path = _lines_in(spark, head.union(lines).coalesce(1).sortWithinPartitions(F.col("line") != "!header\tone line", "line"), "list")
    return X.numbered_lines(spark, path)


@query(_LISTED)
def candidate_file(spark, d):
    return X.candidate_list(_list_file(spark, d))


@query(f"SELECT word FROM ({_LISTED})")
def shipped_file(spark, d):
    return X.shipped_words(_list_file(spark, d))


@query("""SELECT CAST(doc_id AS VARCHAR) AS id, 'a "b", c' || chr(10) || doc_id AS title FROM documents WHERE doc_id % 3 = 0 AND doc_id % 2 = 0""", pre=False)
def catalogue_file(spark, d):
    """A catalogue with quotes and line ends in its fields; of one kind and exactly one language."""
    n = F.col("doc_id")
    rows = table(spark, d, "documents").select(
        n.cast("string").alias("Text#"), F.when(n % 3 == 0, "Text").otherwise("Sound").alias("Type"), F.when(n % 2 == 0, "de").otherwise("en; de").alias("Language"),
        F.concat(F.lit('a "b", c\n'), n.cast("string")).alias("Title"),
    )
    path = fresh_path(spark, "catalogue")
    rows.write.option("header", True).option("escape", '"').csv(path)
    return X.catalogue(spark, path, "de").select(F.col("Text#").alias("id"), F.col("Title").alias("title"))


# Sources


@query("""SELECT id, family, locator_kind, template, ranks, as_of, checkability FROM (SELECT DISTINCT source, CAST(substr(source, 4) AS INT) AS n FROM documents), LATERAL (
  SELECT * FROM (VALUES
    ('wiki:' || source, 'wikimedia', 'template', 'https://' || source || '.wikipedia.org/?curid={id}', true, NULL, 'durable'),
    ('wikisource:' || source, 'wikimedia', 'template', 'https://' || source || '.wikisource.org/?curid={id}', true, NULL, 'durable'),
    ('lz:' || source || '_' || (1990 + n) || '_1M', 'leipzig', 'url', NULL, true, CAST(1990 + n AS VARCHAR), 'crawled'),
    ('ebible:' || source, 'ebible', 'template', 'https://ebible.org/' || source || '/{id}.htm', true, NULL, 'durable'),
    ('ud:' || source || '@c0ffee', source, 'template', 'https://raw.githubusercontent.com/UniversalDependencies/' || source || '/c0ffee/{id}', true, NULL, 'durable'),
    ('web:' || source || '.org', source || '.org', 'url', NULL, false, NULL, 'live')) t(id, family, locator_kind, template, ranks, as_of, checkability))""", pre=False)
def source_lookup(spark, d):
    """Ids of every derived kind for each source, and some that name nothing."""
    named = [r["source"] for r in table(spark, d, "documents").select("source").distinct().collect()]  # sources are few
    ids = [i for s in named for i in (f"wiki:{s}", f"wikisource:{s}", f"lz:{s}_{1990 + int(s[3:])}_1M", f"ebible:{s}", f"ud:{s}@c0ffee", f"web:{s}.org", f"ud:{s}", f"none:{s}", f"wiki:{''}", s)]
    return sources_table(spark, ids).select("id", "family", "locator_kind", "template", "ranks", "as_of", "checkability")


@query("SELECT doc_id, doc_id % 5 = 4 AS valid FROM documents", pre=False)
def valid_ids(spark, d):
    sign = F.element_at(F.array(*map(F.lit, (" ", ",", "\t", "", ":"))), (F.col("doc_id") % 5 + 1).cast("int"))
    return table(spark, d, "documents").select("doc_id", valid_id(F.when(F.col("doc_id") % 5 == 3, "").otherwise(F.concat("source", sign, F.lit("x")))).alias("valid"))


@query("SELECT page_id, page_id % 3 < 2 AS is_index FROM pages", pre=False)
def sitemap_indexes(spark, d):
    kind = F.element_at(F.array(*map(F.lit, ("<sitemapindex>", '<?xml?><sitemapindex xmlns="x">', "<sitemapindexes>"))), (F.col("page_id") % 3 + 1).cast("int"))
    return table(spark, d, "pages").select("page_id", is_sitemap_index(F.concat(kind, F.lit("<loc>"), "url", F.lit("</loc>"))).alias("is_index"))


@query("SELECT page_id, replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS text FROM pages", pre=False)
def escaped_pages(spark, d):
    return table(spark, d, "pages").select("page_id", escaped(F.col("html")).alias("text"))


# Orders

_BASE = "replace(strip_accents(word), '’', '''')"


@query(f"SELECT word, families, CAST(row_number() OVER (ORDER BY families DESC, {_BASE}, word) AS BIGINT) AS place FROM fam WHERE families < {MINIMUM}")
def drop_order(spark, d):
    return B.in_drop_order(_built(spark, d).dropped, rule.by_letters("word")).select("word", "families", "place")


@query(f"SELECT word, round(rate, 6) AS rate, CAST(row_number() OVER (ORDER BY round(rate, 6) DESC, {_BASE}, word) AS BIGINT) AS rank FROM rate")
def kept_order(spark, d):
    return rule.ranked(_rated(spark, d), rule.by_letters("word")).select("word", "rate", "rank")


@query("SELECT word FROM cand ORDER BY md5('7:' || word), word LIMIT 40")
def sampled_words(spark, d):
    return C.sample_words(corpus.candidates(spark, d), 40, seed=7)


def _placed(rows: DataFrame, report: str, name: str) -> DataFrame:
    """A sorted report's rows with their place, as they come; reports are a row a source or a domain."""
    place = F.row_number().over(W.orderBy("_at"))
    return rows.withColumn("_at", F.monotonically_increasing_id()).select(F.lit(report).alias("report"), F.col(name).alias("name"), place.alias("place"))


@query("""SELECT 'collections' AS report, source AS name, CAST(row_number() OVER (ORDER BY tokens DESC, source) AS INT) AS place FROM totals
  UNION ALL SELECT 'domains', domain, CAST(row_number() OVER (ORDER BY n DESC, domain) AS INT) FROM (SELECT source || '.org' AS domain, count(*) AS n FROM documents GROUP BY 1)
  UNION ALL SELECT 'combos', combo, CAST(row_number() OVER (ORDER BY words DESC, combo) AS INT) FROM (SELECT combo, count(*) AS words FROM (
    SELECT word, array_to_string(list_sort(list(DISTINCT family)), ' + ') AS combo FROM att WHERE word IN (SELECT word FROM fam WHERE families = 2) GROUP BY 1) GROUP BY 1 ORDER BY words DESC, combo LIMIT 8)""")
def report_orders(spark, d):
    scan, built = _scan(spark, d), _built(spark, d)
    origins = corpus.sources(spark, d).select(F.col("id").alias("source"), F.col("template").alias("origin"))
    domains = table(spark, d, "documents").select(F.concat("source", F.lit(".org")).alias("domain"))
    rows = _placed(R.collections(scan.totals, origins), "collections", "source").union(_placed(R.pages_by_domain(domains), "domains", "domain"))
    return rows.union(_placed(R.top_combos(R.near_misses(built.dropped, built.attestations)), "combos", "combo"))


@query(f"""SELECT source, tokens, CAST(row_number() OVER (ORDER BY source) AS BIGINT) AS place FROM (SELECT 'web:' || source || '.org' AS source, CAST(count(*) AS BIGINT) AS tokens FROM w GROUP BY 1)""")
def domain_order(spark, d):
    """Totals by domain, in order."""
    pages = corpus.documents(spark, d).select("seq", F.concat(F.lit("https://www."), "source", F.lit(".org/"), "locator").alias("locator"), "text")
    totals = S.scan_by_domain(pages, corpus.candidates(spark, d)).totals
    return rule.numbered(totals, ["source"], "place")


# Guards


@query(f"""SELECT 'itself' AS list, true AS same UNION ALL SELECT 'kept', (SELECT count(*) FROM fam WHERE families >= {MINIMUM}) = (SELECT count(*) FROM cand)
  UNION ALL SELECT 'renamed', false""")
def own_output(spark, d):
    """Whether the candidates are the list itself: the same words, fewer, and as many others."""
    words = corpus.candidates(spark, d)
    lists = {"itself": words, "kept": _built(spark, d).kept, "renamed": words.select(F.concat("word", F.lit("X")).alias("word"))}
    return spark.createDataFrame([(name, B.same_as_output(words, rows)) for name, rows in lists.items()], "list string, same boolean")


@query("SELECT source FROM totals WHERE CAST(substr(source, 4) AS INT) % 4 = 1 AND tokens > 0")
def refused_scans(spark, d):
    """Every fourth source comes back without a word; those that had some are refused."""
    totals = _scan(spark, d).totals
    return B.empty_scans(totals.withColumn("tokens", F.when(corpus.number(F.col("source")) % 4 == 1, 0).otherwise(F.col("tokens"))), totals)


@query("SELECT source AS id, CAST(row_number() OVER (ORDER BY n DESC, source) AS INT) AS place FROM (SELECT source, sum(n_chars) AS n FROM documents GROUP BY 1) WHERE CAST(substr(source, 4) AS INT) % 3 = 0 AND CAST(substr(source, 4) AS INT) % 2 = 0", pre=False)
def items_to_fetch(spark, d):
    """Items neither held (every second) nor rejected, largest first."""
    items = table(spark, d, "documents").groupBy(F.col("source").alias("id")).agg(F.sum("n_chars").alias("downloads"))
    n = corpus.number(F.col("id"))
    return _placed(R.held_or_new(items, items.where(n % 2 == 1), items.where(n % 3 != 0)), "", "id").select(F.col("name").alias("id"), "place")


@query("""SELECT CAST(sum(n_chars) FILTER (lang IS NOT NULL) AS BIGINT) AS claimed, CAST(5 AS BIGINT) AS loose, CAST(1 AS INT) AS strict, CAST(0 AS INT) AS plain FROM documents""", pre=False)
def cache_bytes(spark, d):
    """Bytes that somebody claims and that nobody does, and what a strict and a plain check end with."""
    docs = table(spark, d, "documents")
    files = docs.groupBy(F.col("source").alias("file")).agg(F.sum("n_chars").alias("bytes")).union(spark.createDataFrame([("loose", 5)], "file string, bytes long"))
    claimed = R.cache_claims(files, docs.select(F.col("source").alias("file"), F.col("lang").alias("language")))
    return R.cache_totals(claimed).select("claimed", "loose", F.lit(R.strict_exit(claimed)).alias("strict"), F.lit(R.strict_exit(claimed, False)).alias("plain"))


@query(f"""SELECT 'https://x.org/' || d.doc_id AS url, coalesce(words, '') AS words FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(word || ':' || n, ' ' ORDER BY word) AS words FROM dw WHERE word IN (SELECT word FROM cand) GROUP BY 1) x ON x.doc_id = d.doc_id""")
def resumed_harvest(spark, d):
    """A harvest of some pages, and one of all that goes on with the rest: each page once."""
    path, words = fresh_path(spark, "resumed"), corpus.candidates(spark, d)
    url = F.concat(F.lit("https://x.org/"), F.col("doc_id").cast("string")).alias("url")
    pages = table(spark, d, "documents").select(url, F.lit("x.org").alias("domain"), "text")
    I.append_harvest(pages.where(F.pmod(F.xxhash64("url"), F.lit(3)) == 0), words, path)
    I.append_harvest(I.new_pages(pages.union(pages), I.harvested(spark, path)), words, path)
    pairs = F.transform("words", lambda w: F.concat(w["word"], F.lit(":"), w["n"].cast("string")))
    return I.harvested(spark, path).select("url", F.array_join(pairs, " ").alias("words"))


# Renderings


@query(_GREEDY_PRE + f""", st AS ({_STEPS}), ck AS (SELECT family, bool_or(as_of IS NULL) AS c FROM src JOIN (SELECT DISTINCT source FROM att) USING (source) GROUP BY 1)
SELECT 'xx' AS language, (SELECT count(*) FROM fam) AS candidates, (SELECT count(*) FROM fam WHERE families >= {MINIMUM}) AS shipped, 'yes' AS ships, CAST((SELECT count(*) FROM ck) AS INT) AS families,
  CAST((SELECT count(*) FROM ck WHERE c) AS INT) AS checkable, (SELECT CAST(min(families) AS INT) FROM st WHERE families > 3 AND gained < (SELECT max(gained) FROM st) / 20.0) AS knee,
  (SELECT string_agg(families || ' ' || added || ' ' || kept || ' ' || gained, ', ' ORDER BY families) FROM st) AS steps""", pre=False)
def status_row(spark, d):
    """A language's status, with a decision taken before."""
    known, steps = corpus.sources(spark, d).select(F.col("id").alias("source"), "checkability"), _steps(spark, d).withColumn("language", F.lit("xx"))
    state = R.status("xx", "2020-01-01", _built(spark, d).verdicts, steps, R.family_checkability(_attested(spark, d), known), K.knee(steps), True, {"ships": True})
    row = spark.createDataFrame([state], R.STATUS)
    said = F.array_join(F.transform("steps", lambda s: F.concat_ws(" ", s["families"].cast("string"), s["added"], s["kept"].cast("string"), s["gained"].cast("string"))), ", ")
    return row.select("language", "candidates", "shipped", "ships", "families", "checkable", "knee", said.alias("steps"))


def _languages(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").where("lang IS NOT NULL")
    n = F.count(F.lit(1))
    rows = docs.groupBy(F.col("lang").alias("language")).agg((n * 1000).alias("candidates"), F.count_if(F.col("doc_id") % 2 == 0).alias("even"), F.count_distinct("source").cast("int").alias("families"))
    return rows.select("language", "candidates", (F.col("even") * 1000).alias("shipped"), "families", F.lit(2).alias("checkable"), F.when(F.length("language") == 2, F.lit(4)).alias("knee"), F.lit("held").alias("ships"))


@query("""SELECT '| ' || lang || ' | ' || format('{:,}', n) || ' | ' || format('{:,}', k) || ' | ' || printf('%.1f', k * 100.0::DOUBLE / n) || '% | ' || f || ' | 2 | ' || CASE WHEN length(lang) = 2 THEN '4' ELSE 'still paying' END || ' | held |' AS line FROM (
  SELECT lang, count(*) * 1000 AS n, count(*) FILTER (doc_id % 2 = 0) * 1000 AS k, count(DISTINCT source) AS f FROM documents WHERE lang IS NOT NULL GROUP BY 1)""", pre=False)
def languages_table(spark, d):
    lines = R.languages_markdown(_languages(spark, d)).split("\n")[2:-1]
    return spark.createDataFrame([(x,) for x in lines], "line string")


@query(_GREEDY_PRE + f""", st AS ({_STEPS}), z AS (SELECT max(families) AS most FROM st)
SELECT string_agg(printf('%.1f', 60 + 780 * families / most) || ',' || printf('%.1f', 30 + 460 * (1 - kept::DOUBLE / (SELECT count(*) FROM cand))), ' ' ORDER BY families) AS points FROM st, z""", pre=False)
def chart_points(spark, d):
    """The curve of the chart."""
    steps = [(r["families"], r["share"]) for r in _steps(spark, d).orderBy("families").collect()]  # a row a family
    drawn = K.chart([("xx", steps, "yes")])
    return spark.createDataFrame([(re.search('<polyline points="([^"]*)"', drawn)[1],)], "points string")
