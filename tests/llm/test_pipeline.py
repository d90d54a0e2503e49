import zlib
from collections import Counter

import corpus_pipeline
from lexwarrant.llm import queries
from lexwarrant.storage import write_table

from .test_near_and_lines import brute, brute_templates
from .test_tokens_and_packing import expected_pieces, lay_out


def test_stages_against_brute_force(spark):
    """Each stage on what the one before it kept."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf), name)
        assert docs.columns == columns and docs.schema == spark.read.parquet(f"{sf}/documents.parquet").schema
        after = docs.collect()
        ids = Counter(r["doc_id"] for r in after)
        if name == "language_id":
            assert {r["doc_id"] for r in before if any(c.isalpha() for c in r["text"])} == set(ids)
        elif name == "line_dedup":
            drop = brute_templates([r["text"] for r in before])
            expected = {r["doc_id"]: "\n".join(x for i, x in enumerate(r["text"].split("\n")) if (r["text"], i) not in drop) for r in before}
            changed = {r["doc_id"] for r in before if expected[r["doc_id"]] != r["text"]}
            assert {r["doc_id"]: r["text"] for r in after} == {i: t for i, t in expected.items() if t.split() or i not in changed}
            assert all(r["n_chars"] == len(r["text"]) for r in after if r["doc_id"] in changed)
        elif name == "near_dedup":
            found, _ = brute({r["doc_id"]: r["text"] for r in before}, 5)
            assert set(ids) == {i for i, c in found.items() if i == c} and max(ids.values()) == 1
        elif name == "mixing":
            texts = {r["doc_id"]: r["text"] for r in before}
            assert all(texts[r["doc_id"]] == r["text"] for r in after) and max(ids.values()) <= 3
        before = after
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    expected = Counter(expected_pieces([(r["doc_id"], r["text"]) for r in before], 2048))
    assert Counter(tuple(r[k] for k in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in rows) == expected
    lay_out(rows, 2048)


def test_run_is_the_stages(spark):
    sf = "/root/testdata/sf0.001"
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and all(r["length"] <= 2048 for r in rows)


def test_the_language_stage_labels_and_selects(spark, documents, monkeypatch):
    german, english = "der hund und die katze sind nicht in das haus gegangen", "the dog and the cat have not gone into the house"
    rows = [(i, german if i % 2 else english, "de" if i % 2 else "en", "s", 1) for i in range(40)]
    rows += [(100, german, None, "s", 1), (101, german, "en", "s", 1), (102, "1234 ...", "en", "s", 1)]
    got = {r["doc_id"]: r["lang"] for r in corpus_pipeline.identify(spark, documents(rows), "").collect()}
    assert set(got) == {r[0] for r in rows} - {102} and got[100] == got[101] == "de" and got[0] == "en"
    monkeypatch.setattr(corpus_pipeline, "WANTED_LANGUAGES", frozenset({"de"}))
    assert set(corpus_pipeline.identify(spark, documents(rows), "").select("lang").distinct().toPandas()["lang"]) == {"de"}


def test_odd_rows_pass_all_stages(spark, odd):
    docs = odd
    # tables whose names differ in case only can be written and read only so
    spark.conf.set("spark.sql.caseSensitive", "true" if "TEXT" in odd.columns else "false")
    try:
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = write_table(stage(spark, docs, ""), "stage")
            assert docs.columns == odd.columns
        rows = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    assert bool(rows) == bool(odd.rows)


def test_queries_are_registered():
    assert [int(n[2:].split("_")[0]) for n in queries.queries()] == list(range(1, 14))
    assert zlib.crc32(b"4") >= 0 and set(queries.oracle_sql()) <= set(queries.queries())
