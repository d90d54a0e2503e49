"""Files of any number: listed and read by tasks, empty, repeated and missing ones included."""

import bz2
import gzip

from lexwarrant.plans import queries
from lexwarrant.sources import readers as X

from .compare import differences


def test_empty_repeated_and_missing_documents(spark, tmp_path):
    rows = [(1, "one"), (2, ""), (3, None), (None, "no id"), (4, "twice"), (4, "twice"), (4, "other\r\n\x00text ü"), (-5, "﻿mark")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    query, sql = queries.REGISTRY["book_files"]
    found = query(spark, str(tmp_path))
    want = sorted((f"b{i}" if i is not None else "", t or "", t is None) for i, t in rows)
    assert sorted((r["locator"] or "", r["text"] or "", r["text"] is None) for r in found.collect()) == want


def test_same_rows_as_sql(spark):
    query, sql = queries.REGISTRY["book_files"]
    assert differences(query(spark, "/root/testdata/sf0.001"), sql, "/root/testdata/sf0.001") == ([], [])


def test_the_driver_lists_no_files(spark, tmp_path, monkeypatch):
    for folder, name, text in (("x", "b.txt", b"B"), ("y", "a.txt", b""), ("y", "_no", b"-"), ("y", "c.txt.gz", gzip.compress(b"C")), ("x", "d.bz2", bz2.compress(b"D"))):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_bytes(text)

    def held(*_):
        raise AssertionError("names on the driver")

    monkeypatch.setattr(X, "file_ranks", held)
    monkeypatch.setattr(X, "TASK_FILES", 2)
    docs = X.file_documents(spark, [f"{tmp_path}/x", f"file://{tmp_path}/y"], "s").orderBy("seq").collect()
    assert [(r["seq"] >> 40, r["locator"], r["text"]) for r in docs] == [(0, "a", ""), (1, "b", "B"), (2, "c.txt", "C"), (3, "d", "D")]
    assert X.file_documents(spark, [], "s").count() == 0
