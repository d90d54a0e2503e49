"""Names of files: one call to the JVM for all, not one each."""

from lexwarrant.sources import readers as X


def test_names_of_files_come_in_one_call(spark, tmp_path, monkeypatch):
    names = ["b ü1.txt", "a%2.txt", "c+3.txt", "d\n4.txt"]
    for name in names:
        (tmp_path / name).write_text(name)
    files = spark.read.text(str(tmp_path), wholetext=True)
    assert sorted(X.file_names(files)) == sorted(files.inputFiles()) and len(files.inputFiles()) == 4
    assert X.file_names(spark.range(1)) == []

    def each(self):
        raise AssertionError("a call a name")

    monkeypatch.setattr(type(files), "inputFiles", each)
    docs = X.file_documents(spark, str(tmp_path), "books").orderBy("seq").collect()
    assert [r["text"] for r in docs] == sorted(names) and [r["seq"] >> 40 for r in docs] == [0, 1, 2, 3]
