"""python -m lexwarrant conform FOLDER | status FOLDER | languages FOLDER... | dumps FOLDER
| verify FOLDER [WORDS] | harvest FOLDER CANDIDATES SITE... | cache FOLDER CLAIMS [--strict]

CLAIMS has a file and a language by tab in each line.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import SparkSession, functions as F

from .operators import checks, reports, repository
from .sources import ingest


def main(args: list[str]) -> int:
    if len(args) < 2 or args[0] not in ("conform", "status", "languages", "dumps", "verify", "harvest", "cache"):
        print(__doc__)
        return 2
    spark = SparkSession.builder.appName("lexwarrant").getOrCreate()
    command, folders = args[0], args[1:]
    if command == "conform":
        failures = repository.conform(spark, folders[0])
        for check, detail in failures:
            print(f"{check}: {detail}")
        return int(bool(failures))
    if command == "status":
        print(reports.saturation_markdown(repository.save_status(spark, folders[0])), end="")
        return 0
    if command == "languages":
        print(reports.languages_markdown(repository.roll_up(spark, folders)), end="")
        return 0
    if command == "verify":
        checked, proofs = repository.verify(spark, folders[0], int(folders[1]) if len(folders) > 1 else 20, ingest.http_get)
        for r in checks.tally(checked).orderBy("outcome").collect():
            print(f"{r['n']:8} {r['outcome']}")
        short = [r["word"] for r in proofs.where(~F.col("holds")).orderBy("word").collect()]
        print(*(f"not proved: {w}" for w in short), sep="\n", end="\n" if short else "")
        return int(bool(short))
    if command == "harvest":
        print(repository.harvest(spark, folders[0], folders[2:], repository.candidates(spark, folders[1]), ingest.http_get), "pages")
        return 0
    if command == "cache":
        here = spark.createDataFrame([(p.name, p.stat().st_size) for p in sorted(Path(folders[0]).iterdir()) if p.is_file()], "file string, bytes long")
        claims = spark.read.option("sep", "\t").schema("file string, language string").csv(folders[1])
        claimed = reports.cache_claims(here, claims)
        for r in claimed.orderBy("file").collect():
            print(f"{r['bytes']:14} {r['file']}  {', '.join(r['languages']) or 'nobody'}")
        return reports.strict_exit(claimed, "--strict" in folders)
    files = spark.createDataFrame([(p.name, p.stat().st_size) for p in sorted(Path(folders[0]).iterdir()) if p.is_file()], "name string, have long")
    asked = {r["name"]: r["url"] for r in files.select("name", checks.dump_url(F.col("name")).alias("url")).collect() if r["url"]}
    sizes = spark.createDataFrame([(n, ingest.http_size(u)) for n, u in asked.items()], "name string, expect long")
    rows = checks.dump_verdicts(files.join(sizes, "name", "left").withColumn("from", F.lit(None).cast("string"))).orderBy("name").collect()
    for r in rows:
        print(f"{r['verdict']:12} {r['name']}")
    return int(any(r["verdict"] == "truncated" for r in rows))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
