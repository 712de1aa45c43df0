"""Result sets that appear whole or not at all.

All tables of a set are written aside, and counted and summed up by the writes themselves. Only then a
manifest with their folders, rows and checksums is published by a rename, under the next number. Readers
follow the manifest of the highest number, so a set that fails on the way changes nothing for them. A
rerun with the same rows publishes nothing new.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_MANIFEST = re.compile(r"manifest-(\d{8})\.json")


def _checksum(df: DataFrame) -> Column:
    """A sum over row hashes that does not depend on the order of rows; rows that repeat count."""
    # Maps have no hash, and vectors none of their own; both are hashed as text.
    texts = [F.to_json(F.struct(F.col(f"`{f.name}`").alias("x"))) if _odd(f.dataType) else F.col(f"`{f.name}`") for f in df.schema.fields]
    whole = F.xxhash64(*texts, F.lit(df.schema.simpleString()))
    return F.sum(whole.cast("decimal(38,0)"))


def _odd(kind) -> bool:
    return "map<" in kind.simpleString() or kind.typeName() == "udt"


def _place(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _delete(spark: SparkSession, path: str) -> None:
    files, at = _place(spark, path)
    files.delete(at, True)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    files, at = _place(spark, path)
    stream = files.create(at, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _numbers(spark: SparkSession, out_dir: str) -> list[int]:
    files, at = _place(spark, out_dir)
    if not files.exists(at):
        return []
    names = [status.getPath().getName() for status in files.listStatus(at)]
    return sorted(int(m.group(1)) for name in names if (m := _MANIFEST.fullmatch(name)))


def _manifest(spark: SparkSession, out_dir: str, number: int) -> list[dict]:
    line = spark.read.text(f"{out_dir}/manifest-{number:08d}.json", wholetext=True).first()["value"]
    return json.loads(line)


def _content(entries: list[dict]) -> list[tuple]:
    return sorted((e["name"], e["n"], e["checksum"], json.dumps(e["fields"])) for e in entries)


def _rename(spark: SparkSession, old: str, new: str) -> bool:
    files, at = _place(spark, old)
    return files.rename(at, spark._jvm.org.apache.hadoop.fs.Path(new))


def publish_results(results: dict[str, DataFrame], out_dir: str, keep: int = 2) -> int:
    """Write the tables as one set below ``out_dir`` and return the number of its manifest.

    If a table fails, what was written aside is deleted, the error is raised, and readers keep the set
    they had. With the same tables and rows as the published set, that one stays and its number is
    returned. The last ``keep`` sets stay for readers that have begun; older ones are deleted. Two writers
    at once get two numbers; the later one holds.
    """
    if not results or keep < 1:
        raise ValueError("a set needs a table, and keep must be positive")
    spark, out_dir = next(iter(results.values())).sparkSession, out_dir.rstrip("/")
    aside = f"sets/{uuid.uuid4().hex}"
    entries = []
    try:
        for name, df in results.items():
            seen = Observation()
            df.observe(seen, F.count(F.lit(1)).alias("n"), _checksum(df).alias("checksum")).write.parquet(f"{out_dir}/{aside}/{name}")
            found = seen.get
            entries.append(
                {"name": name, "folder": f"{aside}/{name}", "n": found["n"], "checksum": str(found["checksum"] or 0), "fields": df.schema.jsonValue()}
            )
    except Exception:
        _delete(spark, f"{out_dir}/{aside}")
        raise
    numbers = _numbers(spark, out_dir)
    if numbers and _content(_manifest(spark, out_dir, numbers[-1])) == _content(entries):
        _delete(spark, f"{out_dir}/{aside}")
        return numbers[-1]
    waiting, number = f"{out_dir}/{aside}.json", numbers[-1] + 1 if numbers else 1
    _write_text(spark, waiting, json.dumps(entries))
    while not _rename(spark, waiting, f"{out_dir}/manifest-{number:08d}.json"):
        number += 1  # another writer was first
    for old in [n for n in numbers if n <= number - keep]:
        folders = {e["folder"].rsplit("/", 1)[0] for e in _manifest(spark, out_dir, old)}
        _delete(spark, f"{out_dir}/manifest-{old:08d}.json")
        for folder in folders:
            _delete(spark, f"{out_dir}/{folder}")
    return number


def published(spark: SparkSession, out_dir: str) -> list[dict]:
    """The entries of the newest manifest. Raises if nothing is published."""
    out_dir = out_dir.rstrip("/")
    numbers = _numbers(spark, out_dir)
    if not numbers:
        raise FileNotFoundError(f"no result set in {out_dir}")
    return _manifest(spark, out_dir, numbers[-1])


def read_published(spark: SparkSession, out_dir: str, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The tables of the newest set, all of the same one."""
    entries = {e["name"]: e for e in published(spark, out_dir)}
    chosen = list(entries) if names is None else list(names)
    root = out_dir.rstrip("/")
    return {n: spark.read.schema(StructType.fromJson(entries[n]["fields"])).parquet(f"{root}/{entries[n]['folder']}") for n in chosen}


def verify_published(spark: SparkSession, out_dir: str) -> DataFrame:
    """``(name, n, whole)`` for each table of the newest set: rows now, and whether rows and checksum are those of the manifest."""
    tables, rows = read_published(spark, out_dir), []
    for entry in published(spark, out_dir):
        df = tables[entry["name"]]
        now = df.agg(F.count(F.lit(1)).alias("n"), _checksum(df).alias("checksum")).first()
        rows.append((entry["name"], now["n"], (now["n"], str(now["checksum"] or 0)) == (entry["n"], entry["checksum"])))
    return spark.createDataFrame(rows, "name string, n bigint, whole boolean")
