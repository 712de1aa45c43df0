"""Result sets appear whole or not at all; counts come from the writes themselves."""

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from foldwright.sources import ObservedCounts, publish_results, published, read_published, to_local, verify_published
from foldwright.sources import published as published_entries
from foldwright.staging import stage


def tables(spark, n):
    rows = spark.range(n, numPartitions=3)
    return {
        "plain": rows.withColumn("text", F.concat(F.lit("t"), F.col("id"))),
        "odd": rows.select(F.create_map("id", F.lit("x")).alias("m"), array_to_vector(F.array(F.col("id").cast("double"))).alias("v")),
        "empty": rows.filter("id < 0"),
    }


def broken(spark):
    return spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).alias("x"))


def folders(tmp_path):
    return sorted(p.name for p in (tmp_path / "sets").iterdir())


def test_a_set_is_read_as_it_was_published(spark, tmp_path):
    out = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        published(spark, out)
    assert publish_results(tables(spark, 10), out) == 1
    back = read_published(spark, out)
    assert {n: df.count() for n, df in back.items()} == {"plain": 10, "odd": 10, "empty": 0}
    assert back["odd"].dtypes == tables(spark, 1)["odd"].dtypes
    assert all(r["whole"] for r in verify_published(spark, out).collect())
    assert list(read_published(spark, out, ["plain"])) == ["plain"]


def test_a_failing_table_leaves_the_older_set(spark, tmp_path):
    out = str(tmp_path)
    publish_results(tables(spark, 10), out)
    before, kept = published(spark, out), folders(tmp_path)
    with pytest.raises(PySparkException):
        publish_results({**tables(spark, 20), "broken": broken(spark)}, out)
    assert published(spark, out) == before and folders(tmp_path) == kept
    assert read_published(spark, out)["plain"].count() == 10


def test_a_rerun_publishes_nothing_new(spark, tmp_path):
    out = str(tmp_path)
    publish_results(tables(spark, 10), out)
    kept = folders(tmp_path)
    shuffled = {n: df.repartition(5) for n, df in tables(spark, 10).items()}
    assert publish_results(shuffled, out) == 1 and folders(tmp_path) == kept
    # One row twice and another missing is another set.
    other = tables(spark, 10) | {"plain": tables(spark, 10)["plain"].filter("id <> 3").unionByName(tables(spark, 10)["plain"].filter("id = 4"))}
    assert publish_results(other, out) == 2


def test_old_sets_go(spark, tmp_path):
    out = str(tmp_path)
    for n in (1, 2, 3, 4):
        assert publish_results({"plain": tables(spark, n)["plain"]}, out, keep=2) == n
        assert len([f for f in folders(tmp_path) if not f.endswith(".crc")]) == min(n, 2)
    assert read_published(spark, out)["plain"].count() == 4


def test_a_damaged_table_is_told(spark, tmp_path):
    out = str(tmp_path)
    publish_results({"plain": tables(spark, 10)["plain"], "empty": tables(spark, 1)["empty"]}, out)
    entry = next(e for e in published_entries(spark, out) if e["name"] == "plain")
    spark.range(2).withColumn("text", F.lit("more")).write.mode("append").parquet(f"{out}/{entry['folder']}")
    assert {r["name"]: r["whole"] for r in verify_published(spark, out).collect()} == {"plain": False, "empty": True}


def test_counts_of_a_write(spark):
    counts = ObservedCounts()
    rows = spark.range(1000, numPartitions=7)
    kept = counts.steps(rows, {"all": F.lit(True), "even": F.col("id") % 2 == 0, "late": F.col("id") > 500}).filter("id % 2 = 0 and id > 500")
    staged = stage(counts.rows(kept, "written"), "counted")
    assert staged.count() == 249
    got = [tuple(r) for r in counts.table(spark).collect()]
    assert got == [("all", 1000), ("even", 500), ("late", 249), ("written", 249)]
    # Reading the table again does not count again.
    staged.count()
    assert [tuple(r) for r in counts.table(spark).collect()] == got


def test_the_caller_names_the_bound(spark):
    assert len(to_local(spark.range(20_000))) == 20_000
    with pytest.raises(ValueError):
        to_local(spark.range(5), max_rows=4)
