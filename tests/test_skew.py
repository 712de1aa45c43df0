"""One customer, order, group or score that holds a third of the rows."""

import pytest
from pyspark.sql import functions as F

from foldwright.operators import metrics, quantiles
from foldwright.operators.ordered import RANGE, cut_into_ranges
from foldwright.sources import applicants, table

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture()
def settings(spark):
    """Cluster-like decisions on small data: no broadcast, and small targets for partitions and skew."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def hot_dir(spark, tmp_path_factory):
    """The sample tables, with a third of the orders from one customer and a third of the lines in one order."""
    folder = str(tmp_path_factory.mktemp("hot"))
    orders, lines = table(spark, SF_DIR, "orders"), table(spark, SF_DIR, "lineitem")
    hot_customer = F.when(F.col("o_orderkey") % 3 == 0, 7).otherwise(F.col("o_custkey")).cast("bigint")
    hot_order = F.when(F.col("l_partkey") % 3 == 0, 11).otherwise(F.col("l_orderkey")).cast("bigint")
    # many files, as map outputs can only be split between map tasks
    orders.withColumn("o_custkey", hot_customer).repartition(8).write.parquet(f"{folder}/orders.parquet")
    lines.withColumn("l_orderkey", hot_order).repartition(8).write.parquet(f"{folder}/lineitem.parquet")
    table(spark, SF_DIR, "customer").write.parquet(f"{folder}/customer.parquet")
    return folder


def test_hot_customer_is_split_in_the_join(spark, hot_dir, settings):
    joined = applicants(spark, hot_dir)
    rows = joined.collect()
    assert len(rows) == table(spark, hot_dir, "orders").count()
    final = joined._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in final


def test_hot_order_is_counted_before_the_join(spark, hot_dir):
    counted = applicants(spark, hot_dir).filter("row_key = 11").first()["APPLICANT_FAMILY_COUNT"]
    assert counted == table(spark, hot_dir, "lineitem").filter("l_orderkey = 11").count() - 1


def test_ranges_are_even_despite_a_hot_group_and_a_hot_score(spark, many_ranges):
    ids = spark.range(60000)
    df = ids.select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        F.when(F.pmod(F.xxhash64("id"), F.lit(3)) == 0, 0.5).otherwise(F.pmod(F.xxhash64("id", "id"), F.lit(50000)) / 50000).alias("score"),
        (F.col("id") % 4 == 0).cast("int").alias("label"),
    )
    counted = df.groupBy("g", "score").agg(F.count("*").alias("n"))
    sizes = [r["count"] for r in cut_into_ranges(counted, ["g"], "score").groupBy(RANGE).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / len(sizes)
    assert metrics.auc_roc(df, ["g"]).count() == 8
    boxes = {r["g"]: r["n"] for r in quantiles.boxplot_stats(df, ["g"], "score").collect()}
    assert boxes["hot"] == 20000 and sum(boxes.values()) == 60000
