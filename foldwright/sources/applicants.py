"""The applicants table: its schema, and a view of the same shape over the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwright.sources.scans import table

# Fixed value: the status text that means "approved" in the source data.
APPROVED = "موافقة"

APPLICANT_SCHEMA = T.StructType(
    [
        T.StructField("AGE", T.DoubleType()),
        T.StructField("APPLICANT_FAMILY_COUNT", T.LongType()),
        T.StructField("MARITAL_STATUS", T.StringType()),
        T.StructField("GENDER_DESC", T.StringType()),
        T.StructField("APPLICATION_DATE", T.TimestampType()),
        T.StructField("APPROVED_DATE", T.TimestampType()),
        T.StructField("APPLICANT_BIRTH_DATE", T.TimestampType()),
        T.StructField("APPLICATION_STATUS_NAME", T.StringType()),
    ]
)


def applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, shaped like an application.

    The status ``'F'`` takes the place of the approved status. A customer with a
    negative balance has no age, and an order without lines has no family count.

    No join hint: the customer side is broadcast when its size allows, and a
    customer with very many orders is split by the adaptive skew join. The lines
    are counted before they are joined, and that aggregate's partitioning by order
    is the one the second join needs.
    """
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg((F.count("*") - 1).alias("family"), F.max("l_shipdate").alias("shipped"))
    )
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
        .join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        .select(
            F.col("o_orderkey").alias("row_key"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("AGE"),
            F.col("family").alias("APPLICANT_FAMILY_COUNT"),
            F.col("c_mktsegment").alias("MARITAL_STATUS"),
            F.col("o_orderpriority").alias("GENDER_DESC"),
            F.col("o_orderdate").alias("APPLICATION_DATE"),
            F.when(F.col("o_orderstatus") == "F", F.col("shipped")).alias("APPROVED_DATE"),
            F.date_sub(F.lit("1985-01-01").cast("date"), ((F.col("o_custkey") * 7919) % 40000).cast("int")).alias(
                "APPLICANT_BIRTH_DATE"
            ),
            F.col("o_orderstatus").alias("APPLICATION_STATUS_NAME"),
        )
    )
