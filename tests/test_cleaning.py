import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from foldwright.functions import months_between_years
from foldwright.operators import cleaning
from foldwright.plans import clean, derive_features, feature_steps, feature_table
from foldwright.sources import (
    APPLICANT_SCHEMA,
    APPROVED,
    collect_scalar,
    row_count,
    scan_csv,
    stage_counts,
    to_local,
)

HEADER = (
    "REGION,APPLICATION_STATUS_NAME,AGE,APPLICANT_FAMILY_COUNT,MARITAL_STATUS,GENDER_DESC,"
    "APPLICATION_DATE,APPROVED_DATE,APPLICANT_BIRTH_DATE"
)
LINES = [
    f"north,{APPROVED},30,2,Married,Female,2020-03-01 00:00:00,2020-04-01 00:00:00,1990-03-01 00:00:00",
    "south,rejected,41,0,Single,Male,2020-02-28 10:00:00,,1980-02-29 00:00:00",
    ",,50,7,Married,Male,2021-05-05 00:00:00,,1950-05-06 00:00:00",
    f"east,{APPROVED},,3,Married,Male,2020-01-01 00:00:00,2020-01-05 00:00:00,1970-01-01 00:00:00",
    f"west,{APPROVED},17,1,Single,Female,2020-01-01 00:00:00,2019-12-31 00:00:00,2004-01-01 00:00:00",
    "west,rejected,abc,1,Single,Female,2020-01-01 00:00:00,,1990-01-01 00:00:00",
    "west,rejected,33,1,Single,Female,soon,,1990-01-01 00:00:00",
]


@pytest.fixture()
def csv(tmp_path):
    path = tmp_path / "applications.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n", encoding="utf-8")
    return str(path)


def test_csv_columns_are_found_by_name(spark, csv):
    df = scan_csv(spark, csv, APPLICANT_SCHEMA)
    types = dict(df.dtypes)
    assert types["AGE"] == "double" and types["APPLICATION_DATE"] == "timestamp" and types["REGION"] == "string"
    assert df.count() == len(LINES)
    assert df.filter(F.col("APPLICATION_STATUS_NAME") == APPROVED).count() == 3
    assert df.filter("AGE is null").count() == 2
    wider = StructType([*APPLICANT_SCHEMA.fields, StructField("MISSING", StringType())])
    with pytest.raises(ValueError, match="no column"):
        scan_csv(spark, csv, wider)


def test_csv_types_can_be_inferred(spark, csv):
    assert dict(scan_csv(spark, csv).dtypes)["APPLICANT_FAMILY_COUNT"] == "int"


def test_feature_rules(spark, csv):
    raw = scan_csv(spark, csv, APPLICANT_SCHEMA)
    derived = {r["APPLICANT_FAMILY_COUNT"]: r for r in derive_features(clean(raw)).collect()}
    assert derived[2]["AGE_AT_APPLICATION"] == 30 and derived[2]["APPROVAL_LABEL"] == 1
    assert derived[2]["PROCESSING_DAYS"] == 31 and derived[2]["AGE_GROUP"] == "Young Adult (25-34)"
    assert derived[0]["AGE_AT_APPLICATION"] == 39 and derived[0]["FAMILY_SIZE_CATEGORY"] == "No Dependents"
    # no status means not approved; the day before a birthday is the year before
    assert derived[7]["APPROVAL_LABEL"] == 0 and derived[7]["AGE_AT_APPLICATION"] == 70
    assert derived[7]["FAMILY_SIZE_CATEGORY"] == "Very Large (7+)"
    kept = feature_table(raw)
    assert sorted(r["APPLICANT_FAMILY_COUNT"] for r in kept.collect()) == [0, 2, 7]
    counts = {r["stage"]: r["n"] for r in stage_counts(raw, feature_steps(raw)).collect()}
    assert counts == {"loaded": 7, "complete": 5, "valid_age": 3}


def test_age_of_leap_day_and_future_births(spark):
    pairs = [
        ("2021-02-28", "2000-02-29", 21),
        ("2021-02-27", "2000-02-29", 20),
        ("2024-02-29", "2000-02-29", 24),
        ("2000-01-01", "2001-06-01", -2),
        ("2020-04-30", "2000-05-31", 19),
    ]
    df = spark.createDataFrame(pairs, "a string, b string, years long")
    got = df.select(months_between_years(F.to_date("a"), F.to_date("b")).alias("y"), "years").collect()
    assert [r["y"] for r in got] == [r["years"] for r in got]


def test_bad_dates_and_numbers(spark):
    df = spark.createDataFrame([("2020-01-02", 3.9), ("never", 1e12)], "d string, x double")
    assert [r["d"] for r in cleaning.cast_to_date(df, ["d"]).collect()] == [datetime.date(2020, 1, 2), None]
    assert [r["x"] for r in cleaning.cast_int(df, "x").collect()] == [3, None]
    with pytest.raises(Exception):
        cleaning.cast_to_date(df, ["d"], strict=True).collect()
    with pytest.raises(Exception):
        cleaning.cast_int(df, "x", strict=True).collect()


def test_missing_values_are_null_or_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "x double, s string")
    assert [r["s"] for r in cleaning.drop_null_subset(df, ["x"]).collect()] == ["a", None]
    assert cleaning.drop_null_subset(df, ["x", "s"]).exceptAll(df.dropna(subset=["x", "s"])).count() == 0
    assert cleaning.drop_null_subset(df, ["x", "s"]).count() == 1


def test_buckets_of_odd_values(spark):
    df = spark.createDataFrame([(-1,), (0,), (5,), (None,)], "n int")
    rules = [("==", 0, "none"), ("<=", 2, "few")]
    got = [r["b"] for r in cleaning.bucketize_case(df, "n", rules, "many", "b").collect()]
    assert got == ["few", "none", "many", "many"]
    with pytest.raises(ValueError):
        cleaning.bucketize_case(df, "n", [("~", 1, "x")], "y", "b")
    assert cleaning.filter_range(df, "n", 0, 10).count() == 2
    assert cleaning.filter_ne(df, "n", 0).count() == 2


def test_values_for_the_driver(spark):
    df = spark.range(20)
    assert collect_scalar(df.agg(F.sum("id"))) == 190
    with pytest.raises(ValueError):
        collect_scalar(df)
    with pytest.raises(ValueError):
        to_local(df, max_rows=19)
    assert len(to_local(df, max_rows=20)) == 20
    assert {r["stage"]: r["n"] for r in row_count({"a": df, "b": df.filter("id < 5")}).collect()} == {"a": 20, "b": 5}
