"""Writing result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def sink_results(results: dict[str, DataFrame], out_dir: str) -> None:
    """Write each result as a parquet table ``out_dir/<name>``, replacing an older one."""
    for name, df in results.items():
        df.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{name}")


def read_results(spark: SparkSession, out_dir: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{out_dir.rstrip('/')}/{name}") for name in names}
