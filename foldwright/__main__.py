"""``python -m foldwright --input applications.csv --out results``: the whole study as parquet tables."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from foldwright.plans.study import Settings, run_study
from foldwright.sources import APPLICANT_SCHEMA, APPROVED, publish_results, scan_csv, scan_report
from foldwright.staging import release, stage


def main() -> None:
    parser = argparse.ArgumentParser(prog="foldwright", description=__doc__)
    parser.add_argument("--input", required=True, help="CSV with a header")
    parser.add_argument("--out", required=True, help="folder for the result sets")
    parser.add_argument("--key", nargs="*", default=[], help="columns that identify a row")
    parser.add_argument("--approved", default=APPROVED, help="status text that means approved")
    parser.add_argument("--infer-schema", action="store_true", help="infer types instead of using the declared ones")
    parser.add_argument("--folds", type=int, default=10)
    parser.add_argument("--parallelism", type=int, default=1, help="model fits that run side by side")
    parser.add_argument("--fit-scope", choices=["all", "fold"], default="all", help="what preparation learns from")
    parser.add_argument("--bagging", choices=["forest", "separate"], default="forest", help="one fit for all trees, or one for each bootstrap")
    parser.add_argument("--tree-depth", type=int, default=5, help="of the bagged trees")
    parser.add_argument("--early-stop", action="store_true", help="end boosting before a learner no better than chance")
    parser.add_argument("--seed", type=int, default=42)
    args = parser.parse_args()

    spark = SparkSession.builder.appName("foldwright").getOrCreate()
    raw = scan_csv(spark, args.input, None if args.infer_schema else APPLICANT_SCHEMA)
    key = tuple(args.key)
    if not key:
        # Without a key the rows are numbered once; staging fixes the numbers.
        raw = stage(raw.withColumn("row_key", F.monotonically_increasing_id()), "numbered")
        key = ("row_key",)
    settings = Settings(
        key=key,
        k=args.folds,
        parallelism=args.parallelism,
        fit_scope=args.fit_scope,
        bagging=args.bagging,
        tree_depth=args.tree_depth,
        early_stop=args.early_stop,
        seed=args.seed,
    )
    try:
        results = run_study(raw, settings, args.approved)
        if not args.infer_schema:
            results["scan_report"] = scan_report(spark, args.input, APPLICANT_SCHEMA)
        publish_results(results, args.out)
    finally:
        release(spark)
        spark.stop()


if __name__ == "__main__":
    main()
