"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores. The model
queries run the full study: ten folds, 25 bagged trees, ten boosting rounds, 50
boosted trees, and K-Means for k = 2..10.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from pyspark.sql import functions as F  # noqa: E402

from foldwright.checks import queries as q  # noqa: E402
from foldwright.checks.inputs import labelled  # noqa: E402
from foldwright.operators import clustering, metrics  # noqa: E402
from foldwright.operators.folds import fold_assign, stage_folds  # noqa: E402
from foldwright.plans import study  # noqa: E402
from foldwright.session import local_session  # noqa: E402
from foldwright.staging import release, stage  # noqa: E402

TABLE_QUERIES = [
    "approval_by_age_group",
    "feature_table",
    "stage_counts",
    "value_counts_many",
    "describe_numeric",
    "corr_matrix",
    "group_mode_top_n",
    "boxplot_stats",
    "share_of_total",
    "top_n_with_others",
    "fold_assign",
    "bootstrap_sample",
    "vote_join",
    "majority_vote",
    "weighted_vote",
    "boost_rounds",
    "auc_roc",
    "fold_metrics",
    "model_comparison",
    "roc_curve",
    "prep_pipeline",
    "cross_validate",
    "nearest_center",
    "silhouette",
    "cluster_profile",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def learned(spark, folder):
    return labelled(spark, folder).withColumn("label", F.col("LEARNED_LABEL").cast("double"))


def cluster_table(ready, k: int):
    assigned = clustering.kmeans_fit(ready, k, 100).transform(ready).drop("features")
    return clustering.cluster_profile(stage(assigned, "clusters"), ["AGE_AT_APPLICATION", "APPLICANT_FAMILY_COUNT"], "label")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "foldwright-bench")
    registered = q.registered()
    drain(registered["approval_by_age_group"](spark, folder))  # start-up, not timed
    seconds: dict[str, float] = {}

    def timed(name: str, work):
        start = time.perf_counter()
        result = work()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    for name in TABLE_QUERIES:
        timed(name, lambda: drain(registered[name](spark, folder)))

    settings = study.Settings(label="label", parallelism=min(8, int(cores)) if cores != "*" else 8)
    ready, names = timed("prepare", lambda: study.prepare(stage(learned(spark, folder), "learned"), settings))
    narrow = ready.select("row_key", "label", "features")
    folded = timed("stage_folds", lambda: stage_folds(fold_assign(narrow, settings.k, settings.key)))
    models = {"cv_logistic": study.LOGISTIC, "cv_bagging": study.BAGGING, "cv_adaboost": study.ADABOOST}
    parts = {
        name: timed(name, lambda: study.cross_validated(folded, settings, [model])) for name, model in models.items()
    }
    together = None
    for part in parts.values():
        together = part if together is None else together.unionByName(part)
    timed("cv_metrics", lambda: drain(metrics.fold_metrics(together, ["model", "fold"])))
    timed("gbt_importance", lambda: study.importance_study(ready, names, settings)["feature_importance"].count())
    sweep = timed("kmeans_sweep", lambda: clustering.choose_k(ready, settings.ks))
    best = sweep.filter("chosen").first()["k"]
    timed("kmeans_profile", lambda: drain(cluster_table(ready, best)))
    release(spark)
    line = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
