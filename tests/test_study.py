import pytest
from pyspark.sql import functions as F

from foldwright import staging
from foldwright.checks import queries as q
from foldwright.checks.inputs import labelled, prepared
from foldwright.operators import folds
from foldwright.plans import Settings, model_study, profile_tables, run_study
from foldwright.plans.features import feature_steps, feature_table
from foldwright.plans.study import importance_study
from foldwright.sources import applicants, read_results, sink_results, stage_counts

SMALL = Settings(k=3, num_models=3, rounds=2, gbt_iterations=3, ks=[2, 3], parallelism=3)


@pytest.fixture(scope="module")
def study(spark):
    return run_study(applicants(spark, "/root/testdata/sf0.001"), SMALL, approved="F")


def test_every_table_of_the_study(study, tmp_path, spark):
    out = str(tmp_path / "out")
    sink_results(study, out)
    back = read_results(spark, out, list(study))
    # Fold scores within the whiskers leave no outliers.
    assert all(df.count() > 0 for name, df in back.items() if name != "fold_outliers")
    assert back["input_preview"].count() == back["feature_preview"].count() == 5
    counts = {r["stage"]: r["n"] for r in back["stage_counts"].collect()}
    assert set(counts) == {"loaded", "complete", "valid_age", "prepared"} and counts["prepared"] == counts["valid_age"]
    rows = back["stage_counts"].filter("stage = 'valid_age'").first()["n"]
    assert back["confusion"].agg(F.sum("n")).first()[0] == 3 * rows
    assert back["comparison"].count() == 3 and back["best_model"].count() == 1
    assert back["fold_scores"].count() == 3 * 3 * 5
    assert back["cluster_profile"].agg(F.sum("n")).first()[0] == rows
    assert back["silhouettes"].filter("chosen").count() == 1
    assert back["feature_importance"].agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert back["importance_shares"].count() == 6
    assert back["correlations"].count() == 16


def test_model_study_reads_staged_tables_only(spark, sf_dir):
    from foldwright.operators.prep import fit_prep
    from foldwright.plans.features import CATEGORICAL, NUMERIC

    rows = staging.stage(labelled(spark, sf_dir), "rows")
    ready = fit_prep(rows, NUMERIC, CATEGORICAL).transform(rows)
    result = model_study(ready, Settings(label="LEARNED_LABEL", k=3, num_models=3, rounds=2))
    plan = result["comparison"]._jdf.queryExecution().executedPlan().toString()
    assert "metrics-" in plan and "Join" not in plan


def test_profile_is_one_pass_per_table(spark, sf_dir):
    table = labelled(spark, sf_dir)
    for df in profile_tables(table).values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("orders.parquet") == 1


LAZY = [
    "approval_by_age_group",
    "auc_roc",
    "boost_reweight",
    "corr_matrix",
    "cv_summary",
    "describe_numeric",
    "feature_table",
    "fold_assign",
    "group_mode_top_n",
    "label_join",
    "majority_vote",
    "roc_curve",
    "score_join",
    "share_of_total",
    "stage_counts",
    "top_n_with_others",
    "value_counts_many",
    "vote_join",
    "weighted_f1",
    "weighted_vote",
]


@pytest.mark.parametrize("name", LAZY)
def test_plans_have_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = q.registered()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    if name != "top_n_with_others":
        assert "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "BatchEval" not in plan


def test_rank_limit_is_pushed_below_the_shuffle(spark, sf_dir):
    plan = q.registered()["group_mode_top_n"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 5, Partial" in plan


def test_scans_read_only_what_they_need(spark, sf_dir):
    plan = q.registered()["approval_by_age_group"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "c_name" not in plan and "o_totalprice" not in plan and "l_comment" not in plan


def test_staged_tables_live_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    path = staging.new_path(spark, "x")
    assert path.startswith(named or staging.shared_dir(spark))


def test_a_fold_scan_lists_only_its_own_files(spark):
    df = spark.range(1000, numPartitions=4).withColumn("fold", (F.col("id") % 10).cast("int"))
    staged = folds.stage_folds(df)
    assert staged.columns == ["id", "fold"] and staged.count() == 1000
    plan = staged.filter("fold = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fold" in plan
    assert staged.filter("fold = 3").rdd.getNumPartitions() <= 4
    assert {"fold=3"} == {f.split("/")[-2] for f in staged.filter("fold = 3").select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}


def test_importances_do_not_depend_on_the_partitions(spark, sf_dir):
    rows = prepared(spark, sf_dir)
    settings = Settings(label="label", gbt_iterations=3)
    names = [f"s{i}" for i in range(13)]
    got = [
        sorted(map(tuple, importance_study(rows.repartition(n), names, settings)["feature_importance"].collect()))
        for n in (1, 5)
    ]
    assert got[0] == got[1]


def test_counts_of_text_dates(spark):
    """One unreadable date makes an inferred column text; the other rows count as before."""
    rows = [(40.0, 1, "S", "F", "2020-01-01", "2020-02-01", "1980-01-01", "F"), (40.0, 1, "S", "F", "no date", None, "1980-01-01", "F")]
    names = "AGE double, APPLICANT_FAMILY_COUNT int, MARITAL_STATUS string, GENDER_DESC string, APPLICATION_DATE string, APPROVED_DATE string, APPLICANT_BIRTH_DATE string, APPLICATION_STATUS_NAME string"
    raw = spark.createDataFrame(rows, names)
    counts = {r["stage"]: r["n"] for r in stage_counts(raw, feature_steps(raw)).collect()}
    assert counts == {"loaded": 2, "complete": 2, "valid_age": feature_table(raw).count()}


def test_null_rules_reach_the_scans_and_the_join(spark, sf_dir):
    plan = q.registered()["feature_table"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    pushed = " ".join(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "isnotnull(o_orderpriority" in pushed and "c_acctbal" in pushed
    assert "LeftOuter" not in plan
