"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwright.checks.fold_queries import QUERIES as FOLD_QUERIES
from foldwright.checks.inputs import (
    APPROVED_STATUS,
    CENTERS,
    EIGHT_FLAGS,
    FIVE_FLAGS,
    LINE_KEY,
    QUANTITY_RULES,
    RULE_ALPHAS,
    RULE_MODELS,
    features,
    flagged,
    flags,
    labelled,
    prepared,
    price_votes,
    rounded,
    rule_lines,
    rule_metrics,
    rule_predictions,
    staged_features,
    vectors,
)
from foldwright.functions import (
    date_diff_days,
    exp_sigmoid,
    months_between_years,
    threshold_predict,
    to_prob_vec,
)
from foldwright.operators import bagging, boosting, cleaning, clustering, comparison, folds, learners, metrics, prep
from foldwright.operators import profiling as prof
from foldwright.operators import quantiles
from foldwright.operators.importance import feature_importance
from foldwright.plans import study
from foldwright.plans.features import (
    BUCKETED,
    CATEGORICAL,
    DATES,
    NUMERIC,
    REQUIRED,
    clean,
    derive_features,
    feature_steps,
)
from foldwright.plans.features import feature_table as features_of
from foldwright.sources import (
    APPLICANT_SCHEMA,
    ObservedCounts,
    applicants,
    collect_scalar,
    preview,
    publish_results,
    read_published,
    read_results,
    row_count,
    scan_csv,
    scan_report,
    schema_report,
    sink_results,
    stage_counts,
    table,
    to_local,
    verify_published,
)
from foldwright.staging import new_path, stage

Query = Callable[[SparkSession, str], DataFrame]
_registered: dict[str, Query] = {}


def registered() -> dict[str, Query]:
    return _registered | FOLD_QUERIES


def query_named(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        _registered[name] = function
        return function

    return register


def query(function: Query) -> Query:
    return query_named(function.__name__)(function)


# --- sources, sinks, actions -------------------------------------------------


@query_named("scan_csv")
def scan_csv_applicants(spark, d):
    path = new_path(spark, "csv")
    applicants(spark, d).write.option("header", True).csv(path)
    read = scan_csv(spark, path, APPLICANT_SCHEMA)
    return rounded(read.withColumn("row_key", F.col("row_key").cast("bigint")).withColumns({c: F.to_date(c) for c in DATES}))


def _whole_numbers(spark, d) -> str:
    """The applicants as text, with family counts written as whole numbers often are: 3.0, 3, ' 3', nothing, abc."""
    n = F.col("APPLICANT_FAMILY_COUNT").cast("string")
    key = F.col("row_key") % 5
    written = F.when(key == 0, F.concat(n, F.lit(".0"))).when(key == 1, n).when(key == 2, F.concat(F.lit(" "), n))
    path = new_path(spark, "csv")
    rows = applicants(spark, d).withColumn("APPLICANT_FAMILY_COUNT", written.when(key == 3, "").otherwise("abc"))
    rows.write.option("header", True).csv(path)
    return path


@query
def scan_csv_whole_numbers(spark, d):
    read = scan_csv(spark, _whole_numbers(spark, d), APPLICANT_SCHEMA)
    return read.select(F.col("row_key").cast("bigint").alias("row_key"), "APPLICANT_FAMILY_COUNT")


@query_named("scan_report")
def scan_report_applicants(spark, d):
    return scan_report(spark, _whole_numbers(spark, d), APPLICANT_SCHEMA).filter("column in ('APPLICANT_FAMILY_COUNT', 'MARITAL_STATUS')")


@query
def scan_parquet(spark, d):
    orders = table(spark, d, "orders")
    return rounded(orders.withColumn("o_orderdate", F.to_date("o_orderdate")))


@query_named("row_count")
def row_count_tables(spark, d):
    return row_count({name: table(spark, d, name) for name in ("orders", "customer", "lineitem")})


@query_named("stage_counts")
def row_count_stages(spark, d):
    raw = applicants(spark, d)
    return stage_counts(raw, feature_steps(raw))


@query_named("preview")
def preview_features(spark, d):
    shown = features(spark, d).select(
        "row_key", *NUMERIC[:1], "APPLICATION_YEAR", "PROCESSING_DAYS", "APPROVAL_LABEL", *BUCKETED
    )
    return preview(shown, 30, "row_key")


@query_named("schema_report")
def schema_report_orders(spark, d):
    return schema_report(table(spark, d, "orders"))


@query_named("collect_scalar")
def collect_scalar_total(spark, d):
    total = collect_scalar(table(spark, d, "lineitem").agg(F.sum("l_quantity")))
    return rounded(table(spark, d, "orders").agg(F.count("*").alias("n"), (F.lit(total) / F.count("*")).alias("per_order")))


@query_named("to_local")
def to_local_counts(spark, d):
    counts = to_local(features(spark, d).groupBy("AGE_GROUP").agg(F.count("*").alias("n")))
    return spark.createDataFrame(counts, "AGE_GROUP string, n bigint")


@query_named("sink_results")
def sink_results_tables(spark, d):
    out = new_path(spark, "results")
    orders = table(spark, d, "orders")
    sink_results({c: prof.value_counts(orders, c) for c in ("o_orderstatus", "o_orderpriority")}, out)
    back = read_results(spark, out, ["o_orderstatus", "o_orderpriority"])
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("result"), "value", "n") for name, df in back.items()])


@query
def published_results(spark, d):
    """A set of two tables, a set that fails half-way, and a rerun: readers have the first set, whole."""
    out = new_path(spark, "published")
    orders = table(spark, d, "orders")
    results = {c: prof.value_counts(orders, c) for c in ("o_orderstatus", "o_orderpriority")}
    first = publish_results(results, out)
    failing = {"o_orderstatus": results["o_orderstatus"], "o_orderpriority": orders.select(F.raise_error(F.lit("broken")).alias("value"))}
    try:
        publish_results(failing, out)
        raise AssertionError("a broken table was published")
    except PySparkException:
        pass
    again = publish_results(results, out)
    whole = verify_published(spark, out).select(F.col("name").alias("result"), F.col("whole"))
    back = read_published(spark, out)
    rows = reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("result"), "value", "n") for name, df in back.items()])
    return rows.join(F.broadcast(whole), "result").withColumn("same_set", F.lit(first == again))


@query
def observed_counts(spark, d):
    """Rows after each filter and after preparation, counted by the writes of these tables."""
    counts = ObservedCounts()
    raw = applicants(spark, d)
    rows = stage(features_of(counts.steps(raw, feature_steps(raw)), APPROVED_STATUS), "features")
    ready = prep.fit_prep(rows, NUMERIC, CATEGORICAL).transform(rows)
    stage(counts.rows(ready.select("row_key", "features"), "prepared"), "prepared")
    return counts.table(spark)


# --- cleaning, projection, filters -------------------------------------------


@query
def drop_null_subset(spark, d):
    kept = cleaning.drop_null_subset(applicants(spark, d), REQUIRED)
    return rounded(kept.select("row_key", *REQUIRED))


@query
def cast_to_date(spark, d):
    return cleaning.cast_to_date(applicants(spark, d), DATES).select("row_key", *DATES)


@query
def cast_int(spark, d):
    return cleaning.cast_int(applicants(spark, d), "AGE").select("row_key", "AGE")


@query
def cast_double_label(spark, d):
    return cleaning.cast_double_label(labelled(spark, d), "LEARNED_LABEL").select("row_key", "LEARNED_LABEL")


@query
def drop_column(spark, d):
    return cleaning.drop_column(table(spark, d, "customer"), "c_name").withColumn("c_acctbal", F.round("c_acctbal", 6))


@query
def project(spark, d):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    columns = {"order_key": "l_orderkey", "line_number": "l_linenumber", "part_key": "l_partkey", "net": net}
    return rounded(cleaning.project(table(spark, d, "lineitem"), columns), 4)


@query
def add_column(spark, d):
    year = F.year("o_orderdate")
    added = cleaning.add_column(table(spark, d, "orders"), {"o_year": year, "o_half": F.col("o_totalprice") / 2})
    return rounded(added.select("o_orderkey", "o_year", "o_half"))


@query
def filter_range(spark, d):
    aged = derive_features(clean(applicants(spark, d)), "F")
    return cleaning.filter_range(aged, "AGE_AT_APPLICATION", 18, 100).select("row_key", "AGE_AT_APPLICATION")


@query
def filter_eq(spark, d):
    return cleaning.filter_eq(table(spark, d, "orders"), "o_orderstatus", "F").select("o_orderkey", "o_orderstatus")


@query
def filter_ne(spark, d):
    return cleaning.filter_ne(table(spark, d, "orders"), "o_orderstatus", "F").select("o_orderkey", "o_orderstatus")


@query
def binary_label(spark, d):
    return cleaning.binary_label(applicants(spark, d), "APPLICATION_STATUS_NAME", "F", "APPROVAL_LABEL").select(
        "row_key", "APPROVAL_LABEL"
    )


@query
def bucketize_case(spark, d):
    return derive_features(clean(applicants(spark, d)), "F").select("row_key", *BUCKETED)


@query_named("threshold_predict")
def threshold_predict_lines(spark, d):
    lines = table(spark, d, "lineitem")
    return lines.select(*LINE_KEY, threshold_predict(F.col("l_discount") * 10).alias("prediction"))


@query
def feature_table(spark, d):
    return features(spark, d)


# --- scalar functions ----------------------------------------------------------


@query_named("months_between_years")
def months_between_years_all(spark, d):
    a = applicants(spark, d)
    years = months_between_years(F.to_date("APPLICATION_DATE"), F.col("APPLICANT_BIRTH_DATE"))
    return a.select("row_key", years.alias("years"))


@query
def year_of(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("o_year"))


@query_named("date_diff_days")
def date_diff_days_all(spark, d):
    a = applicants(spark, d)
    return a.select("row_key", date_diff_days(F.col("APPROVED_DATE"), F.col("APPLICATION_DATE")).alias("days"))


@query
def arith(spark, d):
    q, p, n = F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_linenumber")
    return rounded(
        table(spark, d, "lineitem").select(
            *LINE_KEY,
            (q + n).alias("plus"),
            (p - q).alias("minus"),
            (q * n).alias("times"),
            (p / q).alias("over"),
            (F.col("l_orderkey") % 7).alias("modulo"),
            (-q).alias("negated"),
            F.lit(1.5).alias("literal"),
        ),
        8,
    )


@query
def literal(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.lit(1.0).alias("one"), F.lit("x").alias("letter"))


@query_named("exp_sigmoid")
def exp_sigmoid_lines(spark, d):
    lines = table(spark, d, "lineitem")
    return rounded(lines.select(*LINE_KEY, exp_sigmoid(F.col("l_quantity") / 10 - 2.5).alias("p1")))


@query
def row_id(spark, d):
    ids = table(spark, d, "orders").select(F.monotonically_increasing_id().alias("row_id"))
    return ids.agg(F.count("*").alias("n"), F.count_distinct("row_id").alias("n_ids"))


@query_named("to_prob_vec")
def to_prob_vec_lines(spark, d):
    lines = table(spark, d, "lineitem").select(*LINE_KEY, to_prob_vec(F.col("l_discount")).alias("probability"))
    return rounded(prep.slot_columns(lines, "probability", ["p0", "p1"], LINE_KEY))


# --- joins -----------------------------------------------------------------------


@query
def vote_join(spark, d):
    return rounded(bagging.vote_join(price_votes(spark, d), ["o_orderkey"]))


@query
def label_join(spark, d):
    votes = bagging.vote_join(price_votes(spark, d), ["o_orderkey"])
    labels = cleaning.binary_label(table(spark, d, "orders"), "o_orderstatus", "F", "label").select("o_orderkey", "label")
    return rounded(bagging.label_join(votes, labels, ["o_orderkey"]))


@query
def vote_join_gaps(spark, d):
    """Tables that miss keys, repeat them, or have null keys: what every table has once is left."""
    tables = []
    for i, votes in enumerate(price_votes(spark, d)):
        key = F.col("o_orderkey")
        some = votes.filter(key % 11 != i)
        again = votes.filter(key % 13 == i)
        unknown = votes.filter(key % 17 == 0).withColumn("o_orderkey", F.lit(None).cast("bigint"))
        tables.append(some.union(again).union(unknown))
    return rounded(bagging.vote_join(tables, ["o_orderkey"]))


@query
def score_join(spark, d):
    labels = cleaning.binary_label(table(spark, d, "orders"), "o_orderstatus", "F", "label").select("o_orderkey", "label")
    frames = list(zip(price_votes(spark, d), RULE_ALPHAS))
    return rounded(boosting.score_join(labels, frames, ["o_orderkey"]))


# --- aggregation and profiling ---------------------------------------------------


@query
def value_counts(spark, d):
    return prof.value_counts(features(spark, d), "AGE_GROUP")


@query
def value_counts_many(spark, d):
    return prof.value_counts_many(features(spark, d), ["APPROVAL_LABEL", *CATEGORICAL, *BUCKETED])


@query
def describe_numeric(spark, d):
    return rounded(prof.describe_numeric(features(spark, d), NUMERIC))


@query
def corr_matrix(spark, d):
    return rounded(prof.corr_matrix(features(spark, d), [*NUMERIC, "APPROVAL_LABEL"]))


@query
def corr_matrix_with_nulls(spark, d):
    raw = applicants(spark, d).withColumn("CONSTANT", F.lit(1))
    return rounded(prof.corr_matrix(raw, ["AGE", "APPLICANT_FAMILY_COUNT", "CONSTANT"]))


@query
def sum_agg(spark, d):
    lines = table(spark, d, "lineitem")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return rounded(prof.sum_agg(lines, ["l_returnflag"], {"quantity": F.col("l_quantity"), "net": net}), 2)


@query
def avg_agg(spark, d):
    means = {"avg_age": F.col("AGE_AT_APPLICATION"), "avg_family": F.col("APPLICANT_FAMILY_COUNT")}
    return rounded(prof.avg_agg(features(spark, d), ["MARITAL_STATUS"], means))


@query
def group_rate(spark, d):
    return rounded(prof.group_rate(features(spark, d), ["AGE_GROUP"], "APPROVAL_LABEL"))


@query
def group_mode_top_n(spark, d):
    return prof.group_mode_top_n(table(spark, d, "lineitem"), ["l_returnflag"], "l_partkey", 5)


@query
def boxplot_stats(spark, d):
    lines = table(spark, d, "lineitem").withColumn("amount", F.col("l_quantity") * F.col("l_extendedprice"))
    return rounded(quantiles.boxplot_stats(lines, ["l_returnflag"], "amount", whis=1.0), 4)


@query
def boxplot_outliers(spark, d):
    lines = table(spark, d, "lineitem").withColumn("amount", F.col("l_quantity") * F.col("l_extendedprice"))
    return rounded(quantiles.boxplot_outliers(lines, ["l_returnflag"], "amount", whis=1.0), 4)


@query
def share_of_total(spark, d):
    return rounded(prof.share_of_total(table(spark, d, "orders"), "o_orderpriority", "o_totalprice"), 2)


@query
def top_n_with_others(spark, d):
    return rounded(prof.top_n_with_others(table(spark, d, "orders"), "o_custkey", "o_totalprice", 5), 2)


# --- folds, metrics, comparison --------------------------------------------------


@query
def fold_assign(spark, d):
    return folds.fold_assign(table(spark, d, "orders"), 10, "o_orderkey").select("o_orderkey", "fold")


@query
def fold_split(spark, d):
    parts = folds.fold_split(folds.fold_assign(table(spark, d, "orders"), 10, "o_orderkey"), 3)
    sides = [p.agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("amount")) for p in parts]
    return rounded(
        sides[0].withColumn("part", F.lit("train")).unionByName(sides[1].withColumn("part", F.lit("test"))), 2
    )


def _rate_predictor(train: DataFrame, test: DataFrame) -> DataFrame:
    """The training share of label 1 in the row's own group; one half for an unseen group."""
    group = ["MARITAL_STATUS", "AGE_GROUP"]
    rates = stage(train.groupBy(*group).agg(F.avg("label").alias("rate")), "rates")
    p1 = F.coalesce("rate", F.lit(0.5))
    joined = test.join(rates, group, "left")
    return joined.withColumns({"p1": p1, "score": p1, "prediction": threshold_predict(p1)})


@query
def cross_validate(spark, d):
    rows = labelled(spark, d).select("row_key", "MARITAL_STATUS", "AGE_GROUP", F.col("LEARNED_LABEL").alias("label"))
    folded = folds.fold_assign(rows, 10, "row_key")
    scored = folds.cross_validate(folded, _rate_predictor, 10, ["row_key"])
    return rounded(scored.select("fold", "row_key", "label", "prediction", "p1"))


@query
def auc_roc(spark, d):
    return rounded(metrics.auc_roc(rule_predictions(spark, d), ["model", "fold"]))


@query
def accuracy(spark, d):
    return rounded(metrics.accuracy(rule_predictions(spark, d), ["model", "fold"]))


@query
def weighted_precision(spark, d):
    return rounded(metrics.weighted_precision(rule_predictions(spark, d), ["model", "fold"]))


@query
def weighted_recall(spark, d):
    return rounded(metrics.weighted_recall(rule_predictions(spark, d), ["model", "fold"]))


@query
def weighted_f1(spark, d):
    return rounded(metrics.weighted_f1(rule_predictions(spark, d), ["model", "fold"]))


@query
def fold_metrics(spark, d):
    return rounded(rule_metrics(spark, d))


@query
def metrics_null_labels(spark, d):
    """Rows without a label, some of them without a prediction too, count in no metric."""
    part = F.col("l_orderkey") % 7
    preds = rule_predictions(spark, d).withColumns(
        {"label": F.when(part > 1, F.col("label")), "prediction": F.when(part != 0, F.col("prediction"))}
    )
    return rounded(metrics.fold_metrics(preds, ["model", "fold"], ["accuracy", "auc", "weighted_recall"]))


@query
def cv_summary(spark, d):
    return rounded(metrics.cv_summary(rule_metrics(spark, d)))


@query
def fold_series(spark, d):
    return rounded(metrics.fold_series(rule_metrics(spark, d)))


@query
def model_comparison(spark, d):
    return rounded(comparison.model_comparison(rule_metrics(spark, d), RULE_MODELS))


@query
def best_model(spark, d):
    return rounded(comparison.best_model(comparison.model_comparison(rule_metrics(spark, d), RULE_MODELS)))


@query
def confusion_matrix(spark, d):
    return metrics.confusion_matrix(rule_predictions(spark, d), ["model", "fold"])


@query
def roc_curve(spark, d):
    return rounded(metrics.roc_curve(rule_predictions(spark, d), ["model"]))


# --- feature preparation -----------------------------------------------------------


@query
def string_index(spark, d):
    indexed = prep.string_index(staged_features(spark, d), CATEGORICAL)
    return indexed.select("row_key", *[f"{c}_IDX" for c in CATEGORICAL])


@query
def string_index_wide(spark, d):
    """A column of very many values: every part of the order lines."""
    lines = table(spark, d, "lineitem").select(*LINE_KEY, F.col("l_partkey").alias("part"))
    return prep.string_index(lines, ["part"]).select(*LINE_KEY, F.col("part_IDX").cast("bigint").alias("part_index"))


@query
def one_hot(spark, d):
    encoded = prep.one_hot(prep.index_slots(staged_features(spark, d), CATEGORICAL[:1]), CATEGORICAL[:1])
    return prep.slot_columns(encoded, "MARITAL_STATUS_VEC", [f"m{i}" for i in range(5)], ["row_key"])


def _slots(n: int) -> list[str]:
    return [f"f{i:02d}" for i in range(n)]


def _assembled(spark, d) -> DataFrame:
    encoded = prep.one_hot(prep.index_slots(staged_features(spark, d), CATEGORICAL), CATEGORICAL)
    return prep.assemble(encoded, [*NUMERIC, *[f"{c}_VEC" for c in CATEGORICAL]], "features_unscaled")


@query
def assemble(spark, d):
    assembled = _assembled(spark, d)
    names = prep.feature_names(assembled)
    return rounded(prep.slot_columns(assembled, "features_unscaled", _slots(len(names)), ["row_key"]))


@query
def standardize(spark, d):
    assembled = _assembled(spark, d)
    names = prep.feature_names(assembled)
    scaled = prep.standardize(assembled, "features_unscaled", "features")
    return rounded(prep.slot_columns(scaled, "features", _slots(len(names)), ["row_key"]))


@query
def prep_pipeline(spark, d):
    rows = staged_features(spark, d)
    ready = prep.fit_prep(rows, NUMERIC, CATEGORICAL).transform(rows)
    names = prep.feature_names(ready)
    return rounded(prep.slot_columns(ready, "features", _slots(len(names)), ["row_key"]))


@query
def feature_names(spark, d):
    names = prep.feature_names(_assembled(spark, d))
    return spark.createDataFrame(list(enumerate(names)), "slot int, name string")


# --- models and ensembles ------------------------------------------------------------


@query
def bootstrap_sample(spark, d):
    return bagging.bootstrap_sample(table(spark, d, "orders"), "o_orderkey", 3).select("o_orderkey", "w")


def _by_flag(scored: DataFrame) -> DataFrame:
    return scored.groupBy("flag", "prediction").agg(F.count("*").alias("n"))


@query
def tree_fit(spark, d):
    rows = flagged(spark, d)
    return _by_flag(learners.tree_fit(rows, max_depth=1).transform(rows))


@query
def tree_fit_five_flags(spark, d):
    """A tree of full depth over five 0/1 slots: every cell of the flags gets its majority."""
    rows = flags(spark, d, FIVE_FLAGS, "LEARNED_LABEL")
    scored = learners.tree_fit(rows, max_depth=5).transform(rows)
    return scored.groupBy(*FIVE_FLAGS, "prediction").agg(F.count("*").alias("n"))


@query
def bagging_fit_bootstraps(spark, d):
    """25 trees, each fitted on its own bootstrap: which of eight slots each splits, and how each side votes."""
    rows = flags(spark, d, EIGHT_FLAGS, "row_key % 2 = 0")
    trees = bagging.bagging_fit(rows, 25, max_depth=1, strategy="separate", key="row_key")
    voted, votes = bagging.cast_votes(rows, trees)
    voted = bagging.majority_vote(voted, votes)
    return rounded(voted.groupBy(*EIGHT_FLAGS, "p1", "prediction").agg(F.count("*").alias("n")))


@query
def bagging_fit(spark, d):
    rows = flagged(spark, d)
    voted, votes = bagging.cast_votes(rows, bagging.bagging_fit(rows, 25, max_depth=1))
    return _by_flag(bagging.majority_vote(voted, votes))


@query
def bagging_fit_separate(spark, d):
    rows = flagged(spark, d)
    trees = bagging.bagging_fit(rows, 25, max_depth=1, strategy="separate", key="row_key")
    voted, votes = bagging.cast_votes(rows, trees)
    return _by_flag(bagging.majority_vote(voted, votes))


@query
def majority_vote(spark, d):
    names = [f"v{i}" for i in range(len(QUANTITY_RULES))]
    voted = bagging.majority_vote(rule_lines(spark, d), names, vector=True)
    p0 = F.get(vector_to_array("probability"), F.lit(0))
    return rounded(voted.select(*LINE_KEY, "label", "p1", "prediction", p0.alias("p0")))


def _fitted_shares(model, rows: DataFrame) -> DataFrame:
    p1 = F.get(vector_to_array("probability"), F.lit(1))
    return rounded(model.transform(rows).groupBy("flag").agg(F.count("*").alias("n"), F.avg(p1).alias("p1")), 3)


@query
def logreg_fit(spark, d):
    rows = flagged(spark, d)
    return _fitted_shares(learners.logreg_fit(rows, reg=0.0), rows)


@query
def weak_learner_fit(spark, d):
    rows = flagged(spark, d).withColumn("w", F.col("label") + 1.0)
    return _fitted_shares(learners.weak_learner_fit(rows), rows)


def _rule_misses(spark, d) -> DataFrame:
    return rule_lines(spark, d).withColumn("w", F.lit(1.0) / F.lit(table(spark, d, "lineitem").count()))


@query
def weighted_error(spark, d):
    weighted = _rule_misses(spark, d)
    rows = [
        boosting.weighted_error(weighted, prediction=f"v{i}").select(F.lit(t).alias("rule"), "err", "total")
        for i, t in enumerate(QUANTITY_RULES)
    ]
    return rounded(reduce(DataFrame.unionByName, rows))


@query
def boost_alpha(spark, d):
    lines = rule_lines(spark, d)
    shares = lines.agg(*[F.avg(boosting.missed(prediction=f"v{i}")).alias(f"v{i}") for i in range(len(QUANTITY_RULES))])
    errors = shares.first()
    rows = [(t, errors[f"v{i}"], boosting.boost_alpha(errors[f"v{i}"])) for i, t in enumerate(QUANTITY_RULES)]
    return rounded(spark.createDataFrame(rows, "rule int, err double, alpha double"))


@query
def boost_reweight(spark, d):
    weighted = _rule_misses(spark, d)
    row = boosting.weighted_error(weighted, prediction="v2").first()
    alpha = boosting.boost_alpha(row["err"])
    updated = boosting.boost_reweight(weighted, alpha, row["err"], row["total"], prediction="v2")
    relative = F.col("w") * F.lit(float(weighted.count()))
    return rounded(updated.select(*LINE_KEY, relative.alias("relative_weight")))


@query
def boost_rounds(spark, d):
    """Boosting with the quantity rules as learners, one per round."""
    rounds = boosting.boost(
        rule_lines(spark, d),
        fit=lambda weighted, t: f"v{t}",
        predict=lambda rule, df: df.withColumn("prediction", F.col(rule)),
        rounds=len(QUANTITY_RULES),
    )
    return rounded(_rounds_table(spark, rounds))


def _rounds_table(spark, rounds) -> DataFrame:
    rows = [(t, r.err, r.alpha) for t, r in enumerate(rounds)]
    return spark.createDataFrame(rows, "round int, err double, alpha double")


@query
def adaboost_fit(spark, d):
    """Boosting with one slot per age group: each learner predicts every group's weighted majority."""
    rows = labelled(spark, d).select("AGE_GROUP", F.col("LEARNED_LABEL").alias("label"))
    grouped = prep.one_hot(prep.index_slots(stage(rows, "groups"), ["AGE_GROUP"]), ["AGE_GROUP"])
    return rounded(_rounds_table(spark, boosting.adaboost_fit(grouped, rounds=3, features="AGE_GROUP_VEC")))


@query
def adaboost_fit_prepared(spark, d):
    return rounded(_rounds_table(spark, boosting.adaboost_fit(prepared(spark, d), rounds=10)))


@query
def adaboost_first_round(spark, d):
    rows = flagged(spark, d)
    voted, votes = boosting.adaboost_votes(rows, boosting.adaboost_fit(rows, rounds=1))
    scored = boosting.weighted_vote(voted, votes)
    return rounded(scored.groupBy("flag", "prediction", "p1").agg(F.count("*").alias("n")))


@query
def weighted_vote(spark, d):
    votes = [(f"v{i}", a) for i, a in enumerate(RULE_ALPHAS)]
    return rounded(boosting.weighted_vote(rule_lines(spark, d), votes).select(*LINE_KEY, "margin", "p1", "prediction"))


@query
def gbt_fit(spark, d):
    rows = flagged(spark, d)
    return _by_flag(learners.gbt_fit(rows, max_iter=5, max_depth=1).transform(rows))


@query_named("feature_importance")
def feature_importances(spark, d):
    rows = prepared(spark, d)
    model = learners.gbt_fit(rows, max_iter=50)
    return rounded(feature_importance(model, prep.feature_names(rows)))


@query
def feature_importance_by_flag(spark, d):
    """One split over two 0/1 features: all importance goes to the one that splits better."""
    rows = labelled(spark, d).select(
        F.col("LEARNED_LABEL").alias("label"),
        (F.col("AGE_AT_APPLICATION") > 35).cast("double").alias("older"),
        (F.col("APPLICANT_FAMILY_COUNT") > 3).cast("double").alias("large_family"),
    )
    names = ["large_family", "older"]
    points = stage(prep.assemble(rows, names, "features"), "points")
    return rounded(feature_importance(learners.gbt_fit(points, max_iter=1, max_depth=1), names))


def _study(models, **changes) -> Query:
    def run(spark, d):
        settings = study.Settings(label="label", **changes)
        narrow = prepared(spark, d).select("row_key", "label", "features")
        folded = folds.stage_folds(folds.fold_assign(narrow, settings.k, "row_key"))
        predictions = study.cross_validated(folded, settings, models)
        return rounded(metrics.fold_metrics(predictions, ["model", "fold"]))

    return run


_registered["cross_validate_logistic"] = _study([study.LOGISTIC])
_registered["cross_validate_bagging"] = _study([study.BAGGING])
_registered["cross_validate_adaboost"] = _study([study.ADABOOST])


def _by_fold_and_flag(spark, d, fit_predict, k: int = 5) -> DataFrame:
    """Cross-validate a learner on the one 0/1 feature and sum up each fold's predictions."""
    folded = folds.fold_assign(flagged(spark, d), k, "row_key")
    scored = folds.cross_validate(folded, fit_predict, k, ["flag"], parallelism=4)
    sums = scored.groupBy("fold", "flag", "prediction").agg(F.count("*").alias("n"), F.avg("p1").alias("p1"))
    return rounded(sums, 3)


@query
def cross_validate_logistic_by_flag(spark, d):
    return _by_fold_and_flag(spark, d, learners.estimator_predictor(learners.logreg(reg=0.0)))


@query
def cross_validate_bagging_by_flag(spark, d):
    return _by_fold_and_flag(spark, d, bagging.bagging_predictor(5, max_depth=1))


@query
def cross_validate_adaboost_by_flag(spark, d):
    return _by_fold_and_flag(spark, d, boosting.adaboost_predictor(rounds=1))


@query
def cross_validate_fold_scope_by_flag(spark, d):
    """Scaling fitted on each training part; it does not move an unregularized fit."""
    folded = folds.fold_assign(flagged(spark, d).drop("features"), 5, "row_key")
    learner = learners.estimator_predictor(learners.logreg(reg=0.0))
    scaling = prep.prep_pipeline(["flag"], [])
    scored = folds.cross_validate(folded, learner, 5, ["flag"], scaling, fit_scope="fold", parallelism=4)
    sums = scored.groupBy("fold", "flag", "prediction").agg(F.count("*").alias("n"), F.avg("p1").alias("p1"))
    return rounded(sums, 3)


@query
def cross_validate_fold_scope(spark, d):
    """Preparation fitted on each training part only."""
    rows = labelled(spark, d).select("row_key", F.col("LEARNED_LABEL").cast("double").alias("label"), *NUMERIC, *CATEGORICAL)
    folded = folds.fold_assign(rows, 10, "row_key")
    scored = folds.cross_validate(
        folded,
        learners.estimator_predictor(learners.logreg()),
        10,
        ["row_key"],
        prepare=prep.prep_pipeline(NUMERIC, CATEGORICAL),
        fit_scope="fold",
    )
    return rounded(metrics.fold_metrics(stage(scored, "predictions"), ["fold"]))


# --- clustering ----------------------------------------------------------------------


@query
def kmeans_fit(spark, d):
    """Two clusters of a 0/1 feature: the centers are its values."""
    rows = flagged(spark, d)
    model = clustering.kmeans_fit(rows, 2)
    centers = F.array(*[F.lit(float(c[0])) for c in model.clusterCenters()])
    placed = model.transform(rows).withColumn("center", F.get(centers, F.col("cluster")))
    return placed.groupBy("flag", "center").agg(F.count("*").alias("n"))


@query
def kmeans_fit_prepared(spark, d):
    rows = prepared(spark, d)
    return clustering.cluster_sizes(clustering.kmeans_fit(rows, 4, 50).transform(rows))


def _label_means(points: DataFrame) -> list[list[float]]:
    """The mean vector of each cluster, one row per cluster."""
    means = points.groupBy("cluster").agg(Summarizer.mean(array_to_vector("features")).alias("mean"))
    return [row["mean"].toArray().tolist() for row in means.orderBy("cluster").collect()]


@query
def nearest_center(spark, d):
    points = vectors(spark, d)
    assigned = clustering.nearest_center(points, _label_means(points), "features", "nearest")
    return assigned.select("vec_id", "nearest")


@query
def silhouette(spark, d):
    points = stage(vectors(spark, d), "vectors")
    score = clustering.silhouette(points)
    return rounded(points.agg(F.count("*").alias("n"), F.lit(score).alias("silhouette")))


@query
def choose_k(spark, d):
    return rounded(clustering.choose_k(prepared(spark, d)))


def _profiled(spark, d) -> DataFrame:
    rows = features(spark, d)
    point = F.array(F.col("AGE_AT_APPLICATION").cast("double"), F.col("APPLICANT_FAMILY_COUNT").cast("double"))
    return clustering.nearest_center(rows.withColumn("point", point), CENTERS, "point")


@query
def nearest_center_nulls(spark, d):
    """Points without a value, or with a null in it, are near no center."""
    point = F.array((F.col("o_totalprice") / 1000.0), F.when(F.col("o_orderkey") % 3 != 0, F.lit(1.0)))
    rows = table(spark, d, "orders").withColumn("point", F.when(F.col("o_orderkey") % 5 != 0, point))
    return clustering.nearest_center(rows, [[0.0, 1.0], [100.0, 1.0], [200.0, 1.0]], "point").select("o_orderkey", "cluster")


@query
def cluster_sizes(spark, d):
    return clustering.cluster_sizes(_profiled(spark, d))


@query
def cluster_profile(spark, d):
    return rounded(clustering.cluster_profile(_profiled(spark, d), NUMERIC[:2], "APPROVAL_LABEL"))


@query
def cluster_modes(spark, d):
    return prof.group_mode_top_n(_profiled(spark, d), ["cluster"], "MARITAL_STATUS")


@query
def approval_by_age_group(spark, d):
    """The flagship: cleaned and derived applicants, rate of approval by age group."""
    grouped = features(spark, d).groupBy("AGE_GROUP")
    return rounded(
        grouped.agg(
            F.count("*").alias("n"),
            F.avg("AGE_AT_APPLICATION").alias("avg_age"),
            (F.avg("APPROVAL_LABEL") * 100).alias("approval_rate"),
        ).orderBy("AGE_GROUP")
    )
