"""The whole study: profile, cross-validated models, importances and clusters, as result tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.operators import clustering as clusters
from foldwright.operators import metrics as m
from foldwright.operators import profiling as prof
from foldwright.operators.bagging import bagging_predictor
from foldwright.operators.boosting import adaboost_predictor
from foldwright.operators.comparison import best_model, model_comparison
from foldwright.operators.fold_logistic import GRAM_SLOTS, adaboost_predictions, fold_adaboost, fold_logistic, logistic_predictions
from foldwright.operators.fold_prep import FoldPrep, fold_prep
from foldwright.operators.folds import SCORED, cross_validate, fold_assign, stage_folds
from foldwright.operators.importance import feature_importance
from foldwright.operators.learners import estimator_predictor, gbt_fit, logreg
from foldwright.operators.prep import feature_names, fit_prep
from foldwright.operators.quantiles import boxplot_outliers, boxplot_stats
from foldwright.plans.features import BUCKETED, CATEGORICAL, NUMERIC, feature_steps, feature_table
from foldwright.sources.applicants import APPROVED
from foldwright.sources.inspect import ObservedCounts, preview, schema_report
from foldwright.staging import by_key, stage

BAGGING, ADABOOST, LOGISTIC = "bagging", "adaboost", "logistic"
MODELS = [BAGGING, ADABOOST, LOGISTIC]
LABEL = "APPROVAL_LABEL"
PREVIEW_ROWS = 5


@dataclass(frozen=True)
class Settings:
    key: Sequence[str] = ("row_key",)
    label: str = LABEL
    k: int = 10
    num_models: int = 25
    rounds: int = 10
    gbt_iterations: int = 50
    gbt_depth: int = 5
    tree_depth: int = 5
    sample_fraction: float = 1.0
    bagging: str = "forest"  # or "separate": one fit for each bootstrap
    early_stop: bool = False  # ends boosting before a learner no better than chance
    fit_scope: str = "all"  # or "fold": preparation learns from the training part alone
    seed: int = 42
    ks: Sequence[int] = field(default_factory=lambda: list(range(2, 11)))
    parallelism: int = 1  # fits side by side; each keeps its own copy of the training rows
    part_rows: int = 100_000  # rows of a partition of a single fit over all rows


def profile_tables(table: DataFrame, label: str = LABEL) -> dict[str, DataFrame]:
    """Value counts of the label and the categories, numeric summary, and correlations."""
    counted = [label, *CATEGORICAL, *BUCKETED]
    return {
        "value_counts": prof.value_counts_many(table, counted),
        "numeric_summary": prof.describe_numeric(table, NUMERIC),
        "correlations": prof.corr_matrix(table, [*NUMERIC, label]),
    }


def cross_validated(
    folded: DataFrame,
    settings: Settings,
    models: Sequence[str] = tuple(MODELS),
    label: str = "label",
    prepare: FoldPrep | None = None,
) -> DataFrame:
    """Staged ``(model, fold, key, label, prediction, p1, score)`` of the named models.

    ``folded`` is a staged table with ``features``, ``label`` and ``fold``. The logistic fits of all folds,
    and those of all boosting rounds, share their passes; they standardize each training part by itself,
    so preparation of all rows tells them nothing of a test row. With ``prepare`` the bagged trees read
    rows prepared by the state of their training part, from the columns behind ``features``.
    """
    shared = len(folded.select("features").head()["features"]) <= GRAM_SLOTS
    bag = bagging_predictor(
        settings.num_models,
        label=label,
        sample_fraction=settings.sample_fraction,
        max_depth=settings.tree_depth,
        seed=settings.seed,
        strategy=settings.bagging,
        key=settings.key if settings.bagging == "separate" else None,
    )

    def fold_by_fold(predictor, state=None) -> DataFrame:
        rows = folded.drop("features") if state else folded
        return cross_validate(rows, predictor, settings.k, settings.key, state, parallelism=settings.parallelism, staged=True)

    def boosted() -> DataFrame:
        if shared:
            rounds = fold_adaboost(folded, settings.k, settings.rounds, settings.early_stop, label=label)
            return adaboost_predictions(folded, rounds, settings.key, label)
        return fold_by_fold(adaboost_predictor(rounds=settings.rounds, label=label, early_stop=settings.early_stop))

    def regressed() -> DataFrame:
        if shared:
            return logistic_predictions(folded, fold_logistic(folded, settings.k, label=label), settings.key, label)
        return fold_by_fold(estimator_predictor(logreg(label=label), label=label))

    runs = {BAGGING: lambda: fold_by_fold(bag, prepare), ADABOOST: boosted, LOGISTIC: regressed}
    parts = []
    for name in models:
        scored = runs[name]()
        parts.append(scored.select(F.lit(name).alias("model"), "fold", *settings.key, *SCORED))
    return stage(reduce(DataFrame.unionByName, parts), "predictions")


def model_study(prepared: DataFrame, settings: Settings = Settings()) -> dict[str, DataFrame]:
    """Cross-validate all models on prepared rows and compare them.

    The metrics of all models and folds come from one query over the staged predictions.
    """
    behind = [*NUMERIC, *CATEGORICAL] if settings.fit_scope == "fold" else []
    narrow = prepared.select(*settings.key, F.col(settings.label).cast("double").alias("label"), "features", *behind)
    folded = stage_folds(fold_assign(narrow, settings.k, settings.key))
    state = fold_prep(folded, settings.k, NUMERIC, CATEGORICAL) if behind else None
    predictions = cross_validated(folded, settings, prepare=state)
    metrics = stage(m.fold_metrics(predictions, ["model", "fold"]), "metrics")
    comparison = model_comparison(metrics, MODELS)
    return {
        "fold_scores": m.fold_series(metrics),
        "cv_summary": m.cv_summary(metrics),
        "fold_boxplots": boxplot_stats(metrics, ["model", "metric"], "value"),
        "fold_outliers": boxplot_outliers(metrics, ["model", "metric"], "value"),
        "confusion": m.confusion_matrix(predictions, ["model"]),
        "roc_curve": m.roc_curve(predictions, ["model"]),
        "comparison": comparison,
        "best_model": best_model(comparison),
    }


def importance_study(
    prepared: DataFrame, names: Sequence[str], settings: Settings = Settings()
) -> dict[str, DataFrame]:
    """Rank the features by boosted trees over all rows, and sum up all but the top five."""
    parts = -(-prepared.count() // settings.part_rows) or 1
    rows = by_key(prepared.select(*settings.key, settings.label, "features"), parts, settings.key)
    model = gbt_fit(rows, label=settings.label, max_iter=settings.gbt_iterations, max_depth=settings.gbt_depth, seed=settings.seed)
    ranking = feature_importance(model, names)
    return {
        "feature_importance": ranking,
        "importance_shares": prof.top_n_with_others(ranking, "feature", "importance", 5),
    }


def cluster_study(prepared: DataFrame, settings: Settings = Settings()) -> dict[str, DataFrame]:
    """Choose K by silhouette, cluster with it, and profile the clusters."""
    sweep = clusters.choose_k(prepared, settings.ks, settings.seed)
    best = sweep.filter("chosen").select("k").first()["k"]
    model = clusters.kmeans_fit(prepared, best, max_iter=100, seed=settings.seed)
    profiled = model.transform(prepared).select("cluster", settings.label, *NUMERIC[:2], *CATEGORICAL)
    assigned = stage(profiled, "clusters")
    return {
        "silhouettes": sweep,
        "cluster_shares": prof.share_of_total(assigned, "cluster"),
        "cluster_profile": clusters.cluster_profile(assigned, NUMERIC[:2], settings.label),
        "cluster_marital_status": prof.group_mode_top_n(assigned, ["cluster"], "MARITAL_STATUS"),
        "cluster_gender": prof.group_mode_top_n(assigned, ["cluster"], "GENDER_DESC"),
    }


def prepare(
    table: DataFrame, settings: Settings = Settings(), counts: ObservedCounts | None = None
) -> tuple[DataFrame, list[str]]:
    """Staged rows with ``features`` and the slot names; the columns in between are not written. ``counts`` observes the rows."""
    ready = fit_prep(table, NUMERIC, CATEGORICAL).transform(table)
    kept = ready.select(*dict.fromkeys([*settings.key, settings.label, *NUMERIC, *CATEGORICAL, "features"]))
    return stage(counts.rows(kept, "prepared") if counts else kept, "prepared"), feature_names(ready)


def run_study(raw: DataFrame, settings: Settings = Settings(), approved: str = APPROVED) -> dict[str, DataFrame]:
    """Every result table of the study from raw applications.

    The feature table and the prepared rows are each staged once and read by all
    that follows; the same writes count the rows of each step. Call ``staging.release``
    after the results are written.
    """
    counts = ObservedCounts()
    table = stage(feature_table(counts.steps(raw, feature_steps(raw)), approved), "features")
    prepared, names = prepare(table, settings, counts)
    return {
        "input_schema": schema_report(raw),
        "input_preview": preview(raw, PREVIEW_ROWS, list(settings.key)),
        "feature_schema": schema_report(table),
        "feature_preview": preview(table, PREVIEW_ROWS, list(settings.key)),
        "stage_counts": counts.table(raw.sparkSession),
        **profile_tables(table, settings.label),
        **model_study(prepared, settings),
        **importance_study(prepared, names, settings),
        **cluster_study(prepared, settings),
    }
