"""Inputs that the registered queries share."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from foldwright.functions.scores import exp_sigmoid, positive_share, threshold_predict
from foldwright.operators.folds import fold_assign
from foldwright.operators.metrics import fold_metrics
from foldwright.operators.prep import fit_prep
from foldwright.plans.features import CATEGORICAL, NUMERIC, feature_table
from foldwright.sources.applicants import applicants
from foldwright.sources.scans import table
from foldwright.staging import stage

# The sample tables stand in for applications, and order status F for the approved status.
APPROVED_STATUS = "F"
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
QUANTITY_RULES = [5, 15, 25, 35, 45]
PRICE_RULES = [100000, 200000, 300000]
RULE_ALPHAS = [-0.25, 0.1, 0.3, 0.2, -0.05]
RULE_MODELS = ["vote", "weighted", "price"]
CENTERS = [[25.0, 1.0], [40.0, 3.0], [60.0, 3.0], [80.0, 6.0]]
#: Start centers of the sweep (age, family); no point lies as near to two of them.
SWEEP_STARTS = {
    2: [[25.3, 1.1], [70.7, 4.3]],
    3: [[22.1, 0.7], [48.3, 3.2], [83.9, 5.1]],
    5: [[21.7, 4.9], [33.3, 1.3], [52.9, 2.1], [71.1, 6.7], [93.3, 3.1]],
}


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to ``places`` digits: sums differ in their last bits between engines."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    # Adding zero turns a rounded -0.0 into 0.0.
    return df.withColumns({c: F.round(c, places) + F.lit(0.0) for c in doubles})


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_table(applicants(spark, sf_dir), APPROVED_STATUS)


def staged_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table written once, for fits that read it several times."""
    return stage(features(spark, sf_dir), "features")


def model_label() -> Column:
    """A label that can be learned: over 35, turned around for every fifth order."""
    return ((F.col("AGE_AT_APPLICATION") > 35) != (F.col("row_key") % 5 == 0)).cast("int")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).withColumn("LEARNED_LABEL", model_label())


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged ``row_key, label, features, features_unscaled`` and the columns behind them."""
    rows = stage(labelled(spark, sf_dir), "labelled")
    ready = fit_prep(rows, NUMERIC, CATEGORICAL).transform(rows)
    return stage(ready.withColumn("label", F.col("LEARNED_LABEL").cast("double")), "prepared")


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_key, label, flag, features`` with the one feature ``flag``: over 35 or not.

    A learner on one 0/1 feature has a closed form, which SQL can state.
    """
    rows = labelled(spark, sf_dir).select(
        "row_key",
        F.col("LEARNED_LABEL").cast("double").alias("label"),
        (F.col("AGE_AT_APPLICATION") > 35).cast("double").alias("flag"),
    )
    return stage(rows.withColumn("features", array_to_vector(F.array("flag"))), "flagged")


#: Five conditions on an applicant, as SQL that both engines read.
FIVE_FLAGS = {
    "older": "AGE_AT_APPLICATION > 35",
    "large_family": "APPLICANT_FAMILY_COUNT > 3",
    "late": "APPLICATION_YEAR > 1998",
    "machinery": "MARITAL_STATUS = 'MACHINERY'",
    "urgent": "GENDER_DESC = '1-URGENT'",
}
#: Eight conditions that say next to nothing of whether a key is even, so that bootstraps disagree on the best.
EIGHT_FLAGS = FIVE_FLAGS | {
    "middle": "AGE_AT_APPLICATION BETWEEN 40 AND 60",
    "building": "MARITAL_STATUS = 'BUILDING'",
    "low": "GENDER_DESC = '5-LOW'",
}


def flags(spark: SparkSession, sf_dir: str, names: dict[str, str], label: str) -> DataFrame:
    """Staged ``row_key, label, <flags>, features`` with one 0/1 slot for each condition."""
    held = [F.expr(condition).cast("double").alias(name) for name, condition in names.items()]
    rows = labelled(spark, sf_dir).select("row_key", F.expr(label).cast("double").alias("label"), *held)
    return stage(rows.withColumn("features", array_to_vector(F.array(*names))), "flags")


def rule_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with its label and one 0/1 vote per quantity rule."""
    votes = {f"v{i}": (F.col("l_quantity") > t).cast("int") for i, t in enumerate(QUANTITY_RULES)}
    lines = table(spark, sf_dir, "lineitem").withColumn("label", (F.col("l_returnflag") == "R").cast("int"))
    return lines.withColumns(votes).select(*LINE_KEY, "label", "l_extendedprice", *votes)


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(model, fold, key, label, prediction, p1, score)`` of three fixed rules, from one scan."""
    votes = [F.col(f"v{i}") for i in range(len(QUANTITY_RULES))]
    margin = sum((F.lit(a) * (v * 2 - 1) for a, v in zip(RULE_ALPHAS, votes)), F.lit(0.0))
    shares = {
        "vote": positive_share(votes),
        "weighted": exp_sigmoid(margin),
        "price": F.col("l_extendedprice") / 110000.0,
    }
    lines = fold_assign(rule_lines(spark, sf_dir), 10, LINE_KEY)
    scored = F.inline(F.array(*[F.struct(F.lit(m).alias("model"), p.alias("p1")) for m, p in shares.items()]))
    return lines.select("fold", *LINE_KEY, "label", scored).withColumns(
        {"prediction": threshold_predict(F.col("p1")), "score": F.col("p1")}
    )


def rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold_metrics(rule_predictions(spark, sf_dir), ["model", "fold"])


def price_votes(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """One ``(o_orderkey, vote)`` table per price rule."""
    orders = table(spark, sf_dir, "orders")
    return [orders.select("o_orderkey", (F.col("o_totalprice") > t).cast("int").alias("vote")) for t in PRICE_RULES]


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"), F.col("label").alias("cluster")
    )
