"""Categories to slots, columns to one standardized vector, and the names of its slots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.operators.ordered import running_totals
from foldwright.staging import stage

def _indexer(cols: Sequence[str]) -> StringIndexer:
    return StringIndexer(
        inputCols=list(cols), outputCols=[f"{c}_IDX" for c in cols], handleInvalid="keep", stringOrderType="frequencyDesc"
    )


def _encoder(cols: Sequence[str]) -> OneHotEncoder:
    return OneHotEncoder(inputCols=[f"{c}_IDX" for c in cols], outputCols=[f"{c}_VEC" for c in cols])


def _scaler(name: str, out: str) -> StandardScaler:
    return StandardScaler(inputCol=name, outputCol=out, withMean=True, withStd=True)


def string_index(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add ``<c>_IDX``: 0 for the most frequent value, ties by value; null gets the index after the last.

    The distinct values are counted, numbered range by range and joined back, so a
    column may have any number of them; none reaches the driver.
    """
    for name in cols:
        value = F.col(name).cast("string")
        held = df.filter(F.col(name).isNotNull()).groupBy(value.alias("_value")).agg(F.count("*").alias("_n"))
        place = F.struct((-F.col("_n")).alias("_less"), F.col("_value").alias("_value")).alias("_place")
        numbered = running_totals(held.select(F.lit(0).alias("_all"), place, F.lit(1).alias("_one")), ["_all"], "_place", ["_one"])
        index = stage(numbered.select(F.col("_place._value").alias("_value"), F.col("_one_before").alias("_index")), "index")
        last = index.agg(F.count("*")).scalar()
        found = df.join(index, value == F.col("_value"), "left")
        df = found.withColumn(f"{name}_IDX", F.coalesce("_index", last).cast("double")).drop("_value", "_index")
    return df


def index_slots(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``string_index`` for values that become slots of a vector: the column carries their names for ``one_hot``."""
    return _indexer(cols).fit(df).transform(df)


def one_hot(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add ``<c>_VEC`` from ``<c>_IDX``: a slot per known value, all zero for null and unseen."""
    return _encoder(cols).fit(df).transform(df)


def assemble(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    """Concatenate columns into a vector. Rows with a null input are dropped."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip").transform(df)


def standardize(df: DataFrame, name: str, out: str) -> DataFrame:
    """Center a vector and divide by the sample standard deviation; a constant slot becomes 0."""
    return _scaler(name, out).fit(df).transform(df)


class PrepPipeline(Pipeline):
    """The stages of ``prep_pipeline``."""

    def unscaled(self) -> Pipeline:
        """The stages before the last, which standardizes."""
        return Pipeline(stages=self.getStages()[:-1])


def prep_pipeline(numeric: Sequence[str], categorical: Sequence[str]) -> PrepPipeline:
    """Index, encode, assemble (``features_unscaled``) and standardize (``features``).

    Each distinct category becomes a slot with a name, so the values reach the driver
    as the slot names do. For columns of very many values use ``string_index``.
    """
    inputs = [*numeric, *[f"{c}_VEC" for c in categorical]]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features_unscaled", handleInvalid="skip")
    categories = [_indexer(categorical), _encoder(categorical)] if categorical else []
    return PrepPipeline(stages=[*categories, assembler, _scaler("features_unscaled", "features")])


def fit_prep(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> PipelineModel:
    return prep_pipeline(numeric, categorical).fit(df)


def feature_names(df: DataFrame, name: str = "features_unscaled") -> list[str]:
    """Slot names from the vector's metadata. Scaling drops them, so ask for the unscaled column."""
    attributes = df.schema[name].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a["idx"], a["name"]) for group in attributes.values() for a in group if "name" in a)
    if not slots:
        raise ValueError(f"{name} carries no slot names")
    return [slot_name for _, slot_name in slots]


def slot_columns(df: DataFrame, name: str, outputs: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Spread a vector over one double column per slot."""
    slots = vector_to_array(F.col(name))
    return df.select(*keep, *[F.get(slots, F.lit(i)).alias(out) for i, out in enumerate(outputs)])
