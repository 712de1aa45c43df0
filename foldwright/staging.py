"""Tables written once to the cluster's shared folder and then read many times.

Cross-validation, the K sweep and exact running totals read one intermediate
result from several jobs. Writing it as parquet cuts its lineage, keeps column
pruning and filter pushdown, and survives the loss of any executor, because the
files live in the shared folder and not on a worker.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_areas: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is absent, the folder given to ``setCheckpointDir`` is used.
    Only a local session without either gets a folder of its own; on a cluster a
    missing setting is an error, since a worker's own disk is not shared.
    """
    context = spark.sparkContext
    named = spark.conf.get(_SETTING, None)
    current = context.getCheckpointDir()
    if not named and not current:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder that every executor can reach")
        named = tempfile.mkdtemp(prefix="foldwright-")
    if not current:
        # MLlib's boosted trees cut their own lineage only when this is set.
        context.setCheckpointDir(named)
        current = context.getCheckpointDir()
    return named or current


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below this application's part of the shared folder."""
    app = spark.sparkContext.applicationId
    if app not in _areas:
        _areas[app] = f"{shared_dir(spark).rstrip('/')}/foldwright-{app}"
    return f"{_areas[app]}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    With ``by`` there is a folder for each of its values, and a filter on it lists only those files.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    # The schema is passed on so that no footer is read to infer it and so that
    # vector columns keep their slot names.
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def by_key(table: DataFrame, parts: int, key: Sequence[str]) -> DataFrame:
    """The rows dealt into ``parts`` partitions by their key and sorted by it.

    Fits that sample per partition then give the same model on any number of cores.
    """
    return table.repartition(parts, *key).sortWithinPartitions(*key)


def release(spark: SparkSession) -> bool:
    """Delete everything this application staged. Tables handed out become unreadable."""
    area = _areas.pop(spark.sparkContext.applicationId, None)
    if area is None:
        return False
    path = spark._jvm.org.apache.hadoop.fs.Path(area)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
