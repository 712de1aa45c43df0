"""What the workers need: the package's own code, as ``--py-files`` would bring it, and batches of few texts."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

import foldwright

#: Rows that a worker gets at once; texts may be long.
BATCH_ROWS = 2000

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send the package to the workers, once per application, and bound the rows of a batch there.

    Spark's own file server carries the archive from the driver; a cluster on which the package is
    installed does not need it, and loses nothing by it.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) not in range(1, BATCH_ROWS):
        spark.conf.set(name, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(foldwright.__file__).resolve().parent
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/foldwright", "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
