"""Hands this package to the Python workers of a session that was started without it.

Also bounds the Arrow batches between Spark and the workers: texts are long, and a batch
of the usual 10,000 rows of them takes up to 100 MB in each of several buffers.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

BATCH_ROWS = 1000
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends the package's sources with the job, once per application.

    Spark copies the file to every executor; it does not have to lie in a shared folder.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="rankspark-package-")) / "rankspark.zip"
    with zipfile.ZipFile(target, "w") as packed:
        for source in sorted(package.rglob("*.py")):
            packed.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
