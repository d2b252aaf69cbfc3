"""Session settings that the engine expects."""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def session(app: str = "quern", **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew joins, dynamic partition overwrite; further settings by name with __ for a dot."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset a temporary one is made, but only under a local master:
    other executors would not see it."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.match(r"local(\[(?!.*-cluster)|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="quern-checkpoints-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


_shipped: set[str] = set()
#: Rows in an Arrow batch: a thousand texts are a few MB, and the longest ones still fit beside a worker's arrays.
ARROW_ROWS = 1000


def ship(spark: SparkSession) -> SparkSession:
    """Makes this package importable by the Python workers, wherever they run, once for each application, and holds Arrow
    batches small. The archive is made on the driver, which serves it to the executors."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        package = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="quern-")) / "quern.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for source in sorted(package.rglob("*.py")):
                z.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark
