"""Cutting lineage through written tables in the folder that the whole cluster shares."""

from __future__ import annotations

import atexit
import math
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, rows: int | None = None, rows_a_file: int = 250_000, drop_shuffles: bool = False) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back, so that a lost executor costs no recomputation
    and the lineage stays short. Column names must be distinct. The table is deleted when the driver exits.

    rows: about how many rows there are, if known. A table then has no more files than rows_a_file asks for, or than
    there are cores if that is more; files in their thousands for a few rows cost more than the rows.
    drop_shuffles: what was shuffled to write the table leaves the disk at once, and not when the driver next collects
    garbage; for shuffles of whole texts. The table itself is all that is read afterwards."""
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(spark.sparkContext.defaultParallelism, math.ceil(rows / rows_a_file)))
    path = f"{shared_dir(spark)}/quern-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP)
    if drop_shuffles:
        spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    atexit.register(_delete, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session may have ended before the driver
        pass


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
