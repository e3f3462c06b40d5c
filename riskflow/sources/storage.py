"""Steps stored as Parquet in a folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

WORK_DIR = "spark.checkpoint.dir"


def work_dir(spark: SparkSession, given: str | None = None) -> str:
    """`given`, or the folder in spark.checkpoint.dir, read from the session.

    Where that is unset, a local session gets a temporary folder; on a cluster it is an error, since executors do not
    share a machine's disk.
    """
    base = given or spark.conf.get(WORK_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {WORK_DIR} to a shared folder, or pass work_dir")
        base = tempfile.mkdtemp(prefix="riskflow-")
        spark.conf.set(WORK_DIR, base)
    return f"{base.rstrip('/')}/steps-{spark.sparkContext.applicationId}"


def stored(df: DataFrame, given: str | None = None) -> DataFrame:
    """The rows written once and read back. Later passes read only the columns they need and survive lost executors."""
    path = f"{work_dir(df.sparkSession, given)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_stored(spark: SparkSession, given: str | None = None) -> None:
    """Delete all steps of this application. Call it when nothing that reads them is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_dir(spark, given))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
