"""Shared scratch space for tables that cut lineage."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="marketspark-")
    return _LOCAL_ROOTS[application]


def new_folder(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/marketspark-{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The frame's rows from a table in the shared folder (in ``folder``, if given, a new one of it): computed once,
    whatever reads them later, and still there when an executor is lost. Runs a job."""
    folder = folder or new_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def emptied(df: DataFrame, folder: str) -> None:
    """Gives back the space of a table stored in ``folder`` that nothing reads any more: an empty one takes its place."""
    none = [F.lit(None).cast(one.dataType).alias(one.name) for one in df.schema]
    df.sparkSession.range(0, 0, 1, 1).select(*none).write.mode("overwrite").parquet(folder)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the files of shuffles whose results are stored; it does so when the driver collects garbage."""
    spark.sparkContext._jvm.System.gc()
