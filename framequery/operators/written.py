"""Tables written between the steps of an iterative job, which cuts their lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dir: list[str] = []
_made: set[str] = set()


def _folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, a folder that all executors see; only a local master may do without."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors see")
    if not _own_dir:
        _own_dir.append("file://" + tempfile.mkdtemp(prefix="spark-written-"))
    return _own_dir[0]


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in a folder of this application; the driver's JVM deletes it when it ends in good order."""
    folder = f"{_folder(spark)}/written-{spark.sparkContext.applicationId}"
    if folder not in _made:
        _made.add(folder)
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(where)
        files.deleteOnExit(where)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read back; its rows outlive the executors that made them."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
