"""Tables that a job writes for itself, in the folder that all executors see."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

#: Whether Spark deletes an execution's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset, a local session takes a temporary folder, which then is that setting; a cluster must name one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "local")
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='tracewright-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: computed once, however often it is read, and safe when executors are lost.

    The shuffle files of its making go when it is made, not when the driver happens to collect its garbage: the table stands for them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables of ``written`` that nothing will read again."""
    for t in tables:
        if path := _paths.pop(t, None):
            place = t.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(place, True)
