"""Cutting lineage through the folder that all executors share.

A materialised step is a Parquet table below ``spark.checkpoint.dir``: columnar and compressed, so it takes less disk than
a checkpointed RDD, and it outlives any executor. Where that setting is missing, one machine that runs all (a local master)
uses a temporary folder of its own; on a cluster that is an error, since each executor would write to a disk of its own. The
tables are deleted by ``release``, once a result has been read, or when the driver's process ends.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folder: str | None = None
_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    global _own_folder
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="normwerk-")
    return "file://" + _own_folder


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back; the result has no lineage beyond those files."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/normwerk/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def release(df_paths: list[str] | None = None) -> None:
    """Delete the materialised tables (all of them, or those named)."""
    for spark, path in list(_written):
        if df_paths is not None and path not in df_paths:
            continue
        _written.remove((spark, path))
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session may be gone already
            pass


@atexit.register
def _at_exit() -> None:
    import shutil

    release()
    if _own_folder:
        shutil.rmtree(_own_folder, ignore_errors=True)
