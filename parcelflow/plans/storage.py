"""Cutting lineage of iterative plans in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_folders: list[tuple[SparkSession, str]] = []


def cut(df: DataFrame) -> DataFrame:
    """An eager checkpoint: a lost executor loses nothing of it."""
    _shared(df.sparkSession)
    return df.checkpoint()


def folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share; it goes with the process."""
    path = f"{_shared(spark)}/{name}-{uuid.uuid4().hex}"
    _folders.append((spark, path))
    return path


@atexit.register
def _clean() -> None:
    for spark, path in _folders:
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001  the session may be gone
            return


def _shared(spark: SparkSession) -> str:
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or "file://" + tempfile.mkdtemp(prefix="parcelflow-"))
    return sc._jsc.sc().getCheckpointDir().get()
