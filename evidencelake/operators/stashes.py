"""Intermediate tables, written to a folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

#: Folders that this driver wrote, removed when it ends.
_written: set[str] = set()
_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, a temporary one in local mode and an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="evidencelake-")
        atexit.register(shutil.rmtree, _local[app], ignore_errors=True)
    return f"file://{_local[app]}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors; ``clear`` removes it."""
    spark = df.sparkSession
    home = f"{shared_dir(spark)}/evidencelake-{spark.sparkContext.applicationId}"
    if home not in _written:
        _written.add(home)
        atexit.register(_remove, home)
    path = f"{home}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Remove all that ``stash`` wrote for this application; results that read it can't be used any more."""
    for home in [h for h in _written if h.endswith(spark.sparkContext.applicationId)]:
        _remove(home)


def _remove(home: str) -> None:
    jvm = SparkContext._jvm
    if home in _written and jvm is not None:
        path = jvm.org.apache.hadoop.fs.Path(home)
        path.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
    _written.discard(home)
