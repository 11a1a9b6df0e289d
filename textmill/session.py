"""What a session needs before Python workers can run this package's functions, tables in the shared folder, and broadcasts behind a count."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors, once for each application, and keeps Arrow batches small for the Python workers of this session: texts can be long."""
    for key, value in (("maxRecordsPerBatch", "1000"), ("maxBytesPerBatch", str(8 << 20))):
        if spark.conf.get(f"spark.sql.execution.arrow.{key}", None) != value:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", value)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        here = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="textmill-"), "textmill.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(here):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.join("textmill", os.path.relpath(full, here)))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)
    return spark


_made: dict[str, SparkSession] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. A temporary one stands in only where that is unset and all runs on this machine (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="textmill-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses; what is written there is deleted when the driver ends."""
    path = f"{scratch_root(spark)}/textmill/{name}-{uuid.uuid4().hex}"
    _made[path] = spark
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again: cuts lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._textmill_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that written() has returned: nothing may be read from them any more."""
    for t in tables:
        _delete(t._textmill_path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder, by the file system that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _delete(path: str) -> None:
    spark = _made.pop(path, None)
    try:
        remove(spark, path)
    except Exception:  # the session has ended
        pass


def clean_scratch() -> None:
    """Deletes every table that written() has made; DataFrames built on them can't be used afterwards."""
    for path in list(_made):
        _delete(path)


atexit.register(clean_scratch)

_for_life: dict[str, object] = {}


def kept(key: str, make):
    """make(), once in the life of a Python worker, whatever tasks and stages it serves: for models, which are dear to load."""
    if key not in _for_life:
        _for_life[key] = make()
    return _for_life[key]


#: Rows that small() broadcasts at most.
SMALL_ROWS = 200_000


def small(df: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """df with a broadcast hint if it has been counted to have few rows; Spark picks a join by shuffle else."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
