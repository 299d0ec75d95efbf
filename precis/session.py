"""Shared scratch space and staged tables.

Plans that need stable intermediate results write them as Parquet below the
folder named by ``spark.checkpoint.dir``, so that a lost executor costs a
re-read and never a different result. Each application has its own folder there
and drops it when the driver's Python ends.
"""

from __future__ import annotations

import atexit
import contextlib
import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Where staged tables go in local mode when spark.checkpoint.dir is unset; never used on a cluster.
LOCAL_DIR = "/tmp/checkpoints"

_owned: set[str] = set()


def _drop(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended first
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def shared_dir(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``, which every executor can reach."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not top and (master == "local" or master.startswith("local[")):
        top = LOCAL_DIR
    if not top:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = f"{top.rstrip('/')}/precis-{spark.sparkContext.applicationId}"
    if own not in _owned:
        _owned.add(own)
        atexit.register(_drop, spark, own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does ``path`` exist on its (possibly remote) file system?"""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Is ``path`` a folder on its (possibly remote) file system? False when there is nothing."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(jpath) and fs.getFileStatus(jpath).isDirectory()


def write_file(spark: SparkSession, path: str, content: bytes = b"") -> None:
    """Create one small file, such as a marker."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).create(jpath, True)
    out.write(bytearray(content))
    out.close()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, by way of the shared folder."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    path = f"{scratch_path(spark, 'package')}/precis.zip"
    write_file(spark, path, content.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
