"""Files wherever Spark's file systems reach, and scratch folders that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.delete(place, True)


def file_names(spark: SparkSession, folder: str, suffix: str = "") -> list[str]:
    """The names of the files in a folder, in order."""
    system, place = _place(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(place) if s.isFile() and s.getPath().getName().endswith(suffix))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced if it is there."""
    system, place = _place(spark, path)
    out = system.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    return spark.read.text(path, wholetext=True).first()[0]


def scratch(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir; where that is unset (tests, a single machine) a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = getattr(spark, "_tempora_scratch", None)
        if base is None:
            folder = tempfile.mkdtemp(prefix="tempora-scratch-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            base = spark._tempora_scratch = f"file://{folder}"
    return f"{base.rstrip('/')}/scratch/{uuid.uuid4().hex}"
