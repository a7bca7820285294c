"""Intermediate tables and files in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A new path under spark.checkpoint.dir, in a folder of this session. Where that is unset (tests, a single machine) a temporary folder is used."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = getattr(spark, "_tempora_folder", None)
        if base is None:
            if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tempora-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            base = spark._tempora_folder = f"file://{folder}"
    if not getattr(spark, "_tempora_run", "").startswith(base):
        spark._tempora_run = f"{base.rstrip('/')}/tempora/{uuid.uuid4().hex}"
    path = f"{spark._tempora_run}/{uuid.uuid4().hex}"
    spark.__dict__.setdefault("_tempora_made", []).append(path)
    return path


def stash(df: DataFrame) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: the lineage ends there, lost executors cost no recomputation."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._tempora_path = path
    return found


def settled(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """stash(build()), without the tables and files that were made to build it."""
    made = spark.__dict__.setdefault("_tempora_made", [])
    start = len(made)
    out = stash(build())
    for path in made[start:]:
        if path != out._tempora_path:
            remove(spark, path)
    made[start:] = [out._tempora_path]
    return out


def discard(*stashed: DataFrame) -> None:
    """Delete stashed tables that no plan will read any more (only what stash() itself gave)."""
    for df in stashed:
        remove(df.sparkSession, df._tempora_path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store through Spark's own file systems."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def clean(spark: SparkSession) -> None:
    """Delete everything that this session wrote to the shared folder: call it when the results are written elsewhere."""
    if hasattr(spark, "_tempora_run"):
        remove(spark, spark._tempora_run)
        del spark._tempora_run
        spark._tempora_made.clear()


def reads_files(df: DataFrame) -> bool:
    """Whether df is columns and rows of one table of files, each row at most once."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().apply(0)
    return node.nodeName() in ("LogicalRelation", "Relation parquet") and bool(df.inputFiles())


def identified(df: DataFrame) -> DataFrame:
    """df with __file and __row, two numbers that tell its rows apart, the same whenever it is read: from the files' own row numbers
    where df reads files, otherwise from a copy that is written for it."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    if reads_files(df):
        return df.select(*columns, F.xxhash64("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    return stash(df.select(*columns, F.lit(0).cast("long").alias("__file"), F.monotonically_increasing_id().alias("__row")))


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of a row, of any types."""
    return F.xxhash64(*(F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in df.schema.fields))


#: Bytes of input a core reads without having rows dealt to it.
CORE_BYTES = 64 << 20


def spread(df: DataFrame) -> DataFrame:
    """df, with its rows dealt to all cores where its files are fewer than the cores and small: one row group is one task's otherwise."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) > CORE_BYTES * cores:
        return df
    files = len(df.inputFiles())
    return df.repartition(cores) if 0 < files < cores else df


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_bytes(docs: DataFrame, text: str) -> int:
    """Bytes of UTF-8 in a column; sizes chunks, never decides what is processed."""
    return docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0


def file_system(path: str):
    """The pyarrow file system of a path, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:/", "file:///", 1) if path.startswith("file:/") else f"file://{path}")


def read_file(path: str) -> bytes:
    store, place = file_system(path)
    with store.open_input_stream(place) as f:
        return f.read()


def write_file(path: str, raw: bytes) -> None:
    """Write under another name, then rename."""
    store, place = file_system(path)
    store.create_dir(place.rpartition("/")[0], recursive=True)
    temporary = f"{place}.{uuid.uuid4().hex}"
    with store.open_output_stream(temporary) as f:
        f.write(raw)
    store.move(temporary, place)


def exists(path: str) -> bool:
    from pyarrow import fs

    store, place = file_system(path)
    return store.get_file_info(place).type == fs.FileType.File
