"""Trees of YAML files, one record each, as DataFrames with an explicit schema.

Spark has no YAML reader. Files are listed, dealt to tasks, and parsed there with the safe C loader; values are taken as the
schema says (text stays text whatever it looks like, so identifiers keep their zeros). Land the result as Parquet and query that.
"""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import rules, store

FILES_PER_TASK = 512


def _loader():
    import yaml

    base = getattr(yaml, "CSafeLoader", yaml.SafeLoader)

    class TextLoader(base):
        """Scalars as texts; what a value is, the schema says."""

    TextLoader.yaml_implicit_resolvers = {k: [x for x in v if x[0] == "tag:yaml.org,2002:null"] for k, v in base.yaml_implicit_resolvers.items()}
    return yaml, TextLoader


def fit(value, kind: T.DataType):
    """A loaded value as the schema's type; what does not fit is null."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return {f.name: fit(value.get(f.name), f.dataType) for f in kind.fields} if isinstance(value, dict) else None
    if isinstance(kind, T.ArrayType):
        return [fit(v, kind.elementType) for v in value] if isinstance(value, list) else None
    if isinstance(value, (dict, list)):
        return None
    try:
        if isinstance(kind, (T.IntegerType, T.LongType)):
            return int(value)
        if isinstance(kind, T.DoubleType):
            return float(value)
    except ValueError:
        return None
    return str(value)


def list_files(folder: str) -> list[str]:
    """All YAML files below a folder, in order. Only names are kept on the driver."""
    found = [os.path.join(d, f) for d, _, files in os.walk(folder) for f in files if f.endswith((".yaml", ".yml"))]
    return sorted(found)


def _files(spark: SparkSession, folder: str) -> DataFrame | None:
    """_file and content of each YAML file below a folder (content null: open it); None if there is none."""
    if "://" in folder and not folder.startswith("file://"):
        if not store.exists(spark, folder):
            return None
        raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{yaml,yml}").load(folder)
        return raw.select(F.col("path").alias("_file"), F.col("content"))
    files = list_files(folder.removeprefix("file://"))
    if not files:
        return None
    names = spark.createDataFrame(pd.DataFrame({"_file": files}), "_file string")
    return names.repartition(max(1, min(len(files), -(-len(files) // FILES_PER_TASK)))).withColumn("content", F.lit(None).cast("binary"))


def _records(batch):
    """Path and loaded record (an exception where it does not load) of each file of a batch."""
    yaml, loader = _loader()
    for path, content in zip(batch["_file"], batch["content"], strict=True):
        if content is None:
            with open(path, "rb") as f:
                content = f.read()
        try:
            yield path, yaml.load(content, loader)  # noqa: S506 a safe loader
        except yaml.YAMLError as e:
            yield path, e


def read_tree(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """A row a file: the schema's fields and _file. A missing folder gives no rows; a folder with a scheme is read by Spark."""
    out = T.StructType([*schema.fields, T.StructField("_file", T.StringType())])
    source = _files(spark, folder)
    if source is None:
        return spark.createDataFrame([], out)

    def parse(batches):
        for batch in batches:
            rows = []
            for path, record in _records(batch):
                if isinstance(record, Exception):
                    raise ValueError(f"{path}: {record}")
                rows.append({**(fit(record, schema) or {}), "_file": path})
            yield pd.DataFrame(rows, columns=out.names).astype(object)

    return source.mapInPandas(parse, out)


def schema_issues(spark: SparkSession, folder: str, entity: str, rule: dict) -> DataFrame:
    """severity, rule, entity, key (the file) and message of all that does not fit; a key that is not known is a warning."""
    out = "severity string, rule string, entity string, key string, message string"
    source = _files(spark, folder)
    if source is None:
        return spark.createDataFrame([], out)

    def check(batches):
        for batch in batches:
            rows = []
            for path, record in _records(batch):
                found = [("", f"does not load: {record}")] if isinstance(record, Exception) else rules.misfits(record, rule)
                rows += [("warning" if how == "is not known" else "error", "schema", entity, path, f"{at} {how}".strip()) for at, how in found]
            yield pd.DataFrame(rows, columns=["severity", "rule", "entity", "key", "message"])

    return source.mapInPandas(check, out)
