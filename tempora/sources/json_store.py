"""JSON documents below a base folder, each read once."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


class JsonStore:
    """load() remembers what it gave for a path, failures included; preload() forgets failures."""

    def __init__(self, spark: SparkSession, base: str | None = None):
        self.spark = spark
        self.base = base or "data"
        self._kept: dict[str, DataFrame | Exception] = {}

    def load(self, path: str, schema: str | None = None, multi_line: bool = False) -> DataFrame:
        if path not in self._kept:
            full = f"{self.base}/{path}"
            try:
                if "://" not in full and not os.path.exists(full):
                    raise FileNotFoundError(f"cannot load {path} (not found)")
                reader = self.spark.read.option("multiLine", str(multi_line).lower())
                self._kept[path] = (reader.schema(schema) if schema else reader).json(full).cache()
            except Exception as e:
                self._kept[path] = e
        found = self._kept[path]
        if isinstance(found, Exception):
            raise found
        return found

    def preload(self, path: str, schema: str | None = None) -> None:
        if path not in self._kept:
            try:
                self.load(path, schema)
            except Exception:
                del self._kept[path]
