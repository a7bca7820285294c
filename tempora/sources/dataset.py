"""The register as four lazy tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import relations
from . import schema, store
from .yaml_tree import read_tree


class Entity:
    """One kind of record."""

    def __init__(self, load):
        self._load = load
        self._df: DataFrame | None = None

    @property
    def df(self) -> DataFrame:
        if self._df is None:
            self._df = self._load()
        return self._df

    def by_type(self, kind: str, column: str = "type") -> DataFrame:
        return self.df.where(F.col(column) == kind)

    def get(self, key: str, column: str = "id") -> DataFrame:
        return self.df.where(F.col(column) == key)

    def reload(self) -> None:
        """Forget what was read; the next access reads again."""
        if self._df is not None:
            self._df.unpersist()
        self._df = None


class Dataset:
    """A read-only handle: organisaties, personen, posten, mandaten below root/data (or another folder of the root).

    With a columnar folder the YAML tree is landed there as Parquet once and read from there.
    """

    def __init__(self, spark: SparkSession, root: str, columnar: str | None = None, data: str = "data"):
        self.spark, self.root, self.columnar, self.data = spark, str(root), columnar, data
        self.organisaties = Entity(lambda: self._table("organisaties"))
        self.personen = Entity(lambda: self._table("personen"))
        self.posten = Entity(lambda: self._table("posten"))
        self.mandaten = Entity(self._mandates)

    @classmethod
    def local(cls, spark: SparkSession, path: str, columnar: str | None = None) -> Dataset:
        root = os.path.realpath(path)
        if not os.path.exists(root):
            raise FileNotFoundError(f"no such folder: {root}")
        if not os.path.exists(os.path.join(root, "data")):
            raise FileNotFoundError(f"no data folder in {root}")
        return cls(spark, root, columnar)

    @classmethod
    def open(cls, spark: SparkSession, uri: str, columnar: str | None = None) -> Dataset:
        """As local, for a folder on any store that Spark reaches."""
        for path in (uri, f"{uri.rstrip('/')}/data"):
            if not store.exists(spark, path):
                raise FileNotFoundError(f"no such folder: {path}")
        return cls(spark, uri.rstrip("/"), columnar)

    def _folder(self, name: str) -> str:
        return f"{self.root}/{self.data}/{name}"

    def _table(self, name: str) -> DataFrame:
        kind = schema.struct(schema.ENTITIES[name])
        if self.columnar is None:
            return read_tree(self.spark, self._folder(name), kind)
        path = f"{self.columnar}/{name}"
        if not self._landed(path):
            read_tree(self.spark, self._folder(name), kind).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def _landed(self, path: str) -> bool:
        return store.exists(self.spark, f"{path}/_SUCCESS")

    def _mandates(self) -> DataFrame:
        embedded = relations.mandates(self.personen.df)
        folder = self._folder("mandaten")
        if not store.exists(self.spark, folder):
            return embedded
        alone = read_tree(self.spark, folder, schema.struct("person_id STRING, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.mandate().fields)))
        return embedded.unionByName(relations.clean_mandates(alone.withColumn("pos", F.lit(None).cast("int"))), allowMissingColumns=True)

    def reload(self) -> None:
        for entity in (self.organisaties, self.personen, self.posten, self.mandaten):
            entity.reload()
        if self.columnar is not None:
            for name in schema.ENTITIES:
                path = f"{self.columnar}/{name}"
                store.delete(self.spark, path)
                self.spark.catalog.refreshByPath(path)

    def load_all(self) -> dict[str, DataFrame]:
        """orgs, org_types, posts, persons, mandates and mandates_by_post."""
        m = self.mandaten.df
        orgs = self.organisaties.df
        return {
            "orgs": orgs,
            "org_types": orgs.select("type").distinct(),
            "posts": self.posten.df,
            "persons": self.personen.df,
            "mandates": m,
            "mandates_by_post": relations.mandates_by_post(m),
        }

    def views(self) -> None:
        """Temporary views organisaties, personen, posten, mandaten for SQL."""
        for name in ("organisaties", "personen", "posten", "mandaten"):
            getattr(self, name).df.createOrReplaceTempView(name)
