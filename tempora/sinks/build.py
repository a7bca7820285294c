"""Build targets: CSV, data package, SQLite, JSON for charts, JSON-LD, and snapshot differences.

Distributed targets write a folder of part files. SQLite is one file, so rows stream to it partition by partition and
only a batch is on the driver at a time.
"""

from __future__ import annotations

import json
import os
import sqlite3

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..operators import quality
from ..sources import store

#: Data package types by Spark type, and the vocabulary of the JSON-LD context.
TABLE_TYPES = {"string": "string", "int": "integer", "bigint": "integer", "double": "number", "boolean": "boolean", "date": "date", "timestamp": "datetime"}
SQLITE_TYPES = {"int": "INTEGER", "bigint": "INTEGER", "boolean": "INTEGER", "double": "REAL"}
CONTEXT = {"@vocab": "https://schema.org/", "id": "@id", "type": "@type"}
BATCH = 5_000


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(*[F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in df.schema.fields])


def build_csv(tables: dict[str, DataFrame], folder: str) -> list[str]:
    paths = []
    for name, df in tables.items():
        paths.append(f"{folder}/{name}")
        flat(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(paths[-1])
    return paths


def build_datapackage(tables: dict[str, DataFrame], folder: str, name: str = "register") -> str:
    """CSV and a datapackage.json that describes it."""
    build_csv(tables, folder)
    resources = []
    for table, df in tables.items():
        columns = [{"name": c, "type": TABLE_TYPES.get(kind, "string")} for c, kind in flat(df).dtypes]
        parts = [f"{table}/{f}" for f in store.file_names(df.sparkSession, f"{folder}/{table}", ".csv")]
        resources.append({"name": table, "path": parts, "profile": "tabular-data-resource", "schema": {"fields": columns}})
    path = f"{folder}/datapackage.json"
    if resources:
        package = {"name": name, "profile": "tabular-data-package", "resources": resources}
        store.write_text(next(iter(tables.values())).sparkSession, path, json.dumps(package, ensure_ascii=False, indent=2))
    return path


def build_sqlite(tables: dict[str, DataFrame], path: str) -> str:
    """One file on the driver's disk, written beside and renamed; a table of the same name is replaced."""
    path = path.removeprefix("file://")
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    temporary = f"{path}.tmp"
    if os.path.exists(temporary):
        os.remove(temporary)
    with sqlite3.connect(temporary) as db:
        for name, df in tables.items():
            rows = flat(df)
            columns = ", ".join(f'"{c}" {SQLITE_TYPES.get(kind, "TEXT")}' for c, kind in rows.dtypes)
            db.execute(f'CREATE TABLE "{name}" ({columns})')
            marks = ", ".join("?" * len(rows.columns))
            batch = []
            for row in rows.select(*[F.col(f"`{c}`").cast("string") if kind in ("date", "timestamp", "timestamp_ntz") or kind.startswith("decimal") else F.col(f"`{c}`") for c, kind in rows.dtypes]).toLocalIterator(prefetchPartitions=True):
                batch.append(tuple(row))
                if len(batch) == BATCH:
                    db.executemany(f'INSERT INTO "{name}" VALUES ({marks})', batch)
                    batch = []
            db.executemany(f'INSERT INTO "{name}" VALUES ({marks})', batch)
    db.close()
    os.replace(temporary, path)
    return path


def build_viz(tables: dict[str, DataFrame], folder: str) -> list[str]:
    """JSON lines that JsonStore reads back."""
    for name, df in tables.items():
        df.write.mode("overwrite").json(f"{folder}/{name}.json")
    return [f"{folder}/{name}.json" for name in tables]


def json_ld(df: DataFrame, kind: str, key: str = "id") -> DataFrame:
    """A row a record: value, its JSON-LD text."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (key, "type")]
    head = [F.lit(CONTEXT["@vocab"]).alias("@context"), F.col(key).alias("@id"), F.lit(kind).alias("@type")]
    return df.select(F.to_json(F.struct(*head, *rest)).alias("value"))


def build_jsonld(tables: dict[str, DataFrame], folder: str, kinds: dict[str, str] | None = None) -> list[str]:
    for name, df in tables.items():
        json_ld(df, (kinds or {}).get(name, name)).write.mode("overwrite").text(f"{folder}/{name}.jsonld")
    return [f"{folder}/{name}.jsonld" for name in tables]


def write_diff(spark: SparkSession, old: DataFrame, new: DataFrame, key: str, folder: str) -> int:
    """diff.json (what differs) and proposals.json (new rows to take over); gives the number of differences."""
    changes = quality.snapshot_diff(old, new, key).cache()
    changes.write.mode("overwrite").json(f"{folder}/diff.json")
    proposed = new.join(changes.where("change <> 'removed'"), key)
    proposed.write.mode("overwrite").json(f"{folder}/proposals.json")
    n = changes.count()
    changes.unpersist()
    return n


def build_yaml(rows: DataFrame, folder: str, key: str = "id") -> int:
    """A YAML file a row, named by the last part of its key, below the folder that the parts before it name; gives their number.

    Tasks write their own files, so a task that runs again replaces them."""
    fields = rows.columns
    texts = rows.select(F.col(key).alias("__key"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in fields]), {"ignoreNullFields": "false"}).alias("__record"))

    def write(batches):
        import pandas as pd
        import yaml
        from pyarrow import fs

        for batch in batches:
            for name, record in zip(batch["__key"], batch["__record"], strict=True):
                path = f"{folder}/{name.replace(':', '/')}.yaml"
                system, place = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
                system.create_dir(place.rpartition("/")[0], recursive=True)
                with system.open_output_stream(place) as f:
                    f.write(yaml.safe_dump(json.loads(record), allow_unicode=True, sort_keys=False).encode())
            yield pd.DataFrame({"n": [len(batch)]})

    return texts.mapInPandas(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]


def group_pages(rows: DataFrame, group: str, label: str, href: str | None = None, default: str = S.DEFAULT_GROUP) -> DataFrame:
    """A static page a group: group, items and html, a heading with the number of items and their list in Dutch order.

    A page holds its group's items, as the page that a browser gets does."""
    name = F.coalesce(F.col(group), F.lit(default))
    item = S.escaped(label) if href is None else F.coalesce(S.link(href, label), S.escaped(label))
    each = F.struct(F.collate(F.lower(F.col(label)), "nl").alias("o"), F.col(label).alias("l"), F.concat(F.lit("<li>"), item, F.lit("</li>")).alias("h"))
    found = rows.where(F.col(label).isNotNull()).groupBy(name.alias(group)).agg(F.count("*").alias("items"), F.array_sort(F.collect_list(each)).alias("each"))
    head = F.concat(F.lit("<h2>"), S.escaped(group), F.lit(" ("), S.dutch_number("items"), F.lit(")</h2>"))
    return found.select(group, "items", F.concat(head, F.lit("<ul>"), F.array_join(F.transform("each", lambda x: x["h"]), ""), F.lit("</ul>")).alias("html"))


TARGETS = {"csv": build_csv, "datapackage": build_datapackage, "sqlite": lambda t, d: build_sqlite(t, f"{d}/register.sqlite"), "viz": build_viz, "jsonld": build_jsonld}


def main(tables: dict[str, DataFrame], folder: str, targets: list[str] | None = None) -> dict[str, object]:
    """Build the targets named (all by default), each in a folder of its own."""
    done = {}
    for target in targets or list(TARGETS):
        done[target] = TARGETS[target](tables, f"{folder}/{target}")
    return done
