"""Records against rules of JSON Schema: types, required and unknown keys, items, enumerations, patterns, local references."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

from pyspark.sql import types as T

from . import schema

#: The keys that all records of a kind have.
REQUIRED = {
    "organisaties": ["id", "type", "classification", "parent_id", "names", "valid_from", "valid_until", "sources"],
    "personen": ["id", "name", "mandaten", "sources"],
    "posten": ["id", "organization_id", "label", "classification", "valid_from", "valid_until"],
}
#: The first part of a schema file's name, for each kind of record.
FILES = {"organisaties": ("organisaties", "organisatie"), "personen": ("personen", "persoon"), "posten": ("posten", "post")}


def of_type(kind: T.DataType) -> dict:
    """A rule that a Spark type states; everything may be null, no keys but the fields are known."""
    if isinstance(kind, T.StructType):
        return {"type": ["object", "null"], "properties": {f.name: of_type(f.dataType) for f in kind.fields}, "additionalProperties": False}
    if isinstance(kind, T.ArrayType):
        return {"type": ["array", "null"], "items": of_type(kind.elementType)}
    return {"type": [{"int": "integer", "bigint": "integer", "double": "number"}.get(kind.simpleString(), "string"), "null"]}


def rules(folder: str | None = None) -> dict[str, dict]:
    """The rule of each kind of record: from a folder of schema files where it has one, else the built-in one."""
    found = {name: of_type(schema.struct(ddl)) | {"required": REQUIRED[name]} for name, ddl in schema.ENTITIES.items()}
    if folder and os.path.isdir(folder):
        for file in sorted(os.listdir(folder)):
            for name, stems in FILES.items():
                if file.endswith(".json") and file.split(".")[0] in stems:
                    with open(os.path.join(folder, file), encoding="utf-8") as f:
                        found[name] = json.load(f)
    return found


def _is(value, kind: str) -> bool:
    """Whether a loaded value has a type; scalars are loaded as texts."""
    if kind == "null" or value is None:
        return kind == "null" and value is None
    if kind in ("object", "array"):
        return isinstance(value, dict if kind == "object" else list)
    if isinstance(value, (dict, list)):
        return False
    pattern = {"integer": r"[+-]?\d+", "number": r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", "boolean": "true|false"}.get(kind, "(?s).*")
    return re.fullmatch(pattern, str(value)) is not None


def misfits(value, rule: dict, at: str = "", root: dict | None = None) -> Iterator[tuple[str, str]]:
    """Where (a path) and how a value does not fit a rule."""
    root = rule if root is None else root
    while "$ref" in rule:
        target = root
        for part in rule["$ref"].removeprefix("#/").split("/"):
            target = target.get(part, {})
        rule = target
    kinds = rule.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        yield at, f"is not {' or '.join(kinds)}"
        return
    if value is None:
        return
    if "enum" in rule and str(value) not in map(str, rule["enum"]):
        yield at, f"is none of {', '.join(map(str, rule['enum']))}"
    if "pattern" in rule and not isinstance(value, (dict, list)) and not re.search(rule["pattern"], str(value)):
        yield at, f"does not match {rule['pattern']}"
    if isinstance(value, dict):
        known = rule.get("properties", {})
        yield from ((f"{at}.{k}".lstrip("."), "is missing") for k in rule.get("required", []) if k not in value)
        for k, v in value.items():
            place = f"{at}.{k}".lstrip(".")
            if k in known:
                yield from misfits(v, known[k], place, root)
            elif rule.get("additionalProperties", True) is False:
                yield place, "is not known"
    if isinstance(value, list) and isinstance(rule.get("items"), dict):
        for i, v in enumerate(value):
            yield from misfits(v, rule["items"], f"{at}[{i}]", root)
