"""Command line: validate, diff, build."""

from __future__ import annotations

import argparse


def _session():
    from .session import build

    return build()


def validate(args: argparse.Namespace) -> int:
    """Records against their schemas, and the links between them, over a data folder."""
    import os
    from functools import reduce

    from .operators import quality
    from .sources import rules, yaml_tree
    from .sources.dataset import Dataset

    folder = os.path.realpath(args.data)
    if not os.path.isdir(folder):
        print(f"no such folder: {folder}")
        return 2
    names = list(rules.REQUIRED)
    files = sum(len(yaml_tree.list_files(os.path.join(folder, name))) for name in names)
    if not files:
        print(f"no records below {folder}")
        return 2
    spark = _session()
    data = Dataset(spark, os.path.dirname(folder), data=os.path.basename(folder))
    stated = rules.rules(args.schemas)
    misfits = [yaml_tree.schema_issues(spark, f"{folder}/{name}", name, stated[name]) for name in names]
    linked = quality.all_issues(data.organisaties.df, data.personen.df, data.posten.df, data.mandaten.df)
    issues = reduce(lambda a, b: a.unionByName(b), misfits, linked).cache()
    for row in quality.report(issues).orderBy("severity", "rule").toLocalIterator():
        print(f"{row['severity']}\t{row['rule']}\t{row['n']}")
    print(f"{files} files")
    return quality.exit_code(issues, strict=args.strict)


def diff(args: argparse.Namespace) -> int:
    """Records of a cache folder against those of a data folder: diff.json and proposals.json."""
    import os

    from .sinks.build import write_diff
    from .sources import schema
    from .sources.yaml_tree import read_tree

    spark = _session()
    for name, ddl in schema.ENTITIES.items():
        kind = schema.struct(ddl)
        old, new = (read_tree(spark, os.path.join(folder, name), kind).drop("_file") for folder in (args.data, args.cache))
        print(name, write_diff(spark, old, new, "id", os.path.join(args.out, name)))
    return 0


def build(args: argparse.Namespace) -> int:
    from .sinks import build as targets
    from .sources.dataset import Dataset

    data = Dataset.local(_session(), args.root)
    tables = {"organisaties": data.organisaties.df, "personen": data.personen.df, "posten": data.posten.df}
    targets.main(tables, args.out, args.target or None)
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tempora", description=__doc__)
    sub = p.add_subparsers(required=True)
    v = sub.add_parser("validate", help="check records and the links between them")
    v.add_argument("--data", default="data")
    v.add_argument("--schemas", default="schemas", help="folder of JSON Schema files, each named after a kind of record; built-in ones where it has none")
    v.add_argument("--strict", action="store_true", help="fail on warnings, too")
    v.set_defaults(run=validate)
    d = sub.add_parser("diff", help="compare a cache with the data")
    d.add_argument("--cache", default="_cache")
    d.add_argument("--data", default="data")
    d.add_argument("--out", default=".")
    d.set_defaults(run=diff)
    b = sub.add_parser("build", help="write the build targets")
    b.add_argument("--root", default=".")
    b.add_argument("--out", default="dist")
    b.add_argument("--target", action="append", choices=["csv", "datapackage", "sqlite", "viz", "jsonld"])
    b.set_defaults(run=build)
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    return args.run(args) or 0


if __name__ == "__main__":
    raise SystemExit(main())
