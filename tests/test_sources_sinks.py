"""YAML trees, the dataset handle, JSON, and the build targets, on invented records."""

import importlib
import json
import os
import pkgutil
import sqlite3

import pytest

from tempora import cli, fetchers
from tempora.operators import quality, relations
from tempora.sinks import build
from tempora.sources.dataset import Dataset
from tempora.sources.json_store import JsonStore

FILES = {
    "organisaties/ministeries/alpha.yaml": "id: org:alpha\ntype: ministerie\nclassification: ministerie\nparent_id: null\nidentifiers:\n  oin: 00000001003214345000\n  kvk: '01234567'\nnames:\n- value: Alpha\n  abbr: AL\n  valid_from: '2000-01-01'\n  valid_until: null\nvalid_from: '2000-01-01'\nvalid_until: null\nsources:\n- id: feed\n  url: u\n  retrieved: '2024-01-01'\n  fields: [oin]\n",
    "organisaties/zbo/beta.yaml": "id: org:beta\ntype: zbo\nclassification: zbo\nparent_id: org:alpha\nnames: []\nvalid_from: 1900-01-01\nvalid_until: null\nsuccessor_id: org:gone\nsources: []\n",
    "personen/p.yaml": "id: person:p-1950\nname: {full: P. Example, initials: P., family: Example}\nbirth: {year: 1950}\nmandaten:\n- {id: m1, organization_id: org:alpha, post_id: post:x, role: Member, start_date: '2020-01-01', end_date: null, sources: []}\n- {id: m1, organization_id: org:none, post_id: post:x, role: Member, start_date: '2010-01-01', end_date: '2011-01-01', confidence: 0.9, sources: [{id: s, url: u, retrieved: '2024-02-02', fields: null}]}\nsources: []\n",
    "posten/deep/er/x.yaml": "id: post:x\norganization_id: org:alpha\nlabel: X\nclassification: null\nseat_count: 1\nvalid_from: '2015-01-01'\nvalid_until: null\n",
}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    base = tmp_path_factory.mktemp("register")
    for name, text in FILES.items():
        path = base / "data" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    return base


@pytest.fixture(scope="module")
def data(spark, root):
    return Dataset.local(spark, str(root))


def test_missing_folders(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        Dataset.local(spark, str(tmp_path / "no"))
    with pytest.raises(FileNotFoundError):
        Dataset.local(spark, str(tmp_path))


def test_records_keep_their_texts(data):
    org = data.organisaties.by_type("ministerie").first()
    assert (org["identifiers"]["oin"], org["identifiers"]["kvk"]) == ("00000001003214345000", "01234567")
    assert data.organisaties.get("org:beta").first()["valid_from"] == "1900-01-01"
    assert data.personen.df.first()["birth"]["year"] == 1950
    assert data.posten.df.count() == 1


def test_mandates_and_children(data):
    rows = {r["pos"]: r for r in data.mandaten.df.collect()}
    assert rows[0]["end_date"] is None and str(rows[1]["end_date"]) == "2011-01-01" and rows[1]["confidence"] == 0.9
    sources = relations.provenance(data.organisaties.df, data.personen.df, data.posten.df, data.mandaten.df)
    assert {(r["entity"], r["source_id"]) for r in sources.collect()} == {("organisation", "feed"), ("mandate", "s")}
    assert {r["field"] for r in relations.source_fields(sources).collect()} == {"oin", None}
    assert {(r["kind"], r["dst"]) for r in relations.org_edges(data.organisaties.df).collect()} == {("parent", "org:alpha"), ("successor", "org:gone")}
    assert data.load_all()["mandates_by_post"].first()["mandates"][0]["mandate_id"] == "m1"


def test_standalone_mandates_join_the_embedded(spark, root, tmp_path):
    import shutil

    shutil.copytree(root / "data", tmp_path / "data")
    (tmp_path / "data/mandaten").mkdir()
    (tmp_path / "data/mandaten/m.yaml").write_text("person_id: person:q\nid: m9\npost_id: post:x\nstart_date: '2021-01-01'\n")
    assert {r["mandate_id"] for r in Dataset.local(spark, str(tmp_path)).mandaten.df.collect()} == {"m1", "m9"}


def test_columnar_landing_and_reload(spark, root, tmp_path):
    handle = Dataset.local(spark, str(root), str(tmp_path / "c"))
    assert handle.organisaties.df.count() == 2 and os.path.exists(tmp_path / "c/organisaties/_SUCCESS")
    handle.reload()
    assert not os.path.exists(tmp_path / "c/organisaties") and handle.organisaties.df.count() == 2


def test_rules(data):
    issues = quality.all_issues(data.organisaties.df, data.personen.df, data.posten.df, data.mandaten.df)
    found = {r["rule"]: r["n"] for r in quality.report(issues).collect()}
    assert found == {"mandate-org-missing": 1, "org-successor-missing": 1, "mandate-id-repeated": 1, "mandate-before-post": 1}


def test_json_store(spark, tmp_path):
    store = JsonStore(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        store.load("a.json")
    (tmp_path / "a.json").write_text('{"x": 1}\n')
    with pytest.raises(FileNotFoundError):  # failures are remembered
        store.load("a.json")
    store.preload("b.json")  # its failure is not
    (tmp_path / "b.json").write_text('{"x": 2}\n')
    assert store.load("b.json").first()["x"] == 2
    assert store.load("b.json") is store.load("b.json")


def test_targets(spark, data, tmp_path):
    tables = {"organisaties": data.organisaties.df.drop("_file"), "posten": data.posten.df.drop("_file")}
    build.main(tables, str(tmp_path))
    package = json.load(open(tmp_path / "datapackage/datapackage.json"))
    assert [r["name"] for r in package["resources"]] == ["organisaties", "posten"]
    assert spark.read.option("header", True).csv(str(tmp_path / "csv/posten")).first()["label"] == "X"
    with sqlite3.connect(tmp_path / "sqlite/register.sqlite") as db:
        assert db.execute("select id, seat_count from posten").fetchall() == [("post:x", 1)]
    assert JsonStore(spark, str(tmp_path / "viz")).load("posten.json").first()["id"] == "post:x"
    line = json.loads(spark.read.text(str(tmp_path / "jsonld/posten.jsonld")).first()[0])
    assert (line["@id"], line["@type"]) == ("post:x", "posten")


def test_diff_files(spark, tmp_path):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "id int, v string")
    assert build.write_diff(spark, old, new, "id", str(tmp_path)) == 3
    assert {r["id"] for r in spark.read.json(str(tmp_path / "proposals.json")).collect()} == {2, 3}


def test_command_line(spark, root, capsys):
    assert cli.main(["validate", "--data", str(root / "data")]) == 0
    assert "4 files" in capsys.readouterr().out
    assert cli.main(["validate", "--data", str(root / "data"), "--strict"]) == 1
    with pytest.raises(SystemExit):
        cli.main(["--help"])


def test_validate_takes_the_folder_that_it_is_given(spark, root, tmp_path, capsys):
    import shutil

    assert cli.main(["validate", "--data", str(tmp_path / "nosuch")]) == 2
    (tmp_path / "data").mkdir()
    assert cli.main(["validate", "--data", str(tmp_path / "data")]) == 2
    shutil.copytree(root / "data", tmp_path / "_cache")
    (tmp_path / "_cache/posten/deep/er/y.yaml").write_text("id: post:y\nlabel: [a]\nseat_count: many\ncolour: red\n")
    capsys.readouterr()
    assert cli.main(["validate", "--data", str(tmp_path / "_cache")]) == 1
    out = capsys.readouterr().out
    assert "5 files" in out and "error\tschema\t6" in out and "warning\tschema\t1" in out


def test_validate_reads_schema_files(spark, root, tmp_path, capsys):
    (tmp_path / "post.schema.json").write_text(json.dumps({"type": "object", "required": ["colour"], "properties": {"id": {"$ref": "#/$defs/id"}, "seat_count": {"enum": [2, 3]}}, "$defs": {"id": {"type": "string", "pattern": "^org:"}}}))
    assert cli.main(["validate", "--data", str(root / "data"), "--schemas", str(tmp_path)]) == 1
    assert "error\tschema\t3" in capsys.readouterr().out


def test_yaml_files_round_trip(spark, tmp_path):
    from tempora.sources import schema
    from tempora.sources.yaml_tree import read_tree

    rows = spark.createDataFrame([("post:a", "0123", 2), ("post:x:b", "né: 'q'\nz", None)], "id string, label string, seat_count int")
    assert build.build_yaml(rows, f"file://{tmp_path}/posten") == 2
    back = read_tree(spark, f"file://{tmp_path}/posten", schema.struct(schema.POSTS))
    assert sorted(r for r in back.select("id", "label", "seat_count").collect()) == sorted(r for r in rows.collect())


def test_pages_of_groups(spark):
    rows = spark.createDataFrame([("a", "b & co", "/x"), ("a", "Aa", ""), (None, "z", None), ("a", None, "/y")], "k string, l string, h string")
    pages = {r["k"]: (r["items"], r["html"]) for r in build.group_pages(rows, "k", "l", "h").collect()}
    assert pages == {"a": (2, '<h2>a (2)</h2><ul><li>Aa</li><li><a href="/x">b &amp; co</a></li></ul>'), "overig": (1, "<h2>overig (1)</h2><ul><li>z</li></ul>")}


@pytest.mark.parametrize("name", [m.name for m in pkgutil.iter_modules(fetchers.__path__)])
def test_feeds_keep_their_contract(name, capsys):
    module = importlib.import_module(f"tempora.fetchers.{name}")
    assert module.main() == 1 and "not yet implemented" in capsys.readouterr().out
    assert "Bron:" in module.__doc__ and "Endpoint" in module.__doc__ and "main" in module.__all__
