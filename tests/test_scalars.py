"""The rules of single values, on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tempora.functions import scalars as S


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column.alias("x")).collect()]


CASES = [
    ("parse_date", "s string", [("",), ("x",), ("2020-13-01",), ("2020-01-01",), (None,)], lambda: S.parse_date("s"), [None, None, None, dt.date(2020, 1, 1), None]),
    ("iso_date", "s long", [(0,), (86_400_000 - 1,), (None,)], lambda: S.iso_date("s"), ["1970-01-01", "1970-01-01", None]),
    ("has_markup", "s string", [("0",), ("  ",), ("<p>",), ("<P ",), ("< p",), (None,)], lambda: S.has_markup("s"), [False, False, True, True, False, False]),
    ("tone", "s string", [("lint",), ("warn",), ("default",), (None,), ("other",)], lambda: S.tone_color("s"), ["accent", "warning", "neutral", "neutral", "neutral"]),
    ("source_note", "r string, f array<string>", [("2026-05-13", ["oin"]), (None, []), ("", ["a", "b"]), (None, None)], lambda: S.source_note("r", "f"), ["opgehaald 2026-05-13 · velden: oin", "", "velden: a, b", ""]),
    ("labelled", "t string, v string", [("T", None), ("T", "V"), ("T", "")], lambda: S.labelled("t", "v"), ["T", "T: V", "T"]),
    ("trim_slash", "s string", [("/a/",), ("/a",), ("/x//",)], lambda: S.trim_slash("s"), ["/a", "/a", "/x/"]),
    ("dutch_number", "n long", [(1234567,), (5,)], lambda: S.dutch_number("n"), ["1.234.567", "5"]),
    ("comma_decimal", "s string", [("16,96",), ("x",), (None,)], lambda: S.comma_decimal("s"), [16.96, None, None]),
    ("name", "n string, a string, i string", [("Name", "AB", "id"), ("Name", "", "id"), (None, None, "id")], lambda: S.name_with_abbr("n", "a", "i"), ["Name (AB)", "Name", "id"]),
    ("display_name", "f string, g string, i string, n string", [("", "An", None, "Bee"), ("Full", None, None, None), (None, None, None, None)], lambda: S.display_name("f", "g", "i", "n"), ["An Bee", "Full", None]),
    ("initials", "s string", [("w j",), ("W.J.",), ("é",)], lambda: S.format_initials("s"), ["W.J.", "W.J.", "É."]),
    ("merge_initials", "a string, b string", [("W.", "W.J."), ("W.J.", "W."), (None, "A"), ("X", "Y")], lambda: S.merge_initials("a", "b"), ["W.J.", "W.J.", "A.", "X."]),
    ("leading_case", "s string", [("de Vries",), ("",)], lambda: S.leading_case("s"), ["De Vries", ""]),
    ("suffix", "n int", [(1950,), (0,), (None,)], lambda: S.optional_suffix("n"), [" · 1950", "", ""]),
    ("id_class", "s string", [("person:a-1950",), ("person:a-6065947",), ("person:a-e3d384f2",), ("person:a",)], lambda: S.id_class("s"), ["year", "number", "hex", "other"]),
    ("namespace", "s string", [("post:senator",)], lambda: S.id_namespace("s"), ["post"]),
    ("postcode", "s string", [("1234 AB",), ("1234AB",)], lambda: S.is_postcode("s"), [True, False]),
    ("places", "s string", [("A, B,C",), ("",)], lambda: S.place_list("s"), [["A", "B", "C"], []]),
    ("sentinel", "s string", [("1900-01-01",), ("2001-01-01",)], lambda: S.without_sentinel("s"), [None, "2001-01-01"]),
    ("party", "s string", [("Member (ABC)",), ("Member",)], lambda: S.party_in_role("s"), ["ABC", None]),
    ("decree", "s string", [("Decree nr. 2019.123",), ("none",)], lambda: S.decree_number("s"), ["2019.123", None]),
    ("label", "d date", [(dt.date(2024, 1, 1),), (dt.date(2024, 1, 2),)], lambda: S.date_label("d", F.lit("2024-01-01").cast("date")), ["vandaag", "2024-01-02"]),
    ("initial", "s string", [("2020-01-01",), ("bad",), (None,)], lambda: S.initial_date("s", F.lit("2024-01-01").cast("date")), [dt.date(2020, 1, 1), dt.date(2024, 1, 1), dt.date(2024, 1, 1)]),
    ("fragment", "s string", [("#date=2020-01-01&x",), ("#a=1&a=2",), ("#a=b=c",), ("#=z",), ("#p=1+1",), ("",), ("#a%20b=%C3%A9",)], lambda: S.parse_fragment("s"), [{"date": "2020-01-01", "x": ""}, {"a": "2"}, {"a": "b"}, {}, {"p": "1+1"}, {}, {"a b": "é"}]),
    ("encode", "m map<string,string>", [({},), ({"k": "a b"},), ({"k": "!'()~*-_."},)], lambda: S.encode_fragment("m"), ["", "#k=a%20b", "#k=!'()~*-_."]),
    ("merge", "a map<string,string>, b map<string,string>", [({"a": "1", "b": "2"}, {"b": "", "c": None, "d": "4"})], lambda: S.merge_maps("a", "b"), [{"a": "1", "d": "4"}]),
    ("tags", "t array<string>", [(["a=1", "b:2", "c", "a=3"],)], lambda: S.parse_tags("t"), [{"b": "2", "c": "", "a": "3"}]),
    ("any", "u string, a array<string>", [("", []), (None, None), ("x", None), ("", ["y"])], lambda: S.any_present("u", arrays=("a",)), [False, False, True, True]),
]


@pytest.mark.parametrize(("schema", "rows", "column", "expected"), [c[1:] for c in CASES], ids=[c[0] for c in CASES])
def test_values(spark, schema, rows, column, expected):
    assert values(spark, rows, schema, column()) == expected


def test_encode_then_parse_gives_the_entries_back(spark):
    m = {"a b": "c&d=e", "é": "+%", "x": "#"}
    df = spark.createDataFrame([(m,)], "m map<string,string>")
    assert df.select(S.parse_fragment(S.encode_fragment("m")).alias("x")).first()[0] == m


def test_spine(spark):
    days = spark.range(1).select(F.explode(S.date_spine_array(last=F.lit("2026-06-16").cast("date"))).alias("d"))
    assert days.count() == 46_188


def test_content_hash_tells_all_parts_apart(spark):
    rows = [("a", None, "b"), ("a", "b", None), ("ab", None, None), ("a", "", "b"), ("a", "-", "b"), ("a1:b", None, None)]
    df = spark.createDataFrame([*rows, rows[0]], "x string, y string, z string")
    found = [r[0] for r in df.select(S.content_hash("x", "y", "z")).collect()]
    assert found[0] == found[-1] and len(set(found)) == len(rows)
