"""Operators on hand-made rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tempora.operators import budget, graph, quality, skills, stats, temporal
from tempora.operators.prefix import sum_before


def d(text):
    return dt.date.fromisoformat(text) if text else None


@pytest.mark.parametrize(
    ("row", "day", "active"),
    [
        ((None, None, "2024-01-01", "2024-06-30"), "2024-06-30", True),
        ((None, None, "2024-01-01", "2024-06-30"), "2024-07-01", False),
        ((None, None, "2024-01-01", "2024-06-30"), "2023-12-31", False),
        ((None, None, "2024-01-01", "2024-06-30"), "2024-01-01", True),
        ((None, None, None, None), "1800-01-01", True),
        ((None, None, "2024-01-01", "2024-06-30"), None, True),
        (("", None, "2030-01-01", None), "2024-01-01", True),
        ((None, None, "2030-01-01", None), "2024-01-01", False),
    ],
)
def test_as_of(spark, row, day, active):
    df = spark.createDataFrame([row], "valid_from string, valid_until string, start_date string, end_date string")
    assert (temporal.active_on(df, day).count() == 1) is active


def test_as_of_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(d("2024-01-01"), None)], "a date, b date").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).where(temporal.is_active_on(F.col("a"), F.col("b"), "2024-02-01"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(IsNull(a)" in plan


def test_current(spark):
    df = spark.createDataFrame([(None,), ("",), ("2999-01-01",), ("2000-01-01",)], "end_date string")
    assert temporal.current(df).count() == 2


def test_holders_counts_zero_for_posts_without_mandates(spark):
    posts = spark.createDataFrame([("a",), ("b",), ("c",)], "post_id string")
    mandates = spark.createDataFrame([("1", "a", None), ("2", "a", d("2020-01-01")), ("3", "b", d("2020-01-01"))], "mandate_id string, post_id string, end_date date")
    assert {r["post_id"]: r["holders"] for r in stats.holders_per_post(posts, mandates).collect()} == {"a": 1, "b": 0, "c": 0}


def test_group_default_keeps_the_empty_text(spark):
    df = spark.createDataFrame([(None,), ("",), ("x",)], "k string")
    assert {r["k"]: r["n"] for r in stats.count_by_default(df, "k").collect()} == {"overig": 1, "": 1, "x": 1}


def test_top_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(k, None) for k in "cab" for _ in range(3)], "k string, end_date date")
    assert [r["k"] for r in stats.top_by_count(df, "k", 2).orderBy("rank").collect()] == ["a", "b"]


def test_dutch_order(spark):
    df = spark.createDataFrame([(x,) for x in ("Écht", "zee", "Aa", "ab", "IJ", "ijs")], "s string")
    assert [r["s"] for r in df.orderBy(stats.dutch_order("s")).collect()] == ["Aa", "ab", "Écht", "IJ", "ijs", "zee"]


def test_sweep_equals_as_of_on_every_day(spark):
    rows = [(1, "2024-01-01", "2024-01-02"), (2, "2024-01-02", "2024-01-03"), (3, "2024-01-02", None), (4, "2024-01-05", "2024-01-05")]
    df = spark.createDataFrame([(i, d(a), d(b)) for i, a, b in rows], "i int, a date, b date")
    sweep = temporal.active_per_day(df, "a", "b")
    spine = spark.sql("select explode(sequence(date'2023-12-31', date'2024-01-08')) as day")
    daily = {r["day"]: r["active"] for r in temporal.on_every_day(sweep, spine).collect()}
    for day, active in daily.items():
        assert active == df.where(temporal.is_active_on(F.col("a"), F.col("b"), day)).count(), day


def test_overlap_and_containment(spark):
    df = spark.createDataFrame([("p", 1, d("2020-01-01"), d("2020-06-01")), ("p", 2, d("2020-06-01"), None), ("p", 3, d("2020-05-01"), d("2020-07-01"))], "k string, i int, a date, b date")
    assert {(r["a"], r["b"]) for r in temporal.overlapping_pairs(df, "k", "i", "a", "b").collect()} == {(1, 3), (2, 3)}
    outer = spark.createDataFrame([("p", d("2020-02-01"), d("2020-12-31"))], "k string, f date, u date")
    assert {(r["i"], r["early"], r["late"]) for r in temporal.not_contained(df, outer, "k", "a", "b", "f", "u").collect()} == {(1, True, False), (2, False, True)}


def test_latest_version_prefers_open_then_last_position(spark):
    df = spark.createDataFrame([("o", 0, "A", None, None), ("o", 1, "B", None, None), ("o", 2, "C", None, d("2020-01-01"))], "id string, pos int, value string, f date, u date")
    assert temporal.latest_version(df, "id", "f", "u", "pos").first()["value"] == "B"


def test_version_at(spark):
    names = spark.createDataFrame([("o", 0, "Old", None, d("2019-12-31")), ("o", 1, "New", d("2020-01-01"), None)], "id string, pos int, value string, f date, u date")
    facts = spark.createDataFrame([(1, "o", d("2019-05-01")), (2, "o", d("2021-05-01")), (3, "x", d("2021-05-01"))], "n int, id string, at date")
    assert {r["n"]: r["value"] for r in temporal.version_at(facts, names, "id", "at", "f", "u", "pos").collect()} == {1: "Old", 2: "New", 3: None}


@pytest.mark.parametrize(("limit", "admitted"), [(8, [True, True, False]), (0, [False] * 3), (None, [True] * 3)])
def test_budget(spark, limit, admitted):
    df = spark.createDataFrame([(i, Decimal(4)) for i in range(3)], "n int, cost decimal(18,2)")
    assert [r["admitted"] for r in budget.admit(df, "n", "cost", limit).orderBy("n").collect()] == admitted


def test_ledger():
    ledger = budget.CostLedger(8)
    for expected in (False, False, True):
        assert ledger.exceeded() is expected
        ledger.add(4)
    assert (ledger.spent_usd, ledger.limit_usd, ledger.charge(1)) == (12, 8, False)
    free = budget.CostLedger(None)
    assert not free.exceeded() and free.charge(5) and free.spent_usd == 5


def test_ledger_counts_every_thread():
    from concurrent.futures import ThreadPoolExecutor

    ledger = budget.CostLedger(10_000)
    with ThreadPoolExecutor(8) as pool:
        admitted = sum(pool.map(lambda _: ledger.charge(1), range(20_000)))
    assert admitted == ledger.spent_usd == 10_000


def test_prefix_sum_over_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("n"), F.lit(2).cast("long").alias("v"))
    assert all(r["before"] == 2 * r["n"] for r in sum_before(df, "n", "v", parts=16).collect())


def test_issues_and_exit_code(spark):
    warn = spark.createDataFrame([("warning", "r", "e", "k", "m")], "severity string, rule string, entity string, key string, message string")
    bad = warn.withColumn("severity", F.lit("error"))
    assert (quality.exit_code(warn), quality.exit_code(warn, strict=True), quality.exit_code(bad), quality.exit_code(warn.limit(0), True)) == (0, 1, 1, 0)


def test_diff_sees_nulls_and_changes(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, v string")
    new = spark.createDataFrame([(2, None), (3, "x"), (4, "d")], "id int, v string")
    assert {(r["id"], r["change"]) for r in quality.snapshot_diff(old, new, "id").collect()} == {(1, "removed"), (3, "changed"), (4, "added")}


def test_diff_takes_null_keys_as_keys(spark):
    old = spark.createDataFrame([(None, "a", None), (2, "b", 1)], "id int, v string, w int")
    new = spark.createDataFrame([(None, "a", None), (2, "b", None)], "id int, v string, w int")
    assert [(r["id"], r["change"]) for r in quality.snapshot_diff(old, new, "id").collect()] == [(2, "changed")]
    assert quality.snapshot_diff(old, new.where("id = 2"), "id").where("id is null").first()["change"] == "removed"


def test_crowded_keys_lose_no_pair(spark):
    import random

    rng, rows = random.Random(3), []
    for i in range(120):
        start = dt.date(2000, 1, 1) + dt.timedelta(days=rng.randrange(3000))
        end = None if rng.random() < 0.1 else start + dt.timedelta(days=rng.choice([0, 3, 400, 1500]))
        rows.append((rng.choice("aab"), i % 110, None if i == 7 else start, end))
    rows.append((None, 1, d("2000-01-01"), None))
    df = spark.createDataFrame(rows, "k string, i int, a date, b date")
    direct, sliced = (sorted((r["k"], r["a"], r["b"]) for r in temporal.overlapping_pairs(df, "k", "i", "a", "b", crowded=n).collect()) for n in (1000, 5))
    assert direct == sliced and len(direct) > 300


def test_version_at_equals_the_join(spark):
    import random

    rng, day = random.Random(4), lambda: dt.date(2000, 1, 1) + dt.timedelta(days=rng.randrange(400))
    versions = []
    for i in range(60):
        start = None if rng.random() < 0.1 else day()
        versions.append((rng.choice("abc"), i, start, None if rng.random() < 0.1 else (start or d("2000-01-01")) + dt.timedelta(days=rng.randrange(90)), {"n": i}))
    facts = [(n, rng.choice(["a", "b", "c", "x", None]), None if n == 5 else day()) for n in range(150)]
    found = temporal.version_at(spark.createDataFrame(facts, "n int, id string, at date"), spark.createDataFrame([*versions, (None, 99, None, None, {})], "id string, pos int, f date, u date, m map<string,int>"), "id", "at", "f", "u", "pos")
    expected = {}
    for n, key, at in facts:
        inside = [(u is None, u or dt.date.min, f or dt.date.min, p) for k, p, f, u, _ in versions if k == key and (f is None or (at and f <= at)) and (u is None or (at and u >= at))]
        expected[n] = max(inside)[3] if inside else None
    assert {r["n"]: r["pos"] for r in found.collect()} == expected
    assert all(r["m"] == ({"n": r["pos"]} if r["pos"] is not None else None) for r in found.collect())


def test_ranges_by_two_searches(spark):
    from tempora.operators.prefix import range_number

    cuts = [float(x * x) for x in range(50)]
    df = spark.createDataFrame([(float(v),) for v in range(-3, 2600, 7)], "v double").select("v", range_number(F.col("v"), cuts).alias("n"))
    assert all(r["n"] == sum(c <= r["v"] for c in cuts) for r in df.collect())


def test_hierarchy_with_dangling_parent_and_cycle(spark):
    df = spark.createDataFrame([("a", None), ("b", "a"), ("c", "gone"), ("x", "y"), ("y", "x")], "id string, parent string")
    assert {(r["node"], r["root"], r["depth"], r["path"]) for r in graph.hierarchy(df, "id", "parent").collect()} == {("a", "a", 0, "a"), ("b", "a", 1, "a/b"), ("c", "c", 0, "c")}


def test_chains_normalise_predecessors(spark):
    df = spark.createDataFrame([("a", "b", None), ("b", None, ["a"]), ("c", None, ["b"])], "id string, next string, before array<string>")
    found = graph.chains(graph.succession_edges(df, "id", "next", "before"))
    assert {(r["start"], r["node"], r["steps"]) for r in found.collect()} == {("a", "a", 0), ("a", "b", 1), ("a", "c", 2)}


def test_recursion_has_no_row_limit_and_tells_the_depth_cap(spark):
    df = spark.range(70).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"))
    edges = df.where("id > 0").select(F.col("parent").alias("src"), F.col("id").alias("dst"))
    spark.conf.set("spark.sql.cteRecursionRowLimit", "50")
    assert graph.hierarchy(df, "id", "parent", 69).count() == graph.chains(edges, 69).count() == 70
    for short in (graph.hierarchy(df, "id", "parent"), graph.chains(edges)):
        with pytest.raises(Exception, match="RECURSION_LEVEL_LIMIT_EXCEEDED"):
            short.collect()


def test_skill_answers_use_cache_and_budget(spark):
    rows = spark.createDataFrame([(1, "x", Decimal(4)), (2, "y", Decimal(4)), (3, "z", Decimal(4))], "n int, t string, cost decimal(18,2)")
    key = rows.where("n = 1").select(skills.content_hash(F.lit("s"), "t").alias("key"), F.lit("known").alias("answer"))
    found = skills.answers(rows, "t", "s", str.upper, cache=key, order="n", cost="cost", limit=4)
    assert {r["n"]: (r["answer"], r["cached"]) for r in found.collect()} == {1: ("known", True), 2: ("Y", False), 3: (None, False)}
    assert [r.cached for r in skills.run_skill("s", ["a", "a"])] == [False, True]
