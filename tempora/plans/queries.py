"""The register's operators over the driver's tables.

customer stands for posts, orders for mandates (ended unless their status is O), lineitem for validity intervals (open if the return
flag is N), part for a hierarchy. Every query runs over whole tables. Beside each stands DuckDB SQL for its rows.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import budget, graph, quality, stats, temporal
from ..streaming import windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def posts(spark, d) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_custkey").alias("post_id"), F.col("c_mktsegment").alias("classification"))


def mandates(spark, d) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("mandate_id"), F.col("o_custkey").alias("post_id"), day.alias("start_date"), F.when(F.col("o_orderstatus") != "O", F.date_add(day, 30)).alias("end_date"))


MANDATES = "(SELECT o_orderkey AS mandate_id, o_custkey AS post_id, o_orderdate::DATE AS start_date, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate::DATE + 30 END AS end_date FROM orders)"


def intervals(spark, d) -> DataFrame:
    return intervals_of(table(spark, d, "lineitem"))


def intervals_of(lines: DataFrame) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    return lines.select("l_orderkey", "l_linenumber", day.alias("start_date"), F.when(F.col("l_returnflag") != "N", F.date_add(day, F.col("l_quantity").cast("int"))).alias("end_date"))


INTERVALS = "(SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS start_date, CASE WHEN l_returnflag <> 'N' THEN l_shipdate::DATE + l_quantity::INTEGER END AS end_date FROM lineitem)"


# scans and unions


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def scan_parquet(spark, d):
    return table(spark, d, "nation")


@query("SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0")
def scan_project(spark, d):
    return table(spark, d, "customer").where("c_acctbal > 0").select("c_custkey", "c_name")


@query("SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def union_all(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


# filters


@query("SELECT event_id, user_id FROM events WHERE event_type = 'click'")
def filter_by_type(spark, d):
    return table(spark, d, "events").where(F.col("event_type") == "click").select("event_id", "user_id")


@query(f"SELECT l_orderkey, l_linenumber FROM {INTERVALS} WHERE start_date <= DATE '1996-03-01' AND (end_date IS NULL OR end_date >= DATE '1996-03-01')")
def asof_active(spark, d):
    started = table(spark, d, "lineitem").where(temporal.started_by("l_shipdate", "1996-03-01"))  # the half that the scan can test
    return intervals_of(started).where(temporal.is_active_on(F.col("start_date"), F.col("end_date"), "1996-03-01")).select("l_orderkey", "l_linenumber")


@query("SELECT o_orderkey AS mandate_id FROM orders WHERE o_orderstatus = 'O'")
def current_filter(spark, d):
    return temporal.current(mandates(spark, d)).select("mandate_id")


@query("SELECT page_id, coalesce(regexp_matches(html, '<[a-z]', 'i'), false) AS has_markup FROM pages")
def has_markup(spark, d):
    return table(spark, d, "pages").select("page_id", S.has_markup("html").alias("has_markup"))


QUERY_PART = r"[?]([^#]*)"
FRAGMENT_PART = r"#(.*)$"


@query(f"SELECT page_id, regexp_extract(url, '{QUERY_PART}', 1) <> '' OR regexp_extract(url, '{FRAGMENT_PART}', 1) <> '' AS has_any FROM pages")
def has_any(spark, d):
    params = F.filter(F.split(F.regexp_extract("url", QUERY_PART, 1), "&"), lambda p: p != "")
    return table(spark, d, "pages").select("page_id", S.any_present(F.regexp_extract("url", FRAGMENT_PART, 1), arrays=(params,)).alias("has_any"))


def entries(m) -> object:
    """A map as sorted text."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), "&")


@query("SELECT doc_id, concat_ws('&', CASE WHEN lang <> '' THEN 'lang=' || lang END, CASE WHEN source <> 'src0' THEN 'source=' || source END) AS entries FROM documents")
def map_filter_empty(spark, d):
    m = F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.when(F.col("source") == "src0", "").otherwise(F.col("source")), F.lit("none"), F.lit(None).cast("string"))
    return table(spark, d, "documents").select("doc_id", entries(S.drop_empty(m)).alias("entries"))


@query(f"SELECT page_id, len(list_filter(string_split(regexp_extract(url, '{QUERY_PART}', 1), '&'), lambda p: p <> '')) > 0 AS has_params FROM pages")
def array_nonempty(spark, d):
    params = F.filter(F.split(F.regexp_extract("url", QUERY_PART, 1), "&"), lambda p: p != "")
    return table(spark, d, "pages").select("page_id", S.array_nonempty(params).alias("has_params"))


@query("SELECT event_id, coalesce(sum(value::DECIMAL(18,2)) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 100000 AS admitted FROM events")
def budget_gate(spark, d):
    calls = table(spark, d, "events").select("event_id", F.col("value").cast("decimal(18,2)").alias("cost"))
    return budget.admit(calls, "event_id", "cost", Decimal(100000)).select("event_id", "admitted")


@query("SELECT o_orderkey, CASE WHEN o_orderdate::DATE = DATE '1995-06-17' THEN 'vandaag' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS label FROM orders")
def label_for(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.date_label(F.col("o_orderdate").cast("date"), F.lit("1995-06-17").cast("date")).alias("label"))


@query("SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)licensed|token')")
def keyword_prefilter(spark, d):
    return table(spark, d, "documents").where(F.col("text").rlike("(?i)licensed|token")).select("doc_id")


@query("SELECT event_id FROM events WHERE value >= 50")
def threshold_filter(spark, d):
    return table(spark, d, "events").where("value >= 50").select("event_id")


@query("SELECT o_orderkey, coalesce(nullif(CASE WHEN o_orderkey % 4 = 0 THEN '1900-01-01' ELSE strftime(o_orderdate, '%Y-%m-%d') END, '1900-01-01'), CASE WHEN o_orderkey % 8 = 0 THEN '1992-01-01' END) AS start FROM orders")
def sentinel_null(spark, d):
    stated = F.when(F.col("o_orderkey") % 4 == 0, S.SENTINEL_DATE).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, d, "orders").select("o_orderkey", S.without_sentinel(stated, F.when(F.col("o_orderkey") % 8 == 0, "1992-01-01")).alias("start"))


# joins


@query(f"SELECT c_custkey AS post_id, c_mktsegment AS classification, count(m.mandate_id) FILTER (WHERE m.end_date IS NULL) AS holders FROM customer LEFT JOIN {MANDATES} m ON m.post_id = c_custkey GROUP BY 1, 2")
def post_holders(spark, d):
    return stats.holders_per_post(posts(spark, d), mandates(spark, d))


@query("SELECT event_id, coalesce(c_name || CASE WHEN c_nationkey % 2 = 0 THEN ' (' || c_mktsegment || ')' ELSE '' END, user_id::VARCHAR) AS label FROM events LEFT JOIN customer ON c_custkey = user_id")
def lookup_fallback(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", F.when(F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment")).alias("abbr"))
    e = table(spark, d, "events").select("event_id", "user_id")
    return e.join(c, F.col("c_custkey") == F.col("user_id"), "left").select("event_id", S.name_with_abbr("c_name", "abbr", F.col("user_id").cast("string")).alias("label"))


@query(
    """WITH a AS (SELECT nullif(c_custkey, 11) AS id, c_name, c_acctbal FROM customer),
    b AS (SELECT CASE WHEN c_custkey % 5 = 0 THEN -1 - c_custkey ELSE nullif(c_custkey, 11) END AS id, c_name, CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer)
    SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.c_name IS NULL THEN 'added' WHEN b.c_name IS NULL THEN 'removed' ELSE 'changed' END AS change
    FROM a FULL JOIN b ON a.id IS NOT DISTINCT FROM b.id WHERE a.c_name IS NULL OR b.c_name IS NULL OR a.c_acctbal <> b.c_acctbal"""
)
def diff_full_outer(spark, d):
    return quality.snapshot_diff(*snapshots(spark, d), "id")


def snapshots(spark, d) -> tuple[DataFrame, DataFrame]:
    """All customers (one without an id), and all of them with a fifth of the ids and a third of the balances changed."""
    c = table(spark, d, "customer")
    known, balance = F.nullif(F.col("c_custkey"), F.lit(11).cast("long")), F.when(F.col("c_custkey") % 3 == 0, 0.0).otherwise(F.col("c_acctbal"))
    moved = F.when(F.col("c_custkey") % 5 == 0, -1 - F.col("c_custkey")).otherwise(known)
    return c.select(known.alias("id"), "c_name", "c_acctbal"), c.select(moved.alias("id"), "c_name", balance.alias("c_acctbal"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def orphans_anti(spark, d):
    return quality.orphans(table(spark, d, "documents").select("doc_id"), "doc_id", table(spark, d, "labels"), "doc_id")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT user_id FROM events)")
def used_semi(spark, d):
    return quality.referenced(table(spark, d, "customer").select("c_custkey"), "c_custkey", table(spark, d, "events"), "user_id")


@query("SELECT c.p_partkey, c.p_partkey // 10 AS parent, p.p_name AS parent_p_name FROM part c JOIN part p ON p.p_partkey = c.p_partkey // 10")
def parent_child(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name").withColumn("parent", F.expr("p_partkey div 10"))
    return quality.parent_child(p, "p_partkey", "parent", "p_name").select("p_partkey", "parent", "parent_p_name")


@query(f"SELECT x.l_orderkey, x.l_linenumber AS a, y.l_linenumber AS b FROM {INTERVALS} x JOIN {INTERVALS} y ON x.l_orderkey = y.l_orderkey AND x.l_linenumber < y.l_linenumber WHERE (y.end_date IS NULL OR x.start_date < y.end_date) AND (x.end_date IS NULL OR y.start_date < x.end_date)")
def interval_overlap(spark, d):
    return temporal.overlapping_pairs(intervals(spark, d), "l_orderkey", "l_linenumber", "start_date", "end_date")


@query(
    f"""SELECT l_orderkey, l_linenumber, start_date < o_orderdate::DATE AS early, end_date IS NULL OR end_date > o_orderdate::DATE + 120 AS late
    FROM {INTERVALS} JOIN orders ON o_orderkey = l_orderkey WHERE start_date < o_orderdate::DATE OR end_date IS NULL OR end_date > o_orderdate::DATE + 120"""
)
def interval_contain(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("since"), F.date_add(F.col("o_orderdate").cast("date"), 120).alias("until"))
    return temporal.not_contained(intervals(spark, d), o, "l_orderkey", "start_date", "end_date", "since", "until").select("l_orderkey", "l_linenumber", "early", "late")


@query(
    f"""WITH e AS (SELECT start_date AS day, 1 AS x FROM {INTERVALS} UNION ALL SELECT end_date + 1, -1 FROM {INTERVALS} WHERE end_date IS NOT NULL),
    s AS (SELECT day, sum(x) AS x FROM e GROUP BY day) SELECT day, CAST(sum(x) OVER (ORDER BY day) AS BIGINT) AS active FROM s"""
)
def active_per_day(spark, d):
    return temporal.active_per_day(intervals(spark, d), "start_date", "end_date")


@query(
    f"""WITH m AS {MANDATES}, j AS (SELECT f.mandate_id, v.mandate_id AS version, row_number() OVER (PARTITION BY f.mandate_id
      ORDER BY (v.end_date IS NULL) DESC, v.end_date DESC NULLS LAST, v.start_date DESC NULLS LAST, v.mandate_id DESC) AS n
    FROM m f LEFT JOIN m v ON v.post_id = f.post_id AND v.start_date <= f.start_date AND (v.end_date IS NULL OR v.end_date >= f.start_date))
    SELECT mandate_id, version FROM j WHERE n = 1"""
)
def asof_name(spark, d):
    m = mandates(spark, d)
    versions = m.select("post_id", F.col("mandate_id").alias("version"), F.col("start_date").alias("v_start"), F.col("end_date").alias("v_end"))
    return temporal.version_at(m, versions, "post_id", "start_date", "v_start", "v_end", "version").select("mandate_id", "version")


# aggregates


@query("SELECT o_orderpriority, count(*) AS n, CAST(GROUPING(o_orderpriority) AS INTEGER) AS is_total FROM orders GROUP BY ROLLUP (o_orderpriority)")
def group_count(spark, d):
    return stats.count_with_total(table(spark, d, "orders"), "o_orderpriority")


@query("SELECT coalesce(quality::VARCHAR, 'overig') AS quality, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def group_default(spark, d):
    joined = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return stats.count_by_default(joined.select(F.col("quality").cast("string")), "quality")


@query("SELECT DISTINCT event_type FROM events")
def distinct_types(spark, d):
    return stats.distinct_values(table(spark, d, "events"), "event_type")


@query("SELECT n_regionkey, string_agg(n_nationkey::VARCHAR, ',' ORDER BY n_nationkey) AS members FROM nation GROUP BY 1")
def group_collect(spark, d):
    found = stats.members(table(spark, d, "nation"), "n_regionkey", "n_nationkey")
    return found.select("n_regionkey", F.array_join(F.col("members").cast("array<string>"), ",").alias("members"))


@query(
    """SELECT severity, rule, count(*) AS n FROM (
      SELECT 'error' AS severity, 'ships-before-order' AS rule FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_shipdate < o_orderdate
      UNION ALL SELECT 'warning', 'line-repeated' FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
      UNION ALL SELECT 'warning', 'label-missing' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) GROUP BY 1, 2"""
)
def severity_rollup(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    early = lines.join(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), F.col("o_orderkey") == F.col("l_orderkey")).where("l_shipdate < o_orderdate")
    found = quality.issue(early, quality.ERROR, "ships-before-order", "line", "l_orderkey", "early")
    found = found.unionByName(quality.issue(stats.duplicate_keys(lines, "l_orderkey", "l_linenumber"), quality.WARNING, "line-repeated", "line", "l_orderkey", "repeated"))
    unlabelled = quality.orphans(table(spark, d, "documents").select("doc_id"), "doc_id", table(spark, d, "labels"), "doc_id")
    return quality.report(found.unionByName(quality.issue(unlabelled, quality.WARNING, "label-missing", "document", "doc_id", "no label")))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dup_keys(spark, d):
    return stats.duplicate_keys(table(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


@query(f"SELECT c_custkey AS post_id, CAST(nullif(c_custkey % 12, 0) AS BIGINT) AS seat_count, count(*) AS holders FROM customer JOIN {MANDATES} m ON m.post_id = c_custkey WHERE m.end_date IS NULL GROUP BY 1, 2 HAVING count(*) > nullif(c_custkey % 12, 0)")
def seat_overflow(spark, d):
    seats = posts(spark, d).select("post_id", F.nullif(F.col("post_id") % 12, F.lit(0).cast("long")).alias("seat_count"))
    return stats.seat_overflow(stats.holders_per_post(seats, mandates(spark, d)))


@query("SELECT o_orderpriority, count(*) AS n, max(o_orderdate)::DATE AS latest FROM orders GROUP BY 1")
def source_freshness(spark, d):
    o = table(spark, d, "orders").select("o_orderpriority", F.col("o_orderdate").cast("date").alias("day"))
    return stats.freshness(o, "o_orderpriority", "day")


@query("SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS F, count(*) FILTER (WHERE o_orderstatus = 'O') AS O, count(*) FILTER (WHERE o_orderstatus = 'P') AS P FROM orders GROUP BY 1")
def crosstab(spark, d):
    return stats.crosstab(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n, CAST(GROUPING(o_orderpriority, o_orderstatus) AS INTEGER) AS level FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)")
def cube_count(spark, d):
    return table(spark, d, "orders").cube("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("level"))


@query("SELECT o_custkey AS key FROM orders INTERSECT SELECT user_id FROM events")
def intersect_keys(spark, d):
    return table(spark, d, "orders").select(F.col("o_custkey").alias("key")).intersect(table(spark, d, "events").select("user_id"))


# windows, sorts


@query("SELECT c_custkey, CAST(ntile(4) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) AS INTEGER) AS quarter, CAST(rank() OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey) AS INTEGER) AS place FROM customer")
def quarter_in_group(spark, d):
    from pyspark.sql import Window

    group = Window.partitionBy("c_mktsegment")
    return table(spark, d, "customer").select("c_custkey", F.ntile(4).over(group.orderBy("c_acctbal", "c_custkey")).alias("quarter"), F.rank().over(group.orderBy("c_nationkey")).alias("place"))


TOP = f"SELECT post_id, count(*) AS total, count(*) FILTER (WHERE end_date IS NULL) AS current FROM {MANDATES} GROUP BY 1"


@query(f"SELECT CAST(row_number() OVER (ORDER BY total DESC, post_id) AS INTEGER) AS rank, * FROM ({TOP}) ORDER BY rank LIMIT 50")
def top_mandates(spark, d):
    return stats.top_by_count(mandates(spark, d), "post_id", 50)


@query(f"SELECT post_id, mandate_id FROM (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY (end_date IS NULL) DESC, end_date DESC NULLS LAST, start_date DESC NULLS LAST, mandate_id DESC) AS n FROM {MANDATES}) WHERE n = 1")
def latest_version(spark, d):
    return temporal.latest_version(mandates(spark, d), "post_id", "start_date", "end_date", "mandate_id").select("post_id", "mandate_id")


@query(
    f"""SELECT mandate_id, previous_end, next_start, CAST(start_date - previous_end AS INTEGER) AS gap_days FROM (
      SELECT *, lag(end_date) OVER w AS previous_end, lead(start_date) OVER w AS next_start FROM {MANDATES} WINDOW w AS (PARTITION BY post_id ORDER BY start_date, mandate_id))"""
)
def prev_next(spark, d):
    return temporal.neighbours(mandates(spark, d), "post_id", ["start_date", "mandate_id"], "start_date", "end_date").select("mandate_id", "previous_end", "next_start", "gap_days")


@query("SELECT n_regionkey, string_agg(n_name, ' · ' ORDER BY n_nationkey) AS list FROM nation GROUP BY 1")
def join_list(spark, d):
    return stats.joined_list(table(spark, d, "nation"), "n_regionkey", "n_name", "n_nationkey")


@query("SELECT n_name, CAST(row_number() OVER (ORDER BY lower(n_name) COLLATE nl, n_nationkey) AS INTEGER) AS place FROM nation")
def locale_sort(spark, d):
    from pyspark.sql import Window

    place = F.row_number().over(Window.orderBy(stats.dutch_order(F.lower("n_name")), "n_nationkey"))  # a list for display
    return table(spark, d, "nation").select("n_name", place.alias("place"))


@query("SELECT o_custkey AS c_custkey FROM orders EXCEPT ALL SELECT c_custkey FROM customer")
def diff_except(spark, d):
    return quality.added_keys(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


# scalars


@query("SELECT doc_id, concat_ws('&', 'a=1', CASE WHEN doc_id % 2 = 1 THEN 'lang=' || lang END, CASE WHEN doc_id % 3 > 0 THEN 'source=' || source END) AS entries FROM documents")
def map_merge(spark, d):
    old = F.create_map(F.lit("a"), F.lit("1"), F.lit("lang"), F.col("lang"), F.lit("source"), F.lit("old"))
    new = F.create_map(F.lit("source"), F.when(F.col("doc_id") % 3 > 0, F.col("source")).otherwise(""), F.lit("lang"), F.when(F.col("doc_id") % 2 == 1, F.col("lang")))
    return table(spark, d, "documents").select("doc_id", entries(S.merge_maps(old, new)).alias("entries"))


@query("SELECT o_orderkey, TRY_CAST(CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'x' WHEN 2 THEN '2020-13-01' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE) AS day FROM orders")
def parse_date(spark, d):
    k = F.col("o_orderkey") % 4
    return table(spark, d, "orders").select("o_orderkey", S.parse_date(F.when(k == 0, "").when(k == 1, "x").when(k == 2, "2020-13-01").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))).alias("day"))


@query("SELECT o_orderkey, strftime(make_timestamp(o_orderkey % 70000000 * 123456789 * 1000), '%Y-%m-%d') AS day FROM orders")
def iso_date(spark, d):
    instant = F.col("o_orderkey").cast("long") % 70_000_000 * 123456789  # more would not fit a timestamp's 64 bits of microseconds
    return table(spark, d, "orders").select("o_orderkey", S.iso_date(instant).alias("day"))


@query("SELECT unnest(generate_series(TIMESTAMP '1900-01-01', TIMESTAMP '2026-06-16', INTERVAL 1 DAY))::DATE AS day")
def date_spine(spark, d):
    return spark.range(1).select(F.explode(S.date_spine_array(last=F.lit("2026-06-16").cast("date"))).alias("day"))


@query("SELECT o_orderkey, replace(format('{:,}', (o_totalprice * 100)::BIGINT), ',', '.') AS text FROM orders")
def fmt_nl(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.dutch_number(F.round(F.col("o_totalprice") * 100)).alias("text"))


@query("SELECT event_id, concat_ws(' · ', CASE WHEN event_id % 3 > 0 THEN 'opgehaald ' || strftime(ts, '%Y-%m-%d') END, CASE WHEN event_id % 2 = 0 THEN 'velden: ' || event_type || ', value' END) AS note FROM events")
def concat_skip_null(spark, d):
    when = F.when(F.col("event_id") % 3 == 0, F.when(F.col("event_id") % 2 == 0, F.lit(""))).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    fields = F.when(F.col("event_id") % 2 == 0, F.array("event_type", F.lit("value")))
    return table(spark, d, "events").select("event_id", S.source_note(when, fields).alias("note"))


@query("SELECT p_partkey, 'sources[' || (i - 1) || ']' AS path, w AS word FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w, generate_subscripts(string_split(p_name, ' '), 1) AS i FROM part)")
def posexplode_path(spark, d):
    words = table(spark, d, "part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("i", "word"))
    return words.select("p_partkey", S.index_path("sources", "i").alias("path"), "word")


@query(
    """SELECT p_partkey, CASE WHEN p_size % 3 > 0 THEN p_brand || ': ' || p_type ELSE p_brand END AS label, coalesce(CASE WHEN p_size % 2 = 0 THEN p_name END, CASE WHEN p_size % 5 > 0 THEN p_type END) AS href,
    CASE WHEN p_size % 5 > 0 THEN p_brand END AS title FROM part"""
)
def nested_coalesce(spark, d):
    grounds = F.when(F.col("p_size") % 5 > 0, F.array(F.struct(F.col("p_type").alias("reference"), F.col("p_brand").alias("heading"))))
    p = table(spark, d, "part").withColumn("ground", F.get(grounds, F.lit(0)))
    value = F.when(F.col("p_size") % 3 > 0, F.col("p_type"))
    return p.select("p_partkey", S.labelled("p_brand", value).alias("label"), F.coalesce(F.when(F.col("p_size") % 2 == 0, F.col("p_name")), F.col("ground.reference")).alias("href"), F.col("ground.heading").alias("title"))


@query("SELECT conv_id, turn, CASE role WHEN 'user' THEN 'accent' WHEN 'assistant' THEN 'warning' ELSE 'neutral' END AS color FROM conversations")
def case_map(spark, d):
    tone = F.when(F.col("role") == "user", "lint").when(F.col("role") == "assistant", "warn").when(F.col("role") == "system", "default")
    return table(spark, d, "conversations").select("conv_id", "turn", S.tone_color(tone).alias("color"))


@query("SELECT page_id, regexp_replace(url, '/$', '') AS url FROM pages")
def trim_slash(spark, d):
    return table(spark, d, "pages").select("page_id", S.trim_slash("url").alias("url"))


@query("SELECT p_partkey, '/site/posten/' || lower(replace(p_brand, '#', '-')) || '/' AS url FROM part")
def build_url(spark, d):
    return table(spark, d, "part").select("p_partkey", S.post_url(F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit("-"))), "/site/").alias("url"))


@query("SELECT c_custkey, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_name END, concat_ws(' ', c_mktsegment, CASE WHEN c_custkey % 3 = 0 THEN 'van' END, c_custkey::VARCHAR)) AS name FROM customer")
def display_name(spark, d):
    full = F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise("")
    return table(spark, d, "customer").select("c_custkey", S.display_name(full, "c_mktsegment", F.when(F.col("c_custkey") % 3 == 0, "van"), F.col("c_custkey").cast("string")).alias("name"))


@query(
    f"""WITH p AS (SELECT page_id, unnest(string_split(q, '&')) AS p, generate_subscripts(string_split(q, '&'), 1) AS i FROM (SELECT page_id, regexp_extract(url, '{QUERY_PART}', 1) AS q FROM pages)),
    k AS (SELECT page_id, i, url_decode(split_part(p, '=', 1)) AS k, url_decode(split_part(p, '=', 2)) AS v FROM p WHERE split_part(p, '=', 1) <> '')
    SELECT page_id, k, v FROM (SELECT *, row_number() OVER (PARTITION BY page_id, k ORDER BY i DESC) AS n FROM k) WHERE n = 1"""
)
def parse_fragment(spark, d):
    m = S.parse_fragment(F.concat(F.lit("#"), F.regexp_extract("url", QUERY_PART, 1)))
    return table(spark, d, "pages").select("page_id", F.explode(m).alias("k", "v"))


@query(
    """SELECT p_partkey, '#q=' || replace(replace(replace(replace(replace(url_encode(p_name || ' (a&b)!~*'), '%21', '!'), '%27', ''''), '%28', '('), '%29', ')'), '%2A', '*') || '&brand=' || url_encode(p_brand) AS fragment FROM part"""
)
def encode_fragment(spark, d):
    m = F.create_map(F.lit("q"), F.concat("p_name", F.lit(" (a&b)!~*")), F.lit("brand"), F.col("p_brand"))
    return table(spark, d, "part").select("p_partkey", S.encode_fragment(m).alias("fragment"))


@query("SELECT p_partkey, p_name || CASE WHEN p_size % 7 > 0 THEN ' · ' || (p_size % 7) ELSE '' END AS text FROM part")
def optional_suffix(spark, d):
    return table(spark, d, "part").select("p_partkey", F.concat("p_name", S.optional_suffix(F.col("p_size") % 7)).alias("text"))


@query("SELECT p_partkey, regexp_replace(upper(regexp_replace(p_type, '[^\\p{L}]', '', 'g')), '(\\p{L})', '\\1.', 'g') AS initials FROM part")
def initials(spark, d):
    return table(spark, d, "part").select("p_partkey", S.format_initials("p_type").alias("initials"))


@query("SELECT p_partkey, upper(left(p_name, 1)) || substr(p_name, 2) AS name FROM part")
def leading_case(spark, d):
    return table(spark, d, "part").select("p_partkey", S.leading_case("p_name").alias("name"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 10 > 0 THEN p_retailprice END AS price FROM part")
def locale_decimal(spark, d):
    text = F.when(F.col("p_partkey") % 10 > 0, F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(","))).otherwise("16,9,6")
    return table(spark, d, "part").select("p_partkey", S.comma_decimal(text).alias("price"))


@query("SELECT p_partkey, 'brand=' || p_brand || '&confirmed=&size=' || p_size AS tags FROM part")
def tag_parse(spark, d):
    tags = F.array(F.concat(F.lit("size:"), F.col("p_size").cast("string")), F.lit("confirmed"), F.concat(F.lit("brand="), F.col("p_brand")))
    return table(spark, d, "part").select("p_partkey", entries(S.parse_tags(tags)).alias("tags"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_brand END AS party FROM part")
def regex_extract(spark, d):
    role = F.concat("p_name", F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(" ("), F.col("p_brand"), F.lit(")"))).otherwise(""))
    return table(spark, d, "part").select("p_partkey", S.party_in_role(role).alias("party"))


@query("SELECT o_orderkey, split_part(lower(o_orderpriority) || ':' || o_orderkey, ':', 1) AS namespace FROM orders")
def id_namespace(spark, d):
    made = F.concat(F.lower("o_orderpriority"), F.lit(":"), F.col("o_orderkey").cast("string"))
    return table(spark, d, "orders").select("o_orderkey", S.id_namespace(made).alias("namespace"))


@query(
    """WITH i AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'x-' || strftime(o_orderdate, '%Y') WHEN 1 THEN 'x-' || o_orderkey || '000' WHEN 2 THEN 'x-' || left(md5(o_orderkey::VARCHAR), 7) || 'a' ELSE o_orderpriority END AS id FROM orders)
    SELECT o_orderkey, CASE WHEN regexp_matches(id, '-(1[89]|20)[0-9]{2}$') THEN 'year' WHEN regexp_matches(id, '-[0-9]+$') THEN 'number' WHEN regexp_matches(id, '-[0-9a-f]{8}$') THEN 'hex' ELSE 'other' END AS kind FROM i"""
)
def id_class(spark, d):
    k, key = F.col("o_orderkey") % 4, F.col("o_orderkey").cast("string")
    made = F.when(k == 0, F.concat(F.lit("x-"), F.date_format("o_orderdate", "yyyy"))).when(k == 1, F.concat(F.lit("x-"), key, F.lit("000"))).when(k == 2, F.concat(F.lit("x-"), F.substring(F.md5(key), 1, 7), F.lit("a"))).otherwise(F.col("o_orderpriority"))
    return table(spark, d, "orders").select("o_orderkey", S.id_class(made).alias("kind"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate::DATE ELSE DATE '2026-05-17' END AS day FROM orders")
def initial_date(spark, d):
    k = F.col("o_orderkey") % 3
    return table(spark, d, "orders").select("o_orderkey", S.initial_date(F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 1, "soon"), F.lit("2026-05-17").cast("date")).alias("day"))


@query("SELECT p_partkey, sha256(length(p_name) || ':' || p_name || CASE WHEN p_size % 2 = 0 THEN length(p_brand) || ':' || p_brand ELSE '-' END || length(p_type) || ':' || p_type) AS hash FROM part")
def content_hash(spark, d):
    return table(spark, d, "part").select("p_partkey", S.content_hash("p_name", F.when(F.col("p_size") % 2 == 0, F.col("p_brand")), "p_type").alias("hash"))


# nested data and graphs


@query("SELECT doc_id, i - 1 AS pos, length(line) AS chars FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS INTEGER) AS i FROM documents)")
def explode_child(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.select("doc_id", "pos", F.length("line").cast("long").alias("chars"))


@query("SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(string_split(line, ' ')) AS word FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)) GROUP BY 1, 2")
def explode_nested(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    words = lines.select("doc_id", F.explode(F.split("line", " ")).alias("word"))
    return words.groupBy("doc_id", "word").agg(F.count("*").alias("n"))


@query(f"SELECT page_id, p AS param FROM pages LEFT JOIN LATERAL (SELECT unnest(string_split(regexp_extract(url, '{QUERY_PART}', 1), '&')) AS p) ON p <> ''")
def explode_outer(spark, d):
    params = F.filter(F.split(F.regexp_extract("url", QUERY_PART, 1), "&"), lambda p: p != "")
    return table(spark, d, "pages").select("page_id", F.explode_outer(params).alias("param"))


@query(
    """WITH RECURSIVE n AS (SELECT p_partkey AS node, nullif(p_partkey // 10, 0) AS parent FROM part), t AS (
      SELECT node, node AS root, 0 AS depth, node::VARCHAR AS path FROM n WHERE parent IS NULL OR parent NOT IN (SELECT node FROM n)
      UNION ALL SELECT n.node, t.root, t.depth + 1, t.path || '/' || n.node FROM t JOIN n ON n.parent = t.node) SELECT * FROM t"""
)
def recursive_tree(spark, d):
    return graph.hierarchy(table(spark, d, "part").select("p_partkey", F.expr("nullif(p_partkey div 10, 0)").alias("parent")), "p_partkey", "parent")


@query(
    """WITH RECURSIVE e AS (SELECT p_partkey AS src, p_partkey * 2 AS dst FROM part WHERE p_partkey % 3 > 0 UNION SELECT p_partkey // 2, p_partkey FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 6 > 0), w AS (
      SELECT DISTINCT src AS start, src AS node, 0 AS steps FROM e WHERE src NOT IN (SELECT dst FROM e)
      UNION ALL SELECT w.start, e.dst, w.steps + 1 FROM w JOIN e ON e.src = w.node) SELECT * FROM w"""
)
def recursive_chain(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 > 0, F.col("p_partkey") * 2).alias("next"), F.when((F.col("p_partkey") % 2 == 0) & (F.col("p_partkey") % 6 > 0), F.array(F.expr("p_partkey div 2"))).alias("before"))
    return graph.chains(graph.succession_edges(p, "p_partkey", "next", "before"))


# event windows (an addition: the register itself is refreshed in batches)


@query("SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS since, count(*) AS n FROM events GROUP BY 1, 2")
def event_windows(spark, d):
    return windows.tumbling(table(spark, d, "events"), "ts", "1 hour", "event_type").select("event_type", F.col("since").cast("timestamp_ntz").alias("since"), "n")


@query(
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM g)
    SELECT user_id, min(ts) AS since, count(*) AS n FROM s GROUP BY user_id, s"""
)
def event_sessions(spark, d):
    return windows.sessions(table(spark, d, "events"), "ts", "6 hours", "user_id").select("user_id", F.col("since").cast("timestamp_ntz").alias("since"), "n")
