"""Further queries over the driver's tables: files written and read back, nested records, calls, and what the register's pages do."""

from __future__ import annotations

import json
import sqlite3
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import own
from ..functions import scalars as S
from ..operators import joins, listeners, quality, relations, skills, stats
from ..sinks import build
from ..sources import schema, store
from ..sources.dataset import Dataset
from ..sources.json_store import JsonStore
from ..sources.yaml_tree import read_tree
from .queries import MANDATES, mandates, posts, query, snapshots, table

# sources and sinks


@query("SELECT 'post:' || s_suppkey AS id, s_name AS label, CAST(nullif(s_nationkey, 0) AS INTEGER) AS seat_count FROM supplier")
def yaml_records(spark, d):
    folder = store.scratch(spark)
    s = table(spark, d, "supplier")
    rows = s.select(F.concat(F.lit("post:"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("label"), F.nullif(F.col("s_nationkey"), F.lit(0)).alias("seat_count"))
    build.build_yaml(rows, f"{folder}/posten")
    return read_tree(spark, f"{folder}/posten", schema.struct(schema.POSTS)).select("id", "label", "seat_count")


def register(spark, d) -> Dataset:
    """Nations as persons whose mandates are their suppliers, regions as organisations and as mandates of their own, written as YAML files and opened."""
    root = store.scratch(spark)
    text = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    nothing = F.lit(None).cast("string")
    nation, supplier, region = (table(spark, d, t) for t in ("nation", "supplier", "region"))
    since = F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), F.col("s_suppkey").cast("int")), "yyyy-MM-dd")
    one = F.struct(
        text("m", "s_suppkey").alias("id"),
        F.lit("org:0").alias("organization_id"),
        text("post:", "s_suppkey").alias("post_id"),
        F.col("s_name").alias("role"),
        since.alias("start_date"),
        F.when(F.col("s_suppkey") % 2 == 0, since).alias("end_date"),
        F.array(F.struct(F.lit("feed").alias("id"), F.array(F.lit("role")).alias("fields"))).alias("sources"),
    )
    held = supplier.groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", one.alias("m")))).alias("all"))
    persons = nation.join(held, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    members = F.coalesce(F.transform("all", lambda x: x["m"]), F.array().cast(held.select(F.transform("all", lambda x: x["m"]).alias("a")).schema["a"].dataType))
    build.build_yaml(persons.select(text("person:", "n_nationkey").alias("id"), F.struct(F.col("n_name").alias("full")).alias("name"), members.alias("mandaten"), F.array().alias("sources")), f"{root}/data/personen")
    name = F.struct(F.col("r_name").alias("value"), F.substring("r_name", 1, 2).alias("abbr"), F.lit("2000-01-01").alias("valid_from"), nothing.alias("valid_until"))
    build.build_yaml(region.select(text("org:", "r_regionkey").alias("id"), F.lit("regio").alias("type"), F.lit("regio").alias("classification"), F.when(F.col("r_regionkey") > 0, F.lit("org:9")).alias("parent_id"), F.array(name).alias("names"), F.lit("2000-01-01").alias("valid_from"), nothing.alias("valid_until"), F.array().alias("sources")), f"{root}/data/organisaties")
    build.build_yaml(region.select(text("s", "r_regionkey").alias("id"), F.lit("person:0").alias("person_id"), F.lit("post:0").alias("post_id"), F.lit("1999-01-01").alias("start_date")), f"{root}/data/mandaten")
    return Dataset.open(spark, root)


REGISTER_SQL = """SELECT 'person:' || s_nationkey AS person_id, 'm' || s_suppkey AS mandate_id, 'post:' || s_suppkey AS post_id, DATE '2000-01-01' + CAST(s_suppkey AS INTEGER) AS start_date, CASE WHEN s_suppkey % 2 = 0 THEN DATE '2000-01-01' + CAST(s_suppkey AS INTEGER) END AS end_date FROM supplier
    UNION ALL SELECT 'person:0', 's' || r_regionkey, 'post:0', DATE '1999-01-01', NULL FROM region"""


@query(REGISTER_SQL)
def yaml_mandates(spark, d):
    return register(spark, d).mandaten.df.select("person_id", "mandate_id", "post_id", "start_date", "end_date")


@query(f"SELECT post_id, string_agg(mandate_id, ',' ORDER BY mandate_id) AS mandates FROM ({REGISTER_SQL}) GROUP BY 1")
def yaml_mandates_by_post(spark, d):
    found = register(spark, d).load_all()["mandates_by_post"]
    return found.select("post_id", F.array_join(F.array_sort(F.transform("mandates", lambda m: m["mandate_id"])), ",").alias("mandates"))


@query("SELECT 'org:' || r_regionkey AS id, 'regio' AS type FROM region")
def yaml_reload(spark, d):
    data = register(spark, d)
    landed = Dataset(spark, data.root, f"{data.root}/columnar")
    landed.organisaties.df.count()
    landed.reload()
    landed.views()
    return spark.sql("SELECT id, type FROM organisaties WHERE type = 'regio'")


@query("SELECT 'warning' AS severity, 'org-parent-missing' AS rule, count(*) AS n FROM region WHERE r_regionkey > 0 UNION ALL SELECT 'warning', 'mandate-post-missing', (SELECT count(*) FROM supplier) + (SELECT count(*) FROM region)")
def yaml_issues(spark, d):
    data = register(spark, d)
    return quality.report(quality.all_issues(data.organisaties.df, data.personen.df, data.posten.df, data.mandaten.df))


@query("SELECT c_custkey, c_name, c_mktsegment || ', \"' || c_nationkey || '\"' AS note FROM customer")
def sink_csv(spark, d):
    folder = store.scratch(spark)
    note = F.concat("c_mktsegment", F.lit(', "'), F.col("c_nationkey").cast("string"), F.lit('"'))
    build.build_csv({"customer": table(spark, d, "customer").select("c_custkey", "c_name", note.alias("note"))}, folder)
    return spark.read.option("header", True).option("escape", '"').schema("c_custkey long, c_name string, note string").csv(f"{folder}/customer")


@query("SELECT 'nation' AS resource, n_nationkey AS key, n_name AS name FROM nation UNION ALL SELECT 'region', r_regionkey, r_name FROM region")
def sink_datapackage(spark, d):
    folder = store.scratch(spark)
    tables = {"nation": table(spark, d, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name")), "region": table(spark, d, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))}
    package = json.loads(store.read_text(spark, build.build_datapackage(tables, folder)))
    kinds = {v: k for k, v in build.TABLE_TYPES.items() if k != "bigint"}
    found = []
    for r in package["resources"]:  # as many as tables
        fields = ", ".join(f"{f['name']} {kinds[f['type']]}" for f in r["schema"]["fields"])
        found.append(spark.read.option("header", True).schema(fields).csv([f"{folder}/{p}" for p in r["path"]]).select(F.lit(r["name"]).alias("resource"), "key", "name"))
    return found[0].unionByName(found[1])


@query("SELECT s_nationkey, count(*) AS n, min(s_name) AS first FROM supplier GROUP BY 1")
def sink_sqlite(spark, d):
    import tempfile

    with tempfile.TemporaryDirectory() as folder:  # the file is the driver's, as the sink states; no task opens it
        path = build.build_sqlite({"supplier": table(spark, d, "supplier")}, f"{folder}/register.sqlite")
        with sqlite3.connect(path) as db:
            rows = db.execute("SELECT s_nationkey, count(*), min(s_name) FROM supplier GROUP BY 1").fetchall()  # a row a nation
        db.close()
    return spark.createDataFrame(rows, "s_nationkey int, n long, first string")


@query("SELECT p_partkey, p_name, p_retailprice FROM part")
def sink_viz(spark, d):
    folder = store.scratch(spark)
    build.build_viz({"part": table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice")}, folder)
    return JsonStore(spark, folder).load("part.json", "p_partkey long, p_name string, p_retailprice double")


@query("SELECT 'nation:' || n_nationkey AS id, 'Country' AS type, n_name AS name FROM nation")
def sink_jsonld(spark, d):
    folder = store.scratch(spark)
    rows = table(spark, d, "nation").select(F.concat(F.lit("nation:"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_name").alias("name"))
    path = build.build_jsonld({"nation": rows}, folder, {"nation": "Country"})[0]
    part = lambda key: F.get_json_object("value", f"$['{key}']")
    return spark.read.text(path).select(part("@id").alias("id"), part("@type").alias("type"), part("name").alias("name"))


@query("SELECT target, r_regionkey FROM region, (VALUES ('csv'), ('viz')) t(target)")
def sink_all(spark, d):
    folder = store.scratch(spark)
    done = build.main({"region": table(spark, d, "region").select("r_regionkey")}, folder, ["csv", "viz"])
    csv = spark.read.option("header", True).schema("r_regionkey int").csv(done["csv"][0]).select(F.lit("csv").alias("target"), "r_regionkey")
    return csv.unionByName(spark.read.schema("r_regionkey int").json(done["viz"][0]).select(F.lit("viz").alias("target"), "r_regionkey"))


@query(
    """WITH a AS (SELECT nullif(c_custkey, 11) AS id, c_name, c_acctbal FROM customer),
    b AS (SELECT CASE WHEN c_custkey % 5 = 0 THEN -1 - c_custkey ELSE nullif(c_custkey, 11) END AS id, c_name, CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer)
    SELECT 'proposal' AS kind, b.id, b.c_name AS detail FROM b LEFT JOIN a ON a.id = b.id WHERE b.id IS NOT NULL AND (a.id IS NULL OR a.c_acctbal <> b.c_acctbal)
    UNION ALL SELECT 'diff', coalesce(a.id, b.id), CASE WHEN a.c_name IS NULL THEN 'added' WHEN b.c_name IS NULL THEN 'removed' ELSE 'changed' END
    FROM a FULL JOIN b ON a.id IS NOT DISTINCT FROM b.id WHERE a.c_name IS NULL OR b.c_name IS NULL OR a.c_acctbal <> b.c_acctbal"""
)
def sink_diff(spark, d):
    folder = store.scratch(spark)
    build.write_diff(spark, *snapshots(spark, d), "id", folder)
    found = spark.read.schema("id long, change string").json(f"{folder}/diff.json").select(F.lit("diff").alias("kind"), "id", F.col("change").alias("detail"))
    return found.unionByName(spark.read.schema("id long, c_name string").json(f"{folder}/proposals.json").select(F.lit("proposal").alias("kind"), "id", F.col("c_name").alias("detail")))


@query("SELECT n_regionkey AS region, count(*) AS items, '<h2>' || n_regionkey || ' (' || count(*) || ')</h2><ul>' || string_agg('<li><a href=\"/' || n_nationkey || '\">' || n_name || '</a></li>', '' ORDER BY lower(n_name)) || '</ul>' AS html FROM nation GROUP BY 1")
def page_html(spark, d):
    n = table(spark, d, "nation").select(F.col("n_regionkey").cast("string").alias("region"), "n_name", F.concat(F.lit("/"), F.col("n_nationkey").cast("string")).alias("href"))
    return build.group_pages(n, "region", "n_name", "href").withColumn("region", F.col("region").cast("int"))


# nested records


def nested(spark, d) -> DataFrame:
    """Parts as organisations with what organisations hold."""
    key, size = F.col("p_partkey").cast("string"), F.col("p_size")
    phone = lambda n: F.struct(F.col("p_brand").alias("label"), F.concat(key, F.lit(f"-{n}")).alias("nummer"))
    ground = F.struct(F.col("p_type").alias("opschrift"), key.alias("referentie"))
    source = F.struct(F.array("p_brand", "p_type").alias("fields"), F.lit("feed").alias("id"), F.lit("2024-01-02").alias("retrieved"), F.col("p_name").alias("url"))
    return table(spark, d, "part").select(
        F.concat(F.lit("org:"), key).alias("id"),
        F.struct(F.when(size % 3 > 0, F.array(phone(1), phone(2))).alias("phones")).alias("contact"),
        F.array(F.struct(F.col("p_type").alias("type"), F.when(size % 2 == 0, F.array(ground, ground)).alias("wettelijke_grondslagen"))).alias("classifications"),
        F.struct(F.split("p_name", " ").alias("bevat_plaatsen")).alias("geography"),
        F.struct(F.array(F.struct(F.col("p_size").alias("aantal_zetels"), F.col("p_brand").alias("naam"))).alias("parties")).alias("council"),
        F.array(F.struct(F.lit("P").alias("abbr"), F.lit("2000-01-01").alias("valid_from"), F.when(size % 2 == 0, F.lit("bad")).otherwise("2010-01-01").alias("valid_until"), F.col("p_name").alias("value"))).alias("names"),
        F.when(size % 4 > 0, F.array(source)).alias("sources"),
        F.when(F.col("p_partkey") > 9, F.concat(F.lit("org:"), F.expr("p_partkey div 10").cast("string"))).alias("parent_id"),
        F.lit(None).cast("string").alias("successor_id"),
        F.when(size % 5 == 0, F.array(F.lit("org:0"))).alias("predecessor_id"),
    )


@query("SELECT 'org:' || p_partkey AS org_id, CAST(i - 1 AS INTEGER) AS pos, p_brand AS label, p_partkey || '-' || i AS nummer FROM part, (VALUES (1), (2)) t(i) WHERE p_size % 3 > 0")
def org_phones(spark, d):
    return relations.org_children(nested(spark, d), "phones")


@query("SELECT 'org:' || p_partkey AS org_id, CAST(0 AS INTEGER) AS pos, i AS ground, p_type AS opschrift, p_partkey::VARCHAR AS referentie FROM part, (VALUES (0), (1)) t(i) WHERE p_size % 2 = 0")
def org_grounds(spark, d):
    return relations.legal_grounds(nested(spark, d))


@query("SELECT 'org:' || p_partkey AS org_id, CAST(0 AS INTEGER) AS pos, p_size AS aantal_zetels, p_brand AS naam FROM part")
def org_parties(spark, d):
    return relations.org_children(nested(spark, d), "council_parties")


@query("SELECT 'org:' || p_partkey AS org_id, CAST(unnest(range(len(string_split(p_name, ' ')))) AS INTEGER) AS pos, unnest(string_split(p_name, ' ')) AS place FROM part")
def org_places(spark, d):
    return relations.places(nested(spark, d))


@query("SELECT 'org:' || p_partkey AS org_id, CAST(0 AS INTEGER) AS pos, p_name AS value, 'P' AS abbr, DATE '2000-01-01' AS valid_from, CASE WHEN p_size % 2 > 0 THEN DATE '2010-01-01' END AS valid_until FROM part")
def org_name_versions(spark, d):
    return relations.org_names(nested(spark, d))


@query(
    """SELECT 'parent' AS kind, 'org:' || p_partkey AS src, 'org:' || p_partkey // 10 AS dst FROM part WHERE p_partkey > 9
    UNION ALL SELECT 'predecessor', 'org:' || p_partkey, 'org:0' FROM part WHERE p_size % 5 = 0"""
)
def org_links(spark, d):
    return relations.org_edges(nested(spark, d))


@query("SELECT 'org:' || p_partkey AS entity_id, unnest([p_brand, p_type]) AS field FROM part WHERE p_size % 4 > 0")
def source_field_rows(spark, d):
    o = nested(spark, d)
    none = o.limit(0)
    empty = none.select("id", F.lit(0).alias("pos"), F.lit(None).cast("string").alias("person_id"), "sources")
    rows = relations.provenance(o, none.select("id", "sources"), none.select("id", "sources"), empty)
    return relations.source_fields(rows).select("entity_id", "field")


@query(f"SELECT post_id, count(*) AS n, min(mandate_id) AS first FROM {MANDATES} GROUP BY 1")
def mandates_by_post(spark, d):
    m = mandates(spark, d).select("post_id", F.lit("p").alias("person_id"), F.col("mandate_id").alias("pos"), "mandate_id", F.lit("r").alias("role"), "start_date", "end_date")
    return relations.mandates_by_post(m).select("post_id", F.size("mandates").cast("long").alias("n"), F.col("mandates")[0]["mandate_id"].alias("first"))


# windows, groups and joins


@query(
    f"""SELECT mandate_id, CAST(round(percent_rank() OVER (PARTITION BY post_id ORDER BY start_date), 6) AS DOUBLE) AS place,
    count(*) OVER (PARTITION BY post_id ORDER BY start_date RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW) AS in_month FROM {MANDATES}"""
)
def rank_and_range(spark, d):
    post = Window.partitionBy("post_id")
    days = post.orderBy(F.unix_date("start_date")).rangeBetween(-30, 0)
    return mandates(spark, d).select("mandate_id", F.round(F.percent_rank().over(post.orderBy("start_date")), 6).alias("place"), F.count("*").over(days).alias("in_month"))


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderpriority), (o_orderstatus), ())")
def grouping_sets(spark, d):
    o = table(spark, d, "orders")
    sets = [[F.col("o_orderpriority")], [F.col("o_orderstatus")], []]
    return o.groupingSets(sets, "o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n")).select("o_orderpriority", "o_orderstatus", "n")


@query("SELECT o_orderpriority, count(DISTINCT o_orderstatus) AS kinds FROM orders GROUP BY 1")
def approx_kinds(spark, d):
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(F.approx_count_distinct("o_orderstatus", 0.01).alias("kinds"))


@query("SELECT n_regionkey, n_name, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY lower(n_name) COLLATE nl, n_nationkey) AS INTEGER) AS place FROM nation")
def sorted_in_groups(spark, d):
    order = Window.partitionBy("n_regionkey").orderBy(stats.dutch_order(F.lower("n_name")), "n_nationkey")
    return table(spark, d, "nation").select("n_regionkey", "n_name", F.row_number().over(order).alias("place"))


@query(f"SELECT post_id, total FROM (SELECT post_id, count(*) AS total FROM {MANDATES} GROUP BY 1) ORDER BY total DESC, post_id LIMIT 5")
def top_prefix(spark, d):
    return stats.top_by_count(mandates(spark, d), "post_id", 50).orderBy("rank").limit(5).select("post_id", "total")


@query("SELECT s.strategy, c_mktsegment, count(*) AS n FROM customer JOIN orders ON o_custkey = c_custkey, (VALUES ('auto'), ('broadcast'), ('hash'), ('sort_merge')) s(strategy) GROUP BY 1, 2")
def join_strategies(spark, d):
    p, found = posts(spark, d), []
    for strategy in ("auto", "broadcast", "hash", "sort_merge"):
        joined = joins.join_by(mandates(spark, d).select("post_id"), p, "post_id", strategy=strategy)
        found.append(joined.groupBy(F.lit(strategy).alias("strategy"), F.col("classification").alias("c_mktsegment")).agg(F.count("*").alias("n")))
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


@query("SELECT user_id, event_type FROM (SELECT user_id, event_type, arg_max(value >= 50, event_id) AS inside FROM events GROUP BY 1, 2) WHERE inside")
def listener_sets(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", "event_id", (F.col("value") >= 50).alias("added"))
    return listeners.members_after(e, "user_id", "event_type", "added", "event_id")


@query("SELECT event_id FROM (SELECT event_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS after FROM events) WHERE after IS NULL OR after >= ts + INTERVAL 6 HOUR")
def debounced_events(spark, d):
    return listeners.debounced(table(spark, d, "events"), "user_id", "ts", "6 hours", "event_id").select("event_id")


# calls and functions of users


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'known' WHEN spent < 20 THEN upper(s_name) END AS answer FROM (SELECT *, coalesce(sum(CASE WHEN s_suppkey % 4 > 0 THEN 1 ELSE 0 END) OVER (ORDER BY s_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM supplier)")
def skill_answers(spark, d):
    rows = table(spark, d, "supplier").select("s_suppkey", "s_name", F.lit(Decimal(1)).cast("decimal(18,2)").alias("cost"))
    known = rows.where("s_suppkey % 4 = 0").select(S.content_hash(F.lit("shout"), "s_name").alias("key"), F.lit("known").alias("answer"))
    return skills.answers(rows, "s_name", "shout", str.upper, cache=known, order="s_suppkey", cost="cost", limit=Decimal(20)).select("s_suppkey", "answer")


@query("SELECT n_nationkey, lower(n_name) AS answer FROM nation")
def skill_backfill(spark, d):
    return skills.backfill(table(spark, d, "nation"), "n_name", "whisper", str.lower, 3).select("n_nationkey", "answer")


@query("SELECT l_returnflag, max(l_quantity) - min(l_quantity) AS span, max(l_quantity) - min(l_quantity) AS built_in FROM lineitem GROUP BY 1")
def own_aggregate(spark, d):
    lines = table(spark, d, "lineitem").select("l_returnflag", "l_quantity")
    # the aggregate of a user sees a whole group at once: it gets the distinct values, of which there are few
    few = lines.distinct().groupBy("l_returnflag").agg(own.span("l_quantity").alias("span"))
    return few.join(lines.groupBy("l_returnflag").agg(own.span_of("l_quantity").alias("built_in")), "l_returnflag")


@query("SELECT n_nationkey, CAST(unnest(range(n_regionkey)) AS INTEGER) AS position FROM nation")
def own_table_function(spark, d):
    own.register(spark)
    table(spark, d, "nation").createOrReplaceTempView("tempora_nation")
    return spark.sql("SELECT n_nationkey, position FROM tempora_nation, LATERAL positions(n_regionkey)")


# scalars


@query("SELECT p_partkey, CASE WHEN p_size % 3 > 0 THEN '<a href=\"/' || p_partkey || '\">' || replace(p_brand, '#', '&amp;') || '</a>' END AS html FROM part")
def link_markup(spark, d):
    href = F.when(F.col("p_size") % 3 > 0, F.concat(F.lit("/"), F.col("p_partkey").cast("string"))).otherwise("")
    return table(spark, d, "part").select("p_partkey", S.link(href, F.replace(F.col("p_brand"), F.lit("#"), F.lit("&"))).alias("html"))


@query("SELECT c_custkey, '/r/organisaties/' || c_custkey || '/' AS org, '/r/personen/' || c_custkey || '/' AS person, coalesce(nullif(CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment WHEN c_custkey % 3 = 0 THEN '' END, ''), 'data') AS base FROM customer")
def site_urls(spark, d):
    key = F.col("c_custkey").cast("string")
    stated = F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).when(F.col("c_custkey") % 3 == 0, F.lit(""))
    return table(spark, d, "customer").select("c_custkey", S.org_url(key, "/r/").alias("org"), S.person_url(key, "/r").alias("person"), S.data_base(stated).alias("base"))


@query("SELECT p_partkey, upper(left(p_type, 1) || left(p_name, 1)) AS compact, upper(left(p_type, 1)) || '.' || upper(left(p_name, 1)) || '.' AS merged FROM part")
def initials_merged(spark, d):
    one, two = F.substring("p_type", 1, 1), F.concat(F.lower(F.substring("p_type", 1, 1)), F.lit(". "), F.substring("p_name", 1, 1))
    return table(spark, d, "part").select("p_partkey", S.compact_initials(two).alias("compact"), S.merge_initials(one, two).alias("merged"))


@query("SELECT p_partkey, array_to_string(string_split(p_name, ' '), '|') AS places, p_size % 2 = 0 AS postcode, CASE WHEN p_size % 3 > 0 THEN p_size::VARCHAR END AS decree FROM part")
def places_and_codes(spark, d):
    listed = F.concat(F.lit(" "), F.replace(F.col("p_name"), F.lit(" "), F.lit(", ")), F.lit(","))
    code = F.when(F.col("p_size") % 2 == 0, F.lit("1234 AB")).otherwise("1234AB")
    decree = F.when(F.col("p_size") % 3 > 0, F.concat(F.lit("Decree NR. "), F.col("p_size").cast("string"), F.lit(" of"))).otherwise("Decree of")
    return table(spark, d, "part").select("p_partkey", F.array_join(S.place_list(listed), "|").alias("places"), S.is_postcode(code).alias("postcode"), S.decree_number(decree).alias("decree"))
