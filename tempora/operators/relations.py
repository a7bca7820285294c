"""Child tables of the nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import parse_date


def clean_mandates(rows: DataFrame) -> DataFrame:
    """Mandates with dates as dates. (person_id, pos) is the key; mandate_id may repeat."""
    return rows.select(
        "person_id",
        "pos",
        F.col("id").alias("mandate_id"),
        "organization_id",
        "post_id",
        "role",
        parse_date("start_date").alias("start_date"),
        parse_date("end_date").alias("end_date"),
        F.col("appointment.decision").alias("decision"),
        F.col("appointment.staatscourant_url").alias("gazette_url"),
        "confidence",
        "sources",
    )


def mandates(persons: DataFrame) -> DataFrame:
    exploded = persons.select(F.col("id").alias("person_id"), F.posexplode("mandaten").alias("pos", "m"))
    return clean_mandates(exploded.select("person_id", "pos", "m.*"))


def mandates_by_post(rows: DataFrame) -> DataFrame:
    """The mandates of each post as an array, by person and position. Arrays grow with their post: join on the key where one may be large."""
    each = F.struct("person_id", "pos", "mandate_id", "role", "start_date", "end_date")
    return rows.groupBy("post_id").agg(F.array_sort(F.collect_list(each)).alias("mandates"))


def org_names(orgs: DataFrame) -> DataFrame:
    rows = orgs.select(F.col("id").alias("org_id"), F.posexplode("names").alias("pos", "n"))
    return rows.select("org_id", "pos", "n.value", "n.abbr", parse_date("n.valid_from").alias("valid_from"), parse_date("n.valid_until").alias("valid_until"))


def _sources(rows: DataFrame, entity: str, key: str, parent: str | None = None) -> DataFrame:
    position = F.col(parent) if parent else F.lit(None).cast("int")
    exploded = rows.select(F.col(key).alias("entity_id"), position.alias("parent_pos"), F.posexplode("sources").alias("pos", "s"))
    return exploded.select(F.lit(entity).alias("entity"), "entity_id", "parent_pos", "pos", F.col("s.id").alias("source_id"), "s.url", parse_date("s.retrieved").alias("retrieved"), "s.fields")


def provenance(orgs: DataFrame, persons: DataFrame, posts: DataFrame, mandate_rows: DataFrame) -> DataFrame:
    """A row for each source of each record."""
    parts = [_sources(mandate_rows, "mandate", "person_id", "pos"), _sources(persons, "person", "id"), _sources(orgs, "organisation", "id"), _sources(posts, "post", "id")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def source_fields(sources: DataFrame) -> DataFrame:
    """A row for each field that a source backs; one with null for sources that name none."""
    return sources.select("entity", "entity_id", "parent_pos", "pos", F.explode_outer("fields").alias("field"))


def org_edges(orgs: DataFrame) -> DataFrame:
    """kind, src, dst for parents, successors and predecessors."""
    parent = orgs.where("parent_id is not null").select(F.lit("parent").alias("kind"), F.col("id").alias("src"), F.col("parent_id").alias("dst"))
    ahead = orgs.where("successor_id is not null").select(F.lit("successor").alias("kind"), F.col("id").alias("src"), F.col("successor_id").alias("dst"))
    back = orgs.select(F.lit("predecessor").alias("kind"), F.col("id").alias("src"), F.explode("predecessor_id").alias("dst"))
    return parent.unionByName(ahead).unionByName(back)


#: Arrays inside records that become child tables: name, then the column that holds the array.
ORG_CHILDREN = {
    "addresses": "contact.addresses",
    "phones": "contact.phones",
    "emails": "contact.emails",
    "internet_addresses": "contact.internet_addresses",
    "contact_forms": "contact.contact_forms",
    "social_media": "contact.social_media",
    "classifications": "classifications",
    "council_parties": "council.parties",
    "policy_areas": "policy_areas",
    "participants": "gr_meta.deelnemende_organisaties",
}


def org_children(orgs: DataFrame, name: str) -> DataFrame:
    rows = orgs.select(F.col("id").alias("org_id"), F.posexplode(ORG_CHILDREN[name]).alias("pos", "x"))
    return rows.select("org_id", "pos", "x.*")


def places(orgs: DataFrame) -> DataFrame:
    return orgs.select(F.col("id").alias("org_id"), F.posexplode("geography.bevat_plaatsen").alias("pos", "place"))


def legal_grounds(orgs: DataFrame) -> DataFrame:
    rows = orgs.select(F.col("id").alias("org_id"), F.posexplode("classifications").alias("pos", "c"))
    return rows.select("org_id", "pos", F.posexplode("c.wettelijke_grondslagen").alias("ground", "g")).select("org_id", "pos", "ground", "g.*")
