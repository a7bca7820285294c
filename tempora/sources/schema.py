"""The schemas of the register's records. Dates and identifiers stay text here: identifiers may begin with zeros, dates may be bad."""

from __future__ import annotations

from pyspark.sql import types as T

# The fields of the records as they are on file.
ORGANISATIONS = """
advisory_kind STRING,
afspraak STRUCT<email: STRING, telefoonnummer: STRING>,
classification STRING,
classifications ARRAY<STRUCT<eind_datum: STRING, type: STRING, url: STRING, wettelijke_grondslagen: ARRAY<STRUCT<opschrift: STRING, referentie: STRING>>>>,
contact STRUCT<addresses: ARRAY<STRUCT<huisnummer: STRING, huisnummer_toevoeging: STRING, land: STRING, openbare_ruimte: STRING, postbus: STRING, postcode: STRING, provincie: STRING, regio: STRING, toelichting: STRING, type: STRING, woonplaats: STRING>>, beschrijving: STRING, bezoekadres: STRING, contact_forms: ARRAY<STRUCT<label: STRING, url: STRING>>, email: STRING, emails: ARRAY<STRUCT<email: STRING, label: STRING>>, fax: STRING, internet_addresses: ARRAY<STRUCT<label: STRING, url: STRING>>, phones: ARRAY<STRUCT<label: STRING, nummer: STRING>>, postadres: STRING, social_media: ARRAY<STRUCT<gebruikersnaam: STRING, platform: STRING, url: STRING>>, website: STRING>,
council STRUCT<parties: ARRAY<STRUCT<aantal_zetels: INT, naam: STRING>>, total_seats: INT>,
description STRUCT<text: STRING, url: STRING>,
geography STRUCT<aantal_inwoners: INT, bevat_plaatsen: ARRAY<STRING>, bevat_plaatsen_raw: STRING, inwoners: STRING, inwoners_eenheid: STRING, inwoners_per_km2: DOUBLE, oppervlakte: STRING, oppervlakte_eenheid: STRING, oppervlakte_km2: DOUBLE>,
gr_meta STRUCT<bevoegdheidsverkrijgingen: ARRAY<STRING>, bronhouder: STRUCT<naam: STRING, owms: STRING, roo_id: STRING, tooi: STRING>, datum_inwerkingtreding: STRING, datum_uitwerkingtreding: STRING, deelnemende_organisaties: ARRAY<STRUCT<naam: STRING, owms: STRING, roo_id: STRING, toetredings_datum: STRING, tooi: STRING>>, instellingsbesluiten: ARRAY<STRING>, registratiehouder: STRING, samenwerkingsvorm: STRUCT<afkorting: STRING, value: STRING>, taalcode: STRING>,
hoort_bij_gemeenschappelijke_regeling STRUCT<naam: STRING, roo_id: STRING>,
id STRING,
identifiers STRUCT<atu: STRING, btw: STRING, ictu: STRING, kvk: STRING, oin: STRING, organisatiecode: STRING, owms: STRING, roo_id: STRING, rsin: STRING, tooi: STRING, wikidata: STRING>,
kaderwet STRUCT<kaderwetAdviescollege: STRUCT<kaderwetVanToepassing: STRING>, kaderwetZbo: STRUCT<afwijkendeBepalingKaderwet: STRUCT<artikel: STRING>, kaderwetVanToepassing: STRING>>,
last_mutation STRING,
last_verified STRING,
legal_form STRING,
names ARRAY<STRUCT<abbr: STRING, valid_from: STRING, valid_until: STRING, value: STRING>>,
organogram_url STRING,
parent_id STRING,
personnel STRUCT<aantalFte: STRING, peildatumFte: STRING>,
policy_areas ARRAY<STRUCT<naam: STRING, tooi: STRING>>,
predecessor_id ARRAY<STRING>,
relation_to_ministerie STRUCT<naam: STRING, owms: STRING, roo_id: STRING, tooi: STRING>,
roo_start_datum STRING,
sources ARRAY<STRUCT<fields: ARRAY<STRING>, id: STRING, retrieved: STRING, url: STRING>>,
subname STRING,
subtype STRING,
successor_id STRING,
taken_en_bevoegdheden STRING,
type STRING,
valid_from STRING,
valid_until STRING,
wettelijke_grondslagen ARRAY<STRUCT<opschrift: STRING, referentie: STRING>>,
zbo_kind STRING
"""

PERSONS = """
birth STRUCT<year: INT>,
gender STRING,
id STRING,
identifiers STRUCT<tk_persoon_id: STRING, wikidata: STRING>,
mandaten ARRAY<STRUCT<appointment: STRUCT<decision: STRING, staatscourant_url: STRING>, confidence: DOUBLE, end_date: STRING, id: STRING, organization_id: STRING, post_id: STRING, role: STRING, sources: ARRAY<STRUCT<fields: ARRAY<STRING>, id: STRING, retrieved: STRING, url: STRING>>, start_date: STRING>>,
name STRUCT<family: STRING, full: STRING, given: STRING, honorifics_post: ARRAY<STRING>, honorifics_pre: ARRAY<STRING>, initials: STRING, tussenvoegsel: STRING>,
sources ARRAY<STRUCT<fields: ARRAY<STRING>, id: STRING, retrieved: STRING, url: STRING>>
"""

POSTS = """
classification STRING,
id STRING,
label STRING,
organization_id STRING,
roo_functie_id STRING,
roo_naam STRING,
seat_count INT,
sources ARRAY<STRUCT<fields: ARRAY<STRING>, id: STRING, retrieved: STRING, url: STRING>>,
valid_from STRING,
valid_until STRING
"""

#: Folder and schema of each kind of record.
ENTITIES = {"organisaties": ORGANISATIONS, "personen": PERSONS, "posten": POSTS}


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(" ".join(ddl.split()))


def mandate() -> T.StructType:
    return struct(PERSONS)["mandaten"].dataType.elementType
