"""Queries of the canonical mapping, sinks, coverage, checks and incremental work."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import parse, text
from ..operators import incremental, lossrun, mapping, quality
from ..rules import coverage as cov_rules
from ..rules import mapping as rules
from ..session import run_folder
from ..sources import readers, sinks
from ..streaming import continuous
from . import reconciliation
from .registry import Inputs, query, rule_case, values

# Attribute fields of a submission: customers, several names per attribute, some empty.
NAMED = {
    "vlm_APPLICANT_INFORMATION_0_full_name": "CASE c_custkey % 4 WHEN 0 THEN c_name || ' LLC' WHEN 1 THEN '' END", "vlm_named_insured_name": "CASE c_custkey % 8 WHEN 1 THEN 'Fuzzy ' || c_custkey || ' Inc.' END",
    "NamedInsured_FullName_A[0]": "CASE c_custkey % 3 WHEN 0 THEN 'Beta ' || c_custkey || ' Trust 12 N Oak Ave' WHEN 1 THEN 'Gamma ' || c_custkey || ' L.P.' ELSE NULL END",
    "NamedInsured_FullName_B[0]": "CASE c_custkey % 5 WHEN 0 THEN 'SECONDARY' WHEN 1 THEN ' Other ' || c_custkey ELSE '' END",
    "NamedInsured_SICCode_A[0]": "CASE WHEN c_custkey % 2 = 0 THEN '6513' END", "vlm_applicant_address": "CASE c_custkey % 3 WHEN 0 THEN '12 Oak Ave, Suite 5, Springfield, NY 10001-1234' ELSE 'unknown place' END",
    "NamedInsured_AddressLine_CityName_A[0]": "CASE c_custkey % 6 WHEN 2 THEN 'Boxtown' END", "NamedInsured_MailingAddress_LineTwo_A[0]": "CASE c_custkey % 6 WHEN 1 THEN 'Linetown, CA 90210 x' END",
    "NamedInsured_MailingAddress_LineOne_A[0]": "CASE c_custkey % 6 WHEN 3 THEN 'Suite 9' END", "Producer_FullName_A[0]": "'Agent of ' || c_mktsegment", "vlm_HEADER_agency_name": "CASE c_custkey % 7 WHEN 0 THEN 'Header Agency' END",
    "Policy_EffectiveDate_A[0]": "CASE c_custkey % 2 WHEN 0 THEN '5/' || (c_custkey % 28 + 1) || '/24' END", "vlm_policy_effective": "CASE c_custkey % 3 WHEN 0 THEN '2023-01-05' ELSE 'soon' END", "vlm_policy_no": "'PN' || c_custkey"}
FLAGS = {"NamedInsured_LegalEntity_CorporationIndicator_A[0]": "c_custkey % 10 = 0", "NamedInsured_LegalEntity_PartnershipIndicator_A[0]": "c_custkey % 5 = 0", "Policy_LineOfBusinessIndicator_Property_A": "c_custkey % 4 = 0",
         "Policy_LineOfBusinessIndicator_CommercialGeneralLiability_A": "c_custkey % 6 = 0", "Alarm_CentralStationIndicator_A": "c_custkey % 3 = 0", "FireProtection_SprinklerIndicator_A": "c_custkey % 4 = 1"}
FIELDS = "SELECT c_custkey AS doc_id, 1 AS page_no, inline(array(" + ", ".join(
    [f"struct({i} AS ord, '{n}' AS name, {v} AS v_str, CAST(NULL AS BOOLEAN) AS v_bool, 'text' AS ftype)" for i, (n, v) in enumerate(NAMED.items())] +
    [f"struct({len(NAMED) + i} AS ord, '{n}' AS name, CAST(NULL AS STRING) AS v_str, {v} AS v_bool, 'checkbox' AS ftype)" for i, (n, v) in enumerate(FLAGS.items())]) + ")) FROM {customer}"
V = {k: f"nullif({v}, '')" for k, v in NAMED.items()}
MODEL_NAME = f"coalesce({V['vlm_APPLICANT_INFORMATION_0_full_name']}, {V['vlm_named_insured_name']})"
BOX_NAME = f"coalesce({V['NamedInsured_FullName_A[0]']}, {V['NamedInsured_FullName_B[0]']})"
INSURED = f"coalesce({MODEL_NAME}, CASE WHEN regexp_matches({BOX_NAME}, 'Ave') THEN regexp_extract({BOX_NAME}, '^(.*?)\\s+12 N', 1) ELSE {BOX_NAME} END)"


def fields(t: Inputs):
    """Customers are dealt before each becomes its fields, so picking from a document's fields moves none of them."""
    return t.sql(FIELDS, customer="c_custkey")


def application(t: Inputs):
    return mapping.application_blocks(fields(t))


@query("map1_priority_pick", f"SELECT c_custkey AS doc_id, {BOX_NAME} AS box_name, {V['NamedInsured_SICCode_A[0]']} AS sic FROM {{customer}}")
def _(t: Inputs):
    specs = {k: rules.PICKS[k] for k in ("box_name", "sic")}
    return fields(t).groupBy("doc_id").agg(*mapping.pick(specs))


@query("map2_fuzzy_pick", f"SELECT c_custkey AS doc_id, {MODEL_NAME} AS model_name, coalesce({V['Policy_EffectiveDate_A[0]']}, {V['vlm_policy_effective']}) AS effective FROM {{customer}}")
def _(t: Inputs):
    specs = {k: rules.PICKS[k] for k in ("model_name", "effective")}
    return fields(t).groupBy("doc_id").agg(*mapping.pick(specs))


FLAT = """SELECT o_orderkey AS doc_id, 1 AS page_no, '{"a":{"b":[' || o_custkey || ',0,""],"c":"' || o_orderstatus || '"},"t":true,"f":false,"n":null,"e":{}}' AS content FROM {orders}"""


@query("map3_flattened_pages", """SELECT o_orderkey AS doc_id, 'vlm_a_b_0' AS name, CAST(o_custkey AS VARCHAR) AS v_str, NULL::BOOLEAN AS v_bool FROM {orders} WHERE o_custkey <> 0 UNION ALL SELECT o_orderkey, 'vlm_a_c', o_orderstatus, NULL FROM {orders} UNION ALL SELECT o_orderkey, 'vlm_t', NULL, true FROM {orders}""")
def _(t: Inputs):
    return mapping.flatten_pages(t.sql(FLAT)).select("doc_id", "name", "v_str", "v_bool")


@query("map4_insured_name", f"SELECT c_custkey AS doc_id, {INSURED} AS insured_name FROM {{customer}}")
def _(t: Inputs):
    return application(t).select("doc_id", "insured_name")


ENTITY = rule_case("regexp_replace(upper(n), '[.,]', '', 'g')", rules.ENTITY_SUFFIXES, "Other")


@query("map5_entity_type", f"SELECT c_custkey AS doc_id, CASE WHEN c_custkey % 10 = 0 THEN 'Corporation' WHEN c_custkey % 5 = 0 THEN 'Partnership' ELSE {ENTITY} END AS entity_type FROM (SELECT c_custkey, {INSURED} AS n FROM {{customer}})")
def _(t: Inputs):
    return application(t).select("doc_id", "entity_type")


PARSED = "c_custkey % 3 = 0"
LINE = "c_custkey % 6 = 1"


@query("map6_insured_address", f"""SELECT c_custkey AS doc_id, CASE WHEN {PARSED} THEN '12 Oak Ave, Suite 5' WHEN regexp_matches(coalesce({BOX_NAME}, ''), 'Ave') THEN '12 N Oak Ave' END AS street,
CASE WHEN {PARSED} AND c_custkey % 6 = 3 THEN 'Suite 9' END AS street2, CASE WHEN c_custkey % 6 = 2 THEN 'Boxtown' WHEN {PARSED} THEN 'Springfield' WHEN {LINE} THEN 'Linetown' END AS city, CASE WHEN {PARSED} THEN 'NY' WHEN {LINE} THEN 'CA' END AS state,
CASE WHEN {PARSED} THEN '10001-1234' WHEN {LINE} THEN '90210' END AS zip FROM {{customer}}""")
def _(t: Inputs):
    return application(t).select("doc_id", "street", "street2", "city", "state", "zip")


@query("map7_agent", "SELECT c_custkey AS doc_id, CASE WHEN c_custkey % 7 = 0 THEN 'Header Agency' ELSE 'Agent of ' || c_mktsegment END AS agent_name FROM {customer}")
def _(t: Inputs):
    return application(t).select("doc_id", "agent_name")


@query("map8_policy", """SELECT c_custkey AS doc_id, CASE WHEN c_custkey % 2 = 0 THEN '2024-05-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') WHEN c_custkey % 3 = 0 THEN '2023-01-05' ELSE 'soon' END AS effective_date, 'PN' || c_custkey AS prior_policy_number FROM {customer}""")
def _(t: Inputs):
    return application(t).select("doc_id", "effective_date", "prior_policy_number")


@query("map9_lines_of_business", """SELECT c_custkey AS doc_id, CASE WHEN c_custkey % 12 = 0 THEN 'Property,General Liability' WHEN c_custkey % 4 = 0 THEN 'Property' WHEN c_custkey % 6 = 0 THEN 'General Liability' ELSE 'General Liability,Property' END AS lob FROM {customer}""")
def _(t: Inputs):
    return application(t).select("doc_id", F.array_join("lob", ",").alias("lob"))


# Interest blocks: the orders of a customer are the pages that name a party.
PARTY = {"FullName": "'Bank ' || o_orderkey % 3 || CASE WHEN o_orderkey % 3 = 0 THEN ' Mortgage LLC 918 Heron Road' ELSE ' Trust Co' END", "MailingAddress_LineOne": "CASE WHEN o_orderkey % 3 = 1 THEN 'Springfield, NY 10001' ELSE 'PO Box 7' END", "MailingAddress_LineTwo": "'County ' || o_orderkey % 3"}
PARTY_FLAGS = {"Interest_LossPayeeIndicator": "o_orderkey % 2 = 0", "Interest_MortgageeIndicator": "o_orderkey % 3 = 0", "CertificateRequiredIndicator": "o_orderkey % 5 = 0"}
PARTIES = "SELECT o_custkey AS doc_id, CAST(o_orderkey AS INT) AS page_no, inline(array(" + ", ".join([f"struct('AdditionalInterest_{n}_A[0]' AS name, {v} AS v_str, CAST(NULL AS BOOLEAN) AS v_bool)" for n, v in PARTY.items()] + [
    f"struct('AdditionalInterest_{n}_A[0]' AS name, CAST(NULL AS STRING) AS v_str, {v} AS v_bool)" for n, v in PARTY_FLAGS.items()]) + ")) FROM {orders}"


@query("map10_secured_parties", """WITH p AS (SELECT o_custkey AS doc_id, o_orderkey AS page_no, CASE o_orderkey % 3 WHEN 0 THEN 'Bank 0 Mortgage LLC' ELSE 'Bank ' || o_orderkey % 3 || ' Trust Co' END AS name, CASE WHEN o_orderkey % 3 = 0 THEN 'Mortgagee' WHEN o_orderkey % 2 = 0 THEN 'Loss Payee' END AS interest,
  o_orderkey % 5 = 0 AS certificate, CASE WHEN o_orderkey % 3 = 0 THEN 'Heron Road' END AS street, CASE WHEN o_orderkey % 3 <> 1 THEN 'PO Box 7' END AS street2, CASE WHEN o_orderkey % 3 = 1 THEN 'Springfield' END AS city, CASE WHEN o_orderkey % 3 = 1 THEN 'NY' END AS state,
  CASE WHEN o_orderkey % 3 = 1 THEN '10001' END AS zip, 'County ' || o_orderkey % 3 AS county FROM {orders})
SELECT doc_id, name, interest, arg_min(certificate, page_no) AS certificate, any_value(street) AS street, any_value(street2) AS street2, any_value(city) AS city, any_value(state) AS state, any_value(zip) AS zip, any_value(county) AS county, CAST(min(page_no) AS INT) AS first_page,
string_agg(page_no, ',' ORDER BY page_no) AS pages FROM p GROUP BY doc_id, name, interest""")
def _(t: Inputs):
    return mapping.secured_parties(t.sql(PARTIES)).withColumn("pages", F.array_join("pages", ","))


@query("map11_other_insureds", "SELECT c_custkey AS doc_id, '_B[0]' AS suffix, 'Other ' || c_custkey AS name FROM {customer} WHERE c_custkey % 5 = 1")
def _(t: Inputs):
    return mapping.other_insureds(fields(t))


HAZARDS = """SELECT l_orderkey AS doc_id, l_linenumber AS page_no, inline(array(struct('GeneralLiability_Hazard_Classification_A' AS name, CASE WHEN l_partkey % 3 = 0 THEN 'ROOF GARDEN 1 5 ' || (40000 + l_partkey % 9000) || ' T 1' ELSE 'Apartments - garden' END AS v_str),
  struct('GeneralLiability_Hazard_Exposure_A' AS name, CASE l_partkey % 4 WHEN 0 THEN '7,450 U' WHEN 1 THEN l_suppkey || '' ELSE 'see note' END AS v_str))) FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey FROM {lineitem} GROUP BY l_orderkey, l_linenumber)"""


@query("map12_hazards", """SELECT l_orderkey AS doc_id, l_linenumber AS page_no, '_A' AS suffix, CASE WHEN p % 3 = 0 THEN CAST(40000 + p % 9000 AS VARCHAR) ELSE 'Apartments - garden' END AS occupancy_class, CASE WHEN p % 3 = 0 THEN 'ROOF GARDEN' ELSE 'Apartments - garden' END AS description,
CASE p % 4 WHEN 0 THEN 7450 WHEN 1 THEN s END::DOUBLE AS exposure, CASE p % 4 WHEN 0 THEN '7,450 U' WHEN 1 THEN CAST(s AS VARCHAR) ELSE 'see note' END AS exposure_raw, CASE WHEN p % 3 = 0 THEN 'ROOF GARDEN 1 5 ' || (40000 + p % 9000) || ' T 1' ELSE 'Apartments - garden' END AS class_raw
FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS p, min(l_suppkey) AS s FROM {lineitem} GROUP BY l_orderkey, l_linenumber)""")
def _(t: Inputs):
    return mapping.hazards(t.sql(HAZARDS))


@query("map13_safeguards", "SELECT c_custkey AS doc_id, CASE WHEN c_custkey % 3 = 0 THEN 'Central Station Alarm' || CASE WHEN c_custkey % 4 = 1 THEN ',Sprinkler' ELSE '' END ELSE 'Sprinkler' END AS safeguards FROM {customer} WHERE c_custkey % 3 = 0 OR c_custkey % 4 = 1")
def _(t: Inputs):
    return mapping.document_safeguards(fields(t)).withColumn("safeguards", F.array_join("safeguards", ","))


@query("map14_building_description", """SELECT p_partkey AS doc_id, array_to_string(list_filter([CASE WHEN p_partkey % 3 > 0 THEN p_type END, CASE WHEN p_size % 4 > 0 THEN p_size % 4 || '-story ' || p_name ELSE p_name END, 'built ' || (1950 + p_size), CASE WHEN p_size % 5 > 0 THEN p_size % 5 || ' units' END], lambda x: x IS NOT NULL)[1:2], ' — ')
|| coalesce(' (' || nullif(array_to_string(list_filter([CASE WHEN p_partkey % 3 > 0 THEN p_type END, CASE WHEN p_size % 4 > 0 THEN p_size % 4 || '-story ' || p_name ELSE p_name END, 'built ' || (1950 + p_size), CASE WHEN p_size % 5 > 0 THEN p_size % 5 || ' units' END], lambda x: x IS NOT NULL)[3:], ', '), '') || ')', '') AS description FROM {part}""")
def _(t: Inputs):
    part = t.table("part")
    return part.select(F.col("p_partkey").alias("doc_id"), mapping.building_description(
        F.when(F.col("p_partkey") % 3 > 0, F.col("p_type")), F.col("p_size") % 4, F.col("p_name"), F.col("p_size") + 1950, F.col("p_size") % 5).alias("description"))


@query("map15_aggregate_income", "SELECT l_suppkey AS doc_id, nullif(CAST(sum(CASE WHEN l_suppkey % 4 = 0 THEN 0 ELSE CAST(l_quantity AS DECIMAL(18,2)) END) AS DOUBLE), 0) AS aggregate_income FROM {lineitem} GROUP BY l_suppkey")
def _(t: Inputs):
    return mapping.aggregate_income(t.sql("SELECT l_suppkey AS doc_id, CASE WHEN l_suppkey % 4 = 0 THEN 0.0D ELSE l_quantity END AS business_income FROM {lineitem}"))


@query("map17_submission_json", f"""WITH a AS (SELECT c_custkey AS doc_id, {INSURED} AS nm, CASE WHEN c_custkey % 10 = 0 THEN 'Corporation' WHEN c_custkey % 5 = 0 THEN 'Partnership' ELSE (SELECT {ENTITY} FROM (SELECT {INSURED} AS n)) END AS et FROM {{customer}})
SELECT c_custkey AS doc_id, a.nm AS insured_name, a.et AS entity_type, NOT (c_custkey % 4 = 0 AND c_custkey % 6 > 0) AS gl_selected, NOT (c_custkey % 6 = 0 AND c_custkey % 4 > 0) AS property_selected, 'New' AS renewal_flag,
(SELECT count(*) FROM {{orders}} o WHERE o.o_custkey = c.c_custkey)::INT AS n_loss_runs FROM {{customer}} c JOIN a ON a.doc_id = c.c_custkey""")
def _(t: Inputs):
    from .submission import assemble
    runs = t.sql("SELECT o_custkey AS doc_id, 'f' || o_orderkey AS source_file, o_orderstatus AS carrier FROM {orders}")
    nested = assemble(t.sql("SELECT c_custkey AS doc_id FROM {customer}"), application(t), loss_runs=runs)
    return nested.select("doc_id", F.col("Insured.Name").alias("insured_name"), F.col("Insured.EntityType").alias("entity_type"), F.col("Submission.GLSelected").alias("gl_selected"),
                         F.col("Submission.PropertySelected").alias("property_selected"), F.col("PolicyInfo.RenewalFlag").alias("renewal_flag"), F.coalesce(F.size("LossRuns"), F.lit(0)).alias("n_loss_runs"))


@query("snk1_counts_by_type", "SELECT coalesce(nullif(o_orderpriority, '5-LOW'), 'unknown') AS doc_type, count(*) AS n_files FROM {orders} GROUP BY 1")
def _(t: Inputs):
    return sinks.counts_by_type(t.sql("SELECT o_orderkey AS doc_id, nullif(o_orderpriority, '5-LOW') AS doc_type FROM {orders}"))


@query("snk2_json_without_nulls", """SELECT o_orderkey AS doc_id, '{' || CASE WHEN o_orderkey % 2 = 0 THEN '"status":"' || o_orderstatus || '",' ELSE '' END || '"customer":' || o_custkey || ',"inner":{' || CASE WHEN o_orderkey % 3 = 0 THEN '"p":"' || o_orderpriority || '"' ELSE '' END || '}}' AS content FROM {orders}""")
def _(t: Inputs):
    records = t.table("orders").select(F.col("o_orderkey").alias("doc_id"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("status"), F.col("o_custkey").alias("customer"),
                                       F.struct(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("p")).alias("inner"))
    return sinks.as_json(records, ["doc_id"])


NAMES = "SELECT page_id AS doc_id, 'LR (' || page_id || ') é ' || url || '.pdf' AS name FROM {pages}"


@query("snk3_safe_names", f"""SELECT doc_id, replace(replace(replace(replace(replace(name, ' ', '_'), '(', ''), ')', ''), '.pdf', ''), '.PDF', '') AS document_name, trim(regexp_replace(name, '[^A-Za-z0-9._-]+', '_', 'g'), '_') AS path_name FROM ({NAMES})""")
def _(t: Inputs):
    return t.sql(NAMES).select("doc_id", text.safe_name_document("name").alias("document_name"), text.safe_name_path("name").alias("path_name"))


SCALARS = "SELECT o_orderkey AS doc_id, CAST(month(o_orderdate) AS STRING) || '/' || CAST(day(o_orderdate) AS STRING) || '/' || lpad(CAST(o_custkey % 100 AS STRING), 2, '0') AS d, '$1,' || (100 + o_custkey % 900) || '.9' AS m, 'Aa_LimitedLiability' || o_orderstatus || '_A' AS f, 'open w/PAYMENT ' || lower(o_orderpriority) AS s, month(o_orderdate) AS mo, day(o_orderdate) AS da, o_custkey % 100 AS yy FROM {orders}"


@query("fn_scalar_parsing", f"""SELECT doc_id, CASE WHEN mo = 2 AND da = 29 AND yy % 4 > 0 THEN d ELSE CASE WHEN yy >= 69 THEN '19' ELSE '20' END || lpad(CAST(yy AS VARCHAR), 2, '0') || '-' || lpad(CAST(mo AS VARCHAR), 2, '0') || '-' || lpad(CAST(da AS VARCHAR), 2, '0') END AS parsed_date, CAST(replace(replace(m, ',', ''), '$', '') AS DOUBLE) AS money, NULL::BIGINT AS int_of_money,
'aa_limited liability' || lower(substr(f, 20, 1)) || '_a' AS words, 'Aa_LimitedLiability' || substr(f, 20, 1) AS label, 'Open W/Payment ' || upper(substr(s, 16, 3)) || substr(s, 19) AS title FROM ({SCALARS})""".replace("'aa_limited liability' || lower(substr(f, 20, 1)) || '_a'", "'aa_limited liability ' || lower(substr(f, 20, 1)) || '_a'").replace(
    "'Open W/Payment ' || upper(substr(s, 16, 3)) || substr(s, 19)", "'Open W/Payment ' || substr(s, 16, 2) || array_to_string(list_transform(string_split(substr(s, 18), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"))
def _(t: Inputs):
    return t.sql(SCALARS).select("doc_id", parse.parse_date("d").alias("parsed_date"), parse.safe_float("m").alias("money"), parse.safe_int("m").alias("int_of_money"), text.camel_words("f").alias("words"), text.short_label("f").alias("label"), text.title_case("s").alias("title"))


# Coverage: submissions built from orders; locations and buildings come and go by key arithmetic.
RECORDS = """SELECT o_orderkey AS doc_id, '{"Submission":{"Status":"Cleared","Notes":"' || CASE WHEN o_custkey % 2 = 0 THEN 'n' ELSE '' END || '","GLSelected":false},"Insured":{"Name":"x","Addresses":' || CASE WHEN o_custkey % 3 = 0 THEN '[]' ELSE '[{"City":"c"}]' END || '},"Locations":['
  || CASE WHEN o_custkey % 4 = 0 THEN '' ELSE '{"LocationNumber":1,"Address":{"City":"c"},"Buildings":[{"BuildingNumber":0,"Building":{"BuildingLimit":' || CASE WHEN o_custkey % 2 = 0 THEN '5' ELSE 'null' END || '}},{"BuildingNumber":2}]}' END || ']}' AS content FROM {orders}"""
SCHEMA = values("s", "section, field, tier", cov_rules.SCHEMA_FIELDS)
COVERAGE = f"""o AS (SELECT o_orderkey AS doc_id, o_custkey % 2 = 0 AS even, o_custkey % 3 > 0 AS addr, o_custkey % 4 > 0 AS loc FROM {{orders}}),
cov AS (SELECT o.doc_id, s.section, s.field, s.tier, CASE WHEN NOT ends_with(s.section, '[]') THEN 1 WHEN s.section = 'Locations[]' AND loc THEN 1 WHEN s.section = 'Buildings[]' AND loc THEN 2 ELSE 0 END AS n_items,
 CASE WHEN s.section = 'Submission' AND s.field IN ('Status', 'GLSelected') THEN 1 WHEN s.section = 'Submission' AND s.field = 'Notes' AND even THEN 1 WHEN s.section = 'Insured' AND s.field = 'Name' THEN 1 WHEN s.section = 'Insured' AND s.field = 'Addresses' AND addr THEN 1
 WHEN s.section = 'Locations[]' AND loc AND s.field IN ('LocationNumber', 'Address') THEN 1 WHEN s.section = 'Buildings[]' AND loc AND s.field = 'BuildingNumber' THEN 2 WHEN s.section = 'Buildings[]' AND loc AND even AND s.field = 'Building.BuildingLimit' THEN 1 ELSE 0 END AS populated FROM o, {SCHEMA})"""


def coverage(t: Inputs):
    records = t.dealt(RECORDS)
    return quality.coverage(quality.field_presence(records, ["doc_id"]), records, ["doc_id"])


@query("agg2_section_coverage", f"WITH {COVERAGE} SELECT doc_id, section, CAST(sum(populated) AS BIGINT) AS populated, CAST(sum(greatest(n_items, 1)) AS BIGINT) AS total FROM cov GROUP BY doc_id, section")
def _(t: Inputs):
    return quality.section_coverage(coverage(t), ["doc_id"])


@query("agg3_field_marks", f"WITH {COVERAGE} SELECT doc_id, section, field, CASE WHEN n_items > 0 AND populated = n_items THEN 'all' WHEN populated > 0 THEN 'some' ELSE 'none' END AS mark FROM cov")
def _(t: Inputs):
    return coverage(t).select("doc_id", "section", "field", "mark")


@query("agg4_tier_coverage", f"""WITH {COVERAGE}, x AS (SELECT doc_id, tier, CAST(sum(populated) AS BIGINT) AS populated, CAST(sum(n_items) AS BIGINT) AS total FROM cov GROUP BY doc_id, tier)
SELECT * FROM x UNION ALL SELECT doc_id, 'reachable', CAST(sum(populated) AS BIGINT), CAST(sum(total) AS BIGINT) FROM x WHERE tier IN ('HIGH', 'MEDIUM', 'LOW') GROUP BY doc_id""")
def _(t: Inputs):
    return quality.tier_coverage(coverage(t), ["doc_id"])


@query("qc3_populated_fields", f"WITH {COVERAGE} SELECT doc_id, section, field, CAST(populated AS BIGINT) AS populated FROM cov WHERE populated > 0")
def _(t: Inputs):
    return coverage(t).where("populated > 0").select("doc_id", "section", "field", "populated")


PART = "SELECT p_brand AS template, CAST(p_size % 4 AS INT) AS tpage, p_type || '_' || p_name AS name, CASE WHEN p_partkey % 3 = 0 THEN '/Btn' ELSE '/Tx' END AS ftype FROM {part}"


@query("agg5_template_inventory", f"SELECT template, tpage, count(*) AS n_fields, count(*) FILTER (ftype = '/Btn') AS n_checkboxes, count(*) FILTER (ftype <> '/Btn') AS n_text_fields FROM ({PART}) GROUP BY ROLLUP (template, tpage)")
def _(t: Inputs):
    return quality.template_inventory(t.sql(PART))


@query("agg5_top_sections", f"SELECT split_part(name, '_', 1) AS section, count(*) AS n_fields FROM ({PART}) GROUP BY 1 ORDER BY n_fields DESC, section LIMIT 10")
def _(t: Inputs):
    return quality.top_sections(t.sql(PART))


@query("agg5_densest_pages", f"SELECT template, tpage, count(*) AS n_fields FROM ({PART}) GROUP BY 1, 2 ORDER BY n_fields DESC, template, tpage LIMIT 20")
def _(t: Inputs):
    return quality.densest_pages(t.sql(PART))


@query("agg6_class_shares", "SELECT lang, count(*) AS n, round(count(*) / (SELECT count(*) FROM {documents}), 9) AS share FROM {documents} GROUP BY lang")
def _(t: Inputs):
    return quality.class_shares(t.table("documents"), "lang").withColumn("share", F.round("share", 9))


RUNS = "SELECT user_id AS doc_id, event_type AS mode, CASE WHEN value > 20 THEN 'OK' ELSE 'RAW' END AS status FROM {events}"


@query("agg7_run_summary", f"SELECT doc_id, mode, count(*) FILTER (status = 'OK') AS ok_pages, count(*) AS pages, round(count(*) FILTER (status = 'OK') / count(*), 9) AS ok_rate FROM ({RUNS}) GROUP BY GROUPING SETS ((doc_id, mode), (mode), ())")
def _(t: Inputs):
    return quality.run_summary(t.sql(RUNS)).withColumn("ok_rate", F.round("ok_rate", 9))


USED = "SELECT 'part_' || p_partkey AS name, CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE 'x' END AS v_str, CASE p_partkey % 4 WHEN 0 THEN true WHEN 1 THEN false END AS v_bool FROM {part} UNION ALL SELECT 'vlm_' || s_suppkey, 'y', NULL FROM {supplier}"
MAPPED = "SELECT 'part_' || l_partkey AS name FROM {lineitem} WHERE l_quantity > 49 UNION ALL SELECT 'vlm_' || l_suppkey FROM {lineitem} WHERE l_quantity > 49.5"


@query("agg8_mapping_usage", f"""WITH u AS (SELECT DISTINCT name, CASE WHEN starts_with(name, 'vlm_') THEN 'model' WHEN v_bool THEN 'checkbox true' WHEN NOT v_bool THEN 'checkbox false' ELSE 'text' END AS category FROM ({USED})), m AS (SELECT DISTINCT name FROM ({MAPPED}))
SELECT category, count(*) AS extracted, count(m.name) AS mapped, count(*) - count(m.name) AS unmapped FROM u LEFT JOIN m ON u.name = m.name GROUP BY ROLLUP (category)""")
def _(t: Inputs):
    return quality.mapping_usage(t.sql(USED), t.sql(MAPPED))


@query("agg9_text_layer_summary", """WITH p AS (SELECT o_custkey AS doc_id, count(*) AS pages, count(*) FILTER (o_orderstatus = 'P') AS garbled FROM {orders} GROUP BY 1), c AS (SELECT c_custkey AS doc_id, c_nationkey AS n FROM {customer} WHERE c_custkey % 2 = 0)
SELECT p.doc_id, p.pages, p.garbled AS garbled_pages, (SELECT count(DISTINCT o_orderkey % 3) FROM {orders} o WHERE o.o_custkey = p.doc_id) AS tables, (SELECT count(*) FROM c WHERE c.doc_id = p.doc_id) AS claim_rows FROM p""")
def _(t: Inputs):
    pages = t.sql("SELECT o_custkey AS doc_id, o_orderkey AS page_no, o_orderstatus = 'P' AS garbled FROM {orders}")
    tables = t.sql("SELECT o_custkey AS doc_id, 1 AS page_no, o_orderkey % 3 AS table_no FROM {orders}")
    return quality.text_layer_summary(pages, tables, t.sql("SELECT c_custkey AS doc_id FROM {customer} WHERE c_custkey % 2 = 0"))


CHECKS = [{"rule": "one check", "kind": "true_count", "keys": ["Check_Agency"], "n": 1, "only": "agency"}, {"rule": "no NY code", "kind": "forbidden", "keys": ["code"], "values": ["ny", "ca"]}, {"rule": "amount text", "kind": "forbidden", "keys": ["amount"], "values": ["about"], "part": True},
          {"rule": "exclusive", "kind": "exclusive", "off": "Check_AgencyIndicator_A", "on": "Other_A"}, {"rule": "no fills", "kind": "no_gap_fills", "page": 2}]
CHECKED = f"""SELECT doc_id, page_no, name, v_str, v_bool, ftype FROM ({reconciliation.FIELDS}) UNION ALL SELECT o_orderkey, CASE WHEN o_custkey % 9 = 0 THEN 2 ELSE 1 END, 'vlm_code', CASE WHEN o_custkey % 3 = 0 THEN 'NY' ELSE 'TX' END, NULL, 'text' FROM {{orders}}
UNION ALL SELECT o_orderkey, 1, 'vlm_amount', CASE WHEN o_custkey % 2 = 0 THEN 'about 5' ELSE '5' END, NULL, 'text' FROM {{orders}} UNION ALL SELECT o_orderkey, 1, 'Other_A', NULL, o_custkey % 4 < 2, 'checkbox' FROM {{orders}}"""


@query("qc1_assertions", """WITH o AS (SELECT o_orderkey AS doc_id, o_custkey AS c FROM {orders}) SELECT doc_id, 'one check' AS rule, c % 2 = 0 AS passed, CAST(c % 2 = 0 AS BIGINT) AS found FROM o UNION ALL SELECT doc_id, 'no NY code', c % 3 > 0, CAST(c % 3 = 0 AS BIGINT) FROM o
UNION ALL SELECT doc_id, 'amount text', c % 2 > 0, CAST(c % 2 = 0 AS BIGINT) FROM o UNION ALL SELECT doc_id, 'exclusive', c % 2 = 1 AND c % 4 < 2, CAST(c % 2 = 1 AS BIGINT) + CAST(c % 4 < 2 AS BIGINT) FROM o UNION ALL SELECT doc_id, 'no fills', c % 9 > 0, CAST(c % 9 = 0 AS BIGINT) FROM o""")
def _(t: Inputs):
    return quality.assertions(t.sql(CHECKED), CHECKS)


@query("qc2_page_profile", f"SELECT doc_id, page_no, count(*) FILTER (starts_with(name, 'vlm_')) AS gap_fills, count(*) FILTER (ftype = 'checkbox' AND v_bool) AS checked, count(*) FILTER (ftype = 'text' AND NOT starts_with(name, 'vlm_')) AS box_texts, count(*) AS fields FROM ({CHECKED}) GROUP BY doc_id, page_no")
def _(t: Inputs):
    return quality.page_profile(t.sql(CHECKED))


ATTEMPTS = "SELECT user_id AS doc_id, CAST(event_id % 4 AS INT) AS page_no, event_id AS attempt, CASE WHEN value > 40 THEN 'OK' ELSE 'RAW' END AS status, props AS content FROM {events}"
LAST = f"a AS ({ATTEMPTS}), l AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_no ORDER BY (status = 'OK') DESC, attempt DESC) AS k FROM a)"


@query("inc1_pending_documents", "SELECT doc_id, lang FROM {documents} WHERE doc_id NOT IN (SELECT doc_id FROM {labels} GROUP BY doc_id HAVING bool_and(quality = 1))")
def _(t: Inputs):
    pages = t.sql("SELECT doc_id, 1 AS page_no, CASE WHEN quality = 1 THEN 'OK' ELSE 'RAW' END AS status FROM {labels}")
    return incremental.pending(t.sql("SELECT doc_id, lang FROM {documents}"), incremental.complete_documents(pages))


@query("inc3_last_attempts", f"WITH {LAST} SELECT doc_id, page_no, attempt, status, content FROM l WHERE k = 1")
def _(t: Inputs):
    return incremental.last_attempts(t.sql(ATTEMPTS))


@query("inc3_retry_worklist", f"WITH a AS ({ATTEMPTS}) SELECT doc_id, page_no, max(attempt % 7) AS attempts FROM a GROUP BY doc_id, page_no HAVING NOT bool_or(status = 'OK') AND max(attempt % 7) < 6")
def _(t: Inputs):
    return incremental.retry_worklist(t.sql(ATTEMPTS).withColumn("attempt", F.col("attempt") % 7), max_attempts=6)


@query("inc4_latest_versions", "SELECT user_id AS doc_id, max(ts) AS modified_ts, arg_max(event_id, ts) AS event_id FROM {events} GROUP BY user_id")
def _(t: Inputs):
    return incremental.latest_versions(t.sql("SELECT user_id AS doc_id, ts AS modified_ts, event_id FROM {events}"), ["doc_id"])


SHAPES = """SELECT o_orderkey AS doc_id, CASE o_orderkey % 3 WHEN 0 THEN '{"pages":{"page_2":{"v":' || o_custkey || '},"page_x":{}}}' WHEN 1 THEN '{"pages":[{"page":1,"data":{"v":' || o_custkey || '}},{"page":null,"data":{}}]}'
  ELSE '{"vlm_pages":[{"page":3,"data":{"v":' || o_custkey || '}}],"pages":[]}' END AS content FROM {orders}"""


@query("inc2_continuous", "SELECT user_id AS doc_id, count(*) AS n, max(event_id) AS last_event FROM {events} GROUP BY user_id")
def _(t: Inputs):
    # Users are the documents. A third comes in the first arrival alone, a third in the second alone, and a third in both,
    # in the first with other events. Every user's rows lie in many files, and batches end inside an arrival.
    folder, files = f"{run_folder(t.spark)}/inc2-{uuid.uuid4().hex}", max(6, int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    source, third = t.table("events").select(F.col("user_id").alias("doc_id"), "event_id"), F.pmod(F.xxhash64("doc_id"), F.lit(3))
    first = source.withColumn("event_id", F.when(third == 1, F.col("event_id") + 1_000_000_000_000).otherwise(F.col("event_id")))
    stale = first.where(third.isin(0, 1)).unionByName(first.where(third == 1))
    for n, rows in enumerate((stale, source.where(third.isin(1, 2)))):
        rows.repartition(files).write.parquet(f"{folder}/arrived-{n + 1}")
        stream = continuous.document_stream(t.spark, f"{folder}/arrived-*", "doc_id bigint, event_id bigint", files_per_trigger=files * 2 // 3)
        continuous.upsert_by_document(stream, f"{folder}/table", f"{folder}/progress").awaitTermination()
        if n == 0:  # the second arrival goes on from a folded log
            continuous.compact(t.spark, f"{folder}/table")
    return continuous.read_latest(t.spark, f"{folder}/table").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_event"))


@query("src2_page_shapes", """SELECT o_orderkey AS doc_id, CASE o_orderkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 3 END AS page_no, CASE o_orderkey % 3 WHEN 0 THEN 'merged' WHEN 1 THEN 'list' ELSE 'bundle' END AS shape, '{"v":' || o_custkey || '}' AS content FROM {orders}""")
def _(t: Inputs):
    return readers.document_pages(t.sql(SHAPES))


@query("set1_tagged_union", "SELECT o_orderkey AS doc_id, 'a' AS source_file FROM {orders} WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, 'b' FROM {orders} WHERE o_orderstatus = 'O' UNION ALL SELECT o_orderkey, 'c' FROM {orders} WHERE o_orderstatus NOT IN ('F', 'O')")
def _(t: Inputs):
    part = lambda test: t.sql(f"SELECT o_orderkey AS doc_id FROM {{orders}} WHERE o_orderstatus {test}")
    return lossrun.tag_sources((part("= 'F'"), "a"), (part("= 'O'"), "b"), (part("NOT IN ('F', 'O')"), "c"))


@query("dst1_first_per_key", "SELECT o_custkey AS doc_id, min(o_orderkey) AS ord, arg_min(o_orderpriority, o_orderkey) AS value FROM {orders} GROUP BY o_custkey")
def _(t: Inputs):
    from ..operators.ordered import first_by
    return first_by(t.sql("SELECT o_custkey AS doc_id, o_orderkey AS ord, o_orderpriority AS value FROM {orders}"), ["doc_id"], ["ord"])


@query("win1_row_numbers", "SELECT l_suppkey AS doc_id, l_orderkey, l_linenumber, l_partkey, count(*) AS n, max(rn) AS rn FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS rn FROM {lineitem}) GROUP BY ALL")
def _(t: Inputs):
    from ..operators.ordered import number_rows
    rows = t.sql("SELECT l_suppkey AS doc_id, l_orderkey, l_linenumber, l_partkey FROM {lineitem}")
    numbered = number_rows(rows, ["doc_id"], ["l_orderkey", "l_linenumber", "l_partkey"])
    return numbered.groupBy("doc_id", "l_orderkey", "l_linenumber", "l_partkey").agg(F.count(F.lit(1)).alias("n"), F.max("rn").alias("rn"))
