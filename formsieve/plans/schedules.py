"""Queries of property schedules, loss runs and spreadsheet grids."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lossrun, sov
from ..session import materialize
from ..sources import readers
from .registry import Inputs, query, values

# A schedule per nation: its suppliers are the buildings, customers of the same key the second sheet. Columns by number.
HEADERS = ["Loc.#", "Building #", "Street Address", "City", "State", "Zip", "Year Built", "Sprinklered %", "Building RCV", "BPP", "Loss of Rents", "Entity"]
CELL = {
    0: "CASE WHEN k % 11 = 0 THEN '' ELSE CAST(k % 5 + 1 AS STRING) END", 1: "CASE k % 4 WHEN 0 THEN '0' WHEN 1 THEN 'x' ELSE CAST(k % 4 AS STRING) END",
    2: "CAST(k AS STRING) || ' Oak Ave '", 3: "'City ' || k % 3", 4: "'NY'", 5: "CASE WHEN k % 2 = 0 THEN CAST(10000 + k AS STRING) || '.0' ELSE 'A' || k END",
    6: "CAST(1950 + k % 70 AS STRING) || '.9'", 7: "CASE k % 3 WHEN 0 THEN '100' WHEN 1 THEN '99' ELSE '1.0' END", 8: "'$1,' || (100 + k % 900) || ',000'",
    9: "CASE WHEN k % 3 = 0 THEN '0' ELSE CAST(k AS STRING) END", 10: "CASE WHEN k % 4 = 0 THEN '-5' ELSE CAST(k * 10 AS STRING) END", 11: "CASE WHEN k % 6 = 0 THEN '' ELSE 'Owner ' || k || ' LLC; ' END"}
ROWS = "SELECT CAST(c_nationkey AS BIGINT) AS doc_id, c_custkey AS k FROM {customer}"


def _grid(headers: list[str], cells: dict[int, str], sheet: str, ord_: int, source: str) -> str:
    inline = lambda cs: "inline(array(" + ", ".join(f"struct({i} AS col_no, {c} AS value)" for i, c in cs) + "))"
    head = f"SELECT doc_id, '{sheet}' AS sheet, {ord_} AS sheet_ord, CAST(-1 AS BIGINT) AS row_no, {inline((i, repr(h)) for i, h in enumerate(headers))} FROM (SELECT DISTINCT doc_id FROM ({source}))"
    return f"{head} UNION ALL SELECT doc_id, '{sheet}', {ord_}, k, {inline(cells.items())} FROM ({source})"


NOTES = "SELECT CAST(n_nationkey AS BIGINT) AS doc_id, 'notes' AS sheet, 0 AS sheet_ord, CAST(1 AS BIGINT) AS row_no, 0 AS col_no, n_name AS value FROM {nation}"
CELLS = _grid(HEADERS, CELL, "sov", 1, ROWS) + " UNION ALL " + NOTES
BARE = [h for h in HEADERS if h != "Loc.#"]
BARE_CELLS = _grid(BARE, {BARE.index(HEADERS[i]): c for i, c in CELL.items() if i}, "sov", 1, ROWS)
TRIMMED = "nullif({}, '')"


def cells(t: Inputs, sql: str = CELLS):
    """The cells as a table, as the operators find them; the derivation is a union over columns."""
    return materialize(t.sql(sql))


@query("sov1_best_sheet", "SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS doc_id, 'sov' AS sheet FROM {customer}")
def _(t: Inputs):
    return sov.best_sheet(cells(t))


@query("sov2_header_row", "SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS doc_id, 'sov' AS sheet, CAST(-1 AS BIGINT) AS header_row FROM {customer}")
def _(t: Inputs):
    return sov.header_row(sov.row_fill(cells(t)))


NUM = lambda i: f"TRY_CAST(replace(replace(trim({CELL[i]}), ',', ''), '$', '') AS DOUBLE)"
INT = lambda i: f"CAST(trunc({NUM(i)}) AS BIGINT)"
COLS = {0: "loc", 1: "bldg", 2: "street", 3: "city", 4: "state", 5: "zip", 6: "year", 7: "sprinkler", 8: "rcv", 9: "bpp", 10: "bi", 11: "named"}


@query("sov3_resolved_columns", f"SELECT doc_id, k AS row_no, {', '.join(f'nullif({CELL[i]}, chr(0)) AS {n}' for i, n in COLS.items() if i not in (0, 11))}, nullif({CELL[0]}, '') AS loc, nullif({CELL[11]}, '') AS named FROM ({ROWS})")
def _(t: Inputs):
    return sov.schedule_rows(cells(t), exclude={"rcv": ["Building #"]}).select("doc_id", "row_no", *COLS.values())


BUILT = f"""SELECT doc_id, k AS row_no, {INT(0)} AS location_number, CASE WHEN coalesce({INT(1)}, 0) = 0 THEN 1 ELSE {INT(1)} END AS building_number, {INT(6)} AS year_built,
NULL::VARCHAR AS construction, NULL::VARCHAR AS roof, NULL::DOUBLE AS sqft, NULL::BIGINT AS stories, NULL::BIGINT AS units, NULL::VARCHAR AS occupancy, {NUM(7)} >= 100 AS fully_sprinklered, {NUM(8)} AS building_limit,
CASE WHEN {NUM(9)} > 0 THEN {NUM(9)} END AS bpp_limit, CASE WHEN {NUM(10)} > 0 THEN {NUM(10)} END AS business_income FROM ({ROWS}) WHERE {CELL[0]} <> ''"""


def schedule(t: Inputs):
    return sov.numbered_rows(sov.schedule_rows(cells(t)))


@query("sov5_typed_buildings", BUILT)
def _(t: Inputs):
    return sov.buildings(schedule(t))


@query("sov4_auto_numbered", f"""SELECT doc_id, k AS row_no, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS location_number FROM ({ROWS})""")
def _(t: Inputs):
    return sov.numbered_rows(sov.schedule_rows(cells(t, BARE_CELLS))).select("doc_id", "row_no", "location_number")


@query("sov6_locations", f"""WITH r AS (SELECT doc_id, k, {INT(0)} AS n, {CELL[11]} AS named, trim({CELL[2]}) AS street, {CELL[3]} AS city, {CELL[4]} AS state, coalesce(CAST(CAST(TRY_CAST({CELL[5]} AS DOUBLE) AS BIGINT) AS VARCHAR), {CELL[5]}) AS zip FROM ({ROWS}) WHERE {CELL[0]} <> ''),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, n ORDER BY k) AS o, count(*) OVER (PARTITION BY doc_id, n) AS c FROM r)
SELECT doc_id, n AS location_number, CASE WHEN named = '' THEN 'Location ' || n ELSE regexp_replace(named, '[;,\\s]+$', '') END AS location_name, street, city, state, zip, NULL::VARCHAR AS county, c AS n_buildings FROM f WHERE o = 1""")
def _(t: Inputs):
    return sov.locations(schedule(t))


@query("sov6_nested_locations", f"""WITH b AS ({BUILT}) SELECT doc_id, location_number, string_agg(building_number || ':' || year_built, ',' ORDER BY row_no) AS buildings FROM b GROUP BY doc_id, location_number""")
def _(t: Inputs):
    return sov.nested_locations(schedule(t)).select("doc_id", "location_number", F.array_join(F.transform(
        "buildings", lambda b: F.concat_ws(":", b["building_number"], b["year_built"])), ",").alias("buildings"))


# Spreadsheet records: parts as rows; a title-less sheet whose header repeats a name and leaves one blank.
SHEETS = """SELECT p_brand AS doc_id, 's' || p_size % 3 AS sheet, p_partkey AS row_no, 0 AS col_no, CASE WHEN p_partkey % 7 = 0 THEN ' ' || p_name ELSE p_name END AS value FROM {part}
UNION ALL SELECT p_brand, 's' || p_size % 3, p_partkey, 1, p_type FROM {part} UNION ALL SELECT p_brand, 's' || p_size % 3, p_partkey, 2, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_size AS STRING) END FROM {part}
UNION ALL SELECT p_brand, 's' || p_size % 3, p_partkey, 3, CAST(p_partkey AS STRING) FROM {part}
UNION ALL SELECT DISTINCT p_brand, 's' || p_size % 3, -1, 0, ' Name ' FROM {part} UNION ALL SELECT DISTINCT p_brand, 's' || p_size % 3, -1, 1, '' FROM {part}
UNION ALL SELECT DISTINCT p_brand, 's' || p_size % 3, -1, 2, 'Size' FROM {part} UNION ALL SELECT DISTINCT p_brand, 's' || p_size % 3, -1, 3, 'Name' FROM {part}"""


@query("src4_sheet_records", """SELECT p_brand AS doc_id, 's' || p_size % 3 AS sheet, p_partkey AS row_no, 'Name' AS key, CAST(p_partkey AS VARCHAR) AS value FROM {part}
UNION ALL SELECT p_brand, 's' || p_size % 3, p_partkey, 'Size', CAST(p_size AS VARCHAR) FROM {part} WHERE p_partkey % 5 > 0""")
def _(t: Inputs):
    return readers.sheet_records(cells(t, SHEETS))


@query("src4_record_maps", """SELECT p_brand AS doc_id, 's' || p_size % 3 AS sheet, p_partkey AS row_no, 'Name=' || p_partkey || CASE WHEN p_partkey % 5 > 0 THEN ';Size=' || p_size ELSE '' END AS record FROM {part}""")
def _(t: Inputs):
    maps = readers.record_maps(readers.sheet_records(cells(t, SHEETS)))
    return maps.withColumn("record", F.array_join(F.transform(F.map_entries("record"), lambda e: F.concat_ws("=", e["key"], e["value"])), ";"))


# Claim tables: the orders of a customer, with a title row, a header row, claims, blank rows and a totals row.
TITLE = "SELECT DISTINCT o_custkey AS doc_id, 1 AS page_no, 0 AS table_no, CAST(-2 AS BIGINT) AS row_no, 0 AS col_no, 'Account summary' AS text FROM {orders}"
CLAIM_HEAD = ["Claim #", "Loss Date", "Total Paid", "Status/Type", "Status"]
CLAIM_VALUES = ["CASE WHEN blank THEN '' ELSE 'C-' || o_orderkey END", "CASE WHEN blank THEN NULL ELSE mdy END", "CASE WHEN blank THEN '' ELSE '$' || price END", "CASE WHEN blank THEN '' ELSE o_orderpriority END",
                "CASE WHEN blank THEN NULL WHEN o_orderkey % 3 = 0 THEN 'closed w/payment' ELSE 'OPEN ' || o_orderstatus END"]
CLAIM_ROWS = """SELECT *, o_orderkey % 9 = 0 AS blank, CAST(month(o_orderdate) AS STRING) || '/' || CAST(day(o_orderdate) AS STRING) || '/' || CAST(year(o_orderdate) AS STRING) AS mdy,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS price, CAST(CAST(o_orderdate AS DATE) AS STRING) AS iso FROM {orders}"""
_inline = lambda cs: "inline(array(" + ", ".join(f"struct({i} AS col_no, {c} AS text)" for i, c in enumerate(cs)) + "))"
CLAIM_CELLS = f"""{TITLE} UNION ALL SELECT doc_id, 1, 0, CAST(-1 AS BIGINT), {_inline([repr(h) for h in CLAIM_HEAD])} FROM (SELECT DISTINCT o_custkey AS doc_id FROM {{orders}})
UNION ALL SELECT o_custkey, 1, 0, o_orderkey, {_inline(CLAIM_VALUES)} FROM ({CLAIM_ROWS}) c"""
KEYS = ["claim_no", "loss_date", "total_paid", "status_type", "status"]


@query("lr1_claim_cells", " UNION ALL ".join(f"SELECT o_custkey AS doc_id, o_orderkey AS row_no, '{k}' AS key, {v} AS value FROM ({CLAIM_ROWS}) c WHERE NOT blank" for k, v in zip(KEYS, CLAIM_VALUES)))
def _(t: Inputs):
    return lossrun.claim_cells(cells(t, CLAIM_CELLS)).select("doc_id", "row_no", "key", "value")


@query("lr1_claim_records", f"""SELECT o_custkey AS doc_id, o_orderkey AS row_no, 'claim_no=C-' || o_orderkey || ';loss_date=' || mdy || ';status=' || CASE WHEN o_orderkey % 3 = 0 THEN 'closed w/payment' ELSE 'OPEN ' || o_orderstatus END
|| ';status_type=' || o_orderpriority || ';total_paid=$' || price AS record FROM ({CLAIM_ROWS}) c WHERE NOT blank""")
def _(t: Inputs):
    records = lossrun.claim_records(lossrun.claim_cells(cells(t, CLAIM_CELLS)))
    return records.select("doc_id", "row_no", F.array_join(F.transform(F.map_entries("record"), lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias("record"))


# Model pages of loss runs: one page per order of a customer; the page's header, its summary rows and its claims.
MODEL_PAGES = f"""SELECT o_custkey + CASE WHEN o_custkey % 2 = 0 THEN 0 ELSE 1000000 END AS doc_id, CAST(o_orderkey AS INT) AS page_no, '{{"header":{{"' || CASE o_orderkey % 3 WHEN 0 THEN 'company' WHEN 1 THEN 'carrier' ELSE 'company/carrier' END || '":"Carrier ' || o_custkey
  || '","policy_number":"PN-' || o_orderkey || '","valuation_date":"' || mdy || '"}},"summary":[{{"effective_date":"' || CASE WHEN o_orderkey % 2 = 0 THEN mdy || ' - 1/2/2031' ELSE mdy END || '","expiration_date":'
  || CASE o_orderkey % 4 WHEN 1 THEN 'null' ELSE '"' || iso || '"' END || ',"claim_count":' || o_orderkey % 5 || '}},{{"effective_date":"","expiration_date":"","claim_count":1}}],"' || CASE WHEN o_orderkey % 2 = 0 THEN 'claims' ELSE 'detail' END
  || '":[{{"claim_number":"M-' || o_orderkey || '","amount_paid":' || price || ',"status":"open","date_of_loss":"' || mdy || '","type_cause":null,"description":"' || o_orderpriority || '","net_incurred":"n/a"}}]}}' AS content FROM ({CLAIM_ROWS}) c"""
DOC = "o_custkey + CASE WHEN o_custkey % 2 = 0 THEN 0 ELSE 1000000 END"
TERMS = f"""SELECT {DOC} AS doc_id, CAST(o_orderkey AS INT) AS page_no, 0 AS ord, iso AS effective, CASE WHEN o_orderkey % 2 = 0 THEN '2031-01-02' WHEN o_orderkey % 4 = 1 THEN NULL ELSE iso END AS expiration, CAST(o_orderkey % 5 AS STRING) AS claim_count FROM ({CLAIM_ROWS}) c"""


def model_leaves(t: Inputs):
    return materialize(lossrun.model_leaves(t.sql(MODEL_PAGES)))


@query("lr2_policy_terms", TERMS)
def _(t: Inputs):
    return lossrun.policy_terms(model_leaves(t))


@query("lr3_latest_term", f"WITH t AS ({TERMS}), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(expiration, '') DESC, page_no, ord) AS k FROM t) SELECT doc_id, effective, expiration FROM r WHERE k = 1")
def _(t: Inputs):
    return lossrun.latest_term(lossrun.policy_terms(model_leaves(t)))


PARSED = f"""SELECT o_custkey AS doc_id, 'parsed' AS origin, o_orderkey AS row_no, 'C-' || o_orderkey AS claim_no, CASE WHEN o_orderkey % 3 = 0 THEN 'Closed W/Payment' ELSE 'Open ' || o_orderstatus END AS status, iso AS loss_date,
NULL AS description, CAST(price AS DOUBLE) AS paid, CAST(NULL AS DOUBLE) AS reserve, CAST(NULL AS DOUBLE) AS incurred FROM ({CLAIM_ROWS}) c WHERE NOT blank"""
MODEL = f"""SELECT {DOC} AS doc_id, 'model' AS origin, CAST(0 AS BIGINT) AS row_no, 'M-' || o_orderkey AS claim_no, 'Open' AS status, iso AS loss_date, o_orderpriority AS description, CAST(price AS DOUBLE) AS paid, NULL::DOUBLE AS reserve, NULL::DOUBLE AS incurred FROM ({CLAIM_ROWS}) c"""
CLAIMS = f"WITH pa AS ({PARSED}), cl AS (SELECT * FROM pa UNION ALL SELECT m.* FROM ({MODEL}) m WHERE m.doc_id NOT IN (SELECT doc_id FROM pa))"


def all_claims(t: Inputs, leaves=None):
    parsed = lossrun.parsed_claims(lossrun.claim_cells(cells(t, CLAIM_CELLS)))
    return lossrun.claims(parsed, lossrun.model_claims(model_leaves(t) if leaves is None else leaves))


@query("lr4_claims", f"{CLAIMS} SELECT * FROM cl")
def _(t: Inputs):
    return all_claims(t).drop("page_no", "table_no").withColumn("row_no", F.col("row_no").cast("bigint"))


HEADER = f"""h AS (SELECT {DOC} AS doc_id, 'Carrier ' || o_custkey AS carrier, 'PN-' || o_orderkey AS policy_number, iso AS evaluation_date, 'General Liability' AS lob, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM ({CLAIM_ROWS}) c)"""


@query("lr5_header_fields", f"WITH {HEADER} SELECT doc_id, carrier, policy_number, evaluation_date, lob FROM h WHERE k = 1")
def _(t: Inputs):
    return lossrun.header_fields(model_leaves(t))


@query("lr6_no_known_losses", "SELECT c_custkey AS doc_id, NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P') AS no_known_losses FROM {customer} c")
def _(t: Inputs):
    return lossrun.no_known_losses(t.sql("SELECT c_custkey AS doc_id FROM {customer}"), t.sql("SELECT o_custkey AS doc_id FROM {orders} WHERE o_orderstatus = 'P'"))


@query("lr7_loss_runs", f"""{CLAIMS}, {HEADER}, t AS ({TERMS}), l AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(expiration, '') DESC, page_no, ord) AS k FROM t), n AS (SELECT doc_id, count(*) AS n FROM cl GROUP BY doc_id),
d AS (SELECT c_custkey AS doc_id, 'LR_' || c_custkey AS source_file FROM {{customer}} UNION ALL SELECT c_custkey + 1000000, 'second_LR_' || c_custkey FROM {{customer}})
SELECT d.doc_id, d.source_file, h.carrier, h.policy_number, h.evaluation_date, 'General Liability' AS lob, l.effective AS policy_effective, l.expiration AS policy_expiration, coalesce(n.n, 0) AS n_claims, n.n IS NULL AS no_known_losses
FROM d LEFT JOIN h ON d.doc_id = h.doc_id AND h.k = 1 LEFT JOIN l ON d.doc_id = l.doc_id AND l.k = 1 LEFT JOIN n ON d.doc_id = n.doc_id""")
def _(t: Inputs):
    documents = t.sql("SELECT c_custkey AS doc_id, 'LR_' || c_custkey AS source_file FROM {customer} UNION ALL SELECT c_custkey + 1000000, 'second_LR_' || c_custkey FROM {customer}")
    leaves = model_leaves(t)
    return lossrun.loss_runs(documents, lossrun.header_fields(leaves), lossrun.policy_terms(leaves), all_claims(t, leaves))


AMOUNTS = """SELECT l_suppkey AS doc_id, l_returnflag AS property, CAST(year(l_shipdate) AS STRING) AS period, CAST(l_extendedprice AS DECIMAL(18,2)) AS paid, CAST(l_quantity AS DECIMAL(18,2)) AS reserve, CAST(l_tax AS DECIMAL(18,2)) AS expenses,
  CAST(l_discount AS DECIMAL(18,2)) AS recovered, CAST(l_extendedprice AS DECIMAL(18,2)) + CAST(l_quantity AS DECIMAL(18,2)) AS incurred FROM {lineitem}"""
SUMS = ", ".join(f"CAST(sum({c}) AS DOUBLE) AS {c}" for c in lossrun.TOTALS)


def totals(t: Inputs):
    return lossrun.period_totals(t.sql(AMOUNTS)).select("doc_id", "property", "period", "n_claims", *[F.col(c).cast("double").alias(c) for c in lossrun.TOTALS])


@query("lr8_period_totals", f"SELECT doc_id, property, period, count(*) AS n_claims, {SUMS} FROM ({AMOUNTS}) GROUP BY GROUPING SETS ((doc_id, property, period), (doc_id, property), (doc_id))")
def _(t: Inputs):
    return totals(t)


STATED = f"SELECT doc_id, CAST(sum(paid) + CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS paid, CAST(sum(reserve) AS DOUBLE) AS reserve FROM ({AMOUNTS}) a GROUP BY doc_id"


@query("lr8_stated_differences", f"SELECT doc_id, 'paid' AS measure, paid AS stated, paid - 1 AS computed FROM ({STATED}) WHERE doc_id % 3 = 0".replace("paid - 1 AS computed", "round(paid - 1, 2) AS computed"))
def _(t: Inputs):
    whole = totals(t).where("property IS NULL").select("doc_id", "paid", "reserve")
    return lossrun.stated_differences(whole, t.sql(STATED), ["doc_id"])
