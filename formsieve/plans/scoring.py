"""Queries of leaf flattening, ground-truth comparison and scoring."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import compare, leaves
from .registry import Inputs, query

# Expected and produced leaves of one record per order; the output differs by key arithmetic so that every verdict occurs.
MDY = "CAST(month(o_orderdate) AS STRING) || '/' || CAST(day(o_orderdate) AS STRING) || '/' || CAST(year(o_orderdate) AS STRING)"
ISO = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
PRICE = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)"
NOTE = "'Order of customer ' || o_custkey || ' at  priority ' || o_orderpriority"
EXPECTED = f"""SELECT o_orderkey AS doc_id, 'price' AS path, {PRICE} AS value, 'number' AS vtype FROM {{orders}}
UNION ALL SELECT o_orderkey, 'date', CASE o_orderkey % 2 WHEN 0 THEN {ISO} ELSE {MDY} END, 'string' FROM {{orders}}
UNION ALL SELECT o_orderkey, 'priority', CASE o_orderkey % 9 WHEN 0 THEN '*' WHEN 1 THEN 'N/A' WHEN 2 THEN NULL WHEN 3 THEN '' ELSE o_orderpriority END,
  CASE WHEN o_orderkey % 9 = 2 THEN 'null' ELSE 'string' END FROM {{orders}}
UNION ALL SELECT o_orderkey, 'open', CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END, 'boolean' FROM {{orders}}
UNION ALL SELECT o_orderkey, 'note', {NOTE}, 'string' FROM {{orders}}"""
PRODUCED = f"""SELECT o_orderkey AS doc_id, 'price' AS path, CASE o_custkey % 6 WHEN 0 THEN {PRICE} WHEN 1 THEN '$' || CAST(CAST(o_totalprice + 0.5 AS DECIMAL(18,2)) AS STRING)
  WHEN 2 THEN CAST(CAST(o_totalprice + 400 AS DECIMAL(18,2)) AS STRING) WHEN 3 THEN CAST(CAST(o_totalprice + 90000 AS DECIMAL(18,2)) AS STRING) WHEN 4 THEN 'about ' || {PRICE} ELSE '' END AS value,
  CASE o_custkey % 6 WHEN 0 THEN 'number' ELSE 'string' END AS vtype FROM {{orders}}
UNION ALL SELECT o_orderkey, 'date', CASE o_custkey % 4 WHEN 0 THEN {ISO} WHEN 1 THEN {MDY} WHEN 2 THEN {ISO} || 'T10:00:00' ELSE '2/30/1999' END, 'string' FROM {{orders}}
UNION ALL SELECT o_orderkey, 'priority', CASE o_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'false' WHEN 2 THEN '[]' ELSE lower(o_orderpriority) || ' ' END,
  CASE o_custkey % 5 WHEN 0 THEN 'null' WHEN 1 THEN 'boolean' WHEN 2 THEN 'array' ELSE 'string' END FROM {{orders}}
UNION ALL SELECT o_orderkey, 'open', CASE o_custkey % 3 WHEN 0 THEN 'no' WHEN 1 THEN 'false' ELSE '1' END, CASE o_custkey % 3 WHEN 0 THEN 'string' WHEN 1 THEN 'boolean' ELSE 'number' END FROM {{orders}}
UNION ALL SELECT o_orderkey, 'note', CASE o_custkey % 4 WHEN 0 THEN upper({NOTE}) WHEN 1 THEN 'Note: ' || {NOTE} || '.' WHEN 2 THEN 'Order' ELSE {NOTE} END, 'string' FROM {{orders}} WHERE o_custkey % 7 > 0"""

DATE = lambda c: f"CAST(CAST(try_strptime(split_part(trim({c}), 'T', 1), ['%Y-%m-%d', '%m/%d/%Y', '%d/%m/%Y', '%m-%d-%Y']) AS DATE) AS STRING)"
NORM = lambda c: f"regexp_replace(lower(trim({c})), '\\s+', ' ', 'g')"
TRUTH = lambda v, t: f"CASE {t} WHEN 'boolean' THEN {v} = 'true' WHEN 'number' THEN CAST({v} AS DOUBLE) <> 0 WHEN 'null' THEN false WHEN 'array' THEN false ELSE {v} <> '' END"
NUM = "TRY_CAST(replace(replace(o, ',', ''), '$', '') AS DOUBLE)"
VERDICTS = f"""x AS (SELECT g.doc_id, g.path, g.value AS g, g.vtype AS gt, p.value AS o, coalesce(p.vtype, 'null') AS ot FROM ({EXPECTED}) g
  LEFT JOIN ({PRODUCED}) p ON g.doc_id = p.doc_id AND g.path = p.path),
v AS (SELECT doc_id, path, g AS gt_value, o AS out_value, CASE
  WHEN gt = 'null' OR g = '' THEN CASE WHEN ot IN ('null', 'array') OR o = '' OR (ot = 'boolean' AND o = 'false') THEN 'CORRECT' ELSE 'EXTRA' END
  WHEN g = '*' THEN CASE WHEN ot IN ('null', 'array') OR o = '' THEN 'MISSING' ELSE 'CORRECT' END
  WHEN g = 'N/A' THEN 'N/A' WHEN ot = 'null' OR o = '' THEN 'MISSING'
  WHEN gt = 'boolean' OR ot = 'boolean' THEN CASE WHEN ({TRUTH('g', 'gt')}) = ({TRUTH('o', 'ot')}) THEN 'CORRECT' ELSE 'WRONG' END
  WHEN gt = 'number' THEN CASE WHEN abs(CAST(g AS DOUBLE) - {NUM}) < 1 OR abs(CAST(g AS DOUBLE) - {NUM}) / abs(CAST(g AS DOUBLE)) < 0.005 THEN 'CORRECT' ELSE 'WRONG' END
  WHEN {DATE('g')} IS NOT NULL AND {DATE('o')} IS NOT NULL THEN CASE WHEN {DATE('g')} = {DATE('o')} THEN 'CORRECT' ELSE 'WRONG' END
  WHEN {NORM('g')} = {NORM('o')} OR (length(g) > 30 AND contains({NORM('o')}, {NORM('g')})) THEN 'CORRECT' ELSE 'WRONG' END AS verdict FROM x)"""
SCORE = """count(*) FILTER (verdict = 'CORRECT') AS correct, count(*) FILTER (verdict = 'WRONG') AS wrong, count(*) FILTER (verdict = 'MISSING') AS missing,
count(*) FILTER (verdict = 'EXTRA') AS extra, count(*) FILTER (verdict = 'N/A') AS skipped"""
RATES = """round(correct / nullif(correct + wrong + missing + extra, 0)::DOUBLE, 6) AS accuracy, round(correct / nullif(correct + wrong, 0)::DOUBLE, 6) AS precision,
round(correct / nullif(correct + missing, 0)::DOUBLE, 6) AS recall"""


def verdicts(t: Inputs):
    return compare.compare_leaves(t.sql(EXPECTED), t.sql(PRODUCED), ["doc_id", "path"])


def rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "recall")})


@query("gt1_leaf_verdicts", f"WITH {VERDICTS} SELECT * FROM v")
def _(t: Inputs):
    return verdicts(t)


@query("agg1_score", f"WITH {VERDICTS}, s AS (SELECT path, {SCORE} FROM v GROUP BY path) SELECT *, {RATES} FROM s")
def flagship(t: Inputs):
    return rounded(compare.score(verdicts(t), ["path"]))


@query("agg1_score_total", f"WITH {VERDICTS}, s AS (SELECT {SCORE} FROM v) SELECT *, {RATES} FROM s")
def _(t: Inputs):
    return rounded(compare.score(verdicts(t)))


@query("leaf1_flat_records", "SELECT event_id AS doc_id, CAST(0 AS BIGINT) AS ord, 'k' AS path, json_extract_string(props, '$.k') AS value, 'number' AS vtype FROM {events}")
def _(t: Inputs):
    return leaves.flatten(t.table("events").withColumnRenamed("event_id", "doc_id"), ["doc_id"], "props").drop("steps")


NESTED = """SELECT o_orderkey AS doc_id, '{"id":' || o_orderkey || ',"who":{"key":"' || o_custkey || '","tags":["' || o_orderstatus || '",{"p":"' || o_orderpriority
  || '"},[' || (o_custkey % 7) || ',null]]},"none":{},"list":[],"ok":' || CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END || '}' AS content FROM {orders}"""
LEAF_ROWS = [(0, "id", "CAST(o_orderkey AS STRING)", "number"), (1, "who.key", "CAST(o_custkey AS STRING)", "string"),
             (2, "who.tags[0]", "o_orderstatus", "string"), (3, "who.tags[1].p", "o_orderpriority", "string"),
             (4, "who.tags[2][0]", "CAST(o_custkey % 7 AS STRING)", "number"), (5, "who.tags[2][1]", "NULL", "null"),
             (6, "none", "'{}'", "object"), (7, "list", "'[]'", "array"), (8, "ok", "CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END", "boolean")]


@query("leaf1_nested_records", " UNION ALL ".join(
    f"SELECT o_orderkey AS doc_id, CAST({n} AS BIGINT) AS ord, '{p}' AS path, {v} AS value, '{k}' AS vtype FROM {{orders}}" for n, p, v, k in LEAF_ROWS))
def _(t: Inputs):
    return leaves.flatten(t.dealt(NESTED), ["doc_id"]).drop("steps")


@query("leaf1_rebuild", NESTED)
def _(t: Inputs):
    return leaves.rebuild(leaves.flatten(t.dealt(NESTED), ["doc_id"]), ["doc_id"])


# Nested records with keyed lists: the output lists the buildings in another order, misses one or has one more.
def _item(key: str, value: str) -> str:
    return f"'{{\"BuildingNumber\":' || ({key}) || ',\"v\":\"' || ({value}) || '\"}}'"


GT_ITEMS = [("o_orderkey % 3 + 1", "o_orderstatus"), ("o_orderkey % 3 + 9", "o_orderpriority"), ("o_orderkey % 3 + 20", "'x'")]
OUT_ITEMS = [("o_orderkey % 3 + 20", "'x'"), ("o_orderkey % 3 + 1", "CASE WHEN o_custkey % 2 = 0 THEN o_orderstatus ELSE 'F' END"), ("o_orderkey % 3 + 9", "o_orderpriority")]
EXTRA_ITEM = ("5", "'extra'")
join_items = lambda items: " || ',' || ".join(_item(*i) for i in items)
# Three more lists stand around the buildings; each has its two items in another order on either side.
def _wrapped(inner: str, swapped: bool) -> str:
    for name in ("N", "M", "L"):
        items = [f"'{{{{\"Name\":\"z\",' || {inner} || '}}}}'", """'{{"Name":"a","v":"1"}}'"""]
        inner = f"""'"{name}":[' || {" || ',' || ".join(reversed(items) if swapped else items)} || ']'"""
    return inner.replace("{{{{", "{{").replace("}}}}", "}}").replace("{{", "{").replace("}}", "}")


GT_RECORD = f"""SELECT o_orderkey AS doc_id, '{{"_meta":1,"Total":' || o_custkey || ',' || {_wrapped(f"""'"Buildings":[' || {join_items(GT_ITEMS)} || ']'""", False)} || '}}' AS content FROM {{orders}}"""
OUT_LIST = f"""CASE o_custkey % 3 WHEN 0 THEN {join_items(OUT_ITEMS[:2])} WHEN 1 THEN {join_items([*OUT_ITEMS, EXTRA_ITEM])} ELSE {join_items(OUT_ITEMS)} END"""
OUT_RECORD = f"""SELECT o_orderkey AS doc_id, '{{"Total":"' || o_custkey || '","more":1,' || {_wrapped(f"""'"Buildings":[' || {OUT_LIST} || ']'""", True)} || '}}' AS content FROM {{orders}}"""
_rows = lambda items, where: " UNION ALL ".join(f"SELECT o_orderkey AS doc_id, {i} AS i, CAST({k} AS STRING) AS k, {v} AS v FROM orders WHERE {where}" for i, (k, v) in enumerate(items))


def _record_oracle(number_gt: str, number_out: str, pair: str, surplus: str, z: int) -> str:
    """`z`: place of the wrapping items, `number_*`: place of a building on its side, `surplus`: place of one without a partner."""
    levels = ["L", f"L[{z}].M", f"L[{z}].M[{z}].N"]
    inside = f"L[{z}].M[{z}].N[{z}].Buildings["
    frame = " ".join(f"UNION ALL SELECT o_orderkey, '{x}[{i}].{k}', '{v}', '{v}', 'CORRECT' FROM orders" for x in levels for i, k, v in ((z, "Name", "z"), (1 - z, "Name", "a"), (1 - z, "v", "1")))
    return f"""WITH gi AS ({_rows(GT_ITEMS, 'true')}), oi AS ({_rows(OUT_ITEMS[:2], 'true')}
  UNION ALL SELECT o_orderkey, 2, CAST({OUT_ITEMS[2][0]} AS STRING), {OUT_ITEMS[2][1]} FROM orders WHERE o_custkey % 3 > 0
  UNION ALL SELECT o_orderkey, 3, '5', 'extra' FROM orders WHERE o_custkey % 3 = 1),
g AS (SELECT *, {number_gt} AS n FROM gi), o AS (SELECT *, {number_out} AS n FROM oi),
j AS (SELECT coalesce(g.doc_id, o.doc_id) AS doc_id, coalesce(g.n, {surplus}) AS n, g.k AS gk, g.v AS gv, o.k AS ok, o.v AS ov, g.k IS NULL AS extra FROM g FULL JOIN o ON g.doc_id = o.doc_id AND {pair})
SELECT doc_id, '{inside}' || n || '].BuildingNumber' AS path, gk AS gt_value, ok AS out_value, CASE WHEN ok IS NULL THEN 'MISSING' WHEN abs(CAST(gk AS INT) - CAST(ok AS INT)) < 1 THEN 'CORRECT' ELSE 'WRONG' END AS verdict FROM j WHERE NOT extra
UNION ALL SELECT doc_id, '{inside}' || n || '].v', gv, ov, CASE WHEN ov IS NULL THEN 'MISSING' WHEN lower(gv) = lower(ov) THEN 'CORRECT' ELSE 'WRONG' END FROM j WHERE NOT extra
UNION ALL SELECT doc_id, '{inside}' || n || ']', NULL, '(extra item)', 'EXTRA' FROM j WHERE extra
UNION ALL SELECT o_orderkey, 'Total', CAST(o_custkey AS STRING), CAST(o_custkey AS STRING), 'CORRECT' FROM orders {frame}"""


RANK = "row_number() OVER (PARTITION BY doc_id ORDER BY k, i) - 1"


@query("gt2_list_alignment", _record_oracle(RANK, RANK, "g.n = o.n", "o.n", 1))
def _(t: Inputs):
    return compare.compare_records(t.dealt(GT_RECORD), t.dealt(OUT_RECORD), ["doc_id"])


@query("gt2_alignment_by_key", _record_oracle("i", "i", "g.k = o.k", "3", 0))
def _(t: Inputs):
    return compare.compare_records(t.dealt(GT_RECORD), t.dealt(OUT_RECORD), ["doc_id"], mode="key")
