"""Queries of predicates, scrubbing and reconciliation: orders as form fields, and model answers that differ from them."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reconcile, scrub
from ..rules import fields as rules
from ..sources import readers
from .registry import Inputs, query, values

PRICE = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)"
LABELS_CASE = """CASE o_custkey % 7 WHEN 0 THEN '1. ANY OTHER BUSINESS VENTURES' WHEN 1 THEN 'APPLICANT INFORMATION SECTION DETAILS' WHEN 2 THEN 'GREENFIELD APARTMENTS PARTNERS LLC'
  WHEN 3 THEN 'POOL AREA AND DECK 0 2 48925 T 1' WHEN 4 THEN 'PRODUCER SIGNATURE:' WHEN 5 THEN '100 OAK AVENUE SOUTH OF THE MAIN ROAD' ELSE 'Springfield, NY 10001' END"""
# fields(doc_id, page_no, ord, name, v_str, v_bool, ftype, tooltip, source)
FIELDS = f"""SELECT o_orderkey AS doc_id, 1 AS page_no, CAST(0 AS BIGINT) AS ord, 'Amount_A[0]' AS name, CASE WHEN o_custkey % 3 = 0 THEN '$' || {PRICE} ELSE {PRICE} END AS v_str, CAST(NULL AS BOOLEAN) AS v_bool, 'text' AS ftype, 'amount' AS tooltip, 'bbox' AS source FROM {{orders}}
UNION ALL SELECT o_orderkey, 1, 1, 'Status_A', CASE WHEN o_custkey % 2 = 0 THEN 'State of ' || o_orderstatus ELSE 'unknown' END, NULL, 'text', 'status', 'bbox' FROM {{orders}}
UNION ALL SELECT o_orderkey, 1, 2, 'Question_A', {LABELS_CASE}, NULL, 'text', 'question', 'bbox' FROM {{orders}}
UNION ALL SELECT o_orderkey, 1, 3, 'Priority_A', o_orderpriority, NULL, 'text', 'priority', 'bbox' FROM {{orders}} WHERE o_custkey % 5 > 0
UNION ALL SELECT o_orderkey, 1, 4, 'Check_AgencyIndicator_A', NULL, o_custkey % 2 = 0, 'checkbox', 'check', CASE WHEN o_custkey % 4 = 0 THEN 'bbox:pixel:0.42' ELSE 'bbox' END FROM {{orders}}"""

CANDIDATES = [
    (0, "vlm_header_amount", "header.amount", f"CASE o_custkey % 3 WHEN 0 THEN {PRICE} WHEN 1 THEN 'about ' || {PRICE} ELSE '17' END", "string", "object"),
    (1, "vlm_header_status", "header.status", "o_orderstatus", "string", "object"),
    (2, "vlm_header_note", "header.note", "CASE o_custkey % 4 WHEN 0 THEN 'Producer''s  Signature' WHEN 1 THEN 'Is this a question?' WHEN 2 THEN 'I SELECT this' ELSE 'plain note' END", "string", "object"),
    (3, "vlm_header_prio", "header.prio", "o_orderpriority || ' '", "string", "object"),
    (4, "vlm_header_entity", "header.entity", "CASE WHEN o_custkey % 2 = 0 THEN 'LLC' ELSE 'Limited  Liability Corporation' END", "string", "object"),
    (5, "vlm_rows_0_code", "rows[0].code", "'NY'", "string", "array"),
    (6, "vlm_rows_0_zero", "rows[0].zero", "'0'", "string", "array"),
    (7, "vlm_rows_0_n", "rows[0].n", "'0'", "number", "array"),
    (8, "vlm_rows_0_cust", "rows[0].cust", "'C' || o_custkey", "string", "array"),
    (9, "vlm_rows_1_code", "rows[1].code", "CASE WHEN o_custkey % 2 = 0 THEN 'ny' ELSE 'CA' END", "string", "array"),
    (10, "vlm_kind", "kind", "'ny'", "string", "scalar"),
    (11, "vlm_flag", "flag", "CASE WHEN o_custkey % 2 = 0 THEN 'true' ELSE 'false' END", "boolean", "scalar"),
    (12, "vlm_deep_x", "deep.x", "'{\"y\":\"PRIMARY\",\"z\":' || o_custkey || '}'", "o", "object"),
    (13, "vlm_empty_note", "empty.note", "''", "string", "object"),
]


def _j(n: int) -> str:
    _, _, _, sql, kind, _ = CANDIDATES[n]
    return f"'\"' || {sql} || '\"'" if kind == "string" else sql


RESPONSES = f"""SELECT o_orderkey AS doc_id, 1 AS page_no, '{{"header":{{"amount":' || {_j(0)} || ',"status":' || {_j(1)} || ',"note":' || {_j(2)} || ',"prio":' || {_j(3)} || ',"entity":' || {_j(4)}
  || '}},"rows":[{{"code":' || {_j(5)} || ',"zero":' || {_j(6)} || ',"n":' || {_j(7)} || ',"cust":' || {_j(8)} || '}},"stray",{{"code":' || {_j(9)} || '}}],"kind":' || {_j(10)} || ',"flag":' || {_j(11)}
  || ',"tags":["a","b"],"deep":{{"x":' || {_j(12)} || '}},"empty":{{"note":"","none":null,"list":[]}}}}' AS content FROM {{orders}}"""
CAND = "c AS (" + " UNION ALL ".join(
    f"SELECT o_orderkey AS doc_id, {n} AS n, '{name.replace('rows_1', 'rows_2')}' AS name, '{tip.replace('rows[1]', 'rows[2]')}' AS tooltip, {sql} AS value, '{kind}' AS vtype, '{branch}' AS branch FROM {{orders}}"
    for n, name, tip, sql, kind, branch in CANDIDATES) + ")"
NORM = lambda c: f"trim(regexp_replace(replace(replace(lower({c}), '$', ''), ',', ''), '\\s+', ' ', 'g'))"
UPPER = lambda c: f"(upper({c}) = {c} AND lower({c}) <> {c})"
IN_GARBAGE = ", ".join("'" + g.replace("'", "''") + "'" for g in [*rules.TEMPLATE_GARBAGE, *rules.BOX_GLYPHS])
GARBAGE = lambda c: f"""(trim({c}) = '' OR {NORM(c)} IN ({IN_GARBAGE}) OR regexp_matches(trim({c}), '{rules.NUMBERED_QUESTION}') OR (ends_with(trim({c}), '?') AND length(trim({c})) > 12)
  OR ({UPPER(f'trim({c})')} AND length(trim({c})) > 25 AND NOT regexp_matches({c}, '[0-9]') AND NOT contains({c}, ':')) OR regexp_matches(trim({c}), '{rules.CHOICE_PREFIX}'))"""
LABEL = lambda c: f"""coalesce(CASE WHEN length(trim({c})) < 3 THEN false WHEN regexp_matches(trim({c}), '{rules.NUMBERED_QUESTION}') THEN true WHEN ends_with(trim({c}), ':') AND length(trim({c})) > 5 AND {UPPER(f"trim(replace({c}, ':', ''))")} THEN true
  WHEN {UPPER(f'trim({c})')} AND length(trim({c})) > 25 THEN NOT regexp_matches({c}, '{rules.BUSINESS_SUFFIX}') AND NOT regexp_matches(trim({c}), '{rules.STREET_START}') AND NOT regexp_matches(regexp_replace(trim({c}), '^\\d+\\.\\s+', ''), '[0-9]') ELSE false END, false)"""
AMOUNT = lambda c: f"coalesce(regexp_matches(replace({c}, ' ', ''), '{rules.AMOUNT}'), false)"


@query("flt1_amounts", f"WITH f AS ({FIELDS}) SELECT doc_id, name, v_str AS value FROM f WHERE {AMOUNT('v_str')}")
def _(t: Inputs):
    return t.sql(FIELDS).where(scrub.is_amount("v_str", F.lit("string"))).select("doc_id", "name", F.col("v_str").alias("value"))


@query("flt2_labels_as_values", f"WITH f AS ({FIELDS}) SELECT doc_id, name, v_str, {LABEL('v_str')} AS is_label FROM f")
def _(t: Inputs):
    return t.sql(FIELDS).select("doc_id", "name", "v_str", scrub.is_label("v_str").alias("is_label"))


LEGACY_EXCEPTIONS = ["LLC", "LP", "INC", "OAK"]


@query("flt2_labels_legacy", f"""WITH f AS ({FIELDS}) SELECT doc_id, name, coalesce(length(v_str) >= 3 AND (({UPPER('v_str')} AND length(v_str) > 25 AND NOT ({' OR '.join(f"contains(v_str, '{e}')" for e in LEGACY_EXCEPTIONS)}))
  OR regexp_matches(v_str, '{rules.LEGACY_NUMBERED_QUESTION}')), false) AS is_label FROM f""")
def _(t: Inputs):
    return t.sql(FIELDS).select("doc_id", "name", scrub.is_label_legacy("v_str", LEGACY_EXCEPTIONS).alias("is_label"))


@query("flt3_template_garbage", f"WITH {CAND} SELECT doc_id, name, value FROM c WHERE vtype = 'string' AND {GARBAGE('value')}")
def _(t: Inputs):
    cands = reconcile.candidates(t.dealt(RESPONSES))
    return cands.where((F.col("vtype") == "string") & scrub.is_garbage("value")).select("doc_id", "name", "value")


@query("flt4_scrubbed_json", f"""SELECT o_orderkey AS doc_id, '{{"header":{{"amount":' || {_j(0)} || ',"status":' || {_j(1)} || CASE WHEN o_custkey % 4 = 3 THEN ',"note":"plain note"' ELSE '' END || ',"prio":' || {_j(3)} || ',"entity":' || {_j(4)}
  || '}},"rows":[{{"code":' || {_j(5)} || ',"zero":' || {_j(6)} || ',"n":' || {_j(7)} || ',"cust":' || {_j(8)} || '}},"stray",{{"code":' || {_j(9)} || '}}],"kind":' || {_j(10)} || ',"flag":' || {_j(11)}
  || ',"tags":["a","b"],"deep":{{"x":{{"z":' || o_custkey || '}}}}}}' AS content FROM {{orders}}""")
def _(t: Inputs):
    return scrub.scrub_json(t.sql(RESPONSES), ["doc_id"])


# A form of two pages, each with its own checkboxes.
FORM = [("form_a", 0, 0, "Party_LegalEntity_LimitedLiabilityCorporationIndicator_A[0]", "/Btn"), ("form_a", 0, 1, "Name_A", "/Tx"),
        ("form_a", 1, 0, "Bill_DirectBillIndicator_B", "/Btn"), ("form_a", 1, 1, "Name_B", "/Tx")]
PAGE_LABELS = [["limited liability corporation", *rules.CHECKBOX_SYNONYMS["limitedliabilitycorporation"], *rules.CHECKBOX_CONSTANTS],
               ["direct bill", "direct", *rules.CHECKBOX_CONSTANTS]]
# Every other page shows a page of the form whose option labels are known.
TPAGE = "CAST(floor({doc} / 4) AS BIGINT) % 2"
PAGES = f"SELECT o_orderkey AS doc_id, 1 AS page_no, CASE WHEN o_orderkey % 2 = 0 THEN 'form_a' ELSE 'form_b' END AS template, CAST({TPAGE.format(doc='o_orderkey')} AS INT) AS tpage FROM {{orders}}"


def is_option(doc: str, value: str) -> str:
    """SQL: `value` is an option label of the page that `doc` shows."""
    listed = [", ".join("'" + x.replace("'", "''") + "'" for x in page) for page in PAGE_LABELS]
    return f"({doc} % 2 = 0 AND (" + " OR ".join(f"{TPAGE.format(doc=doc)} = {n} AND {value} IN ({x})" for n, x in enumerate(listed)) + "))"


def form(t: Inputs):
    return t.rows("template string, tpage int, ord int, name string, ftype string", FORM)


PART_NAMES = """SELECT p_brand AS template, CAST(p_size % 4 AS INT) AS tpage, p_partkey AS ord, replace(p_name, ' ', '_') || CASE p_partkey % 4 WHEN 0 THEN '_JointVentureIndicator_A[0]' WHEN 1 THEN '_ProducerBillIndicator_B'
  WHEN 2 THEN '_SolidFuelIndicator' ELSE '_OwnerIndicator_C[12]' END AS name, CASE WHEN p_size % 2 = 0 THEN '/Btn' ELSE '/Tx' END AS ftype FROM {part}"""
PART_OPTION = "CASE ord % 4 WHEN 0 THEN 'joint venture' WHEN 1 THEN 'producer bill' WHEN 2 THEN 'solid fuel' ELSE 'owner' END"
SYNONYM_ROWS = [("joint venture", s) for s in ["joint venture", "jv"]] + [("producer bill", s) for s in ["agency", "producer", "agency bill", "producer bill"]] + [("owner", "owner")]


@query("flt5_checkbox_labels", f"""WITH f AS ({PART_NAMES}), o AS (SELECT DISTINCT template, tpage, {PART_OPTION} AS label FROM f WHERE ftype = '/Btn')
SELECT template, tpage, label FROM o UNION SELECT o.template, o.tpage, s.syn FROM o JOIN {values('s', 'label, syn', SYNONYM_ROWS)} ON o.label = s.label
UNION SELECT f.template, f.tpage, k.label FROM (SELECT DISTINCT template, tpage FROM f) f, {values('k', 'label', [(c,) for c in rules.CHECKBOX_CONSTANTS])}""")
def _(t: Inputs):
    return scrub.checkbox_labels(t.sql(PART_NAMES))


EMPTY_MEMBERS = " UNION ALL SELECT o_orderkey, 'vlm_empty_none', NULL FROM {orders} UNION ALL SELECT o_orderkey, 'vlm_empty_list', '[]' FROM {orders}"


@query("flt6_drop_option_labels", f"WITH {CAND} SELECT doc_id, name, value FROM c WHERE NOT (vtype = 'string' AND {is_option('doc_id', NORM('value'))}){EMPTY_MEMBERS}")
def _(t: Inputs):
    cands = reconcile.candidates(t.dealt(RESPONSES))
    return scrub.drop_option_labels(cands, t.sql(PAGES), scrub.checkbox_labels(form(t))).select("doc_id", "name", "value")


BLED = "SELECT o_orderkey AS doc_id, CASE o_orderkey % 4 WHEN 0 THEN 'Alpha LLC ' || o_custkey || ' N Oak Ave' WHEN 1 THEN 'Beta Inc' WHEN 2 THEN o_custkey || ' Elm street' ELSE 'Suite ' || o_custkey END AS value FROM {orders}"


@query("flt7_bled_address", f"SELECT doc_id, value, regexp_matches(value, '{rules.ADDRESS_BLED}') AS bled FROM ({BLED})")
def _(t: Inputs):
    return t.sql(BLED).select("doc_id", "value", scrub.bled_address("value").alias("bled"))


@query("flt8_enough_cells", """SELECT l_orderkey AS doc_id, l_linenumber AS row_no, l_partkey, 1 + CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END + CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END + CASE WHEN l_partkey % 2 = 0 THEN 1 ELSE 0 END >= 3 AS enough FROM {lineitem}""")
def _(t: Inputs):
    grid = t.sql("SELECT l_orderkey AS doc_id, l_linenumber AS row_no, l_partkey, array('x', CASE WHEN l_returnflag = 'A' THEN 'a' ELSE ' ' END, CASE WHEN l_linestatus = 'F' THEN 'f' END, CASE WHEN l_partkey % 2 = 0 THEN 'p' ELSE '' END) AS r FROM {lineitem}")
    return grid.select("doc_id", "row_no", "l_partkey", scrub.enough_cells("r", 3).alias("enough"))


@query("rec1_primary_split", f"""WITH f AS ({FIELDS}) SELECT doc_id, name, v_str, CASE WHEN {LABEL('v_str')} THEN 'label_as_value' ELSE 'bbox' END AS outcome, CASE WHEN {LABEL('v_str')} THEN NULL ELSE source END AS source_detail FROM f""")
def _(t: Inputs):
    kept, bad = reconcile.split_primary(t.sql(FIELDS))
    return kept.select("doc_id", "name", "v_str", F.col("source").alias("outcome"), "source_detail").unionByName(
        bad.select("doc_id", F.col("field").alias("name"), F.col("value").alias("v_str"), F.col("issue").alias("outcome"), F.lit(None).cast("string").alias("source_detail")))


@query("rec2_model_candidates", f"""WITH {CAND} SELECT doc_id, name, tooltip, value, vtype, branch FROM c
UNION ALL SELECT o_orderkey, 'vlm_empty_none', 'empty.none', NULL, 'null', 'object' FROM {{orders}} UNION ALL SELECT o_orderkey, 'vlm_empty_list', 'empty.list', '[]', 'array', 'object' FROM {{orders}}""")
def _(t: Inputs):
    return reconcile.candidates(t.dealt(RESPONSES)).select("doc_id", "name", "tooltip", "value", "vtype", "branch")


# Short values of the test are plain words, so whether an earlier one was itself dropped makes no difference here.
FILLS = f"""{CAND}, f AS ({FIELDS}), pk AS (SELECT doc_id, v_str FROM f WHERE v_str IS NOT NULL AND NOT {LABEL('v_str')}),
s AS (SELECT doc_id, n, name, CASE WHEN vtype = 'o' THEN '{{"z":' || (doc_id * 0 + CAST(regexp_extract(value, 'z":(\\d+)', 1) AS BIGINT)) || '}}' ELSE value END AS value, vtype, CASE WHEN vtype <> 'o' THEN {NORM('value')} END AS norm FROM c
  WHERE NOT (vtype = 'string' AND {GARBAGE('value')}) AND NOT (branch = 'array' AND vtype = 'string' AND value IN ('0', '0.0', '$0.00')) AND NOT (vtype = 'string' AND {is_option('doc_id', NORM('value'))})),
fills AS (SELECT s.* FROM s WHERE NOT EXISTS (SELECT 1 FROM pk WHERE pk.doc_id = s.doc_id AND {NORM('pk.v_str')} = s.norm)
  AND NOT (coalesce(length(s.norm) BETWEEN 1 AND 3, false) AND (EXISTS (SELECT 1 FROM pk WHERE pk.doc_id = s.doc_id AND regexp_matches(lower(pk.v_str), '\\b' || s.norm || '\\b'))
    OR EXISTS (SELECT 1 FROM s e WHERE e.doc_id = s.doc_id AND e.n < s.n AND e.vtype = 'string' AND regexp_matches(lower(e.value), '\\b' || s.norm || '\\b')))))"""


@query("rec3_gap_fills", f"WITH {FILLS} SELECT doc_id, name, value, vtype FROM fills")
def _(t: Inputs):
    kept, _ = reconcile.split_primary(t.sql(FIELDS))
    clean = scrub.drop_option_labels(reconcile.scrub_candidates(reconcile.candidates(t.dealt(RESPONSES))), t.sql(PAGES), scrub.checkbox_labels(form(t)))
    return reconcile.gap_fills(kept, clean).select("doc_id", "name", "value", "vtype")


@query("rec4_gap_fills_legacy", f"""WITH {CAND}, f AS ({FIELDS}), pk AS (SELECT doc_id, v_str FROM f WHERE v_str IS NOT NULL AND NOT {LABEL('v_str')}),
s AS (SELECT * FROM c WHERE value <> '' AND NOT (vtype = 'boolean' AND value = 'false') AND NOT (vtype = 'number' AND value = '0') AND NOT (branch = 'array' AND value = '0'))
SELECT doc_id, name, value FROM s WHERE NOT EXISTS (SELECT 1 FROM pk WHERE pk.doc_id = s.doc_id AND contains(lower(pk.v_str), lower(s.value)))
  AND NOT EXISTS (SELECT 1 FROM s e WHERE e.doc_id = s.doc_id AND e.n < s.n AND e.vtype = 'string' AND contains(lower(e.value), lower(s.value)))""")
def _(t: Inputs):
    kept, _ = reconcile.split_primary(t.sql(FIELDS))
    return reconcile.gap_fills_legacy(kept, reconcile.candidates(t.dealt(RESPONSES)), t.parts(t.table("orders"))).select("doc_id", "name", "value")


VALUES_TEXT = "string_agg(' ' || lower(coalesce(value, '')) || ' ', ' ')"
UNCONFIRMED = f"""{CAND}, f AS ({FIELDS}), t AS (SELECT doc_id, replace({VALUES_TEXT}, ',', '') AS txt FROM c GROUP BY doc_id), a AS (SELECT doc_id, name, v_str, replace(replace(v_str, ',', ''), '$', '') AS amount FROM f WHERE {AMOUNT('v_str')} AND NOT {LABEL('v_str')}),
un AS (SELECT a.doc_id, a.name AS field, a.v_str AS value, 'amount_not_in_vlm' AS issue FROM a JOIN t ON a.doc_id = t.doc_id WHERE NOT contains(t.txt, a.amount))"""


@query("rec5_unconfirmed_amounts", f"WITH {UNCONFIRMED} SELECT * FROM un")
def _(t: Inputs):
    kept, _ = reconcile.split_primary(t.sql(FIELDS))
    return reconcile.unconfirmed_amounts(kept, t.dealt(RESPONSES)).drop("page_no")


def merged(t: Inputs):
    return reconcile.merge(t.sql(FIELDS), t.dealt(RESPONSES), t.sql(PAGES), scrub.checkbox_labels(form(t)))


MERGED = f"""{FILLS}, mg AS (SELECT doc_id, 1 AS page_no, name, v_str, v_bool, ftype, source AS source_detail, 'bbox' AS source FROM f WHERE NOT {LABEL('v_str')}
  UNION ALL SELECT doc_id, 1, name, CASE WHEN vtype <> 'boolean' THEN value END, CASE WHEN vtype = 'boolean' THEN value = 'true' END, 'text', 'vlm', 'vlm' FROM fills)"""


@query("rec6_merged_fields", f"WITH {MERGED} SELECT doc_id, name, v_str, v_bool, ftype, source, source_detail FROM mg")
def _(t: Inputs):
    return merged(t)[0].select("doc_id", "name", "v_str", "v_bool", "ftype", "source", "source_detail")


@query("rec6_discrepancies", f"""WITH {UNCONFIRMED} SELECT * FROM un UNION ALL SELECT doc_id, name, v_str, 'label_as_value' FROM f WHERE {LABEL('v_str')}""")
def _(t: Inputs):
    return merged(t)[1].drop("page_no")


@query("rec6_merge_counts", f"""WITH {MERGED} SELECT doc_id, count(DISTINCT page_no) FILTER (source = 'bbox') AS pages_with_data, count(*) FILTER (source = 'bbox') AS box_fields,
count(*) FILTER (source <> 'bbox') AS gap_fills, count(*) FILTER (source = 'bbox' AND v_bool) AS checked FROM mg GROUP BY doc_id""")
def _(t: Inputs):
    return reconcile.merge_counts(merged(t)[0])


# Page texts end in a line of facts; the values repeat it, reorder it, or get it wrong.
PAGE_TEXT = """SELECT CAST(floor(doc_id / 4) AS BIGINT) AS doc_id, CAST(doc_id % 4 AS INT) AS page_no, doc_id AS k, CASE WHEN doc_id % 17 = 0 THEN NULL ELSE text || chr(10) || 'Paid $1,' || (1000 + doc_id % 500) || '.50 on 0' || (doc_id % 9 + 1) || '/0' || (doc_id % 7 + 1)
  || '/2025' || chr(10) || doc_id || ' Elm Str' || chr(10) || 'Springfield NY ' || (10000 + doc_id) END AS text FROM {documents}"""
CHECKED = [("amount", "'1' || (1000 + k % 500) || '.50'", "number"), ("date", "(k % 9 + 1) || '/' || (k % 7 + 1) || '/2025'", "string"), ("street", "k || ' Elm StrSpringfield'", "string"),
           ("city", "(10000 + k) || ' Springfield NY'", "string"), ("wrong", "(70000 + k) || ' NY'", "string"), ("short", "'abc'", "string"), ("word", "'Elmwood'", "string"), ("flag", "'true'", "boolean")]
SPARK_LEAVES = "WITH p AS (" + PAGE_TEXT + ") " + " UNION ALL ".join(f"SELECT doc_id, page_no, '{n}' AS path, {v} AS value, '{ty}' AS vtype FROM p" for n, v, ty in CHECKED)
RAW = lambda c: f"regexp_replace(regexp_replace({NORM(c)}, '\\b0(\\d)/', '\\1/', 'g'), '/0(\\d)\\b', '/\\1', 'g')"
STATUS = f"""p AS ({PAGE_TEXT}), v AS ({" UNION ALL ".join(f"SELECT doc_id, page_no, '{n}' AS path, {v} AS value, '{ty}' AS vtype FROM p" for n, v, ty in CHECKED)}),
q AS (SELECT doc_id, page_no, {RAW('text')} AS norm FROM p WHERE text IS NOT NULL), j AS (SELECT v.*, {RAW('v.value')} AS c, q.norm FROM v LEFT JOIN q ON v.doc_id = q.doc_id AND v.page_no = q.page_no),
st AS (SELECT doc_id, page_no, path, value, CASE WHEN norm IS NULL OR length(trim(value)) < 4 OR NOT regexp_matches(c, '[0-9]') THEN 'skipped' WHEN contains(norm, c) OR contains(replace(norm, ' ', ''), replace(c, ' ', ''))
  OR len(list_filter(string_split(c, ' '), lambda x: length(x) >= 2 AND NOT contains(norm, x))) = 0 THEN 'confirmed' ELSE 'not_in_raw_text' END AS status FROM j)"""


def checked(t: Inputs):
    return reconcile.text_check(t.sql(SPARK_LEAVES), t.sql(PAGE_TEXT).drop("k"))


@query("rec7_text_check", f"WITH {STATUS} SELECT doc_id, page_no, path, value, status FROM st")
def _(t: Inputs):
    return checked(t).drop("vtype")


@query("rec8_confirmation_report", f"""WITH {STATUS} SELECT doc_id, page_no, count(*) AS n_values, count(*) FILTER (status = 'confirmed') AS confirmed, count(*) FILTER (status = 'not_in_raw_text') AS unconfirmed FROM st GROUP BY ROLLUP (doc_id, page_no)""")
def _(t: Inputs):
    return reconcile.confirmation_report(checked(t))


RUN_A = f"SELECT o_orderkey AS doc_id, 1 AS page_no, 'price' AS path, {PRICE} AS value FROM {{orders}} UNION ALL SELECT o_orderkey, 1, 'status', CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE o_orderstatus END FROM {{orders}} WHERE o_custkey % 4 > 0"
RUN_B = f"SELECT o_orderkey AS doc_id, 1 AS page_no, 'price' AS path, CASE WHEN o_custkey % 6 = 0 THEN '0' ELSE {PRICE} END AS value FROM {{orders}} WHERE o_custkey % 5 > 0 UNION ALL SELECT o_orderkey, 1, 'status', CASE WHEN o_custkey % 18 = 0 THEN NULL ELSE o_orderstatus END FROM {{orders}}"
RUNS = f"""r AS (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, coalesce(a.page_no, b.page_no) AS page_no, coalesce(a.path, b.path) AS path, a.value AS value_a, b.value AS value_b, CASE WHEN b.doc_id IS NULL THEN 'only_a' WHEN a.doc_id IS NULL THEN 'only_b'
  WHEN a.value IS NOT DISTINCT FROM b.value THEN 'same' ELSE 'different' END AS agreement FROM ({RUN_A}) a FULL JOIN ({RUN_B}) b ON a.doc_id = b.doc_id AND a.page_no = b.page_no AND a.path = b.path)"""


@query("rec9_compare_runs", f"WITH {RUNS} SELECT * FROM r")
def _(t: Inputs):
    return reconcile.compare_runs(t.sql(RUN_A), t.sql(RUN_B))


# Both pages of the form list all fields.
INSPECT = [("form_a", page, i, n, k) for page in (0, 1) for i, (n, k) in enumerate([("Amount_A[0]", "/Tx"), ("Status_A", "/Tx"), ("Question_A", "/Tx"), ("Priority_A", "/Tx"), ("Check_AgencyIndicator_A", "/Btn"), ("Missing_A", "/Tx")])]


@query("rec10_inspector", f"""WITH f AS ({FIELDS}), m AS ({PAGES}), i AS (SELECT m.doc_id, m.page_no, x.name, x.ftype AS kind FROM m JOIN {values('x', 'template, tpage, ord, name, ftype', INSPECT)} ON m.template = x.template AND m.tpage = x.tpage)
SELECT i.*, CASE WHEN f.name IS NULL THEN 'absent' WHEN f.v_bool THEN 'checked' WHEN NOT f.v_bool THEN 'unchecked' ELSE 'text' END AS state, CASE WHEN f.name IS NULL THEN '(no extracted value)' WHEN f.v_bool THEN 'true' WHEN NOT f.v_bool THEN 'false' ELSE f.v_str END AS preview, f.v_str AS value,
coalesce(f.v_bool, f.v_str IS NOT NULL) AS populated FROM i LEFT JOIN f ON i.doc_id = f.doc_id AND i.page_no = f.page_no AND i.name = f.name""")
def _(t: Inputs):
    fields = t.rows("template string, tpage int, ord int, name string, ftype string", INSPECT)
    return reconcile.listing_order(reconcile.inspector(fields, t.sql(PAGES), t.sql(FIELDS)))


@query("rec11_page_bundle", f"""WITH p AS ({PAGE_TEXT}), {RUNS} SELECT p.doc_id, p.page_no, p.text, 'r' || p.k AS content, (SELECT count(*) FROM {{orders}} o WHERE o.o_custkey = p.doc_id AND o.o_orderkey % 4 = p.page_no) AS n_claims,
(SELECT count(*) FROM {{orders}} o WHERE o.o_orderkey = p.doc_id AND p.page_no = 1 AND o.o_custkey % 6 = 0) AS n_discrepancies FROM p""")
def _(t: Inputs):
    pages = t.sql(PAGE_TEXT)
    responses = pages.select("doc_id", "page_no", F.concat(F.lit("r"), "k").alias("content"))
    claims = t.sql("SELECT o_custkey AS doc_id, CAST(o_orderkey % 4 AS INT) AS page_no FROM {orders}")
    bad = t.sql("SELECT o_orderkey AS doc_id, 1 AS page_no FROM {orders} WHERE o_custkey % 6 = 0")
    return reconcile.page_bundle(responses, pages.drop("k"), claims, bad)


# Model answers as raw text: JSON with talk around it, lists, cut-off and empty answers, a repeated key.
ANSWERS = """SELECT event_id AS doc_id, 1 AS page_no, CASE event_id % 8 WHEN 0 THEN 'Here you go: ' || props || ' done' WHEN 1 THEN 'list [' || user_id || ', 2] and more' WHEN 2 THEN '{"a": ' || user_id WHEN 3 THEN '' WHEN 4 THEN '{"a":1,"a":2}'
  WHEN 5 THEN '[' || props || ']' WHEN 6 THEN NULL ELSE '{broken} then [' || user_id || ']' END AS content FROM {events}"""


@query("src6_response_ingest", f"""WITH a AS ({ANSWERS}) SELECT a.doc_id, CASE a.doc_id % 8 WHEN 2 THEN 'RAW' WHEN 3 THEN 'ERROR' WHEN 4 THEN 'RAW' WHEN 6 THEN 'ERROR' ELSE 'OK' END AS status,
CASE a.doc_id % 8 WHEN 0 THEN e.props WHEN 1 THEN '[' || e.user_id || ', 2]' WHEN 5 THEN e.props WHEN 7 THEN '[' || e.user_id || ']' END AS data, CASE WHEN a.doc_id % 8 IN (2, 4) THEN a.content END AS raw FROM a JOIN events e ON a.doc_id = e.event_id""")
def _(t: Inputs):
    return readers.ingest_responses(t.sql(ANSWERS)).select("doc_id", "status", "data", "raw")


@query("src6_first_bracket", f"""WITH a AS ({ANSWERS}) SELECT a.doc_id, CASE a.doc_id % 8 WHEN 2 THEN 'RAW' WHEN 3 THEN 'ERROR' WHEN 4 THEN 'RAW' WHEN 6 THEN 'ERROR' WHEN 7 THEN 'RAW' ELSE 'OK' END AS status,
CASE a.doc_id % 8 WHEN 0 THEN e.props WHEN 1 THEN '[' || e.user_id || ', 2]' WHEN 5 THEN '[' || e.props || ']' END AS data FROM a JOIN events e ON a.doc_id = e.event_id""")
def _(t: Inputs):
    return readers.ingest_responses(t.sql(ANSWERS), first_bracket=True).select("doc_id", "status", "data")
