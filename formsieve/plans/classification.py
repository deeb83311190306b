"""Queries of page, document and file classification."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import classify
from ..rules import classify as rules
from ..session import run_folder
from ..sources import readers
from .registry import Inputs, query, rule_case, values

# Page text: every document is one page of a five-page package; some pages end in a form footer or carry form headers,
# claim headers, schedule headers, or next to nothing.
PAGE_TEXT = """SELECT CAST(floor(doc_id / 5) AS BIGINT) AS doc_id, CAST(doc_id % 5 + 1 AS INT) AS page_no,
  CASE doc_id % 13
    WHEN 0 THEN text || chr(10) || 'ACORD 125 (2016/03)'
    WHEN 1 THEN text || chr(10) || 'Acord 126 (2014/04)   page'
    WHEN 2 THEN 'ACORD 140 (2014/12) ' || text || chr(10) || 'no footer here'
    WHEN 3 THEN 'Property Section' || chr(10) || 'Blanket Summary' || chr(10) || 'Wiring ' || text
    WHEN 4 THEN 'Commercial General Liability Section. Schedule of Hazards. ' || text
    WHEN 5 THEN 'Loss Run valuation date 2024 Claim # Date of Loss total paid ' || text
    WHEN 6 THEN 'Schedule of Values Loc # Building # ' || text
    WHEN 7 THEN 'short page'
    WHEN 8 THEN 'claimant and loss date only ' || text
    WHEN 9 THEN 'Umbrella Excess Liability each occurrence ' || text
    WHEN 10 THEN 'garbled (cid:12)(cid:7) ' || text
    ELSE text END AS text
FROM {documents}"""

FOOTER = rule_case("right(text, 300)", rules.FOOTERS, None)
SCORED = " UNION ALL ".join(
    f"SELECT doc_id, page_no, {i} AS n, '{name}' AS template, " + " + ".join(
        [f"{rules.STRONG} * CAST(contains(up, '{p}') AS INT)" for p in strong] + [f"{rules.WEAK} * CAST(contains(up, '{p}') AS INT)" for p in weak]) + " AS score FROM u"
    for i, (name, (strong, weak)) in enumerate(rules.FINGERPRINTS.items()))
SCORES = f"p AS ({PAGE_TEXT}), u AS (SELECT doc_id, page_no, upper(text) AS up FROM p), s AS ({SCORED})"
RANKED = ("r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_no ORDER BY score DESC, n) AS k, "
          "lead(score) OVER (PARTITION BY doc_id, page_no ORDER BY score DESC, n) AS second FROM s), "
          f"f AS (SELECT doc_id, page_no, template FROM r WHERE k = 1 AND score >= {rules.MIN_SCORE} AND score - second >= {rules.MIN_MARGIN})")
TEMPLATE = f"""{SCORES}, {RANKED}, m AS (SELECT p.*, {FOOTER} AS footer FROM p),
t AS (SELECT m.doc_id, m.page_no, m.text, CASE WHEN trim(m.text) <> '' THEN coalesce(m.footer, f.template) END AS template
      FROM m LEFT JOIN f ON m.doc_id = f.doc_id AND m.page_no = f.page_no)"""


def _count(patterns: list[str]) -> str:
    return " + ".join(f"CAST(regexp_matches(text, '{p}') AS INT)" for p in patterns)


KIND = f"""{TEMPLATE}, g AS (SELECT *, length(trim(text)) AS n, {_count(rules.LOSS_SIGNALS)} AS loss, {_count(rules.SCHEDULE_SIGNALS)} AS sched FROM t),
kinds AS (SELECT doc_id, page_no, CASE WHEN n < 30 THEN 'EMPTY' WHEN template IS NOT NULL THEN 'ACORD_FORM' WHEN loss >= 3 THEN 'LOSS_RUN'
  WHEN sched >= 2 THEN 'SOV_TABLE' WHEN n > 300 THEN 'NARRATIVE' ELSE 'UNKNOWN' END AS kind,
  CASE WHEN n < 30 THEN n WHEN template IS NOT NULL THEN NULL WHEN loss >= 3 THEN loss WHEN sched >= 2 THEN sched ELSE n END AS detail FROM g)"""


def page_text(t: Inputs):
    return t.sql(PAGE_TEXT)


@query("cls1_footer_match", f"WITH p AS ({PAGE_TEXT}) SELECT doc_id, page_no, {FOOTER} AS template FROM p")
def _(t: Inputs):
    return page_text(t).select("doc_id", "page_no", classify.footer_template(classify.page_end("text")).alias("template"))


@query("cls2_fingerprint_scores", f"WITH {SCORES} SELECT doc_id, page_no, template, CAST(score AS BIGINT) AS score FROM s")
def _(t: Inputs):
    return classify.fingerprint_scores(page_text(t)).withColumn("score", F.col("score").cast("bigint"))


@query("cls3_best_template", f"WITH {SCORES}, {RANKED} SELECT p.doc_id, p.page_no, f.template FROM p LEFT JOIN f ON p.doc_id = f.doc_id AND p.page_no = f.page_no")
def _(t: Inputs):
    return classify.with_template(page_text(t)).select("doc_id", "page_no", F.col("fingerprint").alias("template"))


# Form pages: the benchmark texts, eight to a form. A filled page quotes the text of one of them.
FORM_PAGES = "SELECT concat('form_', CAST(floor(item_id / 8) AS BIGINT)) AS template, CAST(item_id % 8 AS INT) AS tpage, text FROM {benchmark}"
FILLED_PAGES = """SELECT d.doc_id, 1 AS page_no, concat('form_', CAST(floor(b.item_id / 8) AS BIGINT)) AS template, d.text || ' ' || b.text AS text
FROM {documents} d JOIN {benchmark} b ON b.item_id = d.doc_id % (SELECT count(*) FROM {benchmark})"""


@query("cls4_template_page", f"""WITH w AS (SELECT template, tpage, list_distinct(regexp_extract_all(upper(text), '{rules.TEMPLATE_PHRASE}')) AS phrases FROM ({FORM_PAGES})),
x AS (SELECT template, tpage, unnest(phrases) AS phrase FROM w), d AS ({FILLED_PAGES}), n AS (
  SELECT d.doc_id, x.tpage, count(*) FILTER (contains(upper(d.text), x.phrase)) AS c FROM d JOIN x ON d.template = x.template GROUP BY ALL)
SELECT d.doc_id, coalesce(min(b.tpage), 0) AS tpage FROM d LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY c DESC, tpage) AS k FROM n) b
  ON d.doc_id = b.doc_id AND b.k = 1 GROUP BY d.doc_id""")
def _(t: Inputs):
    return classify.template_page(t.sql(FILLED_PAGES), classify.template_phrases(t.sql(FORM_PAGES))).select("doc_id", "tpage")


AVAILABLE = ["acord_125", "acord_126", "acord_131", "acord_140"]


@query("cls5_page_form", f"""WITH {TEMPLATE} SELECT doc_id, page_no, CASE WHEN template = 'acord_126_2014' THEN 'acord_126'
  WHEN template IN ('acord_125', 'acord_126', 'acord_131', 'acord_140') THEN template END AS template FROM t""")
def _(t: Inputs):
    return classify.with_template(page_text(t), AVAILABLE).select("doc_id", "page_no", "template")


@query("cls6_page_kind", f"WITH {KIND} SELECT doc_id, page_no, kind, CAST(detail AS BIGINT) AS detail FROM kinds")
def _(t: Inputs):
    return classify.with_page_kind(page_text(t)).select("doc_id", "page_no", "kind", F.col("detail").cast("bigint").alias("detail"))


@query("cls7_page_runs", f"""WITH {KIND}, c AS (SELECT *, CASE WHEN kind = lag(kind) OVER w THEN 0 ELSE 1 END AS change FROM kinds WINDOW w AS (PARTITION BY doc_id ORDER BY page_no)),
i AS (SELECT *, sum(change) OVER (PARTITION BY doc_id ORDER BY page_no) AS run_no FROM c)
SELECT doc_id, CAST(run_no AS BIGINT) AS run_no, min(kind) AS kind, min(page_no) AS first_page, max(page_no) AS last_page, count(*) AS n_pages FROM i GROUP BY doc_id, run_no""")
def _(t: Inputs):
    return classify.page_runs(classify.with_page_kind(page_text(t)))


TURNS = "SELECT conv_id AS doc_id, CAST(turn + 1 AS INT) AS page_no, CASE WHEN turn % 4 = 3 THEN 'user' ELSE role END AS kind FROM {conversations}"


@query("cls7_turn_runs", f"""WITH k AS ({TURNS}), c AS (SELECT *, CASE WHEN kind = lag(kind) OVER (PARTITION BY doc_id ORDER BY page_no) THEN 0 ELSE 1 END AS change FROM k),
i AS (SELECT *, sum(change) OVER (PARTITION BY doc_id ORDER BY page_no) AS run_no FROM c)
SELECT doc_id, CAST(run_no AS BIGINT) AS run_no, min(kind) AS kind, min(page_no) AS first_page, max(page_no) AS last_page, count(*) AS n_pages FROM i GROUP BY doc_id, run_no""")
def _(t: Inputs):
    return classify.page_runs(t.sql(TURNS))


PRIMARY = f"""{KIND}, h AS (SELECT doc_id, kind, count(*) AS n, min(page_no) AS first FROM kinds GROUP BY doc_id, kind),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY (kind IN ('EMPTY', 'UNKNOWN')), n DESC, first) AS k FROM h),
prim AS (SELECT doc_id, max(CASE WHEN k = 1 AND kind NOT IN ('EMPTY', 'UNKNOWN') THEN kind END) AS kind, CAST(sum(n) AS BIGINT) AS n_pages FROM o GROUP BY doc_id)"""


@query("cls8_primary_kind", f"WITH {PRIMARY} SELECT doc_id, coalesce(kind, 'UNKNOWN') AS primary_kind, n_pages FROM prim")
def _(t: Inputs):
    return classify.primary_kind(classify.with_page_kind(page_text(t))).drop("kinds_present")


# File names: the last part of the page address in the guise of the names packages use.
FILE_NAMES = """SELECT page_id AS doc_id, CASE page_id % 11
  WHEN 0 THEN 'Loss Run ' || page_id || '.PDF' WHEN 1 THEN 'LR_' || page_id || '_values.pdf' WHEN 2 THEN 'Acord 125 ' || page_id || '.pdf'
  WHEN 3 THEN 'app_acord.v2 ' || page_id || '.pdf' WHEN 4 THEN 'Supplemental form ' || page_id || '.docx' WHEN 5 THEN 'Questionnaire' || page_id || '.xlsx'
  WHEN 6 THEN 'SOV ' || page_id || '.XLS' WHEN 7 THEN 'broker email ' || page_id || '.docx' WHEN 8 THEN 'claims-history' || page_id
  ELSE regexp_replace(url, '^.*[/]', '') || '.' || page_id || '.pdf' END AS file_name FROM {pages}"""
BY_NAME = rule_case("lower(file_name)", rules.FILE_TYPES, rules.FILE_TYPE_DEFAULT)


@query("cls9_filename_type", f"WITH f AS ({FILE_NAMES}) SELECT doc_id, {BY_NAME} AS doc_type FROM f")
def _(t: Inputs):
    return t.sql(FILE_NAMES).select("doc_id", classify.file_type("file_name").alias("doc_type"))


@query("cls10_content_override", f"""WITH {PRIMARY}, names AS ({FILE_NAMES}), n AS (SELECT doc_id, {BY_NAME} AS by_name FROM names)
SELECT n.doc_id, CASE prim.kind WHEN 'ACORD_FORM' THEN 'acord_application' WHEN 'LOSS_RUN' THEN 'loss_run' ELSE n.by_name END AS doc_type
FROM n LEFT JOIN prim ON n.doc_id = prim.doc_id""")
def _(t: Inputs):
    kinds = classify.primary_kind(classify.with_page_kind(page_text(t)))
    names = t.sql(FILE_NAMES).select("doc_id", classify.file_type("file_name").alias("by_name"))
    return names.join(kinds, "doc_id", "left").select("doc_id", F.coalesce(classify.routed_type("by_name", "primary_kind"), "by_name").alias("doc_type"))


SUFFIX = r"lower(regexp_extract(file_name, '^.+(\.[^.]*)$', 1))"


@query("cls11_attachments", f"""WITH f AS ({FILE_NAMES}) SELECT doc_id, file_name, {rule_case("lower(file_name)", rules.ATTACHMENT_TYPES, "Other")} AS attachment_type,
CASE {SUFFIX} {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.MIME_TYPES.items())} ELSE '{rules.MIME_DEFAULT}' END AS mime_type,
regexp_replace(file_name, '(.)\\.[^.]*$', '\\1') AS description FROM f""")
def _(t: Inputs):
    return classify.attachments(t.sql(FILE_NAMES))


ROUTED = "SELECT o_orderkey AS doc_id, CAST(o_orderkey % 4 + 1 AS INT) AS page_no, CASE o_custkey % 5 WHEN 0 THEN 'loss_run' WHEN 1 THEN 'questionnaire' WHEN 2 THEN 'acord_application' WHEN 3 THEN 'supplemental_application' ELSE 'other' END AS doc_type FROM {orders}"
ROUTES = [*rules.PROMPT_ROUTES, *[("acord_application", i, f"FORM_P{i}") for i in (1, 2, 3)]]


@query("cls12_prompt_routes", f"""WITH p AS ({ROUTED}), r AS (SELECT * FROM {values("v", "doc_type, page_no, prompt_id", ROUTES)})
SELECT p.doc_id, p.page_no, coalesce(a.prompt_id, b.prompt_id, 'GENERALIZED') AS prompt_id FROM p
LEFT JOIN r a ON p.doc_type = a.doc_type AND a.page_no IS NULL LEFT JOIN r b ON p.doc_type = b.doc_type AND p.page_no = b.page_no""")
def _(t: Inputs):
    routes = t.rows("doc_type string, page_no int, prompt_id string", ROUTES)
    return classify.prompt_routes(t.sql(ROUTED), routes).select("doc_id", "page_no", "prompt_id")


# Template fields: part rows as boxes of forms.
PART_FIELDS = """SELECT p_brand AS template, CAST(p_size % 4 AS INT) AS tpage, p_partkey AS ord,
  replace(p_name, ' ', '_') || CASE p_partkey % 3 WHEN 0 THEN '_LimitedLiabilityCorporationIndicator_A[0]' WHEN 1 THEN '_DirectBillIndicator_B' ELSE '_FullName_A[0]' END AS name,
  CASE WHEN p_partkey % 3 < 2 THEN '/Btn' ELSE '/Tx' END AS ftype, p_type AS tooltip FROM {part}"""


@query("cls12_checkbox_hints", f"""SELECT template, tpage, count(*) FILTER (ftype = '/Btn') AS n_checkboxes, count(*) FILTER (ftype = '/Tx') AS n_text_fields
FROM ({PART_FIELDS}) GROUP BY template, tpage""")
def _(t: Inputs):
    return classify.checkbox_hints(t.sql(PART_FIELDS))


@query("cls13_unreadable_pages", f"""SELECT doc_id, page_no, CASE WHEN contains(text, '(cid:') THEN '' ELSE text END AS text, contains(text, '(cid:') AS garbled,
length(text) AS raw_chars FROM ({PAGE_TEXT})""")
def _(t: Inputs):
    return classify.readable(page_text(t))


GROUPS = rules.DISCOVERY
GROUP_ROWS = [(g, p.lower()) for g, parts in GROUPS.items() for p in parts]
FILES = "SELECT o_custkey AS submission, CASE o_orderkey % 6 WHEN 0 THEN 'Acord_' WHEN 1 THEN 'x_SOV_' WHEN 2 THEN 'LR_' WHEN 3 THEN 'the_Email_' WHEN 4 THEN 'Some_LLC_Master_' ELSE 'zzz' END || o_orderkey || '.json' AS file_name FROM {orders}"
FOUND = f"SELECT DISTINCT f.submission, g.grp, f.file_name FROM ({FILES}) f JOIN {values('g', 'grp, part', GROUP_ROWS)} ON contains(lower(f.file_name), g.part)"


# A package folder per 32nd of the pages, two kinds of files in it; a text file ends every page with a line break.
@query("src1_package_files", """SELECT 'pkg=' || page_id % 32 AS package, CASE WHEN page_id % 3 = 0 THEN '.json' ELSE '.txt' END AS suffix, true AS sized,
  CAST(sum(CASE WHEN page_id % 3 = 0 THEN 12 + length(CAST(page_id AS VARCHAR)) ELSE strlen(coalesce(html, '')) END + 1) AS BIGINT) AS n_bytes FROM {pages} GROUP BY ALL""")
def _(t: Inputs):
    folder, pages = f"{run_folder(t.spark)}/src1-{uuid.uuid4().hex}", t.table("pages").withColumn("pkg", F.col("page_id") % 32)
    dealt = pages.repartition("pkg")
    dealt.where("page_id % 3 <> 0").select(F.coalesce("html", F.lit("")).alias("value"), "pkg").write.partitionBy("pkg").text(f"{folder}/in/text")
    dealt.where("page_id % 3 = 0").select("page_id", "pkg").write.partitionBy("pkg").json(f"{folder}/in/records")
    files = readers.scan_files(t.spark, folder).where(F.startswith("file_name", F.lit("part-")))
    return files.groupBy(F.element_at(F.split("path", "/"), -2).alias("package"), "suffix").agg(
        F.bool_and(F.col("modified_ts").isNotNull() & (F.col("n_bytes") > 0)).alias("sized"), F.sum("n_bytes").alias("n_bytes"))


@query("src3_find_all_files", FOUND)
def _(t: Inputs):
    return readers.find_files(t.sql(FILES), GROUPS, ["submission"])


@query("src3_find_first_file", f"SELECT submission, grp, min(file_name) AS file_name FROM ({FOUND}) GROUP BY submission, grp")
def _(t: Inputs):
    return readers.find_first(t.sql(FILES), GROUPS, ["submission"])
