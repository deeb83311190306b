"""Queries of reading values by position: words are the words of the documents, placed on pages of fifty lines."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import raster, spatial
from .registry import Inputs, query, values

_PLACE = """CAST(floor(l / 50) AS INT) + 1 AS page_no, CAST(l AS BIGINT) * 100000 + p AS ord, w AS text, CAST(20 + p * 40 AS DOUBLE) AS x0,
  CAST(20 + p * 40 + 6 * length(w) AS DOUBLE) AS x1, CAST((l % 50) * 120 + 100 + (p % 3) * 4 AS DOUBLE) / 10 AS top,
  CAST((l % 50) * 120 + 180 + (p % 3) * 4 AS DOUBLE) / 10 AS bottom"""
SPARK_WORDS = f"""SELECT doc_id, concat('form_', doc_id % 3) AS ptype, {_PLACE} FROM
  (SELECT doc_id, l, posexplode(split(line, ' ')) AS (p, w) FROM (SELECT doc_id, posexplode(split(text, '\\n')) AS (l, line) FROM {{documents}})) WHERE w <> ''"""
WORDS = f"""SELECT doc_id, 'form_' || (doc_id % 3) AS ptype, {_PLACE} FROM (SELECT doc_id, l, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS p FROM
  (SELECT doc_id, l, string_split(line, ' ') AS ws FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS l FROM
    (SELECT doc_id, string_split(text, chr(10)) AS ls FROM {{documents}})))) WHERE w <> ''""".replace("{{", "{").replace("}}", "}")

REGIONS = [("form_0", "head", 15, 5, 400, 22, "the"), ("form_0", "body", 15, 30, 900, 60, None), ("form_1", "head", 15, 5, 400, 22, "en"),
           ("form_1", "side", 300, 100, 700, 160, None), ("form_2", "foot", 15, 500, 500, 640, "le")]
READ = "ORDER BY round_even(top, 0), x0, ord"
INSIDE = "w.x0 >= r.x0 - 3 AND w.x1 <= r.x1 + 3 AND w.top >= r.y0 - 3 AND w.bottom <= r.y1 + 3"
REGION_TEXT = f"""w AS ({WORDS}), r AS (SELECT * FROM {values('v', 'ptype, region, x0, y0, x1, y1, ex', REGIONS)}),
h AS (SELECT w.doc_id, w.page_no, r.region, r.ex, string_agg(w.text, ' ' ORDER BY round_even(w.top, 0), w.x0, w.ord) AS t FROM w JOIN r ON w.ptype = r.ptype AND {INSIDE} GROUP BY ALL),
reg AS (SELECT * FROM (SELECT doc_id, page_no, region, nullif(trim(regexp_replace(trim(replace(t, coalesce(ex, chr(1)), '')), '\\s+', ' ', 'g')), '') AS value FROM h) WHERE value IS NOT NULL)"""


def words(t: Inputs):
    return t.sql(SPARK_WORDS)


def regions(t: Inputs):
    return t.rows("ptype string, region string, x0 double, y0 double, x1 double, y1 double, ex string", REGIONS).withColumn(
        "exclude", F.when(F.col("ex").isNotNull(), F.array("ex"))).drop("ex")


@query("spa1_region_text", f"WITH {REGION_TEXT} SELECT * FROM reg")
def _(t: Inputs):
    return spatial.region_text(words(t), regions(t), ["ptype"])


LABELS = ["the", "of", "en", "le", "der"]
IN_LABELS = ", ".join(f"'{x}'" for x in LABELS)


@query("spa2_right_of_label", f"""WITH w AS ({WORDS}), m AS (SELECT * FROM w WHERE text IN ({IN_LABELS})), c AS (SELECT * FROM w WHERE text NOT IN ({IN_LABELS})),
h AS (SELECT m.doc_id, m.page_no, m.text AS label, m.ord AS o, trim(string_agg(c.text, ' ' ORDER BY c.x0, c.ord)) AS value FROM m JOIN c ON m.doc_id = c.doc_id AND m.page_no = c.page_no
  AND c.x0 > m.x1 - 2 AND c.x0 < m.x1 + 200 AND abs(c.top - m.top) < 5 GROUP BY ALL)
SELECT doc_id, page_no, label, arg_min(value, o) AS value FROM h GROUP BY ALL""")
def _(t: Inputs):
    labels = t.rows("label string", [(x,) for x in LABELS])
    return spatial.right_of_label(words(t), labels, known=LABELS)


MARKS = ["th", "an", "ou", "ei"]
X_WORDS = "SELECT doc_id, page_no, ord, CASE WHEN length(text) = 2 AND ord % 5 = 0 THEN 'X' ELSE text END AS text, x0, x1, top, bottom FROM w"
MARKED = f"""w AS ({WORDS}), x AS ({X_WORDS}), l AS (SELECT * FROM {values('v', 'label, o', [(m, i) for i, m in enumerate(MARKS)])}),
k AS (SELECT DISTINCT a.doc_id, a.page_no, l.label, l.o FROM x a JOIN l ON contains(lower(a.text), l.label) JOIN x b ON a.doc_id = b.doc_id AND a.page_no = b.page_no
  AND b.text = 'X' AND abs(b.top - a.top) < 6 AND (abs(b.x0 - a.x0) < 30 OR abs(b.x1 - a.x0) < 30))"""


def marked_words(t: Inputs):
    return words(t).withColumn("text", F.when((F.length("text") == 2) & (F.col("ord") % 5 == 0), "X").otherwise(F.col("text")))


@query("spa3_marked_labels", f"WITH {MARKED} SELECT doc_id, page_no, label FROM k")
def _(t: Inputs):
    return spatial.marked_labels(marked_words(t), MARKS)


@query("spa10_checked_options", f"WITH {MARKED} SELECT doc_id, page_no, string_agg('opt ' || label, ',' ORDER BY o) AS options FROM k GROUP BY ALL")
def _(t: Inputs):
    return spatial.checked_options(marked_words(t), [(m, f"opt {m}") for m in MARKS]).withColumn("options", F.array_join("options", ","))


BLOCKS = [(f"form_{i}", b, c, x0, 5 + 72 * b + dy, x1, 25 + 72 * b + dy) for i in range(3) for b in range(4) for c, x0, x1, dy in (("street", 10, 250, 0), ("city", 10, 180, 24), ("zip", 230, 420, 24))]


@query("spa4_repeating_blocks", f"""WITH w AS ({WORDS}), r AS (SELECT * FROM {values('v', 'ptype, block_no, region, x0, y0, x1, y1', BLOCKS)}),
c AS (SELECT w.doc_id, w.page_no, r.block_no, r.region, nullif(trim(regexp_replace(string_agg(w.text, ' ' ORDER BY round_even(w.top, 0), w.x0, w.ord), '\\s+', ' ', 'g')), '') AS value FROM w JOIN r ON w.ptype = r.ptype AND {INSIDE} GROUP BY ALL),
p AS (SELECT doc_id, page_no, block_no, max(CASE WHEN region = 'street' THEN value END) AS street, max(CASE WHEN region = 'city' THEN value END) AS city, max(CASE WHEN region = 'zip' THEN value END) AS zip FROM c GROUP BY ALL)
SELECT * FROM p WHERE street IS NOT NULL OR city IS NOT NULL""")
def _(t: Inputs):
    boxes = t.rows("ptype string, block_no int, region string, x0 double, y0 double, x1 double, y1 double", BLOCKS).withColumn("exclude", F.lit(None).cast("array<string>"))
    return spatial.blocks(words(t), boxes, ["ptype"], ["street", "city", "zip"], ["street", "city"])


LINES = f"w AS ({WORDS}), ln AS (SELECT doc_id, page_no, CAST(floor(ord / 100000) AS BIGINT) AS l, string_agg(text, ' ' ORDER BY x0) AS text FROM w GROUP BY ALL)"


@query("spa5_lines", f"WITH {LINES} SELECT doc_id, page_no, row_number() OVER (PARTITION BY doc_id, page_no ORDER BY l) AS n, text FROM ln")
def _(t: Inputs):
    return spatial.lines(words(t)).select("doc_id", "page_no", F.col("line_no").cast("bigint").alias("n"), "text")


STARRED = "CASE WHEN doc_id % 4 = 0 AND ord % 100000 = 0 AND length(text) % 2 = 0 THEN '* Code ' || text WHEN doc_id % 4 = 0 AND ord % 100000 = 1 THEN '* Description ' || text ELSE text END"


@query("spa6_prefixed_lines", f"""WITH w AS ({WORDS}), s AS (SELECT doc_id, page_no, ord, {STARRED} AS text, x0, top FROM w), e AS (SELECT * FROM s WHERE starts_with(text, '* Code') OR starts_with(text, '* Description')),
r AS (SELECT s.* FROM s ANTI JOIN e ON s.doc_id = e.doc_id AND s.page_no = e.page_no),
l AS (SELECT doc_id, page_no, CAST(floor(ord / 100000) AS BIGINT) AS l, string_agg(text, ' ' ORDER BY x0) AS text FROM r GROUP BY ALL), k AS (SELECT *, max(l) OVER (PARTITION BY doc_id, page_no) AS last FROM l)
SELECT doc_id, page_no, 'entry' AS origin, text FROM e UNION ALL SELECT doc_id, page_no, 'line', text FROM k WHERE text <> 'En' AND (l = last OR NOT (contains(text, 'PAGE') OR contains(text, 'OF')))""")
def _(t: Inputs):
    return spatial.overflow_content(words(t).withColumn("text", F.expr(STARRED)), skip=["En"])


ANSWERS = "SELECT o_orderkey AS doc_id, CAST(o_custkey % 9 + 1 AS INT) AS page_no, 'q' || (o_orderkey % 15) AS region, CASE o_custkey % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN 'Y / N' ELSE 'KEY:' || o_orderpriority || ': x' END AS value FROM {orders}"


@query("spa7_yes_no", f"SELECT * FROM ({ANSWERS}) WHERE value IN ('Y', 'N')")
def _(t: Inputs):
    return spatial.yes_no(t.sql(ANSWERS))


@query("spa8_keyed_values", f"SELECT doc_id, page_no, region, CASE WHEN contains(value, ':') THEN trim(substr(value, strpos(value, ':') + 1)) ELSE value END AS value FROM ({ANSWERS})")
def _(t: Inputs):
    return spatial.keyed_value(t.sql(ANSWERS))


PREMIUMS = "SELECT o_custkey AS doc_id, 1 AS page_no, 'line_' || o_orderkey AS region, CASE o_orderkey % 3 WHEN 0 THEN '$' WHEN 1 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS value FROM {orders}"


@query("spa9_premiums", f"SELECT doc_id, page_no, string_agg(region || '=' || value, ';' ORDER BY region) AS premiums FROM ({PREMIUMS}) WHERE value IS NOT NULL AND value <> '$' GROUP BY ALL")
def _(t: Inputs):
    return spatial.premiums(t.sql(PREMIUMS)).withColumn("premiums", F.array_join(F.transform(F.map_entries("premiums"), lambda e: F.concat_ws("=", e["key"], e["value"])), ";"))


@query("spa11_clean_grid", """SELECT o_orderkey AS doc_id, CASE WHEN o_custkey % 5 = 0 AND o_orderkey % 2 = 0 THEN NULL ELSE
  CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderstatus || '|' || o_orderpriority END || CASE WHEN o_custkey % 5 = 0 THEN '' ELSE CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE '/' END || o_custkey || '|' END END AS grid FROM {orders}""")
def _(t: Inputs):
    grid = t.sql("""SELECT o_orderkey AS doc_id, array(array(' ', NULL), CASE WHEN o_orderkey % 2 = 0 THEN array('', ' ') ELSE array(o_orderstatus || ' ', ' ' || o_orderpriority) END,
      CASE WHEN o_custkey % 5 = 0 THEN array(NULL, '') ELSE array(CAST(o_custkey AS STRING), NULL) END) AS g FROM {orders}""")
    return grid.select("doc_id", F.array_join(F.transform(spatial.clean_grid("g"), lambda r: F.array_join(r, "|")), "/").alias("grid"))


# Forms of the anchor queries: the benchmark texts; a document's page shows the form its number points to.
SPARK_TMPL = "SELECT concat('b', item_id) AS template, 0 AS tpage, CAST(p AS BIGINT) AS ord, w AS text, CAST(p * 7 + item_id AS DOUBLE) AS top FROM (SELECT item_id, posexplode(split(text, ' ')) AS (p, w) FROM {benchmark})"
TMPL = "SELECT 'b' || item_id AS template, 0 AS tpage, CAST(p AS BIGINT) AS ord, w AS text, CAST(p * 7 + item_id AS DOUBLE) AS top FROM (SELECT item_id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS p FROM (SELECT item_id, string_split(text, ' ') AS ws FROM {benchmark}))"
MAP = "SELECT DISTINCT doc_id, page_no, concat('b', doc_id % (SELECT count(*) FROM {benchmark})) AS template, 0 AS tpage FROM w"
ANCHORS = ["the", "of", "and", "in", "is", "that", "for", "with", "on", "as", "are"]
IN_ANCHORS = ", ".join(f"'{x}'" for x in ANCHORS)
PAIRS = f"""w AS ({WORDS}), m AS ({MAP}), tw AS ({TMPL}), a AS (SELECT doc_id, page_no, text AS label, arg_min(top, ord) AS page_top FROM w WHERE text IN ({IN_ANCHORS}) GROUP BY ALL),
b AS (SELECT template, tpage, text AS label, arg_min(top, ord) AS tmpl_top FROM tw WHERE text IN ({IN_ANCHORS}) GROUP BY ALL),
pr AS (SELECT a.doc_id, a.page_no, a.label, a.page_top, b.tmpl_top FROM a JOIN m ON a.doc_id = m.doc_id AND a.page_no = m.page_no JOIN b ON m.template = b.template AND m.tpage = b.tpage AND a.label = b.label)"""


def anchor_inputs(t: Inputs):
    w = words(t)
    n = t.table("benchmark").count()
    page_map = w.select("doc_id", "page_no").distinct().withColumn("template", F.concat(F.lit("b"), F.col("doc_id") % n)).withColumn("tpage", F.lit(0))
    return w, t.sql(SPARK_TMPL), page_map


@query("spa12_anchor_offset", f"""WITH {PAIRS}, d AS (SELECT doc_id, page_no, avg(page_top - tmpl_top) AS dy FROM pr GROUP BY ALL)
SELECT m.doc_id, m.page_no, m.template, m.tpage, round(coalesce(d.dy, 8.0), 6) AS dy FROM m LEFT JOIN d ON m.doc_id = d.doc_id AND m.page_no = d.page_no""")
def _(t: Inputs):
    return spatial.anchor_offset(*anchor_inputs(t), labels=ANCHORS).withColumn("dy", F.round("dy", 6))


AFFINE = "SELECT l_suppkey AS page, l_quantity AS tx, l_extendedprice AS ty, l_quantity * 1.5 + 3 + l_linenumber AS px, l_extendedprice * 0.5 + l_discount AS py FROM {lineitem}"


@query("spa13_affine_fit", f"""WITH p AS ({AFFINE}), f AS (SELECT page, count(*) AS anchors, regr_slope(px, tx) AS sx, regr_intercept(px, tx) AS dx, regr_slope(py, ty) AS sy, regr_intercept(py, ty) AS dy FROM p GROUP BY page)
SELECT p.page, any_value(anchors) AS anchors, round(any_value(sx), 4) AS sx, round(any_value(dx), 3) AS dx, round(any_value(sy), 4) AS sy, round(any_value(dy), 2) AS dy,
round(max(greatest(abs(px - (sx * tx + dx)), abs(py - (sy * ty + dy)))), 3) AS max_err FROM p JOIN f ON p.page = f.page GROUP BY p.page""")
def _(t: Inputs):
    fit = spatial.affine_fit(t.sql(AFFINE), ["page"])
    return fit.select("page", "anchors", *[F.round(c, d).alias(c) for c, d in (("sx", 4), ("dx", 3), ("sy", 4), ("dy", 2), ("max_err", 3))])


# Template boxes in form space (origin at the bottom).
FIELDS = [(f"form_{i}", 0, n, name, kind, f"tip {n}", x0, y0, x1, y1) for i in range(3) for n, (name, kind, x0, y0, x1, y1) in enumerate([
    ("Insurer_FullName_A[0]", "/Tx", 18, 755, 300, 782), ("Policy_Number_A[0]", "/Tx", 300 + 40 * i, 700, 520, 745),
    ("Remarks_A[0]", "/Tx", 18, 100, 800, 180 + i), ("Party_LimitedLiabilityCorporationIndicator_A[0]", "/Btn", 15, 700, 260, 790),
    ("Coverage_AcceptIndicator_A", "/Btn", 250, 600, 600 + i, 720), ("Dummy_A", "/Tx", 0, 1, 0, 1)])]
FIELD_COLUMNS = "template, tpage, ord, name, ftype, tooltip, x0, y0, x1, y1"
OFFSETS = "SELECT DISTINCT doc_id, page_no, ptype AS template, 0 AS tpage, CAST(doc_id % 5 AS DOUBLE) / 2 - 1 AS dy FROM w"
MERGED_BOXES = f"""w AS ({WORDS}), x AS ({X_WORDS}), m AS ({OFFSETS}), f AS (SELECT * FROM {values('v', FIELD_COLUMNS, FIELDS)} WHERE NOT (x0 = 0 AND y0 = 1 AND x1 = 0 AND y1 = 1)),
z AS (SELECT x.*, m.template, m.tpage, m.dy FROM x JOIN m ON x.doc_id = m.doc_id AND x.page_no = m.page_no),
bt AS (SELECT z.doc_id, z.page_no, CAST(f.ord AS INT) AS ord, f.name, f.tooltip, trim(string_agg(z.text, ' ' ORDER BY round_even(z.top, 0), z.x0, z.ord)) AS value FROM z JOIN f ON z.template = f.template AND f.ftype = '/Tx'
  AND z.x0 >= f.x0 - 4 AND z.x1 <= f.x1 + 4 AND z.top >= 792 - f.y1 + z.dy - 2 AND z.bottom <= 792 - f.y0 + z.dy + 5 + 2 GROUP BY ALL)"""
CENTER = "(z.x0 + z.x1) / 2 BETWEEN f.x0 AND f.x1 AND (z.top + z.bottom) / 2 BETWEEN 792 - f.y1 + z.dy AND 792 - f.y0 + z.dy"
OVERLAP = "z.x0 >= f.x0 - 5 AND z.x1 <= f.x1 + 5 AND z.top >= 792 - f.y1 + z.dy - 5 AND z.bottom <= 792 - f.y0 + z.dy + 10"
CHECKS = lambda rule: f"""bc AS (SELECT m.doc_id, m.page_no, CAST(f.ord AS INT) AS ord, f.name, f.tooltip, EXISTS (SELECT 1 FROM z WHERE z.doc_id = m.doc_id AND z.page_no = m.page_no AND z.text = 'X' AND {rule}) AS checked
  FROM m JOIN f ON m.template = f.template AND f.ftype = '/Btn')"""


def box_inputs(t: Inputs):
    w = marked_words(t)
    offsets = w.select("doc_id", "page_no", F.col("ptype").alias("template")).distinct().select(
        "*", F.lit(0).alias("tpage"), ((F.col("doc_id") % 5).cast("double") / 2 - 1).alias("dy"))
    fields = t.rows("template string, tpage int, ord int, name string, ftype string, tooltip string, x0 double, y0 double, x1 double, y1 double", FIELDS)
    return w, fields, offsets


@query("spa14_box_text", f"WITH {MERGED_BOXES} SELECT * FROM bt")
def _(t: Inputs):
    return spatial.box_text(*box_inputs(t))


@query("spa15_box_marks", f"WITH {MERGED_BOXES}, {CHECKS(CENTER)} SELECT doc_id, page_no, name, checked FROM bc")
def _(t: Inputs):
    return spatial.box_marks(*box_inputs(t)).select("doc_id", "page_no", "name", "checked")


@query("spa15_box_marks_legacy", f"WITH {MERGED_BOXES}, {CHECKS(OVERLAP)} SELECT doc_id, page_no, name, checked FROM bc")
def _(t: Inputs):
    return spatial.box_marks(*box_inputs(t), mode="overlap").select("doc_id", "page_no", "name", "checked")


RATIO = "CASE WHEN (doc_id + ord) % 4 = 0 THEN NULL ELSE CAST((doc_id * 7 + ord) % 50 AS DOUBLE) / 100 END"


@query("spa17_combined_marks", f"""WITH {MERGED_BOXES}, {CHECKS(CENTER)}, q AS (SELECT *, {RATIO} AS ratio FROM bc) SELECT doc_id, page_no, name, checked OR coalesce(ratio > 0.18, false) AS checked,
CASE WHEN checked THEN 'bbox:text_x' WHEN ratio > 0.18 THEN 'bbox:pixel:' || printf('%.2f', ratio) ELSE 'bbox' END AS source FROM q""")
def _(t: Inputs):
    marks = spatial.box_marks(*box_inputs(t))
    ratios = marks.select("doc_id", "page_no", "ord", F.expr(RATIO).alias("ratio"))
    return spatial.combined_marks(marks, ratios).select("doc_id", "page_no", "name", "checked", "source")


@query("spa18_page_fields", f"""WITH {MERGED_BOXES}, {CHECKS(CENTER)} SELECT doc_id, page_no, ord, name, NULL AS v_str, checked AS v_bool, 'checkbox' AS ftype, tooltip, CASE WHEN checked THEN 'bbox:text_x' ELSE 'bbox' END AS source FROM bc
UNION ALL SELECT doc_id, page_no, ord, name, value, NULL, 'text', tooltip, 'bbox' FROM bt""")
def page_fields(t: Inputs):
    return spatial.page_fields(*box_inputs(t))


@query("spa18_page_fields_legacy", f"""WITH {MERGED_BOXES}, {CHECKS(OVERLAP)} SELECT doc_id, page_no, name, NULL AS v_str, checked AS v_bool FROM bc WHERE checked
UNION ALL SELECT doc_id, page_no, name, value, NULL FROM bt""")
def _(t: Inputs):
    return spatial.page_fields(*box_inputs(t), mode="overlap", only_checked=True).select("doc_id", "page_no", "name", "v_str", "v_bool")


# Rasters: every embedding is a gray page eight pixels wide.
GRAY = "CAST(least(255, greatest(0, floor(128 + e * 400))) AS INT)"
BOXES = [(0, 0, 0, 8, 8), (1, 0, 1, 6, 6), (2, 3, 0, 8, 5), (3, 0, 0, 3, 9), (4, -2, -2, 7, 99), (5, 2, 2, 6, 6)]


@query("spa16_dark_ratios", f"""WITH e AS (SELECT vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) - 1 AS i, len(embedding) // 8 AS h FROM {{embeddings}}),
b AS (SELECT * FROM {values('v', 'ord, px0, py0, px1, py1', BOXES)}), c AS (SELECT DISTINCT vec_id, h, ord, greatest(0, px0) AS l, greatest(0, py0) AS u, least(8, px1) AS r, least(h, py1) AS d FROM e, b),
s AS (SELECT *, greatest(1, CAST(floor((r - l) * 0.2) AS INT)) AS ix, greatest(1, CAST(floor((d - u) * 0.2) AS INT)) AS iy FROM c)
SELECT s.vec_id AS doc_id, 1 AS page_no, CAST(s.ord AS BIGINT) AS ord, CASE WHEN r - l >= 4 AND d - u >= 4 AND r - l - 2 * ix >= 2 AND d - u - 2 * iy >= 2 THEN round(avg(CASE WHEN {GRAY} < 140 THEN 1.0 ELSE 0.0 END)
  FILTER (i % 8 >= l + ix AND i % 8 < r - ix AND i // 8 >= u + iy AND i // 8 < d - iy), 6) END AS ratio FROM s JOIN e ON s.vec_id = e.vec_id GROUP BY s.vec_id, s.ord, l, u, r, d, ix, iy""")
def _(t: Inputs):
    rasters = t.sql(f"SELECT vec_id AS doc_id, 1 AS page_no, unhex(array_join(transform(embedding, e -> lpad(hex({GRAY}), 2, '0')), '')) AS gray, 8 AS w FROM {{embeddings}}")
    boxes = rasters.select("doc_id", "page_no", F.inline(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("ord", "px0", "py0", "px1", "py1"), b)]) for b in BOXES])))
    return raster.dark_ratios(rasters, boxes).withColumn("ratio", F.round("ratio", 6))
