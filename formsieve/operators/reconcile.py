"""Reconciling template boxes with model output, and model output with page text.

fields(doc_id, page_no, ord, name, v_str, v_bool, ftype, tooltip, source); candidates are model values one or two levels
deep. Whether a value is already there is settled page by page: values and box texts of a page meet in one place, whole values
by their normalized form, short values as word-bounded pieces of the texts. Rows of a page are not paired.
"""
from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col, let, norm_dedup, norm_raw, strip
from ..rules import fields as rules
from ..session import materialize
from . import leaves, packs, scrub

PAGE = packs.PAGE
# Short values of a page up to which each text is tried for every one of them.
ASKED_AT_ONCE = 64


def split_primary(fields: DataFrame, is_label: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept fields, discrepancies): labels captured as values are diverted. `source_detail` keeps the pixel tag."""
    flag = F.coalesce(scrub.is_label("v_str") if is_label is None else is_label, F.lit(False))
    marked = fields.withColumn("_label", flag)
    kept = marked.where(~F.col("_label")).withColumn("source_detail", F.col("source")).withColumn("source", F.lit("bbox")).drop("_label")
    bad = marked.where("_label").select(*PAGE, F.col("name").alias("field"), F.col("v_str").alias("value"),
                                        F.lit("label_as_value").alias("issue"))
    return kept, bad


def candidates(responses: DataFrame, json: str = "content") -> DataFrame:
    """(doc_id, page_no, ord, name, tooltip, value, vtype, branch) from one JSON object per page.

    Scalars, members of objects, and members of objects in arrays; scalars in arrays are not candidates. Deeper values
    stay JSON text (vtype o/a).
    """
    return leaves.members(responses, PAGE, json)


def scrub_candidates(cands: DataFrame) -> DataFrame:
    """Drop empty and garbage values; deeper values lose their garbage and go when nothing is left."""
    nested = F.col("vtype").isin("o", "a")
    zero = (F.col("branch") == "array") & (F.col("vtype") == "string") & F.col("value").isin(rules.ZERO_TEXTS)
    null_text = (F.col("branch") == "scalar") & (F.col("vtype") == "string") & F.col("value").isin(rules.NULL_TEXTS)
    kept = materialize(cands.where(nested | (scrub.survives_scrub("value", "vtype") & ~zero & ~null_text)))
    flat, deep = kept.where(~nested), kept.where(nested)
    keys = [*PAGE, "ord"]
    rebuilt = scrub.scrub_json(deep.dropna(subset=keys), keys, "value", [c for c in deep.columns if c not in (*keys, "value")])
    return flat.unionByName(rebuilt.withColumnRenamed("content", "value"))


def _pieces(low: Column) -> Column:
    return F.array_distinct(F.flatten(F.array(*[
        F.regexp_extract_all(low, F.lit(rf"(?sU)(?=(\b.{{{n}}}\b))"), F.lit(1)) for n in range(1, rules.SHORT_VALUE)])))


def short_pieces(text: Column | str) -> Column:
    """Word-bounded pieces of up to three characters of the lowercased text, overlapping ones included."""
    return _pieces(F.lower(col(text)))


def asked_pieces(text: Column | str, asked: Column | str) -> Column:
    """Those short pieces of the text that are asked for; all of them where `asked` is null. A text that does not even
    contain one is not cut into pieces."""
    asked = col(asked)

    def found(low: Column) -> Column:
        hits = F.filter(asked, lambda s: F.contains(low, s))
        return F.when(asked.isNull(), _pieces(low)).otherwise(let(hits, lambda h: F.when(F.size(h) > 0, F.array_intersect(h, _pieces(low)))))

    return let(F.lower(col(text)), found)


@cache
def _in_word(c: str) -> bool:
    """Whether the character is one of a word, as Java's classes have it by Unicode."""
    return unicodedata.category(c) in ("Lu", "Ll", "Lt", "Lm", "Lo", "Nl", "Nd", "Mn", "Mc", "Me", "Pc") or c in "\u200c\u200d" or any(
        a <= c <= b for a, b in (("\u24b6", "\u24e9"), ("\U0001f130", "\U0001f149"), ("\U0001f150", "\U0001f169"), ("\U0001f170", "\U0001f189")))


def _bounded(low: str, at: int) -> bool:
    """Whether a word starts or ends before the character at this place."""
    return (at > 0 and _in_word(low[at - 1])) != (at < len(low) and _in_word(low[at]))


def _holds(low: str, piece: str) -> bool:
    """Whether the text contains the piece as a word. Equal to: the piece is one of its short pieces."""
    at = low.find(piece)
    while at >= 0:
        if _bounded(low, at) and _bounded(low, at + len(piece)):
            return True
        at = low.find(piece, at + 1)
    return False


def _cut(low: str) -> set[str]:
    """The short pieces of a lowercased text."""
    bounds = [at for at in range(len(low) + 1) if _bounded(low, at)]
    return {low[a:b] for i, a in enumerate(bounds) for b in bounds[i + 1:i + rules.SHORT_VALUE] if b - a < rules.SHORT_VALUE}


def _first_shown(asked: set[str], texts: list[tuple[int, str]]) -> dict[str, int]:
    """Position of the first of the texts, which are in order, that shows each piece. Texts are searched for what is asked for;
    where that is much, they are cut into their pieces."""
    found: dict[str, int] = {}
    for at, low in texts:
        if len(asked) > ASKED_AT_ONCE:
            shown = _cut(low) & asked
        else:
            shown = [s for s in asked if s not in found and s in low and _holds(low, s)]
        for s in shown:
            found.setdefault(s, at)
    return found


def _unfilled(ords: list[int], norms: list[str | None], lows: list[str | None], values: list[str | None], boxes: list[dict]) -> list[bool]:
    """Of each value of a page, in order, whether neither a box nor an earlier kept text shows it."""
    equal = {b["norm"] for b in boxes if b["norm"]}
    keep = [norm not in equal for norm in norms]
    short = [i for i, norm in enumerate(norms) if norm and len(norm) < rules.SHORT_VALUE and keep[i]]
    if not short:
        return keep
    taken = set(short)
    texts = [(-1, b["low"]) for b in boxes] + [(ords[i], low) for i, low in enumerate(lows) if low is not None and keep[i] and i not in taken]
    first = _first_shown({norms[i] for i in short}, sorted(texts, key=lambda t: t[0]))
    for i in short:
        keep[i] = first.get(norms[i], ords[i]) >= ords[i]
    # What is left are short values that only another short value could hide. Whether that one was kept is settled in
    # document order over the distinct short texts of the page.
    least: dict[str, tuple] = {}
    for i in short:
        if keep[i] and lows[i] is not None and ords[i] < least.get(values[i], (ords[i] + 1,))[0]:
            least[values[i]] = (ords[i], values[i], norms[i], lows[i])
    shown: dict[str, int] = {}
    for at, _, norm, low in sorted(least.values()):
        if norm not in shown:
            for piece in _cut(low):
                shown.setdefault(piece, at)
    for i in short:
        keep[i] = keep[i] and shown.get(norms[i], ords[i]) >= ords[i]
    return keep


_HELPERS = ["_norm", "_low", "_boxes"]


def _homeless(rows: pa.RecordBatch) -> bool:
    """Whether the first row has no whole key, so that it belongs to no page."""
    return not all(rows.column(k)[0].is_valid for k in PAGE)


def _whole_pages(batches: Iterator[pa.RecordBatch], judge: Callable[[pa.RecordBatch], pa.RecordBatch], lasting: bool = False) -> Iterator[pa.RecordBatch]:
    """`judge` of the rows of whole pages; rows come sorted by page, and a page may go on in the next batch. Rows without a page
    are not gathered: each batch of them is judged as it comes, and once more with the next one if the judgement is `lasting`."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        before = [held[-1].slice(len(held[-1]) - 1)] if held else []
        cuts = np.flatnonzero(packs.changes(pa.concat_batches([*before, batch]), PAGE)) + (0 if before else 1)
        if len(cuts):
            done = [x for x in (*held, batch.slice(0, int(cuts[-1]))) if len(x)]
            held = [batch.slice(int(cuts[-1]))]
            yield judge(pa.concat_batches(done))
        else:
            held.append(batch)
            if _homeless(held[0]) and lasting:
                held = [judge(pa.concat_batches(held))]
    if held:
        yield judge(pa.concat_batches(held))


def _fill_batches(one_per_name: bool) -> Callable:
    def judge(rows: pa.RecordBatch) -> pa.RecordBatch:
        starts = [0, *(np.flatnonzero(packs.changes(rows, PAGE)) + 1).tolist()]
        homeless = pc.or_(*(rows.column(k).is_null() for k in PAGE)).to_numpy(zero_copy_only=False)
        ords, norms, lows, values, names = (rows.column(c).to_pylist() for c in ("ord", "_norm", "_low", "value", "name"))
        boxes = rows.column("_boxes").take(pa.array(starts)).to_pylist()
        keep: list[bool] = []
        for a, b, page in zip(starts, [*starts[1:], len(rows)], boxes):
            kept = [True] * (b - a) if homeless[a] else _unfilled(ords[a:b], norms[a:b], lows[a:b], values[a:b], page or [])
            if one_per_name:
                last = {name: i for i, (name, k) in enumerate(zip(names[a:b], kept)) if k}
                kept = [k and last[name] == i for i, (name, k) in enumerate(zip(names[a:b], kept))]
            keep += kept
        return rows.filter(pa.array(keep, pa.bool_()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (rows.drop_columns(_HELPERS) for rows in _whole_pages(batches, judge, lasting=True))
    return run


def gap_fills(primary: DataFrame, cands: DataFrame, one_per_name: bool = False) -> DataFrame:
    """Candidates that no kept text of the page already shows, in document order semantics.

    Values of four or more normalized characters are dropped when a box text equals them. Shorter ones are dropped when
    a box text, or a model text kept before them, contains them as a word. `one_per_name`: of what is left of a page, the last
    value of each name.

    Box texts are gathered by page, and only they are shuffled where the candidates already lie by page. The window is there
    for the page in one place and in order, which Spark sees to by itself, and marks the row that brings the page's boxes.
    """
    boxes = packs.keyed(primary.where("v_str IS NOT NULL"), PAGE, ["v_str"]).groupBy(*PAGE).agg(F.collect_set("v_str").alias("_boxes"))
    rows = cands.withColumn("_norm", F.when(~F.col("vtype").isin("o", "a"), norm_dedup("value"))).withColumn(
        "_low", F.when(F.col("vtype") == "string", F.lower("value")))
    placed = rows.join(boxes, PAGE, "left").withColumn("_at", F.row_number().over(Window.partitionBy(*PAGE).orderBy("ord")))
    box = F.transform("_boxes", lambda t: F.struct(norm_dedup(t).alias("norm"), F.lower(t).alias("low")))
    ready = placed.select(*rows.columns, F.when(F.col("_at") == 1, box).alias("_boxes"))
    found = ready.mapInArrow(_fill_batches(one_per_name), ", ".join(f"`{c}` {t}" for c, t in cands.dtypes))
    return found.select(*[F.col(c).cast(t) for c, t in cands.dtypes])


# Stands between the texts of a page. No UTF-8 text holds it, so a value is found inside one text only.
BETWEEN = "\ud800"


def _shown(ords: list[int], lows: list[str], texts: list[bool]) -> list[bool]:
    """Of each value of a page whether a text at an earlier position contains it. One search per value, no pairs."""
    page = BETWEEN.join([low for low, is_text in zip(lows, texts) if is_text])
    out, end, here, last, find = [], 0, 0, None, page.find
    for at, low, is_text in zip(ords, lows, texts):
        if at != last:
            end, here, last = end + here, 0, at
        out.append(find(low, 0, end) >= 0)
        if is_text:
            here += len(low) + 1
    return out


def _unshown(rows: pa.RecordBatch) -> pa.RecordBatch:
    """The values of whole pages that no earlier text of their page contains. Rows without a key belong to no page."""
    starts = [0, *(np.flatnonzero(packs.changes(rows, PAGE)) + 1).tolist()]
    homeless = pc.or_(*(rows.column(k).is_null() for k in PAGE)).to_numpy(zero_copy_only=False)
    ords, lows, texts = (rows.column(c).to_numpy(zero_copy_only=False).tolist() for c in ("ord", "_low", "_text"))
    keep: list[bool] = []
    for a, b in zip(starts, [*starts[1:], len(rows)]):
        keep += [False] * (b - a) if homeless[a] else _shown(ords[a:b], lows[a:b], texts[a:b])
    return rows.filter(pc.and_(rows.column("_value"), pa.array(~np.array(keep, bool)))).drop_columns(["_low", "_text", "_value"])


def _unshown_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by page and position in; a page may go on in the next batch."""
    return _whole_pages(batches, _unshown)


def gap_fills_legacy(primary: DataFrame, cands: DataFrame, parts: int | None = None) -> DataFrame:
    """Earlier rule: a value goes when it occurs anywhere inside a box text or an earlier model text of the page.

    Substring containment is transitive, so dropped texts hide the same values as kept ones. Boxes and values are dealt to
    their pages once, into `parts` parts if given, and lie there in order.
    """
    falsy = ((F.col("vtype") == "boolean") & (F.col("value") == "false")) | ((F.col("vtype") == "number") & (F.col("value").try_cast("double") == 0))
    empty = F.col("vtype").isin("null", "object", "array") | (F.coalesce("value", F.lit("")) == "") | falsy
    zero = (F.col("branch") == "array") & F.col("value").isin(rules.ZERO_TEXTS)
    null_text = (F.col("branch") == "scalar") & F.col("value").isin(rules.NULL_TEXTS)
    kept = cands.where(~empty & ~zero & ~null_text)
    values = kept.select("*", F.lower("value").alias("_low"), (F.col("vtype") == "string").alias("_text"), F.lit(True).alias("_value"))
    boxes = primary.where("v_str IS NOT NULL").select(
        *PAGE, F.lit(-1).cast("bigint").alias("ord"), F.lower("v_str").alias("_low"), F.lit(True).alias("_text"), F.lit(False).alias("_value"))
    rows = values.unionByName(boxes, allowMissingColumns=True)
    dealt = rows.repartition(*([parts] if parts else []), *PAGE).sortWithinPartitions(*PAGE, "ord")
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c in cands.columns)
    return dealt.mapInArrow(_unshown_batches, schema).select(*[F.col(c).cast(t) for c, t in cands.dtypes])


def unconfirmed_amounts(kept: DataFrame, responses: DataFrame, json: str = "content", unparsed: DataFrame | None = None) -> DataFrame:
    """Discrepancies: box amounts that occur nowhere in the page's model output. unparsed: (doc_id, page_no, raw), the
    answers that are no JSON, searched as they are."""
    amounts = kept.where(F.col("v_str").isNotNull() & scrub.is_amount("v_str", F.lit("string"))).select(
        *PAGE, F.col("name").alias("field"), F.col("v_str").alias("value"), F.translate("v_str", ",$", "").alias("_a")).where("_a <> ''")
    said = leaves.digest(responses, PAGE, json)
    if unparsed is not None:
        said = said.unionByName(unparsed.select(*PAGE, F.col("raw").alias("digest")))
    pages = said.select(*PAGE, F.replace(F.lower("digest"), F.lit(","), F.lit("")).alias("_d"))
    return amounts.join(pages, PAGE, "left").where(~F.contains(F.coalesce("_d", F.lit("")), F.col("_a"))).select(
        *PAGE, "field", "value", F.lit("amount_not_in_vlm").alias("issue"))


def merge(fields: DataFrame, responses: DataFrame, page_map: DataFrame | None = None, labels: DataFrame | None = None,
          legacy: bool = False, unparsed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(merged fields, discrepancies) of template boxes and model output. responses: one OK JSON object per page; unparsed:
    the raw text of pages without one, which gives no fields but confirms amounts."""
    kept, bad = split_primary(fields)
    cands = candidates(responses)
    # Two paths may give one name; the later value stands, as in a dictionary.
    if legacy:
        fills = gap_fills_legacy(kept, cands)
        last = fills.groupBy(*PAGE, "name").agg(F.max_by(F.struct(*[c for c in fills.columns if c not in (*PAGE, "name")]), "ord").alias("r"))
        fills = last.select(*PAGE, "name", "r.*")
    else:
        clean = scrub_candidates(cands)
        if labels is not None:
            clean = scrub.drop_option_labels(clean, page_map, labels)
        fills = gap_fills(kept, clean, one_per_name=True)
    as_fields = fills.select(
        *PAGE, "ord", "name", F.when(F.col("vtype") != "boolean", F.col("value")).alias("v_str"),
        F.when(F.col("vtype") == "boolean", F.col("value").cast("boolean")).alias("v_bool"), F.lit("text").alias("ftype"),
        "tooltip", F.lit("vlm").alias("source"), F.lit("vlm").alias("source_detail"))
    return kept.unionByName(as_fields), bad.unionByName(unconfirmed_amounts(kept, responses, unparsed=unparsed))


def merge_counts(merged: DataFrame) -> DataFrame:
    """Per document: pages with box fields, box fields, gap fills, true checkboxes."""
    box = F.col("source") == "bbox"
    per_page = merged.groupBy(*PAGE).agg(F.count_if(box).alias("box_fields"), F.count_if(~box).alias("gap_fills"),
                                         F.count_if(box & F.col("v_bool")).alias("checked"))
    return per_page.groupBy("doc_id").agg(F.count_if(F.col("box_fields") > 0).alias("pages_with_data"),
                                          *[F.sum(c).alias(c) for c in ("box_fields", "gap_fills", "checked")])


def text_check(leaf_rows: DataFrame, page_text: DataFrame) -> DataFrame:
    """leaves plus `status`: confirmed, not_in_raw_text or skipped, against the text of their page.

    Page text is normalized once per page, before the join.
    """
    def prepared(t: Column) -> Column:
        return let(norm_raw(t), lambda n: F.struct(n.alias("norm"), F.replace(n, F.lit(" "), F.lit("")).alias("tight")))

    pages = page_text.where("text IS NOT NULL AND text <> ''").select(*PAGE, prepared(F.col("text")).alias("_p"))
    text = F.when(F.col("vtype") == "boolean", F.initcap("value")).otherwise(strip("value"))
    rows = leaf_rows.select("*", text.alias("_s"), norm_raw(text).alias("_c"))
    specific = ((F.length("_s") >= rules.CHECKED_LENGTH) & (F.col("_c") != "") &
                ((F.col("_c").rlike(r"\d") & (F.length("_c") >= rules.CHECKED_LENGTH)) | F.col("_s").rlike(rules.CLAIM_NUMBER)))
    joined = rows.join(pages, PAGE, "left")
    norm, tight = F.col("_p.norm"), F.col("_p.tight")
    tokens = F.filter(F.split("_c", " "), lambda t: F.length(t) >= rules.TOKEN_LENGTH)
    found = (F.when(F.contains(norm, F.col("_c")), True).when(F.contains(tight, F.replace("_c", F.lit(" "), F.lit(""))), True)
             .otherwise((F.size(tokens) > 0) & F.forall(tokens, lambda t: F.contains(norm, t))))
    status = (F.when(F.col("_p").isNull() | ~F.coalesce(specific, F.lit(False)), "skipped").when(found, "confirmed")
              .otherwise("not_in_raw_text"))
    return joined.select(*leaf_rows.columns, status.alias("status"))


def confirmation_report(checked: DataFrame) -> DataFrame:
    """Counts per page, per document (page_no NULL) and overall (both NULL)."""
    return checked.rollup(*PAGE).agg(F.count(F.lit(1)).alias("n_values"), F.count_if(F.col("status") == "confirmed").alias("confirmed"),
                                     F.count_if(F.col("status") == "not_in_raw_text").alias("unconfirmed"))


def compare_runs(run_a: DataFrame, run_b: DataFrame) -> DataFrame:
    """(doc_id, page_no, path, value_a, value_b, agreement) of two extraction runs."""
    a = run_a.select(*PAGE, "path", F.col("value").alias("value_a"), F.lit(True).alias("_a"))
    b = run_b.select(*PAGE, "path", F.col("value").alias("value_b"), F.lit(True).alias("_b"))
    verdict = (F.when(F.col("_b").isNull(), "only_a").when(F.col("_a").isNull(), "only_b")
               .when(F.col("value_a").eqNullSafe(F.col("value_b")), "same").otherwise("different"))
    return a.join(b, [*PAGE, "path"], "full_outer").select(*PAGE, "path", "value_a", "value_b", verdict.alias("agreement"))


def inspector(tmpl_fields: DataFrame, page_map: DataFrame, merged: DataFrame) -> DataFrame:
    """Every template field of every mapped page with its extracted value, a short preview of it, and its state."""
    listed = page_map.join(tmpl_fields, ["template", "tpage"]).select(*PAGE, "name", F.col("ftype").alias("kind"))
    got = merged.select(*PAGE, "name", "v_str", "v_bool", F.lit(True).alias("_got"))
    rows = listed.join(got, [*PAGE, "name"], "left")
    text = F.coalesce("v_str", F.lit(""))
    cut = F.when(F.length(text) > 50, F.concat(F.left(text, F.lit(50)), F.lit("…"))).otherwise(text)
    state = (F.when(F.col("_got").isNull(), "absent").when(F.col("v_bool"), "checked").when(~F.col("v_bool"), "unchecked").otherwise("text"))
    preview = (F.when(F.col("_got").isNull(), "(no extracted value)").when(F.col("v_bool"), "true").when(~F.col("v_bool"), "false").otherwise(cut))
    populated = F.coalesce(F.col("_got") & (F.col("v_bool") | F.col("v_str").isNotNull()), F.lit(False))
    return rows.select(*PAGE, "name", "kind", state.alias("state"), preview.alias("preview"), F.col("v_str").alias("value"), populated.alias("populated"))


def listing_order(rows: DataFrame) -> DataFrame:
    """Populated fields first, then by name, per page."""
    return rows.orderBy(*PAGE, F.desc("populated"), "name")


def page_bundle(responses: DataFrame, page_text: DataFrame, claims: DataFrame, discrepancies: DataFrame) -> DataFrame:
    """Loss-run page bundles: model data, text and the numbers of parsed claims and discrepancies, one row per page."""
    n_claims = claims.groupBy(*PAGE).agg(F.count(F.lit(1)).alias("n_claims"))
    n_bad = discrepancies.groupBy(*PAGE).agg(F.count(F.lit(1)).alias("n_discrepancies"))
    return page_text.join(responses, PAGE, "left").join(n_claims, PAGE, "left").join(n_bad, PAGE, "left").na.fill(
        0, ["n_claims", "n_discrepancies"])
