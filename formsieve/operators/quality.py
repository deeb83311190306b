"""Coverage, inventories, run summaries and declarative checks."""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..rules import coverage as rules
from . import leaves

PAGE = ["doc_id", "page_no"]


def _filled(value) -> bool:
    """Present and not empty; false and 0 are values."""
    return value is not None and (bool(value) or not isinstance(value, (str, dict, list)))


def _address(steps: tuple) -> tuple[str, str, str] | None:
    """(section, item, field) of a node; None for nodes that are not a field of a section or of one of its items."""
    def fields(start: int) -> bool:
        return len(steps) > start and all(isinstance(s, str) for s in steps[start:])

    if len(steps) < 2 or not isinstance(steps[0], str):
        return None
    if fields(1):
        return steps[0], "", ".".join(steps[1:])
    if not isinstance(steps[1], int):
        return None
    if fields(2):
        return steps[0] + "[]", str(steps[1]), ".".join(steps[2:])
    if fields(4) and isinstance(steps[2], str) and isinstance(steps[3], int) and rules.NESTED_IN.get(steps[2] + "[]") == steps[0]:
        return steps[2] + "[]", f"{steps[1]}.{steps[3]}", ".".join(steps[4:])
    return None


def _presence_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key columns and JSON text in, key columns and fields out. Neither paths nor texts of nodes are made."""
    for batch in batches:
        source, out = [], []

        def flush() -> pa.RecordBatch:
            take = pa.array(source, pa.int64())
            sections, items, names, filled = zip(*out)
            return pa.RecordBatch.from_arrays(
                [k.take(take) for k in batch.columns[:-1]] + [pa.array(sections, pa.string()), pa.array(items, pa.string()),
                                                              pa.array(names, pa.string()), pa.array(filled, pa.bool_())],
                names=batch.schema.names[:-1] + ["section", "item", "field", "populated"])

        for row, text in enumerate(batch.columns[-1].to_pylist()):
            ok, value = leaves.parse(text)
            for steps, v in leaves.nodes(value, containers=True) if ok else ():
                at = _address(steps)
                if at:
                    source.append(row)
                    out.append((*at, _filled(v)))
                    if len(out) >= leaves.ROWS_PER_BATCH:
                        yield flush()
                        source, out = [], []
        if out:
            yield flush()


def field_presence(records: DataFrame, keys: list[str], json: str = "content") -> DataFrame:
    """(keys, section, item, field, populated) of nested submission records, worked out in the walk of a record."""
    schema = leaves.key_schema(records, keys) + "section string, item string, field string, populated boolean"
    return records.select(*keys, json).mapInArrow(_presence_batches, schema)


def coverage(presence: DataFrame, documents: DataFrame, keys: list[str], schema_fields: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """(keys, section, field, tier, n_items, populated, mark): every schema field of every document.

    A leaf looks its field up in the schema and says at most two things: that the field is populated, and that its list has
    this item. These facts are counted by (document, number), in the task that walked the record first, and only then is
    every field laid out per document. mark: all, some, none.
    """
    schema = schema_fields or rules.SCHEMA_FIELDS
    lists = sorted({s for s, _, _ in schema if s.endswith("[]")})
    numbers = presence.sparkSession.createDataFrame([(s, f, i) for i, (s, f, _) in enumerate(schema)], "section string, field string, number int")
    known = presence.join(F.broadcast(numbers), ["section", "field"], "left")  # as many rows as the schema has fields
    listed = F.when(F.col("item") != "", F.array_position(F.array(*map(F.lit, lists)), F.col("section")))
    facts = F.array(F.when(F.col("populated"), F.struct("number", F.lit("").alias("item"))),
                    F.when(listed > 0, F.struct((-listed).cast("int").alias("number"), "item")))
    said = known.select(*keys, F.explode(facts).alias("fact")).select(*keys, "fact.number", "fact.item").where("number IS NOT NULL")
    once = said.groupBy(*keys, "number", "item").agg(F.count(F.lit(1)).alias("n"))
    counts = once.groupBy(*keys, "number").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("items"))
    found = counts.groupBy(*keys).agg(F.map_from_entries(F.collect_list(
        F.struct("number", F.when(F.col("number") < 0, F.col("items")).otherwise(F.col("n")).alias("n")))).alias("_m"))
    # One constant list of fields, looked up row by row: an expression per field would be too large to be compiled.
    fields = F.array(*[F.struct(F.lit(s).alias("section"), F.lit(f).alias("field"), F.lit(t).alias("tier"), F.lit(i).alias("_f"),
                                F.lit(-1 - lists.index(s) if s in lists else None).cast("int").alias("_l")) for i, (s, f, t) in enumerate(schema)])
    of = lambda number: F.coalesce(F.try_element_at("_m", F.col(number)), F.lit(0)).cast("bigint")
    laid = documents.select(*keys).join(found, keys, "left").select(*keys, "_m", F.inline(fields))
    rows = laid.select(*keys, "section", "field", "tier", F.when(F.col("_l").isNull(), F.lit(1).cast("bigint")).otherwise(of("_l")).alias("n_items"),
                       of("_f").alias("populated"))
    mark = F.when((F.col("n_items") > 0) & (F.col("populated") == F.col("n_items")), "all").when(F.col("populated") > 0, "some").otherwise("none")
    return rows.withColumn("mark", mark)


def section_coverage(cov: DataFrame, keys: list[str]) -> DataFrame:
    """Populated and total per section; a section without items counts its fields once."""
    return cov.groupBy(*keys, "section").agg(F.sum("populated").alias("populated"),
                                             F.sum(F.greatest("n_items", F.lit(1))).alias("total"))


def tier_coverage(cov: DataFrame, keys: list[str]) -> DataFrame:
    """Populated and total per tier, and for the reachable tiers together; sections without items count nothing."""
    tiers = cov.groupBy(*keys, "tier").agg(F.sum("populated").alias("populated"), F.sum("n_items").alias("total"))
    reach = tiers.where(F.col("tier").isin(rules.REACHABLE)).groupBy(*keys).agg(
        F.lit("reachable").alias("tier"), F.sum("populated").alias("populated"), F.sum("total").alias("total"))
    return tiers.unionByName(reach)


def template_inventory(tmpl_fields: DataFrame) -> DataFrame:
    """Field counts per template page, template (tpage NULL) and overall (both NULL)."""
    return tmpl_fields.rollup("template", "tpage").agg(
        F.count(F.lit(1)).alias("n_fields"), F.count_if(F.col("ftype") == "/Btn").alias("n_checkboxes"),
        F.count_if(F.col("ftype") != "/Btn").alias("n_text_fields"))


def top_sections(tmpl_fields: DataFrame, n: int = 10) -> DataFrame:
    """Largest sections: the first part of the field name."""
    return tmpl_fields.groupBy(F.substring_index("name", "_", 1).alias("section")).agg(F.count(F.lit(1)).alias("n_fields")).orderBy(
        F.desc("n_fields"), "section").limit(n)


def densest_pages(tmpl_fields: DataFrame, n: int = 20) -> DataFrame:
    return tmpl_fields.groupBy("template", "tpage").agg(F.count(F.lit(1)).alias("n_fields")).orderBy(
        F.desc("n_fields"), "template", "tpage").limit(n)


def class_shares(rows: DataFrame, label: str) -> DataFrame:
    """Counts and shares per class. The window runs over the counted classes, not over the rows."""
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(label, "n", (F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0)))).alias("share"))


def run_summary(pages: DataFrame) -> DataFrame:
    """OK pages, pages and rate per file and mode, per mode (doc_id NULL) and overall (both NULL)."""
    ok = F.count_if(F.col("status") == "OK")
    totals = pages.groupingSets([["doc_id", "mode"], ["mode"], []], "doc_id", "mode").agg(
        ok.alias("ok_pages"), F.count(F.lit(1)).alias("pages"))
    return totals.withColumn("ok_rate", F.col("ok_pages") / F.col("pages"))


def mapping_usage(fields: DataFrame, mapped_names: DataFrame) -> DataFrame:
    """Distinct extracted fields, mapped and unmapped, per category and overall (category NULL)."""
    category = (F.when(F.startswith("name", F.lit("vlm_")), "model").when(F.col("v_bool"), "checkbox true")
                .when(~F.col("v_bool"), "checkbox false").otherwise("text"))
    names = fields.select("name", category.alias("category")).groupBy("name").agg(F.max("category").alias("category"))
    joined = names.join(mapped_names.select("name").distinct().withColumn("_m", F.lit(True)), "name", "left")
    return joined.rollup("category").agg(F.count(F.lit(1)).alias("extracted"), F.count_if(F.col("_m")).alias("mapped"),
                                         F.count_if(F.col("_m").isNull()).alias("unmapped"))


def text_layer_summary(page_text: DataFrame, tables: DataFrame, claims: DataFrame) -> DataFrame:
    """Per document: pages, unreadable pages, tables and parsed claim rows. page_text has `garbled`."""
    pages = page_text.groupBy("doc_id").agg(F.count(F.lit(1)).alias("pages"), F.count_if("garbled").alias("garbled_pages"))
    n_tables = tables.select("doc_id", "page_no", "table_no").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("tables"))
    n_claims = claims.groupBy("doc_id").agg(F.count(F.lit(1)).alias("claim_rows"))
    return pages.join(n_tables, "doc_id", "left").join(n_claims, "doc_id", "left").na.fill(0, ["tables", "claim_rows"])


def page_profile(merged: DataFrame) -> DataFrame:
    """Per page: gap fills, true checkboxes, box texts, all fields."""
    fill = F.startswith("name", F.lit("vlm_"))
    return merged.groupBy(*PAGE).agg(
        F.count_if(fill).alias("gap_fills"), F.count_if((F.col("ftype") == "checkbox") & F.col("v_bool")).alias("checked"),
        F.count_if((F.col("ftype") == "text") & ~fill).alias("box_texts"), F.count(F.lit(1)).alias("fields"))


def _named(parts: list[str]) -> Column:
    low = F.lower("name")
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(low, F.lit(p.lower()))
    return out


def assertions(merged: DataFrame, rules_: list[dict]) -> DataFrame:
    """(doc_id, rule, passed, found) of declarative checks, all in one pass over the fields.

    Rule kinds, each on page `page` (NULL page = any): 'true_count' (true checkboxes whose name holds one of `keys` must
    number `n`, and with `only` each must hold that text), 'forbidden' (no model field named by `keys` has one of
    `values`; with `part` also inside longer values), 'exclusive' (field `off` is false and field `on` true),
    'no_gap_fills' (no model field at all).
    """
    fill = F.startswith("name", F.lit("vlm_"))
    checks = []
    for r in rules_:
        here = F.lit(True) if r.get("page") is None else F.col("page_no") == r["page"]
        if r["kind"] == "true_count":
            hit = here & (F.col("ftype") == "checkbox") & F.col("v_bool") & _named(r["keys"])
            found = F.count_if(hit)
            passed = found == r["n"]
            if r.get("only"):
                passed = passed & (F.count_if(hit & F.contains(F.lower("name"), F.lit(r["only"].lower()))) == r["n"])
        elif r["kind"] == "forbidden":
            low = F.lower(F.coalesce("v_str", F.lit("")))
            bad = F.exists(F.array(*map(F.lit, r["values"])), lambda v: F.contains(low, v)) if r.get("part") else low.isin(r["values"])
            found = F.count_if(here & fill & _named(r["keys"]) & bad)
            passed = found == 0
        elif r["kind"] == "exclusive":
            off, on = F.col("name") == r["off"], F.col("name") == r["on"]
            found = F.count_if(here & ((off & ~F.col("v_bool")) | (on & F.col("v_bool"))))
            passed = found == 2
        else:
            found = F.count_if(here & fill)
            passed = found == 0
        checks.append(F.struct(F.lit(r["rule"]).alias("rule"), passed.alias("passed"), found.alias("found")))
    return merged.groupBy("doc_id").agg(F.array(*checks).alias("c")).select("doc_id", F.inline("c"))

