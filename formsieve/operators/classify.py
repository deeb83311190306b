"""Page, document and file classification.

Everything per page is one projection: patterns and phrases are literals in the expression, so page text is never
shuffled or multiplied by the number of phrases.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, col, let, strip
from ..rules import classify as rules
from .ordered import running


def first_match(c: Column, patterns: list[tuple[str, str]], default: str | None = None) -> Column:
    """Label of the first pattern that matches."""
    out = F.lit(default)
    for pattern, label in reversed(patterns):
        out = F.when(c.rlike(pattern), F.lit(label)).otherwise(out)
    return out


def _total(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def footer_template(tail: Column | str, patterns=None) -> Column:
    """Template named by the end of the page."""
    return first_match(col(tail), patterns or rules.FOOTERS)


def page_end(text: Column | str) -> Column:
    return F.right(col(text), F.lit(rules.FOOTER_TAIL))


def with_scores(pages: DataFrame, fingerprints=None) -> DataFrame:
    """Add one integer score column `score_<template>` per form; phrases count wherever they occur in the uppercased text.

    The text is uppercased in a projection of its own, so once per page, and the scores stay in generated code.
    """
    fingerprints = fingerprints or rules.FINGERPRINTS
    up = F.col("_up")

    def score(strong: list[str], weak: list[str]) -> Column:
        return _total([F.contains(up, F.lit(p)).cast("int") * rules.STRONG for p in strong] +
                      [F.contains(up, F.lit(p)).cast("int") * rules.WEAK for p in weak])

    return pages.withColumn("_up", F.upper("text")).select(
        *pages.columns, *[score(*phrases).alias(f"score_{name}") for name, phrases in fingerprints.items()])


def fingerprint_scores(pages: DataFrame, fingerprints=None) -> DataFrame:
    """(doc_id, page_no, template, score): one row per page and form."""
    names = list(fingerprints or rules.FINGERPRINTS)
    each = F.array(*[F.struct(F.lit(n).alias("template"), F.col(f"score_{n}").alias("score")) for n in names])
    return with_scores(pages, fingerprints).select("doc_id", "page_no", F.inline(each))


def with_template(pages: DataFrame, available: list[str] | None = None, footers=None, fingerprints=None) -> DataFrame:
    """Add `footer`, `fingerprint` and `template`.

    The footer decides, else the fingerprint: the best score, if it amounts to a strong phrase and leads the second by as
    much. An edition without a template falls back to its older one, or to none.
    """
    names = list(fingerprints or rules.FINGERPRINTS)
    scores = [F.col(f"score_{n}") for n in names]
    rows = with_scores(pages.withColumn("_end", page_end("text")), fingerprints).withColumn(
        "_top", F.sort_array(F.array(*scores, F.lit(0)), asc=False))
    best, second = F.col("_top")[0], F.col("_top")[1]
    named = reduce(lambda acc, n: F.when(F.col(f"score_{n}") == best, F.lit(n)).otherwise(acc), reversed(names), F.lit(None))
    clear = (best >= rules.MIN_SCORE) & (best - second >= rules.MIN_MARGIN)
    rows = rows.select(*pages.columns, footer_template("_end", footers).alias("footer"), F.when(clear, named).alias("fingerprint"))
    found = F.when(strip("text") != "", F.coalesce("footer", "fingerprint"))
    if available is None:
        return rows.withColumn("template", found)
    resolved = F.when(F.col("_t").isin(available), F.col("_t"))
    for edition, older in rules.EDITION_FALLBACK.items():
        if older in available and edition not in available:
            resolved = F.when(F.col("_t") == edition, F.lit(older)).otherwise(resolved)
    return rows.withColumn("_t", found).withColumn("template", resolved).drop("_t")


def template_phrases(template_pages: DataFrame) -> DataFrame:
    """(template, pages array<struct<tpage, phrases>>) from template_pages(template, tpage, text)."""
    phrases = F.array_distinct(F.regexp_extract_all(F.upper("text"), F.lit(rules.TEMPLATE_PHRASE), F.lit(0)))
    return template_pages.select("template", F.struct("tpage", phrases.alias("phrases")).alias("p")).groupBy("template").agg(
        F.array_sort(F.collect_list("p")).alias("template_pages"))


def template_page(pages: DataFrame, phrases: DataFrame) -> DataFrame:
    """Add `tpage`: the page of the form template whose phrases occur most; ties go to the lowest, 0 when none."""
    def best(up: Column) -> Column:
        scored = F.transform(F.filter("template_pages", lambda p: F.size(p["phrases"]) > 0), lambda p: F.struct(
            F.size(F.filter(p["phrases"], lambda w: F.contains(up, w))).alias("n"), (-p["tpage"]).alias("back")))
        return F.coalesce(-F.array_max(scored)["back"], F.lit(0))

    joined = pages.join(phrases, "template", "left")
    return joined.select(*[pages[c] for c in pages.columns], F.when(
        pages["template"].isNotNull(), let(F.upper(pages["text"]), best)).cast("int").alias("tpage"))


def page_map(pages: DataFrame, template_pages: DataFrame, available: list[str] | None = None) -> DataFrame:
    """(doc_id, page_no, template, tpage) for the pages that show a known form."""
    found = with_template(pages, available).where(F.col("template").isNotNull())
    return template_page(found, template_phrases(template_pages)).select("doc_id", "page_no", "template", "tpage")


def signals(text: Column | str, patterns: list[str]) -> Column:
    return _total([col(text).rlike(p).cast("int") for p in patterns])


def with_page_kind(pages: DataFrame, loss_signals=None, schedule_signals=None) -> DataFrame:
    """Add kind and the signal count or text length behind it. Pages may bring their `template` along."""
    rows = pages if "template" in pages.columns else with_template(pages).drop("footer", "fingerprint")
    out = rows.select("*", F.length(strip("text")).alias("_n"), F.col("template").isNotNull().alias("_form"),
                      signals("text", loss_signals or rules.LOSS_SIGNALS).alias("_loss"),
                      signals("text", schedule_signals or rules.SCHEDULE_SIGNALS).alias("_sched"))
    kind = (F.when(F.col("_n") < rules.EMPTY_BELOW, "EMPTY").when(F.col("_form"), "ACORD_FORM")
            .when(F.col("_loss") >= rules.LOSS_AT_LEAST, "LOSS_RUN").when(F.col("_sched") >= rules.SCHEDULE_AT_LEAST, "SOV_TABLE")
            .when(F.col("_n") > rules.NARRATIVE_ABOVE, "NARRATIVE").otherwise("UNKNOWN"))
    out = out.withColumn("kind", kind)
    detail = (F.when(F.col("kind") == "LOSS_RUN", F.col("_loss")).when(F.col("kind") == "SOV_TABLE", F.col("_sched"))
              .when(F.col("kind") == "ACORD_FORM", F.lit(None)).otherwise(F.col("_n")))
    return out.withColumn("detail", detail).drop("_n", "_form", "_loss", "_sched")


def page_runs(kinds: DataFrame) -> DataFrame:
    """(doc_id, run_no, kind, first_page, last_page, n_pages): consecutive pages of one kind."""
    rows = kinds.select("doc_id", "page_no", "kind")
    numbered = running(rows, ["doc_id"], "page_no", changes={"run_no": F.col("kind")})
    return numbered.groupBy("doc_id", "run_no").agg(
        F.min("kind").alias("kind"), F.min("page_no").alias("first_page"), F.max("page_no").alias("last_page"),
        F.count(F.lit(1)).alias("n_pages"))


def kind_histogram(kinds: DataFrame) -> DataFrame:
    return kinds.groupBy("doc_id", "kind").agg(F.count(F.lit(1)).alias("n_pages"), F.min("page_no").alias("first_page"))


def primary_kind(kinds: DataFrame) -> DataFrame:
    """(doc_id, primary_kind, n_pages, kinds_present): most frequent informative kind, ties to the first seen."""
    informative = ~F.col("kind").isin(rules.UNINFORMATIVE)
    return kind_histogram(kinds).groupBy("doc_id").agg(
        F.coalesce(F.max_by(F.when(informative, F.col("kind")),
                            F.when(informative, F.struct("n_pages", -F.col("first_page")))), F.lit("UNKNOWN")).alias("primary_kind"),
        F.sum("n_pages").alias("n_pages"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "n_pages")))).alias("kinds_present"))


def file_type(name: Column | str) -> Column:
    return let(F.lower(col(name)), lambda n: first_match(n, rules.FILE_TYPES, rules.FILE_TYPE_DEFAULT))


def routed_type(by_name: Column | str, by_content: Column | str) -> Column:
    """Content decides only where it shows a form or a loss run."""
    out = col(by_name)
    for kind, doc_type in rules.CONTENT_OVERRIDES.items():
        out = F.when(col(by_content) == kind, F.lit(doc_type)).otherwise(out)
    return out


def suffix(name: Column | str) -> Column:
    return F.lower(F.regexp_extract(col(name), r"(?s)^.+(\.[^.]*)$", 1))


def stem(name: Column | str) -> Column:
    return F.regexp_extract(col(name), r"(?s)^(.+?)(\.[^.]*)?$", 1)


def attachments(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Add attachment type, MIME type and description."""
    mime = reduce(lambda acc, kv: F.when(suffix(name) == kv[0], F.lit(kv[1])).otherwise(acc),
                  rules.MIME_TYPES.items(), F.lit(rules.MIME_DEFAULT))
    return files.select("*", let(F.lower(name), lambda n: first_match(n, rules.ATTACHMENT_TYPES, rules.ATTACHMENT_DEFAULT)).alias(
        "attachment_type"), mime.alias("mime_type"), stem(name).alias("description"))


def prompt_routes(pages: DataFrame, routes: DataFrame, default: str = rules.PROMPT_DEFAULT) -> DataFrame:
    """Add prompt_id: the document type's route, else its route for the page, else the default."""
    whole = routes.where("page_no IS NULL").select("doc_type", F.col("prompt_id").alias("_whole"))
    paged = routes.where("page_no IS NOT NULL").select("doc_type", "page_no", F.col("prompt_id").alias("_paged"))
    return pages.join(whole, "doc_type", "left").join(paged, ["doc_type", "page_no"], "left").select(
        *pages.columns, F.coalesce("_whole", "_paged", F.lit(default)).alias("prompt_id"))


def checkbox_hints(tmpl_fields: DataFrame) -> DataFrame:
    """(template, tpage, n_checkboxes, n_text_fields) for the prompt of a templated page."""
    return tmpl_fields.groupBy("template", "tpage").agg(
        F.count_if(F.col("ftype") == "/Btn").alias("n_checkboxes"), F.count_if(F.col("ftype") == "/Tx").alias("n_text_fields"))


def readable(pages: DataFrame) -> DataFrame:
    """Add `garbled`; the text of unreadable pages becomes empty, its length stays."""
    flag = F.contains(F.coalesce("text", F.lit("")), F.lit(rules.UNREADABLE_MARK))
    kept = [F.when(flag, F.lit("")).otherwise(F.col("text")).alias("text") if c == "text" else F.col(c) for c in pages.columns]
    return pages.select(*kept, flag.alias("garbled"), F.length("text").alias("raw_chars"))


def readable_text(pages: DataFrame) -> DataFrame:
    """(doc_id, page_no, text) of the pages that cross-checks may use."""
    return readable(pages).select("doc_id", "page_no", blank_to_null("text").alias("text")).where("text IS NOT NULL")
