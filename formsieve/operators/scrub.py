"""Predicates over extracted values, and removing form text from model output."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import camel_words, col, is_upper, let, norm_dedup, strip
from ..rules import fields as rules
from . import leaves, packs


def is_amount(value: Column | str, vtype: Column | str, booleans: bool = False) -> Column:
    """Any number, or text that is one after removing blanks, dollar sign and commas. `booleans`: legacy rule."""
    vtype = col(vtype)
    kinds = ["number", "boolean"] if booleans else ["number"]
    text = (vtype == "string") & F.replace(col(value), F.lit(" "), F.lit("")).rlike(rules.AMOUNT)
    return F.coalesce(vtype.isin(kinds) | text, F.lit(False))


def is_label(value: Column | str) -> Column:
    """Form label captured as a value: numbered question, capital label with a colon, long capitals that are neither a
    business name, nor a street address, nor a data row with digits."""

    def rule(s: Column) -> Column:
        n = F.length(s)
        before_colon = strip(F.replace(s, F.lit(":"), F.lit("")))
        body = F.regexp_replace(s, r"^\d+\.\s+", "")
        return (F.when(n < rules.LABEL_AT_LEAST, False).when(s.rlike(rules.NUMBERED_QUESTION), True)
                .when(F.endswith(s, F.lit(":")) & (n > rules.LABEL_LONGER_THAN) & is_upper(before_colon), True)
                .when(is_upper(s) & (n > rules.CAPITALS_LONGER_THAN),
                      ~s.rlike(rules.BUSINESS_SUFFIX) & ~s.rlike(rules.STREET_START) & ~body.rlike(r"\d"))
                .otherwise(False))

    return F.coalesce(let(strip(value), rule), F.lit(False))


def is_label_legacy(value: Column | str, exceptions: list[str]) -> Column:
    """Earlier rule: long capitals unless they contain an exception, or a numbered prefix with or without period."""
    s = col(value)
    known = reduce(lambda a, b: a | b, [F.contains(s, F.lit(e)) for e in exceptions], F.lit(False))
    long_capitals = is_upper(s) & (F.length(s) > rules.CAPITALS_LONGER_THAN) & ~known
    return F.coalesce((F.length(s) >= rules.LABEL_AT_LEAST) & (long_capitals | s.rlike(rules.LEGACY_NUMBERED_QUESTION)), F.lit(False))


def is_garbage(value: Column | str) -> Column:
    """Form text instead of data; blank text counts as well."""

    def rule(s: Column) -> Column:
        return let(norm_dedup(s), lambda n: (
            (s == "") | n.isin(rules.TEMPLATE_GARBAGE) | n.isin(rules.BOX_GLYPHS) | s.rlike(rules.NUMBERED_QUESTION)
            | (F.endswith(s, F.lit("?")) & (F.length(s) > rules.QUESTION_LONGER_THAN))
            | ((F.length(s) > rules.CAPITALS_LONGER_THAN) & is_upper(s) & ~s.rlike(r"\d") & ~F.contains(s, F.lit(":")))
            | s.rlike(rules.CHOICE_PREFIX)))

    return F.coalesce(let(strip(value), rule), F.lit(False))


def survives_scrub(value: Column | str, vtype: Column | str) -> Column:
    """Leaf-level scrub: numbers and booleans stay, text stays unless it is garbage, the rest goes."""
    vtype = col(vtype)
    return vtype.isin("number", "boolean") | ((vtype == "string") & ~is_garbage(value))


def scrub_leaves(leaf_rows: DataFrame) -> DataFrame:
    """A branch whose last leaf goes is gone with it."""
    return leaf_rows.where(survives_scrub("value", "vtype"))


def scrub_json(df: DataFrame, keys: list[str], json: str = "content", carry: list[str] | None = None) -> DataFrame:
    """(keys, content): scrubbed JSON; no row where nothing is left. With columns to `carry`, one row for each record."""
    return leaves.sift(df, keys, lambda text: survives_scrub(text, F.lit("string")), json, carry)


def checkbox_labels(tmpl_fields: DataFrame) -> DataFrame:
    """(template, tpage, label): option texts of the checkboxes of each form page, with synonyms and constants."""
    base = F.regexp_replace(F.regexp_replace(F.regexp_replace("name", r"\[\d+\]$", ""), r"_[A-Z]$", ""), r"Indicator$", "")
    option = F.element_at(F.split(base, "_"), -1)
    synonyms = F.create_map(*[x for k, v in rules.CHECKBOX_SYNONYMS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    words = strip(camel_words(option))
    per_field = F.when(words != "", F.concat(F.array(words), F.coalesce(F.try_element_at(synonyms, F.lower(option)),
                                                                       F.array().cast("array<string>"))))
    named = tmpl_fields.where("ftype = '/Btn'").select("template", "tpage", F.explode(per_field).alias("label"))
    constants = tmpl_fields.select("template", "tpage").distinct().select(
        "template", "tpage", F.explode(F.array(*map(F.lit, rules.CHECKBOX_CONSTANTS))).alias("label"))
    return named.unionByName(constants).distinct()


def drop_option_labels(values: DataFrame, page_map: DataFrame, labels: DataFrame, value: str = "value") -> DataFrame:
    """Drop text values that name a checkbox option of their page's form. Values travel to their page's form in packs."""
    forms = packs.keyed(page_map, packs.PAGE, ["template", "tpage"])
    met = packs.packed(values, packs.PAGE).join(forms, packs.PAGE, "left")
    placed = packs.unpacked(met, [*packs.PAGE, "template", "tpage"], values.columns).withColumn(
        "label", F.when(F.col("vtype") == "string", norm_dedup(value)))
    return placed.join(labels, ["template", "tpage", "label"], "left_anti").select(*values.columns)


def bled_address(value: Column | str) -> Column:
    """A street address ran into the value."""
    return F.coalesce(col(value).rlike(rules.ADDRESS_BLED), F.lit(False))


def filled_cells(row: Column | str) -> Column:
    return F.size(F.filter(row, lambda c: strip(F.coalesce(c, F.lit(""))) != ""))


def enough_cells(row: Column | str, least: int) -> Column:
    return filled_cells(row) >= least
