"""Scoring a record against ground truth, leaf by leaf."""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import compare_date, number
from ..functions.text import norm_compare
from . import leaves

# List items are matched by the first of these keys that the first expected item has.
SORT_KEYS = ["Name", "BuildingNumber", "ClaimNumber", "FileName", "LocationNumber", "Email"]
ABSOLUTE, RELATIVE, LONG_TEXT = 1.0, 0.005, 30
ANY_VALUE, NOT_SCORED = "*", "N/A"

CONTAINER = ["o", "a"]


def _truth(value: Column, vtype: Column) -> Column:
    return (F.when(vtype == "boolean", value == "true").when(vtype == "number", value.try_cast("double") != 0)
            .when(vtype.isin("null", "object", "array"), False).otherwise(F.coalesce(value, F.lit("")) != ""))


def with_verdict(rows: DataFrame, strict_bool: bool = False) -> DataFrame:
    """Add `verdict` (CORRECT, WRONG, MISSING, EXTRA, N/A) to rows of gt_value, gt_type, out_value, out_type.

    A missing output has a NULL type. A flag compares by truthiness, so any text counts as true; `strict_bool` reads
    no/false/0/n/off text as false. What several rules read is computed in a projection of its own.
    """
    gt, out, gt_type, out_type = F.col("gt_value"), F.col("out_value"), F.col("_gt"), F.col("_ot")
    prepared = rows.withColumns({"_gt": F.coalesce("gt_type", F.lit("null")), "_ot": F.coalesce("out_type", F.lit("null"))}).withColumns({
        "_gn": F.when(gt_type == "number", number(gt)),
        "_on": F.when((gt_type == "number") & ~out_type.isin(CONTAINER), number(F.translate(out, ",$", ""))),
        "_gd": F.when(gt_type == "string", compare_date(gt)), "_od": F.when(gt_type == "string", compare_date(out)),
        "_gs": F.when(gt_type == "string", norm_compare(gt)), "_os": F.when(gt_type == "string", norm_compare(out))})
    gt_text = gt_type == "string"
    out_blank = (out_type == "null") | ((out_type == "string") & (out == ""))
    out_empty = out_blank | out_type.isin("object", "array")
    out_false = (out_type == "boolean") & (out == "false")
    out_truth = _truth(out, out_type)
    if strict_bool:
        out_truth = F.when((out_type == "string") & F.lower(out).isin("no", "false", "0", "n", "off"), False).otherwise(out_truth)
    g, o = F.col("_gn"), F.col("_on")
    gap = F.abs(g - o)
    numeric = (gap < ABSOLUTE) | ((g != 0) & (gap / F.nullif(F.abs(g), F.lit(0.0)) < RELATIVE))
    same_text = (F.col("_gs") == F.col("_os")) | ((F.length(gt) > LONG_TEXT) & F.contains("_os", "_gs"))
    text = F.when(F.col("_gd").isNotNull() & F.col("_od").isNotNull(), F.col("_gd") == F.col("_od")).otherwise(same_text)

    def ok(c: Column) -> Column:
        return F.when(c, "CORRECT").otherwise("WRONG")

    verdict = (F.when((gt_type == "null") | (gt_text & (gt == "")), F.when(out_empty | out_false, "CORRECT").otherwise("EXTRA"))
               .when(gt_text & (gt == ANY_VALUE), F.when(out_empty, "MISSING").otherwise("CORRECT"))
               .when(gt_text & (gt == NOT_SCORED), "N/A").when(out_blank, "MISSING")
               .when((gt_type == "boolean") | (out_type == "boolean"), ok(_truth(gt, gt_type) == out_truth))
               .when(gt_type == "number", ok(numeric)).otherwise(ok(text)))
    return prepared.select(*rows.columns, verdict.alias("verdict"))


def compare_leaves(gt: DataFrame, out: DataFrame, keys: list[str], strict_bool: bool = False) -> DataFrame:
    """(keys, gt_value, out_value, verdict) for flat leaves (keys, value, vtype): every expected leaf."""
    g = gt.select(*keys, F.col("value").alias("gt_value"), F.col("vtype").alias("gt_type"))
    o = out.select(*keys, F.col("value").alias("out_value"), F.col("vtype").alias("out_type"))
    return with_verdict(g.join(o, keys, "left"), strict_bool).select(*keys, "gt_value", "out_value", "verdict")


def _sort_text(item, key: str) -> str:
    """Normalized text of an item's sort key; items without one, or with an empty one, share the empty text."""
    value = item.get(key) if isinstance(item, dict) else None
    if not value:
        return ""
    return " ".join(("true" if value is True else leaves.text_of(value)[0]).lower().split())


def _paired(expected: list, got: list, mode: str) -> tuple[list[tuple], list[int]]:
    """((number, expected item, whether there is an output item, that item)..., numbers of surplus output items)."""
    first = expected[0] if expected else None
    key = next((k for k in SORT_KEYS if k in first), None) if isinstance(first, dict) else None
    if key is not None and mode == "key":
        free: dict[str, list[int]] = {}
        for i in reversed(range(len(got))):
            free.setdefault(_sort_text(got[i], key), []).append(i)
        own = [held.pop() if (held := free.get(_sort_text(item, key))) else None for item in expected]
        surplus = len(got) - sum(i is not None for i in own)
        return [(n, item, i is not None, None if i is None else got[i]) for n, (item, i) in enumerate(zip(expected, own))], list(
            range(len(expected), len(expected) + surplus))
    if key is not None:
        expected, got = (sorted(side, key=lambda item: _sort_text(item, key)) for side in (expected, got))
    return [(n, item, n < len(got), got[n] if n < len(got) else None) for n, item in enumerate(expected)], list(range(len(expected), len(got)))


def pairs(expected, has_output: bool, output, mode: str) -> Iterator[tuple]:
    """(path, expected text, type, output text, type, surplus) of every expected leaf and every surplus list item.

    Lists are aligned where they are met, at any depth; the walk keeps its own stack.
    """
    stack = [("", expected, has_output, output)]
    while stack:
        path, g, has, o = stack.pop()
        if isinstance(g, dict):
            inside = o if has and isinstance(o, dict) else {}
            stack.extend((f"{path}.{k}" if path else k, v, k in inside, inside.get(k)) for k, v in reversed(g.items()) if not k.startswith("_"))
        elif isinstance(g, list):
            paired, surplus = _paired(g, o if has and isinstance(o, list) else [], mode)
            yield from ((f"{path}[{n}]", None, None, "(extra item)", None, True) for n in surplus)
            stack.extend((f"{path}[{n}]", item, there, other) for n, item, there, other in reversed(paired))
        else:
            yield path, *leaves.text_of(g), *(leaves.text_of(o) if has else (None, None)), False


def _pair_batches(mode: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, source, found = batch.columns[:-2], [], []

            def flush() -> pa.RecordBatch:
                take = pa.array(source, pa.int64())
                kinds = [pa.string()] * 5 + [pa.bool_()]
                return pa.RecordBatch.from_arrays([k.take(take) for k in keys] + [pa.array(c, t) for c, t in zip(zip(*found), kinds)],
                                                  names=[*batch.schema.names[:-2], "path", "gt_value", "gt_type", "out_value", "out_type", "surplus"])

            for row, (gt, out) in enumerate(zip(batch.columns[-2].to_pylist(), batch.columns[-1].to_pylist())):
                ok, expected = leaves.parse(gt)
                if ok:
                    for pair in pairs(expected, *leaves.parse(out), mode):
                        source.append(row)
                        found.append(pair)
                        if len(found) >= leaves.ROWS_PER_BATCH:
                            yield flush()
                            source, found = [], []
            if found:
                yield flush()
    return run


def compare_records(gt: DataFrame, out: DataFrame, keys: list[str], json: str = "content", mode: str = "rank", strict_bool: bool = False) -> DataFrame:
    """(keys, path, gt_value, out_value, verdict) of two nested records per key.

    Every expected leaf gets a verdict; items beyond the expected length of a list count as EXTRA; keys starting with an
    underscore and surplus object keys are ignored. Lists of any depth are aligned: items sort by the normalized text of the
    sort key, ties keep their order, and pair by rank; mode 'key' pairs equal key texts instead, so that one missing item
    does not shift the others. One join brings two records together; everything after it stays in its task.
    """
    both = gt.select(*keys, F.col(json).alias("_gt")).join(out.select(*keys, F.col(json).alias("_out")), keys, "left").select(*keys, "_gt", "_out")
    columns = "path string, gt_value string, gt_type string, out_value string, out_type string, surplus boolean"
    rows = both.mapInArrow(_pair_batches(mode), leaves.key_schema(gt, keys) + columns)
    judged = with_verdict(rows, strict_bool)
    return judged.select(*keys, "path", "gt_value", "out_value", F.when(F.col("surplus"), "EXTRA").otherwise(F.col("verdict")).alias("verdict"))


def score(verdicts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Counts per verdict, accuracy, precision and recall; leaves marked N/A do not count."""
    names = {"correct": "CORRECT", "wrong": "WRONG", "missing": "MISSING", "extra": "EXTRA", "skipped": "N/A"}
    counts = verdicts.groupBy(*(keys or [])).agg(*[F.count_if(F.col("verdict") == v).alias(n) for n, v in names.items()])

    def share(*of: str) -> Column:
        return F.try_divide(F.col("correct").cast("double"), reduce(lambda a, b: a + b, [F.col(c) for c in of]))

    return counts.select("*", share("correct", "wrong", "missing", "extra").alias("accuracy"),
                         share("correct", "wrong").alias("precision"), share("correct", "missing").alias("recall"))
