"""Reading values by position.

Words meet boxes through an equality on form page and vertical band, with containment as the residual condition, so a
word is tested against the boxes of its own band only. Words meet labels on the same page through a grid of cells as
large as the search range. Concatenation groups are the cells of the output, never whole pages.
"""
from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions.text import SPACES, after_colon, blank_to_null, let, squeeze, strip
from ..rules import fields as rules
from ..session import materialize
from . import ordered

BAND = 24.0
PAGE = ["doc_id", "page_no"]
# Words of one page that a task holds at most while it reads lines or marks; a page with more is spread over tasks.
PAGE_WORDS = 20_000
# Pairs of a word and a cross of one page that are compared at once.
PAIRS_AT_ONCE = 1_000_000


def ordered_text(text: str = "text", row: str = "top", x0: str = "x0", ord_: str = "ord") -> Column:
    """Words of a group in reading order, joined by spaces."""
    words = F.array_sort(F.collect_list(F.struct(geo.reading_order(row, x0, ord_).alias("at"), F.col(text).alias("t"))))
    return F.array_join(F.transform(words, lambda w: w["t"]), " ")


def _without_labels(text: Column, labels: Column) -> Column:
    cleaned = F.aggregate(labels, text, lambda acc, l: strip(F.replace(acc, l, F.lit(""))))
    return blank_to_null(strip(squeeze(F.coalesce(cleaned, text))))


def words_in_regions(words: DataFrame, regions: DataFrame, on: list[str], pad: float = geo.REGION_PAD) -> DataFrame:
    """Words joined to the regions of their page type that contain them whole."""
    side = regions.withColumn("_band", F.explode(geo.cells(F.col("y0") - pad, F.col("y1") + pad, BAND)))
    rows = words.withColumn("_band", geo.cell(F.col("top"), BAND))
    inside = ((rows["x0"] >= side["x0"] - pad) & (rows["x1"] <= side["x1"] + pad) &
              (rows["top"] >= side["y0"] - pad) & (rows["bottom"] <= side["y1"] + pad))
    cond = [rows[c] == side[c] for c in [*on, "_band"]] + [inside]
    keep = [side[c] for c in regions.columns if c not in (*on, "x0", "y0", "x1", "y1")]
    return rows.join(side, cond).select(*[rows[c] for c in words.columns], *keep)


def region_text(words: DataFrame, regions: DataFrame, on: list[str], extra: list[str] | None = None) -> DataFrame:
    """(doc_id, page_no, region, value). regions: on..., region, x0, y0, x1, y1, exclude array<string>."""
    extra = extra or []
    hits = words_in_regions(words, regions, on)
    grouped = hits.groupBy(*PAGE, "region", *extra).agg(ordered_text().alias("value"), F.first("exclude").alias("exclude"))
    return grouped.select(*PAGE, "region", *extra, _without_labels(strip("value"), F.coalesce("exclude", F.array().cast(
        "array<string>"))).alias("value")).where("value IS NOT NULL")


def right_of_label(words: DataFrame, labels: DataFrame, known: list[str] | None = None, max_gap: float = rules.LABEL_MAX_GAP,
                   y_tol: float = rules.LABEL_Y_TOL) -> DataFrame:
    """(doc_id, page_no, label, value): text right of the first occurrence of the label that has any. labels: (label)."""
    known = rules.KNOWN_LABELS if known is None else known
    text = strip("text")
    marks = words.withColumn("label", text).join(labels, "label", "left_semi").select(
        *PAGE, "label", F.col("ord").alias("l_ord"), F.col("x1").alias("l_x1"), F.col("top").alias("l_top"))
    marks = marks.withColumn("_y", F.explode(geo.cells(F.col("l_top") - y_tol, F.col("l_top") + y_tol, y_tol))).withColumn(
        "_x", F.explode(geo.cells(F.col("l_x1") - rules.LABEL_OVERLAP, F.col("l_x1") + max_gap, max_gap)))
    values = words.where(~text.isin(known)).select(
        *PAGE, "ord", "text", "x0", "top", geo.cell(F.col("top"), y_tol).alias("_y"), geo.cell(F.col("x0"), max_gap).alias("_x"))
    near = ((F.col("x0") > F.col("l_x1") - rules.LABEL_OVERLAP) & (F.col("x0") < F.col("l_x1") + max_gap) &
            (F.abs(F.col("top") - F.col("l_top")) < y_tol))
    hits = marks.join(values, [*PAGE, "_y", "_x"]).where(near)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "ord", "text"))), lambda w: w["text"]), " ")
    per_mark = hits.groupBy(*PAGE, "label", "l_ord").agg(strip(joined).alias("value"))
    return per_mark.groupBy(*PAGE, "label").agg(F.min_by("value", "l_ord").alias("value"))


def _spread_marks(found: DataFrame, crosses: DataFrame, y_tol: float, x_range: float) -> DataFrame:
    """(page, label): labelled words meet crosses through a grid of cells, so no step needs a page in one task."""
    found = found.select(*PAGE, F.explode("labels").alias("label"), F.col("x0").alias("l_x0"), F.col("top").alias("l_top"))
    found = found.withColumn("_y", F.explode(geo.cells(F.col("l_top") - y_tol, F.col("l_top") + y_tol, y_tol))).withColumn(
        "_x", F.explode(geo.cells(F.col("l_x0") - x_range, F.col("l_x0") + x_range, x_range)))
    edges = crosses.select(*PAGE, "top", F.explode(F.array("x0", "x1")).alias("edge")).select(
        *PAGE, "top", "edge", geo.cell(F.col("top"), y_tol).alias("_y"), geo.cell(F.col("edge"), x_range).alias("_x"))
    cond = [found[c] == edges[c] for c in [*PAGE, "_y", "_x"]] + [
        F.abs(edges["top"] - found["l_top"]) < y_tol, F.abs(edges["edge"] - found["l_x0"]) < x_range]
    return found.join(edges, cond, "left_semi").select(*PAGE, "label").distinct()


def _marked(x0: np.ndarray, top: np.ndarray, crosses: tuple[np.ndarray, np.ndarray, np.ndarray], y_tol: float, x_range: float) -> np.ndarray:
    """Of each word whether one of the crosses (x0, x1, top) of its page is beside it; NaN is beside nothing."""
    c_x0, c_x1, c_top = crosses
    near, step = np.zeros(len(x0), bool), max(1, PAIRS_AT_ONCE // max(len(c_top), 1))
    for a in range(0, len(x0), step):
        x, y = x0[a:a + step, None], top[a:a + step, None]
        near[a:a + step] = ((np.abs(c_top - y) < y_tol) & ((np.abs(c_x0 - x) < x_range) | (np.abs(c_x1 - x) < x_range))).any(axis=1)
    return near


def _mark_batches(y_tol: float, x_range: float) -> Callable:
    """Arrow function: (page, x0, x1, top, cross, places of labels) in; (page, place of a label) out, and for every stretch of
    words of one page a row of the place -1."""
    def read(words: pa.RecordBatch) -> pa.RecordBatch:
        first = _stretches(words)
        ends = np.append(first[1:], len(words))
        x0, x1, top = (words.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("x0", "x1", "top"))
        cross = pc.fill_null(words.column("cross"), False).to_numpy(zero_copy_only=False)
        listed, at = words.column("labels").flatten().to_numpy(), words.column("labels").offsets.to_numpy() - words.column("labels").offsets[0].as_py()
        rows, places = [first], [np.full(len(first), -1)]
        with np.errstate(invalid="ignore"):
            for a, b in zip(first, ends):
                c = a + np.flatnonzero(cross[a:b])
                w = a + np.flatnonzero(at[a + 1:b + 1] > at[a:b])
                if len(c) and len(w):
                    w = w[_marked(x0[w], top[w], (x0[c], x1[c], top[c]), y_tol, x_range)]
                    if len(w):
                        places.append(np.unique(np.concatenate([listed[at[i]:at[i + 1]] for i in w])))
                        rows.append(np.full(len(places[-1]), a))
        take = pa.array(np.concatenate(rows))
        return pa.RecordBatch.from_arrays([*(k.take(take) for k in words.columns[:2]), pa.array(np.concatenate(places), pa.int32())], names=[*PAGE, "place"])

    return lambda batches: _held_pages(batches, read)


def marked_labels(words: DataFrame, labels: list[str], y_tol: float = rules.MARK_Y_TOL,
                  x_range: float = rules.MARK_X_RANGE) -> DataFrame:
    """(doc_id, page_no, label): labels with an X mark beside a word that contains them.

    Crosses and words with labels mostly lie next to each other, page by page, so pages are read where they lie and no word is
    shuffled. Pages found in more than one place (of several partitions, larger than a task may hold, or mixed with others) are
    read again, spread over tasks.
    """
    listed = F.array(*[F.lower(F.lit(x)) for x in labels])
    held = let(F.lower("text"), lambda low: F.filter(F.transform(listed, lambda l, i: F.when(F.contains(low, l), i)), lambda i: i.isNotNull()))
    words = words.select(*PAGE, *[F.col(c).cast("double").alias(c) for c in ("x0", "x1", "top")], F.coalesce(strip("text") == rules.MARK, F.lit(False)).alias("cross"),
                         F.coalesce(held, F.array().cast("array<int>")).alias("labels")).where("doc_id IS NOT NULL AND page_no IS NOT NULL AND (cross OR size(labels) > 0)")
    types = dict(words.dtypes)
    found = materialize(words.mapInArrow(_mark_batches(y_tol, x_range), "".join(f"{k} {types[k]}, " for k in PAGE) + "place int"))
    named = lambda place: F.element_at(F.array(*[F.lit(x) for x in labels]), place + 1)
    whole = found.where("place >= 0").select(*PAGE, named(F.col("place")).alias("label"))
    apart = materialize(found.where("place < 0").groupBy(*PAGE).agg(F.count("*").alias("n")).where("n > 1").select(*PAGE))
    if apart.isEmpty():
        return whole.distinct() if len(set(labels)) < len(labels) else whole
    again = words.join(apart, PAGE, "left_semi")
    spread = _spread_marks(again.where("size(labels) > 0").withColumn("labels", F.transform("labels", named)), again.where("cross"), y_tol, x_range)
    return whole.join(apart, PAGE, "left_anti").unionByName(spread).distinct()


def checked_options(words: DataFrame, options: list[tuple[str, str]]) -> DataFrame:
    """(doc_id, page_no, options array): names of the checked options in option order. options: (label, name)."""
    labels = F.array(*[F.lit(label) for label, _ in options])
    names = F.array(*[F.lit(name) for _, name in options])
    marked = marked_labels(words, [label for label, _ in options])
    listed = F.array_sort(F.collect_list(F.array_position(labels, F.col("label"))))
    return marked.groupBy(*PAGE).agg(F.transform(listed, lambda o: F.element_at(names, o.cast("int"))).alias("options"))


def blocks(words: DataFrame, block_regions: DataFrame, on: list[str], columns: list[str], anchors: list[str]) -> DataFrame:
    """(doc_id, page_no, block_no, one column per sub-box): repeating blocks with at least one anchor filled.

    block_regions: on..., block_no, region (= column name), x0, y0, x1, y1, exclude.
    """
    cells = region_text(words, block_regions, on, extra=["block_no"])
    wide = cells.groupBy(*PAGE, "block_no").pivot("region", columns).agg(F.first("value"))
    return wide.where(F.coalesce(*[F.col(a) for a in anchors]).isNotNull())


def _next_starts(tops: DataFrame) -> DataFrame:
    """(page, top, next): where the line after one that starts at `top` starts, as the struct of `at`.

    That is the first place, in reading order, among the tops too far from it. It depends on the top alone, so each
    distinct top asks once: tops and questions stand in one falling order, and a running minimum answers.
    """
    far = F.col("top") + geo.LINE_TOLERANCE
    # The least number whose difference from the top reaches the tolerance in floating point, as words are compared.
    below, above = far - F.abs(far) * 1.12e-16, far + F.abs(far) * 2.3e-16
    reaches = lambda v: v - F.col("top") >= geo.LINE_TOLERANCE
    least = F.when(reaches(below), below).when(reaches(far), far).otherwise(above)
    places = tops.select(*PAGE, F.struct((-F.col("top")).alias("v"), F.lit(0).alias("asks"), "top").alias("pos"), "at")
    asked = tops.select(*PAGE, F.struct((-least).alias("v"), F.lit(1).alias("asks"), "top").alias("pos"), F.lit(None).cast(tops.schema["at"].dataType).alias("at"))
    found = ordered.running(places.unionByName(asked), PAGE, "pos", mins={"next": F.col("at")})
    return found.where("pos.asks = 1 AND next IS NOT NULL").select(*PAGE, F.col("pos.top").alias("top"), "next")


def _rows_with_starts(words: DataFrame) -> DataFrame:
    """(page, row, start, n): the word that starts a line inside each rounded row, if one does, and the starts so far.

    A row holds one start at most, as the tolerance is larger than a row. Rows too far below the row before always hold
    one. Only where rows follow more closely is there a chain of pointers from line to line to go along, and it is gone
    along in doubled steps, as many rounds as the longest run of close lines has binary digits.
    """
    at = geo.reading_order("top", "x0", "ord").withField("top", F.col("top"))
    tops = materialize(words.where("top IS NOT NULL").groupBy(*PAGE, "top").agg(F.min(at).alias("at")))
    rows = tops.groupBy(*PAGE, F.col("at.row").alias("row")).agg(F.min("at").alias("at"))
    rows = materialize(ordered.running(rows, PAGE, "row", previous={"above": F.col("row")}))
    apart = F.col("above").isNull() | (F.col("row") - F.col("above") >= geo.LINE_TOLERANCE + 1)
    sure, close = rows.where(apart).select(*PAGE, "at"), rows.where(~apart)
    # Only tops of rows with a close neighbour need pointers; one that leaves such a run arrives at a sure start.
    near = close.select(*PAGE, "row").unionByName(close.select(*PAGE, F.col("above").alias("row")))
    asking = tops.withColumn("row", F.col("at.row")).join(near, [*PAGE, "row"], "left_semi").drop("row")
    steps = _next_starts(asking).join(sure.select(*PAGE, F.col("at").alias("next")), [*PAGE, "next"], "left_anti")
    steps, starts = materialize(steps.select(*PAGE, "top", "next")), sure
    while not steps.isEmpty():
        ahead = starts.withColumn("top", F.col("at.top")).join(steps, [*PAGE, "top"]).select(*PAGE, F.col("next").alias("at"))
        starts = materialize(starts.unionByName(ahead).distinct())
        onward = steps.select(*PAGE, F.col("top").alias("_top"), F.col("next").alias("_next"))
        steps = materialize(steps.withColumn("_top", F.col("next.top")).join(onward, [*PAGE, "_top"]).select(*PAGE, "top", F.col("_next").alias("next")))
    held = rows.select(*PAGE, "row").join(starts.select(*PAGE, F.col("at.row").alias("row"), F.struct("at.x", "at.o").alias("start")), [*PAGE, "row"], "left")
    return ordered.running(held, PAGE, "row", sums={"n": F.when(F.col("start").isNotNull(), 1).otherwise(0)})


def _spread_lines(words: DataFrame) -> DataFrame:
    """Lines of pages whose words lie apart or are many: line starts are found on the distinct tops of a page; a word counts
    the starts up to it by its row. Nothing larger than a line is collected, and no step needs a page in one task."""
    placed = words.withColumn("row", F.bround("top")).join(_rows_with_starts(words), [*PAGE, "row"])
    ahead = F.coalesce(F.struct(F.col("x0").alias("x"), F.col("ord").alias("o")) < F.col("start"), F.lit(False))
    numbered = placed.select(*PAGE, (F.col("n") - ahead.cast("int")).alias("line"), F.struct("x0", "ord", "text").alias("word"))
    texts = numbered.groupBy(*PAGE, "line").agg(F.array_join(F.transform(F.array_sort(F.collect_list("word")), lambda w: w["text"]), " ").alias("text"))
    kept = texts.select(*PAGE, "line", strip("text").alias("text")).where("text <> ''")
    return ordered.number_rows(kept, PAGE, ["line"], "line_no").select(*PAGE, "line_no", "text")


def _line_starts(tops: np.ndarray) -> list[int]:
    """Places, in reading order, at which the lines of a page start. A word before another is less than the tolerance below
    it, so the first word that is far enough below a start is the first at which the running maximum is."""
    far, starts, at = np.maximum.accumulate(tops).tolist(), [], 0
    while at < len(far):
        starts.append(at)
        top = float(tops[at])
        at = bisect_left(far, top + geo.LINE_TOLERANCE - abs(top) * 1e-15, at + 1)
        while at < len(far) and far[at] - top < geo.LINE_TOLERANCE:
            at += 1
    return starts


def _stretches(words: pa.RecordBatch) -> np.ndarray:
    """Where neighbouring words are of different pages: the first word of each stretch."""
    other = np.zeros(len(words), bool)
    other[0] = True
    for key in words.columns[:2]:
        other[1:] |= pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(other)


def _stretch_lines(words: pa.RecordBatch) -> pa.RecordBatch:
    """(page, line_no, text) of every stretch of words of one page, and for each a row of line number 0 without text; the
    number is -1 where places are missing or not finite, and the lines do not count."""
    first = _stretches(words)
    top, x0, at = (words.column(c) for c in ("top", "x0", "ord"))
    odd = pc.or_(pc.invert(pc.fill_null(pc.is_finite(top), False)), pc.or_(pc.invert(pc.fill_null(pc.is_finite(x0), False)), pc.is_null(at)))
    odd_in = np.logical_or.reduceat(odd.to_numpy(zero_copy_only=False), first)
    top, x0, at = (np.nan_to_num(c.fill_null(0).to_numpy(zero_copy_only=False)) for c in (top, x0, at))
    stretch = np.repeat(np.arange(len(first)), np.diff(first, append=len(words)))
    reading = np.lexsort((at, x0, np.rint(top), stretch))
    tops = top[reading]
    starts = np.concatenate([f + np.array(_line_starts(tops[f:end])) for f, end in zip(first, [*first[1:], len(words)])])
    line = np.empty(len(words), np.int64)
    line[reading] = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(words)))
    place = np.lexsort((at, x0, line))
    l, x, o = line[place], x0[place], at[place]
    if ((l[1:] == l[:-1]) & (x[1:] == x[:-1]) & (o[1:] == o[:-1])).any():
        place = pc.sort_indices(pa.table({"l": line, "x": x0, "o": at, "t": words.column("text")}),
                                sort_keys=[(c, "ascending") for c in "lxot"]).to_numpy()
    place = place[words.column("text").is_valid().to_numpy(zero_copy_only=False)[place]]
    ends = np.searchsorted(line[place], np.arange(len(starts) + 1))
    text = pc.utf8_trim(pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.column("text").take(pa.array(place))), " "), SPACES)
    kept = np.flatnonzero(pc.not_equal(text, "").to_numpy(zero_copy_only=False))
    owner = stretch[starts[kept]]
    number = np.arange(len(kept)) - np.searchsorted(owner, owner) + 1
    rows = pa.array(np.concatenate([first, starts[kept]]))
    return pa.RecordBatch.from_arrays(
        [*(c.take(rows) for c in words.columns[:2]), pa.array(np.concatenate([np.where(odd_in, -1, 0), number]), pa.int64()),
         pa.concat_arrays([pa.nulls(len(first), pa.string()), text.take(pa.array(kept))])], names=[*PAGE, "line_no", "text"])


def _held_pages(batches: Iterator[pa.RecordBatch], read: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`read` of batches of whole stretches. The last page of a batch may go on in the next one, so it is held back, up to a
    number of words."""
    held = None
    for batch in batches:
        if not len(batch):
            continue
        words = batch if held is None else pa.concat_batches([held, batch])
        done = int(_stretches(words)[-1])
        held = words.slice(done) if len(words) - done <= PAGE_WORDS else None
        if held is None:
            done = len(words)
        if done:
            yield read(words.slice(0, done))
    if held is not None:
        yield read(held)


def _line_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _held_pages(batches, _stretch_lines)


def lines(words: DataFrame) -> DataFrame:
    """(doc_id, page_no, line_no from 1, text): words within 4 units of the first word of the running line form a line.

    Words of a page mostly lie next to each other, so lines are read where they lie, and no word is shuffled. Pages found in
    more than one place (of several partitions, larger than a task may hold, or mixed with others) are read again, spread
    over tasks. Words without a top or a page are in no line.
    """
    words = words.select(*PAGE, F.col("top").cast("double").alias("top"), F.col("x0").cast("double").alias("x0"), "ord", "text").where(
        F.col("doc_id").isNotNull() & F.col("page_no").isNotNull() & F.col("top").isNotNull())
    types = dict(words.dtypes)
    read = words.mapInArrow(_line_batches, "".join(f"{k} {types[k]}, " for k in PAGE) + "line_no bigint, text string")
    found = materialize(read)
    places = found.where("line_no <= 0").groupBy(*PAGE).agg(F.count("*").alias("n"), F.min("line_no").alias("least"))
    apart = materialize(places.where("n > 1 OR least < 0").select(*PAGE))
    whole = found.where("line_no > 0")
    if apart.isEmpty():
        return whole
    return whole.join(apart, PAGE, "left_anti").unionByName(_spread_lines(words.join(apart, PAGE, "left_semi")))


def prefixed_lines(words: DataFrame, prefix: str = rules.OVERFLOW_PREFIX, mark: str = rules.OVERFLOW_MARK) -> DataFrame:
    """(doc_id, page_no, ord, text): words that start a coverage entry."""
    t = strip("text")
    code = F.startswith(t, F.lit(prefix))
    other = F.startswith(t, F.lit("*")) & ~F.contains(t, F.lit("Code")) & F.contains(t, F.lit(mark))
    return words.where(code | other).select(*PAGE, "ord", t.alias("text"))


def overflow_content(words: DataFrame, skip: list[str] | None = None) -> DataFrame:
    """Prefixed entries of a page; pages without any give their lines instead, headers dropped."""
    entries = materialize(prefixed_lines(words))
    # Lines are read before pages with entries go, so that pages and lines are dealt, but no words.
    read = materialize(lines(words))
    rest = materialize(read.groupBy(*PAGE).agg(F.max("line_no").alias("_last")).join(entries.select(*PAGE).distinct(), PAGE, "left_anti"))
    # Page counters are dropped, except on the last line of a page.
    counter = (F.contains("text", F.lit("PAGE")) | F.contains("text", F.lit("OF"))) & (F.col("line_no") != F.col("_last"))
    fallback = read.join(rest, PAGE).where(~counter & ~F.col("text").isin(rules.OVERFLOW_HEADERS if skip is None else skip))
    return entries.select(*PAGE, F.lit("entry").alias("origin"), "text").unionByName(
        fallback.select(*PAGE, F.lit("line").alias("origin"), "text"))


def yes_no(values: DataFrame) -> DataFrame:
    """Answers of the right margin: Y or N stay, anything else (also 'Y / N') is no answer."""
    return values.where(F.col("value").isin("Y", "N"))


def keyed_value(values: DataFrame) -> DataFrame:
    """`KEY:value` boxes reduced to the value."""
    return values.withColumn("value", after_colon("value"))


def premiums(values: DataFrame) -> DataFrame:
    """(doc_id, page_no, premiums map): lines of business with an amount; a lone '$' is none."""
    rows = values.where(F.col("value").isNotNull() & (F.col("value") != "$"))
    return rows.groupBy(*PAGE).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("region", "value")))).alias("premiums"))


def clean_grid(grid: Column | str) -> Column:
    """array<array<string>>: trimmed cells, NULL as '', rows without text dropped; NULL for an empty table."""
    cells = F.transform(grid, lambda row: F.transform(row, lambda c: strip(F.coalesce(c, F.lit("")))))
    rows = F.filter(cells, lambda row: F.exists(row, lambda c: c != ""))
    return F.when(F.size(rows) > 0, rows)


def _anchor_tops(words: DataFrame, keys: list[str], labels: list[str]) -> DataFrame:
    return words.withColumn("label", strip("text")).where(F.col("label").isin(labels)).groupBy(*keys, "label").agg(
        F.min_by(F.col("top"), F.col("ord")).alias("top"))


def anchor_pairs(words: DataFrame, tmpl_words: DataFrame, page_map: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """(doc_id, page_no, template, tpage, label, page_top, tmpl_top): labels printed on both."""
    labels = labels or rules.ANCHOR_LABELS
    page = _anchor_tops(words, PAGE, labels).withColumnRenamed("top", "page_top")
    tmpl = _anchor_tops(tmpl_words, ["template", "tpage"], labels).withColumnRenamed("top", "tmpl_top")
    return page.join(page_map, PAGE).join(tmpl, ["template", "tpage", "label"]).select(
        *PAGE, "template", "tpage", "label", "page_top", "tmpl_top")


def anchor_offset(words: DataFrame, tmpl_words: DataFrame, page_map: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """page_map plus `dy`: mean offset over the common labels, 8.0 without any."""
    labels = labels or rules.ANCHOR_LABELS
    pairs = anchor_pairs(words, tmpl_words, page_map, labels)
    order = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("label"))
    # At most one value per label; summed in label order, so the last digits do not depend on the partitioning.
    per_page = pairs.groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct(
        order.alias("o"), (F.col("page_top") - F.col("tmpl_top")).alias("d")))).alias("ds"))
    mean = F.aggregate("ds", F.lit(0.0), lambda acc, x: acc + x["d"]) / F.size("ds")
    return page_map.join(per_page.select(*PAGE, mean.alias("dy")), PAGE, "left").withColumn(
        "dy", F.coalesce("dy", F.lit(geo.DEFAULT_OFFSET)))


def affine_fit(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Scale and shift per axis from anchor pairs (tx, ty -> px, py), their count and the largest error.

    Residuals need the fitted line, so the pairs are joined to it once more; every step aggregates partially.
    """
    def line(p: str, t: str, n: str):
        return [F.regr_slope(p, t).alias(f"s{n}"), F.regr_intercept(p, t).alias(f"d{n}"),
                F.avg(F.col(p) - F.col(t)).alias(f"m{n}")]

    fit = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("anchors"), *line("px", "tx", "x"), *line("py", "ty", "y"))
    fit = fit.select(*keys, "anchors", *[c for n in ("x", "y") for c in (
        F.coalesce(f"s{n}", F.lit(1.0)).alias(f"s{n}"),
        F.when(F.col(f"s{n}").isNull(), F.col(f"m{n}")).otherwise(F.col(f"d{n}")).alias(f"d{n}"))])
    err = F.greatest(F.abs(F.col("px") - (F.col("sx") * F.col("tx") + F.col("dx"))),
                     F.abs(F.col("py") - (F.col("sy") * F.col("ty") + F.col("dy"))))
    worst = pairs.join(fit, keys).groupBy(*keys).agg(F.max(err).alias("max_err"))
    return fit.join(worst, keys)


def usable_fields(tmpl_fields: DataFrame) -> DataFrame:
    """Template fields with a name and a real box."""
    degenerate = (F.col("x0") == 0) & (F.col("y0") == 1) & (F.col("x1") == 0) & (F.col("y1") == 1)
    return tmpl_fields.where((F.col("name") != "") & ~degenerate)


def _place(words: DataFrame, offsets: DataFrame) -> DataFrame:
    return words.join(offsets.select(*PAGE, "template", "tpage", "dy"), PAGE)


def box_text(words: DataFrame, tmpl_fields: DataFrame, offsets: DataFrame) -> DataFrame:
    """(doc_id, page_no, ord, name, tooltip, value): text inside each text box of the page's template."""
    px, py, extra = geo.TEXT_BOX_PAD_X, geo.TEXT_BOX_PAD_Y, geo.TEXT_BOX_EXTRA_BOTTOM
    zero = F.lit(0.0)
    boxes = usable_fields(tmpl_fields).where("ftype <> '/Btn'").select(
        "template", "tpage", F.col("ord").alias("f_ord"), "name", "tooltip", F.col("x0").alias("bx0"), F.col("y0").alias("by0"),
        F.col("x1").alias("bx1"), F.col("y1").alias("by1"),
        F.explode(geo.cells(geo.box_top(F.col("y1"), zero) - py, geo.box_bottom(F.col("y0"), zero) + extra + py, BAND)).alias("_band"))
    placed = _place(words, offsets).withColumn("_band", geo.cell(F.col("top") - F.col("dy"), BAND))
    inside = ((F.col("x0") >= F.col("bx0") - px) & (F.col("x1") <= F.col("bx1") + px) &
              (F.col("top") >= geo.box_top(F.col("by1"), F.col("dy")) - py) &
              (F.col("bottom") <= geo.box_bottom(F.col("by0"), F.col("dy")) + extra + py))
    hits = placed.join(boxes, ["template", "tpage", "_band"]).where(inside)
    return hits.groupBy(*PAGE, "f_ord", "name").agg(
        blank_to_null(strip(ordered_text())).alias("value"), F.first("tooltip").alias("tooltip")).where("value IS NOT NULL").select(
        *PAGE, F.col("f_ord").alias("ord"), "name", "tooltip", "value")


def box_marks(words: DataFrame, tmpl_fields: DataFrame, offsets: DataFrame, mode: str = "center") -> DataFrame:
    """(doc_id, page_no, ord, name, tooltip, x0..y1, checked) for every checkbox of every mapped page.

    mode 'center': the middle of an X lies in the shifted box. 'overlap' (legacy): the whole X lies in the box, padded by
    5 units on every side and 5 more at the bottom.
    """
    zero = F.lit(0.0)
    boxes = usable_fields(tmpl_fields).where("ftype = '/Btn'").select(
        "template", "tpage", F.col("ord").alias("f_ord"), "name", "tooltip", F.col("x0").alias("bx0"), F.col("y0").alias("by0"),
        F.col("x1").alias("bx1"), F.col("y1").alias("by1"))
    marks = _place(words.where(strip("text") == rules.MARK), offsets)
    top, bottom = geo.box_top(F.col("by1"), F.col("dy")), geo.box_bottom(F.col("by0"), F.col("dy"))
    if mode == "center":
        mid = (F.col("top") + F.col("bottom")) / 2.0
        cx = (F.col("x0") + F.col("x1")) / 2.0
        inside = (F.col("bx0") <= cx) & (cx <= F.col("bx1")) & (top <= mid) & (mid <= bottom)
        pad = 0.0
    else:
        mid, pad = F.col("top"), 10.0
        inside = ((F.col("x0") >= F.col("bx0") - 5) & (F.col("x1") <= F.col("bx1") + 5) & (F.col("top") >= top - 5) &
                  (F.col("bottom") <= bottom + geo.TEXT_BOX_EXTRA_BOTTOM + 5))
    banded = boxes.withColumn("_band", F.explode(geo.cells(
        geo.box_top(F.col("by1"), zero) - pad, geo.box_bottom(F.col("by0"), zero) + pad, BAND)))
    hits = marks.withColumn("_band", geo.cell(mid - F.col("dy"), BAND)).join(
        banded, ["template", "tpage", "_band"]).where(inside).select(*PAGE, "f_ord").distinct().withColumn("_hit", F.lit(True))
    every = offsets.select(*PAGE, "template", "tpage", "dy").join(boxes, ["template", "tpage"])
    return every.join(hits, [*PAGE, "f_ord"], "left").select(
        *PAGE, F.col("f_ord").alias("ord"), "name", "tooltip", "bx0", "by0", "bx1", "by1", "dy",
        F.coalesce("_hit", F.lit(False)).alias("checked"))


def combined_marks(marks: DataFrame, ratios: DataFrame | None = None, threshold: float = rules.PIXEL_THRESHOLD) -> DataFrame:
    """(doc_id, page_no, ord, name, tooltip, checked, source): an X decides, else the dark-pixel ratio.

    ratios: (doc_id, page_no, ord, ratio), needed only for boxes without an X.
    """
    if ratios is None:
        marks = marks.withColumn("ratio", F.lit(None).cast("double"))
    else:
        marks = marks.join(ratios.select(*PAGE, "ord", "ratio"), [*PAGE, "ord"], "left")
    dark = F.coalesce(F.col("ratio") > threshold, F.lit(False))
    source = (F.when(F.col("checked"), "bbox:text_x").when(dark, F.format_string("bbox:pixel:%.2f", F.col("ratio")))
              .otherwise("bbox"))
    return marks.select(*PAGE, "ord", "name", "tooltip", (F.col("checked") | dark).alias("checked"), source.alias("source"))


def page_fields(words: DataFrame, tmpl_fields: DataFrame, offsets: DataFrame, ratios: DataFrame | None = None,
                mode: str = "center", only_checked: bool = False) -> DataFrame:
    """fields(doc_id, page_no, ord, name, v_str, v_bool, ftype, tooltip, source): checkboxes with their explicit state
    (legacy `only_checked`: the true ones), text boxes where they hold text. Of boxes that share a name the last one counts."""
    checks = combined_marks(box_marks(words, tmpl_fields, offsets, mode), ratios)
    if only_checked:
        checks = checks.where("checked")
    checks = checks.select(*PAGE, "ord", "name", F.lit(None).cast("string").alias("v_str"), F.col("checked").alias("v_bool"),
                           F.lit("checkbox").alias("ftype"), "tooltip", "source")
    texts = box_text(words, tmpl_fields, offsets).select(
        *PAGE, "ord", "name", F.col("value").alias("v_str"), F.lit(None).cast("boolean").alias("v_bool"),
        F.lit("text").alias("ftype"), "tooltip", F.lit("bbox").alias("source"))
    read = checks.unionByName(texts)
    rest = [c for c in read.columns if c not in (*PAGE, "name")]
    last = read.groupBy(*PAGE, "name").agg(F.max_by(F.struct(*rest), "ord").alias("_last"))
    return last.select(*PAGE, "name", "_last.*").select(*read.columns)
