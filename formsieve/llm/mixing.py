"""Mixing sources to target weights by Pareto order sampling.

A source that is to give r times its words expects more than one copy of some documents. The whole part of a document's
expected copies is certain; the fraction is its inclusion probability for one copy more. Among the documents of a source,
ranked by random odds over inclusion odds (Rosen 1997), the first ones are drawn until the source's words are reached, so
the sample's size in words is fixed and inclusion is unequal: expected copies rise with the binary digits of the length.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import number_rows
from .common import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Parts a range of ranks is cut into per step, and the rows left when its ranks are compared one by one.
PARTS, FEW = 1024, 4096


def _with(rows: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
    """Join on `source`, a null source being one of its own."""
    return rows.join(other.withColumnRenamed("source", "_other"), F.col("source").eqNullSafe(F.col("_other")), how).drop("_other")


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def digits(size: Column) -> Column:
    """Binary digits of size + 1: the weight of a document's expected copies, at most 64 different values."""
    return F.length(F.bin(size + 1)).cast("double")


def targets(sources: DataFrame, weights: Sequence[float], share: float, most: int) -> DataFrame:
    """Add `target` to (source, source_size): `weights` go round by code point, nulls last; a target stops at `most` times
    its source, and what is above goes to the others by weight until none is above."""
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rn") - 1, F.lit(len(weights))) + 1).cast("int"))
    ordered = number_rows(sources.withColumn("last", F.col("source").isNull()), [], ["last", "source"], "rn")
    weighed = materialize(ordered.select("source", "source_size", cycle.alias("w"), (F.col("source_size") * float(most)).alias("top")))
    level, capped = 0.0, -1
    while True:
        above = F.col("top") < F.col("w") * F.lit(level)
        row = weighed.agg((F.sum("source_size") * share).alias("all"), F.sum(F.when(above, F.col("top"))).alias("full"),
                          F.sum(F.when(~above, F.col("w"))).alias("open"), F.count_if(above).alias("n")).first()
        if row.n == capped or not row.open:
            break
        level, capped = ((row.all or 0.0) - (row.full or 0.0)) / row.open, row.n if capped >= 0 else 0
    return weighed.select("source", "source_size", F.least("top", F.col("w") * F.lit(level)).alias("target"))


def _expected(sized: DataFrame, planned: DataFrame, most: int) -> DataFrame:
    """(source, source_size, target, scale): expected copies of a document are min(most, scale * digits)."""
    levels = sized.groupBy("source", digits(F.col("size")).alias("d")).agg(F.sum("size").alias("s")).where("s > 0")
    joined = _with(levels, planned)
    by = Window.partitionBy("source").orderBy("d")
    upto = F.sum(F.col("d") * F.col("s")).over(by.rowsBetween(Window.unboundedPreceding, 0))
    beyond = F.coalesce(F.sum("s").over(by.rowsBetween(1, Window.unboundedFollowing)), F.lit(0))
    solved = joined.withColumn("scale", (F.col("target") - most * beyond) / upto)
    # The largest digits that stay below `most` copies; the ones above get `most` in full.
    best = solved.where(F.col("scale") * F.col("d") <= most * (1 + 1e-12)).groupBy("source").agg(F.max_by("scale", "d").alias("scale"))
    return _with(planned, best, "left").select(
        "source", "source_size", "target", F.greatest(F.coalesce("scale", F.lit(0.0)), F.lit(0.0)).alias("scale"))


def _ranked(rows: DataFrame, most: int, seed: int) -> DataFrame:
    """Add certain copies and the rank (0 to 1, null without a chance) to rows that carry their source's scale."""
    copies = F.least(F.lit(float(most)), F.col("scale") * digits(F.col("size")))
    # A hair below a whole number is that number: rounding must not turn a certain copy into a draw.
    certain = F.floor(copies + 1e-9)
    chance = F.greatest(copies - certain, F.lit(0.0))
    draw = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id", "size"), 11) + 0.5) / float(1 << 53)
    odds = (draw / (1 - draw)) / (chance / (1 - chance))
    return rows.withColumn("certain", certain).withColumn("chance", chance).withColumn(
        "rank", F.when((F.col("chance") > 0) & (F.col("size") > 0), odds / (1 + odds))).drop("chance")


def plan(sized: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: int = 17) -> DataFrame:
    """(source, source_size, target, scale, cut): everything a row needs to know how often it is taken.

    `sized` has (id, source, size). `cut` is the last rank drawn, with id and size against ties. The range that holds it is
    narrowed by sums over `PARTS` parts per source until few ranks are left, so a source of any size is never ordered whole.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    planned = materialize(_expected(sized, targets(totals, weights, share, most), most))
    rows = _ranked(_with(sized, planned).select("id", "source", "size", "scale"), most, seed)
    rows = materialize(rows.select("id", "source", "size", "certain", "rank"))
    base = rows.groupBy("source").agg(F.sum(F.col("certain") * F.col("size")).alias("sure"))
    state = materialize(_with(planned, base).select(
        "source", (F.col("target") - F.col("sure")).alias("rest"), F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"), F.lit(0).cast("long").alias("before")))
    drawn = rows.where("rank is not null").select("id", "source", "size", "rank")
    for _ in range(8):
        part = F.least(F.floor((F.col("rank") - F.col("lo")) / (F.col("hi") - F.col("lo")) * PARTS), F.lit(PARTS - 1))
        inside = _with(drawn, state).where("rank >= lo and rank < hi").select(
            "source", "rest", "lo", "hi", "before", part.alias("p"), "size")
        sums = inside.groupBy("source", "rest", "lo", "hi", "before", "p").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n"))
        run = Window.partitionBy("source").orderBy("p")
        sums = sums.withColumn("upto", F.col("before") + F.sum("s").over(run)).withColumn("last", F.lead("p").over(run).isNull())
        step = (F.col("hi") - F.col("lo")) / PARTS
        found = sums.where((F.col("upto") >= F.col("rest")) | F.col("last")).groupBy("source").agg(F.min_by(F.struct(
            "rest", (F.col("lo") + F.col("p") * step).alias("lo"), F.when(F.col("p") == PARTS - 1, F.col("hi")).otherwise(F.col("lo") + (F.col("p") + 1) * step).alias("hi"),
            (F.col("upto") - F.col("s")).alias("before"), "n"), "p").alias("x")).select("source", "x.*")
        found = materialize(found)
        state = found.drop("n")
        if not found.where((F.col("n") > FEW) & (F.col("hi") - F.col("lo") > 1e-14)).limit(1).count():
            break
    near = _with(drawn, state).where("rank >= lo and rank < hi")
    units = near.groupBy("source", "rest", "before", "rank", "id", "size").agg(F.sum("size").alias("s"))
    run = Window.partitionBy("source").orderBy("rank", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    upto = units.withColumn("upto", F.col("before") + F.sum("s").over(run))
    cut = upto.where(F.col("upto") - F.col("s") / 2 <= F.col("rest")).groupBy("source").agg(F.max(F.struct("rank", "id", "size")).alias("cut"))
    edge = _with(state, cut, "left").select("source", "lo", "cut", "rest")
    return materialize(_with(planned, edge, "left").select("source", "source_size", "target", "scale", "lo", "rest", "cut"))


def copies(rows: DataFrame, planned: DataFrame, most: int = 2, seed: int = 17) -> DataFrame:
    """Add `copies` (and the plan's columns) to rows with (id, source, size) by the plan of their source."""
    ranked = _ranked(_with(rows, planned), most, seed)
    within = (F.col("rest") > 0) & ((F.col("rank") < F.col("lo")) | (F.col("cut").isNotNull() & (F.struct("rank", "id", "size") <= F.col("cut"))))
    return ranked.withColumn("copies", (F.col("certain") + F.coalesce((F.col("rank").isNotNull() & within).cast("int"), F.lit(0))).cast("long"))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"), words_in(F.col(text_col)).alias("size"), *more)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = (3, 1, 2),
        share: float = 1.5, most: int = 2, seed: int = 17) -> DataFrame:
    """(id, size, source_size, target, taken) for every row: `taken` words of whole copies, 0 to `most` of them.

    A null text has size 0 and is taken with 0 words; a null source is a source. Rows with the same id and size share their
    draw, so repeated rows are taken alike. The words a source gives miss its target by half of the largest such
    group of rows at most: half a document where no row repeats another's id and size. No rows
    give none. Other columns are ignored. Equal inputs give equal results, however they are partitioned.
    """
    sized = materialize(_sized(docs, id_col, text_col, source_col))
    rows = copies(sized, plan(sized, weights, share, most, seed), most, seed)
    return rows.select("id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def repeat(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = (3, 1, 2),
           share: float = 1.5, most: int = 2, seed: int = 17) -> DataFrame:
    """The mix itself: every row of `docs` as often as `mix` takes it, with all its columns."""
    planned = plan(materialize(_sized(docs, id_col, text_col, source_col)), weights, share, most, seed)
    rows = _sized(docs, id_col, text_col, source_col, F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    return copies(rows, planned, most, seed).select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")
