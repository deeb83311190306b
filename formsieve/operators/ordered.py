"""Ordered computations that stay parallel when one group holds a large share of all rows.

A plain window puts a whole group into one task. Here rows are dealt by ranges of (group, position), so every range has
about the same number of rows however positions are spaced. What a range holds of a group is a block: a window partition of
its own, of which one summary row meets the other blocks of the group. There are as many blocks as ranges, so they grow with
the data; a group of a few rows is one block, a large one many, by the same path.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def _blocks(df: DataFrame, keys: list[str], order: list[str], ranges: int | None) -> DataFrame:
    """`df` with the range each row fell into as `_b`. It is written: a range is drawn once, whoever reads it."""
    dealt = df.repartitionByRange(*([ranges] if ranges else []), *keys, *order)
    return materialize(dealt.withColumn("_b", F.spark_partition_id()))


def running(df: DataFrame, keys: list[str], pos: str, sums: dict | None = None, maxes: dict | None = None, previous: dict | None = None,
            changes: dict | None = None, xors: dict | None = None, mins: dict | None = None, ranges: int | None = None) -> DataFrame:
    """Add, over `pos` within `keys`, running sums, maxima, minima and exclusive ors (current row included), previous-row values, and
    `changes`: how many rows so far, the first one included, differ from the row before (nulls are equal).

    `pos` is unique within `keys`; its values and gaps do not matter. `ranges` overrides the session's shuffle partitions.
    """
    sums, maxes, previous, changes, xors, mins = sums or {}, maxes or {}, previous or {}, changes or {}, xors or {}, mins or {}
    rows = _blocks(df, keys, [pos], ranges)
    inner = Window.partitionBy(*keys, "_b").orderBy(pos)
    upto = inner.rowsBetween(Window.unboundedPreceding, 0)
    boxed = {n: F.struct(e.alias("v")) for n, e in {**previous, **changes}.items()}
    marked = rows.select("*", *[b.alias(f"_v_{n}") for n, b in boxed.items()], *[F.lag(b).over(inner).alias(f"_q_{n}") for n, b in boxed.items()])
    # The first row of a block is compared with the block before, which only the summaries know.
    turned = marked.select("*", *[(F.col(f"_q_{n}").isNotNull() & ~F.col(f"_v_{n}")["v"].eqNullSafe(F.col(f"_q_{n}")["v"])).cast("long").alias(f"_c_{n}") for n in changes])
    local = turned.select(
        *df.columns, "_b", *[f"_q_{n}" for n in previous],
        *[F.sum(e).over(upto).alias(f"_l_{n}") for n, e in sums.items()], *[F.max(e).over(upto).alias(f"_x_{n}") for n, e in maxes.items()],
        *[F.bit_xor(e).over(upto).alias(f"_h_{n}") for n, e in xors.items()], *[F.min(e).over(upto).alias(f"_y_{n}") for n, e in mins.items()],
        *[F.sum(f"_c_{n}").over(upto).alias(f"_t_{n}") for n in changes])
    summary = [F.sum(e).alias(f"_s_{n}") for n, e in sums.items()] + [F.max(e).alias(f"_m_{n}") for n, e in maxes.items()]
    summary += [F.bit_xor(e).alias(f"_g_{n}") for n, e in xors.items()] + [F.min(e).alias(f"_w_{n}") for n, e in mins.items()]
    summary += [F.max_by(f"_v_{n}", pos).alias(f"_p_{n}") for n in boxed]
    summary += [c for n in changes for c in (F.min_by(f"_v_{n}", pos).alias(f"_f_{n}"), F.sum(f"_c_{n}").alias(f"_n_{n}"))]
    across = Window.partitionBy(*keys).orderBy("_b")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    met = turned.groupBy(*keys, "_b").agg(*(summary or [F.lit(0)])).select("*", *[F.lag(f"_p_{n}").over(across).alias(f"_o_{n}") for n in boxed])
    met = met.select("*", *[(F.col(f"_o_{n}").isNull() | ~F.col(f"_f_{n}")["v"].eqNullSafe(F.col(f"_o_{n}")["v"])).cast("long").alias(f"_e_{n}") for n in changes])
    blocks = met.select(
        *keys, "_b", *[F.sum(f"_s_{n}").over(before).alias(f"_s_{n}") for n in sums], *[F.max(f"_m_{n}").over(before).alias(f"_m_{n}") for n in maxes],
        *[F.bit_xor(f"_g_{n}").over(before).alias(f"_g_{n}") for n in xors], *[F.min(f"_w_{n}").over(before).alias(f"_w_{n}") for n in mins],
        *[F.col(f"_o_{n}") for n in previous],
        *[(F.coalesce(F.sum(F.col(f"_n_{n}") + F.col(f"_e_{n}")).over(before), F.lit(0)) + F.col(f"_e_{n}")).alias(f"_n_{n}") for n in changes])
    return local.join(blocks, [*keys, "_b"]).select(
        *df.columns,
        *[(F.coalesce(f"_l_{n}", F.lit(0)) + F.coalesce(f"_s_{n}", F.lit(0))).alias(n) for n in sums],
        *[F.greatest(f"_x_{n}", f"_m_{n}").alias(n) for n in maxes], *[F.least(f"_y_{n}", f"_w_{n}").alias(n) for n in mins],
        *[F.coalesce(f"_h_{n}", F.lit(0)).bitwiseXOR(F.coalesce(f"_g_{n}", F.lit(0))).alias(n) for n in xors],
        *[F.coalesce(f"_q_{n}", f"_o_{n}")["v"].alias(n) for n in previous],
        *[(F.col(f"_t_{n}") + F.col(f"_n_{n}")).alias(n) for n in changes])


def number_rows(df: DataFrame, keys: list[str], order: list[str], name: str = "rn", ranges: int | None = None) -> DataFrame:
    """1-based position of every row within `keys` by `order`, which is unique within a group. No keys: one group."""
    if not keys:
        return number_rows(df.withColumn("_all", F.lit(0)), ["_all"], order, name, ranges).drop("_all")
    rows = _blocks(df, keys, order, ranges)
    local = rows.select("*", F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(*order)).alias("_r"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*keys, "_b").count().select(*keys, "_b", F.sum("count").over(before).alias("_off"))
    return local.join(offsets, [*keys, "_b"]).select(*df.columns, (F.col("_r") + F.coalesce("_off", F.lit(0))).cast("bigint").alias(name))


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key by `order`: a partial aggregation, so a hot key shrinks before it is shuffled."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)
