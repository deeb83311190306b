"""Shards by rendezvous hashing of record keys.

Every shard draws a number for every key, and the key goes to the shard whose draw wins: of `-ln(draw) / weight` the least,
so a shard wins in proportion to its weight. A draw depends on the key and the shard alone. A shard that is added can only
win keys for itself, and one that leaves gives up its own: nothing else moves.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import number_rows

#: Bytes that a record takes beside its text.
OVERHEAD = 16
#: Bits of a draw: as many as a double holds exactly.
BITS = 53


def _number(key: Column) -> Column:
    """60 bits of a key's MD5, once for all shards. A null key is the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def _draws(number: Column, weights: Sequence[float]) -> Column:
    """An array of (score, shard), a struct for each shard; the least one wins, the lower shard if scores are equal."""
    listed = F.array(*[F.lit(float(w)) for w in weights])

    def score(number: Column, shard: Column) -> Column:
        drawn = F.shiftrightunsigned(F.xxhash64(number, shard.cast("long")), 64 - BITS)
        return F.struct((-F.log((drawn + 0.5) / float(1 << BITS)) / F.get(listed, shard)).alias("score"), shard.alias("shard"))
    # The number is an element, not a captured column: it is worked out once for a row and not once for a shard.
    return F.transform(F.array_repeat(number, len(weights)), score)


def _checked(weights: Sequence[float]) -> Sequence[float]:
    if not weights or not all(0 < w < float("inf") for w in weights):
        raise ValueError("one positive weight for every shard")
    return weights


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard, 0 to len(weights) - 1, of a key. A null key is the empty text."""
    return F.array_min(_draws(_number(key), _checked(weights)))["shard"]


def place(docs: DataFrame, weights: Sequence[float], added: float = 1.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot, grown_shard) for every row of `docs`.

    `size` is the text in UTF-8 and `OVERHEAD` bytes; a null text has no bytes, and the crc32 of none is 0. `slot` counts a
    shard's rows from 0 without gaps by id (null first), size and crc32; rows alike in all of them take neighbouring slots.
    Rows with the same id, whatever their texts, share a shard; rows without an id too. `grown_shard` is the shard with one
    more of weight `added`. No rows give none; other columns are ignored, whatever their names. Slots are counted over
    ranges of a shard's rows, so no task holds a shard.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        _number(F.col(id_col)).alias("number"))
    drawn = sized.withColumn("draws", _draws(F.col("number"), [*_checked(weights), added]))
    won = drawn.withColumn("best", F.array_min(F.slice("draws", 1, len(weights))))
    rows = won.select("id", "size", "text_crc32", F.col("best.shard").alias("shard"),
                      F.least("best", F.element_at("draws", -1))["shard"].alias("grown_shard"))
    numbered = number_rows(rows, ["shard"], ["id", "size", "text_crc32"], "slot")
    return numbered.select("id", "size", "text_crc32", "shard", (F.col("slot") - 1).alias("slot"), "grown_shard")


def moves(docs: DataFrame, before: Sequence[float], after: Sequence[float], id_col: str = "doc_id") -> DataFrame:
    """(id, from_shard, to_shard) for the rows of `docs` that other weights send elsewhere, and for no other: what a new
    layout has to copy. Shards keep their number; one beyond the end of a list is absent from it. Nulls, repeated rows,
    empty tables and other columns as in `place`."""
    old, new = shard_of(F.col(id_col), before), shard_of(F.col(id_col), after)
    return docs.select(F.col(id_col).alias("id"), old.alias("from_shard"), new.alias("to_shard")).where("from_shard <> to_shard")


def write(docs: DataFrame, folder: str, weights: Sequence[float], id_col: str = "doc_id") -> None:
    """All rows and columns of `docs` under `folder`, in a directory `_shard=n` for each shard, by id within its files. Rows
    are dealt by ranges of (shard, id): a large shard is several files written side by side."""
    if "_shard" in docs.columns:
        raise ValueError("`_shard` names the directories")
    placed = docs.withColumn("_shard", shard_of(F.col(id_col), weights))
    placed.repartitionByRange("_shard", id_col).sortWithinPartitions("_shard", id_col).write.partitionBy("_shard").parquet(folder)
