"""Rows that lie next to each other and share a key, as one row of lists.

A shuffle writes every row with its key, its null bits and a word per column, and rows of one page repeat most of their texts.
Packed, a page's rows go as one, column after column, which takes a fraction of the bytes. A key found in several places
has several packs; nothing has to be gathered first.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE = ["doc_id", "page_no"]
# Rows of a pack at most.
PACK_ROWS = 1_000


def changes(rows: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Whether the key changes from each row to the next one."""
    found = np.zeros(max(len(rows) - 1, 0), bool)
    for column in (rows.column(k) for k in keys):
        empty = column.is_null().to_numpy(zero_copy_only=False)
        other = pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, len(found))), True).to_numpy(zero_copy_only=False)
        found |= other & ~(empty[1:] & empty[:-1])
    return found


def _pack_batches(keys: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            first = np.union1d(np.flatnonzero(changes(batch, keys)) + 1, np.arange(0, len(batch), PACK_ROWS))
            ends, take = pa.array(np.append(first, len(batch)), pa.int32()), pa.array(first)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(take) if c in keys else pa.ListArray.from_arrays(ends, batch.column(c))
                                              for c in batch.schema.names], names=batch.schema.names)
    return run


def packed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, one list per other column): neighbouring rows of one key."""
    schema = ", ".join(f"`{c}` {t}" if c in keys else f"`{c}` array<{t}>" for c, t in rows.dtypes)
    return rows.mapInArrow(_pack_batches(keys), schema)


def unpacked(packs: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The rows of packs: keys, and those of `columns` that are lists."""
    return packs.select(*keys, F.inline(F.arrays_zip(*[F.col(c) for c in columns if c not in keys])))


def keyed(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Keys and columns of the rows. A key that is the same literal in every row would be folded out of a join, which would then deal
    by the other key alone, and the next step would deal all rows once more; a key out of a list stays."""
    return rows.select(*columns, F.inline(F.array(F.struct(*keys)))).select(*keys, *columns)
