"""What the operators of this subpackage share: sessions, folders on shared storage, words of whole texts, row streams."""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, run_folder, tune

#: Rows of one Arrow batch: texts are long, and a Python worker holds a batch as a whole.
BATCH_ROWS = "512"
PIECE = 1 << 20
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

def prepare(spark: SparkSession) -> SparkSession:
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def folder_for(spark: SparkSession, name: str) -> str:
    """A new folder on the shared storage, named once per run of an operator."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def local_path(uri: str) -> tuple[fs.FileSystem, str]:
    """Any shared storage that pyarrow opens (a mounted path, hdfs, s3, gs), from the name Spark uses for it."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def crc_remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def lower_ascii(data: bytes) -> bytes:
    """A-Z to a-z, every other byte as it is."""
    return data.translate(LOWER)


def word_pieces(data: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """Words between runs of the bytes 09-0D and 20, in lists that each cover about `size` bytes: a text of any length is
    never split into words as a whole."""
    if len(data) <= size:
        yield data.split()
        return
    start = 0
    while start < len(data):
        end = min(start + size, len(data))
        while end < len(data) and data[end] != 32 and not 9 <= data[end] <= 13:
            end += 1
        yield data[start:end].split()
        start = end


def batches(work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch | None]):
    """A function for mapInArrow that treats each non-empty batch by itself."""
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            if batch.num_rows:
                made = work(batch)
                if isinstance(made, pa.RecordBatch):
                    yield made
                elif made is not None:
                    yield from made
    return run


def texts(column: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of a string column, row by row."""
    binary = column.cast(pa.large_binary())
    for value in binary:
        yield value.as_py()


def grouped(stream: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole key groups from batches that are sorted by `key`: every group is complete, several come together."""
    held: list[pa.RecordBatch] = []
    for batch in stream:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        if held and held[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        changes = np.flatnonzero(keys[1:] != keys[:-1])
        if len(changes):
            cut = int(changes[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)
