"""Near-duplicate embeddings by cross-polytope hashing after fast Hadamard rotations.

A rotation is three rounds of random signs and a Walsh-Hadamard transform; its hash is the axis, with sign, that the rotated
vector lies closest to. A table joins several hashes to one code. Each vector stands in the bucket of its code and probes the
buckets that the next-best axes give (multiprobe). Pairs that meet are verified by cosine in double precision.
"""
from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, grouped, materialize
from .components import components

#: Further buckets a vector probes in each table.
PROBES = 1
#: Share of pairs at the threshold 0.98 in 64 dimensions that one more hash keeps together (measured, probes included), and
#: the share of pairs that all tables together may miss.
KEPT, MISSED = 0.816, 2e-5
#: Rows of a bucket that are compared as one block.
BLOCK = 1024
PAIRS = 1 << 17


def tables_for(hashes: int) -> int:
    return math.ceil(math.log(MISSED) / math.log(1 - KEPT ** (hashes - 1)))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row; the length is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        pairs = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(n, d)
        step *= 2
    return x / math.sqrt(d)


def codes_of(unit: np.ndarray, hashes: int, tables: int, seed: int = 5) -> np.ndarray:
    """Codes of each row as (rows, tables, 1 + PROBES): its own first, then the cheapest ones with next-best axes."""
    n, d = unit.shape
    size = 1 << max(1, (d - 1).bit_length())
    rng = np.random.default_rng(seed)
    signs = rng.choice([-1.0, 1.0], size=(tables, hashes, 3, size))
    padded = np.zeros((n, size))
    padded[:, :d] = unit
    out = np.zeros((n, tables, 1 + PROBES), np.int64)
    weights = (2 * size) ** np.arange(hashes)
    for t in range(tables):
        best, second, gap = (np.zeros((n, hashes), k) for k in (np.int64, np.int64, float))
        for h in range(hashes):
            x = padded
            for s in signs[t, h]:
                x = hadamard(x * s)
            at = np.argpartition(-np.abs(x), 1, axis=1)[:, :2]
            value = np.take_along_axis(x, at, axis=1)
            order = np.argsort(-np.abs(value), axis=1, kind="stable")
            at, value = np.take_along_axis(at, order, axis=1), np.take_along_axis(value, order, axis=1)
            axis = 2 * at + (value < 0)
            best[:, h], second[:, h], gap[:, h] = axis[:, 0], axis[:, 1], np.abs(value[:, 0]) - np.abs(value[:, 1])
        out[:, t, 0] = best @ weights
        cheap = np.argsort(gap, axis=1, kind="stable")[:, :PROBES]
        swap = (np.take_along_axis(second, cheap, axis=1) - np.take_along_axis(best, cheap, axis=1)) * weights[cheap]
        out[:, t, 1:] = out[:, t, :1] + swap
    return out


def _marked(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(id, key, lab, vec): vec as doubles; key and vec are null for a vector or label that links with nothing."""
    keys, vectors = [], []
    for label, values in zip(batch.column(1).to_pylist(), batch.column(2)):
        vector = None
        if label is not None and values.is_valid and len(values.values) and not values.values.null_count:
            vector = values.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # -0.0 is 0.0
            if not np.isfinite(vector).all() or not vector.any():
                vector = None
        vectors.append(None if vector is None else vector.tobytes())
        keys.append(None if vector is None else hashlib.blake2b(vectors[-1], digest_size=16, person=hashlib.blake2b(label.encode(), digest_size=16).digest()).digest())
    return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(keys, pa.binary()), batch.column(1), pa.array(vectors, pa.binary())],
                                      names=["id", "key", "label", "vec"])


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors; scaling by the largest entry first keeps squares in range."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors ** 2).sum(axis=1, keepdims=True))


def _coded(hashes: int, tables: int):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = batch.column(3).to_pylist()
        codes: list = [None] * len(raw)
        sizes = np.array([len(v) for v in raw])
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            unit = _scaled(np.stack([np.frombuffer(raw[i], np.float64) for i in rows]))
            for i, c in zip(rows.tolist(), codes_of(unit, hashes, tables).reshape(len(rows), -1).tolist()):
                codes[i] = c
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.list_(pa.int64()))], names=[*batch.schema.names, "codes"])
    return work


def _verified(threshold: float, tables: int):
    """Per class and cell: links found here for the first time, and the smallest class they tie it to."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("links", pa.int64())])

    def cell(part: pa.Table) -> pa.RecordBatch | None:
        column = lambda name: part.column(name).to_numpy()
        slot, n, chunk, other = (column(c) for c in ("slot", "n", "chunk", "other"))
        keys, label = part.column("key").to_pylist(), np.array(part.column("label").to_pylist(), object)
        vec, bucket = part.column("vec").to_pylist(), column("bucket")
        if len({len(v) for v in vec}) > 1:  # buckets of different lengths fell together
            return None if len(vec) < 2 else _join([cell(part.filter(pa.array([len(v) == size for v in vec]))) for size in {len(v) for v in vec}])
        codes = np.array(part.column("codes").to_pylist(), np.int64).reshape(len(keys), tables, 1 + PROBES)
        unit = _scaled(np.stack([np.frombuffer(v, np.float64) for v in vec]))
        table, place = slot // (1 + PROBES), slot % (1 + PROBES)
        left, right = np.nonzero(np.triu(unit @ unit.T >= threshold - 1e-9, 1))
        good = ((place[left] == 0) | (place[right] == 0)) & (bucket[left] == bucket[right]) & (table[left] == table[right]) & (label[left] == label[right])
        good &= (np.minimum(chunk, other)[left] == np.minimum(chunk, other)[right]) & (np.maximum(chunk, other)[left] == np.maximum(chunk, other)[right])
        good &= (chunk[left] != chunk[right]) | (chunk[left] == other[left])
        left, right = left[good], right[good]
        links, root = np.zeros(len(keys), np.int64), list(range(len(keys)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for first in range(0, len(left), PAIRS):
            i, j = left[first:first + PAIRS], right[first:first + PAIRS]
            ci, cj = codes[i], codes[j]
            forth, back = (ci[:, :, :1] == cj).any(axis=2), (cj[:, :, :1] == ci).any(axis=2)
            rows, t = np.arange(len(i)), table[i]
            # The pair counts in the first table where it meets, there in the smaller bucket if it meets in both.
            own_i, own_j = ci[rows, t, 0], cj[rows, t, 0]
            both = forth[rows, t] & back[rows, t]
            home = np.where(both, np.minimum(own_i, own_j), np.where(forth[rows, t], own_i, own_j))
            here = ((forth | back).argmax(axis=1) == t) & (home == ci[rows, t, place[i]])
            i, j = i[here], j[here]
            near = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
            i, j = i[near], j[near]
            np.add.at(links, i, n[j])
            np.add.at(links, j, n[i])
            for a, b in zip(i.tolist(), j.tolist()):
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
        hit = np.flatnonzero(links).tolist()
        if not hit:
            return None
        return pa.RecordBatch.from_arrays([pa.array([keys[i] for i in hit], pa.binary()), pa.array([keys[find(i)] for i in hit], pa.binary()), pa.array(links[hit])], schema=schema)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in grouped(stream, "cell"):
            cells = whole.column("cell").to_numpy()
            bounds = [0, *(np.flatnonzero(cells[1:] != cells[:-1]) + 1).tolist(), len(cells)]
            found = [made for a, b in zip(bounds, bounds[1:]) if b - a > 1 and (made := cell(whole.slice(a, b - a))) is not None]
            if found:
                yield _join(found)
    return run


def _join(found: list[pa.RecordBatch | None]) -> pa.RecordBatch | None:
    found = [f for f in found if f is not None]
    return pa.Table.from_batches(found).combine_chunks().to_batches()[0] if found else None


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98,
                    hashes: int | None = None) -> DataFrame:
    """(id, n_links, component): number of other vectors with the same label and a cosine of at least `threshold`, and the
    smallest id reachable by such links, itself included.

    Equal vectors of a label are one class, so that copies are counted, not paired. A bucket of any size is cut into blocks
    that are compared in pairs of blocks; links are counted and tied together there, never passed on as pairs. Hashes per
    table follow from the largest label's number of classes (about one class per bucket), the tables from the hashes.

    Null, empty and zero vectors, and those with a null or non-finite component or a null label link with nothing and are
    their own component. Vectors of different lengths do not link. A null id is the smallest of its component only if there
    is no other; repeated rows are links of one another. No rows give none. Other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("vec"))
    marked = materialize(rows.mapInArrow(batches(_marked), "id long, key binary, label string, vec binary"))
    classes = materialize(marked.where("key is not null").groupBy("key").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("vec").alias("vec")))
    most = classes.groupBy("label", F.length("vec").alias("size")).agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.struct("n", "size"))).first()[0]
    if hashes is None:
        hashes = max(2, math.ceil(math.log(most.n) / math.log(max(most.size // 4, 4)))) if most else 2
    tables = tables_for(hashes)
    coded = materialize(classes.select("key", "n", "label", "vec").mapInArrow(batches(_coded(hashes, tables)), "key binary, n long, label string, vec binary, codes array<long>"))

    placed = coded.select("key", "label", F.length("vec").alias("size"), F.posexplode("codes").alias("slot", "code"))
    table = F.floor(F.col("slot") / (1 + PROBES))
    placed = placed.select("key", "slot", F.xxhash64("label", "size", table, "code").alias("bucket"))
    counts = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.count_if(F.col("slot") % (1 + PROBES) == 0).alias("own")).where("m > 1 and own > 0")
    counts = materialize(counts.select("bucket", F.ceil(F.col("m") / BLOCK).alias("blocks")))
    alive = placed.join(counts, "bucket").select("key", "slot", "bucket", "blocks", F.pmod(F.xxhash64("key"), F.col("blocks")).alias("chunk"))
    cells = alive.select("key", "slot", "bucket", "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    cells = cells.withColumn("cell", F.xxhash64("bucket", F.least("chunk", "other"), F.greatest("chunk", "other")))
    full = cells.join(coded, "key").repartition(F.col("cell")).sortWithinPartitions("cell")
    found = materialize(full.select("cell", "key", "slot", "bucket", "chunk", "other", "n", "label", "vec", "codes")
                        .mapInArrow(_verified(threshold, tables), "a binary, b binary, links long"))

    roots = components(found.select("a", "b")).withColumnRenamed("node", "key")
    links = found.groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    placed_classes = materialize(classes.select("key", "least", "n").join(links, "key", "left").join(roots, "key", "left").select(
        "key", "least", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "key").alias("root")))
    lowest = placed_classes.groupBy("root").agg(F.min("least").alias("component"))
    of_class = materialize(placed_classes.join(lowest, "root").select("key", "n_links", "component"))
    return marked.select("id", "key").join(of_class, "key", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component")).alias("component"))
