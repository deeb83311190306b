"""SimHash near-duplicates by covering locality-sensitive hashing.

Masks are structured so that any two fingerprints within the radius agree on all unmasked bits of at least one mask: every
bit position gets one of the non-zero codes of radius + 1 bits, and the mask of a code keeps the positions whose code has an
odd inner product with it. Two or fewer positions span less than the code space, so some mask ignores all of them.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, lower_ascii, materialize, texts, word_pieces
from .components import components

BITS = 64
SEED = 42
#: Fingerprints in one bucket that are still compared pair by pair; larger buckets are linked through their neighbourhoods.
BUCKET = 64
CHUNK = 1 << 16


class _Votes:
    """Set bits of shingle hashes, counted per bit position; hashes are held for a bounded time only."""

    def __init__(self) -> None:
        self.counts, self.n, self.held = np.zeros(BITS, np.int64), 0, []

    def add(self, hashes: list[int]) -> None:
        self.held.extend(hashes)
        if len(self.held) >= CHUNK:
            self.flush()

    def flush(self) -> None:
        if self.held:
            bits = np.unpackbits(np.array(self.held, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            self.counts += bits.sum(axis=0, dtype=np.int64)
            self.n += len(self.held)
            self.held = []

    def fingerprint(self) -> int:
        self.flush()
        return int(np.packbits(self.counts * 2 > self.n, bitorder="little").view("<i8")[0])


def fingerprint(text: bytes | None, width: int = 3, seed: int = SEED) -> int:
    """Signed 64-bit SimHash of the XXH64 values of `width`-word shingles, repeats included; 0 for no word."""
    votes, tail, shingles = _Votes(), [], 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for words in word_pieces(lower_ascii(text or b"")):
        words = tail + words
        if len(words) >= width:
            line = join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate(([0], ends[:-1])).tolist()
            stops = (ends[width - 1:] - 1).tolist()
            votes.add([digest(line[a:b], seed) for a, b in zip(starts, stops)])
            shingles += len(stops)
            tail = words[len(words) - width + 1:]
        else:
            tail = words
    if not shingles and tail:
        votes.add([digest(join(tail), seed)])
    return votes.fingerprint()


def fingerprint_of(hashes: np.ndarray) -> int:
    """Signed 64-bit SimHash of shingle hashes that are known already."""
    votes = _Votes()
    for at in range(0, len(hashes), CHUNK):
        votes.add(hashes[at:at + CHUNK].tolist())
    return votes.fingerprint()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, key, fp): one row per input row, `key` being the hash of its text. A null or blank text has fingerprint 0."""
    schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("fp", pa.int64())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [fingerprint(t, width) for t in texts(batch.column(2))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("key"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(batches(work), "id long, key long, fp long")


def masks(radius: int, bits: int = BITS) -> list[int]:
    """The 2^(radius+1) - 1 covering masks as signed integers."""
    codes = 2 ** (radius + 1) - 1
    found = []
    for vector in range(1, codes + 1):
        mask = sum(1 << i for i in range(bits) if bin((1 + i % codes) & vector).count("1") % 2)
        found.append(mask - (1 << bits) if mask >> (bits - 1) else mask)
    return found


def links(distinct: DataFrame, radius: int = 2, bucket: int = BUCKET) -> DataFrame:
    """(a, b) edges between distinct fingerprints `fp`, which connect exactly the pairs with at most `radius` differing bits.

    A bucket of up to `bucket` members is compared pair by pair: that gives each of its links. Larger ones (possible when
    many texts are nearly alike) are linked in linear work: two fingerprints are within 2r bits if and only if they share a
    point within r bits of both, so every member names the points within radius / 2 and joins the smallest member there.
    For an odd radius, the far end of a pair names the points one bit further out. The edges then form the same components.
    """
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for t, m in enumerate(masks(radius))])
    keyed = materialize(distinct.select("fp", F.inline(tables).alias("t", "k")))
    sizes = materialize(keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    small = keyed.join(sizes.where(F.col("n") <= bucket).select("t", "k"), ["t", "k"])
    other = keyed.select("t", "k", F.col("fp").alias("other"))
    pairs = small.join(other, ["t", "k"]).where((F.col("fp") < F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= radius)) \
        .select(F.col("fp").alias("a"), F.col("other").alias("b"))
    crowded = keyed.join(sizes.where(F.col("n") > bucket).select("t", "k"), ["t", "k"]).select("fp").distinct()
    return pairs.unionByName(_near_points(crowded, radius))


def _near_points(distinct: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) of `links` by shared points: members within the inner radius of a point join its smallest one."""
    inner, outer = radius // 2, radius - radius // 2

    def named(reach: int) -> DataFrame:
        points = distinct.select("fp", F.col("fp").alias("point"), F.lit(-1).alias("last"))
        layers = [points]
        for _ in range(reach):
            flips = F.filter(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(1 << i if i < 63 else -(1 << 63)).alias("m")) for i in range(BITS)]),
                             lambda f: f["i"] > F.col("last"))
            points = points.select("fp", "point", F.inline(flips).alias("i", "m")).select(
                "fp", F.col("point").bitwiseXOR(F.col("m")).alias("point"), F.col("i").alias("last"))
            layers.append(points)
        found = layers[0]
        for layer in layers[1:]:
            found = found.unionByName(layer)
        return found.select("fp", "point")

    near = materialize(named(inner))
    low = materialize(near.groupBy("point").agg(F.min("fp").alias("low"), F.count(F.lit(1)).alias("n")))
    stars = near.join(low.where("n > 1").select("point", "low"), "point").where("fp <> low").select(F.col("low").alias("a"), F.col("fp").alias("b"))
    if outer == inner:
        return stars
    far = named(outer).join(low.select("point", "low"), "point").where("fp <> low").select(F.col("low").alias("a"), F.col("fp").alias("b"))
    return stars.unionByName(far)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2, width: int = 3) -> DataFrame:
    """(id, key, fp, root, component): component is the smallest id reachable by links of at most `radius` differing bits,
    itself included; root names the component also where no row has an id, and key is the hash of the text.

    Links hold between fingerprints, so equal ones are one node and copies are never paired. Repeated ids stay rows of their
    own; a null id never is the smallest unless its component has no other id. No rows give none. Other columns are ignored.
    """
    marked = materialize(fingerprints(docs, id_col, text_col, width))
    classes = materialize(marked.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(classes.select("fp"), radius)).withColumnRenamed("node", "fp")
    placed = materialize(classes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    lowest = placed.groupBy("root").agg(F.min("least").alias("component"))
    of_class = materialize(placed.join(lowest, "root").select("fp", "root", "component"))
    return marked.join(of_class, "fp").select("id", "key", "fp", "root", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2, width: int = 3) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each component the row with the smallest id stays (without ids, that
    with the smallest text hash), and one of rows that repeat it. Columns are kept as they are."""
    return keep_first(docs, near_duplicates(docs, id_col, text_col, radius, width), id_col, text_col)


def keep_first(docs: DataFrame, grouped: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of `docs` that `keep_one` leaves of the groups (id, key, root)."""
    chosen = grouped.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("first"))
    chosen = materialize(chosen.select(F.col("first")["id"].alias("i"), F.col("first")["key"].alias("k")))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("key"))
    kept = rows.join(chosen, F.col("id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k")), "left_semi")
    again = F.row_number().over(Window.partitionBy("id", "key").orderBy("key"))
    return kept.withColumn("again", again).where("again = 1").select("row.*")
