"""Near-duplicates by the Jaccard similarity of word shingles: candidates by SimHash fingerprints of the shingles, then by
min-wise keys for what the fingerprints' radius does not reach, every link verified on the sets.

A pair of similarity s agrees in one key of `ROWS` minima with probability s^ROWS, so it has no key in common with
probability (1 - s^ROWS)^KEYS: 0.00006 at 0.8, 0.000001 at 0.85. SimHash alone does not reach that far: at 0.8 about 15 % of the
bits differ, and keys long enough to tell texts apart would take hundreds of tables. It ties close copies together.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, lower_ascii, materialize, texts, word_pieces
from .components import components
from .simhash import CHUNK, SEED, fingerprint_of, keep_first
from .simhash import links as fingerprint_links

KEYS, ROWS = 32, 6
#: Differing bits up to which fingerprints make candidates, and how many members in turn a bucket is compared with.
RADIUS, LEADERS = 2, 2
#: Shingles that meet all multipliers at once, and rows of (id, hash, hash) that may be broadcast.
BLOCK, SENT = 2048, 500_000
_rng = np.random.default_rng(SEED)
_FACTORS = _rng.integers(0, 1 << 63, KEYS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _rng.integers(0, 1 << 63, (KEYS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: bytes | None, width: int = 5, seed: int = SEED) -> np.ndarray:
    """Sorted distinct XXH64 values of the `width`-word shingles, ASCII letters lowered; a shorter text is one shingle, a
    blank one has none."""
    done, held, tail, shingles = [], [], [], 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for words in word_pieces(lower_ascii(text or b"")):
        words = tail + words
        if len(words) >= width:
            line = join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate(([0], ends[:-1])).tolist()
            stops = (ends[width - 1:] - 1).tolist()
            held.extend([digest(line[a:b], seed) for a, b in zip(starts, stops)])
            shingles += len(stops)
            tail = words[len(words) - width + 1:] if width > 1 else []
            if len(held) >= CHUNK:
                done, held = [np.unique(np.concatenate([*done, np.array(held, np.uint64)]))], []
        else:
            tail = words
    if not shingles and tail:
        held.append(digest(join(tail), seed))
    return np.unique(np.concatenate([*done, np.array(held, np.uint64)]))


def min_keys(shingles: np.ndarray) -> list[int] | None:
    """The `KEYS` keys of a set as signed integers; none for the empty set."""
    if not len(shingles):
        return None
    low = np.full(KEYS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), BLOCK):
        np.minimum(low, np.multiply.outer(_FACTORS, shingles[at:at + BLOCK]).min(axis=1), out=low)
    mixed = ((low.reshape(KEYS, ROWS) ^ (low.reshape(KEYS, ROWS) >> np.uint64(29))) * _MIX).sum(axis=1, dtype=np.uint64)
    return mixed.view(np.int64).tolist()


def _marked(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, key, node, size, fp, keys): `key` hashes the text, `node` its set of shingles, `fp` is the SimHash of these."""
    schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("node", pa.int64()), ("size", pa.int64()), ("fp", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingle_set(t, width) for t in texts(batch.column(2))]
        nodes = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in found], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nodes), pa.array([len(s) for s in found], pa.int64()),
                                           pa.array([fingerprint_of(s) for s in found], pa.int64()), pa.array([min_keys(s) for s in found], schema.field("keys").type)], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("key"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(batches(work), "id long, key long, node long, size long, fp long, keys array<long>")


def _sets(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(node, shingles binary) of the nodes of `chosen` (node, i, k), each from one of the rows that have it."""
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingle_set(t, width).tobytes() for t in texts(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("key"), F.col(text_col).cast("string").alias("t"))
    # Few enough of them are sent to the texts, else the texts are dealt; the rows are the same.
    chosen = F.broadcast(chosen) if chosen.limit(SENT + 1).count() <= SENT else chosen
    rows = rows.join(chosen, F.col("id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k"))).select("node", "t").dropDuplicates(["node"])
    return rows.mapInArrow(batches(work), "node long, shingles binary")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose sets have at least the similarity `threshold`."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = np.concatenate([x, y])
            both.sort(kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            keep.append(common + 1e-9 >= threshold * (len(both) - common))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=schema).filter(pa.array(keep, pa.bool_()))

    one, two = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(batches(work), "a long, b long")


def _exploded(sets: DataFrame) -> DataFrame:
    """(node, shingle) of all sets."""
    schema = pa.schema([("node", pa.int64()), ("shingle", pa.int64())])

    def work(batch: pa.RecordBatch):
        nodes, held, n = [], [], 0
        for at, (node, value) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
            held.append(np.frombuffer(value.as_buffer(), np.int64))
            nodes.append(np.full(len(held[-1]), node, np.int64))
            n += len(held[-1])
            if n >= CHUNK or at + 1 == batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(held))], schema=schema)
                nodes, held, n = [], [], 0

    return sets.select("node", "shingles").mapInArrow(batches(work), "node long, shingle long")


def _prefix_pairs(placed: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b): pairs of `placed` (node, size, root) with different roots, among them all whose sets have the similarity
    `threshold`, by prefix filter.

    A set's shingles are put in order by the number of sets that hold them, the rarest first. Two sets with that similarity
    have so much in common that the first one they share is among the first `size - ceil(threshold * size) + 1` of either; what
    many texts hold comes last and pairs nothing. A shared shingle that stands so far back that the rest of the shorter set
    cannot reach the threshold is no candidate either. What no other set holds is only counted.
    """
    t = F.lit(threshold)
    shingles = materialize(_exploded(sets.join(placed.select("node"), "node", "left_semi")))
    held = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = shingles.join(held, "shingle")
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("n"), "shingle"))
    # Counted from the end, so that the shingles of one set alone need not be there.
    ranked = shared.withColumn("behind", rank - 1).join(placed, "node")
    prefix = materialize(ranked.where(F.col("behind") >= F.ceil(t * F.col("size") - 1e-9) - 1).select("shingle", "node", "size", "root", "behind"))
    x, y = prefix.alias("x"), prefix.alias("y")
    least = t / (1 + t) * (F.col("x.size") + F.col("y.size")) - 1e-9
    near = (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root")) & (F.least("x.behind", "y.behind") + 1 >= least)
    return x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & near).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _alike(nodes: DataFrame) -> DataFrame:
    """(a, b): candidates among `nodes` (node, fp) by SimHash. Of the nodes with one fingerprint each meets the least; those of
    fingerprints within the radius meet by covering masks."""
    least = materialize(nodes.groupBy("fp").agg(F.min("node").alias("lead"), F.count(F.lit(1)).alias("n")))
    same = nodes.join(least.where("n > 1"), "fp").where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b"))
    end = lambda c: least.select(F.col("fp").alias(c), F.col("lead").alias(f"{c}_lead"))
    near = fingerprint_links(least.select("fp"), RADIUS).join(end("a"), "a").join(end("b"), "b").select(F.col("a_lead").alias("a"), F.col("b_lead").alias("b"))
    return same.unionByName(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _mixed(members: DataFrame, links: DataFrame) -> DataFrame:
    """(t, k, node, size, root) of the members of buckets that hold more than one component of `links`."""
    placed = members.join(materialize(components(links)), "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = placed.groupBy("t", "k").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("t", "k")
    return materialize(placed.join(several, ["t", "k"], "left_semi"))


def near_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: float = 0.8) -> DataFrame:
    """(id, key, root): root is the same for rows tied by links of at least `threshold` Jaccard similarity of their shingles;
    key hashes the text. Texts of one set of shingles are one node, so copies are never paired.

    Nodes with equal or near SimHash fingerprints are compared first. The members of a min-wise bucket that still holds more
    than one component are compared with one of them, then with another, `LEADERS` times: that ties most of a large group
    together in linear work. The texts of buckets that hold more than one component after that are joined by
    `_prefix_pairs`, and all pairs it finds are compared.

    A null or blank text has no shingle and no key: all of them are one node, as texts with one set are. A null id, repeated
    rows and ids, and other columns of any name are carried along or ignored; no rows give none.
    """
    marked = materialize(_marked(docs, id_col, text_col, width))
    nodes = materialize(marked.groupBy("node").agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("first"), F.min("size").alias("size"),
                                                   F.any_value("fp").alias("fp"), F.any_value("keys").alias("keys")))
    keyed = nodes.select("node", "size", F.posexplode("keys").alias("t", "k"))
    shared = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = materialize(keyed.join(shared, ["t", "k"], "left_semi"))
    alike = materialize(_alike(nodes.where("size > 0").select("node", "fp")))
    ends = alike.select(F.explode(F.array("a", "b")).alias("node"))
    chosen = nodes.join(members.select("node").unionByName(ends).distinct(), "node", "left_semi")
    chosen = materialize(chosen.select("node", F.col("first")["id"].alias("i"), F.col("first")["key"].alias("k")))
    sets = materialize(_sets(docs, chosen, id_col, text_col, width))

    links = materialize(_verified(alike, sets, threshold))
    close = F.least("size", "l.size") + 1e-9 >= F.lit(threshold) * F.greatest("size", "l.size")
    placed = _mixed(members, links)
    for turn in range(LEADERS):
        # The turn's hash draws the leader, the same one for buckets that share members.
        leads = placed.groupBy("t", "k").agg(F.min_by(F.struct("node", "size", "root"), F.xxhash64("node", F.lit(turn))).alias("l"))
        first = placed.join(leads, ["t", "k"]).where((F.col("root") != F.col("l.root")) & close)
        pairs = materialize(first.select(F.least("node", "l.node").alias("a"), F.greatest("node", "l.node").alias("b")).distinct())
        links = materialize(links.unionByName(_verified(pairs, sets, threshold)))
        placed = _mixed(placed.drop("root"), links)
    placed = materialize(placed.select("node", "size", "root").distinct())
    open_pairs = materialize(_prefix_pairs(placed, sets, threshold))
    more = materialize(_verified(open_pairs.join(links, ["a", "b"], "left_anti"), sets, threshold))

    roots = materialize(components(links.unionByName(more)))
    return marked.select("id", "key", "node").join(roots, "node", "left").select("id", "key", F.coalesce("root", "node").alias("root"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of `docs` without near-duplicates, chosen as `simhash.keep_one` does."""
    return keep_first(docs, near_texts(docs, id_col, text_col, width, threshold), id_col, text_col)
