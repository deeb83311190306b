"""Removal of long passages that repeat across documents, by level-wise doubling of the repeated windows.

Level one looks at windows of half the length. Of those inside one full window, the one with the smallest hash (leftmost on
ties) is its anchor: equal full windows have equal anchors at equal offsets, so anchors alone carry level one, and no repeat
is missed. Consecutive full windows with the same anchor form a run. Only runs whose anchor occurs in two documents survive
to the doubled length. There, runs that repeat as a whole are settled by one comparison, and what remains (the edges of
passages) is compared window by window. Hashes of the doubled level are 128 bits together with the anchor's.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, materialize, texts, word_pieces

#: Odd multipliers of the polynomial window hashes modulo 2^64.
ANCHOR_BASE, RUN_BASE, WINDOW_BASE, TEXT_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
#: Window starts of one text that are worked on together; a longer text is taken in tiles.
TILE = 1 << 20
NO_ID = (1 << 63) - 1


class Powers:
    """Powers of an odd multiplier and of its inverse modulo 2^64, grown as texts need them."""

    def __init__(self, base: int) -> None:
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def reach(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            for name, factor in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


class Rolling:
    """Hashes of any stretch of a sequence of word hashes from one prefix sum."""

    def __init__(self, words: np.ndarray, powers: Powers) -> None:
        up, self.down = powers.reach(len(words) + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up[:len(words)], dtype=np.uint64)))

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mixed((self.sums[last] - self.sums[first]) * self.down[first])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of a 64-bit value over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """For each i, the leftmost index of the smallest of values[i : i + width]."""
    best, at, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        right, right_at = best[step:], at[step:]
        best, at = best[:len(right)], at[:len(right)]
        take = right < best
        best, at = np.where(take, right, best), np.where(take, right_at, at)
        have += step
    return at


_POWERS = {base: Powers(base) for base in (ANCHOR_BASE, RUN_BASE, WINDOW_BASE, TEXT_BASE)}


def word_hashes(data: bytes) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    parts = [np.array([digest(w) for w in words], np.uint64) for words in word_pieces(data)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def runs_of(words: np.ndarray, bounds: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Runs of full windows with one anchor: (text number, first start in `words`, number of windows, anchor hash, run hash).

    `bounds` holds the ends of the texts that follow one another in `words`.
    """
    half = window // 2
    if len(words) < window:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    anchor = Rolling(words, _POWERS[ANCHOR_BASE])
    starts = np.arange(len(words) - half + 1)
    at = smallest(anchor(starts, starts + half), window - half + 1)
    begin = np.arange(len(at))
    owner = np.searchsorted(bounds, begin, side="right")
    inside = begin + window <= bounds[owner]
    begin, at, owner = begin[inside], at[inside], owner[inside]
    if not len(begin):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    new = np.concatenate(([True], (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])))
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate((first, [len(begin)])))
    start, anchors = begin[first], at[first]
    whole = Rolling(words, _POWERS[RUN_BASE])(start, start + count + window - 1)
    # Where the anchor lies in the run belongs to the run's identity, as does its length.
    whole = mixed(whole ^ (count.astype(np.uint64) << np.uint64(32)) ^ (anchors - start).astype(np.uint64))
    return owner[first], start, count, anchor(anchors, anchors + half), whole


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _scan(window: int):
    """Per document: number of words, 128-bit hash of the word sequence, SHA-256 of all words, and its runs."""
    schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("n_words", pa.int64()), ("seq", pa.int64()), ("seq2", pa.int64()), ("whole", pa.string()),
                        ("anchor", pa.list_(pa.int64())), ("run", pa.list_(pa.int64())), ("first", pa.list_(pa.int32())),
                        ("size", pa.list_(pa.int32()))])

    def rows(ids: list, keys: list, hashes: list[np.ndarray], digests: list[str]) -> pa.RecordBatch:
        lengths = np.array([len(h) for h in hashes], np.int64)
        bounds = np.cumsum(lengths)
        base = bounds - lengths
        words = np.concatenate(hashes)
        found = [np.concatenate(parts) for parts in zip(*_tiled(words, bounds, window))]
        owner, start, count, anchor, run = found
        offsets = pa.array(np.searchsorted(owner, np.arange(len(ids) + 1)), pa.int32())
        seqs = [_signed(mixed(Rolling(words, _POWERS[b])(base, bounds) ^ lengths.astype(np.uint64))) for b in (TEXT_BASE, WINDOW_BASE)]
        nested = [pa.ListArray.from_arrays(offsets, x) for x in (
            _signed(anchor), _signed(run), pa.array((start - base[owner]).astype(np.int32)), pa.array(count.astype(np.int32)))]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(lengths), *seqs, pa.array(digests), *nested], schema=schema)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, keys, hashes, digests, held = [], [], [], [], 0
        for own, key, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), texts(batch.column(1))):
            ids.append(own)
            keys.append(key)
            hashes.append(word_hashes(text or b""))
            digests.append(kept_digest(text or b"", None))
            held += len(hashes[-1])
            if held >= TILE:
                yield rows(ids, keys, hashes, digests)
                ids, keys, hashes, digests, held = [], [], [], [], 0
        if ids:
            yield rows(ids, keys, hashes, digests)
    return work


def _tiled(words: np.ndarray, bounds: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """`runs_of` over tiles of window starts. A tile's end may cut a run; its parts then are settled window by window."""
    yield runs_of(words[:0], bounds, window)
    for at in range(0, len(words), TILE):
        part = words[at:at + TILE + window - 1]
        owner, start, count, anchor, run = runs_of(part, np.clip(bounds - at, 0, len(part)), window)
        yield owner, start + at, count, anchor, run


def kept_digest(data: bytes, removed: np.ndarray | None) -> str:
    """SHA-256 of the words that are not removed, joined by one space."""
    total, position, space = hashlib.sha256(), 0, b""
    for words in word_pieces(data):
        if removed is not None:
            gone = removed[position:position + len(words)]
            position += len(words)
            words = [w for w, g in zip(words, gone.tolist()) if not g]
        if words:
            total.update(space + b" ".join(words))
            space = b" "
    return total.hexdigest()


def _windows(window: int):
    """Every full window of a document's open runs: (anchor, window hash, id, seq, start)."""
    schema = pa.schema([("anchor", pa.int64()), ("win", pa.int64()), ("id", pa.int64()), ("seq", pa.int64()), ("start", pa.int32())])

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for key, seq, runs, text in zip(*(batch.column(i).to_pylist() for i in range(3)), texts(batch.column(3))):
            hashed = Rolling(word_hashes(text or b""), _POWERS[WINDOW_BASE])
            first = np.array([r["first"] for r in runs], np.int64)
            size = np.array([r["size"] for r in runs], np.int64)
            anchor = np.repeat(np.array([r["anchor"] for r in runs], np.int64), size)
            start = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
            # The anchor's place in the window needs no extra bits: equal windows have it at the same offset.
            yield pa.RecordBatch.from_arrays([pa.array(anchor), _signed(hashed(start, start + window)), pa.array(np.full(len(start), key)),
                                              pa.array(np.full(len(start), seq)), pa.array(start.astype(np.int32))], schema=schema)
    return work


def _result(window: int):
    """Words covered by a repeated window are cut out of the text: (id, seq, n_removed, kept)."""
    schema = pa.schema([("id", pa.int64()), ("seq", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        for key, seq, runs, starts, n, text in zip(*(batch.column(i).to_pylist() for i in range(5)), texts(batch.column(5))):
            edge = np.zeros(n + 1, np.int64)
            for r in runs or ():
                edge[r["first"]] += 1
                edge[r["first"] + r["size"] + window - 1] -= 1
            if starts:
                np.add.at(edge, np.array(starts), 1)
                np.add.at(edge, np.array(starts) + window, -1)
            gone = np.cumsum(edge[:n]) > 0
            made.append((key, seq, int(gone.sum()), kept_digest(text or b"", gone)))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), schema.types)], schema=schema)
    return work


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """(id, n_words, n_removed, kept): what stays of each document when every word goes that is covered by `window`
    consecutive words which also start in a document with a smaller id. `kept` is the SHA-256 of the remaining words.

    Texts with equal words are one class: all but those with its smallest id lose everything (if they have a window at all),
    so copies never take part further. A null text has no words. Rows that share an id do not remove from each other; a null
    id counts as larger than any other and is equal to itself. Repeated rows give repeated results, no rows give none.
    """
    keyed = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).cast("string").alias("text"),
                        F.xxhash64(F.col(text_col).cast("string")).alias("key"))
    scanned = materialize(keyed.mapInArrow(
        batches(_scan(window)), "id long, key long, n_words long, seq long, seq2 long, whole string, anchor array<long>, run array<long>, first array<int>, size array<int>"))
    classes = materialize(scanned.groupBy("seq", "seq2").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")))

    shared = classes.where("n > 1").select("seq", "seq2", "least")
    firsts = scanned.where(F.size("anchor") > 0).join(shared, ["seq", "seq2"], "left").where("least is null or id = least")
    runs = firsts.select("id", "key", "seq", F.inline(F.arrays_zip("anchor", "run", "first", "size")))
    # Level one: anchors in two documents. Level two: whole runs, then single windows of what differs.
    repeated = materialize(runs.groupBy("anchor").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("anchor"))
    alive = materialize(runs.join(repeated, "anchor"))
    same = materialize(alive.groupBy("anchor", "run").agg(F.min("id").alias("least")))
    open_anchor = materialize(same.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor", F.lit(True).alias("open")))
    settled = materialize(same.join(open_anchor, "anchor", "left").select("anchor", "run", "least", "open"))
    judged = alive.join(settled, ["anchor", "run"]).where("id > least or open")
    lists = judged.groupBy("id", "key", "seq").agg(
        F.collect_set(F.when(F.col("id") > F.col("least"), F.struct("first", "size"))).alias("cut"),
        F.collect_set(F.when(F.col("id") == F.col("least"), F.struct("first", "size", "anchor"))).alias("edges"))
    held = materialize(_with_text(keyed, lists))

    windows = materialize(held.where(F.size("edges") > 0).select("id", "seq", "edges", "text").mapInArrow(
        batches(_windows(window)), "anchor long, win long, id long, seq long, start int"))
    least = materialize(windows.groupBy("anchor", "win").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
                        .select("anchor", "win", "least"))
    starts = windows.join(least, ["anchor", "win"]).where("id > least").groupBy("id", "seq").agg(F.collect_set("start").alias("starts"))
    removed = materialize(held.join(starts, ["id", "seq"], "left").where(F.size("cut").__gt__(0) | F.col("starts").isNotNull())
                          .select("id", "seq", "cut", "starts", "n_words", "text")
                          .mapInArrow(batches(_result(window)), "id long, seq long, n_removed long, kept string").distinct())

    copy = (F.col("id") > F.col("least")) & (F.col("n_words") >= window)
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return scanned.select("id", "n_words", "seq", "seq2", "whole").join(shared, ["seq", "seq2"], "left").join(removed, ["id", "seq"], "left").select(
        F.nullif("id", F.lit(NO_ID)).alias("id"), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, nothing).otherwise(F.coalesce("kept", "whole")).alias("kept"))


def _with_text(keyed: DataFrame, lists: DataFrame) -> DataFrame:
    """The texts that `lists` (id, seq, ..) speaks of; rows that share an id are told apart by the hash of
    their text, and by the word sequence should that be equal."""
    def pick(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = batch.schema.names
        seqs, right, counts = batch.column(names.index("seq")).to_pylist(), [], []
        for seq, text in zip(seqs, texts(batch.column(names.index("text")))):
            words = word_hashes(text or b"")
            n = np.array([len(words)], np.int64)
            own = mixed(Rolling(words, _POWERS[TEXT_BASE])(np.zeros(1, np.int64), n) ^ n.astype(np.uint64))
            right.append(int(own.view(np.int64)[0]) == seq)
            counts.append(len(words))
        columns = [batch.column(i) for i in range(batch.num_columns)] + [pa.array(counts, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=[*names, "n_words"]).filter(pa.array(right))

    joined = keyed.join(lists, ["id", "key"]).select("id", "seq", "cut", "edges", "text")
    kinds = "id long, seq long, cut array<struct<first:int,size:int>>, edges array<struct<first:int,size:int,anchor:long>>, text string, n_words long"
    return joined.mapInArrow(batches(pick), kinds)
