"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

A seed is a mask over consecutive words: the words at its marked positions are hashed, the others are ignored, so that a
replaced word at an ignored position does not hide a passage. The masks are lossless: whichever two words of a window of
`WINDOW` are replaced, some mask fits somewhere in the window and marks neither. Hits of test and training hashes give the
alignment; around it, words are compared one by one.
"""
from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Words of a passage that counts as evidence, and how many of them may be replaced.
WINDOW, SUBSTITUTIONS = 15, 2
#: Marked positions of each mask; `lossless` checks what they promise.
MASKS = (
    (0, 2, 4, 7, 8, 9, 11),
    (0, 1, 2, 4, 5, 6, 8),
)
#: A shorter test item is searched as a whole and unchanged; one with fewer words than this says nothing.
LEAST = 5
#: Test-set hashes up to this number are sent to every task (some 40 bytes each); a larger test set is shuffled.
SENT = 500_000


def lossless(masks: tuple[tuple[int, ...], ...], window: int, substitutions: int) -> bool:
    """Whether every choice of replaced words leaves a mask at some place unharmed."""
    places = [{p + m for m in mask} for mask in masks for p in range(window - max(mask))]
    return all(any(not place & set(bad) for place in places) for bad in combinations(range(window), substitutions))


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _seeds(rows: DataFrame, masks: list[tuple[int, ...]], keep: list[str]) -> DataFrame:
    """A row per place and mask: `keep`, pos, seed. Mask number and marked words make the seed; it is 0 where a mask does not
    fit. (A null there, or a filter here, would have Spark split and hash the words twice.)"""
    placed = rows.select(*keep, F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("pos"))
    both = placed.select("*", F.explode(F.array(*[F.lit(i) for i in range(len(masks))])).alias("mask"))
    seed = F.lit(0).cast("long")
    for i, mask in reversed(list(enumerate(masks))):
        fits = (F.col("mask") == i) & (F.col("pos") + max(mask) < F.size("words"))
        seed = F.when(fits, F.xxhash64(F.lit(i), *[F.get("words", F.col("pos") + m) for m in mask])).otherwise(seed)
    return both.select(*keep, "pos", seed.alias("seed"))


def overlaps(docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
             window: int = WINDOW, substitutions: int = SUBSTITUTIONS, masks: tuple[tuple[int, ...], ...] = MASKS) -> DataFrame:
    """(id, key, item, start, length, matched): one row per document and test item that share a passage.

    They share one if some `window` consecutive words of the item stand in the document with at most `substitutions` of them
    replaced; `start` is where the item would begin in the document (words from 0, the first such place), `length` the item's
    words and `matched` the most equal words of any window. An item of `LEAST` to `window` - 1 words has to be there whole
    and unchanged. `key` is the hash of the text: it tells rows with one id, or none, apart. Null and blank texts and items
    share nothing; repeated rows give one result. No rows or no items give none.
    """
    items = materialize(tests.select(F.col(item_col).cast("long").alias("item"), words_of(F.col(item_text_col)).alias("words")).where(F.size("words") >= LEAST))
    short = [r.n for r in items.where(F.size("words") < window).select(F.size("words").alias("n")).distinct().collect()]  # fewer than `window` numbers
    whole = [tuple(range(n)) for n in sorted(short)]
    n = F.size("words")
    own = _seeds(items.where(n >= window), list(masks), ["item", "words"])
    used = list(masks) + whole
    for i, mask in enumerate(whole):
        exact = F.xxhash64(F.lit(len(masks) + i), *[F.get("words", F.lit(m)) for m in mask])
        own = own.unionByName(items.where(n == len(mask)).select("item", "words", F.lit(0).alias("pos"), exact.alias("seed")))
    own = materialize(own.select("item", F.col("pos").alias("at"), "seed").where("seed <> 0").distinct())
    if own.count() <= SENT:
        own = F.broadcast(own)

    split = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("key"), words_of(F.col(text_col)).alias("words"))
    hits = _seeds(split, used, ["id", "key", "words"]).join(own, "seed")
    size = items.select("item", n.alias("length"), F.col("words").alias("item_words"))
    # All hits of one alignment leave the same words, and one task: they are one row before anything moves.
    begin = F.greatest(F.col("pos") - F.col("at"), F.lit(0))
    longest = F.lit(items.agg(F.max(n)).first()[0] or 1)
    around = hits.select("id", "key", "item", (F.col("pos") - F.col("at")).alias("start"), F.concat_ws(" ", F.slice("words", begin + 1, longest)).alias("near")).distinct()

    skipped = F.greatest(-F.col("start"), F.lit(0))
    near = around.join(size, "item").select("id", "key", "item", "start", "length", F.split("near", " ").alias("near"),
                                            F.slice("item_words", skipped + 1, F.greatest(F.col("length") - skipped, F.lit(1))).alias("wanted"))
    pairs = F.arrays_zip(F.slice("near", 1, F.size("wanted")).alias("a"), F.slice("wanted", 1, F.size("near")).alias("b"))
    equal = near.select("id", "key", "item", "start", "length", F.transform(pairs, lambda p: (p["a"] == p["b"]).cast("int")).alias("equal"))
    span = F.least(F.lit(window), F.col("length"))
    most = F.array_max(F.transform(F.sequence(F.lit(0), F.greatest(F.size("equal") - span, F.lit(0))),
                                   lambda i: F.aggregate(F.slice("equal", i + 1, span), F.lit(0), lambda a, x: a + x)))
    judged = equal.where(F.size("equal") >= span).select("id", "key", "item", "start", "length", most.alias("matched"))
    enough = F.col("matched") >= F.when(F.col("length") < window, F.col("length")).otherwise(window - substitutions)
    return judged.where(enough).groupBy("id", "key", "item").agg(F.min("start").alias("start"), F.max("length").alias("length"), F.max("matched").alias("matched"))


def remove(docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of `docs` that share no passage with a test item, with all their columns."""
    found = materialize(overlaps(docs, tests, id_col, text_col, item_col, item_text_col).select(F.col("id").alias("i"), F.col("key").alias("k")).distinct())
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("key"))
    return rows.join(found, F.col("id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k")), "left_anti").select("row.*")
