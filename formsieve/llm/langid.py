"""Language identification by rank-order n-gram profiles (out-of-place distance)."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, materialize

UNKNOWN = "und"
#: n-grams of a profile. They have one to three signs; a blank stands before and after every word.
RANKS = 400
#: Code of a blank in an n-gram; 0 is no sign at all.
BLANK = 1
#: Characters that are counted together; a longer text is cut between words and its counts are added up.
PIECE = 1 << 20
#: n-grams a training task holds before it passes on what it has counted.
HELD = 1 << 21

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point 0 (no letter) or a 16-bit code of its lower-case letter; letters past 16 bits share a block."""
    if not _LETTERS:
        table = np.zeros(0x110000, np.uint16)
        for code in range(0x110000):
            sign = chr(code)
            if sign.isalpha():
                low = sign.lower()
                point = ord(low) if len(low) == 1 else code
                table[code] = point if point < 1 << 16 else 0xE000 + point % 0x1900
        _LETTERS.append(table)
    return _LETTERS[0]


def codes_of(text: str) -> np.ndarray:
    return letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def count(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part number, n-gram, count) of several texts' codes; an n-gram is its codes, the first one lowest."""
    sizes = np.array([len(p) + 1 for p in parts])
    line = np.zeros(sizes.sum() + 1, np.uint16)
    owner = np.repeat(np.arange(len(parts), dtype=np.uint64), sizes)
    at = 1
    for part, size in zip(parts, sizes.tolist()):
        line[at:at + size - 1] = part
        at += size
    keep = np.concatenate(([True], (line[1:] != 0) | (line[:-1] != 0)))  # one blank between words
    owner, line = np.concatenate((owner[:1], owner))[keep], line[keep].astype(np.uint64)
    letter, line = line != 0, np.maximum(line, np.uint64(BLANK))
    two = line[:-1] | line[1:] << np.uint64(16)
    three = two[:-1] | line[2:] << np.uint64(32)
    # A blank may begin or end an n-gram, but not be inside one or stand alone.
    pair, inside = letter[:-1] | letter[1:], letter[1:-1]
    found = [(line[letter], owner[letter]), (two[pair], np.where(letter[1:], owner[1:], owner[:-1])[pair]), (three[inside], owner[1:-1][inside])]
    keys = np.concatenate([g | o << np.uint64(48) for g, o in found])
    keys.sort()
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    unique = keys[first]
    return (unique >> np.uint64(48)).astype(np.int64), unique & np.uint64((1 << 48) - 1), np.diff(np.concatenate((first, [len(keys)])))


def add_up(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, at = np.unique(grams, return_inverse=True)
    return unique, np.bincount(at, counts, len(unique)).astype(np.int64)


def grams_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`count` for whole texts, in groups of bounded size; a text number is its place in `texts`."""
    made, held, names, size = [], [], [], 0

    def flush() -> None:
        if held:
            owner, grams, counts = count(held)
            made.append((np.array(names, np.int64)[owner], grams, counts))
            held.clear()
            names.clear()

    for number, text in enumerate(texts):
        codes = codes_of(text or "")
        if len(codes) > PIECE:
            blanks, start, parts = np.flatnonzero(codes == 0), 0, []
            while start < len(codes):
                after = np.searchsorted(blanks, start + PIECE)
                end = int(blanks[after]) if after < len(blanks) else len(codes)
                parts.append(count([codes[start:end]])[1:])
                start = end
            grams, counts = add_up(*(np.concatenate(p) for p in zip(*parts)))
            made.append((np.full(len(grams), number), grams, counts))
            continue
        if size + len(codes) > PIECE or len(held) == 4096:
            flush()
            size = 0
        held.append(codes)
        names.append(number)
        size += len(codes)
    flush()
    if not made:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(p) for p in zip(*made))


def _tally(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts of a training task, by language."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    kept = 0

    def passed_on() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            grams, counts = add_up(*(np.concatenate(p) for p in zip(*parts)))
            yield pa.RecordBatch.from_arrays([pa.array([lang]).take(pa.array(np.zeros(len(grams), np.int32))), pa.array(grams.view(np.int64)), pa.array(counts)],
                                             names=["lang", "gram", "n"])

    for batch in stream:
        if not batch.num_rows:
            continue
        langs = np.array(batch.column(0).to_pylist(), object)
        owner, grams, counts = grams_of(batch.column(1).to_pylist())
        for lang in dict.fromkeys(langs.tolist()):
            own = (langs == lang)[owner]
            held.setdefault(lang, []).append(add_up(grams[own], counts[own]))
            if len(held[lang]) == 32:
                held[lang] = [add_up(*(np.concatenate(p) for p in zip(*held[lang])))]
        kept += len(grams)
        if kept > 8 * HELD:
            held = {lang: [add_up(*(np.concatenate(p) for p in zip(*parts)))] for lang, parts in held.items()}
            kept = sum(len(parts[0][0]) for parts in held.values())
            if kept > HELD:
                yield from passed_on()
                held, kept = {}, 0
    yield from passed_on()


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", ranks: int = RANKS) -> DataFrame:
    """(lang, gram, rank): the `ranks` most frequent n-grams of each language over all rows, ties by n-gram.

    Rows with a null language or text teach nothing.
    """
    taught = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("t"))
    counts = taught.mapInArrow(_tally, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return counts.withColumn("rank", place).where(F.col("rank") <= ranks).select("lang", "gram", F.col("rank") - 1)


class Profiles:
    """The learnt profiles as one table of ranks: n-grams by languages, `ranks` where a language lacks the n-gram."""

    def __init__(self, rows: list[tuple[str, int, int]], ranks: int) -> None:
        self.langs = sorted({r[0] for r in rows})
        self.ranks = ranks
        self.grams = np.unique(np.array([r[1] for r in rows], np.int64).view(np.uint64))
        self.places = np.full((len(self.grams) + 1, len(self.langs)), ranks, np.int32)
        column = {lang: i for i, lang in enumerate(self.langs)}
        for lang, gram, rank in rows:
            self.places[np.searchsorted(self.grams, np.uint64(gram)), column[lang]] = rank

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language with the least distance (the first by code point on a tie) and 1 - distance / largest distance."""
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        owner, grams, counts = grams_of(texts)
        if not len(owner) or not self.langs:
            return langs, scores
        order = np.lexsort((grams, -counts, owner))
        owner, grams = owner[order], grams[order]
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        rank = np.arange(len(owner)) - np.repeat(first, np.diff(np.concatenate((first, [len(owner)]))))
        owner, grams, rank = owner[rank < self.ranks], grams[rank < self.ranks], rank[rank < self.ranks]
        at = np.searchsorted(self.grams, grams)
        at[(at == len(self.grams)) | (self.grams[np.minimum(at, len(self.grams) - 1)] != grams)] = len(self.grams)
        place = self.places[at]
        away = np.where(place == self.ranks, self.ranks, np.abs(place - rank[:, None]))
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        sums, sizes = np.add.reduceat(away, first, axis=0), np.diff(np.concatenate((first, [len(owner)])))
        best = sums.argmin(axis=1)
        for text, lang in zip(owner[first].tolist(), best.tolist()):
            langs[text] = self.langs[lang]
        scores[owner[first]] = 1 - sums.min(axis=1) / (sizes * self.ranks)
        return langs, scores


def identify(docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", ranks: int = RANKS) -> DataFrame:
    """(id, lang_pred, score) for every row of `docs`, by profiles of `training`.

    Null texts and texts without a letter are `und` with score 0, as is everything if nothing was learnt. Repeated rows give
    repeated results. What goes through the driver is the profiles: `ranks` rows per language.
    """
    profiles = Profiles([tuple(r) for r in materialize(learn(training, lang_col, text_col, ranks)).collect()], ranks)
    schema = pa.schema([("id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores = profiles.predict(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(langs, pa.string()), pa.array(scores)], schema=schema)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(batches(work), "id long, lang_pred string, score double")
