"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct words and their beginnings, hashed. The machine adds a weight per term and, per pair of terms
that occur together, the inner product of their factors, so that a pair can count for more than its parts.
"""
from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, materialize, texts, word_pieces

#: Hash buckets, lengths of word beginnings that are terms besides the word, and words a worker remembers.
BUCKETS = 1 << 20
BEGINNINGS = (4, 5, 6)
REMEMBER = 300_000
#: Documents of each class that the machine is fitted on: the ones with the smallest hash of their id.
PER_CLASS = 8000
#: Terms that enter the machine by their association with the label, and those, the ones in most toxic documents, among
#: which pairs are looked for that say what their parts don't; about as many terms as chance may let in.
TERMS, PAIRED, CHANCE = 4096, 1024, 10
#: Rows of an update and number of updates, whatever the number of rows.
BATCH, UPDATES = 512, 640
FACTORS, RATE, SHRINK = 8, 0.02, 1e-6
_BLANKS = bytes(i if i >= 128 or chr(i).isalnum() else 32 for i in range(256))


def terms_of_word(word: bytes) -> list[int]:
    """Buckets of a word and its beginnings, which are counted in characters."""
    text = word.decode()
    parts = [b"=" + word] + [text[:n].encode() for n in BEGINNINGS if len(text) > n]
    return [xxhash.xxh64_intdigest(p, 7) & (BUCKETS - 1) for p in parts]


def words_of(text: bytes | None) -> Iterable[list[bytes]]:
    """Lower-case words of a whole text, in lists of bounded size."""
    for words in word_pieces((text or b"").translate(_BLANKS)):
        yield b" ".join(words).decode().lower().encode().split()


class Machine:
    """logit = bias + sum of weights + half of (|sum of factors|^2 - sum of |factors|^2) over the terms of a text."""

    def __init__(self, terms: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray) -> None:
        self.place = {int(t): i for i, t in enumerate(terms)}
        self.bias, self.weights, self.factors = bias, weights, factors
        self.seen: dict[bytes, tuple[int, ...]] = {}

    def known(self, word: bytes) -> tuple[int, ...]:
        found = self.seen.get(word)
        if found is None:
            if len(self.seen) >= REMEMBER:
                self.seen.clear()
            found = self.seen[word] = tuple(self.place[t] for t in terms_of_word(word) if t in self.place)
        return found

    def score(self, text: bytes | None) -> float:
        own: set[int] = set()
        for words in words_of(text):
            for word in set(words):
                if found := self.known(word):
                    own.update(found)
        logit = self.bias
        if own:
            at = np.array(sorted(own))
            v = self.factors[at]
            logit += self.weights[at].sum() + ((v.sum(axis=0) ** 2).sum() - (v ** 2).sum()) / 2
        return float(1 / (1 + np.exp(-np.clip(logit, -40, 40))))


def fit(rows: list[np.ndarray], labels: np.ndarray, n_terms: int, seed: int = 11) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and factors by Adam on the logistic loss; `rows` hold places of terms.

    Every fit takes `UPDATES` steps of `BATCH` rows (all, where there are fewer), so it goes as far on 80 rows as on 16,000;
    the bias begins at the labels' log odds. Rows are dealt anew each time all have been seen.
    """
    rng = np.random.default_rng(seed)
    size = np.array([len(r) for r in rows])
    first = np.concatenate(([0], np.cumsum(size)))
    flat = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int32)
    params = np.zeros(1 + n_terms * (1 + FACTORS))
    params[0] = np.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5))
    params[1 + n_terms:] = rng.normal(0, 0.01, n_terms * FACTORS)
    moment, square = np.zeros_like(params), np.zeros_like(params)

    def summed(values: np.ndarray, starts: np.ndarray, full: np.ndarray) -> np.ndarray:
        """Sums of the stretches that begin at `starts`; `full` tells which of them hold anything."""
        out = np.zeros((len(starts), *values.shape[1:]))
        if len(values):
            out[full] = np.add.reduceat(values, starts[full], axis=0)
        return out

    order, at = rng.permutation(len(rows)), 0
    for step in range(1, UPDATES + 1):
        if at >= len(order):
            order, at = rng.permutation(len(rows)), 0
        chosen = order[at:at + BATCH]
        at += BATCH
        n = size[chosen]
        starts = np.concatenate(([0], np.cumsum(n)[:-1]))
        terms = flat[np.arange(n.sum()) + np.repeat(first[chosen] - starts, n)]
        owner = np.repeat(np.arange(len(chosen)), n)
        by_term = np.argsort(terms, kind="stable")
        known, known_at = np.unique(terms[by_term], return_index=True)
        w, v = params[1:1 + n_terms], params[1 + n_terms:].reshape(n_terms, FACTORS)
        total = summed(v[terms], starts, n > 0)
        logit = params[0] + summed(w[terms], starts, n > 0) + ((total ** 2).sum(axis=1) - summed((v[terms] ** 2).sum(axis=1), starts, n > 0)) / 2
        error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels[chosen]) / len(chosen)
        hits, weights, factors = np.zeros(n_terms), SHRINK * w, SHRINK * v
        if len(terms):
            full = np.ones(len(known), bool)
            hits[known] = summed(error[owner[by_term]], known_at, full)
            factors[known] += summed((error[:, None] * total)[owner[by_term]], known_at, full)
        grad = np.concatenate(([error.sum()], hits + weights, (factors - hits[:, None] * v).ravel()))
        moment = 0.9 * moment + 0.1 * grad
        square = 0.999 * square + 0.001 * grad ** 2
        params -= RATE * (moment / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    return float(params[0]), params[1:1 + n_terms], params[1 + n_terms:].reshape(n_terms, FACTORS)


def likelihood_ratio(hits: np.ndarray, n: np.ndarray, all_hits: np.ndarray, all_n: np.ndarray) -> np.ndarray:
    """How much better `hits` of `n` and the rest of `all_hits` of `all_n` are told by two rates than by one: twice the
    logarithm of the likelihood ratio. Without evidence it is 0."""
    def part(k: np.ndarray, of: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.nan_to_num(np.where(k > 0, k * np.log(k / of), 0.0) + np.where(of - k > 0, (of - k) * np.log((of - k) / of), 0.0))
    return np.maximum(2 * (part(hits, n) + part(all_hits - hits, all_n - n) - part(all_hits, all_n)), 0.0)


def pair_terms(rows: list[np.ndarray], labels: np.ndarray, n_terms: int) -> np.ndarray:
    """Places of the terms of pairs that say what their parts don't: each part must change the label's rate among the texts
    that have the other one, beyond what chance does to the likeliest of all pairs."""
    there = np.zeros((len(rows), n_terms), np.float32)
    for i, row in enumerate(rows):
        there[i, row] = 1
    both, toxic = (there.T @ there).astype(np.float64), (there.T @ (there * labels[:, None].astype(np.float32))).astype(np.float64)
    n, hits = np.diag(both), np.diag(toxic)
    given = likelihood_ratio(toxic, both, hits[:, None], n[:, None])
    told = np.minimum(given, given.T) >= 2 * np.log(max(n_terms * (n_terms - 1) / 2, 1))
    np.fill_diagonal(told, False)
    return np.flatnonzero(told.any(axis=1))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS) -> Machine:
    """Fit a machine on labelled documents, at most `per_class` of each label; the bias is set back to the labels' true rate.

    Terms enter that tell the label beyond what chance does to the likeliest `CHANCE` of all terms (a likelihood ratio of
    2 log(terms / CHANCE), so the bound follows the labelled texts), and those of telling pairs (`pair_terms`). With few
    labels no term may reach that: the machine then says the rate of the label, as it does without one of the classes; without any
    label it says 0.5. Null labels teach nothing, several labels of one id count as the largest, and a repeated document
    counts as often as it stands there. Null and empty texts are texts without terms. No rows teach nothing; other columns
    are ignored. Through the driver go the terms and, of each fitted document, which of them it has.
    """
    known = materialize(labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max((F.col(label_col) > 0).cast("int")).alias("label")))
    rates = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    if not (rates.get(0) and rates.get(1)):
        only = 0.5 if not rates else float(bool(rates.get(1)))
        return Machine(np.zeros(0, np.int64), float(np.log((only + 1e-3) / (1 - only + 1e-3))), np.zeros(0), np.zeros((0, FACTORS)))
    drawn = [known.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(per_class) for k in (0, 1)]
    chosen = F.broadcast(drawn[0].unionByName(drawn[1]))  # 2 * per_class rows at most

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [sorted({t for words in words_of(text) for word in set(words) for t in terms_of_word(word)}) for text in texts(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["label", "terms"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).join(chosen, "id").select("label", "t")
    marked = materialize(rows.mapInArrow(batches(work), "label int, terms array<int>"))
    sizes = {r.label: r["count"] for r in marked.groupBy("label").count().collect()}
    ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
    if not (ones and zeros):
        return Machine(np.zeros(0, np.int64), float(np.log(rates[1] / rates[0])), np.zeros(0), np.zeros((0, FACTORS)))
    n = ones + zeros
    seen = materialize(marked.select("label", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("label").alias("a"), F.count(F.lit(1)).alias("d")).where("d > 1"))
    part = lambda k, e: F.when(k > 0, k * F.log(k / e)).otherwise(0.0)
    a, d = F.col("a"), F.col("d")
    ratio = 2 * (part(a, d * (ones / n)) + part(d - a, d * (zeros / n)) + part(ones - a, (n - d) * (ones / n)) + part(zeros - d + a, (n - d) * (zeros / n)))
    evidence = 2 * float(np.log(max(seen.count() / CHANCE, 1)))
    best = seen.withColumn("g", ratio).where(F.col("g") >= evidence).orderBy(F.desc("g"), "term").limit(TERMS)
    single = np.array(sorted(r.term for r in best.select("term").collect()), np.int64)
    common = np.array([r.term for r in seen.where("a > 1").orderBy(F.desc("a"), F.desc("d"), "term").limit(PAIRED).select("term").collect()], np.int64)
    terms = np.union1d(single, common)
    wanted = F.split(F.lit(",".join(map(str, terms.tolist()))), ",") if len(terms) else F.array()  # one literal, not thousands
    fitted = marked.select("label", F.array_intersect("terms", wanted.cast("array<int>")).alias("terms")).toArrow()
    held = fitted.column("terms").combine_chunks()
    ends, flat = held.offsets.to_numpy(), np.searchsorted(terms, held.values.to_numpy())
    places = [np.sort(flat[i:j]) for i, j in zip(ends, ends[1:])]
    marks = fitted.column("label").to_numpy().astype(float)
    place = np.full(len(terms) + 1, -1)
    place[np.searchsorted(terms, common)] = np.arange(len(common))
    paired = common[pair_terms([place[r][place[r] >= 0] for r in places], marks, len(common))]
    entering = np.union1d(single, paired)
    place[:] = -1
    place[np.searchsorted(terms, entering)] = np.arange(len(entering))
    bias, weights, factors = fit([place[r][place[r] >= 0] for r in places], marks, len(entering))
    return Machine(entering, bias + float(np.log(rates[1] / rates[0]) - np.log(ones / zeros)), weights, factors)


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row, score from 0 to 1; a null text is scored as an empty one, by the bias alone. Repeated rows
    give repeated results, a null id stays null, no rows give none; other columns are ignored, whatever their names."""
    schema = pa.schema([("id", pa.int64()), ("score", pa.float64())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([machine.score(t) for t in texts(batch.column(1))], pa.float64())], schema=schema)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(batches(work), "id long, score double")


def reject(docs: DataFrame, machine: Machine, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that score below `threshold`, with all their columns, as often as they stand there. Null and empty
    texts are scored by the bias alone, no rows give none."""
    at = docs.columns.index(text_col)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([machine.score(t) < threshold for t in texts(batch.column(at).cast(pa.string()))]))

    return docs.mapInArrow(batches(work), docs.schema)
