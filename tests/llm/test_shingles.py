import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from formsieve.llm import shingles


def plain_set(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def least_ids(docs, threshold=0.8):
    """Smallest id of each group of (id, text), by comparing all pairs."""
    sets = [plain_set(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= threshold:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted(least.values())


def edited_copies():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    docs = []
    for _ in range(40):
        base = [word() for _ in range(rng.randint(60, 300))]
        docs.append(base)
        for _ in range(rng.randint(0, 8)):
            copy = list(base)
            for _ in range(rng.randint(1, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = word()
            docs.append(copy)
    base = [word() for _ in range(150)]
    for _ in range(150):  # one large group whose members are near some of the others only
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = word()
        docs.append(copy)
    docs = [" ".join(d) for d in docs] + ["one two three", "One  two THREE", "one two four", None, "", " "]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("text", [None, " \n", "One", "a b c d", "a b c d e", "É b C d e f a b c d e", "x " * 30])
def test_shingle_set(text):
    assert len(shingles.shingle_set(None if text is None else text.encode())) == len(plain_set(text))


def test_shingle_set_of_pieces(monkeypatch):
    text = " ".join(str(i % 700) for i in range(3000)).encode()
    want = shingles.shingle_set(text).tolist()
    pieces = shingles.word_pieces
    monkeypatch.setattr(shingles, "word_pieces", lambda data: pieces(data, 40))
    monkeypatch.setattr(shingles, "CHUNK", 100)
    assert shingles.shingle_set(text).tolist() == want


def test_stage_drops_edited_copies(spark):
    docs = edited_copies()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    kept = corpus_pipeline.drop_near_duplicates(spark, df, "")
    assert sorted(r.doc_id for r in kept.collect()) == least_ids(docs)
    assert corpus_pipeline.drop_near_duplicates(spark, df.where(F.lit(False)), "").count() == 0


def test_large_group_is_not_compared_pair_by_pair(spark, monkeypatch):
    """Copies that are edited too much to be near any other share keys with all of them."""
    rng = random.Random(8)
    base = [str(rng.randint(0, 10**6)) for _ in range(150)]
    docs = []
    for i in range(300):
        copy = list(base)
        for at in rng.sample(range(0, 150, 6), i % 8):
            copy[at] = f"w{rng.randint(0, 10**9)}"
        docs.append((i, " ".join(copy)))
    compared, verified = [], shingles._verified

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return verified(pairs, *rest)
    monkeypatch.setattr(shingles, "_verified", counted)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(r.doc_id for r in shingles.keep_one(df).collect()) == least_ids(docs)
    assert sum(compared) < 300 * 299 / 2 / 4


def test_fingerprints_tie_close_copies_by_themselves(spark, monkeypatch):
    """Without a bucket that is mixed, SimHash is all that makes candidates."""
    rng = random.Random(5)
    docs = []
    for i in range(12):
        base = [str(rng.randint(0, 10**6)) for _ in range(1500)]
        docs.append((2 * i, " ".join(base)))
        base[-1] = "other"
        docs.append((2 * i + 1, " ".join(base)))
    mixed = shingles._mixed
    monkeypatch.setattr(shingles, "_mixed", lambda *a: mixed(*a).where(F.lit(False)))
    kept = {r.doc_id for r in shingles.keep_one(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert kept >= set(range(0, 24, 2)) and len(kept) <= 14
