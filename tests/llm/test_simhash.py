import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from formsieve.llm import simhash


def plain_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def groups(values, radius):
    """Smallest id of each component, by comparing all pairs."""
    ids = list(range(len(values)))
    root = list(ids)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in ids:
        for j in ids[:i]:
            if bin((values[i] ^ values[j]) & (2**64 - 1)).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in ids]


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_every_pair_within_the_radius_agrees_under_some_mask(radius):
    rng = random.Random(radius)
    for _ in range(2000):
        flips = rng.sample(range(64), radius)
        assert any(not any(m >> b & 1 for b in flips) for m in simhash.masks(radius))


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "one TWO", "a b c", "Éa b c d É", "x " * 50, "a\x0bb\x0cc d e f"])
def test_fingerprint(text):
    assert simhash.fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)


def test_fingerprint_of_pieces(monkeypatch):
    rng = random.Random(5)
    text = " ".join(str(rng.randint(0, 500)) for _ in range(3000))
    want = plain_fingerprint(text)
    pieces = simhash.word_pieces
    monkeypatch.setattr(simhash, "word_pieces", lambda data: pieces(data, 40))
    assert simhash.fingerprint(text.encode()) == want


@pytest.mark.parametrize("radius", [1, 2, 3])
@pytest.mark.parametrize("bucket", [2, 64])
def test_links_connect_what_all_pairs_connect(spark, radius, bucket):
    rng = random.Random(7 + radius)
    values = {rng.getrandbits(64) - (1 << 63) for _ in range(30)}
    for v in list(values):
        for _ in range(rng.randint(0, 6)):
            for b in rng.sample(range(64), rng.randint(1, 4)):
                v = ((v ^ (1 << b)) + (1 << 63)) % (1 << 64) - (1 << 63)
            values.add(v)
    values = sorted(values)
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    edges = {(r.a, r.b) for r in simhash.links(df, radius, bucket).distinct().collect()}
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= radius for a, b in edges)
    roots = {r.node: r.root for r in simhash.components(simhash.links(df, radius, bucket)).collect()}
    assert [roots.get(v, v) for v in values] == [values[g] for g in groups(values, radius)]


def test_documents(spark):
    long = " ".join(str(i) for i in range(400))
    rows = [(9, long), (4, long), (4, long), (7, long.replace("17 ", "seventeen ", 1)), (2, None), (1, ""), (None, " "), (None, long), (5, "other words here")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, fp int")
    got = {(r.id, r.fp): r.component for r in simhash.near_duplicates(df).collect()}
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = groups(fps, 2)
    for k, (i, _) in enumerate(rows):
        same = [rows[j][0] for j in range(len(rows)) if roots[j] == roots[k] and rows[j][0] is not None]
        assert got[(i, fps[k])] == (min(same) if same else None)
    assert simhash.near_duplicates(df).count() == len(rows)
    assert simhash.near_duplicates(df.where(F.lit(False))).count() == 0
