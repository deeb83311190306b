import numpy as np
from pyspark.sql import functions as F

from formsieve.llm import embeddings

SCHEMA = "vec_id long, label int, embedding array<float>, n_links int"


def brute(rows, threshold):
    n = len(rows)
    ok = [label is not None and v and None not in v and np.isfinite(v).all() and any(v) for _, label, v in rows]
    unit = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if k else None for k, (_, _, v) in zip(ok, rows)]
    near = [[j for j in range(n) if j != i and ok[i] and ok[j] and rows[i][1] == rows[j][1] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold]
            for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(near[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def near(rng, v, cosine):
    r = rng.normal(size=len(v))
    r -= (r @ v) * v / (v @ v)
    return cosine * v / np.linalg.norm(v) + np.sqrt(1 - cosine ** 2) * r / np.linalg.norm(r)


def test_rotation_keeps_length():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose((embeddings.hadamard(x) ** 2).sum(axis=1), (x ** 2).sum(axis=1))


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rng = np.random.default_rng(4)
    rows, at = [], 0
    for label in (0, 1, None):
        for _ in range(12):
            v = rng.normal(size=64)
            for _ in range(rng.integers(1, 7)):
                rows.append((at, label, near(rng, v, rng.uniform(0.985, 0.999)).tolist()))
                v = np.array(rows[-1][2]) if rng.random() < 0.5 else v
                at += 1
    center = rng.normal(size=64)
    rows += [(at + i, 1, near(rng, center, rng.uniform(0.989, 0.9999)).tolist()) for i in range(70)]
    at += 70
    rows += [(at + i, 0, rows[0][2]) for i in range(9)] + [(at + 9, 1, rows[0][2]), (at + 10, 0, (np.array(rows[0][2]) * 3).tolist()), (None, 0, rows[0][2])]
    rows += [(at + 20, 0, None), (at + 21, 0, []), (at + 22, 0, [0.0] * 64), (at + 23, 0, [float("nan")] + [1.0] * 63), (at + 24, 0, [None] + [1.0] * 63),
             (at + 25, 0, [float("inf")] + [1.0] * 63), (None, 0, None), (at + 26, 0, [1.0, 2.0]), (at + 27, 0, [1.0, 2.0]), (at + 28, 0, [2.0, 4.0, 0.0]),
             (3, 0, rows[3][2]), (at + 29, 0, [-0.0, 1.0]), (at + 30, 0, [0.0, 1.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    got = sorted(map(tuple, embeddings.near_duplicates(df).collect()), key=str)
    assert got == brute(rows, 0.98)


def test_recall_at_the_threshold():
    """Pairs right at the threshold meet in some table."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.stack([near(rng, v, 0.98) for v in x])
    for hashes in (2, 3):
        a, b = (embeddings.codes_of(v, hashes, embeddings.tables_for(hashes)) for v in (x, y))
        meet = ((a[:, :, :1] == b) | (b[:, :, :1] == a)).any(axis=(1, 2))
        assert meet.mean() > 0.999


def test_empty_table(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert embeddings.near_duplicates(spark.createDataFrame([(1, None, None, 0)], SCHEMA)).where(F.col("component") == 1).count() == 1
