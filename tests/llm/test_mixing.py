import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from formsieve.llm import mixing


def filled(sizes, weights, share, most):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: float(weights[i % len(weights)]) for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        above = {s for s in open_ if w[s] * level > most * sizes[s]}
        if not above:
            return out | {s: w[s] * level for s in open_}
        for s in above:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ -= above
    return out


def test_targets_and_words(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(int(10 ** rng.uniform(0, 2.6)))), rng.choice(["a"] * 12 + ["B", "é", "z", None, "c"])) for i in range(3000)]
    rows += [(9001, None, "a"), (9002, "", "empty"), (9003, " \n", None), (None, "one two", "z"), (5, "again\x0bhere", "B"), (5, "again\x0bhere", "B")]
    df = spark.createDataFrame([(i, t, s, 1) for i, t, s in rows], "doc_id long, text string, source string, size int")
    few, mixing.FEW = mixing.FEW, 16
    parts, mixing.PARTS = mixing.PARTS, 8
    try:
        got = mixing.mix(df.repartition(7)).collect()
        again = mixing.mix(df.repartition(3)).collect()
    finally:
        mixing.FEW, mixing.PARTS = few, parts
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    plain = sorted(map(str, mixing.mix(df).collect()))
    sizes, largest, source_of = defaultdict(int), defaultdict(int), {}
    for i, t, s in rows:
        n = len((t or "").split())
        sizes[s] += n
        largest[s] = max(largest[s], n)
        source_of[i] = s
    want = filled(sizes, (3, 1, 2), 1.5, 2)
    taken = defaultdict(int)
    for r in got:
        s = source_of[r.id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s]) and 0 <= r.taken <= 2 * r.size
        assert r.size == 0 and r.taken == 0 or r.taken % r.size == 0
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] * 1.01
    assert len(plain) == len(rows)


def test_inclusion_is_unequal_and_fixed_in_words(spark):
    rows = [(i, "w " * (4 if i % 2 else 400), s) for s in ("x", "y", "z") for i in range({"x": 0, "y": 10_000, "z": 20_000}[s], {"x": 0, "y": 10_000, "z": 20_000}[s] + 400)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(3, 1, 2)).where("id between 10000 and 10400").collect()
    short, long = ([r.taken / r.size for r in got if (r.size == 4) == k] for k in (True, False))
    assert sum(short) < sum(long)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(df).count() == 0
    df = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [(r.size, r.source_size, r.target, r.taken) for r in mixing.mix(df).collect()] == [(0, 0, 0.0, 0)] * 2
