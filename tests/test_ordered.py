"""Blocked computations against brute force, with one group that holds most rows and blocks far smaller than it."""
import random

import pytest
from pyspark.sql import functions as F

from formsieve.operators import ordered
from formsieve.operators.ordered import first_by, number_rows, running


def rows(n=4000, seed=1):
    rnd = random.Random(seed)
    return [("hot" if rnd.random() < 0.8 else f"k{rnd.randrange(20)}", i * 3, rnd.choice("abc"), rnd.randrange(100)) for i in range(n)]


def spaced(data, gap):
    return [(k, pos * gap, kind, v) for k, pos, kind, v in data]


@pytest.mark.parametrize("gap", [1, 100_000])
def test_running_against_brute_force(spark, gap):
    data = spaced(rows(), gap) + [("nulls", i, None, 1) for i in range(5)]
    df = spark.createDataFrame(data, "k string, pos bigint, kind string, v bigint").repartition(5)
    got = running(df, ["k"], "pos", sums={"s": F.col("v")}, maxes={"m": F.when(F.col("kind") == "a", F.col("pos"))}, previous={"p": F.col("kind")},
                  changes={"c": F.col("kind")}, xors={"x": F.col("v") * F.col("v")}, ranges=23)
    want = {}
    for k in {r[0] for r in data}:
        total, top, before, turns, odd = 0, None, None, 0, 0
        for n, r in enumerate(sorted((x for x in data if x[0] == k), key=lambda x: x[1])):
            total += r[3]
            top = r[1] if r[2] == "a" else top
            turns += n == 0 or r[2] != before
            odd ^= r[3] * r[3]
            want[(k, r[1])] = (total, top, before, turns, odd)
            before = r[2]
    assert {(r["k"], r["pos"]): (r["s"], r["m"], r["p"], r["c"], r["x"]) for r in got.collect()} == want


@pytest.mark.parametrize("gap", [1, 100_000])
def test_blocks_hold_equal_shares_of_a_group(spark, gap):
    """A group's summary table has a row per range, however far apart its positions are."""
    df = spark.createDataFrame(spaced(rows(), gap), "k string, pos bigint, kind string, v bigint").repartition(5)
    sizes = [r["count"] for r in ordered._blocks(df, ["k"], ["pos"], 20).where("k = 'hot'").groupBy("_b").count().collect()]
    assert 10 <= len(sizes) <= 20 and max(sizes) < 3 * sum(sizes) / len(sizes)


def test_number_rows_against_brute_force(spark):
    data = rows(seed=2)
    df = spark.createDataFrame(data, "k string, pos bigint, kind string, v bigint").repartition(5)
    want, everywhere = {}, {}
    for k in {r[0] for r in data}:
        for n, r in enumerate(sorted((x for x in data if x[0] == k), key=lambda x: (x[2], x[1])), 1):
            want[(k, r[1])] = n
    for n, r in enumerate(sorted(data, key=lambda x: (x[2], x[1])), 1):
        everywhere[r[1]] = n
    assert {(r["k"], r["pos"]): r["rn"] for r in number_rows(df, ["k"], ["kind", "pos"], ranges=16).collect()} == want
    assert {r["pos"]: r["rn"] for r in number_rows(df, [], ["kind", "pos"]).collect()} == everywhere


def test_first_by(spark):
    df = spark.createDataFrame(rows(), "k string, pos bigint, kind string, v bigint")
    got = {r["k"]: r["pos"] for r in first_by(df, ["k"], ["pos"]).collect()}
    want = {}
    for r in rows():
        want[r[0]] = min(want.get(r[0], 10**9), r[1])
    assert got == want
