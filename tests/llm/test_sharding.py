import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from formsieve.llm import sharding

SCHEMA = "doc_id long, text string, shard string, id int"


def spark_hash(number, seed):
    return xxhash.xxh64_intdigest((number % 2**64).to_bytes(8, "little"), seed)


def plain_shard(key, weights):
    number = int(hashlib.md5(("" if key is None else str(key)).encode()).hexdigest()[:15], 16)
    draws = [((spark_hash(s, spark_hash(number, 42)) >> 11) + 0.5) / 2**53 for s in range(len(weights))]
    return min(range(len(weights)), key=lambda s: (-math.log(draws[s]) / weights[s], s))


@pytest.fixture(scope="module")
def rows():
    made = [(i * 7 - 500, "é" * (i % 9) + "text", "x", 1) for i in range(3000)]
    return made + [(None, "no id", "x", 1)] * 40 + [(None, None, None, None), (5, None, "y", 2), (5, "", "y", 2), (5, "", "y", 2)]


def test_against_plain_rendezvous(spark, rows):
    weights = [1.0, 2.0, 0.5, 1.0, 4.0]
    got = sharding.place(spark.createDataFrame(rows, SCHEMA).repartition(5), weights, added=1.5).collect()
    assert Counter((r.id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _, _ in rows)
    by_shard = defaultdict(list)
    for r in got:
        assert r.shard == plain_shard(r.id, weights) and r.grown_shard == plain_shard(r.id, [*weights, 1.5])
        assert r.grown_shard in (r.shard, 5)
        by_shard[r.shard].append(r)
    for held in by_shard.values():
        held.sort(key=lambda r: r.slot)
        assert [r.slot for r in held] == list(range(len(held)))
        assert held == sorted(held, key=lambda r: (r.id is not None, r.id or 0, r.size, r.text_crc32, r.slot))


def test_weights_set_the_shares(spark):
    weights = [1.0, 3.0, 0.25]
    counts = Counter(r.shard for r in sharding.place(spark.range(20_000).selectExpr("id as doc_id", "'t' as text"), weights).collect())
    for s, w in enumerate(weights):
        assert abs(counts[s] / 20_000 - w / sum(weights)) < 0.015


def test_only_needed_rows_move(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    same = [1.0] * 8
    assert sharding.moves(df, same, same).count() == 0
    grown = sharding.moves(df, same, [*same, 1.0]).collect()
    assert {r.to_shard for r in grown} == {8} and 0.05 < len(grown) / len(rows) < 0.18
    left = sharding.moves(df, [*same, 1.0], same).collect()
    assert sorted(map(str, ((r.id, r.to_shard, r.from_shard) for r in left))) == sorted(map(str, ((r.id, r.from_shard, r.to_shard) for r in grown)))
    heavier = sharding.moves(df, same, [2.0, *same[1:]]).collect()
    assert {r.to_shard for r in heavier} == {0}


def test_written_shards_read_back(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, SCHEMA)
    sharding.write(df, str(tmp_path / "out"), [1.0] * 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter(map(tuple, back.select(*df.columns).collect())) == Counter(rows)
    assert all(r._shard == plain_shard(r.doc_id, [1.0] * 4) for r in back.collect())


def test_empty_table_and_bad_weights(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert sharding.place(none, [1.0, 1.0]).count() == 0 and sharding.moves(none, [1.0], [1.0, 1.0]).count() == 0
    for weights in ([], [1.0, 0.0], [float("inf")]):
        with pytest.raises(ValueError):
            sharding.place(none, weights)
