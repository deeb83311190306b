import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from formsieve.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    """conv -> its turns, heads borrowed."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def plain_trie(paths):
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    kids = defaultdict(set)
    for node in members:
        if node:
            kids[node[:-1]].add(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(m) - 1) * (len(node[-1][1]) if node else 0)
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), len(kids[node]), leaves[node], saved[node],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(paths[c]) == len(node)))).encode()).hexdigest()) for node, m in members.items())


def result(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(*names).collect())


def built(df, **bounds):
    conv = F.col("conv")
    return trie.prefix_trie(*trie.share_heads(trie.ordered_turns(df), conv - conv % 100, F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(6)), 5), **bounds)


def conversations(seed, n):
    rng, rows = random.Random(seed), []
    for _ in range(n):
        c = rng.choice([0, 100, 200, 300]) + rng.randrange(100)
        if any(r[0] == c for r in rows):
            continue
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["Hi.", "é", "", "Ho ho."])) for t in range(rng.randint(1, 9))]
    return rows


@pytest.mark.parametrize("seed,shard", [(1, 1 << 18), (2, 5), (3, 1)])
def test_against_a_plain_trie(spark, seed, shard):
    rows = conversations(seed, 120)
    # The same talk again and again, nulls, an absent source, a source of one turn, turns with the same number.
    rows += [(1000 + c, t, "user", f"t{t}") for c in range(40) for t in range(7)] + [(2001, None, None, None), (2001, 4, "user", "x"), (2100, 0, "user", "one")]
    rows += [(2100 + c, t, "assistant", "long") for c in (7, 8, 9) for t in range(2)] + [(None, 0, "user", "nobody")] * 3
    df = spark.createDataFrame([(*r, 1, 2, 3, "n") for r in rows], SCHEMA + ", conv long, d long, rep int, size string")
    paths = rebuilt(rows)
    assert any(not p for p in paths.values())
    assert result(built(df.repartition(6), shard=shard, piece=3)) == plain_trie(paths)


def test_long_conversations_are_short_paths(spark):
    rows = [(c, t, "user", f"{t}") for c in (0, 1, 2) for t in range(250)] + [(2, 250, "user", "more"), (3, 0, "user", "0"), (3, 1, "user", "else")]
    turns = trie.ordered_turns(spark.createDataFrame(rows, SCHEMA))
    lengths = turns.groupBy("conv").agg(F.max("d").alias("length"))
    paths = defaultdict(list)
    for c, _, role, text in rows:
        paths[c].append((role, text))
    assert result(trie.prefix_trie(turns, lengths)) == plain_trie(paths)


def test_rows_of_one_turn_have_one_order(spark):
    rows = [(c, 0, "user", t) for c in (1, 2) for t in ("a", "b", "c", "b")]
    turns = trie.ordered_turns(spark.createDataFrame(rows, SCHEMA).repartition(5))
    nodes = trie.prefix_trie(turns, turns.groupBy("conv").agg(F.max("d").alias("length"))).collect()
    assert sorted((r.depth, r.n_convs) for r in nodes) == [(d, 2) for d in range(5)]


def test_empty_table(spark):
    assert built(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("block", [4, 64])
def test_parentheses_against_a_stack(monkeypatch, block):
    monkeypatch.setattr(trie, "BLOCK", block)
    rng = random.Random(block)
    for n in (1, 2, 3, 40, 700, 5000):
        for climb in (0.5, 0.9):
            bits, depth = [], 0
            while len(bits) < n or depth:
                up = depth == 0 or len(bits) < n and rng.random() < climb
                bits.append(int(up))
                depth += 1 if up else -1
            want, stack = {}, []
            for i, b in enumerate(bits):
                if b:
                    stack.append(i)
                else:
                    want[stack.pop()] = i
            opens = np.flatnonzero(bits)
            assert dict(zip(opens.tolist(), trie.Parentheses(np.array(bits)).find_close(opens).tolist())) == want
