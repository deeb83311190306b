import hashlib
import itertools
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from formsieve.llm import repair

GOOD = re.compile(r"(s?(ua)+)?")
BLANK = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_faults(rows):
    seen, faults = set(), []
    for role, text in rows:
        stripped = text.rstrip(BLANK)
        faults.append("blank" if not stripped else "duplicate" if (role, text) in seen else "none" if stripped[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return faults


def plain_repair(rows):
    """Every sequence of edits up to a bound on cost, and of the cheapest the one whose letters are least."""
    faults = plain_faults(rows)
    best = (2 * len(rows), "D" * len(rows), [])

    def walk(at, cost, letters, out):
        nonlocal best
        if cost > best[0]:
            return
        initials = "".join(r[:1] or "?" for r, _ in out)
        if not re.match(r"(s?(ua)*u?)?$", initials):
            return
        if at == len(rows) and GOOD.fullmatch(initials):
            best = min(best, (cost, letters, out), key=lambda b: b[:2])
        for role in ("user", "assistant"):
            walk(at, cost + 5, letters + "I", [*out, (role, "")])
        if at == len(rows):
            return
        role, text = rows[at]
        walk(at + 1, cost + 2, letters + "D", out)
        if faults[at] in ("none", "truncated"):
            more = 5 * (faults[at] == "truncated")
            walk(at + 1, cost + more, letters + "K", [*out, (role, text)])
            for other in ("user", "assistant"):
                walk(at + 1, cost + more + 1, letters + "R", [*out, (other, text)])
    walk(0, 0, "", [])
    return best


def plain(rows):
    """What `repair` says of a conversation whose rows stand in order."""
    faults, initials = plain_faults(rows), [r[:1] for r, _ in rows]
    cost, audit, out = plain_repair(rows)
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (*[faults.count(k) for k in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest)


def result(r):
    return r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256


@pytest.mark.parametrize("n", range(5))
def test_numbers_decide_as_all_repairs_do(n):
    kinds = [("user", "a{}."), ("assistant", "b{}."), ("system", "c{}!"), ("tool", "d{}?"), ("user", "e{}"), ("assistant", "f{}"), ("user", " ")]
    cases = list(itertools.product(kinds, repeat=n))
    for case in cases if n < 4 else random.Random(4).sample(cases, 300):
        rows = [(role, text.format(i)) for i, (role, text) in enumerate(case)]
        faults = plain_faults(rows)
        codes = "".join(repair.CODES[4 * ("s", "u", "a").index(r[0]) + repair.FAULTS.index(f) if r[0] in "sua" else 12 + repair.FAULTS.index(f)]
                        for (r, _), f in zip(rows, faults))
        assert repair.cheapest(codes) == plain_repair(rows)[:2], case


def test_conversations_against_all_repairs(spark):
    rng, rows, want = random.Random(13), [], {}
    texts = ["Yes.", "No!", "cut off", "", " \n", "Why?", "Yes.\x0b", "dot. tail", "é"]
    for conv in range(60):
        said = [(t, rng.choice(["user", "assistant", "system", "User", "", "agent"]), rng.choice(texts)) for t in range(rng.randint(1, 6))]
        rows += [(conv, *r) for r in said]
        want[conv] = plain([r[1:] for r in said])
    rows += [(900, None, "user", "Q?"), (900, 7, "assistant", "A."), (900, 3, None, None), (None, 0, "user", "x."), (None, 2, "assistant", "y.")]
    want[900] = plain([("user", "Q?"), (" ", " "), ("assistant", "A.")])
    want[None] = plain([("user", "x."), ("assistant", "y.")])
    df = spark.createDataFrame([(*r, "k", 1, 2, "a", 3) for r in rows], SCHEMA + ", key string, rank int, pos int, audit string, d1 int")
    got = {r.conv: r for r in repair.repair(df.repartition(7)).collect()}
    assert {k: result(r) for k, r in got.items()} == want
    assert got[900].gaps == 3 and got[None].gaps == 1 and all(got[c].gaps == 0 for c in range(60))
    lines = {}
    for r in repair.repaired(df).orderBy("conv", "pos").collect():
        lines.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    assert all(hashlib.sha256("\n".join(lines.get(k, [])).encode()).hexdigest() == w[-1] for k, w in want.items())


def test_repeated_rows_and_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", 64)
    long = [(1, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for t in range(1500)]
    rows = long + [(1, 700, "user", "700.")] * 5 + [(2, 0, "user", "Hi.")] * 300 + [(2, 1, "assistant", "Ho.")]
    got = {r.conv: r for r in repair.repair(spark.createDataFrame(rows, SCHEMA).repartition(9)).collect()}
    text = "\n".join(f"{r}:{t}" for _, _, r, t in long)
    assert result(got[1]) == (0, 5, 0, 5, 10, "K" * 701 + "D" * 5 + "K" * 799, hashlib.sha256(text.encode()).hexdigest())
    assert (got[2].duplicate, got[2].cost, got[2].audit) == (299, 598, "K" + "D" * 299 + "K")


def test_damage(spark):
    rows = [(c, t, "assistant", "a. b! c? d") for c in range(40) for t in range(5)] + [(3, None, None, None), (None, 1, "user", "x.")]
    got = repair.damage(spark.createDataFrame(rows, SCHEMA)).groupBy("conv_id", "turn", "role", "text").count().collect()
    import zlib
    from collections import Counter
    want = Counter()
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role or " ", text or " "
        want[conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text] += {0: 0, 3: 2}.get(kind, 1)
    assert {tuple(r)[:4]: r["count"] for r in got} == {k: n for k, n in want.items() if n}


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair(none).count() == 0 and repair.repaired(none).count() == 0 and repair.damage(none).count() == 0


def test_work_of_a_long_conversation():
    rng, start = random.Random(1), time.time()
    cost, audit = repair.cheapest("".join(rng.choice(repair.CODES) for _ in range(5000)))
    assert cost <= 10_000 and time.time() - start < 20
