import hashlib
import random
import re

import pytest

from formsieve.llm import substring

SCHEMA = "doc_id long, text string, id string, n int"


def brute(rows, window):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    key = lambda i: float("inf") if i is None else i
    for i, words in split:
        for at in range(len(words) - window + 1):
            w = tuple(words[at:at + window])
            least[w] = min(least.get(w, float("inf")), key(i))
    out = []
    for i, words in split:
        gone = set()
        for at in range(len(words) - window + 1):
            if least[tuple(words[at:at + window])] < key(i):
                gone.update(range(at, at + window))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out.append((i, len(words), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, window):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    return sorted(map(tuple, substring.deduplicate(df, window=window).collect()), key=str)


@pytest.mark.parametrize("window", [4, 5, 10])
def test_matches_brute_force(spark, window, monkeypatch):
    rng = random.Random(window)
    vocab = ["a", "bb", "é", "D", "d"]
    passages = [" ".join(rng.choice(vocab) for _ in range(rng.randint(3, 40))) for _ in range(12)]
    rows = []
    for i in range(120):
        text = rng.choice(["", " ", "\n"]).join(rng.choice([rng.choice(passages), " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 9))), " "])
                                               + rng.choice([" ", "\t", "\x0b"]) for _ in range(rng.randint(0, 6)))
        rows.append((i, text))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (3, rows[3][1]), (7, "a a a a a a a a a a a a a a"), (300, "a " * 40), (301, "a " * 60),
             (None, rows[5][1]), (None, None), (302, None), (303, ""), (5, "a bb é D d " * 5)]
    assert run(spark, rows, window) == brute(rows, window)


def test_tiles_of_long_texts_change_nothing(spark):
    rng = random.Random(1)
    words = [str(rng.randint(0, 9999)) for _ in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join(words[50:350])), (3, " ".join(words[:120] + ["x"] + words[120:]))]
    tile, substring.TILE = substring.TILE, 64
    try:
        hashes = substring.word_hashes(rows[0][1].encode())
        parts = list(substring._tiled(hashes, substring.np.array([len(hashes)]), 50))
        assert sum(int(p[2].sum()) for p in parts) == 400 - 49
    finally:
        substring.TILE = tile
    assert run(spark, rows, 50) == brute(rows, 50)


def test_empty_table(spark):
    assert run(spark, [], 50) == []


def test_rows_without_an_id_meet_their_own_text_only(spark, monkeypatch):
    """400 rows that share the null id and a passage."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(None, f"{passage} {' '.join(f'r{n}x{i}' for i in range(20))}") for n in range(400)] + [(1, passage + " end")]
    met, text_of = [], substring._with_text

    def counted(keyed, lists):
        met.append(keyed.join(lists, ["id", "key"]).count())
        return text_of(keyed, lists)
    monkeypatch.setattr(substring, "_with_text", counted)
    got = substring.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.id is None, r.n_removed) for r in got.collect()) == [(False, 0)] + [(True, 60)] * 400
    assert met[0] <= 401
