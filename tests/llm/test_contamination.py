import random
import re

import pytest
from pyspark.sql import functions as F

from formsieve.llm import contamination


def brute(docs, tests, window=contamination.WINDOW, subs=contamination.SUBSTITUTIONS):
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    found = {}
    for d, text in docs:
        w = split(text)
        for item, t in tests:
            b = split(t)
            span, allowed = (window, subs) if len(b) >= window else (len(b), 0)
            if len(b) < contamination.LEAST:
                continue
            for start in range(-len(b), len(w)):
                equal = [0 <= start + k < len(w) and w[start + k] == b[k] for k in range(len(b))]
                inside = [0 <= start + k < len(w) for k in range(len(b))]
                best = max((sum(equal[q:q + span]) for q in range(len(b) - span + 1) if all(inside[q:q + span])), default=0)
                if best >= span - allowed:
                    old = found.get((d, item))
                    found[(d, item)] = (min(start, old[0]) if old else start, len(b), max(best, old[1 + 1]) if old else best)
    return found


def test_masks_are_lossless():
    assert contamination.lossless(contamination.MASKS, contamination.WINDOW, contamination.SUBSTITUTIONS)
    assert not contamination.lossless(contamination.MASKS, contamination.WINDOW - 3, contamination.SUBSTITUTIONS)


@pytest.mark.parametrize("sent", [10**6, 0])
def test_matches_brute_force(spark, monkeypatch, sent):
    monkeypatch.setattr(contamination, "SENT", sent)
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abé1") for _ in range(rng.randint(1, 2)))
    tests = [(i, " ".join(word() for _ in range(rng.choice([3, 5, 9, 14, 15, 16, 25])))) for i in range(14)] + [(90, None), (91, ""), (92, "X, y! Z; a b c"), (92, "X, y! Z; a b c")]
    docs = []
    for i in range(120):
        item = rng.choice(tests)[1] or ""
        words = item.upper().split()
        for _ in range(rng.randint(0, 4)):
            if words:
                words[rng.randrange(len(words))] = "zz"
        cut = rng.choice([0, 0, 0, 1, 4])
        docs.append((i, rng.choice([", ", "\n"]).join([word() for _ in range(rng.randint(0, 8))] + words[cut:] + [word() for _ in range(rng.randint(0, 8))])))
    docs += [(500, None), (501, ""), (502, " ".join(word() for _ in range(3000)))]
    doc_df = spark.createDataFrame([(*d, "x", 0) for d in docs], "doc_id long, text string, item string, start int")
    test_df = spark.createDataFrame([(*t, 0) for t in tests], "item_id long, text string, seed int")
    got = {(r.id, r.item): (r.start, r.length, r.matched) for r in contamination.overlaps(doc_df, test_df).collect()}
    assert got == brute(docs, tests) and len(got) > 30
    if sent:
        assert contamination.overlaps(doc_df, test_df.where(F.lit(False))).count() == 0
        assert contamination.overlaps(doc_df.where(F.lit(False)), test_df).count() == 0
        twice = doc_df.withColumn("doc_id", F.lit(None).cast("long"))
        assert contamination.overlaps(twice.unionByName(twice), test_df).count() == sum(1 for _ in contamination.overlaps(twice, test_df).collect())
