import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from formsieve.llm import tokens

from .test_contamination import brute as brute_contamination
from .test_shingles import least_ids

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with planted toxic words, near copies and test passages."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    items = [(i, " ".join(word() for _ in range(rng.randint(15, 30)))) for i in range(6)]
    docs, labels = [], []
    for i in range(500):
        words = [word() for _ in range(rng.randint(20, 60))]
        toxic = i % 4 == 0
        if toxic:
            words[rng.randrange(20)] = rng.choice(["zzyx", "qqwv"])
        elif i % 9 == 0:
            words = words[:10] + rng.choice(items)[1].split() + words[10:]
        docs.append((i, " ".join(words), "en", rng.choice("abc"), 1))
        labels.append((i, 1, int(toxic)))
    for i in range(31, 60):  # near copies: a word or two replaced
        words = (docs[i][1] + " " + docs[i + 1][1]).split()
        docs += [(3000 + i, " ".join(words), "en", "b", 1)]
        for at in rng.sample(range(len(words)), rng.randint(1, 2)):
            words[at] = word()
        docs += [(4000 + i, " ".join(words), "en", "b", 1)]
    docs += [(1000 + i, docs[i][1], "en", "a", 1) for i in range(1, 30)] + [(None, docs[1][1], None, None, None), (2000, None, None, None, None), (2001, "", "en", "b", 0)]
    docs += [(2, docs[2][1], "en", docs[2][3], 1), (None, "no id here", "en", "c", 1), (None, "no id here", "en", "c", 1)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, items


def test_stages_against_brute_force(spark, folder):
    path, docs, items = folder
    stages = dict(corpus_pipeline.STAGES)
    frame = spark.read.parquet(f"{path}/documents.parquet")
    step = lambda name, df: stages[name](spark, df, path)
    rows = lambda df: sorted(map(tuple, df.select(COLUMNS).collect()), key=str)

    clean = step("toxicity", frame)
    assert clean.columns == COLUMNS
    assert rows(clean) == sorted((d for d in docs if not any(w in (d[1] or "") for w in ("zzyx", "qqwv"))), key=str)

    kept = step("simhash", clean.withColumn("id", F.lit(1)).withColumn("row", F.lit("x")))
    assert kept.columns == [*COLUMNS, "id", "row"]
    before = rows(clean)
    at = {i: d for i, d in enumerate(before)}
    order = sorted(at, key=lambda i: (at[i][0] is None, at[i][0] or 0))
    place = {n: at[i] for n, i in enumerate(order)}
    least = Counter((place[n][0], place[n][1]) for n in least_ids([(n, place[n][1]) for n in place]))
    got = rows(kept)
    assert Counter((d[0], d[1]) for d in got) == least and len(got) < len(before) - 25

    left = step("contamination", kept)
    bad = {i for i, _ in brute_contamination([(d[0], d[1]) for d in got if d[0] is not None], items)}
    assert bad and rows(left) == [d for d in got if d[0] not in bad]

    mixed = step("mixing", left.select(COLUMNS).withColumn("size", F.lit(1)))
    assert mixed.columns == [*COLUMNS, "size"]
    times = Counter(rows(mixed))
    assert set(times) <= set(map(tuple, rows(left))) and max(times.values()) == 2
    sizes = lambda ds: sum(len((d[1] or "").split()) for d in ds)
    assert abs(sizes(times.elements()) - 1.5 * sizes(rows(left))) < 4 * 90

    last = step("tokens", mixed).orderBy("start").collect()
    plain, at = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json")).tokenizer, 0
    want = Counter()
    for d, n in times.items():
        ids = plain.encode(d[1] or "", add_special_tokens=False).ids + [2]
        want[(d[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += n
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in last) == want
    for r in last:
        assert r.start == at
        at += r.n_tokens


def test_run_and_empty_tables(spark, folder, tmp_path):
    path = folder[0]
    assert corpus_pipeline.run(spark, path).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").where(F.lit(False)).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
