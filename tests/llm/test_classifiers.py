import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from formsieve.llm import langid, toxicity


def words(rng, alphabet, n):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n))


def plain_profile(texts, ranks):
    """(gram, count) ranked, by dictionary."""
    found = {}
    for text in texts:
        line = "".join(c.lower() if c.isalpha() or "\ue000" <= c <= "\uf8ff" else " " for c in text)  # letters past 16 bits are folded there
        for word in line.split():
            padded = f" {word} "
            for n in (1, 2, 3):
                for i in range(len(padded) - n + 1):
                    g = padded[i:i + n]
                    if g != " ":
                        found[g] = found.get(g, 0) + 1
    code = lambda g: sum((langid.BLANK if c == " " else ord(c)) << 16 * i for i, c in enumerate(g))
    return [code(g) for g, _ in sorted(found.items(), key=lambda x: (-x[1], code(x[0])))[:ranks]]


def plain_predict(text, profiles, ranks):
    own = plain_profile([text], ranks)
    away = {lang: sum(abs(i - p.index(g)) if g in p else ranks for i, g in enumerate(own)) for lang, p in profiles.items()}
    lang = min(sorted(away), key=lambda x: away[x])
    return lang, 1 - away[lang] / (len(own) * ranks)


@pytest.mark.parametrize("piece", [1 << 20, 50])
def test_profiles_and_distance_by_dictionary(spark, monkeypatch, piece):
    monkeypatch.setattr(langid, "PIECE", piece)
    rng = random.Random(3)
    alphabets = {"aa": "abcdeéÉ", "bb": "deßfgABC", "cc": "xyzñ𝒳"}
    rows = [(i, words(rng, alphabets[lang], rng.randint(1, 60)), lang) for i in range(90) for lang in [rng.choice(list(alphabets))]]
    rows += [(200, None, "aa"), (201, "", "bb"), (202, "12 3 !", "cc"), (203, "abc", None), (None, "xyz xyz", "cc"), (1, rows[1][1], rows[1][2])]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, score double").repartition(3)
    ranks = 30
    got = sorted(langid.identify(df, df, ranks=ranks).collect(), key=lambda r: str(tuple(r)))
    fold = lambda t: "".join(chr(langid.codes_of(c)[0]) if c.isalpha() else c for c in t)
    profiles = {lang: plain_profile([fold(t) for _, t, own in rows if own == lang and t], ranks) for lang in alphabets}
    want = sorted(((i, *(plain_predict(fold(t), profiles, ranks) if t and any(c.isalpha() for c in t) else ("und", 0.0))) for i, t, _ in rows), key=str)
    assert [(r.id, r.lang_pred) for r in got] == [(w[0], w[1]) for w in want]
    assert np.allclose([r.score for r in got], [w[2] for w in want])


def test_nothing_learnt(spark):
    df = spark.createDataFrame([(1, "abc", None), (2, None, "x")], "doc_id long, text string, lang string")
    assert {(r.id, r.lang_pred, r.score) for r in langid.identify(df, df).collect()} == {(1, "und", 0.0), (2, "und", 0.0)}
    none = df.where(F.lit(False))
    assert langid.identify(none, none).count() == 0


def test_machine_learns_words_beginnings_and_pairs(spark):
    """With shipped parameters; neither word of the pair says much alone."""
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(900):
        base = words(rng, "abcdefgh", rng.randint(5, 40)).split()
        pair = rng.choice([(), ("omega",), ("sigma",), ("omega", "sigma"), ("zorp" + words(rng, "aeiou", 1),)])
        for w in pair:
            base.insert(rng.randrange(len(base)), w)
        docs.append((i, " ".join(base)))
        labels.append((i, int(len(pair) == 2 or any(w.startswith("zorp") for w in pair))))
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, label string")
    known = spark.createDataFrame([*labels[:700], (5000, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    machine = toxicity.learn(df, known)
    held = [(toxicity.Machine.score(machine, d[1].encode()) >= 0.3, bool(y)) for d, (_, y) in zip(docs[700:], labels[700:])]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert machine.score(b"sigma omega") > 2 * max(machine.score(b"omega here"), machine.score(b"sigma here"))
    assert machine.score(b"Well, ZORPaeuu!") > 2 * machine.score(b"Well, xx!")
    scored = toxicity.score(spark.createDataFrame([(1, None), (1, None), (None, "zorpa"), (2, "")], "doc_id long, text string"), machine).collect()
    assert len(scored) == 4 and all(0 <= r.score <= 1 for r in scored)
    left = toxicity.reject(df.select("label", "doc_id", "text"), machine, 0.3)
    clashing = df.select("doc_id", "text", F.lit(1).alias("id"), F.lit(2).alias("t"), F.lit(0.5).alias("score"), F.lit("x").alias("terms"))
    assert sorted(map(tuple, toxicity.score(clashing, machine).collect())) == sorted(map(tuple, toxicity.score(df, machine).collect()))
    assert toxicity.reject(clashing, machine, 0.3).columns == clashing.columns
    none = df.where(F.lit(False))
    assert toxicity.score(none, machine).count() == 0 and toxicity.reject(none, machine, 0.3).count() == 0
    assert left.columns == ["label", "doc_id", "text"] and left.count() == sum(machine.score(d[1].encode()) < 0.3 for d in docs)


def test_labels_of_one_class_or_none(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    for labels, high in (([(1, 0)], False), ([(1, 1)], True), ([], None)):
        machine = toxicity.learn(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert high is None or (machine.score(b"a b") > 0.5) == high
    assert toxicity.learn(df, spark.createDataFrame([(8, 0), (9, 1)], "doc_id long, toxic int")).score(None) == 0.5


@pytest.mark.parametrize("labelled", [80, 400, 8000])
def test_the_fit_goes_as_far_on_any_number_of_labels(spark, labelled):
    """Shipped parameters: one text in eight is toxic, by one of four words."""
    rng = random.Random(labelled)
    docs = []
    for i in range(labelled + 400):
        base = words(rng, "abcdefgh", rng.randint(5, 40)).split()
        toxic = i % 8 == 0
        if toxic:
            base.insert(rng.randrange(len(base)), rng.choice(["zzyx", "qqwv", "vvkk", "jjpp"][:1 if labelled == 80 else 4]))
        docs.append((i, " ".join(base), int(toxic)))
    df = spark.createDataFrame(docs, "doc_id long, text string, toxic int").repartition(4)
    machine = toxicity.learn(df, df.where(F.col("doc_id") < labelled))
    rows = toxicity.score(df.where(F.col("doc_id") >= labelled), machine).collect()
    said = [(r.score >= 0.3, docs[r.id][2]) for r in rows]
    assert sum(p and not y for p, y in said) <= 0.05 * sum(not y for _, y in said)
    assert sum(p and y for p, y in said) >= 0.9 * sum(y for _, y in said)


def test_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(12)]
    terms = np.array(sorted({t for w in vocabulary for t in toxicity.terms_of_word(w.encode())}))
    bias, weights, factors = -0.3, rng.normal(size=len(terms)), rng.normal(size=(len(terms), 5)) / 3
    machine = toxicity.Machine(terms, bias, weights, factors)
    for n in range(8):
        text = " ".join(rng.choice(vocabulary, n)) + " unknown"
        at = [i for i, t in enumerate(terms) if t in {t for w in text.split() for t in toxicity.terms_of_word(w.encode())}]
        logit = bias + sum(weights[i] for i in at) + sum(factors[i] @ factors[j] for i in at for j in at if i < j)
        assert machine.score(text.encode()) == pytest.approx(1 / (1 + np.exp(-logit)))


def test_fit_against_plain_steps(monkeypatch):
    """Adam on the gradient found by moving every parameter a little."""
    monkeypatch.setattr(toxicity, "UPDATES", 3)
    monkeypatch.setattr(toxicity, "FACTORS", 2)
    rows, labels, n = [np.array(r, np.int64) for r in ([0, 1], [1, 2], [0, 2], [], [3], [0, 1, 2, 3])], np.array([1.0, 0, 1, 0, 0, 1]), 4
    rng = np.random.default_rng(11)
    params = np.concatenate(([np.log(3.5 / 3.5)], np.zeros(n), rng.normal(0, 0.01, n * 2)))

    def loss(p):
        w, v = p[1:1 + n], p[1 + n:].reshape(n, 2)
        total = 0
        for r, y in zip(rows, labels):
            logit = p[0] + sum(w[i] for i in r) + sum(v[i] @ v[j] for i in r for j in r if i < j)
            total += np.logaddexp(0, logit) - y * logit
        return total / len(rows) + toxicity.SHRINK / 2 * (p[1:] ** 2).sum()
    m, q = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, 4):
        grad = np.array([(loss(params + e) - loss(params - e)) / 2e-6 for e in np.eye(len(params)) * 1e-6])
        m, q = 0.9 * m + 0.1 * grad, 0.999 * q + 0.001 * grad ** 2
        params = params - toxicity.RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(q / (1 - 0.999 ** step)) + 1e-8)
    bias, weights, factors = toxicity.fit(rows, labels, n)
    assert np.allclose(np.concatenate(([bias], weights, factors.ravel())), params, atol=2e-3)
