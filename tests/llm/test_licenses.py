import random
import re

import pytest
import regex
from pyspark.sql import functions as F

from formsieve.llm import licenses


def plain(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    labels = {label for _, label in places}
    for notice, label in licenses.NOTICES.items():
        errors = licenses.errors_of(notice)
        spans = [" ".join(words[i:j]) for i in range(len(words)) for j in range(i + 1, len(words) + 1)]
        if any(abs(len(x) - len(notice)) <= errors and regex.fullmatch(rf"(?:{notice}){{e<={errors}}}", x) for x in spans):
            labels.add(label)
    return (len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None),
            ",".join(sorted({label for _, label in places})), ",".join(sorted(labels)))


def edited(rng, text, n):
    for _ in range(n):
        i = rng.randrange(len(text))
        text = rng.choice([text[:i] + text[i + 1:], text[:i] + rng.choice("xyz e") + text[i:], text[:i] + rng.choice("xyze") + text[i + 1:]])
    return text


def test_pieces_cover_the_notice():
    for notice in licenses.NOTICES:
        pieces = licenses.pieces_of(notice, licenses.errors_of(notice))
        assert "".join(p for _, p in pieces) == notice and all(notice[o:o + len(p)] == p for o, p in pieces)


@pytest.mark.parametrize("size", [30, 1 << 20])
def test_matches_plain_search(size):
    rng = random.Random(9)
    search = licenses.Searcher(licenses.NOTICES, licenses.BASE)
    texts = [None, "", "MIT License", "(CC-BY 4.0)", "cc by cc by cc by", "Apache\x7fLicense, éapache license", "the MIT licence!", "isc license mit license"]
    for _ in range(300):
        parts = [edited(rng, rng.choice(list(licenses.NOTICES)), rng.randint(0, 4)) if rng.random() < 0.5 else rng.choice(["the", "é", "Of", "12", "license"])
                 for _ in range(rng.randint(0, 6))]
        texts.append(rng.choice([" ", "\n", ", "]).join(parts))
    for text in texts:
        assert search.scan(None if text is None else text.encode(), size)[:6] == plain(text), text


def test_spans_and_score(spark):
    df = spark.createDataFrame([(1, "x Released under the MIT Licence. y", 0), (1, None, 0), (None, "CC-BY", 0)], "doc_id long, text string, labels int")
    rows = {(r.id, r.n_words): r for r in licenses.scan(df).collect()}
    one = rows[(1, 7)]
    assert one.labels == "mit" and one.base_labels == "" and 0.9 < one.score < 1
    assert ("mit", 1, 5, 1) in [tuple(s) for s in one.spans]
    assert rows[(1, 0)].labels == "" and rows[(1, 0)].score == 0 and rows[(None, 2)].score == 1 and rows[(None, 2)].first_word == 0
    assert licenses.scan(df.where(F.lit(False))).count() == 0


def test_a_text_of_one_notice_thousands_of_times():
    import time
    text, searcher = b"mit license " * 90_000, licenses.Searcher(licenses.NOTICES, licenses.BASE)
    start = time.time()
    n_words, n_base, first, last, *_ = searcher.scan(text)
    assert (n_words, n_base, first, last) == (180_000, 90_000, 0, 179_998) and time.time() - start < 10
