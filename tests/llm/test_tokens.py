import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from formsieve.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "Hello, World's end", "it's they'LL we've I'd", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|> x<|endoftext|>.", "é̀ ñ Ǆ ΣΑΣ", "a b　c d", "☃ ☃☃ x☃",
       "...!!! $$$the&&& 12345", "\x00\x1f a", "word " * 50, "日本語 テキスト", "́ combining ́x", "👍🏽 ok"]


@pytest.mark.parametrize("n,top", [(0, 0), (1, 0), (1, 10**15), (5, 3), (1000, 10**6), (1000, 500), (700, 2**62)])
def test_elias_fano_round_trip(n, top):
    rng = random.Random(n + top)
    values = np.array(sorted(rng.randint(0, top) for _ in range(n)), np.uint64)
    made = tokens.EliasFano.encode(values)
    back, end = tokens.EliasFano.from_bytes(memoryview(made.to_bytes()), 0, n, made.low)
    assert end == len(made.to_bytes())
    assert back.values().tolist() == values.tolist()
    assert [back.select(i) for i in range(n)] == values.tolist()
    for a, b in [(0, n), (n // 3, n // 2), (n // 2, n)]:
        assert back.values(a, b).tolist() == values[a:b].tolist()
    if n >= 1000:
        assert 8 * (len(made.lows) + len(made.highs)) <= n * (3 + max(0, np.log2(max(top, 1) / n)))


def test_words_one_by_one_equal_whole_texts(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBER", 40)
    encode = tokens.Encoder(PATH)
    rng = random.Random(3)
    texts = ODD + [None] + ["".join(rng.choice("aAéÉ'.,! \t\n ☃s tdé̀ñ1<|>") for _ in range(rng.randint(0, 80))) for _ in range(200)]
    for text, got in zip(texts, encode.encode([None if t is None else t.encode() for t in texts], 2)):
        assert got.tolist() == encode.tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def test_a_word_is_looked_up_once_however_often_it_stands():
    """Capitals and signs behind the last letter make no further word; a short form does."""
    class Counting(dict):
        asked = 0

        def get(self, *args):
            Counting.asked += 1
            return super().get(*args)

    encode = tokens.Encoder(PATH)
    encode.known = Counting(encode.known)
    texts = ["River, stone. RIVER  it's\t" * 500, "", "stone river! it's " * 300]
    for text, got in zip(texts, encode.encode([t.encode() for t in texts], 2)):
        assert got.tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids + [2]
    assert Counting.asked <= 10


def test_words_are_cut_behind_their_last_letter():
    words = ["", "Stone,", "STONE", "it's.", "a<b>.", "...", "É,", "x1.", "né!?", "Ab-c--", "日a;"]
    made = tokens._parts(pa.array(["none", *words], pa.large_string()).slice(1)).to_pylist()
    assert list(zip(made[::2], made[1::2])) == [
        ("", ""), ("stone", ","), ("stone", ""), ("it's.", ""), ("a<b>.", ""), ("...", ""), ("É,", ""), ("x1.", ""), ("né!?", ""), ("ab-c", "--"), ("日a", ";")]


def test_files(spark):
    rng = random.Random(4)
    ids = rng.sample(range(-500, 5000), 150)
    rows = [(i, rng.choice(ODD) + " " + str(i)) for i in ids] + [(None, "x y"), (None, None), (7, None), (ids[0], "again"), (ids[1], "same"), (ids[1], "same")]
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, start int").repartition(5)
    manifest = tokens.encode(df, PATH, end_id=2, vocabulary=49_408, shards=4, tokens_per_file=300)
    got = sorted(map(tuple, tokens.read_back(manifest).collect()), key=lambda r: r[1])
    plain = tokens.Encoder(PATH).tokenizer
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(plain.encode(t or "", add_special_tokens=False).ids + [2])
    order = [r[0] for r in got]
    assert order == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for i, start, n, crc in got:
        assert start == at
        at += n
        one = next(w for w in want[i] if len(w) == n and zlib.crc32(np.array(w, "<u4").tobytes()) == crc)
        want[i].remove(one)
    assert manifest.count() > 4
    name = manifest.orderBy("shard").first().file
    with open(name.removeprefix("file:"), "rb") as raw:
        import pyarrow as pa
        shard = tokens.Shard(pa.PythonFile(raw))
        ends = shard.ends().tolist()
        for first, last in ((0, 1), (1, shard.n_docs), (shard.n_docs // 2, shard.n_docs)):
            own, bounds, crcs = shard.block(first, last)
            assert own == shard.doc_ids()[first:last] and bounds.tolist() == [0, *ends][first:last + 1]
            assert crcs == [zlib.crc32(shard.document(i).astype("<u4").tobytes()) for i in range(first, last)]
        assert [len(shard.document(i)) for i in range(shard.n_docs)] == [b - a for a, b in zip([0, *ends], ends)]
    assert tokens.read_back(tokens.encode(df.where(F.lit(False)), PATH, 2, 49_408)).count() == 0


def test_starts_over_any_number_of_files_of_a_partition(spark):
    """Files of a partition come before those of the next one, however many there are."""
    numbers = [(p << 32) + n for p in (0, 1, 1500) for n in range(12_000 if p == 1 else 3)]
    files = with_starts_of(spark, numbers)
    assert [r.shard for r in files] == numbers and [r.start for r in files] == list(range(0, 2 * len(numbers), 2))


def with_starts_of(spark, numbers):
    rows = spark.createDataFrame([(n, f"f{n}", 1, 2) for n in numbers], "shard long, file string, n_docs long, n_tokens long")
    return tokens.with_starts(rows).orderBy("shard").collect()
