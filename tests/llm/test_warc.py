import gzip
import random

import pytest
from pyspark.sql import functions as F

from formsieve.llm import warc
from formsieve.llm.common import local_path

SCHEMA = "page_id long, url string, html string, captured_at timestamp_ntz, file int"


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted((rng.randint(0, 30), rng.randint(0, 3)) for _ in range(rng.randint(0, 40))) for _ in range(k)]
    assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert warc.url_key("HTTP://www.Example.org:80/A/b?Q=1#top") == "org,example)/a/b?q=1"
    assert warc.url_key("https://a.b.co:8443") == "co,b,a:8443)/"
    assert [warc.url_key(u) for u in (None, "", "no url", "http://[bad")] == ["", "", "no url", "http://[bad"]


def test_archives_and_index(spark):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        html = rng.choice([None, "", "<p>é</p>", "<p>same</p>", f"<html>{i}\r\n\r\n{'x' * rng.randint(0, 3000)}</html>"])
        rows.append((i, rng.choice([f"http://h{rng.randint(0, 5)}.org/{rng.randint(0, 9)}", "http://hot.net/", None, "odd url\n"]), html))
    rows += [(None, "http://hot.net/", "<p>same</p>"), (None, None, None), (None, "http://x.y/", "only null"), (None, "http://x.y/", "only null"), (7, rows[7][1], rows[7][2])]
    df = spark.createDataFrame([(i, u, h, None, 1) for i, u, h in rows], SCHEMA)
    df = df.withColumn("captured_at", F.when(F.col("page_id") != 5, F.timestamp_seconds(F.lit(1_600_000_000) - F.col("page_id")))).repartition(9)
    index = warc.archive(df, archive_bytes=4000, rows_per_task=16, fan_in=3)
    got = index.collect()
    files = sorted(index.inputFiles())
    assert len(files) > 3
    in_order = [tuple(r) for f in files for r in spark.read.schema(warc.CAPTURES).parquet(f).coalesce(1).collect()]
    keys = [warc._key(r) for r in in_order]
    assert keys == sorted(keys) and sorted(keys) == sorted(warc._key(tuple(r)) for r in got) and len(keys) == len(rows)

    least = {}
    for i, _, h in rows:
        if i is not None:
            least[h or ""] = min(least.get(h or "", i), i)
    want = []
    for i, u, h in rows:
        p = h or ""
        other = least.get(p) if i is None or least[p] != i else None
        want.append((i, len(p.encode()), warc.base32_sha1(p.encode()), "response" if other is None else "revisit", other))
    back = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_back(index).collect()]
    assert sorted(back, key=str) == sorted(want, key=str)

    store, path = local_path(got[0].file)
    with store.open_input_file(path) as source:
        whole = gzip.decompress(source.read())
    assert whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_small_payloads_stay_responses(spark):
    rows = [(1, "u", "aa"), (2, "u", "aa"), (3, "u", "long enough"), (4, "u", "long enough")]
    df = spark.createDataFrame([(i, u, h, None, 1) for i, u, h in rows], SCHEMA)
    back = {r.page_id: (r.record_type, r.refers_to) for r in warc.read_back(warc.archive(df, least_bytes=5)).collect()}
    assert back == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}


def test_empty_table(spark):
    assert warc.read_back(warc.archive(spark.createDataFrame([], SCHEMA))).count() == 0
