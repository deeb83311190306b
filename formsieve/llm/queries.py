"""One query per operator over its whole table, with production parameters, and reference SQL where SQL can express it."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import contamination, embeddings, langid, licenses, mixing, oracles, repair, sharding, simhash, substring, tokens, toxicity, trie, warc
from .common import crc_remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), radius=2, width=3)
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


@query
def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.deduplicate(table(spark, sf_dir, "documents"), window=50)
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


@query
def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokens.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, vocabulary=49_408)
    return tokens.read_back(manifest).select(F.col("id").alias("doc_id"), "start", "n_tokens", F.col("crc32").alias("ids_crc32"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = toxicity.learn(docs, labels.where(crc_remainder(F.col("doc_id")) != 2))
    held_out = F.coalesce(crc_remainder(F.col("id")) == 2, F.lit(False))
    return toxicity.score(docs, machine).select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "score",
                                                (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    training = docs.where(crc_remainder(F.col("doc_id")) != 2)
    held_out = F.coalesce(crc_remainder(F.col("id")) == 2, F.lit(False))
    return langid.identify(docs, training).select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score")


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2)
    return found.withColumnRenamed("id", "doc_id")


@query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", F.size("spans").alias("n_spans"))


@query
def op4_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), F.col("start").cast("long").alias("start"),
                        F.col("length").cast("long").alias("item_words"), F.col("matched").cast("long").alias("matched"))


# Brute force by another way: of any 15 words with at most 2 replaced, 4 consecutive ones are unchanged.
ORACLES["op4_contamination"] = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
ds AS (SELECT doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] || ' ' || w[p + 3] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS p FROM d)),
bs AS (SELECT item_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] || ' ' || w[p + 3] AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 2)) AS p FROM b WHERE len(w) >= 5)),
places AS (SELECT DISTINCT ds.doc_id, bs.item_id, ds.p - bs.p AS start FROM ds JOIN bs USING (s)),
eq AS (SELECT x.doc_id, x.item_id, x.start, len(b.w) AS n, q, CAST(d.w[x.start + q] = b.w[q] AS INT) AS e
       FROM (SELECT places.*, unnest(range(1, len(b.w) + 1)) AS q FROM places JOIN b USING (item_id)) x JOIN b USING (item_id) JOIN d USING (doc_id)
       WHERE x.start + q BETWEEN 1 AND len(d.w)),
win AS (SELECT doc_id, item_id, start, n, least(n, 15) AS span, sum(e) OVER w15 AS m15, count(*) OVER w15 AS c15,
        sum(e) OVER wall AS mall, count(*) OVER wall AS cnt FROM eq
        WINDOW w15 AS (PARTITION BY doc_id, item_id, start ORDER BY q ROWS 14 PRECEDING), wall AS (PARTITION BY doc_id, item_id, start)),
best AS (SELECT doc_id, item_id, start, n, max(CASE WHEN n >= 15 AND c15 = 15 THEN m15 WHEN n < 15 AND cnt = n THEN mall END) AS matched FROM win GROUP BY ALL)
SELECT doc_id, item_id, CAST(min(start) AS BIGINT) AS start, CAST(n AS BIGINT) AS item_words, CAST(max(matched) AS BIGINT) AS matched
FROM best WHERE matched >= CASE WHEN n < 15 THEN n ELSE 13 END GROUP BY doc_id, item_id, n
"""


@query
def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))


# All pairs within a label, then labels handed down until nothing changes.
ORACLES["op2_embeddings"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
       AND list_sum(list_transform(e, lambda x: x * x)) > 0),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(vec_id, c) AS (SELECT vec_id, vec_id FROM v UNION SELECT p.b, r.c FROM reach r JOIN pairs p ON p.a = r.vec_id WHERE r.c < p.b),
least AS (SELECT vec_id, min(c) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM pairs GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, l.component_id, v.vec_id = l.component_id AS kept
FROM v LEFT JOIN n USING (vec_id) JOIN least l USING (vec_id)
"""


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The table has no time of capture; a second per page number stands in for it.
    pages = table(spark, sf_dir, "pages").withColumn("captured_at", F.timestamp_seconds(F.lit(1_577_836_800) + F.col("page_id")))
    return warc.read_back(warc.archive(pages, least_bytes=0)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", F.col("urlkey").alias("url_key"))


@query
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.place(table(spark, sf_dir, "documents"), weights=[1.0] * 40)
    return found.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


ORACLES["op11_sharding"] = oracles.SHARDS


@query
def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = table(spark, sf_dir, "conversations")
    # Conversations of which no row is left count too.
    found = repair.repair(repair.damage(whole)).withColumnRenamed("conv", "_conv")
    every = whole.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


ORACLES["op13_repair"] = oracles.REPAIR


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv")
    head = F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(6))
    rows, conversations = trie.share_heads(trie.ordered_turns(table(spark, sf_dir, "conversations")), source=conv - conv % 100, head=head, most=5)
    return trie.prefix_trie(rows, conversations).withColumnRenamed("saved", "saved_tokens")


ORACLES["op12_prefix_trie"] = oracles.TRIE
