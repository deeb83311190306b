"""Bindings on rows of their own: whole results, repeated and null keys."""
import re

import duckdb
import pytest

import __spark_entry__ as entry
from formsieve.operators import leaves, scrub
from formsieve.plans import mapping_blocks, registry
from formsieve.plans.registry import Inputs


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


ORDERS = "o_orderkey long, o_custkey long, o_totalprice double, o_orderstatus string, o_orderpriority string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bindings"))
    write(spark, path, "orders", [(k, k * 5 + 1, 100.5 + k, "OFP"[k % 3], f"{k % 5}-X") for k in range(24)], ORDERS)
    return path


def test_inspector_lists_all_fields_of_either_page(spark, folder):
    got = {}
    for r in entry.queries()["rec10_inspector"](spark, folder).collect():
        got.setdefault(r.doc_id, set()).add(r.name)
    assert set(got) == set(range(0, 24, 2)) and {len(names) for names in got.values()} == {6}


def scrubbed_by_leaves(df, keys):
    """The leaves one by one, put together again."""
    return leaves.rebuild(scrub.scrub_leaves(leaves.flatten(df, keys)), keys)


def test_scrubbed_json_moves_records_not_leaves(spark):
    texts = ['{"a":{"b":"PRIMARY","c":1.50,"t":true,"f":false},"l":["x","PRIMARY",["y",{"z":null}],{}],"é":"q\\"ü"}', '{"a":"PRIMARY","b":[]}', '"top"', "7", "[[[2]]]",
             '{"a":{"b":"kept","d":"more"},"l":["w"],"n":12345678901234567890}', '{"a":1,"a":2}', "{", None, '{"a":"Is this a question?","b":"" }', '{"b":"one","a":"two"}']
    rows = [(k % 7 if k % 9 else None, "p" if k % 2 else None, texts[k % len(texts)]) for k in range(300)] + [(100 + k, "p", t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, part string, content string").repartition(5)
    got, want = scrub.scrub_json(df, ["doc_id", "part"]), scrubbed_by_leaves(df, ["doc_id", "part"])
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 15
    assert "Aggregate" not in got._jdf.queryExecution().toString()
    deep = "[" * 200 + '"kept value"' + "]" * 200
    assert [r.content for r in scrub.scrub_json(spark.createDataFrame([(1, deep)], "k int, content string"), ["k"]).collect()] == [deep]


def test_fields_of_one_file_reach_all_tasks(spark, tmp_path):
    write(spark, tmp_path, "customer", [(k % 40, f"name {k}", "SEG") for k in range(50)], "c_custkey long, c_name string, c_mktsegment string")
    inputs = Inputs(spark, str(tmp_path))
    assert inputs.table("customer").rdd.getNumPartitions() == 1
    fields = mapping_blocks.fields(inputs)
    assert fields.rdd.getNumPartitions() >= 8 and fields.count() == 50 * 20
    assert entry.queries()["map1_priority_pick"](spark, str(tmp_path)).count() == 40


def test_parts_hold_a_bounded_number_of_rows(spark, folder, monkeypatch):
    monkeypatch.setattr(registry, "PART_ROWS", 1)
    assert Inputs(spark, folder).dealt("SELECT o_orderkey AS doc_id FROM {orders}").rdd.getNumPartitions() == 24


def test_customers_are_dealt_by_rows_before_they_unfold(spark, tmp_path, monkeypatch):
    spark.range(24).selectExpr("id AS c_custkey", "'n' || id AS c_name", "'BUILDING' AS c_mktsegment").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    monkeypatch.setattr(registry, "PART_ROWS", 1)
    rows = mapping_blocks.fields(Inputs(spark, str(tmp_path)))
    assert rows.rdd.getNumPartitions() == 24 and rows.select("doc_id").distinct().count() == 24


def test_merge_counts_deal_rows_by_page_only(spark, folder):
    """Nothing is dealt by name on the way, and the counts are those of the reference SQL."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "600")
    try:
        got = entry.queries()["rec6_merge_counts"](spark, folder)
        rows = sorted(map(tuple, got.collect()))
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "hashpartitioning(doc_id" in plan and not re.search(r"hashpartitioning\(doc_id#\d+L?, page_no#\d+, (name|norm)#", plan)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW orders AS SELECT * FROM '{folder}/orders.parquet/*.parquet'")
    assert rows == sorted(tuple(r) for r in duck.execute(entry.oracle_sql()["rec6_merge_counts"]).fetchall()) and len(rows) == 24
