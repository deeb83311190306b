"""Leaves, comparison, classification, spatial reading and reconciliation on invented fixtures."""
import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from formsieve.functions.text import SPACES
from formsieve.operators import classify, compare, email, leaves, mapping, quality, reconcile, scrub, sov, spatial
from formsieve.rules import tables
from formsieve.sources import readers, sinks
from formsieve.streaming import continuous


def test_flatten_and_rebuild_is_identity(spark):
    text = '{"b":1,"a":[1,{"z":null,"y":"q\\"é"},[[2]]],"e":{},"t":true,"f":1250.5,"em":[]}'
    df = spark.createDataFrame([(1, text), (2, '{"a":1,"a":2}'), (3, '{"a":'), (4, None), (5, "[]")], "k int, content string")
    rows = leaves.flatten(df, ["k"])
    assert [r["path"] for r in rows.where("k = 1").orderBy("ord").collect()] == ["b", "a[0]", "a[1].z", "a[1].y", "a[2][0][0]", "e", "t", "f", "em"]
    assert {r["k"] for r in rows.collect()} == {1, 5}
    assert {r["k"]: r["content"] for r in leaves.rebuild(rows, ["k"]).collect()} == {1: text, 5: "[]"}


VERDICTS = [
    (None, "null", None, "null", "CORRECT"), (None, "null", "", "string", "CORRECT"), (None, "null", "[]", "array", "CORRECT"), (None, "null", "false", "boolean", "CORRECT"),
    (None, "null", "x", "string", "EXTRA"), ("*", "string", "x", "string", "CORRECT"), ("*", "string", "false", "boolean", "CORRECT"), ("*", "string", "", "string", "MISSING"),
    ("N/A", "string", "z", "string", "N/A"), ("a", "string", None, None, "MISSING"), ("true", "boolean", "no", "string", "CORRECT"), ("100", "number", "100.99", "string", "CORRECT"),
    ("100", "number", "101", "string", "WRONG"), ("1000", "number", "1004.9", "string", "CORRECT"), ("100", "number", "abc", "string", "WRONG"),
    ("2026-05-01", "string", "5/1/2026", "string", "CORRECT"), ("A  b", "string", "a B", "string", "CORRECT"), ("abc", "string", "abcd", "string", "WRONG"),
    ("a text of more than thirty characters", "string", "So: A text of more than  thirty characters!", "string", "CORRECT"), ("x", "string", "{}", "o", "WRONG")]


def test_every_verdict(spark):
    df = spark.createDataFrame(VERDICTS, "gt_value string, gt_type string, out_value string, out_type string, want string")
    assert compare.with_verdict(df).where("verdict <> want").collect() == []
    strict = compare.with_verdict(df, strict_bool=True).where("gt_type = 'boolean'").first()
    assert strict["verdict"] == "WRONG"


def test_record_against_itself_is_perfect(spark):
    record = json.dumps({"Locations": [{"LocationNumber": n, "Buildings": [{"BuildingNumber": b, "v": f"{n}-{b}"} for b in (2, 1)]} for n in (3, 1, 2)], "_m": 1})
    shuffled = json.dumps({"Locations": [{"LocationNumber": n, "Buildings": [{"BuildingNumber": b, "v": f"{n}-{b}"} for b in (1, 2)]} for n in (1, 2, 3)]})
    gt, out = (spark.createDataFrame([(1, x)], "doc_id int, content string") for x in (record, shuffled))
    got = compare.score(compare.compare_records(gt, out, ["doc_id"])).first()
    assert (got["correct"], got["wrong"], got["missing"], got["extra"], got["precision"], got["recall"]) == (15, 0, 0, 0, 1.0, 1.0)


def test_page_runs_and_kinds(spark):
    long = "word " * 80
    pages = spark.createDataFrame([(1, 1, "x" * 29), (1, 2, "x" * 30), (1, 3, long), (1, 4, "loss run claim number valuation date"), (1, 5, "claim number valuation date " + "y" * 10),
                                   (1, 6, "schedule of values loc # z zzz zzz"), (1, 7, "ACORD 125 (2016/03) " + long), (1, 8, long + "ACORD 125 (2016/03)")], "doc_id int, page_no int, text string")
    kinds = classify.with_page_kind(pages)
    assert [r["kind"] for r in kinds.orderBy("page_no").collect()] == ["EMPTY", "UNKNOWN", "NARRATIVE", "LOSS_RUN", "UNKNOWN", "SOV_TABLE", "NARRATIVE", "ACORD_FORM"]
    runs = spark.createDataFrame([(1, 1, "A"), (1, 2, "A"), (1, 3, "B"), (1, 4, "A")], "doc_id int, page_no int, kind string")
    assert [(r["first_page"], r["last_page"]) for r in classify.page_runs(runs).orderBy("run_no").collect()] == [(1, 2), (3, 3), (4, 4)]


def test_lines_against_brute_force(spark):
    rnd = random.Random(5)
    words = [(d, 1, i, f"w{i}", float(rnd.randrange(500)), 0.0, round(rnd.uniform(0, 150), 1), 0.0) for d in range(6) for i in range(120)]
    want = {}
    for d in range(6):
        page = sorted((w for w in words if w[0] == d), key=lambda w: (round(w[6]), w[4], w[2]))
        out, line = [], []
        for w in page:
            if line and abs(w[6] - line[0][6]) < 4:
                line.append(w)
            else:
                out, line = out + ([line] if line else []), [w]
        want[d] = sorted(" ".join(w[3] for w in sorted(x, key=lambda w: (w[4], w[2]))) for x in out + [line])
    df = spark.createDataFrame(words, "doc_id int, page_no int, ord int, text string, x0 double, x1 double, top double, bottom double")
    got = {d: [] for d in range(6)}
    for r in spatial.lines(df).collect():
        got[r["doc_id"]].append(r["text"])
    assert {d: sorted(x) for d, x in got.items()} == want


def test_lines_of_a_page_without_a_gap(spark):
    # One page of close rows: tops a tolerance apart up to the last bit, and one top that holds a third of all words.
    tops = [round(0.1 * k, 1) for k in range(3000)] + [0.1 + 4.0 * k for k in range(60)] + [77.7] * 1500
    rows = [(1, 1, n, t, float(n * 7919 % 613), f"w{n}") for n, t in enumerate(tops)]
    df = spark.createDataFrame(rows, "doc_id int, page_no int, ord bigint, top double, x0 double, text string")
    expected, first = [], None
    for _, _, n, t, x, text in sorted(rows, key=lambda r: (round(r[3]), r[4], r[2])):
        if first is None or abs(t - first) >= 4:
            expected.append([])
            first = t
        expected[-1].append((x, n, text))
    got = [(r.line_no, r.text) for r in spatial.lines(df).orderBy("line_no").collect()]
    assert got == [(i, " ".join(w[2] for w in sorted(line))) for i, line in enumerate(expected, 1)]


def test_lines_of_nothing(spark):
    schema = "doc_id int, page_no int, ord bigint, top double, x0 double, text string"
    assert spatial.lines(spark.createDataFrame([], schema)).collect() == []
    odd = spark.createDataFrame([(1, 1, 0, None, 1.0, "a"), (1, 1, 1, 5.0, 1.0, None), (1, 1, 2, 30.0, 1.0, " "), (1, 1, 3, 60.0, 1.0, "b"), (1, 1, 3, 60.0, 1.0, "b")], schema)
    assert [tuple(r) for r in spatial.lines(odd).collect()] == [(1, 1, 1, "b b")]


def test_lines_shuffle_no_words_of_pages_that_lie_together(spark, monkeypatch):
    rnd = random.Random(8)
    tops = [rnd.choice([None, float("nan"), float("inf")]) if n % 97 == 0 else round(rnd.uniform(0, 60), 1) for n in range(900)]
    rows = [(None if n % 211 == 0 else n // 90, "p", n % 60, rnd.choice(["a", "b", " ", "", "\u00e9\u2003", None]), rnd.choice([None, 1.0, 2.5, -0.0]) if n // 90 == 3 else float(rnd.randrange(9)), t)
            for n, t in enumerate(tops)]
    df = spark.createDataFrame(rows, "doc_id int, page_no string, ord int, text string, x0 double, top double")
    read = lambda words: sorted(map(tuple, spatial.lines(words).collect()))
    want = sorted(map(tuple, spatial._spread_lines(df).collect()))
    assert read(df.coalesce(1)) == read(df.repartition(5)) == read(df.coalesce(1).sort("text")) == want and len(want) > 90
    monkeypatch.setattr(spatial, "PAGE_WORDS", 4)
    assert read(df.coalesce(1)) == want
    monkeypatch.undo()
    together = df.where("doc_id <> 3 AND top < 60 AND NOT isnan(top)").coalesce(1)
    assert "Exchange" not in spatial.lines(together)._jdf.queryExecution().executedPlan().toString()
    assert read(together) == sorted(map(tuple, spatial._spread_lines(together).collect()))


def test_overflow_content_deals_no_words(spark):
    words = [(d, p, n, t, float(n), 10.0 * (n // 2 + 1)) for d in range(6) for p in (1, 2) for n, t in enumerate(["a", "b", "PAGE", "1", "c", "OF" if p == 2 else "d"])]
    words += [(d, 1, 9, "* Code x", 0.0, 90.0) for d in range(0, 6, 2)]
    df = spark.createDataFrame(words, "doc_id int, page_no int, ord int, text string, x0 double, top double").coalesce(1)
    got = spatial.overflow_content(df, skip=["a b"])
    assert "hashpartitioning" not in got.drop("text")._jdf.queryExecution().executedPlan().toString()
    want = [(d, 1, "entry", "* Code x") for d in range(0, 6, 2)] + [(d, 1, "line", "c d") for d in range(1, 6, 2)] + [(d, 2, "line", "c OF") for d in range(6)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_expressions_of_verdicts_are_compiled(spark):
    rows = spark.createDataFrame([("a", "string", "A ", "string")], "gt_value string, gt_type string, out_value string, out_type string")
    code = spark._jvm.PythonSQLUtils.explainString(compare.with_verdict(rows)._jdf.queryExecution(), "codegen")
    largest = max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code))
    assert largest > 8000 >= int(spark.conf.get("spark.sql.codegen.hugeMethodLimit"))
    assert all(compare._sort_text({"Name": f"{a}X{a}y{a}"}, "Name") == "x y" for a in SPACES)


def test_line_numbers_run_over_the_page(spark):
    words = [(1, 1, i, f"w{i}", 0.0, 0.0, float(top), 0.0) for i, top in enumerate([5, 9.5, 14, 40, 44.5, 90])]
    df = spark.createDataFrame(words, "doc_id int, page_no int, ord int, text string, x0 double, x1 double, top double, bottom double")
    assert [(r.line_no, r.text) for r in spatial.lines(df).orderBy("line_no").collect()] == [(i + 1, f"w{i}") for i in range(6)]


def test_deadline_over_many_paragraphs(spark):
    lines = ["we Need by", " ", ":", "", " \t", "5/15/26", "due", "later", "6/1/26"]
    df = spark.createDataFrame([(1, i, "p", t) for i, t in enumerate(lines)] + [(2, 0, "p", "deadline"), (2, 1, "p", "none"), (2, 2, "p", "1/2/26")], "doc_id int, ord int, style string, text string")
    assert {(r.doc_id, r.quote_needed_by) for r in email.quote_deadline(df).collect()} == {(1, "2026-05-15")}


def test_containment_is_not_a_nested_loop(spark):
    words = spark.createDataFrame([(1, 1, 0, "X", 21.0, 27.0, 165.0, 172.0)], "doc_id int, page_no int, ord int, text string, x0 double, x1 double, top double, bottom double")
    fields = spark.createDataFrame([("f", 0, 0, "A_Indicator_A", "/Btn", "t", 18.0, 620.0, 30.0, 632.0), ("f", 0, 1, "D", "/Tx", "t", 0.0, 1.0, 0.0, 1.0)],
                                   "template string, tpage int, ord int, name string, ftype string, tooltip string, x0 double, y0 double, x1 double, y1 double")
    offsets = spark.createDataFrame([(1, 1, "f", 0, 0.0)], "doc_id int, page_no int, template string, tpage int, dy double")
    got = spatial.page_fields(words, fields, offsets)
    assert [(r["name"], r["v_bool"], r["source"]) for r in got.collect()] == [("A_Indicator_A", True, "bbox:text_x")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


SHORTS = ["NY", "ny", "$5", "5", "1,5", "15", "a b", "a", "b", "-1", "1", "n/a", "n", "x", "zz top text", "of", "5,", "$", "ab"]


@pytest.mark.parametrize("seed", range(4))
def test_gap_fills_against_sequential_rule(spark, seed):
    import re
    rnd = random.Random(seed)
    norm = lambda v: re.sub(r"\s+", " ", v.lower().replace("$", "").replace(",", "")).strip()
    primary, cands, want = [], [], set()
    for d in range(25):
        texts = [rnd.choice(["State of NY", "unit 5", "plain", "a-b", "Zz Top Text"]) for _ in range(rnd.randrange(3))]
        primary += [(d, 1, i, t) for i, t in enumerate(texts)]
        equal, kept = {norm(t) for t in texts}, list(texts)
        for o in range(12):
            v, kind = rnd.choice(SHORTS), rnd.choice(["string", "string", "number"])
            cands.append((d, 1, o, f"f{o}", "t", v, kind, "object"))
            n = norm(v)
            seen = bool(n) and (n in equal or (len(n) < 4 and any(re.search(rf"\b{re.escape(n)}\b", t.lower()) for t in kept)))
            if not seen:
                want.add((d, o))
                if kind == "string":
                    kept.append(v)
    p = spark.createDataFrame(primary, "doc_id int, page_no int, ord bigint, v_str string")
    c = spark.createDataFrame(cands, "doc_id int, page_no int, ord bigint, name string, tooltip string, value string, vtype string, branch string")
    assert {(r["doc_id"], r["ord"]) for r in reconcile.gap_fills(p, c).collect()} == want


def test_pieces_that_are_asked_for(spark):
    asked = [["ny", "5", "a-b"], ["zz"], [], None]
    texts = ["State of NY", "unit 5, a-b", "A b-c5", "plain", "", None, "an NYC\nny."]
    df = spark.createDataFrame([(t, a) for t in texts for a in asked], "t string, a array<string>")
    for r in df.select("a", reconcile.asked_pieces("t", "a").alias("got"), reconcile.short_pieces("t").alias("all")).collect():
        assert set(r["got"] or []) == {p for p in r["all"] or [] if r["a"] is None or p in r["a"]}


def test_members_are_the_walk_without_writing_out_what_holds_them(spark, monkeypatch):
    record = {"a": {"b": "x", "deep": {"c": [1, {"d": None}]}, "none": [], "": True}, "l": ["s", {"k": "v", "n": 2.5, "o": {}}, [3, 4], {}], "t": "u", "f": False, "e": {}}
    want = []
    for n, (steps, text, kind) in enumerate(leaves.walk(record, 3, True)):
        shape = [type(s) for s in steps]
        if shape == [str] and kind not in ("o", "a", "object", "array"):
            want.append((n, f"vlm_{steps[0]}", steps[0], text, kind, "scalar"))
        elif shape == [str, str]:
            want.append((n, "vlm_{}_{}".format(*steps), "{}.{}".format(*steps), text, kind, "object"))
        elif shape == [str, int, str]:
            want.append((n, "vlm_{}_{}_{}".format(*steps), "{}[{}].{}".format(*steps), text, kind, "array"))
    dumped, dump = [], leaves._dump
    monkeypatch.setattr(leaves, "_dump", lambda v: dumped.append(v) or dump(v))
    assert leaves._members(record) == want
    assert dumped == [record["a"]["deep"]]
    df = spark.createDataFrame([(1, 1, json.dumps(record)), (2, 1, "[1]"), (3, 1, '{"a":1,"a":2}'), (4, 1, None)], "doc_id int, page_no int, content string")
    assert [tuple(r)[2:] for r in reconcile.candidates(df).orderBy("doc_id", "ord").collect()] == want


def test_scrub_drops_empty_branches(spark):
    df = spark.createDataFrame([(1, '{"a":{"b":"PRIMARY","c":null},"d":[{"e":"real"},{"f":"signature"},false]}'), (2, '{"a":"Y/N"}')], "k int, content string")
    assert {r["k"]: r["content"] for r in scrub.scrub_json(df, ["k"]).collect()} == {1: '{"d":[{"e":"real"},false]}'}


def test_text_check(spark):
    pages = spark.createDataFrame([(1, 1, "Paid $1,250.50 on 03/09/2025\n12 Elm St\nSpringfield NY 10001"), (1, 2, None)], "doc_id int, page_no int, text string")
    rows = [("1250.50", "confirmed"), ("3/9/2025", "confirmed"), ("12 Elm StSpringfield", "confirmed"), ("10001 Springfield NY", "confirmed"), ("10002 NY", "not_in_raw_text"), ("abc", "skipped"), ("Elmwood", "skipped")]
    df = spark.createDataFrame([(1, 1, v, "string", w) for v, w in rows] + [(1, 2, "99999", "string", "skipped")], "doc_id int, page_no int, value string, vtype string, want string")
    assert reconcile.text_check(df, pages).where("status <> want").collect() == []


def test_schedule_column_theft_can_be_excluded(spark):
    grid = [["Loc #", "Building #", "Street Address", "City", "State"], ["1", "7", "1 Oak", "c", "NY"], ["", "3", "title", "c", "NY"], ["2", "x", "2 Oak", "c", "NY"]]
    cells = spark.createDataFrame([("d", "s", 0, r, c, v) for r, row in enumerate(grid) for c, v in enumerate(row)], "doc_id string, sheet string, sheet_ord int, row_no int, col_no int, value string")
    parity = sov.buildings(sov.numbered_rows(sov.schedule_rows(cells))).orderBy("row_no").collect()
    assert [(r["location_number"], r["building_number"], r["building_limit"]) for r in parity] == [(1, 7, 7.0), (2, 1, None)]
    safe = sov.buildings(sov.numbered_rows(sov.schedule_rows(cells, exclude={"rcv": ["Building #"]}))).orderBy("row_no").collect()
    assert [r["building_limit"] for r in safe] == [None, None]


def test_email_thread(spark):
    lines = ["GL Submission TARGET: $55K - need by 5/15/26", "Thanks,", "Pat Example | Senior Broker", "Sample Brokerage LLC", "pat@example.com 555-010-0100", "From: someone", "outside", "Regards line"]
    p = spark.createDataFrame([(1, i, t) for i, t in enumerate(lines)], "doc_id int, ord int, text string")
    assert email.subject_facts(p).first()["target_premium"] == 55000.0
    assert email.quote_deadline(p).first()["quote_needed_by"] == "2026-05-15"
    sig = email.merge_signatures(email.signatures(email.signature_lines(p))).collect()
    assert [(s["name"], s["title"], s["company"], s["email"], s["phone"]) for s in sig] == [("Pat Example", "Senior Broker", "Sample Brokerage LLC", "pat@example.com", "555-010-0100")]


def test_party_with_two_pages_is_one(spark):
    rows = [(1, p, i, n, v, None) for p in (3, 7) for i, (n, v) in enumerate([("AdditionalInterest_FullName_A", "Beta Bank 12 Oak Road"), ("AdditionalInterest_MailingAddress_LineOne_A", "Springfield, NY 10001")])]
    rows += [(1, p, 9, "AdditionalInterest_Interest_MortgageeIndicator_A", None, True) for p in (3, 7)]
    f = spark.createDataFrame(rows, "doc_id int, page_no int, ord int, name string, v_str string, v_bool boolean")
    got = mapping.secured_parties(f).collect()
    assert [(g["name"], g["interest"], g["street"], g["city"], g["pages"]) for g in got] == [("Beta Bank", "Mortgagee", "Oak Road", "Springfield", [3, 7])]


def test_coverage_counts_empty_sections_once(spark):
    docs = spark.createDataFrame([(1, '{"Submission":{"GLSelected":false},"Locations":[]}')], "doc_id int, content string")
    cov = quality.coverage(quality.field_presence(docs, ["doc_id"]), docs, ["doc_id"])
    sections = {r["section"]: (r["populated"], r["total"]) for r in quality.section_coverage(cov, ["doc_id"]).collect()}
    assert sections["Submission"] == (1, 10) and sections["Locations[]"] == (0, 4)
    assert {r["tier"]: r["total"] for r in quality.tier_coverage(cov, ["doc_id"]).collect()}["HIGH"] < 30


def test_files_and_sinks(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "sub" / "A form.PDF").write_bytes(b"x")
    (tmp_path / "in" / "b.json").write_text('{"pages":[{"page":1,"data":{"a":1}}]}')
    files = {(r["file_name"], r["suffix"]) for r in readers.scan_files(spark, str(tmp_path / "in")).collect()}
    assert files == {("A form.PDF", ".pdf"), ("b.json", ".json")}
    docs = readers.read_json_documents(spark, str(tmp_path / "in"))
    assert readers.document_pages(docs, "file_name").select("page_no", "content").collect()[0].asDict() == {"page_no": 1, "content": '{"a":1}'}
    out = str(tmp_path / "out")
    sinks.write_extractions(spark.createDataFrame([(1, "loss_run"), (2, "other")], "doc_id int, doc_type string"), out)
    assert {r["doc_type"] for r in spark.read.json(out).collect()} == {"loss_run", "other"}
    sinks.write_submissions(spark.createDataFrame([(1, None)], "doc_id int, x string"), str(tmp_path / "subs"))
    assert spark.read.text(str(tmp_path / "subs")).first()["value"] == '{"doc_id":1}'


def test_stream_keeps_the_latest_version_of_each_document(spark, tmp_path):
    source, target, check = (str(tmp_path / n) for n in ("in", "target", "check"))
    schema = "doc_id int, v string"
    for batch in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d")]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(source)
        continuous.upsert_by_document(continuous.document_stream(spark, source, schema), target, check).awaitTermination(120)
    assert {(r["doc_id"], r["v"]) for r in continuous.read_latest(spark, target).collect()} == {(1, "a"), (2, "c"), (3, "d")}


def test_two_versions_in_one_batch(spark, tmp_path):
    source, target, check, schema = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"), "doc_id bigint, v string"
    for batch in ([(1, "old"), (1, "old too"), (2, "b")], [(1, "new"), (3, "c")]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        time.sleep(1.1)
    continuous.upsert_by_document(continuous.document_stream(spark, source, schema), target, check).awaitTermination(120)
    want = {(1, "new"), (2, "b"), (3, "c")}
    assert {(r["doc_id"], r["v"]) for r in continuous.read_latest(spark, target).collect()} == want
    continuous.compact(spark, target)
    assert {(r["doc_id"], r["v"]) for r in continuous.read_latest(spark, target).collect()} == want


def test_a_version_is_an_arrival_over_files_and_batches(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "doc_id bigint, v long"
    rows = lambda base, ids: spark.range(0, 60, 1, 6).selectExpr("id % 5 AS doc_id", f"id + {base} AS v").where(F.col("doc_id").isin(ids))
    rows(0, [0, 1, 2, 3]).write.parquet(f"{source}/arrived-1")
    time.sleep(1.1)
    rows(1000, [2, 3, 4]).write.parquet(f"{source}/arrived-2")
    want = {(i % 5, i + (0 if i % 5 < 2 else 1000)) for i in range(60)}
    for per_trigger in (1, 4, 100):
        target, check = str(tmp_path / f"out{per_trigger}"), str(tmp_path / f"check{per_trigger}")
        stream = continuous.document_stream(spark, f"{source}/arrived-*", schema, files_per_trigger=per_trigger)
        continuous.upsert_by_document(stream, target, check).awaitTermination(120)
        got = [(r["doc_id"], r["v"]) for r in continuous.read_latest(spark, target).collect()]
        assert len(got) == 60 and set(got) == want


def test_a_batch_reads_its_own_rows_and_the_log_folds(spark, tmp_path):
    """20 arrivals of the same size, one a batch. The last ten batches read as much as the first ten, compaction keeps the latest arrival
    of every document and no more, and an arrival that goes on after it stays whole."""
    source, target, check, schema = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"), "doc_id bigint, v bigint"
    executors = lambda: spark._jsc.sc().statusStore().executorList(False).iterator()

    def read_so_far():
        total, each = 0, executors()
        while each.hasNext():
            total += each.next().totalInputBytes()
        return total
    read = []
    for half in (0, 10):
        for n in range(half, half + 10):
            spark.range(0, 500, 1, 2).selectExpr("id % 50 + 10 * (id % 3) AS doc_id", f"1000 * {n} + id AS v").coalesce(1).write.parquet(f"{source}/run={n:02d}")
        stream, before = continuous.document_stream(spark, f"{source}/run=*", schema, files_per_trigger=1), read_so_far()
        continuous.upsert_by_document(stream, target, check).awaitTermination(120)
        read.append(read_so_far() - before)
        if not half:
            assert continuous.compact(spark, target) == 9 and continuous.compact(spark, target) == 9
            continuous.forget(spark, target)
    assert read[1] <= 1.2 * read[0]
    want = {(i % 50 + 10 * (i % 3), 19000 + i) for i in range(500)}
    latest = lambda: {(r["doc_id"], r["v"]) for r in continuous.read_latest(spark, target).collect()}
    assert latest() == want
    assert continuous.compact(spark, target) == 19
    continuous.forget(spark, target)
    assert latest() == want and spark.read.parquet(f"{target}/merged=19").count() == 500
    assert [f.name for f in (tmp_path / "out").iterdir() if f.is_dir()] == ["merged=19"]


def test_an_arrival_goes_on_after_compaction(spark, tmp_path):
    source, target, schema = str(tmp_path / "in"), str(tmp_path / "out"), "doc_id bigint, run int, v string"
    for rows in ([(1, 2, "a"), (1, 1, "old"), (2, 1, "b")], [(1, 2, "a too"), (2, 0, "late")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = continuous.document_stream(spark, source, schema, version="run")
        continuous.upsert_by_document(stream, target, str(tmp_path / "check")).awaitTermination(120)
        continuous.compact(spark, target)
        continuous.forget(spark, target)
    assert {(r["doc_id"], r["v"]) for r in continuous.read_latest(spark, target).collect()} == {(1, "a"), (1, "a too"), (2, "b")}


def test_a_column_names_the_arrival(spark, tmp_path):
    source, target, schema = str(tmp_path / "in"), str(tmp_path / "out"), "doc_id bigint, run int, v string"
    for rows in ([(1, 2, "new"), (1, 1, "old")], [(1, 2, "new too"), (2, 1, "b")], [(1, 1, "late")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    stream = continuous.document_stream(spark, source, schema, files_per_trigger=1, version="run")
    continuous.upsert_by_document(stream, target, str(tmp_path / "check")).awaitTermination(120)
    assert {(r["doc_id"], r["v"]) for r in continuous.read_latest(spark, target).collect()} == {(1, "new"), (1, "new too"), (2, "b")}


def test_first_arrivals(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.sql("SELECT id % 3 AS doc_id, TIMESTAMP '2024-01-01 00:00:00' + make_interval(0,0,0,0,0,CAST(id AS INT)) AS ts FROM range(9)").write.parquet(source)
    stream = continuous.first_arrivals(continuous.document_stream(spark, source, "doc_id bigint, ts timestamp"), "ts", ["doc_id"])
    q = stream.writeStream.format("memory").queryName("arrivals").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination(120)
    assert spark.table("arrivals").count() == 3


def test_scoring_has_no_depth_limit(spark):
    from formsieve.operators import compare
    deep = lambda inner: '{"a":[' * 70 + inner + ']}' * 70
    gt = spark.createDataFrame([(1, deep('{"v":1}')), (2, deep('[{"Name":"b","v":"x"},{"Name":"a","v":"y"}]'))], "doc_id long, content string")
    out = spark.createDataFrame([(1, '{"a":[]}'), (2, deep('[{"Name":"a","v":"y"},{"Name":"b","v":"x"},{"Name":"c"}]'))], "doc_id long, content string")
    got = {(r.doc_id, r.verdict): r.n for r in compare.compare_records(gt, out, ["doc_id"]).groupBy("doc_id", "verdict").agg(F.count("*").alias("n")).collect()}
    assert got == {(1, "MISSING"): 1, (2, "CORRECT"): 4, (2, "EXTRA"): 1}


def test_list_items_paired_by_key(spark):
    from formsieve.operators import compare
    gt = [{"Name": "a", "v": 1}, {"Name": "B ", "v": 2}, {"Name": "b", "v": 3}, "text"]
    paired, surplus = compare._paired(gt, [{"Name": "b", "v": 2}, {"Name": "x"}, {"Name": "A", "v": 1}], "key")
    assert [(n, there, o) for n, _, there, o in paired] == [(0, True, {"Name": "A", "v": 1}), (1, True, {"Name": "b", "v": 2}), (2, False, None), (3, False, None)]
    assert surplus == [4]


def test_legacy_gap_fills_deal_a_page_once(spark):
    """Boxes and values meet by one deal without a join; pages go on over batches, rows without a key belong to no page."""
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(conf)
    spark.conf.set(conf, "2")
    try:
        boxes = spark.createDataFrame([(1, 1, "Alpha Beta"), (1, 2, "gamma"), (2, 1, None), (None, 1, "delta")], "doc_id long, page_no int, v_str string")
        cands = spark.createDataFrame([
            (1, 1, 1, "beta", "string"), (1, 1, 2, "Zeta one", "string"), (1, 1, 3, "7", "number"), (1, 1, 4, "ZETA", "string"), (1, 1, 5, "a\x01b", "string"),
            (1, 1, 6, "A\x01B", "string"), (1, 1, 7, "betazeta", "string"), (1, 1, 8, "", "string"), (1, 1, 9, "false", "boolean"),
            (1, 2, 1, "beta", "string"), (1, 2, 1, "eta", "string"), (1, 2, 2, "et", "string"), (2, 1, 1, "7", "number"), (2, 1, 2, "70", "string"),
            (2, 1, 3, "7", "string"), (None, 1, 1, "delta", "string"), (None, 1, 2, "delta", "string"), (3, None, 1, "x", "string"), (3, None, 2, "x", "string")],
            "doc_id long, page_no int, ord long, value string, vtype string").selectExpr("*", "'n' AS name", "'t' AS tooltip", "'object' AS branch").select(
            "doc_id", "page_no", "ord", "name", "tooltip", "value", "vtype", "branch")
        found = reconcile.gap_fills_legacy(boxes, cands, 3)
        assert found.dtypes == cands.dtypes
        got = sorted(((r.doc_id or 0, r.page_no or 0, r.ord, r.value) for r in found.collect()))
        assert got == [(0, 1, 1, "delta"), (0, 1, 2, "delta"), (1, 1, 2, "Zeta one"), (1, 1, 3, "7"), (1, 1, 5, "a\x01b"), (1, 1, 7, "betazeta"),
                       (1, 2, 1, "beta"), (1, 2, 1, "eta"), (2, 1, 1, "7"), (2, 1, 2, "70"), (3, 0, 1, "x"), (3, 0, 2, "x")]
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan and plan.count("RepartitionByExpression") == 1
    finally:
        spark.conf.set(conf, was)


CAND_SCHEMA = "doc_id long, page_no int, ord long, name string, tooltip string, value string, vtype string, branch string"


def test_gap_fills_deal_packs_once(spark):
    """Values go to their pages as lists, once, for the form and for the boxes alike; no join asks for more than the page."""
    cands = spark.createDataFrame([(d, 1, o, f"n{o}", "t", v, "string", "object") for d in range(6) for o, v in enumerate(["long value", "NY", "ny", "yes", "c"])], CAND_SCHEMA)
    page_map = spark.range(900).selectExpr("id AS doc_id", "1 AS page_no", "'f' AS template", "0 AS tpage")
    labels = tables.frame(spark, "template string, tpage int, label string", [("f", 0, "yes")])
    boxes = spark.range(900).selectExpr("id AS doc_id", "1 AS page_no", "0L AS ord", "IF(id = 0, 'long value', 'part c') AS v_str")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        got = reconcile.gap_fills(boxes, scrub.drop_option_labels(cands, page_map, labels))
        assert sorted((r.doc_id, r.ord) for r in got.collect()) == [(0, 1), (0, 4)] + [(d, o) for d in range(1, 6) for o in (0, 1)]
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        # One deal each of packs, of forms and of boxes by page.
        assert len(re.findall(r"Exchange hashpartitioning\(doc_id#\S+, page_no#\S+, ", plan)) == len(re.findall(r"Exchange hashpartitioning\(doc_id", plan)) == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_pages_of_gap_fills_go_on_over_batches(spark):
    """Rows without a page are all kept; where one value per name stands, the last one of the page does."""
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(conf)
    spark.conf.set(conf, "2")
    try:
        rows = [(1, 1, 0, "a", "State of NY"), (1, 1, 1, "b", "ny"), (1, 1, 2, "c", "x y"), (1, 1, 2, "d", "x"), (1, 1, 3, "c", "X"), (1, 1, 4, "c", "q"), (1, 2, 0, "a", "ny"),
                (1, 2, 1, "a", "z"), (None, 1, 0, "a", "ny"), (None, 1, 1, "a", "ny"), (None, 1, 2, "b", "ny"), (None, 1, 3, "b", "o"), (2, None, 0, "a", "ny"), (2, None, 1, "a", "ny")]
        cands = spark.createDataFrame([(d, p, o, n, "t", v, "string", "object") for d, p, o, n, v in rows], CAND_SCHEMA)
        boxes = spark.createDataFrame([(1, 2, "Z"), (None, 1, "ny"), (1, 1, None)], "doc_id long, page_no int, v_str string")
        show = lambda df: sorted((r.doc_id or 0, r.page_no or 0, r.ord, r.name) for r in df.collect())
        every = [(0, 1, 0, "a"), (0, 1, 1, "a"), (0, 1, 2, "b"), (0, 1, 3, "b"), (1, 1, 0, "a"), (1, 1, 2, "c"), (1, 1, 2, "d"), (1, 1, 4, "c"), (1, 2, 0, "a"), (2, 0, 0, "a"), (2, 0, 1, "a")]
        assert reconcile.gap_fills(boxes, cands).dtypes == cands.dtypes and show(reconcile.gap_fills(boxes, cands)) == every
        assert show(reconcile.gap_fills(boxes, cands, one_per_name=True)) == [(0, 1, 1, "a"), (0, 1, 3, "b"), (1, 1, 0, "a"), (1, 1, 2, "d"), (1, 1, 4, "c"), (1, 2, 0, "a"), (2, 0, 1, "a")]
    finally:
        spark.conf.set(conf, was)


def test_pieces_are_those_of_the_engine(spark):
    rnd = random.Random(7)
    odd = "ab 1_-$,.\n\tåßé́ͅⅳ²½٣ªµ中ー‍‿ⓐ\U0001f150\U0001d400😀·'’"
    texts = ["", "ny", *("".join(rnd.choice(odd) for _ in range(rnd.randrange(1, 12))) for _ in range(400)), *(f"a{c}b {c} {c}{c}" for c in odd)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select(F.lower("t").alias("low"), reconcile.short_pieces("t").alias("p")).collect():
        assert reconcile._cut(r.low) == set(r.p), repr(r.low)
        assert all(reconcile._holds(r.low, p) for p in r.p)
        assert all((p in r.p) == reconcile._holds(r.low, p) for n in (1, 2, 3) for p in (r.low[i:i + n] for i in range(len(r.low) - n + 1)))


def test_many_short_values_of_a_page_are_looked_up_in_pieces():
    asked = {f"{i:03d}" for i in range(100)}
    texts = [(-1, "x 007 099"), (2, "a008 050-051"), (3, "007 050 052")]
    few = {s: at for s in asked for at, low in reversed(texts) if reconcile._holds(low, s)}
    assert len(asked) > reconcile.ASKED_AT_ONCE and reconcile._first_shown(asked, texts) == few == {"007": -1, "099": -1, "050": 2, "051": 2, "052": 3}


def test_deep_values_keep_their_rows_without_a_join(spark):
    """Candidates that share a place share what is left of them; deep ones without a page go."""
    deep = [(1, 1, 0, "a", '{"x":"real","y":"PRIMARY"}'), (1, 1, 0, "b", '{"z":"more"}'), (1, 1, 1, "c", '["PRIMARY"]'), (None, 1, 2, "d", '["kept"]'), (1, 2, 0, "e", '[1,null]')]
    cands = spark.createDataFrame([(d, p, o, n, "t", v, "o", "object") for d, p, o, n, v in deep] + [(1, 1, 5, "f", "t", "flat", "string", "object")], CAND_SCHEMA)
    got = reconcile.scrub_candidates(cands)
    assert got.columns == cands.columns and "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.page_no, r.ord, r.name, r.value) for r in got.collect()) == [
        (1, 0, "a", '{"x":"real","z":"more"}'), (1, 0, "b", '{"x":"real","z":"more"}'), (1, 5, "f", "flat"), (2, 0, "e", "[1]")]


def test_merged_names_are_settled_with_the_page(spark):
    """Of two paths with one name the later one stands, and no fill is shuffled for it."""
    fields = spark.createDataFrame([(1, 1, 0, "A", "box", None, "text", "t", "bbox")], "doc_id long, page_no int, ord long, name string, v_str string, v_bool boolean, ftype string, tooltip string, source string")
    responses = spark.createDataFrame([(1, 1, '{"a_b":{"c":"first"},"a":{"b_c":"second","d":true}}')], "doc_id long, page_no int, content string")
    merged = reconcile.merge(fields, responses)[0]
    assert sorted((r.name, r.v_str, r.v_bool, r.source) for r in merged.collect()) == [("A", "box", None, "bbox"), ("vlm_a_b_c", "second", None, "vlm"), ("vlm_a_d", None, True, "vlm")]
    assert "max_by" not in merged._jdf.queryExecution().optimizedPlan().toString()


WORD_SCHEMA = "doc_id int, page_no int, ord int, text string, x0 double, x1 double, top double, bottom double"


def _beside(words, labels):
    """Every word against every cross of its page."""
    num = lambda v: float("nan") if v is None else v
    near = lambda w, c: abs(num(c[6]) - num(w[6])) < 6 and any(abs(num(e) - num(w[4])) < 30 for e in (c[4], c[5]))
    return {(w[0], w[1], label) for w in words for c in words for label in labels if w[3] and c[3] and w[0] is not None and w[1] is not None and
            w[:2] == c[:2] and label.lower() in w[3].lower() and c[3].strip() == "X" and near(w, c)}


@pytest.mark.parametrize("parts, most", [(1, 20_000), (5, 20_000), (1, 3)])
def test_marks_are_those_beside_a_word(spark, monkeypatch, parts, most):
    rnd = random.Random(parts + most)
    monkeypatch.setattr(spatial, "PAGE_WORDS", most)
    words = []
    for d in [*range(12), None]:
        for p in (1, 2, None):
            for o in range(rnd.randrange(25)):
                x0, top = rnd.choice([None, float("nan"), *[rnd.uniform(0, 200) for _ in range(20)]]), rnd.choice([None, *[rnd.uniform(0, 60) for _ in range(20)]])
                words.append((d, p, o, rnd.choice(["X", " X ", "xX", "Yes", "no YES", "other", None, "maybe x"]), x0, None if x0 is None else x0 + rnd.choice([6.0, 40.0]), top, 0.0))
    labels = ["yes", "No", "x", "absent"]
    df = spark.createDataFrame(words, WORD_SCHEMA).coalesce(1)
    df = df.repartition(parts, "ord") if parts > 1 else df
    want = _beside(words, labels)
    got = [tuple(r) for r in spatial.marked_labels(df, labels).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20


def test_marks_are_read_where_the_words_lie(spark, monkeypatch):
    """No word is dealt or joined, be the batches ever so small; a label that is given twice counts once."""
    words = [(d, p, o, t, x, x + 6.0, 10.0, 18.0) for d in range(6) for p in (1, 2) for o, (t, x) in enumerate([("Yes", 0.0), ("X", 20.0), ("far no", 100.0), ("word", 25.0)])]
    df = spark.createDataFrame(words, WORD_SCHEMA).coalesce(1)
    conf, joined = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    was = spark.conf.get(conf)
    monkeypatch.setattr(type(df), "join", lambda self, other, *a, f=type(df).join, **k: joined.append(other) or f(self, other, *a, **k))
    spark.conf.set(conf, "3")
    try:
        got = spatial.marked_labels(df, ["yes", "no", "yes"]).collect()
    finally:
        spark.conf.set(conf, was)
    assert sorted(map(tuple, got)) == [(d, p, "yes") for d in range(6) for p in (1, 2)] and not joined


@pytest.mark.parametrize("parts", [1, 4])
def test_checked_options_shuffle_no_word(spark, monkeypatch, parts):
    """Options come in their own order; words are joined only where a page lies in several places."""
    words = [(d, 1, o, t, x, x + 6.0, 10.0, 18.0) for d in range(5) for o, (t, x) in enumerate([("No", 0.0), ("X", 20.0), ("Yes", 30.0), ("far", 200.0), (f"last {d}", 210.0)])]
    df, joined = spark.createDataFrame(words, WORD_SCHEMA).repartition(parts, *(["ord"] if parts > 1 else [])), []
    monkeypatch.setattr(type(df), "join", lambda self, other, *a, f=type(df).join, **k: joined.append(other) or f(self, other, *a, **k))
    got = spatial.checked_options(df.sortWithinPartitions("doc_id", "ord"), [("yes", "Y"), ("last", "L"), ("no", "N")]).collect()
    assert sorted((r.doc_id, r.options) for r in got) == [(d, ["Y", "N"]) for d in range(5)] and bool(joined) == (parts > 1)
