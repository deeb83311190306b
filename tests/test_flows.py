"""The form and loss-run flows end to end on one invented page each."""
import json

import numpy as np

from formsieve.operators import lossrun, quality
from formsieve.plans import submission
from formsieve.plans.submission import form_fields, loss_run_claims
from formsieve.sources import sinks

WORD = "doc_id int, page_no int, ord int, text string, x0 double, x1 double, top double, bottom double"


def test_form_flow(spark):
    words = spark.createDataFrame([(1, 1, 0, "CARRIER", 300.0, 340.0, 78.0, 86.0), (1, 1, 1, "Alpha", 302.0, 330.0, 98.5, 106.0), (1, 1, 2, "Mutual", 333.0, 366.0, 98.4, 106.0)], WORD)
    text = spark.createDataFrame([(1, 1, "CARRIER Alpha Mutual ACORD 125 (2016/03)")], "doc_id int, page_no int, text string")
    pages = spark.createDataFrame([("acord_125", 0, "CARRIER SECTION")], "template string, tpage int, text string")
    tmpl_words = spark.createDataFrame([("acord_125", 0, 0, "CARRIER", 70.0)], "template string, tpage int, ord int, text string, top double")
    fields = spark.createDataFrame([("acord_125", 0, 0, "Insurer_FullName_A[0]", "/Tx", "insurer", 298.0, 695.0, 420.0, 704.0), ("acord_125", 0, 1, "Trust_TrustIndicator_A", "/Btn", "trust", 18.0, 620.0, 30.0, 632.0)],
                                   "template string, tpage int, ord int, name string, ftype string, tooltip string, x0 double, y0 double, x1 double, y1 double")
    answers = spark.createDataFrame([(1, 1, 'ok {"a":{"name":"alpha mutual","kind":"TRUST","city":"Springfield"}} done')], "doc_id int, page_no int, content string")
    merged, bad = form_fields(words, text, pages, tmpl_words, fields, answers)
    assert {(r["name"], r["v_str"], r["v_bool"], r["source"]) for r in merged.collect()} == {
        ("Insurer_FullName_A[0]", "Alpha Mutual", None, "bbox"), ("Trust_TrustIndicator_A", None, False, "bbox"), ("vlm_a_city", "Springfield", None, "vlm")}
    assert bad.count() == 0


def test_form_flow_with_unparsed_answers_and_pixels(spark):
    words = spark.createDataFrame([(1, p, 0, "CARRIER", 300.0, 340.0, 78.0, 86.0) for p in (1, 2)] + [(1, p, 1, "$1,250.00", 302.0, 330.0, 98.5, 106.0) for p in (1, 2)] +
                                  [(1, 1, 2, "X", 102.0, 108.0, 170.0, 178.0)], WORD)
    text = spark.createDataFrame([(1, p, "CARRIER ACORD 125 (2016/03)") for p in (1, 2)], "doc_id int, page_no int, text string")
    tmpl_pages = spark.createDataFrame([("acord_125", p, "CARRIER SECTION") for p in (0, 1)], "template string, tpage int, text string")
    tmpl_words = spark.createDataFrame([("acord_125", p, 0, "CARRIER", 70.0) for p in (0, 1)], "template string, tpage int, ord int, text string, top double")
    boxes = [("Policy_Amount_A[0]", "/Tx", "amount", 298.0, 695.0, 420.0, 704.0), ("Dark_A", "/Btn", "dark", 18.0, 620.0, 30.0, 632.0), ("Light_A", "/Btn", "light", 60.0, 620.0, 72.0, 632.0), ("Marked_A", "/Btn", "marked", 99.0, 620.0, 111.0, 632.0)]
    fields = spark.createDataFrame([("acord_125", p, i, *b) for p in (0, 1) for i, b in enumerate(boxes)],
                                   "template string, tpage int, ord int, name string, ftype string, tooltip string, x0 double, y0 double, x1 double, y1 double")
    answers = spark.createDataFrame([(1, 1, 'cut off {"a": {"total": "1,250.00", '), (1, 2, 'cut off {"a": ')], "doc_id int, page_no int, content string")
    image = np.full((792, 612), 255, np.uint8)
    image[:, :40] = 0
    rasters = spark.createDataFrame([(1, 1, bytearray(image.tobytes()), 612)], "doc_id int, page_no int, gray binary, w int")
    merged, bad = form_fields(words, text, tmpl_pages, tmpl_words, fields, answers, rasters=rasters, dpi=72)
    pages = {r["page_no"] for r in merged.collect()}
    assert {(r["page_no"], r["issue"]) for r in bad.collect()} == {(p, "amount_not_in_vlm") for p in pages - {1}} and 1 in pages
    assert {(r["name"], r["v_bool"], r["source_detail"].split(":pixel")[0]) for r in merged.where("page_no = 1 AND ftype = 'checkbox'").collect()} == {
        ("Dark_A", True, "bbox"), ("Light_A", False, "bbox"), ("Marked_A", True, "bbox:text_x")}


def test_loss_run_flow(spark):
    cells = spark.createDataFrame([(1, 1, 0, r, c, v) for r, row in enumerate([["Claim #", "Total Paid"], ["C-0001", "$1,250.50"], ["", ""]]) for c, v in enumerate(row)],
                                  "doc_id int, page_no int, table_no int, row_no int, col_no int, text string")
    text = spark.createDataFrame([(1, 1, "Claim # Total Paid C-0001 $1,250.50"), (2, 1, "(cid:1) x")], "doc_id int, page_no int, text string")
    answers = spark.createDataFrame([(1, 1, '{"detail":[{"claim_number":"C-0001","amount_paid":1250.5,"note":"77777"}]}'), (2, 1, '{"detail":[{"claim_number":"D-0002"}]}')], "doc_id int, page_no int, content string")
    claims, checked = loss_run_claims(cells, text, answers)
    assert {(r["doc_id"], r["origin"], r["claim_no"], r["paid"]) for r in claims.collect()} == {(1, "parsed", "C-0001", 1250.5), (2, "model", "D-0002", None)}
    assert {(r["doc_id"], r["value"], r["status"]) for r in checked.collect()} == {
        (1, "C-0001", "confirmed"), (1, "1250.5", "confirmed"), (1, "77777", "not_in_raw_text"), (2, "D-0002", "skipped")}


def test_submission_record(spark):
    table = lambda schema, *rows: spark.createDataFrame(list(rows), schema)
    fields = [("street", "1 Oak St"), ("city", "Springfield"), ("state", "NY"), ("zip", "10001"), ("insured_name", "Alpha LLC"), ("entity_type", "LLC"), ("contact_name", "Kim"), ("contact_email", "kim@example.com")]
    names = ["naics", "sic", "fein", "phone", "website", "street2", "agent_name", "npn", "agent_street", "agent_street2", "agent_city", "agent_state", "agent_zip", "contact_phone",
             "effective_date", "expiration_date", "prior_policy_number"]
    application = spark.createDataFrame([(1, *[v for _, v in fields], *[None] * len(names), ["Property"])],
                                        "doc_id int, " + ", ".join(f"{c} string" for c in [n for n, _ in fields] + names) + ", lob array<string>")
    schedule = [c for c in ("named", "street", "city", "state", "zip", "county", "bldg", "year", "construction", "roof", "sqft", "stories", "units", "occupancy", "sprinkler", "rcv", "bpp", "bi")]
    row = lambda n, *v: (1, n, 1, *v)
    rows = spark.createDataFrame([row(3, "Oak Court;", "1 Oak St", "Springfield", "NY", "10001", None, "1", "1990", "Frame", None, "1200", "2", "8", "Apartments", "100", "500000", None, "0"),
                                  row(4, None, None, None, None, None, None, "2", None, None, None, None, None, None, None, None, None, "9000", "700")],
                                 "doc_id int, row_no int, location_number int, " + ", ".join(f"{c} string" for c in schedule))
    hazards = table("doc_id int, page_no int, suffix string, occupancy_class string, exposure double", (1, 2, "_A", "60010", 8.0))
    safeguards = table("doc_id int, safeguards array<string>", (1, ["Sprinklers"]))
    places = submission.location_records(rows, hazards, safeguards)
    claims = table("doc_id int, page_no int, table_no int, row_no int, claim_no string, status string, loss_date string, description string, paid double, reserve double, incurred double",
                   (1, 1, 0, 2, "C-2", "Open", None, None, 5.0, None, None), (1, 1, 0, 1, "C-1", "Closed", "2024-01-02", "fire", 1.0, 0.0, 1.0))
    terms = table("doc_id int, page_no int, ord int, effective string, expiration string, claim_count string", (1, 1, 0, "2023-01-01", "2024-01-01", "2"))
    header = table("doc_id int, carrier string, policy_number string, evaluation_date string, lob string", (1, "Mutual", "P1", "2024-05-01", "General Liability"))
    runs = lossrun.loss_runs(table("doc_id int, source_file string", (1, "a.pdf")), header, terms, claims)
    people = table("doc_id int, side string, type string, name string, title string, email string, phone string", (1, "agent", "Producer", "Pat", "Broker", "pat@example.com", None), (1, "insured", None, "Lee", None, None, "555"))
    facts = table("doc_id int, subject string, target_premium double", (1, "New account", 12000.0))
    record = submission.assemble(table("doc_id int", (1,), (2,)), application, loss_runs=submission.loss_run_records(runs, terms, claims), locations=places, contacts=people, facts=facts)
    whole = {r.doc_id: json.loads(r.content) for r in sinks.as_json(record, ["doc_id"]).collect()}
    got = whole[1]
    assert got["Submission"]["Notes"] == "New account" and got["Submission"]["PropertySelected"] and not got["Submission"]["GLSelected"]
    assert [c["Name"] for c in got["Agent"]["Contacts"]] == ["Kim", "Pat"] and got["Insured"]["Contacts"] == [{"Name": "Lee", "Phone": "555"}]
    assert got["LossRuns"] == [{"Carrier": "Mutual", "PolicyNumber": "P1", "EvaluationDate": "2024-05-01", "PolicyEffectiveDate": "2023-01-01", "PolicyExpirationDate": "2024-01-01", "LOB": "General Liability",
                                "Claims": [{"ClaimNumber": "C-1", "ClaimStatus": "Closed", "LossDate": "2024-01-02", "Description": "fire", "AmountPaid": 1.0, "ReserveAmount": 0.0, "TotalIncurred": 1.0},
                                           {"ClaimNumber": "C-2", "ClaimStatus": "Open", "AmountPaid": 5.0}],
                                "PolicyTerms": [{"effective": "2023-01-01", "expiration": "2024-01-01", "claim_count": "2"}]}]
    place = got["Locations"][0]
    assert (place["LocationNumber"], place["LocationName"], place["Address"]) == (1, "Oak Court", {"Type": "Physical", "Street": "1 Oak St", "City": "Springfield", "State": "NY", "ZipCode": "10001"})
    assert place["GeneralLiability"] == [{"OccupancyClass": "60010", "Exposure": 8.0}]
    one, two = place["Buildings"]
    assert one["Building"] == {"BuildingCoverageFlag": True, "BuildingLimit": 500000.0, "Building100RcValue": 500000.0} and one["ProtectiveSafeguards"] == ["Sprinklers"]
    assert one["Description"].startswith("Apartments") and one["FullySprinklered"] is True and "Bpp" not in one and "BusinessIncomeLimit" not in one
    assert two["Bpp"]["BppLimit"] == 9000.0 and two["BusinessIncomeLimit"] == 700.0 and "Description" not in two
    assert whole[2]["Submission"]["Status"] and "LossRuns" not in whole[2]
    cover = quality.coverage(quality.field_presence(sinks.as_json(record, ["doc_id"]), ["doc_id"]), table("doc_id int", (1,)), ["doc_id"])
    found = {(r.section, r.field): (r.populated, r.n_items) for r in cover.collect()}
    assert found[("Locations[]", "Address")] == (1, 1) and found[("Buildings[]", "BuildingNumber")] == (2, 2) and found[("LossRuns[]", "Carrier")] == (1, 1)
