"""Parsing and normalizing rules, one case per pitfall."""
from pyspark.sql import functions as F

from formsieve.functions import parse, text
from formsieve.operators import scrub


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn("v").alias("r")).first()["r"]


def test_dates(spark):
    cases = {"5/1/2024": "2024-05-01", "05/01/24": "2024-05-01", "1/2/75": "1975-01-02", "1/2/68": "2068-01-02", "2024-5-1": "2024-05-01",
             "25/12/2024": "2024-12-25", "12-31-2024": "2024-12-31", "2/30/2024": "2/30/2024", " soon ": "soon", "": None, None: None}
    for raw, want in cases.items():
        assert one(spark, raw, parse.parse_date) == want, raw
    assert one(spark, "2026-05-01T10:11:12", parse.compare_date) == "2026-05-01"


def test_numbers(spark):
    ints = {"12.9": 12, "-12.9": -12, "1,200": 1200, "$5": None, "nan": None, "inf": None, "": None, "x": None, "1e3": 1000}
    for raw, want in ints.items():
        assert one(spark, raw, parse.safe_int) == want, raw
    floats = {" $1,250.50 ": 1250.5, "-5": -5.0, "nan": None, "1d": None, ".5": 0.5}
    for raw, want in floats.items():
        assert one(spark, raw, parse.safe_float) == want, raw


def test_text(spark):
    assert one(spark, "closed w/payment", text.title_case) == "Closed W/Payment"
    assert one(spark, "Paid $1,250.50  on\n03/09/2025", text.norm_raw) == "paid 1250.50 on 3/9/2025"
    assert one(spark, " A B ", text.norm_compare) == "a b"
    assert one(spark, "Party_LegalEntity_TrustIndicator_A[0]", text.short_label) == "Party_LegalEntity_TrustIndicator"
    assert one(spark, "X" * 50, text.short_label) == "…" + "X" * 39
    assert one(spark, "Status/Type", text.column_key) == "status_type"
    assert one(spark, " Claim # ", text.column_key) == "claim_no"
    assert one(spark, "a (b) c.pdf", text.safe_name_document) == "a_b_c"
    assert one(spark, "(é) a b", text.safe_name_path) == "a_b"


def test_address(spark):
    got = one(spark, "12 Oak Ave, Suite 5 \nSpringfield, NY 10001", parse.full_address)
    assert got.asDict() == {"street": "12 Oak Ave, Suite 5", "city": "Springfield", "state": "NY", "zip": "10001"}
    assert one(spark, "Springfield, NY 10001-1234", parse.city_state_zip)["zip"] == "10001-1234"
    assert one(spark, "nowhere", parse.city_state_zip)["city"] is None


def test_label_and_garbage(spark):
    labels = {"1. ANY OTHER BUSINESS VENTURES": True, "POOL AREA AND DECK 0 2 48925 T 1": False, "Springfield, NY 10001": False, "PRODUCER'S SIGNATURE:": True,
              "GREENFIELD APARTMENTS PARTNERS LLC": False, "APPLICANT INFORMATION SECTION DETAILS": True, "AB": False, None: False, "1 MAIN": False}
    for raw, want in labels.items():
        assert one(spark, raw, scrub.is_label) is want, raw
    garbage = {"PRODUCER'S SIGNATURE": True, "  ": True, "☐": True, "Is this a question?": True, "Short?": False, "I SELECT this": True, "Beta Homes LLC": False}
    for raw, want in garbage.items():
        assert one(spark, raw, scrub.is_garbage) is want, raw


def test_amount(spark):
    rows = [("5,000", "string", True), ("5 000", "string", True), ("about 5", "string", False), ("1", "number", True), ("true", "boolean", False)]
    df = spark.createDataFrame(rows, "v string, t string, want boolean")
    assert df.where(scrub.is_amount("v", "t") != F.col("want")).count() == 0
