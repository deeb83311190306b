"""Loss runs: claim tables, policy terms and totals."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import group, parse_date, safe_float
from ..functions.text import blank_to_null, column_key, strip, title_case
from ..rules import schedules as rules
from .leaves import flatten

PAGE = ["doc_id", "page_no"]
TABLE = [*PAGE, "table_no"]


def claim_cells(cells: DataFrame) -> DataFrame:
    """(doc_id, page_no, table_no, row_no, key, value): data cells below the first claim header row of each table.

    cells: (doc_id, page_no, table_no, row_no, col_no, text). A repeated header reads its last column; rows without any
    value are no claims.
    """
    text = F.lower(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col_no", F.coalesce("text", F.lit("")).alias("t")))), lambda c: c["t"]), " "))
    rows = cells.groupBy(*TABLE, "row_no").agg(text.alias("row_text"))
    is_head = reduce(lambda a, b: a | b, [F.contains("row_text", F.lit(h)) for h in rules.CLAIM_HEADERS])
    head = rows.where(is_head).groupBy(*TABLE).agg(F.min("row_no").alias("header_row"))
    marked = cells.join(head, TABLE)
    keys = marked.where("row_no = header_row AND text <> ''").select(*TABLE, "col_no", column_key("text").alias("key")).groupBy(*TABLE, "key").agg(
        F.max("col_no").alias("col_no"))
    data = marked.where("row_no > header_row").join(keys, [*TABLE, "col_no"])
    filled = data.where(blank_to_null("text").isNotNull()).select(*TABLE, "row_no").distinct()
    return data.join(filled, [*TABLE, "row_no"], "left_semi").select(*TABLE, "row_no", "key", strip("text").alias("value"))


def claim_records(pairs: DataFrame) -> DataFrame:
    """(doc_id, page_no, table_no, row_no, record map): the header-keyed record of each claim row."""
    return pairs.groupBy(*TABLE, "row_no").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("record"))


def _picked(spec: dict[str, list[str]]) -> list[Column]:
    """First non-empty value over alternate keys, per output column, in one aggregation."""
    def rank(keys: list[str]) -> Column:
        out = F.lit(None)
        for i, k in reversed(list(enumerate(keys))):
            out = F.when(F.col("key") == k, F.lit(i)).otherwise(out)
        return F.when(blank_to_null("value").isNotNull(), out)
    return [F.min_by("value", rank(keys)).alias(name) for name, keys in spec.items()]


def _normalized(rows: DataFrame, at: list[str], source: str) -> DataFrame:
    return rows.select("doc_id", F.lit(source).alias("origin"), *at, "claim_no", title_case(blank_to_null("status")).alias("status"),
                       parse_date("loss_date").alias("loss_date"), "description", safe_float("paid").alias("paid"),
                       safe_float("reserve").alias("reserve"), safe_float("incurred").alias("incurred"))


def parsed_claims(pairs: DataFrame) -> DataFrame:
    rows = pairs.groupBy(*TABLE, "row_no").agg(*_picked(rules.PARSED_CLAIM))
    return _normalized(rows, ["page_no", "table_no", "row_no"], "parsed")


def model_claims(leaf_rows: DataFrame) -> DataFrame:
    """Claims of the model pages: the `claims` list, or `detail` where a page has no claims there."""
    s = F.col("steps")
    rows = leaf_rows.where(F.get(s, F.lit(0))["key"].isin(rules.MODEL_CLAIM_LISTS) & F.get(s, F.lit(1))["idx"].isNotNull())
    rows = rows.select(*PAGE, F.get(s, F.lit(0))["key"].alias("list"), F.get(s, F.lit(1))["idx"].alias("row_no"),
                       F.when(F.size(s) == 3, F.get(s, F.lit(2))["key"]).alias("key"), F.when(F.col("vtype") != "null", F.col("value")).alias("value"))
    has = rows.where(F.col("list") == rules.MODEL_CLAIM_LISTS[0]).select(*PAGE).distinct().withColumn("_has", F.lit(True))
    chosen = rows.join(has, PAGE, "left").where((F.col("list") == rules.MODEL_CLAIM_LISTS[0]) | F.col("_has").isNull())
    picked = chosen.where("key IS NOT NULL").groupBy(*PAGE, "row_no").agg(*_picked(rules.MODEL_CLAIM))
    return _normalized(picked.withColumn("table_no", F.lit(-1)), ["page_no", "table_no", "row_no"], "model")


def claims(parsed: DataFrame, model: DataFrame) -> DataFrame:
    """Parsed rows win for the whole document; only documents without any use the model's rows."""
    return parsed.unionByName(model.join(parsed.select("doc_id").distinct(), "doc_id", "left_anti"))


def policy_terms(leaf_rows: DataFrame) -> DataFrame:
    """(doc_id, page_no, ord, effective, expiration, claim_count): summary rows with at least one date.

    leaves: (doc_id, page_no, steps, value, vtype) of the model pages.
    """
    s = F.col("steps")
    rows = leaf_rows.where((F.get(s, F.lit(0))["key"] == "summary") & F.get(s, F.lit(1))["idx"].isNotNull() & (F.size(s) == 3))
    one = lambda k: F.max(F.when(F.get(s, F.lit(2))["key"] == k, F.when(F.col("vtype") != "null", F.col("value"))))
    terms = rows.groupBy(*PAGE, F.get(s, F.lit(1))["idx"].alias("ord")).agg(
        one("effective_date").alias("eff"), one("expiration_date").alias("exp"), one("claim_count").alias("claim_count"))
    both = strip("eff").rlike(rules.TERM_RANGE)
    return terms.select(
        *PAGE, "ord", parse_date(F.when(both, group(strip("eff"), rules.TERM_RANGE, 1)).otherwise(F.col("eff"))).alias("effective"),
        parse_date(F.when(both, group(strip("eff"), rules.TERM_RANGE, 2)).otherwise(F.col("exp"))).alias("expiration"), "claim_count").where(
        "effective IS NOT NULL OR expiration IS NOT NULL")


def latest_term(terms: DataFrame, typed: bool = False) -> DataFrame:
    """(doc_id, effective, expiration): the term with the highest expiration as text, first one on ties.

    `typed` ranks by date and leaves unparseable expirations last.
    """
    key = F.coalesce(F.col("expiration").try_cast("date").cast("string") if typed else F.col("expiration"), F.lit(""))
    return terms.groupBy("doc_id").agg(F.max_by(F.struct("effective", "expiration"), F.struct(key, -F.col("page_no"), -F.col("ord"))).alias("t")).select(
        "doc_id", "t.*")


def header_fields(leaf_rows: DataFrame) -> DataFrame:
    """(doc_id, carrier, policy_number, evaluation_date, lob) from the header of the first model page."""
    s = F.col("steps")
    first = leaf_rows.groupBy("doc_id").agg(F.min("page_no").alias("page_no"))
    head = leaf_rows.where((F.size(s) == 2) & (F.get(s, F.lit(0))["key"] == "header")).join(first, PAGE, "left_semi").select(
        "doc_id", F.get(s, F.lit(1))["key"].alias("key"), F.when(F.col("vtype") != "null", F.col("value")).alias("value"))
    spec = {"carrier": rules.CARRIER_KEYS, "policy_number": ["policy_number"], "valuation": ["valuation_date"]}
    return head.groupBy("doc_id").agg(*_picked(spec)).select(
        "doc_id", "carrier", "policy_number", parse_date("valuation").alias("evaluation_date"), F.lit(rules.LOSS_RUN_LOB).alias("lob"))


def loss_runs(documents: DataFrame, header: DataFrame, terms: DataFrame, claim_rows: DataFrame) -> DataFrame:
    """One row per loss run: header, latest term, claim count and the no-known-losses flag.

    documents: (doc_id, source_file); several files of one submission are several rows, each naming its file.
    """
    n = claim_rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_claims"))
    latest = latest_term(terms).select("doc_id", F.col("effective").alias("policy_effective"), F.col("expiration").alias("policy_expiration"))
    return documents.join(header, "doc_id", "left").join(latest, "doc_id", "left").join(n, "doc_id", "left").na.fill(0, ["n_claims"]).withColumn(
        "lob", F.coalesce("lob", F.lit(rules.LOSS_RUN_LOB))).withColumn("no_known_losses", F.col("n_claims") == 0)


def no_known_losses(documents: DataFrame, claim_rows: DataFrame) -> DataFrame:
    """(doc_id, no_known_losses) for every document."""
    having = claim_rows.select("doc_id").distinct().withColumn("_c", F.lit(True))
    return documents.select("doc_id").join(having, "doc_id", "left").select("doc_id", F.col("_c").isNull().alias("no_known_losses"))


def tag_sources(*runs: tuple[DataFrame, str]) -> DataFrame:
    """Loss runs of several files in one table, each row naming its file."""
    return reduce(lambda a, b: a.unionByName(b), [df.withColumn("source_file", F.lit(name)) for df, name in runs])


TOTALS = ["paid", "reserve", "expenses", "recovered", "incurred"]


def period_totals(claim_rows: DataFrame) -> DataFrame:
    """Claims and amounts per document, property and period, with subtotals (NULL period, NULL property).

    claim_rows: (doc_id, property, period, paid, reserve, expenses, recovered, incurred), amounts as decimals.
    """
    return claim_rows.rollup("doc_id", "property", "period").agg(
        F.count(F.lit(1)).alias("n_claims"), *[F.sum(c).alias(c) for c in TOTALS]).where("doc_id IS NOT NULL")


def stated_differences(computed: DataFrame, stated: DataFrame, on: list[str], tolerance: float = 0.005) -> DataFrame:
    """(on..., measure, stated, computed): stated totals that the rows do not add up to."""
    measures = [c for c in stated.columns if c not in on]
    joined = stated.alias("s").join(computed.alias("c"), on, "left")
    each = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"s.{m}").cast("double").alias("stated"), F.col(f"c.{m}").cast("double").alias("computed")) for m in measures])
    gap = F.abs(F.col("stated") - F.coalesce("computed", F.lit(0.0))) > tolerance
    return joined.select(*on, F.inline(each)).where(F.col("stated").isNotNull() & gap)


def model_leaves(responses: DataFrame, json: str = "content") -> DataFrame:
    return flatten(responses, PAGE, json)
