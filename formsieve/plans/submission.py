"""The three flows end to end: forms to merged fields, loss runs to claims and discrepancies, blocks to submissions."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null
from ..operators import classify, leaves, lossrun, mapping, raster, reconcile, scrub, sov, spatial
from ..rules import fields as field_rules
from ..rules import mapping as rules
from ..session import materialize
from ..sources.readers import ingest_responses

CONTACTS = "array<struct<Type: string, Name: string, Title: string, Phone: string, Email: string>>"
#: Columns that order a list and are no part of the record.
INTERNAL = {"LossRuns": ["source_file"]}


def form_fields(words: DataFrame, page_text: DataFrame, template_pages: DataFrame, tmpl_words: DataFrame, tmpl_fields: DataFrame,
                responses: DataFrame, ratios: DataFrame | None = None, available: list[str] | None = None,
                rasters: DataFrame | None = None, dpi: float = field_rules.PIXEL_DPI) -> tuple[DataFrame, DataFrame]:
    """(merged fields, discrepancies) of application forms: page map, box reading, model values, merge.

    `available` names the templates that exist (by default those of `template_pages`): an edition without one falls back to
    its older one, and a page of neither stays unmapped. Checkboxes without an X are decided by the pixels of `rasters`
    (doc_id, page_no, gray, w), rendered at `dpi`, or by dark-pixel `ratios` that are known already.
    """
    if available is None:
        available = [r.template for r in template_pages.select("template").distinct().collect()]  # one name per known form
    page_map = materialize(classify.page_map(page_text, template_pages, available))
    offsets = materialize(spatial.anchor_offset(words, tmpl_words, page_map))
    if ratios is None and rasters is not None:
        ratios = materialize(raster.dark_ratios(rasters, raster.undecided(spatial.box_marks(words, tmpl_fields, offsets), dpi)))
    boxes = materialize(spatial.page_fields(words, tmpl_fields, offsets, ratios))
    answers = materialize(ingest_responses(responses).select("doc_id", "page_no", "status", "data", "raw"))
    parsed = answers.where("status = 'OK'").select("doc_id", "page_no", F.col("data").alias("content"))
    return reconcile.merge(boxes, parsed, page_map, scrub.checkbox_labels(tmpl_fields), unparsed=answers.where("status = 'RAW'"))


def loss_run_claims(cells: DataFrame, page_text: DataFrame, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(claims, checked leaves) of loss runs; the scrubbed leaves of the model pages serve both branches."""
    parsed = ingest_responses(responses).where("status = 'OK'").select("doc_id", "page_no", F.col("data").alias("content"))
    leaf_rows = materialize(scrub.scrub_leaves(leaves.flatten(parsed, ["doc_id", "page_no"])))
    claims = lossrun.claims(lossrun.parsed_claims(lossrun.claim_cells(cells)), lossrun.model_claims(leaf_rows))
    return claims, reconcile.text_check(leaf_rows, classify.readable_text(page_text))


def _list(rows: DataFrame, name: str, order: list[str]) -> DataFrame:
    """(doc_id, name array<struct>): the rows of a document in order; nested records hold them by nature."""
    rest = [c for c in rows.columns if c != "doc_id"]
    at = F.struct(*[F.col(c) for c in order])
    listed = F.array_sort(F.collect_list(F.struct(at.alias("at"), F.struct(*rest).alias("r"))))
    return rows.groupBy("doc_id").agg(F.transform(listed, lambda x: x["r"]).alias(name))


def _block(*pairs: tuple[str, Column]) -> Column:
    return F.struct(*[c.alias(n) for n, c in pairs])


def location_records(rows: DataFrame, hazards: DataFrame | None = None, safeguards: DataFrame | None = None) -> DataFrame:
    """Locations of a document in schema form: (doc_id, LocationNumber, LocationName, Address, GeneralLiability, Buildings).

    rows: numbered schedule rows (`sov.numbered`); hazards and safeguards hold for all locations and buildings of a document.
    """
    b = sov.buildings(rows).withColumn("about", mapping.building_description(*[F.col(c) for c in ("occupancy", "stories", "construction", "year_built", "units")]))
    b = b.join(safeguards, "doc_id", "left") if safeguards is not None else b.withColumn("safeguards", F.lit(None).cast("array<string>"))
    limit, bpp = F.col("building_limit"), F.col("bpp_limit")
    building = _block(
        ("BuildingNumber", F.col("building_number")), ("Description", blank_to_null("about")), ("YearOfConstruction", F.col("year_built")),
        ("ConstructionType", F.col("construction")), ("RoofType", F.col("roof")), ("TotalSqFt", F.col("sqft")), ("NoOfStories", F.col("stories")),
        ("TotalUnits", F.col("units")), ("OccupancyType", F.col("occupancy")), ("FullySprinklered", F.col("fully_sprinklered")), ("ProtectiveSafeguards", F.col("safeguards")),
        ("Building", F.when(limit.isNotNull(), _block(("BuildingCoverageFlag", F.lit(True)), ("BuildingLimit", limit), ("Building100RcValue", limit)))),
        ("Bpp", F.when(bpp.isNotNull(), _block(("BppCoverageFlag", F.lit(True)), ("BppLimit", bpp)))), ("BusinessIncomeLimit", F.col("business_income")))
    listed = b.groupBy("doc_id", "location_number").agg(F.transform(F.array_sort(F.collect_list(F.struct("row_no", building.alias("b")))), lambda x: x["b"]).alias("Buildings"))
    parts = ["street", "city", "state", "zip", "county"]
    address = F.when(F.coalesce(*parts).isNotNull(), _block(("Type", F.lit("Physical")), *zip(("Street", "City", "State", "ZipCode", "County"), map(F.col, parts))))
    places = sov.locations(rows).join(listed, ["doc_id", "location_number"])
    if hazards is None:
        places = places.withColumn("gl", F.lit(None).cast("array<struct<OccupancyClass: string, Exposure: double>>"))
    else:
        item = F.struct("page_no", "suffix", F.struct(F.col("occupancy_class").alias("OccupancyClass"), F.col("exposure").cast("double").alias("Exposure")).alias("h"))
        places = places.join(hazards.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["h"]).alias("gl")), "doc_id", "left")
    return places.select("doc_id", F.col("location_number").alias("LocationNumber"), F.col("location_name").alias("LocationName"), address.alias("Address"),
                         F.col("gl").alias("GeneralLiability"), "Buildings")


def loss_run_records(runs: DataFrame, terms: DataFrame, claim_rows: DataFrame) -> DataFrame:
    """Loss runs in schema form, claims and policy terms inside: (doc_id, source_file, Carrier, .., Claims, PolicyTerms).

    runs: `lossrun.loss_runs`, one row per loss-run document.
    """
    claim = _block(*[(n, F.col(c)) for n, c in (("ClaimNumber", "claim_no"), ("ClaimStatus", "status"), ("LossDate", "loss_date"), ("Description", "description"),
                                                 ("AmountPaid", "paid"), ("ReserveAmount", "reserve"), ("TotalIncurred", "incurred"))])
    listed = lambda rows, at, what, name: rows.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(*at, what.alias("x")))), lambda r: r["x"]).alias(name))
    claims = listed(claim_rows, ["page_no", "table_no", "row_no"], claim, "Claims")
    spans = listed(terms, ["page_no", "ord"], _block(("effective", F.col("effective")), ("expiration", F.col("expiration")), ("claim_count", F.col("claim_count"))), "PolicyTerms")
    rows = runs.join(claims, "doc_id", "left").join(spans, "doc_id", "left")
    return rows.select("doc_id", "source_file", F.col("carrier").alias("Carrier"), F.col("policy_number").alias("PolicyNumber"), F.col("evaluation_date").alias("EvaluationDate"),
                       F.col("policy_effective").alias("PolicyEffectiveDate"), F.col("policy_expiration").alias("PolicyExpirationDate"), F.col("lob").alias("LOB"),
                       F.coalesce("Claims", F.array().cast(claims.schema["Claims"].dataType)).alias("Claims"), "PolicyTerms",
                       F.when(F.col("no_known_losses"), True).alias("NoKnownLossesLast5Years"))


def assemble(documents: DataFrame, application: DataFrame, loss_runs: DataFrame | None = None, locations: DataFrame | None = None,
             parties: DataFrame | None = None, other_insureds: DataFrame | None = None, attachments: DataFrame | None = None,
             contacts: DataFrame | None = None, facts: DataFrame | None = None) -> DataFrame:
    """One nested submission per document; absent lists are NULL, which the JSON sink leaves out.

    Every list is grouped on its own before the joins, so the joins are one row to one row. facts: one row per document
    with subject, target_premium, date_received, quote_needed_by, operations, aggregate_income as far as known. contacts are
    those of `email.contacts`: the agent's side joins Agent.Contacts behind the application's own, the rest Insured.Contacts.
    loss_runs and locations are taken as `loss_run_records` and `location_records` give them.
    """
    lists = {"LossRuns": (loss_runs, ["source_file"]), "Locations": (locations, ["LocationNumber"]), "SecuredParties": (parties, ["first_page", "name"]),
             "OtherNamedInsureds": (other_insureds, ["suffix"]), "Attachments": (attachments, ["file_name"])}
    rows = documents.select("doc_id").join(application, "doc_id", "left")
    person = _block(("Type", F.col("type")), ("Name", F.col("name")), ("Title", F.col("title")), ("Phone", F.col("phone")), ("Email", F.col("email")))
    for side in ("agent", "insured"):
        name = f"_{side}_contacts"
        rows = rows.withColumn(name, F.lit(None).cast(CONTACTS)) if contacts is None else rows.join(
            contacts.where(F.col("side") == side).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("name", "email", person.alias("p")))), lambda x: x["p"])
                                                                        .cast(CONTACTS).alias(name)), "doc_id", "left")
    for name, (df, order) in lists.items():
        if df is not None:
            rows = rows.join(_list(df, name, order), "doc_id", "left")
    known = []
    if facts is not None:
        known = [c for c in facts.columns if c != "doc_id"]
        rows = rows.join(facts, "doc_id", "left")
    fact = lambda c: F.col(c) if c in known else F.lit(None).cast("string")
    lob = F.coalesce("lob", F.array().cast("array<string>"))
    gl, prop = F.array_contains(lob, "General Liability"), F.array_contains(lob, "Property")
    address = _block(("Type", F.lit("Mailing")), ("Street", F.col("street")), ("Street2", F.col("street2")), ("City", F.col("city")),
                     ("State", F.col("state")), ("ZipCode", F.col("zip")))
    has_address = F.coalesce("street", "city", "state", "zip").isNotNull()
    agent_address = _block(("Type", F.lit("Mailing")), ("Street", F.col("agent_street")), ("Street2", F.col("agent_street2")),
                           ("City", F.col("agent_city")), ("State", F.col("agent_state")), ("ZipCode", F.col("agent_zip")))
    has_agent_address = F.coalesce("agent_street", "agent_street2", "agent_city", "agent_state", "agent_zip").isNotNull()
    has_contact = F.coalesce("contact_name", "contact_phone", "contact_email").isNotNull()
    contact = _block(("Type", F.lit("Producer")), ("Name", F.col("contact_name")), ("Title", F.lit(None).cast("string")), ("Phone", F.col("contact_phone")),
                     ("Email", F.col("contact_email")))
    own = F.when(has_contact, F.array(contact)).otherwise(F.array()).cast(CONTACTS)
    listed = lambda people: F.when(F.size(people) > 0, people)
    return rows.select(
        "doc_id",
        _block(("Status", F.lit(rules.SUBMISSION_STATUS)), ("GLSelected", gl), ("PropertySelected", prop), ("ProductType", F.lit(rules.PRODUCT_TYPE)),
               ("Notes", fact("subject")), ("TargetPremium", fact("target_premium")), ("DateReceived", fact("date_received")), ("QuoteNeededBy", fact("quote_needed_by"))).alias("Submission"),
        _block(("RenewalFlag", F.lit(rules.RENEWAL_FLAG)), ("EffectiveDate", F.col("effective_date")), ("ExpirationDate", F.col("expiration_date")),
               ("PriorPolicyNumber", F.col("prior_policy_number")), ("LOB", F.col("lob"))).alias("PolicyInfo"),
        _block(("Name", F.col("insured_name")), ("EntityType", F.col("entity_type")), ("NAICSCode", F.col("naics")), ("SICCode", F.col("sic")),
               ("FEIN", F.col("fein")), ("BusinessPhone", F.col("phone")), ("Website", F.col("website")), ("DescriptionOfOperations", fact("operations")),
               ("Addresses", F.when(has_address, F.array(address))), ("Contacts", F.col("_insured_contacts"))).alias("Insured"),
        _block(("Name", F.col("agent_name")), ("NationalProducerNumber", F.col("npn")), ("Addresses", F.when(has_agent_address, F.array(agent_address))),
               ("Contacts", listed(F.concat(own, F.coalesce("_agent_contacts", F.array().cast(CONTACTS)))))).alias("Agent"),
        _block(("CoverageSelected", gl)).alias("GeneralLiability"),
        _block(("CoverageSelected", prop), ("AggregateBusinessIncomeLimit", fact("aggregate_income"))).alias("Property"),
        *[F.transform(n, lambda x: x.dropFields(*INTERNAL[n])).alias(n) if n in INTERNAL else F.col(n) for n, (df, _) in lists.items() if df is not None])
