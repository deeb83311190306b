"""E-mail threads: subject facts, deadlines, signatures and contacts.

paragraphs(doc_id, ord, style, text), `ord` unique within a document.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import date_or_null, email_timestamp, group, suffix_money
from ..functions.text import blank_to_null, strip
from ..rules import email as rules
from .ordered import running


def subject_facts(paragraphs: DataFrame) -> DataFrame:
    """(doc_id, subject, target_premium): the first paragraph is the subject."""
    first = paragraphs.groupBy("doc_id").agg(F.min_by("text", "ord").alias("subject"))
    return first.select("doc_id", "subject", suffix_money(group("subject", rules.TARGET, 1), F.regexp_extract("subject", rules.TARGET, 2)).alias("target_premium"))


def date_received(cells: DataFrame) -> DataFrame:
    """(doc_id, date_received): last timestamp of the first table. cells: (doc_id, table_no, row_no, col_no, text)."""
    first = cells.groupBy("doc_id").agg(F.min("table_no").alias("table_no"))
    stamps = cells.join(first, ["doc_id", "table_no"], "left_semi").select("doc_id", "row_no", "col_no", email_timestamp("text").alias("ts"))
    return stamps.where("ts IS NOT NULL").groupBy("doc_id").agg(F.max_by("ts", F.struct("row_no", "col_no")).alias("date_received"))


def quote_deadline(paragraphs: DataFrame) -> DataFrame:
    """(doc_id, quote_needed_by): 'ASAP', an ISO date, or the date text as written.

    A phrase may run over paragraph ends. Paragraphs of blanks and colons stand inside a phrase without ending it and are
    left out; of the one before, all that can matter is the opening word it ends with.
    """
    rows = paragraphs.where(F.col("text").isNotNull()).select("doc_id", "ord", F.lower("text").alias("t")).where(~F.rlike("t", F.lit(rules.INSIDE_PHRASE)))
    rows = running(rows, ["doc_id"], "ord", previous={"open": F.regexp_extract("t", rules.OPEN_PHRASE, 0)})
    urgent = reduce(lambda a, b: a | b, [F.contains("t", F.lit(w)) for w in rules.URGENT])
    found = group(F.concat_ws(" ", "open", "t"), rules.DEADLINE, 1)
    hits = rows.select("doc_id", "ord", urgent.alias("urgent"), found.alias("found"))
    facts = hits.groupBy("doc_id").agg(F.bool_or("urgent").alias("urgent"), F.min_by("found", F.when(F.col("found").isNotNull(), F.col("ord"))).alias("found"))
    return facts.select("doc_id", F.when(F.col("urgent"), rules.URGENT_LABEL).otherwise(F.coalesce(date_or_null("found"), F.col("found"))).alias(
        "quote_needed_by")).where("quote_needed_by IS NOT NULL")


def signature_lines(paragraphs: DataFrame, opener: Column | None = None, closer: Column | None = None) -> DataFrame:
    """(doc_id, session, ord, text): non-blank lines between a closing phrase and the next thread header or phrase.

    A line belongs to the latest opening line when no header line came after it; that line's position is the session.
    """
    line = strip("text")
    opens = F.col("text").isNotNull() & (line.rlike(rules.OPENER) if opener is None else opener)
    closes = F.col("text").isNotNull() & (line.rlike(rules.CLOSER) if closer is None else closer)
    rows = paragraphs.select("doc_id", "ord", "text", opens.alias("_open"), (closes & ~opens).alias("_close"))
    rows = running(rows, ["doc_id"], "ord", maxes={"session": F.when(F.col("_open"), F.col("ord")), "_end": F.when(F.col("_close"), F.col("ord"))})
    inside = F.col("session").isNotNull() & (F.col("session") > F.coalesce("_end", F.lit(-1))) & ~F.col("_open")
    return rows.where(inside & (strip("text") != "")).select("doc_id", "session", "ord", "text")


def signatures(lines: DataFrame) -> DataFrame:
    """(doc_id, session, name, title, company, email, phone, license, address): one row per signature with any detail.

    First match per detail, last one for the license; the title beside the name beats a line that looks like a title.
    `address` joins all address lines with ' | '.
    """
    s = strip("text")
    plain = ~F.contains(s, F.lit("@")) & (F.length(s) < rules.SHORT_LINE)
    title_line = F.when(s.rlike(rules.TITLE) & plain, s)
    company_line = F.when(s.rlike(rules.COMPANY) & plain, s)
    address = F.when(s.rlike(rules.ADDRESS_ZIP) | s.rlike(rules.ADDRESS_STREET), s)
    found = lines.select(
        "doc_id", "session", "ord", group(s, rules.EMAIL, 1).alias("email"), strip(group(s, rules.PHONE, 1)).alias("phone"),
        group(s, rules.LICENSE, 1).alias("license"), strip(group(s, rules.NAME_LINE, 1)).alias("name"),
        strip(group(s, rules.NAME_LINE, 3)).alias("beside"), title_line.alias("title_line"), company_line.alias("company"), address.alias("address"))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("ord")))
    listed = F.array_sort(F.collect_list(F.when(F.col("address").isNotNull(), F.struct("ord", "address"))))
    sigs = found.groupBy("doc_id", "session").agg(
        first("name").alias("name"), F.min_by("beside", F.when(F.col("name").isNotNull(), F.col("ord"))).alias("beside"),
        first("title_line").alias("title_line"), first("company").alias("company"), first("email").alias("email"), first("phone").alias("phone"),
        F.max_by("license", F.when(F.col("license").isNotNull(), F.col("ord"))).alias("license"),
        blank_to_null(F.array_join(F.transform(listed, lambda a: a["address"]), " | ")).alias("address"))
    details = ["name", "title", "company", "email", "phone", "license", "address"]
    return sigs.withColumn("title", F.coalesce("beside", "title_line")).select("doc_id", "session", *details).where(F.coalesce(*details).isNotNull())


def merge_signatures(sigs: DataFrame) -> DataFrame:
    """Signatures of one name become one: the first non-empty value per detail. Nameless ones stay apart."""
    details = ["title", "company", "email", "phone", "license", "address"]
    merged = sigs.where("name IS NOT NULL").groupBy("doc_id", "name").agg(
        F.min("session").alias("session"), *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("session"))).alias(c) for c in details])
    return merged.unionByName(sigs.where("name IS NULL").select(*merged.columns))


def contacts(sigs: DataFrame, existing: DataFrame, agent_side: str = rules.AGENT_SIDE) -> DataFrame:
    """(doc_id, side, type, name, title, email, phone) of the contacts to add.

    Company or title words (`agent_side`) place a contact on the agent's side, the rest on the insured's. A contact whose e-mail the
    side already has is left out; contacts without an e-mail are always added, and so are two new ones sharing one.
    existing: (doc_id, side, email).
    """
    words = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    agent = words("company").rlike(agent_side) | words("title").rlike(agent_side)
    rows = sigs.select("doc_id", F.when(agent, "agent").otherwise("insured").alias("side"),
                       F.when(agent, rules.CONTACT_TYPE).alias("type"), "name", "title", "email", "phone")
    known = existing.where("email IS NOT NULL AND email <> ''").select("doc_id", "side", "email").distinct()
    return rows.join(known, ["doc_id", "side", "email"], "left_anti").select("doc_id", "side", "type", "name", "title", "email", "phone")
