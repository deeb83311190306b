"""Typed values out of strings. Unparseable input gives NULL, except `parse_date`, which returns it unchanged."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS, blank_to_null, col, let, strip

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def number(c: Column | str) -> Column:
    """Plain decimal or scientific notation, nothing else; 'nan' and 'inf' are not numbers here."""
    s = strip(col(c).cast("string"))
    return F.when(s.rlike(NUMBER), s.try_cast("double"))


def safe_int(c: Column | str) -> Column:
    return number(F.replace(col(c).cast("string"), F.lit(","), F.lit(""))).try_cast("bigint")


def safe_float(c: Column | str) -> Column:
    return number(F.translate(col(c).cast("string"), ",$", ""))


def _iso(c: Column, fmt: str) -> Column:
    return F.date_format(F.try_to_timestamp(c, F.lit(fmt)), "yyyy-MM-dd")


def date_or_null(c: Column | str) -> Column:
    """ISO date of M/D/YYYY, M/D/YY (69-99 in the 1900s), YYYY-M-D, D/M/YYYY where M/D fails, M-D-YYYY."""

    s = strip(c)
    year = F.right(s, F.lit(2))
    long_year = F.concat(F.regexp_extract(s, r"^(.*/)\d{2}$", 1), F.when(year >= "69", F.lit("19")).otherwise(F.lit("20")), year)
    dated = (
        F.when(s.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.coalesce(_iso(s, "M/d/yyyy"), _iso(s, "d/M/yyyy")))
        .when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), _iso(s, "yyyy-M-d"))
        .when(s.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$"), _iso(long_year, "M/d/yyyy"))
        .when(s.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$"), _iso(s, "M-d-yyyy"))
    )
    return F.when(F.length(s).between(6, 10), dated)


def parse_date(c: Column | str) -> Column:
    s = blank_to_null(strip(c))
    return F.coalesce(date_or_null(s), s)


def compare_date(c: Column | str) -> Column:
    """As `date_or_null`, and timestamps count by their date part."""
    return date_or_null(F.substring_index(strip(c), "T", 1))


def suffix_money(amount: Column, unit: Column) -> Column:
    factor = F.when(F.upper(unit) == "K", 1000.0).when(F.upper(unit) == "M", 1000000.0).otherwise(1.0)
    return number(F.replace(amount, F.lit(","), F.lit(""))) * factor


def group(c: Column | str, pattern: str, idx: int = 1) -> Column:
    """Regex group, NULL where the pattern or the group does not match."""
    return blank_to_null(F.regexp_extract(col(c), pattern, idx))


def city_state_zip(c: Column | str) -> Column:
    """'City, ST 12345[-6789]' -> struct(city, state, zip); NULL fields elsewhere."""
    pattern = rf"^([A-Za-z .'-]+),{WS}*([A-Z]{{2}}){WS}+(\d{{5}}(?:-\d{{4}})?){WS}*$"
    return let(strip(c), lambda s: F.struct(
        strip(group(s, pattern, 1)).alias("city"), group(s, pattern, 2).alias("state"), group(s, pattern, 3).alias("zip")))


def full_address(c: Column | str) -> Column:
    """'Street[, Suite], City, ST 12345' -> struct(street, city, state, zip); line breaks count as commas."""
    pattern = rf"^(.+?),{WS}*([A-Za-z .'-]+),{WS}*([A-Z]{{2}}){WS}+(\d{{5}}(?:-\d{{4}})?){WS}*$"
    one_line = F.regexp_replace(strip(c), rf"{WS}*\n{WS}*", ", ")
    return let(one_line, lambda s: F.struct(
        strip(group(s, pattern, 1)).alias("street"), strip(group(s, pattern, 2)).alias("city"),
        group(s, pattern, 3).alias("state"), group(s, pattern, 4).alias("zip")))


def email_timestamp(c: Column | str) -> Column:
    """'Jan 5, 2026, 4:10 PM' anywhere in the cell; no-break and narrow spaces count as spaces."""
    plain = F.translate(col(c), "  ", "  ")
    found = F.regexp_extract(plain, r"(\w+ \d+, \d+, \d+:\d+\s*[AP]M)", 1)
    tidy = F.regexp_replace(found, r"\s*([AP]M)$", " $1")
    return F.try_to_timestamp(tidy, F.lit("MMM d, yyyy, h:mm a"))
