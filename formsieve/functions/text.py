"""String normalizers, all Column -> Column."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Unicode defines it; neither Java's regex class nor trim alone knows all of it.
SPACES = " \t\n\r\f\v\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
WS = f"[{SPACES}]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate `value` once per row and use it several times inside `body`, also inside nested lambdas."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(SPACES))


def squeeze(c: Column | str) -> Column:
    return F.regexp_replace(col(c), rf"{WS}+", " ")


def norm_dedup(c: Column | str) -> Column:
    """Equality across sources: lower case, no dollar signs or commas, single spaces."""
    return F.trim(squeeze(F.replace(F.replace(F.lower(col(c)), F.lit("$"), F.lit("")), F.lit(","), F.lit(""))))


def norm_raw(c: Column | str) -> Column:
    """Comparison with page text: as norm_dedup, and date parts lose their leading zero."""
    out = F.regexp_replace(norm_dedup(c), r"\b0(\d)/", "$1/")
    return F.regexp_replace(out, r"/0(\d)\b", "/$1")


def norm_compare(c: Column | str) -> Column:
    return squeeze(F.lower(strip(c)))


def is_upper(c: Column | str) -> Column:
    """At least one cased character, and none in lower case."""
    c = col(c)
    return (F.upper(c) == c) & (F.lower(c) != c)


def title_case(c: Column | str) -> Column:
    """Capitalize every run of letters, not only those after a space."""
    runs = F.regexp_extract_all(col(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def camel_words(c: Column | str) -> Column:
    return F.lower(F.regexp_replace(col(c), r"([a-z])([A-Z])", "$1 $2"))


def short_label(c: Column | str, max_len: int = 40) -> Column:
    """Field name for display: no [0], no trailing part of up to two characters, front cut to `max_len`."""
    parts = F.split(F.replace(col(c), F.lit("[0]"), F.lit("")), "_")

    def render(p: Column) -> Column:
        kept = F.when(F.length(F.element_at(p, -1)) <= 2, F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0)))).otherwise(p)
        return F.array_join(kept, "_")

    return let(let(parts, render),
               lambda s: F.when(F.length(s) > max_len, F.concat(F.lit("…"), F.right(s, F.lit(max_len - 1)))).otherwise(s))


def column_key(c: Column | str) -> Column:
    """Table header cell -> record key."""
    out = F.replace(F.lower(strip(c)), F.lit(" "), F.lit("_"))
    out = F.replace(out, F.lit("#"), F.lit("no"))
    return F.translate(out, "/-", "__")


def safe_name_document(c: Column | str) -> Column:
    out = F.translate(F.replace(col(c), F.lit(" "), F.lit("_")), "()", "")
    return F.replace(F.replace(out, F.lit(".pdf"), F.lit("")), F.lit(".PDF"), F.lit(""))


def safe_name_path(c: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(col(c), r"[^A-Za-z0-9._-]+", "_"), r"^_+|_+$", "")


def after_colon(c: Column | str) -> Column:
    """`KEY:value` -> value; text without a colon is returned as it is."""
    c = col(c)
    return F.when(F.contains(c, F.lit(":")), strip(F.split(c, ":", 2)[1])).otherwise(c)


def blank_to_null(c: Column | str) -> Column:
    c = col(c)
    return F.when(c != "", c)
