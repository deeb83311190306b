"""Which documents and pages are still to be done, and which version of a record counts."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def complete_documents(pages: DataFrame) -> DataFrame:
    """(doc_id): documents whose pages all parsed. pages: (doc_id, page_no, status), the last attempt of each page."""
    return pages.groupBy("doc_id").agg(F.bool_and(F.col("status") == "OK").alias("_ok")).where("_ok").select("doc_id")


def pending(documents: DataFrame, done: DataFrame, overwrite: bool = False) -> DataFrame:
    """Documents without finished output; all of them with `overwrite`."""
    return documents if overwrite else documents.join(done.select("doc_id").distinct(), "doc_id", "left_anti")


def last_attempts(attempts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per page: the latest OK attempt, else the latest attempt."""
    keys = keys or ["doc_id", "page_no"]
    rest = [c for c in attempts.columns if c not in keys]
    best = attempts.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct((F.col("status") == "OK").cast("int"), "attempt")).alias("r"))
    return best.select(*keys, "r.*")


def retry_worklist(attempts: DataFrame, max_attempts: int = 2, keys: list[str] | None = None) -> DataFrame:
    """Pages that never parsed and have attempts left."""
    keys = keys or ["doc_id", "page_no"]
    state = attempts.groupBy(*keys).agg(F.bool_or(F.col("status") == "OK").alias("ok"), F.max("attempt").alias("attempts"))
    return state.where(~F.col("ok") & (F.col("attempts") < max_attempts)).drop("ok")


def latest_versions(records: DataFrame, keys: list[str], modified: str = "modified_ts") -> DataFrame:
    """The record of the latest modification per key."""
    rest = [c for c in records.columns if c not in keys]
    return records.groupBy(*keys).agg(F.max_by(F.struct(*rest), modified).alias("r")).select(*keys, "r.*")
