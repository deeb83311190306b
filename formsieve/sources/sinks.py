"""Writing extractions and submissions."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_extractions(extractions: DataFrame, path: str, fmt: str = "json") -> None:
    """One record per document, partitioned by document type; replaces only the types it writes."""
    extractions.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("doc_type").format(fmt).save(path)


def counts_by_type(extractions: DataFrame) -> DataFrame:
    """(doc_type, n_files): the summary that accompanies the master file."""
    return extractions.groupBy(F.coalesce("doc_type", F.lit("unknown")).alias("doc_type")).agg(F.count(F.lit(1)).alias("n_files"))


def as_json(records: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, content): the other columns as one JSON object without NULL members."""
    rest = [c for c in records.columns if c not in keys]
    return records.select(*keys, F.to_json(F.struct(*rest), {"ignoreNullFields": "true"}).alias("content"))


def write_submissions(records: DataFrame, path: str) -> None:
    records.write.mode("overwrite").option("ignoreNullFields", "true").json(path)
