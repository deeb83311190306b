"""Rule rows -> DataFrames. Rules are literals of this package, so their size is known when the plan is made."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _sql(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return repr(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def frame(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """An inline VALUES table: `schema` is 'name type, ...'."""
    columns = [part.strip().split(" ", 1) for part in schema.split(",")]
    names = ", ".join(f"`{n}`" for n, _ in columns)
    values = ", ".join("(" + ", ".join(map(_sql, row)) + ")" for row in rows)
    casts = ", ".join(f"CAST(`{n}` AS {t}) AS `{n}`" for n, t in columns)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})")
