"""Binding operators to the given tables: one registry of queries, each with the SQL that must give the same rows.

Inputs are derived from the tables by SQL that both engines read; `{orders}` and the like stand for the tables.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..rules.tables import frame
from ..session import tune

PART_ROWS = 100_000
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]


@dataclass
class Inputs:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, template: str, **by: str) -> DataFrame:
        """The template over the tables; a table named in `by` is dealt by that column before it is read."""
        used = [name for name in TABLES if "{" + name + "}" in template]
        text = template.replace("{", "{{").replace("}", "}}")
        for name in used:
            text = text.replace("{{" + name + "}}", "{" + name + "}")
        tables = {name: self.table(name) for name in used}
        return self.spark.sql(text, **{name: self._spread(df, by[name]) if name in by else df for name, df in tables.items()})

    def _spread(self, rows: DataFrame, *keys: str) -> DataFrame:
        """Rows dealt by their keys into parts of at most about `PART_ROWS`: bytes say little, repetitive rows shrink to next to nothing."""
        return rows.repartition(self.parts(rows), *keys)

    def parts(self, rows: DataFrame) -> int:
        return max(-(-rows.count() // PART_ROWS), self.spark.sparkContext.defaultParallelism)

    def dealt(self, template: str, *keys: str) -> DataFrame:
        """Records dealt once by their key, at the head of a flow that works on each for long: a table of few row groups
        reaches all tasks, and the flow's later groupings begin from even partitions. The same at any size."""
        return self._spread(self.sql(template), *(keys or ("doc_id",)))

    def rows(self, schema: str, rows: list[tuple]) -> DataFrame:
        return frame(self.spark, schema, rows)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(template: str) -> str:
    for name in TABLES:
        template = template.replace("{" + name + "}", name)
    return template


def query(name: str, oracle: str | None = None):
    """Register a function of `Inputs` under `name`, with its reference SQL where there is one."""
    def register(fn: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Inputs(tune(spark), folder))
        if oracle is not None:
            ORACLES[name] = plain(oracle)
        return fn
    return register


def values(alias: str, columns: str, rows: list[tuple]) -> str:
    """Inline table of the reference SQL."""
    def lit(v):
        if v is None:
            return "NULL"
        return repr(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"
    return f"(VALUES {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) AS {alias}({columns})"


def rule_case(column: str, patterns: list[tuple[str, str]], default: str | None) -> str:
    """Reference SQL of 'first pattern that matches'."""
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    arms = " ".join(f"WHEN regexp_matches({column}, {quoted(p)}) THEN {quoted(l)}" for p, l in patterns)
    return f"CASE {arms} ELSE {'NULL' if default is None else quoted(default)} END"
