"""Reading package folders, extraction files, grids and model responses."""
from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import strip
from ..operators.classify import suffix

PAGE = ["doc_id", "page_no"]


def scan_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, file_name, suffix, modified_ts, n_bytes) of every file below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("file_name"), suffix(name).alias("suffix"),
                        F.col("modificationTime").alias("modified_ts"), F.col("length").alias("n_bytes"))


def read_json_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(file_name, content): one JSON text per file."""
    raw = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    return raw.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file_name"), F.col("value").alias("content"))


def document_pages(documents: DataFrame, key: str = "doc_id", json: str = "content") -> DataFrame:
    """(key, page_no, shape, content): page data of the three extraction shapes.

    merged: `pages` is an object keyed page_N; list: `pages` is a list of {page, data}; bundle: `vlm_pages` is one.
    """
    entry = "array<struct<page:int,data:string>>"
    body = F.col(json)
    pages, bundle = F.get_json_object(body, "$.pages"), F.get_json_object(body, "$.vlm_pages")
    is_map = F.startswith(F.ltrim(F.coalesce(pages, F.lit(""))), F.lit("{"))
    merged = F.transform(F.map_entries(F.from_json(pages, "map<string,string>")), lambda e: F.struct(
        F.regexp_extract(e["key"], r"^page_(\d+)$", 1).try_cast("int").alias("page"), e["value"].alias("data")))
    shape = F.when(bundle.isNotNull(), "bundle").when(is_map, "merged").otherwise("list")
    rows = F.when(bundle.isNotNull(), F.from_json(bundle, entry)).when(is_map, merged).otherwise(F.from_json(pages, entry))
    return documents.select(key, shape.alias("shape"), F.explode(rows).alias("p")).where("p.page IS NOT NULL").select(
        key, F.col("p.page").alias("page_no"), "shape", F.col("p.data").alias("content"))


def _matches(name: Column, groups: dict[str, list[str]]) -> Column:
    low = F.lower(name)
    return F.filter(F.array(*[F.when(F.exists(F.array(*map(F.lit, parts)), lambda p: F.contains(low, F.lower(p))), F.lit(g))
                              for g, parts in groups.items()]), lambda g: g.isNotNull())


def find_files(files: DataFrame, groups: dict[str, list[str]], scope: list[str] | None = None) -> DataFrame:
    """(scope..., grp, file_name): every file whose name holds one of the group's parts, in any case."""
    scope = scope or []
    return files.select(*scope, "file_name", F.explode(_matches(F.col("file_name"), groups)).alias("grp"))


def find_first(files: DataFrame, groups: dict[str, list[str]], scope: list[str] | None = None) -> DataFrame:
    """(scope..., grp, file_name): the first such file by name."""
    return find_files(files, groups, scope).groupBy(*(scope or []), "grp").agg(F.min("file_name").alias("file_name"))


def sheet_records(cells: DataFrame) -> DataFrame:
    """(doc_id, sheet, row_no, key, value): spreadsheet rows below the header as header-keyed values.

    cells: (doc_id, sheet, row_no, col_no, value). The first row with text is the header; blank headers are dropped; a
    repeated header reads its last column. Rows and columns without any cell do not appear in the input.
    """
    filled = F.col("value").isNotNull()
    has_text = strip(F.coalesce("value", F.lit(""))) != ""
    head = cells.where(has_text).groupBy("doc_id", "sheet").agg(F.min("row_no").alias("header_row"))
    marked = cells.join(head, ["doc_id", "sheet"])
    names = marked.where(F.col("row_no") == F.col("header_row")).where(has_text).select("doc_id", "sheet", "col_no", strip("value").alias("key")).groupBy(
        "doc_id", "sheet", "key").agg(F.max("col_no").alias("col_no"))
    return marked.where(filled & (F.col("row_no") > F.col("header_row"))).join(names, ["doc_id", "sheet", "col_no"]).select(
        "doc_id", "sheet", "row_no", "key", strip("value").alias("value"))


def record_maps(records: DataFrame) -> DataFrame:
    """(doc_id, sheet, row_no, record map)."""
    return records.groupBy("doc_id", "sheet", "row_no").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("record"))


def clean_paragraphs(paragraphs: DataFrame) -> DataFrame:
    """Trimmed paragraphs with text."""
    return paragraphs.withColumn("text", strip("text")).where("text <> ''")


def paragraph_counts(paragraphs: DataFrame, cells: DataFrame) -> DataFrame:
    """(doc_id, n_paragraphs, n_tables): tables count when any cell has text."""
    n_p = clean_paragraphs(paragraphs).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_paragraphs"))
    n_t = cells.where(strip(F.coalesce("text", F.lit(""))) != "").select("doc_id", "table_no").distinct().groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_tables"))
    return n_p.join(n_t, "doc_id", "full_outer").na.fill(0, ["n_paragraphs", "n_tables"])


def _span(text: str | None, opening: str, closing: str) -> str | None:
    """First balanced bracket span; brackets inside strings count too."""
    start = text.find(opening) if text else -1
    if start < 0:
        return None
    depth = 0
    for found in re.finditer(f"[{re.escape(opening + closing)}]", text[start:]):
        depth += 1 if found.group() == opening else -1
        if depth == 0:
            return text[start:start + found.end()]
    return None


@F.pandas_udf(StructType([StructField("object", StringType()), StructField("array", StringType())]))
def _spans(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"object": [_span(t, "{", "}") for t in texts], "array": [_span(t, "[", "]") for t in texts]})


def ingest_responses(responses: DataFrame, first_bracket: bool = False, raw_limit: int | None = None) -> DataFrame:
    """Add status OK, RAW or ERROR, `data` (JSON text when OK) and `raw` (the text when RAW, or its first `raw_limit`
    characters).

    The first balanced object decides, else the first balanced array. `first_bracket`: whichever opens first decides
    alone. A repeated key inside an object makes the text RAW.
    """
    rows = responses.withColumn("_s", _spans("content"))
    obj, arr = F.col("_s.object"), F.col("_s.array")
    valid = lambda c: F.when(F.try_parse_json(c).isNotNull(), c)
    if first_bracket:
        brace, bracket = F.instr("content", "{"), F.instr("content", "[")
        data = F.when((brace > 0) & ((bracket == 0) | (brace < bracket)), valid(obj)).otherwise(valid(arr))
    else:
        data = F.coalesce(valid(obj), valid(arr))
    rows = rows.withColumn("data", data).drop("_s")
    status = F.when(F.coalesce("content", F.lit("")) == "", "ERROR").when(F.col("data").isNotNull(), "OK").otherwise("RAW")
    return rows.withColumn("status", status).withColumn("raw", F.when(F.col("status") == "RAW", F.col("content") if raw_limit is None else F.left("content", F.lit(raw_limit))))


