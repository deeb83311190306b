"""Property schedules: spreadsheet cells -> typed buildings and locations.

sheet_cells(doc_id, sheet, sheet_ord, row_no, col_no, value), non-empty cells only or all of them. A header is resolved
once per sheet; data cells meet it by column number and collapse to one row per sheet row in a single aggregation.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import number, safe_float, safe_int
from ..functions.text import blank_to_null, strip
from ..rules import schedules as rules
from ..session import materialize
from .ordered import number_rows

SHEET = ["doc_id", "sheet"]


def _has_text(c: str) -> Column:
    return strip(F.coalesce(F.col(c), F.lit(""))) != ""


def row_fill(cells: DataFrame) -> DataFrame:
    """(doc_id, sheet, sheet_ord, row_no, n_filled, row_text): one row per sheet row."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col_no", F.coalesce("value", F.lit("")).alias("v")))), lambda c: c["v"]), " ")
    return cells.groupBy(*SHEET, "sheet_ord", "row_no").agg(F.count_if(_has_text("value")).alias("n_filled"), F.lower(text).alias("row_text"))


def best_sheet(cells: DataFrame, least: int = rules.SHEET_ROW_CELLS) -> DataFrame:
    """(doc_id, sheet): the sheet with most rows of at least `least` filled cells; ties go to the first."""
    rows = cells.groupBy(*SHEET, "sheet_ord", "row_no").agg((F.count_if(_has_text("value")) >= least).alias("full"))
    sheets = rows.groupBy(*SHEET, "sheet_ord").agg(F.count_if("full").alias("n")).where("n > 0")
    return sheets.groupBy("doc_id").agg(F.max_by("sheet", F.struct("n", -F.col("sheet_ord"))).alias("sheet"))


def header_row(rows: DataFrame) -> DataFrame:
    """(doc_id, sheet, header_row): first row that holds both words of one of the pairs."""
    hit = reduce(lambda a, b: a | b, [F.contains("row_text", F.lit(x)) & F.contains("row_text", F.lit(y)) for x, y in rules.HEADER_PAIRS])
    return rows.where(hit).groupBy(*SHEET).agg(F.min("row_no").alias("header_row"))


def resolve_columns(header_cells: DataFrame, columns: dict[str, list[str]] | None = None, exclude: dict[str, list[str]] | None = None) -> DataFrame:
    """(doc_id, sheet, col_no, targets): which logical columns a sheet column can serve, with ranks.

    header_cells: (doc_id, sheet, col_no, header). An exact alias beats an alias inside the header; `exclude` lists
    headers a logical column may not take by substring (an alias like "Building" is part of "Building #").
    """
    columns, exclude = columns or rules.COLUMNS, exclude or {}
    # A repeated header keeps its first position and reads its last column.
    named = header_cells.withColumn("header", strip("header")).where("header <> ''").groupBy(*SHEET, "header").agg(
        F.min("col_no").alias("place"), F.max("col_no").alias("col_no"))
    low = F.lower("header")

    def ranks(logical: str, aliases: list[str]) -> Column:
        exact, part = F.lit(None), F.lit(None)
        for i, alias in reversed(list(enumerate(aliases))):
            exact = F.when(F.col("header") == alias, F.lit(i)).otherwise(exact)
            part = F.when(F.contains(low, F.lit(alias.lower().strip())), F.lit(i)).otherwise(part)
        if exclude.get(logical):
            part = F.when(~F.col("header").isin(exclude[logical]), part)
        rank = lambda stage, i: F.when(i.isNotNull(), F.struct(F.lit(stage).alias("stage"), i.alias("alias"), F.col("place").cast("int").alias("place")))
        # A header may serve by substring at several aliases; its exact and its best substring rank are enough.
        return F.struct(F.lit(logical).alias("logical"), F.coalesce(rank(0, exact), rank(1, part)).alias("rank"))

    options = F.filter(F.array(*[ranks(k, v) for k, v in columns.items()]), lambda o: o["rank"].isNotNull())
    return named.select(*SHEET, "col_no", "header", F.map_from_entries(options).alias("targets"))


def schedule_rows(cells: DataFrame, columns: dict[str, list[str]] | None = None, exclude: dict[str, list[str]] | None = None) -> DataFrame:
    """(doc_id, sheet, row_no, n_filled, has_loc, one column per logical column): data rows of the best sheet."""
    columns = columns or rules.COLUMNS
    sheet = cells.join(best_sheet(cells), SHEET)
    head = header_row(row_fill(sheet))
    marked = sheet.join(head, SHEET)
    resolved = resolve_columns(marked.where("row_no = header_row").select(*SHEET, "col_no", F.col("value").alias("header")), columns, exclude)
    loc = resolved.groupBy(*SHEET).agg(F.coalesce(F.bool_or(F.col("header").isin(columns["loc"])), F.lit(False)).alias("has_loc"))
    data = marked.where("row_no > header_row").join(resolved.select(*SHEET, "col_no", "targets"), [*SHEET, "col_no"], "left")
    present = F.col("value").isNotNull() & (F.col("value") != "")
    picks = [F.min_by("value", F.when(present, F.try_element_at("targets", F.lit(k)))).alias(k) for k in columns]
    rows = data.groupBy(*SHEET, "row_no").agg(F.count_if(_has_text("value")).alias("n_filled"), *picks)
    return rows.where(F.col("n_filled") >= rules.DATA_ROW_CELLS).join(loc, SHEET)


def numbered_rows(rows: DataFrame) -> DataFrame:
    """Add location_number: the location column where the sheet has one (rows without a number go), else row order over
    the rows that have a name or street."""
    rows = materialize(rows)
    own = rows.where("has_loc").withColumn("location_number", safe_int("loc")).where("location_number IS NOT NULL")
    bare = rows.where(~F.col("has_loc") & F.coalesce("named", "street").isNotNull())
    return own.unionByName(number_rows(bare, SHEET, ["row_no"], "location_number"))


def buildings(rows: DataFrame) -> DataFrame:
    """One typed building per schedule row."""
    text = lambda c: strip(c)
    positive = lambda c: F.when(safe_float(c) > 0, safe_float(c))
    bnum = safe_int("bldg")
    return rows.select(
        "doc_id", "row_no", "location_number", F.when(bnum.isNull() | (bnum == 0), F.lit(1)).otherwise(bnum).cast("bigint").alias("building_number"),
        safe_int("year").alias("year_built"), text("construction").alias("construction"), text("roof").alias("roof"),
        safe_float("sqft").alias("sqft"), safe_int("stories").alias("stories"), safe_int("units").alias("units"),
        text("occupancy").alias("occupancy"), (safe_float("sprinkler") >= rules.FULL_SPRINKLER).alias("fully_sprinklered"),
        positive("rcv").alias("building_limit"), positive("bpp").alias("bpp_limit"), positive("bi").alias("business_income"))


def zip_code(c: str) -> Column:
    return F.coalesce(number(c).try_cast("bigint").cast("string"), strip(c))


def locations(rows: DataFrame) -> DataFrame:
    """(doc_id, location_number, location_name, street, city, state, zip, county, n_buildings): name and address of the
    first row of each location."""
    default = F.concat(F.lit("Location "), F.col("location_number"))
    first_line = strip(F.substring_index(F.coalesce("named", default), "\n", 1))
    name = F.coalesce(blank_to_null(F.regexp_replace(first_line, r"[;,\s]+$", "")), default)
    place = F.struct(name.alias("location_name"), strip("street").alias("street"), strip("city").alias("city"), strip("state").alias("state"),
                     zip_code("zip").alias("zip"), strip("county").alias("county"))
    return rows.groupBy("doc_id", "location_number").agg(F.min_by(place, "row_no").alias("p"), F.count(F.lit(1)).alias("n_buildings")).select(
        "doc_id", "location_number", "p.*", "n_buildings")


def nested_locations(rows: DataFrame) -> DataFrame:
    """(doc_id, location_number, ..., buildings array): the nested form of one location, buildings in row order."""
    b = buildings(rows)
    inner = [c for c in b.columns if c not in ("doc_id", "location_number", "row_no")]
    grouped = b.groupBy("doc_id", "location_number").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("row_no", *inner))), lambda x: F.struct(*[x[c].alias(c) for c in inner])).alias("buildings"))
    return locations(rows).join(grouped, ["doc_id", "location_number"])
