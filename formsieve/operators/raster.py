"""Dark-pixel ratio of checkboxes on page rasters: the one numeric kernel that runs in Arrow batches."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..rules import fields as rules

PAGE = ["doc_id", "page_no"]


def _ratio(image: np.ndarray, box: dict) -> float | None:
    height, width = image.shape
    left, right = max(0, box["px0"]), min(width, box["px1"])
    upper, lower = max(0, box["py0"]), min(height, box["py1"])
    w, h = right - left, lower - upper
    if w < rules.PIXEL_MIN_CROP or h < rules.PIXEL_MIN_CROP:
        return None
    dx, dy = max(1, int(w * rules.PIXEL_INSET)), max(1, int(h * rules.PIXEL_INSET))
    inner = image[upper + dy:lower - dy, left + dx:right - dx]
    if min(inner.shape) < rules.PIXEL_MIN_INNER:
        return None
    return float((inner < rules.PIXEL_DARK).mean())


def _ratios(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, pages, ords, values = [], [], [], []
        columns = [batch.column(n) for n in ("doc_id", "page_no", "gray", "w", "boxes")]
        for doc, page, gray, width, boxes in zip(*columns):
            image = np.frombuffer(gray.as_buffer(), dtype=np.uint8).reshape(-1, width.as_py())
            for box in boxes.as_py():
                docs.append(doc.as_py())
                pages.append(page.as_py())
                ords.append(box["ord"])
                values.append(_ratio(image, box))
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs, columns[0].type), pa.array(pages, columns[1].type), pa.array(ords, pa.int64()),
             pa.array(values, pa.float64())], names=["doc_id", "page_no", "ord", "ratio"])


def dark_ratios(rasters: DataFrame, boxes: DataFrame) -> DataFrame:
    """(doc_id, page_no, ord, ratio). rasters: (doc_id, page_no, gray binary, w int); boxes: pixel rectangles px0..py1.

    The boxes of a page travel as one array (their number is set by the form), so a raster is shipped once.
    """
    per_page = boxes.groupBy(*PAGE).agg(F.collect_list(F.struct(F.col("ord").cast("bigint").alias("ord"), "px0", "py0", "px1", "py1")).alias("boxes"))
    joined = rasters.select(*PAGE, "gray", F.col("w").cast("int").alias("w")).join(per_page, PAGE)
    types = dict(rasters.select(*PAGE).dtypes)
    return joined.mapInArrow(_ratios, f"doc_id {types['doc_id']}, page_no {types['page_no']}, ord bigint, ratio double")


def undecided(marks: DataFrame, dpi: float = rules.PIXEL_DPI) -> DataFrame:
    """Pixel boxes of the checkboxes without an X: the only ones worth looking at."""
    rect = geo.image_rect(F.col("bx0"), F.col("by0"), F.col("bx1"), F.col("by1"), F.col("dy"), dpi)
    return marks.where("NOT checked").select(*PAGE, "ord", rect.alias("r")).select(*PAGE, "ord", "r.*")
