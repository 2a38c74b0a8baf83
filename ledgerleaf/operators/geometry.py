"""Form geometry: point rectangles to pixel boxes and full-width bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import SERVICE_FIELD

PAGE = (612.0, 792.0)
# fixed values: the standard form's bands on a page of 2550 x 3300 pixels (300 dpi): x0, y0, x1, y1
STANDARD_PAGE = (2550, 3300)
STANDARD_BANDS = {"top": (0, 0, 2550, 2254), "service": (0, 2154, 2550, 2847), "bottom": (0, 2747, 2550, 3300)}
POINTS_PER_INCH = 72.0


def _px(c: Column) -> Column:
    return F.bround(c).cast("int")


def field_rects(widgets: DataFrame) -> DataFrame:
    """Union of each field's widgets; widgets (name, x0, y0, x1, y1) in points, y upwards, corners in any order."""
    return widgets.groupBy("name").agg(
        F.min(F.least("x0", "x1")).alias("x0"), F.min(F.least("y0", "y1")).alias("y0"), F.max(F.greatest("x0", "x1")).alias("x1"), F.max(F.greatest("y0", "y1")).alias("y1")
    )


def pixel_boxes(rects: DataFrame, dpi: int = 300, page: tuple[float, float] = PAGE) -> DataFrame:
    s, h = dpi / POINTS_PER_INCH, page[1]
    return rects.select(
        "name",
        _px(F.col("x0") * s).alias("x0"),
        _px((h - F.col("y1")) * s).alias("y0"),
        _px(F.col("x1") * s).alias("x1"),
        _px((h - F.col("y0")) * s).alias("y1"),
    )


def bands(rects: DataFrame, dpi: int = 300, page: tuple[float, float] = PAGE, overlap: float = 0.015) -> DataFrame:
    """(region, x0, y0, x1, y1): top, service and bottom, a little overlapping; no service field: no rows."""
    w, h = (int(round(x * dpi / POINTS_PER_INCH)) for x in page)
    pad = int(round(overlap * h))
    row = pixel_boxes(rects, dpi, page).where(F.col("name").rlike(SERVICE_FIELD)).agg(
        F.min("y0").alias("a"),
        F.max("y1").alias("b"),
    ).where("a is not null")
    clamp = lambda c: F.greatest(F.lit(0), F.least(F.lit(h), c))
    cuts = (
        ("top", F.lit(0), clamp(F.col("a") + pad)),
        ("service", clamp(F.col("a") - pad), clamp(F.col("b") + pad)),
        ("bottom", clamp(F.col("b") - pad), F.lit(h)),
    )
    return row.select(F.inline(F.array(*(F.struct(F.lit(n).alias("region"), F.lit(0).alias("x0"), y0.alias("y0"), F.lit(w).alias("x1"), y1.alias("y1")) for n, y0, y1 in cuts))))


def standard_bands(pages: DataFrame, model_bands: tuple[str, ...] = tuple(STANDARD_BANDS)) -> DataFrame:
    """pages (width, height, ..) with region, x0, y0, x1, y1: the standard bands scaled to each page's size, cut to whole pixels."""

    def scaled(i: int, values: tuple) -> Column:
        side = F.col("width") if i % 2 == 0 else F.col("height")
        return F.floor(F.lit(values[i]) * (side / F.lit(STANDARD_PAGE[i % 2]))).cast("int")

    rows = F.array(*(F.struct(
        F.lit(n).alias("region"),
        *(scaled(i, STANDARD_BANDS[n]).alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))),
    ) for n in model_bands))
    return pages.select("*", F.inline(rows))
