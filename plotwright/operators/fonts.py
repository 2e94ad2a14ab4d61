"""Font heights from contour heights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Contours that count for a page and for a tile, where ``seen`` says their order.
PAGE_CONTOURS, TILE_CONTOURS = 4000, 2000


def _usable(contours: DataFrame, key: str, height: Column, most: int) -> DataFrame:
    rows = contours
    if "seen" in contours.columns:
        rows = rows.where(F.col("seen") < most)
    rows = rows.where((F.col("h") >= 4) & (F.col("h") <= (height * 0.2).cast("int")))
    by = W.partitionBy(key)
    return rows.withColumns({"r": F.row_number().over(by.orderBy("h")) - 1, "n": F.count(F.lit(1)).over(by)})


def page_font(contours: DataFrame, key: str, height: Column) -> DataFrame:
    """(key, font): the median of the middle 60 percent of usable heights; keys without one are left out (0)."""
    rows = _usable(contours, key, height, PAGE_CONTOURS)
    low, high = (F.col("n") * 0.2).cast("int"), (F.col("n") * 0.8).cast("int")
    return rows.where((F.col("r") >= low) & (F.col("r") < F.greatest(low + 1, high))).groupBy(key).agg(F.expr("percentile(h, 0.5)").alias("font"))


def tile_font(contours: DataFrame, key: str, height: Column) -> DataFrame:
    """(key, font): the upper median of usable heights."""
    rows = _usable(contours, key, height, TILE_CONTOURS)
    return rows.where(F.col("r") == F.floor(F.col("n") / 2)).select(key, F.col("h").cast("double").alias("font"))
