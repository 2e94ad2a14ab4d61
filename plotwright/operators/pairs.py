"""Spatial self-joins of the items on a page, by cells: equi-joins that Spark can deal out, no cross joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings


def page_metrics(items: DataFrame, page: str = "page_id", s: Settings = DEFAULT) -> DataFrame:
    """(page, median_h, grid_px, center_px): median box height and what follows from it for suppression."""
    height = F.greatest(F.lit(1), F.rint("y1") - F.rint("y0"))
    found = items.withColumn("_h", height).groupBy(page).agg(F.expr("percentile(_h, 0.5)").alias("median_h"))
    low, high = s.grid_px
    return found.withColumns(
        {
            "grid_px": F.greatest(F.lit(low), F.least(F.lit(high), F.rint(F.col("median_h") * s.grid_factor))).cast("long"),
            "center_px": F.rint(F.greatest(F.lit(float(s.center_px)), F.col("median_h") * s.center_factor)).cast("long"),
        }
    )


def _range(low: Column, high: Column, cell: Column) -> tuple[Column, Column]:
    first = F.floor(low / cell)
    return first, F.greatest(first, F.floor(F.greatest(F.lit(0), high - 1) / cell))


def neighbours(items: DataFrame, key: list[str], page: str = "page_id", cell: str = "grid_px", around: int = 1) -> DataFrame:
    """Pairs (a_*, b_*) of items (box, cell size) of a page whose cell ranges lie within ``around`` cells of each other, a before b by key.

    Both sides are dealt to cells (one side to the cells around as well) and meet by page and cell; a pair counts only in the
    first cell that it shares, so none comes twice and nothing has to be made distinct.  Boxes of whole numbers that overlap share
    a cell, so ``around`` 0 has all overlapping pairs, with a ninth of the copies.
    """
    x = _range(F.col("x0"), F.col("x1"), F.col(cell))
    y = _range(F.col("y0"), F.col("y1"), F.col(cell))
    rows = items.withColumns({"gx0": x[0], "gx1": x[1], "gy0": y[0], "gy1": y[1]})
    side = lambda p: rows.select(*[F.col(c).alias(f"{p}_{c}") for c in rows.columns])
    cells = lambda df, p, by: df.withColumn("cell_x", F.explode(F.sequence(F.col(f"{p}_gx0") - by, F.col(f"{p}_gx1") + by))).withColumn("cell_y", F.explode(F.sequence(F.col(f"{p}_gy0") - by, F.col(f"{p}_gy1") + by)))
    a, b = cells(side("a"), "a", around), cells(side("b"), "b", 0).withColumnsRenamed({"cell_x": "b_cell_x", "cell_y": "b_cell_y"})
    order = F.struct(*[F.col(f"a_{k}") for k in key]) < F.struct(*[F.col(f"b_{k}").alias(f"a_{k}") for k in key])
    met = (F.col(f"a_{page}") == F.col(f"b_{page}")) & (F.col("cell_x") == F.col("b_cell_x")) & (F.col("cell_y") == F.col("b_cell_y"))
    first = (F.col("cell_x") == F.greatest(F.col("a_gx0") - around, F.col("b_gx0"))) & (F.col("cell_y") == F.greatest(F.col("a_gy0") - around, F.col("b_gy0")))
    return a.join(b, met & order & first).drop("cell_x", "cell_y", "b_cell_x", "b_cell_y")
