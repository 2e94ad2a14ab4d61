"""Document words against recognised items: the stateless part of reconciliation, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..functions.geometry import Box, iof, iou
from ..functions.text import where_at_least

CELL = 128


def candidates(words: DataFrame, items: DataFrame, page: str = "page_id", s: Settings = DEFAULT) -> DataFrame:
    """Word-item pairs (w_*, o_*) of a page that can be in the same place: both dealt to cells, words as far as the tolerance reaches."""
    reach = F.greatest(F.lit(s.pdf_center), F.greatest(F.lit(1.0), F.col("w_y1") - F.col("w_y0")) * s.pdf_center_factor) + 1
    w = words.select(*[F.col(c).alias(f"w_{c}") for c in words.columns])
    o = items.select(*[F.col(c).alias(f"o_{c}") for c in items.columns])
    cell = lambda c: F.floor(c / CELL)
    w = w.withColumns({"wx0": cell(F.col("w_x0") - reach), "wy0": cell(F.col("w_y0") - reach)})
    w = w.withColumn("cx", F.explode(F.sequence("wx0", cell(F.col("w_x1") + reach)))).withColumn("cy", F.explode(F.sequence("wy0", cell(F.col("w_y1") + reach))))
    o = o.withColumns({"ox0": cell(F.col("o_x0")), "oy0": cell(F.col("o_y0"))})
    o = o.withColumn("dx", F.explode(F.sequence("ox0", F.greatest("ox0", cell(F.col("o_x1")))))).withColumn("dy", F.explode(F.sequence("oy0", F.greatest("oy0", cell(F.col("o_y1"))))))
    met = (F.col(f"w_{page}") == F.col(f"o_{page}")) & (F.col("cx") == F.col("dx")) & (F.col("cy") == F.col("dy"))
    first = (F.col("cx") == F.greatest("wx0", "ox0")) & (F.col("cy") == F.greatest("wy0", "oy0"))
    # Cheap and necessary: boxes that are further apart than the tolerance reaches neither overlap nor have close middles.
    wide = (F.col("o_x1") >= F.col("w_x0") - reach) & (F.col("o_x0") <= F.col("w_x1") + reach) & (F.col("o_y1") >= F.col("w_y0") - reach) & (F.col("o_y0") <= F.col("w_y1") + reach)
    return w.join(o, met & first & wide).drop("cx", "cy", "dx", "dy", "wx0", "wy0", "ox0", "oy0")


def scored(pairs: DataFrame, threshold: float | None = None, s: Settings = DEFAULT) -> DataFrame:
    """Adds score to the pairs that stand in the same place: where it is 1 or more."""
    a, b = Box.of("o_"), Box.of("w_")
    tall = lambda x: F.greatest(F.lit(1.0), x.y1 - x.y0)
    tolerance = F.greatest(F.lit(s.pdf_center), F.least(tall(a), tall(b)) * s.pdf_center_factor)
    (ax, ay), (bx, by) = a.middle(), b.middle()
    hit = F.when((F.abs(ax - bx) <= tolerance) & (F.abs(ay - by) <= tolerance), 1.0).otherwise(0.0)
    threshold = max(1e-6, s.pdf_iou if threshold is None else threshold)
    return pairs.withColumn("score", where_at_least(F.greatest(iou(a, b) / threshold, iof(a, b) / 0.5, hit), 1.0))


def best_match(words: DataFrame, items: DataFrame, key: list[str], order: list[str], page: str = "page_id") -> DataFrame:
    """For each word (by key) the item of the best score of at least 1, the first by ``order`` on a tie."""
    pairs = scored(candidates(words, items, page))
    by = W.partitionBy(f"w_{page}", *[f"w_{k}" for k in key]).orderBy(F.desc("score"), *[f"o_{c}" for c in order])
    return pairs.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")


def missing_words(words: DataFrame, items: DataFrame, key: list[str], page: str = "page_id") -> DataFrame:
    """Words that no item stands in the place of."""
    hit = scored(candidates(words, items, page)).select(*[F.col(f"w_{c}").alias(c) for c in (page, *key)])
    return words.join(hit, [page, *key], "left_anti")
