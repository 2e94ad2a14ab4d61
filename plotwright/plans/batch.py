"""From manifests and pictures to result rows: scan, look, tile, recognise, place, fold, reconcile, assemble.

Pictures travel once to the workers that look at them and once to those that cut them; everything between is planned as columns.
The turned pass, off by default, recognises the pages turned by 90 degrees as well and unites both before the page's folds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..functions.geometry import Box, scaled
from ..operators import folds, fonts, mapping, tiling
from ..sources import manifest, plugins
from . import page


def _font(looked: DataFrame, key: list[str], height: str, tile: bool) -> DataFrame:
    """Adds font: of the page or the tile, by the heights of its contours; 0 without any."""
    contours = looked.select(F.struct(*key).alias("key"), F.col(height).alias("px"), F.posexplode("heights").alias("seen", "h"))
    found = (fonts.tile_font if tile else fonts.page_font)(contours, "key", F.col("px"))
    found = found.select(*[F.col(f"key.{k}").alias(k) for k in key], "font")
    return looked.join(found, key, "left").withColumn("font", F.coalesce("font", F.lit(0.0))).drop("heights")


def planned_tiles(looked: DataFrame, s: Settings = DEFAULT, pads: bool = False) -> DataFrame:
    """Tiles of pages (page_id, full_w, full_h, font)."""
    sized = looked.select("page_id", F.col("full_w").alias("w"), F.col("full_h").alias("h"), F.col("font").cast("long").alias("font"))
    grid = tiling.grid(tiling.overlap(tiling.downscaled(tiling.tile_size(sized, s), s), s))
    return (tiling.padded(grid, s) if pads else grid).withColumnsRenamed({"w": "full_w", "h": "full_h"})


def recognised_items(images: DataFrame, recogniser: type, decoder: type, s: Settings = DEFAULT, scales: tuple[float, ...] = (), pads: bool = False) -> DataFrame:
    """Placed items of pages (page_id, content), with tile_id and det_idx as their order, and the page's size."""
    looked = _font(plugins.looked_at(images, decoder), ["page_id"], "full_h", tile=False)
    tiles = planned_tiles(looked, s, pads)
    cut = _font(plugins.cut_tiles(images, tiles, decoder), ["page_id", "tile_id"], "tile_px", tile=True)
    passes = tiling.scale_plan(cut, s, scales).select("page_id", "tile_id", "scale", "content")
    return page.placed_items(plugins.recognise(passes, recogniser), tiles, s)


def run(spark: SparkSession, manifests: list[str], images: str, recogniser: type, decoder: type = plugins.OpenCvDecoder, words: DataFrame | None = None, pattern: str = "*.png", s: Settings = DEFAULT, scales: tuple[float, ...] = (), turned: bool = False, pads: bool = False) -> DataFrame:
    """One row a page of the manifests: page_id, path, voltage_level and ocr (:func:`page.page_results`).

    ``images``: the folder that the pictures lie below.  ``words``: (document, page_id, word_id, text, x0, top, x1, bottom, pdf_w,
    pdf_h), for instance of :func:`manifest.page_words`; pages without any are left as recognised.  Page ids tell pages of all
    manifests apart.
    """
    pages = manifest.manifests(spark, *manifests).select("page_id", "path")
    pictures = manifest.page_images(spark, pages, images, pattern).select("page_id", "content")
    keep = ["page_id", "turn", "tile_id", "det_idx", *folds.COLUMNS]
    placed = recognised_items(pictures, recogniser, decoder, s, scales, pads).withColumn("turn", F.lit(0))
    sizes = plugins.looked_at(pictures, decoder).drop("heights")
    if turned:
        aside = recognised_items(plugins.turned(pictures, decoder), recogniser, decoder, s, scales, pads).drop("full_w", "full_h")
        placed = placed.select(*keep).unionByName(mapping.turned_back(aside.join(sizes, "page_id")).withColumn("turn", F.lit(1)).select(*keep))
    items = folds.per_page(placed, lambda own: page.finished(own, s), ["turn", "tile_id", "det_idx"])
    final = items
    if words is not None:
        own = words.join(pages.select("page_id", manifest.document_of(F.col("path")).alias("document")), ["document", "page_id"]).join(sizes, "page_id")
        box = scaled(Box(F.col("x0"), F.col("top"), F.col("x1"), F.col("bottom")), (F.col("pdf_w"), F.col("pdf_h")), (F.col("full_w"), F.col("full_h")))
        final = page.with_document_words(items, own.select("page_id", "word_id", "text", *[c.alias(n) for c, n in zip(box, ("x0", "y0", "x1", "y1"), strict=True)]), s)
    return page.page_results(pages, items, final)


def rasterised(spark: SparkSession, documents: str, rasteriser: type, out: str, dpi: int = 400) -> DataFrame:
    """Pages of the PDFs below ``documents`` (path, page_id, content), written as Parquet below ``out``/pages with a manifest a document.

    Manifests (``out``/manifests) name each page ``<document>/page<id>.png``.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", True).load(documents)
    plugins.rasterise(files.select("path", "content"), rasteriser, dpi).write.parquet(f"{out}/pages")
    pages = spark.read.parquet(f"{out}/pages")
    name = F.regexp_extract("path", r"([^/]+)\.pdf$", 1)
    manifest.write_manifests(pages.select(name.alias("manifest"), F.col("page_id").cast("int").alias("id"), F.concat(name, F.lit("/page"), "page_id", F.lit(".png")).alias("path")), f"{out}/manifests")
    return pages


def tile_statistics(tiles: DataFrame) -> DataFrame:
    """What overlays of a page tell: page_id, n_tiles, the least and greatest tile, and the share of the page that is tiled more than once."""
    area = F.col("crop_w") * F.col("crop_h")
    found = tiles.groupBy("page_id", "full_w", "full_h").agg(F.count(F.lit(1)).alias("n_tiles"), F.min(area).alias("least_area"), F.max(area).alias("most_area"), F.sum(area).alias("tiled"))
    return found.select("page_id", "n_tiles", "least_area", "most_area", F.round(F.col("tiled") / (F.col("full_w") * F.col("full_h")) - 1, 6).alias("twice"))
