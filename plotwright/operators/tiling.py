"""Tile planning: size, overlap, lattice, padding and recognition scales of pages, all as projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings


def whole(x: Column) -> Column:
    """Truncated towards zero."""
    return x.cast("long")


def tile_size(pages: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """Adds tile_w and tile_h to pages (w, h): the page, the preferred tile, or about a third of a large page's sides."""
    (pw, ph), (mw, mh) = s.prefer_tile, s.max_tile
    small = (F.col("w") <= pw) & (F.col("h") <= ph)
    mid = (F.col("w") <= int(mw * s.mid_factor)) & (F.col("h") <= int(mh * s.mid_factor))
    third = lambda c, most: F.least(F.lit(most), F.greatest(F.lit(s.least_tile), F.floor(F.col(c) / 3)))
    side = lambda c, prefer, most: whole(F.when(small, F.col(c)).when(mid, F.lit(prefer)).otherwise(third(c, most)))
    return pages.withColumns({"tile_w": side("w", pw, mw), "tile_h": side("h", ph, mh)})


def downscaled(pages: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """Tiles of a scaled-down page; nothing at the default scale of 1."""
    if s.tile_downscale >= 1:
        return pages
    return pages.withColumns({c: F.greatest(F.lit(s.least_downscaled), whole(F.col(c) * s.tile_downscale)) for c in ("tile_w", "tile_h")})


def overlap(pages: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """Adds overlap: less for large fonts."""
    large = F.greatest(F.lit(s.least_font), F.col("font")) >= int(s.small_font * s.large_font_factor)
    return pages.withColumn("overlap", F.when(large, F.lit(s.overlap_large_font)).otherwise(F.lit(s.overlap_small_font)))


def _starts(length: Column, tile: Column, step: Column) -> Column:
    """Multiples of the step while a tile fits, and a last start flush with the edge if that is another (0 if the page is short)."""
    n = F.floor((F.greatest(F.lit(1), length - tile + 1) - 1) / step).cast("long")
    regular = F.transform(F.sequence(F.lit(0).cast("long"), n), lambda i: i * step)
    flush = F.array(F.greatest(F.lit(0).cast("long"), length - tile))
    return F.when(n * step != length - tile, F.concat(regular, flush)).otherwise(regular)


def grid(pages: DataFrame) -> DataFrame:
    """One row a tile of pages (w, h, tile_w, tile_h, overlap), row by row from the top: tile_id, lattice place, origin and clipped size."""
    step = lambda c: F.greatest(F.lit(1).cast("long"), whole(F.col(c) * (F.lit(1.0) - F.col("overlap"))))
    planned = pages.withColumns({"step_x": step("tile_w"), "step_y": step("tile_h")})
    planned = planned.withColumns({"xs": _starts(F.col("w"), F.col("tile_w"), F.col("step_x")), "ys": _starts(F.col("h"), F.col("tile_h"), F.col("step_y"))})
    keep = [c for c in planned.columns if c not in ("xs", "ys")]
    rows = planned.select(*keep, F.size("xs").alias("n"), "xs", F.posexplode("ys").alias("grid_y", "orig_y"))
    tiles = rows.select(*keep, "n", "grid_y", "orig_y", F.posexplode("xs").alias("grid_x", "orig_x"))
    return tiles.select(
        *keep,
        "grid_x",
        "grid_y",
        "orig_x",
        "orig_y",
        (F.col("grid_y").cast("long") * F.col("n") + F.col("grid_x")).alias("tile_id"),
        (F.least(F.col("w"), F.col("orig_x") + F.col("tile_w")) - F.col("orig_x")).alias("crop_w"),
        (F.least(F.col("h"), F.col("orig_y") + F.col("tile_h")) - F.col("orig_y")).alias("crop_h"),
    )


def padded(tiles: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """Adds how far each tile can be padded on every side: by the font's height, within bounds and the page."""
    pad = whole(F.least(F.lit(float(s.pad[1])), F.greatest(F.lit(float(s.pad[0])), F.col("font") * s.pad_factor)))
    tiles = tiles.withColumn("pad", pad)
    right, bottom = F.col("orig_x") + F.col("crop_w"), F.col("orig_y") + F.col("crop_h")
    return tiles.withColumns(
        {
            "pad_l": F.least(F.col("pad"), F.col("orig_x")),
            "pad_t": F.least(F.col("pad"), F.col("orig_y")),
            "pad_r": F.least(F.col("pad"), F.col("w") - right),
            "pad_b": F.least(F.col("pad"), F.col("h") - bottom),
        }
    ).drop("pad")


def scale_plan(tiles: DataFrame, s: Settings = DEFAULT, scales: tuple[float, ...] = ()) -> DataFrame:
    """One row a recognition pass: the user's scales, else more for small fonts (above 0 and below the limit)."""
    chosen = [x for x in scales if x > 0]
    small = (F.col("font") > 0) & (F.col("font") < s.small_font)
    lists = F.array(*map(F.lit, chosen)) if chosen else F.when(small, F.array(*map(F.lit, s.scales_small))).otherwise(F.array(*map(F.lit, s.scales_large)))
    return tiles.withColumn("small_font", small).withColumn("scale", F.explode(lists))
