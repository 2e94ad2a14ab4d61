from pyspark.sql import functions as F

from plotwright.config import Settings
from plotwright.operators import fonts, tiling


def starts(spark, length, tile, overlap):
    df = spark.createDataFrame([(0, length, length, 0, tile, tile, overlap)], "page_id long, w long, h long, font long, tile_w long, tile_h long, overlap double")
    return [r.orig_x for r in tiling.grid(df).where("grid_y = 0").orderBy("grid_x").collect()]


def test_starts(spark):
    assert starts(spark, 3000, 1000, 0.2) == [0, 800, 1600, 2000]
    assert starts(spark, 900, 1408, 0.2) == [0, 0]
    assert starts(spark, 1408, 1408, 0.2) == [0]


def test_tiles_cover_the_page(spark):
    df = spark.createDataFrame([(1, 5000, 2500, 20), (2, 1500, 700, 30)], "page_id long, w long, h long, font long")
    tiles = tiling.grid(tiling.overlap(tiling.tile_size(df))).collect()
    for page, w, h in ((1, 5000, 2500), (2, 1500, 700)):
        own = [t for t in tiles if t.page_id == page]
        assert max(t.orig_x + t.crop_w for t in own) == w and max(t.orig_y + t.crop_h for t in own) == h
        assert sorted(t.tile_id for t in own) == list(range(len(own)))


def test_downscale_and_scales(spark):
    df = spark.createDataFrame([(1, 600, 1000, 10)], "page_id long, tile_w long, tile_h long, font long")
    assert tiling.downscaled(df, Settings(tile_downscale=0.5)).first()[1:3] == (512, 512)
    assert [r.scale for r in tiling.scale_plan(df).collect()] == [1.0, 1.25, 1.5]
    assert [r.scale for r in tiling.scale_plan(df, scales=(2.0, -1.0)).collect()] == [2.0]


def test_fonts(spark):
    df = spark.createDataFrame([(1, h) for h in (3, 4, 10, 12, 14, 16, 41)], "tile_id long, h int")
    assert fonts.page_font(df, "tile_id", F.lit(200)).first().font == 12.0
    assert fonts.tile_font(df, "tile_id", F.lit(200)).first().font == 12.0
