"""From files to result rows, with pictures that are plain arrays: every text is a strip of pixels that spells it."""

import io
import json

import numpy as np
from pyspark.sql import functions as F

from plotwright.config import Settings
from plotwright.functions import text
from plotwright.plans import batch
from plotwright.sources import manifest, plugins


class Arrays:
    """Pictures as NumPy files."""

    def decode(self, content):
        return np.load(io.BytesIO(content))

    def encode(self, picture):
        out = io.BytesIO()
        np.save(out, picture)
        return out.getvalue()

    def contour_heights(self, picture):
        return [int(h) for h in picture[..., 2].max(axis=1) if h]


class Strips:
    """Reads strips: channel 0 spells the text from left to right, channel 1 marks where it begins."""

    def read(self, picture, scale):
        a, out = np.load(io.BytesIO(picture)), []
        for y, x in np.argwhere(a[..., 1] > 0):
            row = a[y, x:, 0]
            end = int(np.argmin(row)) if (row == 0).any() else len(row)
            if a[y, x, 1] == end:  # whole, not cut by the tile's edge
                box = np.array([x, y, x + 8 * end, y + 18]) * scale
                out.append((bytes(row[:end]).decode(), [(box[0], box[1]), (box[2], box[1]), (box[2], box[3]), (box[0], box[3])], 0.9))
        return out


class Words:
    def pages(self, content):
        return [([tuple(w) for w in p["words"]], tuple(p["size"])) for p in json.loads(content)]


def drawn(w, h, texts, font=20):
    a = np.zeros((h, w, 3), np.uint8)
    for t, x, y in texts:
        a[y, x : x + len(t), 0] = list(t.encode())
        a[y, x, 1] = len(t)
        a[y, x, 2] = font
    return a


def files(tmp_path):
    pages = {1: drawn(3000, 2500, [("C11", 300, 200), ("DS1", 1500, 900), ("hello", 2900, 2400), ("far", 40, 2300)]), 2: drawn(800, 600, [("220 kV SIDE", 100, 100)], 12), 3: drawn(500, 400, [])}
    (tmp_path / "doc").mkdir()
    for i, a in pages.items():
        (tmp_path / "doc" / f"page{i}.png").write_bytes(Arrays().encode(a))
    (tmp_path / "cache.json").write_text(json.dumps({"images": [{"id": i, "path": str(tmp_path / "doc" / f"page{i}.png")} for i in pages]}))
    return pages


def test_from_files_to_rows(spark, tmp_path):
    files(tmp_path)
    document = spark.createDataFrame([("doc", bytearray(json.dumps([{"words": [["extra", 750.0, 600.0, 790.0, 609.0], ["DS1", 750.0, 450.0, 762.0, 459.0]], "size": [1500, 1250]}, {"words": [], "size": [1, 1]}]).encode()))], "document string, content binary")
    words = plugins.extract_words(document, Words)
    manifest.write_page_words(words, str(tmp_path / "words"))
    out = batch.run(spark, [str(tmp_path / "cache.json")], str(tmp_path / "doc"), Strips, Arrays, manifest.page_words(spark, str(tmp_path / "words"), lines=True))
    rows = {r.page_id: r for r in out.collect()}
    assert sorted(i.text for i in rows[1].ocr) == ["C11", "DS1", "extra", "far", "hello"] and rows[1].voltage_level == [110]
    assert [i.text for i in rows[2].ocr] == ["220 kV SIDE"] and rows[2].voltage_level == [220]
    assert rows[3].ocr == [] and rows[3].voltage_level == []
    place = {i.text: tuple(i.bbox) for i in rows[1].ocr}
    assert place["DS1"] == (1500, 900, 1524, 918) and place["extra"] == (1500, 1200, 1580, 1218)


def test_padded_tiles_and_turned_pages(spark, tmp_path):
    files(tmp_path)
    where = ([str(tmp_path / "cache.json")], str(tmp_path / "doc"))
    padded = {r.page_id: sorted(i.text for i in r.ocr) for r in batch.run(spark, *where, Strips, Arrays, pads=True).collect()}
    assert padded == {1: ["C11", "DS1", "far", "hello"], 2: ["220 kV SIDE"], 3: []}
    # A text that stands upright only once the page is turned clockwise: it runs from the bottom up.
    a = np.zeros((600, 900, 3), np.uint8)
    a[:, :, :] = np.rot90(drawn(600, 900, [("up", 100, 50)]), 1)
    (tmp_path / "doc" / "page2.png").write_bytes(Arrays().encode(a))
    both = {r.page_id: {i.text: tuple(i.bbox) for i in r.ocr} for r in batch.run(spark, *where, Strips, Arrays, turned=True).collect()}
    # On the turned page the box is (100, 50, 116, 68); the inverse gives x = y and y = height - x.
    assert both[2] == {"up": (50, 600 - 116, 68, 600 - 100)}


def test_cut_tiles_are_the_pictures_parts(spark):
    rng = np.random.default_rng(1)
    picture = rng.integers(0, 255, (1700, 2000, 3), np.uint8)
    pages = spark.createDataFrame([(7, bytearray(Arrays().encode(picture)))], "page_id long, content binary")
    looked = plugins.looked_at(pages, Arrays).withColumn("font", F.lit(100))
    tiles = batch.planned_tiles(looked, pads=True)
    got = {r.tile_id: Arrays().decode(bytes(r.content)) for r in plugins.cut_tiles(pages, tiles, Arrays).collect()}
    plan = tiles.collect()
    assert len(got) == len(plan) > 3
    for t in plan:
        want = picture[t.orig_y - t.pad_t : t.orig_y + t.crop_h + t.pad_b, t.orig_x - t.pad_l : t.orig_x + t.crop_w + t.pad_r]
        assert np.array_equal(got[t.tile_id], want)
    assert batch.tile_statistics(tiles).first().n_tiles == len(plan)


def test_rasterised(spark, tmp_path):
    class Press:
        def pages(self, content, dpi):
            return content.split(b"\f")

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pdf").write_bytes(b"one\ftwo")
    (tmp_path / "in" / "b.pdf").write_bytes(b"three")
    pages = batch.rasterised(spark, str(tmp_path / "in"), Press, str(tmp_path / "out"))
    assert sorted(bytes(r.content) for r in pages.collect()) == [b"one", b"three", b"two"]
    listed = manifest.manifests(spark, str(tmp_path / "out" / "manifests"))
    assert sorted((r.page_id, r.path) for r in listed.collect()) == [(1, "a/page1.png"), (1, "b/page1.png"), (2, "a/page2.png")]


def test_similarity_column(spark):
    rows = spark.createDataFrame([("tide", "diet"), ("diet", "tide"), ("a", "abcdefgh"), (None, "x"), ("Same  text", "same text")], "a string, b string")
    got = [r[0] for r in rows.select(text.similarity(F.col("a"), F.col("b"), 0.2)).collect()]
    assert got == [0.25, 0.5, 2 / 9, 0.0, 1.0]
    assert rows.select(text.similarity(F.col("a"), F.col("b"), 0.9)).collect()[2][0] == 0.0


def test_downscale_setting_reaches_the_plan(spark):
    looked = spark.createDataFrame([(1, 3000, 3000, 20.0)], "page_id long, full_w long, full_h long, font double")
    assert batch.planned_tiles(looked, Settings(tile_downscale=0.6)).count() > batch.planned_tiles(looked).count()
