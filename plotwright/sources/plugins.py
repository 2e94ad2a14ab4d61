"""Recognisers and rasterisers as plug-ins: any object with the method below can be sent to the workers."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import images


class Recogniser(Protocol):
    """Reads a picture of a tile at a scale; called on executors, made once a worker."""

    def read(self, picture: bytes, scale: float) -> list[tuple[str, list[tuple[float, float]], float]]:
        """(text, polygon, confidence) of every detection, in the scaled picture's pixels."""
        ...


class Rasteriser(Protocol):
    """Turns a document into page pictures."""

    def pages(self, content: bytes, dpi: int) -> list[bytes]: ...


class Decoder(Protocol):
    """Pictures as arrays (height, width, 3) and back; tells the heights of the contours in one, in the order it finds them."""

    def decode(self, content: bytes) -> np.ndarray: ...

    def encode(self, picture: np.ndarray) -> bytes: ...

    def contour_heights(self, picture: np.ndarray) -> list[int]: ...


class OpenCvDecoder:
    """Through OpenCV, where it is installed."""

    def decode(self, content: bytes) -> np.ndarray:
        import cv2

        picture = cv2.imdecode(np.frombuffer(content, np.uint8), cv2.IMREAD_COLOR)
        if picture is None:
            raise ValueError("a picture cannot be read")
        return picture

    def encode(self, picture: np.ndarray) -> bytes:
        import cv2

        return cv2.imencode(".png", picture)[1].tobytes()

    def contour_heights(self, picture: np.ndarray) -> list[int]:
        return images.contour_heights(picture)


class WordExtractor(Protocol):
    """Reads a document's own words."""

    def pages(self, content: bytes) -> list[tuple[list[tuple[str, float, float, float, float]], tuple[float, float]]]:
        """Of each page its words (text, left, top, right, bottom) and its size."""
        ...


_MADE: dict[type, object] = {}


def made(kind: type) -> object:
    """One object of a kind a Python worker, made at first use."""
    if kind not in _MADE:
        _MADE[kind] = kind()
    return _MADE[kind]


def recognise(tiles: DataFrame, kind: type) -> DataFrame:
    """Detections of tiles (page_id, tile_id, scale, content): boxes are whole pixels around the polygon, missing text and confidence are empty and 0."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = made(kind)
        for batch in batches:
            rows = []
            for page, tile, scale, content in batch[["page_id", "tile_id", "scale", "content"]].itertuples(index=False):
                for n, (text, polygon, confidence) in enumerate(reader.read(bytes(content), scale)):
                    xs, ys = zip(*polygon, strict=True)
                    rows.append((page, tile, scale, n, text or "", int(min(xs)), int(min(ys)), int(max(xs)), int(max(ys)), float(confidence or 0.0)))
            yield pd.DataFrame(rows, columns=["page_id", "tile_id", "scale", "det_idx", "text", "x0", "y0", "x1", "y1", "confidence"])

    return tiles.mapInPandas(run, "page_id long, tile_id long, scale double, det_idx long, text string, x0 long, y0 long, x1 long, y1 long, confidence double")


def rasterise(documents: DataFrame, kind: type, dpi: int = 400) -> DataFrame:
    """(path, page_id, content) of documents (path, content); pages count from 1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        maker = made(kind)
        for batch in batches:
            for path, content in batch[["path", "content"]].itertuples(index=False):
                pages = maker.pages(bytes(content), dpi)
                yield pd.DataFrame({"path": [path] * len(pages), "page_id": range(1, len(pages) + 1), "content": pages})

    return documents.mapInPandas(run, "path string, page_id long, content binary")


def looked_at(pages: DataFrame, kind: type) -> DataFrame:
    """page_id, full_w, full_h and heights (of the first contours) of pages (page_id, content): each picture is decoded once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = made(kind)
        for batch in batches:
            rows = []
            for page, content in batch[["page_id", "content"]].itertuples(index=False):
                picture = decoder.decode(bytes(content))
                rows.append((page, picture.shape[1], picture.shape[0], list(map(int, decoder.contour_heights(picture)))))
            yield pd.DataFrame(rows, columns=["page_id", "full_w", "full_h", "heights"])

    return pages.select("page_id", "content").mapInPandas(run, "page_id long, full_w long, full_h long, heights array<int>")


def turned(pages: DataFrame, kind: type) -> DataFrame:
    """Pages (page_id, content) turned clockwise by 90 degrees."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = made(kind)
        for batch in batches:
            yield batch.assign(content=[decoder.encode(np.ascontiguousarray(np.rot90(decoder.decode(bytes(c)), -1))) for c in batch["content"]])

    return pages.select("page_id", "content").mapInPandas(run, "page_id long, content binary")


#: Tiles that are handed on together: what a page's pictures take in memory besides the page.
TILES_AT_ONCE = 4


def cut_tiles(pages: DataFrame, tiles: DataFrame, kind: type) -> DataFrame:
    """(page_id, tile_id, content, heights) of planned tiles (orig_x, orig_y, crop_w, crop_h and pads where planned), cut out of their pages.

    A page's tiles go to its picture, which is decoded once and gives them a few at a time.
    """
    pads = [F.col(c).cast("long") if c in tiles.columns else F.lit(0).cast("long") for c in ("pad_l", "pad_t", "pad_r", "pad_b")]
    plan = F.struct(*[F.col(c).cast("long").alias(c) for c in ("tile_id", "orig_x", "orig_y", "crop_w", "crop_h")], *[p.alias(n) for p, n in zip(pads, ("l", "t", "r", "b"), strict=True)])
    planned = tiles.groupBy("page_id").agg(F.array_sort(F.collect_list(plan)).alias("plan"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = made(kind)
        for batch in batches:
            for page, content, plan in batch[["page_id", "content", "plan"]].itertuples(index=False):
                picture, rows = decoder.decode(bytes(content)), []
                for t in plan:
                    top, left = t["orig_y"] - t["t"], t["orig_x"] - t["l"]
                    tile = np.ascontiguousarray(picture[top : t["orig_y"] + t["crop_h"] + t["b"], left : t["orig_x"] + t["crop_w"] + t["r"]])
                    rows.append((page, t["tile_id"], decoder.encode(tile), list(map(int, decoder.contour_heights(tile))), tile.shape[0]))
                    if len(rows) == TILES_AT_ONCE:
                        yield pd.DataFrame(rows, columns=["page_id", "tile_id", "content", "heights", "tile_px"])
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=["page_id", "tile_id", "content", "heights", "tile_px"])

    return pages.select("page_id", "content").join(planned, "page_id").mapInPandas(run, "page_id long, tile_id long, content binary, heights array<int>, tile_px long")


def extract_words(documents: DataFrame, kind: type) -> DataFrame:
    """(document, page_id, word_id, text, x0, top, x1, bottom, pdf_w, pdf_h) of documents (document, content); pages count from 1."""
    schema = "document string, page_id long, word_id long, text string, x0 double, top double, x1 double, bottom double, pdf_w double, pdf_h double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = made(kind)
        for batch in batches:
            for document, content in batch[["document", "content"]].itertuples(index=False):
                for page, (words, (w, h)) in enumerate(reader.pages(bytes(content)), 1):
                    rows = [(document, page, n, str(t), float(a), float(b), float(c), float(d), float(w), float(h)) for n, (t, a, b, c, d) in enumerate(words)]
                    yield pd.DataFrame(rows, columns=[f.split()[0] for f in schema.split(", ")])

    return documents.select("document", "content").mapInPandas(run, schema)
