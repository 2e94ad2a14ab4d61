"""The whole page plan: recognised tiles to cleaned items and voltage levels, reconciled with a document's own words."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..operators import folds, mapping
from ..operators.voltage import voltage_levels

ORDER = ["tile_id", "scale", "det_idx"]


def finished(items: list[folds.Item], s: Settings = DEFAULT) -> list[folds.Item]:
    """A page's items after suppression, merging, dedupe and cleaning."""
    return folds.cleaned(folds.dedupe(folds.merge_lines(folds.suppress(items, s=s), s=s), s=s))


def local_suppression(detections: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """Each tile's detections (page_id, tile_id, font, ... box in tile pixels) suppressed among themselves, before seams are known."""

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["scale", "det_idx"], kind="stable")
        out = folds.frame_of(folds.suppress(folds.items_of(frame), float(frame["font"].iloc[0]), s=s), page_id=key[0], tile_id=key[1])
        out.insert(2, "det_idx", range(len(out)))
        return out

    columns = ["page_id", "tile_id", "scale", "det_idx", "font", *folds.COLUMNS]
    return detections.select(*columns).groupBy("page_id", "tile_id").applyInPandas(run, f"page_id long, tile_id long, det_idx long, {folds.SCHEMA}")


def placed_items(detections: DataFrame, tiles: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """Detections (page_id, tile_id, scale, det_idx, text, box, confidence) of all scales together, suppressed tile by tile and placed on their pages.

    Tiles: page_id, tile_id, orig_x, orig_y, step_x, step_y, full_w, full_h, font, and pad_l and pad_t where tiles are padded.
    """
    back = mapping.not_trivial(mapping.inverse_scale(detections), s)
    middle = lambda a, b: ((F.col(a) + F.col(b)) / 2).cast("long")
    known = tiles.select("page_id", "tile_id", F.greatest(F.lit(s.least_font), F.col("font").cast("int")).alias("font"))
    ready = back.join(known, ["page_id", "tile_id"]).withColumns({"cx": middle("x0", "x1"), "cy": middle("y0", "y1"), "cut": F.lit(False)})
    local = local_suppression(ready, s)
    pads = {c: F.col(c) if c in tiles.columns else F.lit(0) for c in ("pad_l", "pad_t")}
    own = tiles.withColumns(pads).select("page_id", "tile_id", "pad_l", "pad_t", "orig_x", "orig_y", "step_x", "step_y", "full_w", "full_h")
    return mapping.to_page(local.drop("cut").join(own, ["page_id", "tile_id"]), s)


def page_items(detections: DataFrame, tiles: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """The pages' final items in order, see :func:`placed_items`.  Two shuffles: by tile, then by page."""
    return folds.per_page(placed_items(detections, tiles, s), lambda items: finished(items, s), ["tile_id", "det_idx"])


def with_document_words(items: DataFrame, words: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """Final items (page_id, seq, ...) reconciled with words (page_id, word_id, text, x0, y0, x1, y1 in image pixels)."""

    def run(key: tuple, own: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        items = folds.items_of(own.sort_values("seq"))
        listed = [(t, (a, b, c, d)) for t, a, b, c, d in other.sort_values("word_id")[["text", "x0", "y0", "x1", "y1"]].itertuples(index=False)]
        out = folds.frame_of(folds.reconcile(items, listed, s=s) if listed else items, page_id=key[0])
        out.insert(1, "seq", range(len(out)))
        return out

    return items.groupBy("page_id").cogroup(words.select("page_id", "word_id", "text", "x0", "y0", "x1", "y1").groupBy("page_id")).applyInPandas(run, f"page_id long, seq long, {folds.SCHEMA}")


def page_results(pages: DataFrame, recognised: DataFrame, final: DataFrame) -> DataFrame:
    """One nested row a page of the manifest (page_id, path): voltage levels of what was recognised, and the final items in order."""
    item = F.struct("seq", "text", F.array("x0", "y0", "x1", "y1").alias("bbox"), F.array("cx", "cy").alias("center"), "confidence")
    nested = final.groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x.dropFields("seq")).alias("ocr"))
    levels = voltage_levels(recognised)
    empty = lambda name, kind: F.coalesce(F.col(name), F.array().cast(kind)).alias(name)
    kind = nested.schema["ocr"].dataType
    return pages.join(levels, "page_id", "left").join(nested, "page_id", "left").select("page_id", "path", empty("voltage_level", "array<int>"), empty("ocr", kind))
