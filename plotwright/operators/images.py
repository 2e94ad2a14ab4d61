"""Decisions on tile pictures: is there text, is it faint, how tall is it; and the sharpening of faint ones.

Edges, contours and colour spaces come from OpenCV, which is imported where it is needed and nowhere else; shares and thresholds
are plain arrays.  All run inside ``mapInPandas`` over picture rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Looks:
    """Fixed values of the picture rules."""

    white: int = 235
    blank_share: float = 0.985
    text_edges: float = 0.010
    ink_share: float = 0.010
    faint_edges: float = 0.020
    faint_white: float = 0.98
    ink_hue: tuple[int, int] = (60, 110)
    ink_least: tuple[int, int] = (40, 50)
    ink_lift: tuple[int, int] = (20, 10)
    canny: tuple[int, int] = (50, 150)
    clahe: tuple[float, int] = (2.0, 8)
    sharpen: tuple[float, float, float] = (1.25, -0.25, 1.0)


LOOKS = Looks()


def share(mask: np.ndarray) -> float:
    return float(np.count_nonzero(mask)) / mask.size if mask.size else 0.0


def ink(hsv: np.ndarray, r: Looks = LOOKS) -> np.ndarray:
    """Where the greens and blues of drawing programs are."""
    h, s, v = np.moveaxis(hsv, -1, 0)
    return (h >= r.ink_hue[0]) & (h <= r.ink_hue[1]) & (s >= r.ink_least[0]) & (v >= r.ink_least[1])


def has_text(white: float, edges: float, r: Looks = LOOKS) -> bool:
    return white < r.blank_share and edges > r.text_edges


def is_faint(ink_share: float, white: float, edges: float, r: Looks = LOOKS) -> bool:
    """Drawing ink in it, or few edges though it is not nearly blank."""
    return ink_share >= r.ink_share or edges < r.faint_edges and white < r.faint_white


def lifted(hsv: np.ndarray, r: Looks = LOOKS) -> np.ndarray:
    """Ink with more saturation and value."""
    out, mask = hsv.astype(np.int32), ink(hsv, r)
    for channel, more in zip((1, 2), r.ink_lift, strict=True):
        out[..., channel] += np.where(mask, more, 0)
    return np.clip(out, 0, 255).astype(np.uint8)


def _gray_and_edges(picture: np.ndarray, r: Looks) -> tuple[np.ndarray, np.ndarray]:
    import cv2

    gray = cv2.cvtColor(picture, cv2.COLOR_BGR2GRAY)
    return gray, cv2.Canny(gray, *r.canny)


def contour_heights(picture: np.ndarray, r: Looks = LOOKS) -> list[int]:
    """Heights of all contours in the order in which they are found; ``fonts`` takes the usable ones."""
    import cv2

    _, edges = _gray_and_edges(picture, r)
    found, _ = cv2.findContours(edges, cv2.RETR_LIST, cv2.CHAIN_APPROX_SIMPLE)
    return [cv2.boundingRect(c)[3] for c in found]


def looks_of(picture: np.ndarray, r: Looks = LOOKS) -> tuple[bool, bool]:
    """(has text, is faint)."""
    import cv2

    gray, edges = _gray_and_edges(picture, r)
    white, edge = share(gray > r.white), share(edges > 0)
    return has_text(white, edge, r), is_faint(share(ink(cv2.cvtColor(picture, cv2.COLOR_BGR2HSV), r)), white, edge, r)


def sharpened(picture: np.ndarray, r: Looks = LOOKS) -> np.ndarray:
    """Lifted ink, evened lightness, and no channel lighter than the sharpened grey."""
    import cv2

    picture = cv2.cvtColor(lifted(cv2.cvtColor(picture, cv2.COLOR_BGR2HSV), r), cv2.COLOR_HSV2BGR)
    lab = cv2.cvtColor(picture, cv2.COLOR_BGR2LAB)
    lab[..., 0] = cv2.createCLAHE(clipLimit=r.clahe[0], tileGridSize=(r.clahe[1],) * 2).apply(np.ascontiguousarray(lab[..., 0]))
    picture = cv2.cvtColor(lab, cv2.COLOR_LAB2BGR)
    gray = cv2.cvtColor(picture, cv2.COLOR_BGR2GRAY)
    own, soft, sigma = r.sharpen
    edge = cv2.addWeighted(gray, own, cv2.GaussianBlur(gray, (0, 0), sigmaX=sigma), soft, 0)
    return np.minimum(picture, edge[..., None])


def prepared(tiles: DataFrame) -> DataFrame:
    """Tile pictures (encoded, column content) with has_text and faint, the faint ones sharpened; a picture that cannot be read fails."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import cv2

        for batch in batches:
            content, texts, faints = [], [], []
            for data in batch["content"]:
                picture = cv2.imdecode(np.frombuffer(data, np.uint8), cv2.IMREAD_COLOR)
                if picture is None:
                    raise ValueError("a tile's picture cannot be read")
                text, faint = looks_of(picture)
                texts.append(text)
                faints.append(faint)
                content.append(cv2.imencode(".png", sharpened(picture))[1].tobytes() if faint else data)
            yield batch.assign(content=content, has_text=texts, faint=faints)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tiles.schema)
    return tiles.mapInPandas(run, f"{fields}, has_text boolean, faint boolean")
