"""Settings of the drawing-text engine.  Values are fixed by the semantics that results must match."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """All thresholds; pixels unless said otherwise."""

    # tiling
    prefer_tile: tuple[int, int] = (1408, 1408)
    max_tile: tuple[int, int] = (1536, 1536)
    mid_factor: float = 1.5
    least_tile: int = 256
    overlap_small_font: float = 0.20
    overlap_large_font: float = 0.15
    large_font_factor: float = 1.2
    tile_downscale: float = 1.0
    least_downscaled: int = 512
    pad: tuple[int, int] = (24, 192)
    pad_factor: float = 0.30
    # recognition
    small_font: int = 18
    least_font: int = 12
    scales_small: tuple[float, ...] = (1.0, 1.25, 1.5)
    scales_large: tuple[float, ...] = (1.0,)
    single_char_confidence: float = 0.10
    # seams
    tile_margin: int = 6
    outer_border: int = 12
    # suppression
    nms_iou: float = 0.25
    center_px: int = 24
    center_factor: float = 0.75
    grid_factor: float = 3.5
    grid_px: tuple[int, int] = (48, 256)
    default_height: float = 24.0
    nms_similarity: float = 0.85
    dup_overlap: float = 0.60
    small_gap: float = 0.35
    # lines
    line_overlap: float = 0.55
    line_gap: float = 0.30
    line_center: float = 0.45
    line_similarity: float = 0.97
    cut_bonus: float = 0.5
    # final dedupe
    dedupe_iou: float = 0.40
    dedupe_similarity: float = 0.88
    dedupe_similarity_short: float = 0.96
    baseline: float = 0.5
    # reconciliation
    pdf_iou: float = 0.2
    pdf_center: float = 14.0
    pdf_center_factor: float = 0.35
    pdf_prefer: str = "ocr"


DEFAULT = Settings()

# First digit of a feeder's number -> kilovolts.
VOLTAGE_OF_DIGIT = {"1": 110, "2": 220, "3": 35, "4": 22, "5": 500, "6": 6, "7": 66, "8": 15, "9": 10}
