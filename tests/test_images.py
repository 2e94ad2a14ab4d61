import numpy as np
import pytest

from plotwright.operators import images


def test_thresholds():
    assert images.has_text(0.9, 0.02) and not images.has_text(0.99, 0.02) and not images.has_text(0.9, 0.01)
    assert images.is_faint(0.01, 1.0, 1.0) and images.is_faint(0.0, 0.5, 0.01) and not images.is_faint(0.0, 0.99, 0.01) and not images.is_faint(0.0, 0.5, 0.02)
    assert images.share(np.zeros((0, 3))) == 0.0 and images.share(np.array([True, False])) == 0.5


def test_ink_is_lifted_and_clipped():
    hsv = np.array([[[80, 250, 250], [80, 40, 50], [80, 39, 50], [59, 100, 100]]], np.uint8)
    assert images.ink(hsv).tolist() == [[True, True, False, False]]
    assert images.lifted(hsv).tolist() == [[[80, 255, 255], [80, 60, 60], [80, 39, 50], [59, 100, 100]]]


def test_pictures(spark):
    cv2 = pytest.importorskip("cv2")
    picture = np.full((200, 200, 3), 255, np.uint8)
    cv2.putText(picture, "DS12", (20, 120), cv2.FONT_HERSHEY_SIMPLEX, 2, (0, 0, 0), 3)
    assert images.looks_of(picture)[0] and images.contour_heights(picture)
    assert images.sharpened(picture).shape == picture.shape
    rows = spark.createDataFrame([(1, bytearray(cv2.imencode(".png", picture)[1].tobytes()))], "tile_id long, content binary")
    assert images.prepared(rows).first().has_text
