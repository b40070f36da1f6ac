"""Pixels: encodings, fingerprints and thumbnails. Kernels take Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Channels of each encoding, in the order in which RGB is taken from them.
ENCODINGS = {"rgb8": (3, (0, 1, 2)), "bgr8": (3, (2, 1, 0)), "rgba8": (4, (0, 1, 2)), "bgra8": (4, (2, 1, 0)), "mono8": (1, (0, 0, 0))}


def to_rgb(data: bytes, encoding: str, height: int, width: int, step: int) -> bytes:
    """Row-major RGB of an image message: row padding dropped, channels reordered or repeated."""
    known = ENCODINGS.get(encoding.lower())
    if known is None:
        raise ValueError(f"unsupported encoding {encoding!r}")
    channels, order = known
    if height <= 0 or width <= 0 or step < width * channels or len(data) < height * step:
        raise ValueError("image data doesn't fit its header")
    rows = np.frombuffer(data, np.uint8, height * step).reshape(height, step)[:, : width * channels]
    return np.ascontiguousarray(rows.reshape(height, width, channels)[:, :, list(order)]).tobytes()


@F.pandas_udf(T.BinaryType())
def rgb_pixels(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for data, encoding, height, width, step in parts:
        yield pd.Series([to_rgb(*row) for row in zip(data, encoding, height, width, step, strict=True)])


def pixel_fingerprint(image: Column) -> Column:
    """A content hash; it is only compared for equality."""
    return F.sha2(image, 256)


def area_thumbnail(rgb: bytes, height: int, width: int, side: int) -> list[float]:
    """A gray ``side`` x ``side`` thumbnail: each cell the mean of the area it covers."""
    gray = np.frombuffer(rgb, np.uint8).reshape(height, width, 3) @ np.array([0.299, 0.587, 0.114])

    def cover(n: int) -> np.ndarray:
        edges = np.linspace(0, n, side + 1)
        low, high = np.maximum(edges[:-1, None], np.arange(n)), np.minimum(edges[1:, None], np.arange(n) + 1)
        share = np.clip(high - low, 0, None)
        return share / share.sum(axis=1, keepdims=True)

    return (cover(height) @ gray @ cover(width).T).astype(np.float32).ravel().tolist()


def thumbnail_signature(side: int = 32):
    """A pandas UDF over (rgb, height, width): the frame's signature."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def signature(rgb: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
        return pd.Series([area_thumbnail(a, h, w, side) for a, h, w in zip(rgb, height, width, strict=True)])

    return signature


@F.pandas_udf(T.BinaryType())
def background_image(width: pd.Series, height: pd.Series, camera: pd.Series, tick: pd.Series) -> pd.Series:
    """Test frames: a background seeded by the camera's name, with a bar that moves with the tick."""
    out = []
    for w, h, name, k in zip(width, height, camera, tick, strict=True):
        seed = sum((i + 1) * ord(c) for i, c in enumerate(name))
        frame = np.empty((h, w, 3), np.uint8)
        frame[:] = [48 + seed % 96, 48 + seed // 7 % 96, 48 + seed // 13 % 96]
        frame[:, k % w] = 255
        out.append(frame.tobytes())
    return pd.Series(out)
