"""Highlighter marks in scans: coloured pixels, cleaned by closing and opening, grouped into components. One scan per row, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import CANDIDATE


@dataclass(frozen=True)
class Marker:
    hsv_low: tuple[int, int, int] = (15, 20, 80)
    hsv_high: tuple[int, int, int] = (95, 255, 255)
    min_area: int = 120
    kernel_size: int = 5
    edge_margin_px: int = 25
    max_hw_ratio: float = 3.0
    max_height_frac: float = 0.15
    frame_crop_frac: float = 0.02

    @classmethod
    def of(cls, config: dict) -> Marker:
        given = config.get("highlights", {})
        kinds = {"hsv_low": lambda v: tuple(map(int, v)), "hsv_high": lambda v: tuple(map(int, v)), "min_area": int, "kernel_size": int, "edge_margin_px": int}
        return cls(**{k: kinds.get(k, float)(given[k]) for k in cls.__dataclass_fields__ if k in given})


def hsv(bgr: np.ndarray) -> np.ndarray:
    """8-bit HSV of 8-bit BGR pixels: hue in 0..179, by fixed-point tables of 12 bits."""
    b, g, r = (bgr[..., i].astype(np.int64) for i in range(3))
    v = np.maximum(np.maximum(b, g), r)
    span = v - np.minimum(np.minimum(b, g), r)
    levels = np.arange(256)
    with np.errstate(divide="ignore"):
        by_value = np.where(levels > 0, np.rint((255 << 12) / levels), 0).astype(np.int64)
        by_span = np.where(levels > 0, np.rint((180 << 12) / (6.0 * levels)), 0).astype(np.int64)
    s = (span * by_value[v] + (1 << 11)) >> 12
    h = np.where(v == r, g - b, np.where(v == g, b - r + 2 * span, r - g + 4 * span))
    h = (h * by_span[span] + (1 << 11)) >> 12
    return np.stack([np.where(h < 0, h + 180, h), s, v], -1)


def _spread(mask: np.ndarray, k: int, grow: bool) -> np.ndarray:
    """Dilation (grow) or erosion with k x k ones; pixels outside the image take no part."""
    before, after = k // 2, k - 1 - k // 2
    out = mask
    for axis in (0, 1):
        pad = [(0, 0), (0, 0)]
        # the window of a dilation is that of an erosion mirrored
        pad[axis] = (after, before) if grow else (before, after)
        wide = np.pad(out, pad, constant_values=not grow)
        n = out.shape[axis]
        pieces = [np.take(wide, range(i, i + n), axis) for i in range(k)]
        out = np.logical_or.reduce(pieces) if grow else np.logical_and.reduce(pieces)
    return out


def components(mask: np.ndarray) -> np.ndarray:
    """Labels 1.. of the 8-connected components in order of their first pixel, 0 elsewhere. Runs of rows are joined by union and find."""
    h, w = mask.shape
    parent: list[int] = []

    def root(a: int) -> int:
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    runs: list[tuple[int, int, int]] = []
    above: list[int] = []
    for y in range(h):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], mask[y].astype(np.int8), [0]))))
        here = []
        j = 0
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            n = len(runs)
            runs.append((y, a, b))
            parent.append(n)
            here.append(n)
            while j < len(above) and runs[above[j]][2] < a:
                j += 1
            k = j
            while k < len(above) and runs[above[k]][1] <= b:
                p, q = root(above[k]), root(n)
                parent[max(p, q)] = min(p, q)
                k += 1
        above = here
    labels = np.zeros(mask.shape, np.int32)
    names: dict[int, int] = {}
    for n, (y, a, b) in enumerate(runs):
        labels[y, a:b] = names.setdefault(root(n), len(names) + 1)
    return labels


def marked_pixels(data: bytes, height: int, width: int, channels: int, m: Marker = Marker()) -> tuple[np.ndarray, np.ndarray]:
    """(mask, colours): the pixels of a marker's colour after cropping, closing and opening, and all pixels as HSV."""
    image = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    bgr = np.repeat(image, 3, 2) if channels == 1 else image[..., :3]
    colours = hsv(bgr)
    mask = np.logical_and(colours >= np.array(m.hsv_low), colours <= np.array(m.hsv_high)).all(-1)
    crop = round(width * m.frame_crop_frac) if m.frame_crop_frac > 0 else 0
    if crop > 0:
        mask[:, :crop] = False
        mask[:, width - crop :] = False
    for grow in (True, False, False, True):
        mask = _spread(mask, m.kernel_size, grow)
    return mask, colours


def marks(data: bytes, height: int, width: int, channels: int, m: Marker = Marker()) -> list[dict]:
    """The components of a scan that are large enough, with box, area and mean colour; their shape is judged elsewhere."""
    mask, colours = marked_pixels(data, height, width, channels, m)
    labels = components(mask)
    n = labels.max(initial=0) + 1
    flat = labels.ravel()
    area = np.bincount(flat, minlength=n)
    sums = [np.bincount(flat, colours[..., i].ravel(), minlength=n) for i in range(3)]
    out = []
    ys, xs = np.nonzero(labels)
    at = labels[ys, xs]
    low_x, low_y, high_x, high_y = np.full(n, width), np.full(n, height), np.zeros(n, int), np.zeros(n, int)
    np.minimum.at(low_x, at, xs)
    np.minimum.at(low_y, at, ys)
    np.maximum.at(high_x, at, xs + 1)
    np.maximum.at(high_y, at, ys + 1)
    for k in range(1, n):
        if area[k] >= m.min_area:
            out.append(
                {
                    "bbox": [int(low_x[k]), int(low_y[k]), int(high_x[k]), int(high_y[k])],
                    "area": int(area[k]),
                    "color_stats": {name: float(s[k] / area[k]) for name, s in zip(("h_mean", "s_mean", "v_mean"), sums, strict=True)},
                }
            )
    return out


def shaped(c: dict, width: int, height: int, m: Marker) -> bool:
    """`spans.shape_ok` for one candidate."""
    x1, y1, x2, y2 = c["bbox"]
    w, h = max(1, x2 - x1), max(1, y2 - y1)
    share = h / max(1, height)
    near = x1 <= m.edge_margin_px or x2 >= width - m.edge_margin_px
    return not (h / w > m.max_hw_ratio or share > m.max_height_frac or (near and share > m.max_height_frac * 0.6))


def detect(images: DataFrame, m: Marker = Marker()) -> DataFrame:
    """(page_num, file_name, candidates) of decoded scans. One image at a time is in memory; spread the images before."""
    kind = pa.list_(pa.struct([("bbox", pa.list_(pa.int32())), ("area", pa.int32()), ("color_stats", pa.struct([(k, pa.float64()) for k in ("h_mean", "s_mean", "v_mean")]))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                page, name, h, w, ch, data = (c[i].as_py() for c in b.columns)
                found = [c for c in marks(data, h, w, ch, m) if shaped(c, w, h, m)]
                yield pa.RecordBatch.from_arrays([pa.array([page], pa.int32()), pa.array([name]), pa.array([found], kind)], names=["page_num", "file_name", "candidates"])

    spark = images.sparkSession
    spread = images.select("page_num", "file_name", "height", "width", "channels", "data").repartition(max(1, spark.sparkContext.defaultParallelism), "page_num")
    return spread.mapInArrow(run, f"page_num int, file_name string, candidates array<{CANDIDATE.simpleString()}>").withColumn("file_name", F.col("file_name"))
