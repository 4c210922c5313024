"""PNG files from pixels, and boxes drawn on scans; no imaging library is needed."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np


def encode(pixels: np.ndarray) -> bytes:
    """An 8-bit PNG of (height, width) grey or (height, width, 3) RGB pixels."""
    h, w = pixels.shape[:2]
    colour = 2 if pixels.ndim == 3 else 0
    rows = np.ascontiguousarray(pixels, np.uint8).reshape(h, -1)
    raw = np.concatenate([np.zeros((h, 1), np.uint8), rows], 1).tobytes()

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


@dataclass(frozen=True)
class Style:
    """How a layer of boxes is drawn: colour, width of the outline, and how far above the box its label stands, but not above `least`."""

    colour: tuple[int, int, int]
    thick: int
    up: int = 12
    least: int = 0


# The signs of labels, five columns of seven dots each; a set bit is a dot, the lowest bit on top.
_GLYPHS = {
    "0": (62, 81, 73, 69, 62), "1": (0, 66, 127, 64, 0), "2": (66, 97, 81, 73, 70), "3": (33, 65, 69, 75, 49), "4": (24, 20, 18, 127, 16), "5": (39, 69, 69, 69, 57), "6": (60, 74, 73, 73, 48),
    "7": (1, 113, 9, 5, 3), "8": (54, 73, 73, 73, 54), "9": (6, 73, 73, 41, 30), "p": (124, 20, 20, 20, 8), "l": (0, 65, 127, 64, 0), "s": (72, 84, 84, 84, 32), "h": (127, 8, 4, 4, 120), "_": (64, 64, 64, 64, 64),
}


def boxed(pixels: np.ndarray, boxes: Iterable[list[int]], colour: tuple[int, int, int], thick: int = 2) -> np.ndarray:
    """A copy of RGB pixels with the outlines of boxes; boxes are clipped to the image."""
    out = pixels.copy()
    for b in boxes:
        _outline(out, b, colour, thick)
    return out


def _outline(out: np.ndarray, box: list[int], colour: tuple[int, int, int], thick: int) -> None:
    h, w = out.shape[:2]
    x1, x2 = (max(0, min(x, w)) for x in (box[0], box[2]))
    y1, y2 = (max(0, min(y, h)) for y in (box[1], box[3]))
    out[y1 : min(y1 + thick, y2), x1:x2] = colour
    out[max(y2 - thick, y1) : y2, x1:x2] = colour
    out[y1:y2, x1 : min(x1 + thick, x2)] = colour
    out[y1:y2, max(x2 - thick, x1) : x2] = colour


def _label(out: np.ndarray, text: str, x: int, y: int, colour: tuple[int, int, int]) -> None:
    h, w = out.shape[:2]
    for n, c in enumerate(text):
        for dx, column in enumerate(_GLYPHS.get(c, (127,) * 5)):
            for dy in range(7):
                if column >> dy & 1 and 0 <= y + dy < h and 0 <= x + 6 * n + dx < w:
                    out[y + dy, x + 6 * n + dx] = colour


def drawn(pixels: np.ndarray, shapes: Iterable[dict], styles: Sequence[Style]) -> np.ndarray:
    """A copy of RGB pixels with shapes (box, label, layer), one over the other; shapes without a box of four numbers are passed over."""
    out = pixels.copy()
    for shape in shapes:
        box, style = shape["box"], styles[shape["layer"]]
        if box and len(box) == 4:
            _outline(out, box, style.colour, style.thick)
            if shape["label"]:
                _label(out, shape["label"], box[0], max(style.least, box[1] - style.up), style.colour)
    return out


def rgb(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """RGB pixels of a decoded scan (BGR rows)."""
    image = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.repeat(image, 3, 2) if channels == 1 else image[..., 2::-1]
