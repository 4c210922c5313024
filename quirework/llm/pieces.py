"""Cutting oversized texts into overlapping pieces at natural boundaries.

Each place between two characters has a boundary strength: paragraph, line, sentence or word end, or none. A piece ends at the strongest place of the
window in which it may end, at the rightmost of equals; the next piece begins `overlap` characters earlier. The strongest place of a window is
found in constant time in a sparse table of range maxima. The table is built over a stretch of the text at a time, so that its memory
does not grow with the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = 2_000
OVERLAP = 200

#: Boundary strengths.
NONE, WORD, SENTENCE, LINE, PARAGRAPH = 0, 1, 2, 3, 4

#: Characters for which one sparse table is built.
STRETCH = 1 << 16

# Signs that end sentences, alone or before white space, signs that may follow them, and signs after which a word may end without a space.
_ENDS_ALONE = "。！？｡।॥؟۔"
_ENDS_SPACED = ".!?…;:"
_CLOSERS = "\"'”’»›)]}」』）】〉》"
_SOFT = "、，；：・"
_SPACES = " \t\r\f\v\x85\xa0               　"


def _in(codes: np.ndarray, signs: str) -> np.ndarray:
    return np.isin(codes, np.fromiter(map(ord, signs), np.uint32))


def strengths(text: str) -> np.ndarray:
    """The strength of a cut before each character; its last element is the cut after the text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(codes)
    out = np.zeros(n + 1, np.int8)
    if not n:
        return out
    newline = _in(codes, "\n  ")
    space = newline | _in(codes, _SPACES)
    alone, ends, closer, soft = _in(codes, _ENDS_ALONE), _in(codes, ".!?…"), _in(codes, _CLOSERS), _in(codes, _SOFT)
    before = lambda m: np.concatenate(([False], m))
    after = lambda m: np.concatenate((m, [True]))
    out[before(~space) & after(space) | before(soft)] = WORD
    # a sentence's end moves over at most four closing signs
    spaced, bare = before(ends), before(alone)
    for _ in range(4):
        moved = before(closer)
        spaced[1:] |= spaced[:-1] & moved[1:]
        bare[1:] |= bare[:-1] & moved[1:]
    out[(spaced & after(space)) | (bare & ~after(closer | alone))] = SENTENCE
    line = before(~space) & after(newline) | before(~newline) & after(newline)
    out[line] = LINE
    # a line end is a paragraph's if only white space stands before the next newline
    nl = np.flatnonzero(newline)
    if len(nl) > 1:
        solid = np.concatenate(([0], np.cumsum(~space)))
        blank = nl[:-1][solid[nl[1:]] == solid[nl[:-1] + 1]]
        out[blank[line[blank]]] = PARAGRAPH
    out[0], out[n] = NONE, PARAGRAPH
    return out


class RangeMaximum:
    """Rightmost place of the largest value in any window of values, in constant time after n log n building."""

    def __init__(self, values: np.ndarray, longest: int) -> None:
        row = (values.astype(np.int64) << 32) | np.arange(len(values))
        self.rows = [row]
        width = 1
        while width * 2 <= min(longest, len(values)):
            row = np.maximum(row[:-width], row[width:])
            self.rows.append(row)
            width *= 2

    def query(self, first: int, last: int) -> int:
        """The place of the largest value in first..last, both included."""
        k = (last - first + 1).bit_length() - 1
        row = self.rows[k]
        return int(max(row[first], row[last - (1 << k) + 1]) & 0xFFFFFFFF)


def cut(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """[start, end) of the pieces. Every piece has at most `limit` characters, all but the last at least half as many or overlap + 1; consecutive ones share `overlap`."""
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and smaller than limit")
    n = len(text)
    if n <= limit:
        return [(0, n)] if n else []
    least = max(limit // 2, overlap + 1)
    out, start, base, table = [], 0, 0, None
    strength = strengths(text)
    stretch = max(STRETCH, 4 * limit)
    while n - start > limit:
        if table is None or start + limit >= base + stretch:
            base = start
            table = RangeMaximum(strength[base : base + stretch], limit - least + 1)
        end = base + table.query(start + least - base, start + limit - base)
        out.append((start, end))
        start = end - overlap
    return [*out, (start, n)]


def split_items(items: DataFrame, keys: list[str], text: str = "text", limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(keys, n_pieces, piece_no, start_char, end_char, piece): the pieces of each item, as one row each.

    Texts of at most `limit` characters stay inside the JVM as their only piece; only longer ones go through Python, with no shuffle. Null and empty texts give no row,
    repeated rows give repeated pieces, columns that are not keys are dropped. Whole texts are cut, however long.
    """
    size = F.length(text)
    chosen = items.select(*keys, F.col(text).alias("__text"))
    size = F.length("__text")
    whole = chosen.where((size > 0) & (size <= limit)).select(
        *keys, F.lit(1).alias("n_pieces"), F.lit(0).alias("piece_no"), F.lit(0).alias("start_char"), size.alias("end_char"), F.col("__text").alias("piece")
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t in enumerate(b.column(b.num_columns - 1).to_pylist()):
                at = cut(t, limit, overlap)
                row = b.slice(i, 1)
                rows = pa.array(np.zeros(len(at), np.int64))
                columns = [c.take(rows) for c in row.columns[:-1]]
                columns += [pa.array([len(at)] * len(at), pa.int32()), pa.array(range(len(at)), pa.int32()), pa.array([s for s, _ in at], pa.int32()), pa.array([e for _, e in at], pa.int32()), pa.array([t[s:e] for s, e in at], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keys, "n_pieces", "piece_no", "start_char", "end_char", "piece"])

    long = chosen.where(size > limit)
    return whole.unionByName(long.mapInArrow(pieces, whole.schema))


def page_items(pages: DataFrame) -> DataFrame:
    """(record_id, line_pos, text): each line's text, and at line_pos -1 each record's line texts joined by one newline. Null lines and texts take no part."""
    texts = F.transform(F.coalesce("lines", F.array().cast(pages.schema["lines"].dataType)), lambda line: line["text"])
    own = F.transform(texts, lambda t, i: F.struct(i.alias("line_pos"), t.alias("text")))
    joined = F.array(F.struct(F.lit(-1).alias("line_pos"), F.array_join(texts, "\n").alias("text")))
    return pages.select("record_id", F.explode(F.concat(own, joined)).alias("item")).select("record_id", "item.line_pos", "item.text").where("text is not null")


def oversized(items: DataFrame, keys: list[str], limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """keys of the items that had to be cut."""
    return split_items(items, keys, limit=limit, overlap=overlap).where((F.col("n_pieces") > 1) & (F.col("piece_no") == 0)).select(*keys)


def overlap_text(piece: Column, overlap: int = OVERLAP) -> Column:
    """What a piece shares with the next one."""
    return F.right(piece, F.lit(overlap))
