"""Word boxes to text lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_blank
from ..schema import LINE


def usable_words(boxes: DataFrame) -> DataFrame:
    """Rows of an engine's word table (text, conf, left, top, width, height, ...) that are words: text not blank, conf a number of at least 0, a box with an area."""
    conf = F.expr("try_cast(conf as double)")
    ok = ~is_blank(F.col("text")) & (conf >= 0) & (F.col("width") > 0) & (F.col("height") > 0)
    return boxes.where(F.coalesce(ok, F.lit(False))).withColumn("confidence", conf)


def box_of(left: Column, top: Column, width: Column, height: Column) -> Column:
    return F.array(left, top, left + width, top + height)


def _clusters(middles: list[float], tolerance: float) -> list[int]:
    """Where each cluster of ascending middles begins: a middle joins the open cluster if it is within the tolerance of its running mean."""
    starts: list[int] = []
    total, n = 0.0, 0
    for i, m in enumerate(middles):
        if n and abs(m - total / n) <= tolerance:
            total += m
            n += 1
        else:
            starts.append(i)
            total, n = m, 1
    return starts


def _grouped(words: pa.ListArray, pages: list[int | None], tolerances: list[float]) -> pa.ListArray:
    """The lines of each page. Words stay Arrow columns: they are put in order by one take, and boxes are united by line."""
    flat = words.flatten()
    sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy()
    page_of = np.repeat(np.arange(len(words)), sizes)
    boxes = pc.struct_field(flat, "bbox")
    boxes = pc.if_else(flat.is_valid(), boxes, pa.scalar(None, boxes.type)) if flat.null_count else boxes
    usable = pc.fill_null(pc.equal(pc.list_value_length(boxes), 4), False)
    at = np.flatnonzero(usable.to_numpy(zero_copy_only=False))
    box = boxes.take(pa.array(at, pa.int64())).flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
    page_of = page_of[at]
    middle = (box[:, 1] + box[:, 3]) / 2.0
    order = np.lexsort((box[:, 0], middle, page_of))
    at, box, page_of, middle = at[order], box[order], page_of[order], middle[order]
    begin = np.searchsorted(page_of, np.arange(len(words) + 1))
    starts, numbers, counts = [], [], []
    for k in range(len(words)):
        a, b = begin[k], begin[k + 1]
        own = _clusters(middle[a:b].tolist(), tolerances[k])
        starts += [a + i for i in own]
        numbers += [f"p{pages[k]}_l{n}" for n in range(1, len(own) + 1)]
        counts.append(len(own))
    starts = np.array(starts, np.int64)
    line_of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(at))))
    # within a line words stand by their left edge; equal ones keep their order
    inner = np.lexsort((box[:, 0], line_of))
    at, box = at[inner], box[inner]
    offsets = pa.array(np.append(starts, len(at)), pa.int32())
    own_words = flat.take(pa.array(at, pa.int64()))
    texts = pa.ListArray.from_arrays(offsets, pc.fill_null(pc.struct_field(own_words, "text"), ""))
    edges = [np.minimum.reduceat(box[:, c], starts) if c < 2 else np.maximum.reduceat(box[:, c], starts) for c in range(4)] if len(starts) else [np.zeros(0)] * 4
    united = pa.ListArray.from_arrays(pa.array(np.arange(len(starts) + 1) * 4, pa.int32()), pa.array(np.stack(edges, 1).ravel(), pa.int32()))
    lines = pa.StructArray.from_arrays([pa.array(numbers, pa.string()), united, pa.ListArray.from_arrays(offsets, own_words), pc.binary_join(texts, " ")], names=["line_id", "bbox", "words", "text"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), lines)


def grouped_lines(pages: DataFrame, key: str, tolerance: Column | None = None) -> DataFrame:
    """(key, page_num, lines): each page's own words grouped into lines by the running mean of their middles, within a tolerance in pixels (14 by default).

    A fold over the words of one page in one row; nothing is shuffled. Null words, words without a box, null and empty word arrays give no line.
    """
    tolerance = F.lit(14.0) if tolerance is None else tolerance
    schema = T.StructType([pages.schema[key], T.StructField("page_num", T.IntegerType()), T.StructField("lines", T.ArrayType(LINE))])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines = _grouped(b.column(2), b.column(1).to_pylist(), b.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lines], names=[key, "page_num", "lines"])

    return pages.select(key, "page_num", "words", F.coalesce(tolerance.cast("double"), F.lit(14.0)).alias("tolerance")).mapInArrow(fold, schema)
