"""Highlight boxes to text lines with context: which lines a box meets, the window around them, and equal windows merged.

A page's lines stay nested: a box meets the lines of its own page inside one row, so that the spatial condition needs no join of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import let
from .pages import boxed_lines


@dataclass(frozen=True)
class Selection:
    k_before: int = 2
    k_after: int = 2
    min_overlap_frac: float = 0.02
    min_x_overlap_px: int = 40
    max_overlap_lines: int = 8


def shape_ok(bbox: Column, page_width: Column, page_height: Column, edge_margin_px: Column, max_hw_ratio: Column, max_height_frac: Column) -> Column:
    """Whether a component's box may be a highlight: not too tall, neither for its width nor for the page, and less so near the side edges."""
    w, h = F.greatest(F.lit(1), bbox[2] - bbox[0]), F.greatest(F.lit(1), bbox[3] - bbox[1])
    share = h / F.greatest(F.lit(1), page_height)
    near_edge = (bbox[0] <= edge_margin_px) | (bbox[2] >= page_width - edge_margin_px)
    return ~((h / w > max_hw_ratio) | (share > max_height_frac) | (near_edge & (share > max_height_frac * 0.6)))


def overlap(line: Column, box: Column) -> Column:
    """struct(area, w, h) of the common rectangle; zeros if the boxes only touch or lie apart."""
    w = F.least(line[2], box[2]) - F.greatest(line[0], box[0])
    h = F.least(line[3], box[3]) - F.greatest(line[1], box[1])
    meet = (w > 0) & (h > 0)
    zero = F.lit(0)
    return F.struct(F.when(meet, w * h).otherwise(zero).alias("area"), F.when(meet, w).otherwise(zero).alias("w"), F.when(meet, h).otherwise(zero).alias("h"))


def lines_seen(lines: Column, box: Column, s: Selection = Selection()) -> Column:
    """array<struct<off, i, area, w, h, hit>>: each line's distance from a box, its position, the common rectangle, and whether the overlap is enough."""
    middle = (box[1] + box[3]) / 2.0

    def seen(x: Column, i: Column) -> Column:
        size = F.greatest(F.lit(1), (x["bbox"][2] - x["bbox"][0]) * (x["bbox"][3] - x["bbox"][1]))
        off = F.abs((x["bbox"][1] + x["bbox"][3]) / 2.0 - middle)
        hit = lambda o: (o["area"] > 0) & ((o["area"] / size >= s.min_overlap_frac) | ((o["w"] >= s.min_x_overlap_px) & (o["h"] > 0)))
        return let(overlap(x["bbox"], box), lambda o: F.struct(off.alias("off"), i.alias("i"), o["area"].alias("area"), o["w"].alias("w"), o["h"].alias("h"), hit(o).alias("hit")))

    return F.transform(lines, seen)


def selected_lines(lines: Column, box: Column, s: Selection = Selection()) -> Column:
    """Positions of the lines a box selects: those it overlaps enough; only the nearest of them if they are too many; the page's nearest line if there is none."""
    nearest = lambda a: F.array(F.array_min(a)["i"])  # noqa: E731  (least distance, then least position)

    def chosen(seen: Column, hits: Column) -> Column:
        return F.when(F.size(hits) > s.max_overlap_lines, nearest(hits)).when(F.size(hits) > 0, F.transform(hits, lambda x: x["i"])).otherwise(nearest(seen))

    return let(lines_seen(lines, box, s), lambda seen: let(F.filter(seen, lambda x: x["hit"]), lambda hits: chosen(seen, hits)))


def page_spans(candidates: DataFrame, pages: DataFrame, s: Selection = Selection()) -> DataFrame:
    """(run_id, book_id, page_num, span_id, line_ids, trigger_bboxes, span_bbox) for every span of every candidate row.

    pages must be unique per (book_id, page_num). Candidate rows whose page is missing or has no placeable line give nothing, neither do empty candidate lists. Spans with the
    same lines are one, with their triggers in order; they are numbered in order of their first candidate.
    """
    lines = pages.select("book_id", "page_num", F.transform(boxed_lines(F.col("lines")), lambda x: F.struct(x["line_id"].alias("line_id"), x["bbox"].alias("bbox"))).alias("ls")).where(F.size("ls") > 0)
    c = candidates.select("run_id", "book_id", "page_num", F.posexplode("candidates").alias("at", "c")).where(F.size("c.bbox") == 4)
    met = c.join(lines, ["book_id", "page_num"]).select("run_id", "book_id", "page_num", "at", F.col("c.bbox").alias("box"), "ls")
    picked = met.withColumn("hit", F.array_sort(selected_lines(F.col("ls"), F.col("box"), s)))
    picked = picked.withColumn("anchor", F.get("hit", F.floor(F.size("hit") / 2).cast("int")))
    first = F.greatest(F.lit(0), F.col("anchor") - s.k_before)
    last = F.least(F.size("ls") - 1, F.col("anchor") + s.k_after)
    window = picked.withColumn("w", F.slice("ls", first + 1, last - first + 1)).select(
        "run_id",
        "book_id",
        "page_num",
        "at",
        "box",
        F.transform("w", lambda x: x["line_id"]).alias("line_ids"),
        F.array(
            F.array_min(F.transform("w", lambda x: x["bbox"][0])),
            F.array_min(F.transform("w", lambda x: x["bbox"][1])),
            F.array_max(F.transform("w", lambda x: x["bbox"][2])),
            F.array_max(F.transform("w", lambda x: x["bbox"][3])),
        ).alias("sb"),
    )
    # a page has a bounded number of highlights, so its boxes may be collected
    merged = window.groupBy("run_id", "book_id", "page_num", "line_ids").agg(
        F.min("at").alias("first"),
        F.transform(F.array_sort(F.collect_list(F.struct("at", "box"))), lambda x: x["box"]).alias("trigger_bboxes"),
        F.array(F.min(F.get("sb", F.lit(0))), F.min(F.get("sb", F.lit(1))), F.max(F.get("sb", F.lit(2))), F.max(F.get("sb", F.lit(3)))).alias("span_bbox"),
    )
    number = F.row_number().over(Window.partitionBy("run_id", "book_id", "page_num").orderBy("first"))
    return merged.select("run_id", "book_id", "page_num", F.concat(F.lit("p"), "page_num", F.lit("_s"), number).alias("span_id"), "line_ids", "trigger_bboxes", "span_bbox")
