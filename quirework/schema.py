"""Schemas of the page corpus."""

from __future__ import annotations

from pyspark.sql import types as T

BBOX = T.ArrayType(T.IntegerType(), True)

WORD = T.StructType([T.StructField("text", T.StringType()), T.StructField("bbox", BBOX), T.StructField("confidence", T.DoubleType())])

LINE = T.StructType(
    [
        T.StructField("line_id", T.StringType()),
        T.StructField("bbox", BBOX),
        T.StructField("words", T.ArrayType(WORD)),
        T.StructField("text", T.StringType()),
    ]
)

PAGE_CONFIG = T.StructType(
    [
        T.StructField("config_hash", T.StringType()),
        T.StructField("line_y_tolerance_px", T.IntegerType()),
        T.StructField("language", T.StringType()),
        T.StructField("psm", T.IntegerType()),
        T.StructField("printed_page_detect", T.BooleanType()),
        T.StructField("printed_page_top_band_frac", T.DoubleType()),
        T.StructField("printed_page_min_conf", T.DoubleType()),
        T.StructField("printed_page_roman_max", T.IntegerType()),
        T.StructField("printed_page_roman_min_len", T.IntegerType()),
        T.StructField("printed_page_arabic_switch_min", T.IntegerType()),
        T.StructField("printed_page_debug", T.BooleanType()),
    ]
)

PAGES = T.StructType(
    [
        T.StructField("book_id", T.StringType()),
        T.StructField("page_num", T.IntegerType()),
        T.StructField("scan_relpath", T.StringType()),
        T.StructField("ocr_engine", T.StringType()),
        T.StructField("config", PAGE_CONFIG),
        T.StructField("words", T.ArrayType(WORD)),
        T.StructField("lines", T.ArrayType(LINE)),
        T.StructField("printed_page", T.IntegerType()),
        T.StructField("printed_page_text", T.StringType()),
        T.StructField("printed_page_kind", T.StringType()),
    ]
)

CANDIDATE = T.StructType(
    [
        T.StructField("bbox", BBOX),
        T.StructField("area", T.IntegerType()),
        T.StructField(
            "color_stats",
            T.StructType([T.StructField(k, T.DoubleType()) for k in ("h_mean", "s_mean", "v_mean")]),
        ),
    ]
)

HIGHLIGHT_CONFIG = T.StructType(
    [
        T.StructField("hsv_low", T.ArrayType(T.IntegerType())),
        T.StructField("hsv_high", T.ArrayType(T.IntegerType())),
        T.StructField("min_area", T.IntegerType()),
        T.StructField("kernel_size", T.IntegerType()),
        T.StructField("edge_margin_px", T.IntegerType()),
        T.StructField("max_hw_ratio", T.DoubleType()),
        T.StructField("max_height_frac", T.DoubleType()),
        T.StructField("frame_crop_frac", T.DoubleType()),
    ]
)

HIGHLIGHT_CANDIDATES = T.StructType(
    [
        T.StructField("book_id", T.StringType()),
        T.StructField("page_num", T.IntegerType()),
        T.StructField("scan_filename", T.StringType()),
        T.StructField("candidates", T.ArrayType(CANDIDATE)),
        T.StructField("config", HIGHLIGHT_CONFIG),
    ]
)

SPAN = T.StructType(
    [
        T.StructField("span_id", T.StringType()),
        T.StructField("page_num", T.IntegerType()),
        T.StructField("line_ids", T.ArrayType(T.StringType())),
        T.StructField("trigger_bboxes", T.ArrayType(BBOX)),
        T.StructField("span_bbox", BBOX),
    ]
)

SPANS_DOC = T.StructType(
    [
        T.StructField("book_id", T.StringType()),
        T.StructField("page_num", T.IntegerType()),
        T.StructField("k_before", T.IntegerType()),
        T.StructField("k_after", T.IntegerType()),
        T.StructField("spans", T.ArrayType(SPAN)),
    ]
)
