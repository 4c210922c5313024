"""Books as text. A book's parts stay rows in order, however large the book; the sink puts them into one file piece by piece."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from .quality import Thresholds, low_quality, metrics, placeholder
from .render import raw_text, rendered


def page_text(pages: DataFrame, clean: bool = True, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """(book_id, page_num, display_page, scan_relpath, text): the text of each page, or what stands for it if it is of no use."""
    row = pages.withColumn("__l", F.coalesce("lines", F.array().cast(pages.schema["lines"].dataType))).withColumn("__m", metrics(F.col("__l")))
    text = rendered(F.col("__l")) if clean else raw_text(F.col("__l"))
    return row.select(
        "book_id",
        "page_num",
        F.coalesce("printed_page", "page_num").alias("display_page"),
        F.coalesce("scan_relpath", F.lit("")).alias("scan_relpath"),
        F.when(low_quality(F.col("__m"), thresholds), placeholder(F.col("__m"), F.col("scan_relpath"))).otherwise(text).alias("text"),
    )


def txt_parts(texts: DataFrame) -> DataFrame:
    """(book_id, page_num, part): one part per page; a book's parts in page order, joined by blank lines, are its text export."""
    return texts.select("book_id", "page_num", strip(F.concat(F.lit("# Page "), F.col("page_num"), F.lit("\n"), F.col("text"))).alias("part"))


def md_parts(texts: DataFrame, books: DataFrame) -> DataFrame:
    """(book_id, page_num, part_no, part): four parts per page (the last one empty), before the first page at page_num null the title and an empty part."""
    head = F.regexp_replace(F.concat(F.lit("## Page "), F.col("display_page"), F.lit(" (scan: "), F.col("scan_relpath"), F.lit(")")), r"\s+\z", "")
    pages = texts.select("book_id", "page_num", F.posexplode(F.array(head, strip(F.col("text")), F.lit("---"), F.lit(""))).alias("part_no", "part"))
    title = strip(F.concat(F.lit("# "), F.coalesce(F.nullif(F.col("title"), F.lit("")), F.col("book_id"))))
    known = books.join(texts.select("book_id").distinct(), "book_id", "left_semi")
    front = known.select("book_id", F.lit(None).cast("int").alias("page_num"), F.posexplode(F.array(title, F.lit(""))).alias("part_no", "part"))
    return front.unionByName(pages)
