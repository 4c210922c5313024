"""Scans, corpora, run artifacts and word boxes from files."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import MissingPathError
from ..operators.lines import box_of, usable_words
from ..schema import HIGHLIGHT_CANDIDATES, PAGES, SPANS_DOC

#: Suffixes of scans, in any case.
IMAGE_SUFFIXES = (".png", ".jpg", ".jpeg", ".tif", ".tiff")


def natural_order(name: str) -> list[tuple[int, int, str]]:
    """Sort key by which p_2 comes before p_10, whatever the case."""
    return [(0, int(t), "") if t.isdigit() else (1, 0, t) for t in re.findall(r"\d+|\D+", name.lower())]


def discover_images(folder: str | Path) -> list[Path]:
    """The scans of a folder in natural order; their 1-based places are the page numbers. The folder must exist and hold one at least; subfolders are not read."""
    root = Path(folder)
    if not root.is_dir():
        raise MissingPathError(f"no such folder: {folder}")
    found = [p for p in root.iterdir() if p.is_file() and p.suffix.lower() in IMAGE_SUFFIXES]
    if not found:
        raise MissingPathError(f"no scans in {folder}")
    return sorted(found, key=lambda p: (natural_order(p.name), p.name))


def relative(path: Path, root: str | Path) -> str:
    """A path as seen from a folder; its name alone if it leads out of it."""
    whole, base = path.resolve(), Path(root).resolve()
    return whole.relative_to(base).as_posix() if whole.is_relative_to(base) else path.name


def first_pages(paths: list[Path], most: int | None) -> list[Path]:
    return paths[:most] if most is not None and most > 0 else paths


def image_frame(spark: SparkSession, paths: list[Path]) -> DataFrame:
    """(page_num, path, height, width, channels, data): decoded scans, BGR row by row. A scan that cannot be read fails the job when it is reached."""
    pages = spark.createDataFrame([(n, p.name, str(p)) for n, p in enumerate(paths, 1)], "page_num int, file_name string, path string")
    images = spark.read.format("image").option("dropInvalid", False).load([f"file://{p}" for p in paths])
    name = F.regexp_extract("image.origin", r"([^/]*)$", 1)
    got = images.select(F.col("image.height").alias("height"), F.col("image.width").alias("width"), F.col("image.nChannels").alias("channels"), F.col("image.data").alias("data"), name.alias("file_name"))
    joined = got.join(F.broadcast(pages), "file_name")
    bad = F.when(F.col("height") <= 0, F.raise_error(F.concat(F.lit("unreadable scan: "), F.col("path"))).cast("int"))
    return joined.withColumn("height", F.coalesce(bad, F.col("height")))


def read_pages(spark: SparkSession, path: str | Path) -> DataFrame:
    """A canonical corpus: one page per line. A missing file raises FileNotFoundError, a malformed line fails the job."""
    if not Path(path).exists():
        raise FileNotFoundError(path)
    return spark.read.schema(PAGES).option("mode", "FAILFAST").json(f"file://{Path(path).resolve()}")


def _artifacts(spark: SparkSession, run_root: Path, book_id: str, name: str, schema, most: int | None) -> DataFrame:
    files = first_pages(sorted(run_root.glob(f"book_{book_id}/page_*/{name}")), most)
    if not files:
        raise RuntimeError(f"no {name} under {run_root}")
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json([f"file://{p.resolve()}" for p in files])


def read_candidates(spark: SparkSession, run_root: str | Path, book_id: str, most: int | None = None) -> DataFrame:
    return _artifacts(spark, Path(run_root), book_id, "highlight_candidates.json", HIGHLIGHT_CANDIDATES, most)


def read_spans(spark: SparkSession, run_root: str | Path, book_id: str, most: int | None = None) -> DataFrame:
    return _artifacts(spark, Path(run_root), book_id, "spans.json", SPANS_DOC, most)


def latest_run(runs: str | Path, book_id: str, name: str) -> str | None:
    """The last run by name that has at least one such file of the book."""
    root = Path(runs)
    if not root.is_dir():
        return None
    return next((d.name for d in sorted((d for d in root.iterdir() if d.is_dir()), key=lambda d: d.name, reverse=True) if any(d.glob(f"book_{book_id}/page_*/{name}"))), None)


def read_word_boxes(spark: SparkSession, path: str) -> DataFrame:
    """(page_num, words): the words of an engine's tab-separated output with page_num, text, conf, left, top, width, height, in the order of the file."""
    boxes = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(path)
    typed = boxes.select(F.col("page_num").cast("int"), "text", "conf", *[F.expr(f"try_cast(`{c}` as int)").alias(c) for c in ("left", "top", "width", "height")], F.monotonically_increasing_id().alias("at"))
    words = usable_words(typed).select("page_num", "at", F.struct("text", box_of(F.col("left"), F.col("top"), F.col("width"), F.col("height")).alias("bbox"), "confidence").alias("w"))
    # the words of one page are bounded
    return words.groupBy("page_num").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "w"))), lambda x: x["w"]).alias("words"))
