"""Command line: ocr, detect-highlights, make-spans, emit-obsidian, export-book-text."""

from __future__ import annotations

import argparse
import importlib.util
import shutil
import sys
import traceback
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import __version__
from .errors import ConfigError, HighlightDependencyError, MissingPathError, OcrDependencyError, OverwriteError
from .functions.text import scan_side
from .operators import export, highlights, lines, notes, page_numbers, quality, render, spans
from .sinks import files as sink
from .sinks import png
from .sources import config as settings
from .sources import files as source


def _spark() -> SparkSession:
    return SparkSession.builder.appName("quirework").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def new_run_id() -> str:
    return datetime.now(UTC).strftime("%Y%m%dT%H%M%SZ")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quirework")
    p.add_argument("--version", action="version", version=__version__)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, run) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        c.add_argument("--book", required=True)
        c.add_argument("--pipeline", default="configs/pipeline.yaml")
        c.add_argument("--dry-run", action="store_true")
        c.add_argument("--overwrite", choices=sink.MODES, default="never")
        c.add_argument("--run-id", default=None)
        c.add_argument("--max-pages", type=int, default=None)
        c.set_defaults(run=run)
        return c

    c = command("ocr", run_ocr)
    c.add_argument("--out", default="corpus")
    c.add_argument("--runs", default="runs")
    c.add_argument("--words", default=None, help="tab-separated word boxes (page_num, text, conf, left, top, width, height) in place of an installed engine")
    c.add_argument("--printed-page-detect", action=argparse.BooleanOptionalAction, default=True)
    c.add_argument("--printed-page-top-band-frac", type=float, default=0.12)
    c.add_argument("--printed-page-min-conf", type=float, default=40.0)
    c.add_argument("--printed-page-roman-max", type=int, default=80)
    c.add_argument("--printed-page-roman-min-len", type=int, default=2)
    c.add_argument("--printed-page-arabic-switch-min", type=int, default=10)
    c.add_argument("--printed-page-debug", action="store_true")
    command("detect-highlights", run_highlights).add_argument("--runs", default="runs")
    c = command("make-spans", run_spans)
    c.add_argument("--runs", default="runs")
    c.add_argument("--corpus", default="corpus")
    c.add_argument("--k-before", type=int, default=2)
    c.add_argument("--k-after", type=int, default=2)
    c = command("emit-obsidian", run_notes)
    c.add_argument("--runs", default="runs")
    c.add_argument("--corpus", default="corpus")
    c.add_argument("--vault", default=None)
    c.add_argument("--template", default=None)
    c.add_argument("--sidecar-json", action=argparse.BooleanOptionalAction, default=True)
    c.add_argument("--no-clean-text", dest="clean_text", action="store_false")
    c = command("export-book-text", run_export)
    c.add_argument("--out", default="corpus")
    c.add_argument("--format", choices=("txt", "md"), default="txt")
    c.add_argument("--no-clean-text", dest="clean_text", action="store_false")
    return p


def _corpus(root: str, book_id: str) -> Path:
    return Path(root) / "books" / book_id / "pages.jsonl"


def _artifact(run_root: Path, book_id: str, name: str):
    """Column of an artifact's path by page_num."""
    return F.concat(F.lit(f"{run_root}/book_{book_id}/page_"), F.format_string("%04d", "page_num"), F.lit(f"/{name}"))


def _last_wins(pages: DataFrame) -> DataFrame:
    """Of pages with the same number the last in the file counts."""
    whole = F.struct(*[c for c in pages.columns])
    return pages.withColumn("__at", F.monotonically_increasing_id()).groupBy("page_num").agg(F.max_by(whole, "__at").alias("p")).select("p.*")


def _recognised(spark: SparkSession, paths: list[Path], language: str, psm: int) -> DataFrame:
    """(page_num, words) by the installed engine, one process per scan on the executors."""
    import pandas as pd

    pages = spark.createDataFrame([(n, str(p)) for n, p in enumerate(paths, 1)], "page_num int, path string").repartition(len(paths), "page_num")

    def run(frames):
        import pytesseract
        from PIL import Image

        for f in frames:
            for row in f.itertuples():
                with Image.open(row.path) as image:
                    d = pytesseract.image_to_data(image.convert("RGB"), lang=language, config=f"--psm {psm}", output_type=pytesseract.Output.DICT)
                yield pd.DataFrame({k: d[k] for k in ("text", "left", "top", "width", "height")} | {"conf": [str(c) for c in d["conf"]], "page_num": row.page_num, "at": range(len(d["text"]))})

    boxes = pages.mapInPandas(run, "text string, left int, top int, width int, height int, conf string, page_num int, at int")
    words = lines.usable_words(boxes).select("page_num", "at", F.struct("text", lines.box_of(F.col("left"), F.col("top"), F.col("width"), F.col("height")).alias("bbox"), "confidence").alias("w"))
    return words.groupBy("page_num").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "w"))), lambda x: x["w"]).alias("words"))


def run_ocr(args: argparse.Namespace) -> int:
    if not args.words and (importlib.util.find_spec("pytesseract") is None or importlib.util.find_spec("PIL") is None or shutil.which("tesseract") is None):
        raise OcrDependencyError("no recognition engine is installed; give word boxes with --words")
    book, conf, digest = settings.load_book(args.book, args.pipeline)
    run_root = Path(args.runs) / (args.run_id or new_run_id())
    paths = source.first_pages(source.discover_images(book.scans_path), args.max_pages)
    target = _corpus(args.out, book.book_id)
    sink.guard(target, sink.corpus_mode(args.overwrite))
    spark = _spark()
    ocr = conf["ocr"]
    words = source.read_word_boxes(spark, args.words) if args.words else _recognised(spark, paths, ocr["language"], ocr["psm"])
    images = source.image_frame(spark, paths).select("page_num", "height", "width", "path")
    empty = F.array().cast("array<struct<text:string,bbox:array<int>,confidence:double>>")
    pages = images.join(words, "page_num", "left").withColumn("words", F.coalesce("words", empty))
    grouped = lines.grouped_lines(pages.withColumn("key", F.col("page_num")), "key", F.lit(float(ocr["line_y_tolerance_px"]))).select("page_num", "lines")
    pages = pages.join(grouped, "page_num").withColumnRenamed("width", "page_width").withColumnRenamed("height", "page_height")
    relative = spark.createDataFrame([(n, source.relative(p, book.scans_path)) for n, p in enumerate(paths, 1)], "page_num int, scan_relpath string")
    detection = page_numbers.Detection(args.printed_page_top_band_frac, args.printed_page_min_conf, args.printed_page_roman_min_len, args.printed_page_roman_max, args.printed_page_arabic_switch_min)
    pages = pages.join(F.broadcast(relative), "page_num").withColumn("book_id", F.lit(book.book_id))
    debug = args.printed_page_debug and args.printed_page_detect
    if args.printed_page_detect:
        pages = page_numbers.switched(page_numbers.detected(pages, scan_side(F.col("scan_relpath")), detection, debug), switch_min=detection.arabic_switch_min)
    else:
        pages = pages.withColumns({"found_page": F.lit(None).cast("int"), "found_text": F.lit(None).cast("string"), "found_kind": F.lit(None).cast("string")})
    record_config = F.struct(
        F.lit(digest).alias("config_hash"),
        F.lit(int(ocr["line_y_tolerance_px"])).alias("line_y_tolerance_px"),
        F.lit(str(ocr["language"])).alias("language"),
        F.lit(int(ocr["psm"])).alias("psm"),
        F.lit(args.printed_page_detect).alias("printed_page_detect"),
        F.lit(detection.top_band_frac).alias("printed_page_top_band_frac"),
        F.lit(detection.min_conf).alias("printed_page_min_conf"),
        F.lit(detection.roman_max).alias("printed_page_roman_max"),
        F.lit(detection.roman_min_len).alias("printed_page_roman_min_len"),
        F.lit(detection.arabic_switch_min).alias("printed_page_arabic_switch_min"),
        F.lit(args.printed_page_debug).alias("printed_page_debug"),
    )
    found = [F.col("found_page").alias("printed_page"), F.col("found_text").alias("printed_page_text"), F.col("found_kind").alias("printed_page_kind")]
    seen = pages.select("book_id", "page_num", "scan_relpath", F.lit("tesseract+pytesseract").alias("ocr_engine"), record_config.alias("config"), "words", "lines", *found, *(["mode", "found_debug"] if debug else [])).persist()
    records = seen.drop("mode", "found_debug")
    # what a page's number was found from, and the state after it
    result = F.struct("printed_page", "printed_page_text", "printed_page_kind")
    tried = [F.struct("mode", result.alias("result"), F.col("found_debug").alias("candidates")).alias("printed_page_debug")] if debug else []
    text = render.raw_text(F.col("lines"))
    artifact = F.struct("book_id", "page_num", "scan_relpath", text.alias("text"), "words", "lines", "printed_page", "printed_page_text", "printed_page_kind", F.lit(digest).alias("config_hash"), *tried)
    try:
        sink.write_files(seen.select(_artifact(run_root, book.book_id, "page_text.json").alias("path"), sink.pretty(artifact).alias("content")), args.overwrite, run_root, args.dry_run)
        shapes = F.concat(F.transform("words", lambda w: _shape(w["bbox"], 0)), F.transform("lines", lambda x: _shape(x["bbox"], 1, x["line_id"])))
        _overlays(source.image_frame(spark, paths), records.select("page_num", shapes.alias("shapes")), (png.Style((60, 160, 255), 1), png.Style((255, 80, 80), 2)), "page_overlay.png", run_root, book.book_id, args)
        sink.write_corpus(records, target, args.overwrite, args.dry_run)
        print(f"Processed {records.count()} pages into {target}")
    finally:
        seen.unpersist()
    return 0


def run_highlights(args: argparse.Namespace) -> int:
    if importlib.util.find_spec("numpy") is None:
        raise HighlightDependencyError("numpy is not installed")
    book, conf, _ = settings.load_book(args.book, args.pipeline)
    run_root = Path(args.runs) / (args.run_id or new_run_id())
    paths = source.first_pages(source.discover_images(book.scans_path), args.max_pages)
    m = highlights.Marker.of(conf)
    found = highlights.detect(source.image_frame(_spark(), paths), m)
    echo = F.struct(*[(F.array(*map(F.lit, v)) if isinstance(v := getattr(m, k), tuple) else F.lit(v)).alias(k) for k in m.__dataclass_fields__])
    artifact = F.struct(F.lit(book.book_id).alias("book_id"), "page_num", F.col("file_name").alias("scan_filename"), "candidates", echo.alias("config"))
    rows = found.select(_artifact(run_root, book.book_id, "highlight_candidates.json").alias("path"), sink.pretty(artifact).alias("content"))
    n = len(sink.write_files(rows, args.overwrite, run_root, args.dry_run))
    images = source.image_frame(_spark(), paths)
    shapes = F.transform("candidates", lambda c, i: _shape(c["bbox"], 0, F.concat(F.lit("h"), i + 1)))
    _overlays(images, found.select("page_num", shapes.alias("shapes")), (png.Style((255, 0, 0), 2, 4, 16),), "highlights_overlay.png", run_root, book.book_id, args)
    mask = lambda row: highlights.marked_pixels(row["data"], row["height"], row["width"], row["channels"], m)[0].astype("uint8") * 255
    _pictures(images.withColumn("path", _artifact(run_root, book.book_id, "highlight_mask.png")), mask, run_root, args)
    print(f"Processed {n} pages under {run_root}")
    return 0


def _run_root(args: argparse.Namespace, book_id: str, name: str) -> tuple[Path, str]:
    run_id = args.run_id or source.latest_run(args.runs, book_id, name)
    if run_id is None:
        raise RuntimeError(f"no run with {name} under {args.runs}; give one with --run-id")
    return Path(args.runs) / run_id, run_id


def run_spans(args: argparse.Namespace) -> int:
    book, conf, _ = settings.load_book(args.book, args.pipeline)
    run_root, run_id = _run_root(args, book.book_id, "highlight_candidates.json")
    spark = _spark()
    pages = _last_wins(source.read_pages(spark, _corpus(args.corpus, book.book_id)))
    scans = source.discover_images(book.scans_path)
    s = conf["spans"]
    usual = spans.Selection()
    chosen = spans.Selection(args.k_before, args.k_after, *(type(d)(s.get(k, d)) for k in ("min_overlap_frac", "min_x_overlap_px", "max_overlap_lines") for d in [getattr(usual, k)]))
    candidates = source.read_candidates(spark, run_root, book.book_id, args.max_pages).withColumn("run_id", F.lit(run_id))
    made = spans.page_spans(candidates, pages, chosen)
    number = F.regexp_extract("span_id", r"_s(\d+)$", 1).cast("int")
    by_page = made.groupBy("book_id", "page_num").agg(F.transform(F.array_sort(F.collect_list(F.struct(number.alias("n"), F.struct("span_id", "page_num", "line_ids", "trigger_bboxes", "span_bbox").alias("s")))), lambda x: x["s"]).alias("spans"))
    # pages with lines get a file even if they have no candidate
    with_lines = candidates.select("book_id", "page_num").join(pages.where(F.size("lines") > 0).select("page_num"), "page_num", "left_semi")
    docs = with_lines.join(by_page, ["book_id", "page_num"], "left")
    empty = F.array().cast(by_page.schema["spans"].dataType)
    artifact = F.struct("book_id", "page_num", F.lit(args.k_before).alias("k_before"), F.lit(args.k_after).alias("k_after"), F.coalesce("spans", empty).alias("spans"))
    docs = docs.persist()
    try:
        n = len(sink.write_files(docs.select(_artifact(run_root, book.book_id, "spans.json").alias("path"), sink.pretty(artifact).alias("content")), args.overwrite, run_root, args.dry_run))
        # spans in green, their triggers in red
        shapes = F.flatten(F.transform("spans", lambda s: F.concat(F.array(_shape(s["span_bbox"], 0, s["span_id"])), F.transform(s["trigger_bboxes"], lambda b: _shape(b, 1)))))
        _overlays(source.image_frame(spark, scans), docs.where("spans is not null").select("page_num", shapes.alias("shapes")), (png.Style((0, 255, 0), 3, 14), png.Style((255, 0, 0), 2)), "spans_overlay.png", run_root, book.book_id, args)
    finally:
        docs.unpersist()
    print(f"Processed {n} pages under {run_root}")
    return 0


def _shape(box: Column, layer: int, label: Column | None = None) -> Column:
    return F.struct(box.alias("box"), (F.lit(None).cast("string") if label is None else label).alias("label"), F.lit(layer).alias("layer"))


def _pictures(images: DataFrame, made: Callable[[dict], np.ndarray], run_root: Path, args: argparse.Namespace) -> None:
    """A PNG at `path` of what is made of each row of decoded scans. One picture at a time is in memory besides its Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = {n: c[i].as_py() for n, c in zip(b.schema.names, b.columns, strict=True)}
                yield pa.RecordBatch.from_pydict({"path": [row["path"]], "content": pa.array([png.encode(made(row))], pa.binary())})

    sink.write_files(images.mapInArrow(run, "path string, content binary"), args.overwrite, run_root, args.dry_run, targets=images)


def _overlays(images: DataFrame, shapes: DataFrame, styles: tuple[png.Style, ...], name: str, run_root: Path, book_id: str, args: argparse.Namespace) -> None:
    """A drawn scan for each page of shapes (page_num, shapes) whose scan exists."""
    joined = images.select("page_num", "height", "width", "channels", "data").join(shapes, "page_num").withColumn("path", _artifact(run_root, book_id, name))
    _pictures(joined, lambda row: png.drawn(png.rgb(row["data"], row["height"], row["width"], row["channels"]), row["shapes"] or (), styles), run_root, args)


def run_notes(args: argparse.Namespace) -> int:
    book, conf, digest = settings.load_book(args.book, args.pipeline)
    run_root, run_id = _run_root(args, book.book_id, "spans.json")
    vault = Path(args.vault or book.vault_out_path or run_root / "obsidian_staging") / book.book_id
    if args.template and not Path(args.template).exists():
        raise RuntimeError(f"no such template: {args.template}")
    template = Path(args.template).read_text(encoding="utf-8") if args.template else notes.TEMPLATE
    spark = _spark()
    pages = _last_wins(source.read_pages(spark, _corpus(args.corpus, book.book_id)))
    docs = source.read_spans(spark, run_root, book.book_id, args.max_pages)
    given = docs.select(F.lit(run_id).alias("run_id"), F.lit(book.book_id).alias("book_id"), "page_num", F.explode("spans").alias("s")).select("run_id", "book_id", "page_num", "s.span_id", "s.line_ids", "s.trigger_bboxes", "s.span_bbox")
    pages = pages.withColumn("config", F.struct(F.lit(digest).alias("config_hash")))
    rows = notes.checked(notes.notes(given, pages, settings.book_frame(spark, book), template, args.clean_text, quality.Thresholds.of(conf))).persist()
    try:
        files = rows.select(F.concat(F.lit(f"{vault}/"), "note_name", F.lit(".md")).alias("path"), F.col("note").alias("content"))
        if args.sidecar_json:
            files = files.unionByName(rows.select(F.concat(F.lit(f"{vault}/"), "note_name", F.lit(".span.json")).alias("path"), sink.indented(notes.sidecar(rows)).alias("content")))
        sink.write_files(files, args.overwrite, run_root, args.dry_run)
        print(f"Emitted {rows.count()} notes to {vault}")
    finally:
        rows.unpersist()
    return 0


def run_export(args: argparse.Namespace) -> int:
    book, conf, _ = settings.load_book(args.book, args.pipeline)
    spark = _spark()
    path = _corpus(args.out, book.book_id)
    pages = source.read_pages(spark, path)
    if pages.isEmpty():
        raise RuntimeError(f"no pages in {path}")
    texts = export.page_text(pages.withColumn("book_id", F.lit(book.book_id)), args.clean_text, quality.Thresholds.of(conf))
    parts = export.txt_parts(texts).withColumn("part_no", F.lit(0)) if args.format == "txt" else export.md_parts(texts, settings.book_frame(spark, book))
    target = path.with_name(f"book.{args.format}")
    sink.write_ordered(parts, ["page_num", "part_no"], "part", target, "\n\n", sink.corpus_mode(args.overwrite), args.dry_run)
    print(f"Exported {target}")
    return 0


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        return args.run(args)
    except (ConfigError, MissingPathError) as e:
        print(e, file=sys.stderr)
        return 3
    except OverwriteError as e:
        print(e, file=sys.stderr)
        return 4
    except OcrDependencyError as e:
        print(e, file=sys.stderr)
        return 5
    except HighlightDependencyError as e:
        print(e, file=sys.stderr)
        return 6
    except Exception:  # noqa: BLE001
        traceback.print_exc()
        return 1


if __name__ == "__main__":
    sys.exit(main())
