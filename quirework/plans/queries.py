"""Registered queries of the core: each takes a session and a folder of tables. The SQL they are held against is in `oracles`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import export, lines, nested, notes, page_numbers, quality, render, spans
from ..operators.pages import boxed_lines, latest, ordinal
from ..sources import config
from .oracles import ORACLES  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all words and of all lines without words in raw_pages.payload."""
    return nested.page_positions(table(spark, sf_dir, "raw_pages"))


def _raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return nested.page_tables(table(spark, sf_dir, "raw_pages"))


def p1_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of raw_pages.payload as a flat table."""
    return _raw_tables(spark, sf_dir)["records"].select("raw_id", "rec_pos", "book_id", "page_num")


def p1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of raw_pages.payload as a flat table, linked to their record by position."""
    return _raw_tables(spark, sf_dir)["lines"].select("raw_id", "rec_pos", "line_pos", "line_id", "text")


def p1_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of raw_pages.payload as a flat table, linked to record and line by position; a record's own words stand at line_pos -1."""
    return _raw_tables(spark, sf_dir)["words"].select("raw_id", "rec_pos", "line_pos", "word_pos", "text")


def p1_page_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words level of page_records as a flat table, linked to record and line by position."""
    pages = table(spark, sf_dir, "page_records").select("record_id", "lines")
    words = nested.flatten_struct(pages, "record_id")["lines.words"]
    return words.select("record_id", "line_pos", "word_pos", "text", "confidence")



def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "page_records")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(_records(spark, sf_dir))


def q_text_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text metrics of every page record."""
    m = _records(spark, sf_dir).select("record_id", quality.metrics(F.col("lines")).alias("m"))
    return m.select("record_id", "m.char_count", "m.line_count", *[F.round(F.col(f"m.{c}"), 9).alias(c) for c in ("avg_word_conf", "alpha_ratio", "garbage_ratio", "pipe_ratio")])


def q_low_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which page records are of no use, with the ratios that decide."""
    m = _records(spark, sf_dir).select("record_id", quality.metrics(F.col("lines")).alias("m"))
    return m.select("record_id", quality.low_quality(F.col("m")).alias("low_quality"), F.round("m.alpha_ratio", 9).alias("alpha_ratio"), F.round("m.garbage_ratio", 9).alias("garbage_ratio"))


def q_clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readable lines of every page record, without noise."""
    return _records(spark, sf_dir).select("record_id", F.posexplode(render.clean_lines(F.col("lines"))).alias("line_no", "text"))


def q_hyphen_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readable lines of every page record, broken words joined."""
    return _records(spark, sf_dir).select("record_id", F.posexplode(render.merge_hyphens(render.clean_lines(F.col("lines")))).alias("line_no", "text"))


def q_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered text of every page record."""
    return _records(spark, sf_dir).select("record_id", render.rendered(F.col("lines")).alias("text"))


def q_clean_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token of every page record's lines, bare, and whether it is noise."""
    at = _records(spark, sf_dir).select("record_id", F.posexplode("lines").alias("line_pos", "line")).where("line is not null")
    bare = at.select("record_id", "line_pos", F.posexplode(render.bare_tokens(F.col("line"))).alias("token_pos", "x"))
    return bare.select("record_id", "line_pos", "token_pos", F.col("x.t").alias("token"), render.is_junk(F.col("x.t"), F.col("x.c")).alias("junk"))


def q_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of every page record as its artifact has it: lines that are not blank, one below the other."""
    return _records(spark, sf_dir).select("record_id", render.raw_text(F.col("lines")).alias("text"))


def q_word_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of an engine's word table made from the pages' words, as a recognition engine would give them, and of these the usable ones with their boxes."""
    words = _records(spark, sf_dir).select("record_id", F.posexplode("words").alias("word_pos", "w")).where(F.size("w.bbox") == 4)
    conf = F.when(F.col("word_pos") % 7 == 3, "-1").when(F.col("word_pos") % 11 == 5, "n/a").otherwise(F.col("w.confidence").cast("string"))
    b = F.col("w.bbox")
    # some rows are layout blocks without text, some have no width
    text = F.when(F.col("word_pos") % 13 == 6, F.lit(" \u00a0")).otherwise(F.col("w.text"))
    table_ = words.select("record_id", "word_pos", text.alias("text"), conf.alias("conf"), b[0].alias("left"), b[1].alias("top"), F.when(F.col("word_pos") % 17 == 9, 0).otherwise(b[2] - b[0]).alias("width"), (b[3] - b[1]).alias("height"))
    return lines.usable_words(table_).select("record_id", "word_pos", "text", F.round("confidence", 6).alias("confidence"), F.array_join(lines.box_of(F.col("left"), F.col("top"), F.col("width"), F.col("height")), ",").alias("bbox"))


def q_roman_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roman value of every printed page text."""
    t = F.col("printed_page_text")
    return _records(spark, sf_dir).where(t.isNotNull()).select("record_id", X.roman_letters(t).alias("letters"), X.roman_value(t).alias("value"))


def _detected(spark: SparkSession, sf_dir: str, pages: DataFrame) -> DataFrame:
    return page_numbers.detected(pages, X.scan_side(F.coalesce("scan_relpath", F.lit(""))))


def q_printed_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The printed page number detected on every page record."""
    return _detected(spark, sf_dir, _records(spark, sf_dir)).select("record_id", "found_page", "found_text", "found_kind")


def q_printed_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best candidates of every page record's printed page number, without internal fields."""
    seen = page_numbers.detected(_records(spark, sf_dir), X.scan_side(F.coalesce("scan_relpath", F.lit(""))), debug=True).select("record_id", F.col("found_debug").alias("d"))

    def ranked(kind: str) -> Column:
        return F.transform(f"d.{kind}_top_candidates", lambda c, i: F.struct(F.lit(kind).alias("kind"), (i + 1).alias("rank"), c.alias("c")))

    both = F.concat(ranked("arabic"), ranked("roman"))
    at = seen.select("record_id", F.explode(both).alias("x")).select("record_id", "x.kind", "x.rank", "x.c.*")
    return at.select("record_id", "kind", "rank", "text", F.round("conf", 6).alias("conf"), F.array_join("bbox", ",").alias("bbox"), F.round("x_center_norm", 9).alias("x"), F.round("y_center_norm", 9).alias("y"), "source", F.coalesce("line_id", F.lit("")).alias("line_id"))


def q_page_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Printed page numbers of the latest record of each page after the switch to arabic."""
    out = page_numbers.switched(_pages(spark, sf_dir).select("record_id", "book_id", "page_num", "printed_page", "printed_page_text", "printed_page_kind"), "printed_page", "printed_page_text", "printed_page_kind")
    return out.select("book_id", "page_num", "printed_page", "printed_page_kind", "mode")


def q_scan_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).where("scan_relpath is not null").select("record_id", X.scan_side(F.col("scan_relpath")).alias("side"))


def q_natural_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each scan in its book by natural file name order."""
    names = _pages(spark, sf_dir).where("scan_relpath is not null").select("book_id", F.regexp_extract("scan_relpath", "([^/]*)$", 1).alias("name"), "record_id")
    return ordinal(names, "book_id", X.natural_key(F.col("name")), "name", "record_id").select("book_id", "record_id", "ordinal")


def q_line_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page record's own words grouped into lines."""
    grouped = lines.grouped_lines(_records(spark, sf_dir), "record_id", F.col("config.line_y_tolerance_px"))
    return grouped.select("record_id", F.posexplode("lines").alias("line_pos", "l")).select("record_id", "line_pos", "l.line_id", "l.text", F.array_join("l.bbox", ",").alias("bbox"))


def q_line_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the latest record of each page."""
    at = _pages(spark, sf_dir).select("book_id", "page_num", F.posexplode("lines").alias("line_pos", "l")).where("l is not null")
    return at.select("book_id", "page_num", "line_pos", "l.line_id", "l.text")


def q_shape_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which highlight candidates have the shape of a highlight, by their run's settings."""
    pages = _pages(spark, sf_dir).select("book_id", "page_num", "page_width", "page_height")
    c = table(spark, sf_dir, "highlight_candidates").select("run_id", "book_id", "page_num", "config", F.posexplode("candidates").alias("cand_no", "c")).where(F.size("c.bbox") == 4)
    ok = spans.shape_ok(F.col("c.bbox"), F.col("page_width"), F.col("page_height"), F.col("config.edge_margin_px"), F.col("config.max_hw_ratio"), F.col("config.max_height_frac"))
    return c.join(pages, ["book_id", "page_num"]).select("run_id", "book_id", "page_num", "cand_no", ok.alias("ok"))


def _met(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir).select("book_id", "page_num", boxed_lines(F.col("lines")).alias("ls")).where(F.size("ls") > 0)
    c = table(spark, sf_dir, "highlight_candidates").select("run_id", "book_id", "page_num", F.posexplode("candidates").alias("cand_no", "c")).where(F.size("c.bbox") == 4)
    return c.join(pages, ["book_id", "page_num"])


def q_trigger_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that each highlight candidate selects."""
    hit = F.array_sort(spans.selected_lines(F.col("ls"), F.col("c.bbox")))
    return _met(spark, sf_dir).select("run_id", "book_id", "page_num", "cand_no", F.array_join(hit.cast("array<string>"), ",").alias("picked"))


def q_trigger_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which lines of its page each highlight candidate overlaps, by how much, and whether enough."""
    seen = F.transform(spans.lines_seen(F.col("ls"), F.col("c.bbox")), lambda x: x.withField("line_no", x["i"]))
    at = _met(spark, sf_dir).select("run_id", "book_id", "page_num", "cand_no", F.explode(F.filter(seen, lambda x: x["area"] > 0)).alias("x"))
    return at.select("run_id", "book_id", "page_num", "cand_no", "x.line_no", "x.area", "x.w", "x.h", "x.hit")


def q_trigger_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line of its page whose middle is nearest to each highlight candidate's."""
    nearest = F.array_min(spans.lines_seen(F.col("ls"), F.col("c.bbox")))
    return _met(spark, sf_dir).select("run_id", "book_id", "page_num", "cand_no", nearest["i"].alias("line_no"), nearest["off"].alias("off"))


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.page_spans(table(spark, sf_dir, "highlight_candidates"), _pages(spark, sf_dir))


def q_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of all highlight candidates."""
    return _spans(spark, sf_dir).select(
        "run_id", "book_id", "page_num", "span_id", F.array_join("line_ids", ",").alias("line_ids"), F.array_join(F.transform("trigger_bboxes", lambda b: F.array_join(b, ",")), ";").alias("triggers"), F.array_join("span_bbox", ",").alias("span_bbox")
    )


def _notes(spark: SparkSession, sf_dir: str, clean: bool) -> DataFrame:
    given = table(spark, sf_dir, "page_spans").select("run_id", "book_id", "page_num", F.explode("spans").alias("s")).select("run_id", "book_id", "page_num", "s.span_id", "s.line_ids", "s.trigger_bboxes", "s.span_bbox")
    return notes.notes(given, _pages(spark, sf_dir), table(spark, sf_dir, "books"), clean=clean, uuid=F.lit("0"))


def q_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The notes of all given spans, as they are written, with their sidecars."""
    rows = _notes(spark, sf_dir, True)
    return rows.select("run_id", "book_id", "page_num", "span_id", "note_name", "note", notes.sidecar(rows).alias("sidecar"))


def q_notes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote, title, tags and printed page of the notes of all given spans, quotes as recognised."""
    return _notes(spark, sf_dir, False).select("run_id", "book_id", "page_num", "span_id", "note_name", "title", "quote", notes.tags_block(F.col("tags")).alias("tags_block"), "printed_page")


def q_source_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _notes(spark, sf_dir, False).select("run_id", "book_id", "page_num", "span_id", "source")


def q_sidecar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The provenance of the notes of all given spans."""
    rows = _notes(spark, sf_dir, True)
    return rows.select("run_id", "book_id", "page_num", "span_id", notes.sidecar(rows).alias("sidecar"))


def q_frontmatter_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of every note's front matter, those not allowed, and whether it is a YAML mapping of allowed keys; also of the note broken in five ways."""
    n = F.col("note")
    broken = [
        n,
        F.concat(F.lit("x"), n),
        F.replace(n, F.lit("note_version:"), F.lit("zeta: 1\nversion: 2\n  inner: 3\nnote_version:")),
        F.replace(n, F.lit("creator:"), F.lit('creator: "open\ntitle_2:')),
        F.concat(F.lit("---\n- a\n- b\n---\n"), n),
        F.replace(n, F.lit("\n---\n"), F.lit("\n--\n")),
    ]
    at = _notes(spark, sf_dir, False).select("run_id", "book_id", "page_num", "span_id", F.posexplode(F.array(*broken)).alias("variant", "note"))
    listed = lambda keys: F.coalesce(F.array_join(keys, ","), F.lit(""))
    ok = (F.size(notes.foreign_keys(n)) == 0) & notes.is_yaml_mapping(notes.front_matter(n))
    return at.select("run_id", "book_id", "page_num", "span_id", "variant", listed(F.array_sort(notes.front_keys(n))).alias("keys"), listed(notes.foreign_keys(n)).alias("foreign"), F.coalesce(ok, F.lit(False)).alias("ok"))


def q_config_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The settings hash of every book whose file gives its id and scans only, under the default pipeline settings."""
    return table(spark, sf_dir, "books").select("book_id", config.hash_of(F.col("book_id"), F.col("scans_path")).alias("config_hash"))


def q_export_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of every book's text export."""
    return export.txt_parts(export.page_text(_pages(spark, sf_dir)))


def q_export_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of every book's text export, text as recognised."""
    return export.txt_parts(export.page_text(_pages(spark, sf_dir), clean=False))


def q_export_md(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of every book's Markdown export."""
    return export.md_parts(export.page_text(_pages(spark, sf_dir)), table(spark, sf_dir, "books"))


def q_filename_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "books").select("book_id", X.file_name(F.coalesce("title", F.lit(""))).alias("name"))


def q_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "books").select("book_id", F.array_join(notes.tags_of(F.col("book_id"), F.col("tags")), "|").alias("tags"))


QUERIES: dict[str, Query] = {name: f for name, f in globals().items() if name.startswith(("p1_", "q_")) and callable(f)}
