"""Excerpt notes with provenance."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import file_name, is_blank, yaml_string
from .quality import Thresholds, low_quality, metrics, placeholder
from .render import raw_text, rendered

# The keys a note's front matter may have.
FRONT_KEYS = (
    "address", "aliases", "birthday", "book_read_today", "bridge_applicability_scope", "bridge_applied", "bridge_broken", "bridge_conditions",
    "bridge_isomorphism", "bridge_justification", "bridge_methods", "bridge_preservation", "bridge_required", "bridge_uuids", "canonical_name",
    "cash_out", "creator", "dislikes", "dream_location", "dream_lucidity", "dream_motif", "dream_motif_valence", "email", "entity_type", "first_met",
    "format", "from_mode", "from_register", "hypnagogic_resonance", "interface", "iso_broken", "iso_justification", "iso_structure", "layer", "likes",
    "note_status", "note_type", "note_version", "occupation", "origin", "phone", "pillar", "publisher_studio", "quarantine_reasons",
    "racing_thoughts_while_awake", "ran_script_when_racing", "ran_script_yesterday", "reactivity", "recall_ability", "register", "register_mode",
    "relationship", "revision_triggers", "rhetoric_allowed", "rhetorical_device", "root", "speculation_quarantine", "stop_rule", "tags",
    "temporal_pace", "tension_type", "title", "to_mode", "to_register", "transition_attempted", "unity_level", "uuid", "vector_direction",
    "YAML_schema_version", "year",
)

# Fixed value: the note template.
TEMPLATE = """---
uuid: {{uuid}}
note_version: {{note_version}}
YAML_schema_version: {{YAML_schema_version}}
note_type:
  - {{note_type}}
note_status:
  - {{note_status}}
tags:
{{tags_block}}
format:
  - {{format}}
title: {{title}}
creator: {{creator}}
year: {{year}}
publisher_studio: {{publisher_studio}}
register:
  - {{register}}
---

## Quote
{{quote_text}}

## Commentary
TODO

## Source
{{source_block}}
"""

DEFAULT_TAG = "ingest/highlight_excerpt"


def lines_by_id(lines: Column, ids: Column) -> Column:
    """The lines of the given ids, in their order; unknown ids are left out, of lines with the same id the last one counts."""
    return F.filter(F.transform(ids, lambda i: F.try_element_at(F.filter(lines, lambda x: x["line_id"] == i), F.lit(-1))), lambda x: x.isNotNull())


def tags_of(book_id: Column, tags: Column) -> Column:
    """The note's tags: the book's own first, each once, in order."""
    return F.array_distinct(F.concat(F.array(F.concat(F.lit("book/"), book_id), F.lit(DEFAULT_TAG)), F.filter(F.coalesce(tags, F.array().cast("array<string>")), lambda t: t.isNotNull())))


def tags_block(tags: Column) -> Column:
    rows = F.when(F.size(tags) > 0, tags).otherwise(F.array(F.lit(DEFAULT_TAG)))
    return F.array_join(F.transform(rows, lambda t: F.concat(F.lit("  - "), yaml_string(t))), "\n")


def source_block(book_id: Column, page_num: Column, scan: Column, span_id: Column, line_ids: Column, run_id: Column, config_hash: Column, printed_text: Column, printed_kind: Column) -> Column:
    row = lambda k, v: F.concat(F.lit(f"- {k}: "), F.coalesce(v.cast("string"), F.lit("")))
    text, kind = F.nullif(printed_text, F.lit("")), F.nullif(printed_kind, F.lit(""))
    printed = F.when(text.isNotNull(), F.concat(F.lit("- printed_page: "), text, F.coalesce(F.concat(F.lit(" ("), kind, F.lit(")")), F.lit(""))))
    return F.concat_ws("\n", row("book_id", book_id), row("page_num", page_num), row("scan_relpath", scan), row("span_id", span_id), row("line_ids", F.array_join(line_ids, ", ")), row("run_id", run_id), row("config_hash", config_hash), printed)


def fill(template: Column, values: dict[str, Column]) -> Column:
    """The template with each {{key}} replaced, key after key, so that a value may itself hold a later key."""
    for k, v in values.items():
        template = F.replace(template, F.lit("{{" + k + "}}"), F.coalesce(v, F.lit("")))
    return template


def front_matter(note: Column) -> Column:
    """The text between the leading fences; null if there is none."""
    return F.nullif(F.regexp_extract(note, r"(?s)\A---\r?\n(.*?)\r?\n---(?:\r?\n|\z)", 1), F.lit(""))


def front_keys(note: Column) -> Column:
    rows = F.filter(F.split(front_matter(note), r"\r?\n"), lambda r: r.rlike(r"\A[A-Za-z0-9_]+\s*:"))
    return F.array_distinct(F.transform(rows, lambda r: F.regexp_extract(r, r"\A([A-Za-z0-9_]+)", 1)))


def foreign_keys(note: Column) -> Column:
    """Front matter keys that are not allowed, sorted."""
    return F.array_sort(F.array_except(front_keys(note), F.array(*[F.lit(k) for k in FRONT_KEYS])))


@F.pandas_udf(T.BooleanType())
def is_yaml_mapping(texts: pd.Series) -> pd.Series:
    """Whether a text is a YAML mapping. There is no YAML parser in the JVM; texts come in Arrow batches."""
    import yaml

    def is_mapping(text: str | None) -> bool:
        try:
            return text is not None and isinstance(yaml.safe_load(text), dict)
        except yaml.YAMLError:
            return False

    return texts.map(is_mapping).astype(bool)


def notes(spans: DataFrame, pages: DataFrame, books: DataFrame, template: str = TEMPLATE, clean: bool = True, thresholds: Thresholds = Thresholds(), uuid: Column | None = None) -> DataFrame:
    """One row per span: run_id, book_id, page_num, span_id, note_name, title, quote, tags, source, note, and what the sidecar holds.

    spans has run_id, book_id, page_num, span_id, line_ids, trigger_bboxes, span_bbox; pages must be unique per (book_id, page_num), books per book_id. Spans without
    a page or book give no row, neither do spans whose quote is blank; spans without any known line get the low-quality placeholder.
    """
    page = pages.select("book_id", "page_num", "lines", "scan_relpath", F.col("config.config_hash").alias("config_hash"), "printed_page", "printed_page_text", "printed_page_kind")
    book = books.select("book_id", *[F.col(c).alias(f"b_{c}") for c in ("title", "creator", "year", "format", "publisher_studio", "note_type", "note_status", "note_version", "yaml_schema_version", "register", "tags")])
    row = spans.join(page, ["book_id", "page_num"]).join(book, "book_id")
    row = row.withColumn("__q", F.coalesce(lines_by_id(F.col("lines"), F.col("line_ids")), F.slice("lines", 1, 0))).withColumn("__m", metrics(F.col("__q")))
    text = rendered(F.col("__q")) if clean else raw_text(F.col("__q"))
    # the gate is decided before the placeholder is written, so that no Python function stands in the filter
    row = row.withColumns({"__low": low_quality(F.col("__m"), thresholds), "__t": text}).where(F.col("__low") | ~is_blank(F.col("__t")))
    row = row.withColumn("quote", F.when(F.col("__low"), placeholder(F.col("__m"), F.col("scan_relpath"))).otherwise(F.col("__t")))
    title = F.concat(F.coalesce(F.nullif(F.col("b_title"), F.lit("")), F.col("book_id")), F.lit(" p"), F.col("page_num"), F.lit(" "), F.col("span_id"))
    row = row.withColumns(
        {
            "title": title,
            "note_name": file_name(F.concat("book_id", F.lit("_"), "span_id")),
            "tags": tags_of(F.col("book_id"), F.col("b_tags")),
            "source": source_block(F.col("book_id"), F.col("page_num"), F.col("scan_relpath"), F.col("span_id"), F.col("line_ids"), F.col("run_id"), F.col("config_hash"), F.col("printed_page_text"), F.col("printed_page_kind")),
        }
    )
    q = lambda c: yaml_string(F.col(c))
    values = {
        "uuid": yaml_string(F.uuid() if uuid is None else uuid),
        "note_version": q("b_note_version"),
        "YAML_schema_version": q("b_yaml_schema_version"),
        "note_type": q("b_note_type"),
        "note_status": q("b_note_status"),
        "tags_block": tags_block(F.col("tags")),
        "format": q("b_format"),
        "title": q("title"),
        "creator": q("b_creator"),
        "year": q("b_year"),
        "publisher_studio": q("b_publisher_studio"),
        "register": q("b_register"),
        "quote_text": F.col("quote"),
        "source_block": F.col("source"),
    }
    row = row.withColumn("note", fill(F.lit(template), values))
    printed = F.coalesce(F.nullif(F.col("printed_page_text"), F.lit("")), F.col("printed_page").cast("string"))
    return row.select(
        "run_id", "book_id", "page_num", "span_id", "note_name", "title", "quote", "tags", "source", "note", "line_ids", "trigger_bboxes", "span_bbox", "config_hash", "scan_relpath", printed.alias("printed_page")
    )


def sidecar(rows: DataFrame) -> Column:
    """A note's provenance as JSON; a missing printed page is left out."""
    return F.to_json(F.struct(*[rows[c] for c in ("book_id", "page_num", "span_id", "line_ids", "trigger_bboxes", "span_bbox", "run_id", "config_hash", "scan_relpath", "printed_page")]))


def checked(rows: DataFrame) -> DataFrame:
    """rows, failing on the first note whose front matter has a foreign key, is missing or is no YAML mapping."""
    bad = foreign_keys(F.col("note"))
    ok = F.when(front_matter(F.col("note")).isNull(), F.raise_error(F.lit("note without front matter")).cast("string")).when(F.size(bad) > 0, F.raise_error(F.concat(F.lit("front matter keys not allowed: "), F.array_join(bad, ", "))).cast("string")).when(
        ~is_yaml_mapping(front_matter(F.col("note"))), F.raise_error(F.lit("front matter is no YAML mapping")).cast("string")
    )
    return rows.withColumn("note", F.coalesce(ok, F.col("note")))
