"""Registered queries of the training-data operators, and the SQL that some of them can be held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import leaks, personal, pieces, prose, repair, repeats, sentences, tokens

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and joined pages of page_records that are longer than 2,000 characters."""
    pages = table(spark, sf_dir, "page_records").select("record_id", "lines")
    return pieces.oversized(pieces.page_items(pages), ["record_id", "line_pos"])


def p2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines and joined pages as pieces of at most 2,000 characters."""
    pages = table(spark, sf_dir, "page_records").select("record_id", "lines")
    return pieces.split_items(pieces.page_items(pages), ["record_id", "line_pos"])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of page_records whose content recurs in their book."""
    return repeats.repeated_lines(table(spark, sf_dir, "page_records"))


def p3_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's text without the recurring lines."""
    return repeats.cleaned_pages(table(spark, sf_dir, "page_records"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken and misread words, headers and page numbers of page_records."""
    return repair.found(table(spark, sf_dir, "page_records"))


def p4_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as continuous readable paragraphs."""
    return repair.repaired(table(spark, sf_dir, "page_records"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places where the sentences of running text end."""
    return sentences.sentence_ends(table(spark, sf_dir, "page_records"))


def p5_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence of running text with the place where it ends."""
    return sentences.sentence_units(table(spark, sf_dir, "page_records"))


def p6_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, distance from prose, contributions and kind of every page."""
    return prose.classified(table(spark, sf_dir, "page_records"), table(spark, sf_dir, "common_words"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose body is a list, a table or junk."""
    return p6_stats(spark, sf_dir).where("kind <> 'prose'").select("record_id", "kind")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by byte_bpe_50k."""
    return tokens.encode(table(spark, sf_dir, "documents"))


def p7_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return tokens.decode(p7_ids(spark, sf_dir))


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of held-out items, with BM25 score and longest common run."""
    return leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of held-out items."""
    return p8_leaks(spark, sf_dir).select("doc_id", "item_id")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of personal information in documents."""
    return personal.places(table(spark, sf_dir, "documents"), table(spark, sf_dir, "given_names"))


def p9_sanitised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with typed placeholders in place of personal information."""
    return personal.sanitised(table(spark, sf_dir, "documents"), table(spark, sf_dir, "given_names"))


QUERIES: dict[str, Query] = {
    "p2_found": p2_found,
    "p2_pieces": p2_pieces,
    "p3_found": p3_found,
    "p3_cleaned": p3_cleaned,
    "p4_found": p4_found,
    "p4_repaired": p4_repaired,
    "p5_found": p5_found,
    "p5_sentences": p5_sentences,
    "p6_stats": p6_stats,
    "p6_found": p6_found,
    "p7_ids": p7_ids,
    "p7_decoded": p7_decoded,
    "p8_leaks": p8_leaks,
    "p8_found": p8_found,
    "p9_found": p9_found,
    "p9_sanitised": p9_sanitised,
}

ORACLES: dict[str, str] = {
    "p2_found": """
        WITH t AS (SELECT record_id, [x.text for x in lines if x.text is not null] AS kept, [x.text for x in lines] AS texts FROM page_records)
        SELECT record_id, CAST(line_pos - 1 AS INTEGER) AS line_pos
        FROM (SELECT record_id, unnest(texts) AS text, generate_subscripts(texts, 1) AS line_pos FROM t) WHERE length(text) > 2000
        UNION ALL SELECT record_id, -1 AS line_pos FROM t WHERE length(array_to_string(kept, chr(10))) > 2000
    """,
    "p7_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
