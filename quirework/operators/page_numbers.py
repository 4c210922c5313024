"""Printed page numbers: candidates of a page, the best of them, and the switch from roman to arabic in a book. No explode and no shuffle until the switch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import last_token, roman_letters, roman_value


@dataclass(frozen=True)
class Detection:
    top_band_frac: float = 0.12
    min_conf: float = 40.0
    roman_min_len: int = 2
    roman_max: int = 80
    arabic_switch_min: int = 10
    max_top_lines: int = 5


def _candidate(text: Column, confidence: Column, bbox: Column, source: str, line_id: Column, width: Column, height: Column, side: Column) -> Column:
    x = ((bbox[0] + bbox[2]) / 2.0) / F.greatest(F.lit(1), width)
    y = ((bbox[1] + bbox[3]) / 2.0) / F.greatest(F.lit(1), height)
    preferred = F.when(side == "left", x < 0.35).when(side == "right", x > 0.65).otherwise(F.lit(True))
    edge = F.when(side == "left", 1 - x).when(side == "right", x).otherwise(F.greatest(x, 1 - x))
    # fields stand in their ranking order, so that the least struct is the best candidate
    return F.struct(
        F.when(preferred, 0).otherwise(1).alias("late"),
        (-edge).alias("minus_edge"),
        (-F.coalesce(confidence, F.lit(0.0))).alias("minus_conf"),
        y.alias("y"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.coalesce(line_id, F.lit("")).alias("line_id"),
        F.lit(source).alias("source"),
        bbox.alias("bbox"),
        x.alias("x"),
    )


def candidates(words: Column, lines: Column, width: Column, height: Column, side: Column, d: Detection = Detection()) -> Column:
    """array of candidates: words in the top band, and the last tokens of the topmost lines in the band. Words and lines without a box take no part."""
    limit = max(0.0, d.top_band_frac) * F.greatest(F.lit(1), height)
    middle = lambda x: ((x["bbox"][1] + x["bbox"][3]) / 2.0) / F.greatest(F.lit(1), height)
    inside = lambda x: (F.size(x["bbox"]) == 4) & (middle(x) * height <= limit)
    # the band decides before candidates are built: few words stand in it
    from_words = F.transform(F.filter(words, inside), lambda w: _candidate(w["text"], w["confidence"], w["bbox"], "word", F.lit(None).cast("string"), width, height, side))
    # the topmost lines are chosen before the band decides; only their places are sorted
    placed = F.filter(F.transform(lines, lambda x, i: F.when(F.size(x["bbox"]) == 4, F.struct(middle(x).alias("y"), x["bbox"][0].alias("x1"), F.coalesce(x["line_id"], F.lit("")).alias("line_id"), i.alias("i")))), lambda x: x.isNotNull())
    tops = F.transform(F.slice(F.array_sort(placed), 1, max(0, d.max_top_lines)), lambda x: F.get(lines, x["i"]))
    last = lambda x: F.try_element_at(x["words"], F.lit(-1))
    from_lines = F.transform(
        F.filter(tops, inside),
        lambda x: _candidate(
            F.when(F.size(x["words"]) > 0, last(x)["text"]).otherwise(last_token(x["text"])), F.when(F.size(x["words"]) > 0, last(x)["confidence"]).otherwise(F.lit(0.0)), x["bbox"], "line", x["line_id"], width, height, side
        ),
    )
    both = F.concat(F.coalesce(from_words, F.array().cast(_TYPE)), F.coalesce(F.filter(from_lines, lambda c: c["text"] != ""), F.array().cast(_TYPE)))
    return both


_TYPE = "array<struct<late:int,minus_edge:double,minus_conf:double,y:double,text:string,line_id:string,source:string,bbox:array<int>,x:double>>"


def arabic(found: Column, d: Detection = Detection()) -> Column:
    return F.filter(found, lambda c: (-c["minus_conf"] >= d.min_conf) & c["text"].rlike(r"\A[0-9]{1,4}\z"))


def roman(found: Column, d: Detection = Detection()) -> Column:
    return F.filter(found, lambda c: (-c["minus_conf"] >= d.min_conf) & (F.length(roman_letters(c["text"])) >= d.roman_min_len) & F.coalesce(roman_value(c["text"]) <= d.roman_max, F.lit(False)))


#: So many of the best candidates are reported.
REPORTED = 10


def _ranked(found: Column) -> Column:
    """The best candidates in order, without the fields that only rank them."""
    shown = lambda c: F.struct(c["text"].alias("text"), (-c["minus_conf"]).alias("conf"), c["bbox"].alias("bbox"), c["x"].alias("x_center_norm"), c["y"].alias("y_center_norm"), c["source"].alias("source"), F.when(c["source"] == "line", c["line_id"]).alias("line_id"))
    return F.coalesce(F.transform(F.slice(F.array_sort(found), 1, REPORTED), shown), F.array().cast(_SHOWN))


_SHOWN = "array<struct<text:string,conf:double,bbox:array<int>,x_center_norm:double,y_center_norm:double,source:string,line_id:string>>"


def detected(pages: DataFrame, side: Column, d: Detection = Detection(), debug: bool = False) -> DataFrame:
    """pages with found_page, found_text, found_kind: the best arabic candidate, else the best roman one, else nulls.

    With debug also found_debug: the selected candidate, its kind, and the REPORTED best ones; roman ones only where there is no arabic one.
    """
    # the side is a column of its own, or every candidate would work it out again
    out = pages.withColumn("__side", side).withColumn("__c", candidates(F.col("words"), F.col("lines"), F.col("page_width"), F.col("page_height"), F.col("__side"), d))
    out = out.withColumns({"__as": arabic(F.col("__c"), d), "__rs": roman(F.col("__c"), d)}).withColumns({"__a": F.array_min("__as"), "__r": F.array_min("__rs")})
    a, r = F.col("__a"), F.col("__r")
    kind = F.when(a.isNotNull(), "arabic").when(r.isNotNull(), "roman")
    more = {}
    if debug:
        none = F.array().cast(_SHOWN)
        arabics, romans = _ranked(F.col("__as")), F.when(a.isNotNull(), none).otherwise(_ranked(F.col("__rs")))
        selected = F.try_element_at(F.when(a.isNotNull(), arabics).otherwise(romans), F.lit(1))
        more = {"found_debug": F.struct(selected.alias("selected"), kind.alias("selected_kind"), arabics.alias("arabic_top_candidates"), romans.alias("roman_top_candidates"))}
    return out.withColumns(
        {
            "found_page": F.when(a.isNotNull(), F.expr("try_cast(__a.text as int)")).otherwise(roman_value(r["text"])),
            "found_text": F.coalesce(a["text"], r["text"]),
            "found_kind": kind,
        }
        | more
    ).drop("__side", "__c", "__as", "__rs", "__a", "__r")


def switched(pages: DataFrame, value: str = "found_page", text: str = "found_text", kind: str = "found_kind", switch_min: int = 10) -> DataFrame:
    """pages in which roman results after the first arabic value of at least switch_min are nulled; `mode` tells the state after the page.

    The running state of a book is one number, the page of the switch: it is an aggregate, so no book has to pass through one task in order.
    page_num must be unique in a book.
    """
    at = pages.where((F.col(kind) == "arabic") & (F.col(value) >= switch_min)).groupBy("book_id").agg(F.min("page_num").alias("__switch"))
    out = pages.join(at, "book_id", "left")
    gone = F.coalesce((F.col("page_num") > F.col("__switch")) & (F.col(kind) == "roman"), F.lit(False))
    mode = F.when(F.coalesce(F.col("page_num") >= F.col("__switch"), F.lit(False)), "arabic").otherwise("auto")
    return out.withColumns({c: F.when(~gone, F.col(c)) for c in (value, text, kind)} | {"mode": mode}).drop("__switch")
