"""Text metrics of a page and the gate for pages of no use."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import SPACE, fixed, is_blank, let, strip


@dataclass(frozen=True)
class Thresholds:
    min_avg_word_conf: float = 58.0
    max_garbage_ratio: float = 0.22
    max_pipe_ratio: float = 0.04
    min_alpha_ratio: float = 0.45

    @classmethod
    def of(cls, config: dict | None) -> Thresholds:
        """The thresholds of a pipeline config; what is missing or no number keeps its default."""
        given = config.get("qa") if isinstance(config, dict) else None
        values = {}
        for name in cls.__dataclass_fields__:
            try:
                values[name] = float(given[name])
            except (KeyError, TypeError, ValueError):
                continue
        return cls(**values)


def line_text(line: Column) -> Column:
    """A line's non-blank word texts joined by spaces; its own text if it has no words."""
    words = F.filter(F.transform(line["words"], lambda w: F.coalesce(w["text"], F.lit(""))), lambda t: ~is_blank(t))
    return F.when(F.size(line["words"]) > 0, strip(F.array_join(words, " "))).otherwise(strip(F.coalesce(line["text"], F.lit(""))))


def metrics(lines: Column) -> Column:
    """struct(char_count, line_count, avg_word_conf, alpha_ratio, garbage_ratio, pipe_ratio) of an array of lines. Null lines take no part."""
    solid = F.filter(F.transform(F.filter(lines, lambda x: x.isNotNull()), lambda x: F.struct(line_text(x).alias("t"), x["words"]["confidence"].alias("c"))), lambda x: x["t"] != "")

    def known(s: Column) -> Column:
        sure = F.filter(F.flatten(F.filter(F.transform(s, lambda x: x["c"]), lambda c: c.isNotNull())), lambda c: c >= 0)
        average = let(sure, lambda c: F.when(F.size(c) > 0, F.aggregate(c, F.lit(0.0), lambda a, x: a + x) / F.size(c)))
        return let(F.array_join(F.transform(s, lambda x: x["t"]), "\n"), lambda content: counted(s, content, average))

    def counted(s: Column, content: Column, average: Column) -> Column:
        count = lambda rx: F.regexp_count(content, F.lit(rx))
        counts = F.struct(count(r"\p{L}").alias("letters"), count(r"[\p{L}\p{N}]").alias("alnum"), (F.length(content) - count(SPACE)).alias("solid"), count(r"\|").alias("pipes"))
        ratio = lambda a, b: F.coalesce(F.when(b > 0, a / b), F.lit(0.0))
        return let(
            counts,
            lambda n: F.struct(
                F.length(content).cast("bigint").alias("char_count"),
                F.size(s).cast("bigint").alias("line_count"),
                average.alias("avg_word_conf"),
                ratio(n["letters"], n["alnum"]).alias("alpha_ratio"),
                ratio(n["solid"] - n["alnum"], n["solid"]).alias("garbage_ratio"),
                ratio(n["pipes"], n["solid"]).alias("pipe_ratio"),
            ),
        )

    return let(F.coalesce(solid, F.array().cast("array<struct<t:string,c:array<double>>>")), known)


def low_quality(m: Column, t: Thresholds = Thresholds()) -> Column:
    """Whether a page's text is of no use."""
    few_letters = m["alpha_ratio"] < t.min_alpha_ratio
    return (
        (m["line_count"] <= 0)
        | (m["char_count"] <= 0)
        | ((m["char_count"] < 12) & (m["alpha_ratio"] < 0.35))
        | ((m["pipe_ratio"] > t.max_pipe_ratio) & few_letters)
        | ((m["garbage_ratio"] > t.max_garbage_ratio) & few_letters)
        | (F.coalesce(m["avg_word_conf"] < t.min_avg_word_conf, F.lit(False)) & (m["garbage_ratio"] > t.max_garbage_ratio * 0.75))
    )


def placeholder(m: Column, scan: Column) -> Column:
    """What stands for the text of such a page."""
    return F.concat(
        F.lit("OCR LOW QUALITY (avg_conf="), F.coalesce(fixed(m["avg_word_conf"], 1), F.lit("n/a")), F.lit(", garbage="), fixed(m["garbage_ratio"], 3), F.lit("). See scan: "), F.coalesce(scan, F.lit(""))
    )
