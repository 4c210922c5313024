"""Lines of recognised words to readable paragraphs, inside one row per page."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import let, letter_share, one_spaced

# Patterns and short tokens that noise consists of.
HYPHEN_TAIL = r"""-\s*[)\]}"'`.:;,_!]*\z"""
STRONG_END = r"""[.!?]["')\]]*\z"""
LIST_START = r"\A(?:[0-9]{3,4}\s|[-*•]\s)"
SMALL_START = r"\A[a-z]"
#: A line that becomes a list item once another goes on with it.
LIST_SIGN = r"\A(?:[0-9]{3,4}|[-*•])\z"
SPEW = ("fi", "fl", "hl", "hh", "th", "th!", "i|", "|i", "l|", "il")


def is_junk(token: Column, confidence: Column) -> Column:
    """Whether a token is noise; the first rule that holds decides, and all decide for noise."""
    size, alpha = F.length(token), letter_share(token)
    only_letters = token.rlike(r"\A\p{L}+\z")
    return (
        (token == "")
        | token.rlike(r"\A\|+\z")
        | (token.contains("|") & (confidence < 85))
        | (token.contains("\\") & (confidence < 85))
        | ((size == 1) & ~token.rlike(r"\A[\p{L}\p{N}]\z"))
        | ((size <= 2) & F.lower(token).isin(*SPEW) & (confidence < 85))
        | ((size <= 2) & only_letters & ~token.isin("I", "A", "a") & (confidence < 55))
        | ((alpha < 0.4) & (size < 5) & (confidence < 70))
    )


def tokens(line: Column) -> Column:
    """array<struct<t, c>>: a line's words with their confidence, 100 where it is missing; the pieces of its text if it has no words."""
    words = F.transform(line["words"], lambda w: F.struct(F.coalesce(w["text"], F.lit("")).alias("t"), F.coalesce(w["confidence"], F.lit(100.0)).alias("c")))
    pieces = F.transform(F.split(one_spaced(F.coalesce(line["text"], F.lit(""))), " "), lambda t: F.struct(t.alias("t"), F.lit(100.0).alias("c")))
    return F.when(F.size(line["words"]) > 0, words).otherwise(pieces)


def bare_tokens(line: Column) -> Column:
    """A line's tokens without bars and brackets around them."""
    return F.transform(tokens(line), lambda x: F.struct(F.btrim(one_spaced(x["t"]), F.lit("|\\()")).alias("t"), x["c"].alias("c")))


def clean_line(line: Column) -> Column:
    """A line's text without noise; empty if nothing readable is left."""
    kept = F.filter(bare_tokens(line), lambda x: ~is_junk(x["t"], x["c"]))
    text = one_spaced(F.array_join(F.transform(kept, lambda x: x["t"]), " "))
    return let(text, lambda t: F.when(t.rlike(r"\A\|+\z") | ((F.length(t) == 1) & ~t.rlike(r"\A[\p{L}\p{N}]\z")), "").otherwise(t))


def clean_lines(lines: Column) -> Column:
    return F.filter(F.transform(F.filter(lines, lambda x: x.isNotNull()), clean_line), lambda t: t != "")


#: Stands between paragraphs while they are built; cleaned lines have no such sign, for it counts as white space.
_BREAK = "\x1e"


def _next(texts: Column, i: Column) -> Column:
    return F.get(texts, i + 1)


def merge_hyphens(texts: Column) -> Column:
    """Pairs of lines joined where the first ends in a hyphen and the next begins small; what a pair has become is not joined again.

    Which line begins a pair depends on its neighbours alone; of a row of such lines every other one does, which a replacement from left to right finds.
    """
    pairs = lambda v: F.transform(v, lambda t, i: F.when(t.rlike(HYPHEN_TAIL) & _next(v, i).rlike(SMALL_START), "1").otherwise("0"))
    marks = lambda v: F.split(F.regexp_replace(F.array_join(pairs(v), ""), "1.", "JS"), "")
    joined = lambda t, after: one_spaced(F.concat(F.rtrim(F.regexp_replace(t, HYPHEN_TAIL, "")), after))

    def lines(v: Column) -> Column:
        return let(marks(v), lambda m: F.filter(F.transform(v, lambda t, i: F.when(F.get(m, i) == "J", joined(t, _next(v, i))).when(F.get(m, i) != "S", t)), lambda t: t.isNotNull()))

    return let(texts, lines)


def _in_paragraphs(texts: Column, between: str) -> Column:
    """Lines as one text, `between` paragraphs: a line goes on with the one before unless either looks like a list item, a sentence has ended, or it begins with no small letter."""

    def lead(v: Column, t: Column, i: Column) -> Column:
        # a paragraph begins with no small letter, so whether it looks like a list item is told by its first line, or by its first two
        last = F.get(v, i - 1)
        listed = last.rlike(LIST_START) | (last.rlike(SMALL_START) & F.coalesce(F.get(v, i - 2).rlike(LIST_SIGN), F.lit(False)))
        goes_on = t.rlike(SMALL_START) & ~t.rlike(LIST_START) & ~listed & ~last.rlike(STRONG_END)
        return F.concat(F.when(i == 0, "").when(goes_on, " ").otherwise(between), t)

    return let(texts, lambda v: F.array_join(F.transform(v, lambda t, i: lead(v, t, i)), ""))


def paragraphs(texts: Column) -> Column:
    """Lines, each with single spaces, gathered into paragraphs."""
    return let(texts, lambda v: F.when(F.size(v) > 0, F.split(_in_paragraphs(v, _BREAK), _BREAK)).otherwise(v))


def rendered(lines: Column) -> Column:
    """The readable text of an array of lines: paragraphs divided by blank lines."""
    return F.coalesce(_in_paragraphs(merge_hyphens(clean_lines(lines)), "\n\n"), F.lit(""))


def raw_text(lines: Column) -> Column:
    """The lines' own texts, blank ones left out, one per line."""
    return F.coalesce(F.array_join(F.filter(F.transform(lines, lambda x: x["text"]), lambda t: F.regexp_replace(t, r"[\s\x0b\x1c-\x1f\x85\p{Z}]+", "") != ""), "\n"), F.lit(""))
