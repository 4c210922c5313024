"""Text functions as columns. White space and letters follow Unicode, as in Python."""

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Python's str.isspace has it; Java's \\s alone lacks most of it.
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once, however often body looks at it: inside lambdas nothing else shares common parts."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{SPACE}+|{SPACE}+\z", "")


def one_spaced(text: Column) -> Column:
    """Each run of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def is_blank(text: Column) -> Column:
    return strip(text) == ""


def letter_share(text: Column) -> Column:
    """Letters over all characters; 0 for an empty text."""
    return F.when(F.length(text) > 0, F.regexp_count(text, F.lit(r"\p{L}")) / F.length(text)).otherwise(F.lit(0.0))


# The roman digits and the pairs that subtract.
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}
_SUBTRACT = {"iv": 2, "ix": 2, "xl": 20, "xc": 20, "cd": 200, "cm": 200}
_STRICT = r"\Am{0,4}(cm|cd|d?c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3})\z"


def roman_letters(text: Column) -> Column:
    """The roman digits of a text, wherever they stand; everything else is dropped, so that "six" gives "ix"."""
    return F.regexp_replace(F.lower(text), "[^ivxlcdm]", "")


def roman_value(text: Column) -> Column:
    """The value of the roman digits of a text; null unless they form a canonical numeral."""
    r = roman_letters(text)
    times = lambda s: (F.length(r) - F.length(F.replace(r, F.lit(s)))) / len(s)
    total = sum((times(k) * v for k, v in _ROMAN.items()), F.lit(0)) - sum((times(k) * v for k, v in _SUBTRACT.items()), F.lit(0))
    return F.when((r != "") & r.rlike(_STRICT), total.cast("int"))


def plausible_roman(text: Column, min_len: int, max_value: int) -> Column:
    return F.coalesce((F.length(roman_letters(text)) >= max(1, min_len)) & (roman_value(text) <= max_value), F.lit(False))


def last_token(text: Column) -> Column:
    """The last run of ASCII letters and digits; null if there is none."""
    return F.nullif(F.regexp_extract(strip(text), r"([A-Za-z0-9]+)[^A-Za-z0-9]*\z", 1), F.lit(""))


def file_name(text: Column) -> Column:
    """A text as a safe file name; `note` if nothing is left."""
    return F.coalesce(F.nullif(F.btrim(F.regexp_replace(text, "[^A-Za-z0-9._-]+", "_"), F.lit("._")), F.lit("")), F.lit("note"))


def yaml_string(text: Column) -> Column:
    """A double-quoted YAML (JSON) string; null as the empty string."""
    return F.regexp_extract(F.to_json(F.array(F.coalesce(text, F.lit("")))), r"(?s)\A\[(.*)\]\z", 1)


def scan_side(path: Column) -> Column:
    """left, right or neutral, by the end of the file's stem."""
    stem = F.lower(F.regexp_replace(F.regexp_extract(path, r"([^/]*)\z", 1), r"(?<=.)\.[^.]*\z", ""))
    return F.when(stem.endswith("_l"), "left").when(stem.endswith("_r"), "right").otherwise("neutral")


def natural_key(name: Column) -> Column:
    """A sort key that orders p_2 before p_10 whatever the case: runs of digits by value, padded, other runs as they are."""
    runs = F.regexp_extract_all(F.lower(name), F.lit(r"\d+|\D+"), F.lit(0))
    digits = lambda t: F.regexp_replace(t, r"\A0+(?=\d)", "")
    # kind 0 sorts digits before text, as a number's length does before its digits
    return F.transform(
        runs,
        lambda t: F.when(t.rlike(r"\A\d"), F.struct(F.lit(0).alias("kind"), F.length(digits(t)).alias("size"), digits(t).alias("text"))).otherwise(
            F.struct(F.lit(1).alias("kind"), F.lit(0).alias("size"), t.alias("text"))
        ),
    )


@F.pandas_udf(T.StringType())
def _fixed1(numbers: pd.Series) -> pd.Series:
    return numbers.map(lambda x: None if pd.isna(x) else f"{x:.1f}")


@F.pandas_udf(T.StringType())
def _fixed3(numbers: pd.Series) -> pd.Series:
    return numbers.map(lambda x: None if pd.isna(x) else f"{x:.3f}")


def fixed(number: Column, places: int) -> Column:
    """A number with 1 or 3 decimals, rounded from its exact binary value (the JVM's formatting rounds its shortest decimal text instead)."""
    return {1: _fixed1, 3: _fixed3}[places](number)
