"""Text quality statistics of pages, and how far each page lies from the prose of its language.

All statistics come from one projection over the page's joined text (counts of multi-line patterns, inside the JVM, no explode and no shuffle).
Mean and covariance of prose are estimated robustly for each language over all pages: medians and median deviations first, then moments of the pages
near the medians. A page's squared Mahalanobis distance splits into one contribution per statistic; the group of statistics that contributes
most says what the page is, a check of that group's plain shares follows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import cut

# ------------------------------------------------------------------------------------------------- statistics
# Patterns of one line each; they run with multi-line anchors over the joined text.
_BULLET = r"(?m)^[^\p{L}\p{N}\n]{0,3}(?:[•*·◦‣▪–—-]|\(?\p{N}{1,3}[.)]|\(?\p{L}[.)])[ \t]+(?=\S)"
_LEADER = r"(?m)(?:\.{4,}|…{2,}|_{4,}) *[\p{N}OolIiSBxvXV]{1,5}$"
_INDEX = r"(?m)\p{L}(?:[,،、] ?[\p{N}OolISB]{1,4}){1,12}\.?$"
_SEE = r" — (?:see|siehe|voir|véase|см\.) "
_CELL = r"(?:[—–]|\p{N}[\p{N}.,]*(?: \p{N}/\p{N})?)"
_TABLE_ROW = rf"(?m)(?<![^\s|]){_CELL}(?:(?: *\| *| +\.{{2,5}} +| +){_CELL})+ *\|?$"
_RULE = r"(?m)^[-=_+| ]{5,}$"
_ENDS = r"(?m)[.!?…。！？؟।॥:;,،、；»”’\")\]]$"
_RUN = r"([\p{L}\p{N}._=~-])\1{5,}"
_MIXED = r"(?<=\p{L})\p{N}|(?<=\p{N})\p{L}"
_VOWELS = "[aeiouyàâáäãåæèéêëíìîïóòôöœúùûüAEIOUYÄÖÜÉÈ]"

#: Statistics in their order in `stats`, by the group whose contribution they add to.
GROUPS = {
    "shape": ("words_per_line", "word_length", "ends_share", "confidence"),
    "list": ("bullet_share", "leader_share", "index_share"),
    "table": ("row_share", "rule_share"),
    "junk": ("symbol_ratio", "digit_ratio", "run_ratio", "mixed_share", "rare_share", "oddness", "vowels"),
}
NAMES = tuple(n for names in GROUPS.values() for n in names)

#: At most so many common words are taken into the patterns; the table is a fixed list of a few dozen words per language.
MAX_COMMON = 5_000

_SCRIPTS = {"ru": r"\p{IsCyrillic}", "el": r"\p{IsGreek}", "ar": r"\p{IsArabic}", "hi": r"\p{IsDevanagari}", "th": r"\p{IsThai}", "ja": r"[\p{IsHiragana}\p{IsKatakana}]", "zh": r"\p{IsHan}"}


def _words_pattern(words: list[str]) -> str:
    import re

    return r"(?<![\p{L}\p{M}])(?:" + "|".join(re.escape(w) for w in sorted(words, key=lambda w: (-len(w), w))) + r")(?![\p{L}\p{M}])"


def page_statistics(pages: DataFrame, common_words: DataFrame) -> DataFrame:
    """(record_id, language, n_lines, n_words, n_chars, then NAMES, then marked_chars): statistics of each page with lines.

    language is read off the page: by script, among languages in Latin script by common words. Null lines, texts and confidences take no part; a page without any
    non-blank line gives no row; a page without confidences gets the neutral confidence 90. Repeated rows give repeated rows.
    """
    rows = common_words.where("word is not null and lang is not null").select("lang", F.lower("word").alias("word")).distinct().limit(MAX_COMMON + 1).collect()
    if len(rows) > MAX_COMMON:
        raise ValueError(f"more than {MAX_COMMON} common words")
    words: dict[str, list[str]] = {}
    for r in rows:
        words.setdefault(r.lang, []).append(r.word)

    joined = F.regexp_replace(F.array_join(F.transform("lines", lambda x: x["text"]), "\n"), r"[^\S\n]+|[\p{Z}&&[^ \n]]+", " ")
    text = F.trim(F.regexp_replace(joined, r" ?\n[ \n]*", "\n"), F.lit(" \n"))
    sure = F.filter(F.flatten(F.filter(F.transform("lines", lambda x: x["words"]["confidence"]), lambda c: c.isNotNull())), lambda c: c.isNotNull())
    page = pages.select("record_id", text.alias("x"), sure.alias("c")).where("x <> ''")
    x, n_lines = F.col("x"), F.col("n_lines")
    count = lambda pattern: F.regexp_count(x, F.lit(pattern))
    page = page.select(
        "record_id",
        "x",
        F.when(F.size("c") > 0, F.aggregate("c", F.lit(0.0), lambda a, b: a + b) / F.size("c")).otherwise(F.lit(90.0)).alias("confidence"),
        F.length("x").alias("n_chars"),
        (count("\n") + 1).alias("n_lines"),
        count(r"\p{L}|\p{M}").alias("letters"),
        count(r"\p{IsLatin}").alias("latin"),
        count(r"\p{N}").alias("digits"),
        count(r"[ \n]").alias("spaces"),
        count(r"\S+").alias("n_words"),
    )
    # scripts are counted only on pages that are not all Latin
    page = page.select("*", *[F.when(F.col("latin") < F.col("letters"), count(p)).otherwise(F.lit(0)).alias(f"s_{k}") for k, p in _SCRIPTS.items()])
    foreign = F.greatest(*[F.col(f"s_{k}") for k in _SCRIPTS])
    script = F.coalesce(
        F.when(F.col("s_ja") * 8 > F.col("letters"), F.lit("ja")),
        *[F.when((F.col(f"s_{k}") == foreign) & (F.col(f"s_{k}") * 3 > F.col("letters")), F.lit(k)) for k in _SCRIPTS],
    )
    page = page.withColumn("script", script)
    latin = [k for k in words if k not in _SCRIPTS]
    common = lambda k: F.regexp_count(F.lower("x"), F.lit(_words_pattern(words[k])))
    page = page.select("*", *[F.when(F.col("script").isNull() if k in latin else F.col("script") == k, common(k)).otherwise(F.lit(0)).alias(f"w_{k}") for k in words])
    most = F.greatest(F.lit(0), F.lit(0), *[F.col(f"w_{k}") for k in latin])
    page = page.withColumn("language", F.coalesce("script", *[F.when((F.col(f"w_{k}") == most) & (most > 0), F.lit(k)) for k in latin], F.lit("en")))
    body = F.greatest(n_lines - 2, F.lit(1))
    share = lambda c: F.least(c / body, F.lit(1.0))
    nonspace = F.greatest(F.col("n_chars") - F.col("spaces"), F.lit(1))
    # signs that are neither letters, digits, spaces nor the usual punctuation
    symbols = count(r"[^\p{L}\p{M}\p{N}\s.,;:!?'\"()’‘“”«»—–\-…、。「」『』！？：；，·•।॥؟،؛¿¡\[\]­¬‐*|]")
    # a row of dots that leads to a number is no run of noise
    bare = F.regexp_replace(x, _LEADER, "")
    punctuation = nonspace - F.col("letters") - F.col("digits")
    common = F.coalesce(*[F.when(F.col("language") == k, F.col(f"w_{k}")) for k in words], F.lit(None).cast("int"))
    own_script = F.coalesce(*[F.when(F.col("language") == k, F.col(f"s_{k}") + (F.col("s_zh") if k == "ja" else F.lit(0))) for k in _SCRIPTS], F.col("latin"))
    page = page.select(
        "record_id",
        "language",
        "n_lines",
        "n_words",
        "n_chars",
        "x",
        F.log1p(F.col("n_words") / n_lines).alias("words_per_line"),
        F.log1p(nonspace / F.col("n_words")).alias("word_length"),
        share(count(_ENDS)).alias("ends_share"),
        (F.col("confidence") / 100).alias("confidence"),
        share(count(_BULLET) + count(_SEE)).alias("bullet_share"),
        share(count(_LEADER)).alias("leader_share"),
        share(count(_INDEX)).alias("index_share"),
        share(count(_TABLE_ROW)).alias("row_share"),
        share(count(_RULE)).alias("rule_share"),
        (symbols / nonspace).alias("symbol_ratio"),
        (F.col("digits") / nonspace).alias("digit_ratio"),
        ((F.length(bare) - F.length(F.regexp_replace(bare, _RUN, ""))) / nonspace).alias("run_ratio"),
        F.least(count(_MIXED) / F.col("n_words"), F.lit(1.0)).alias("mixed_share"),
        F.when(common.isNull(), F.lit(0.0)).otherwise(1 - F.least(common / F.col("n_words"), F.lit(1.0))).alias("rare_share"),
        F.greatest((punctuation + F.col("letters") - own_script) / nonspace, F.lit(0.0)).alias("oddness"),
        # only where Latin letters make up half of the letters; else what is usual
        F.when(F.col("latin") * 2 > F.col("letters"), count(_VOWELS) / F.col("latin")).otherwise(F.lit(0.38)).alias("vowels"),
    )
    marked = lambda t: t.rlike("|".join(f"(?:{p})" for p in (_BULLET, _LEADER, _INDEX, _SEE, _TABLE_ROW, _RULE)))
    chars = F.aggregate(F.filter(F.split("x", "\n"), marked), F.lit(0), lambda a, t: a + F.length(t)) / F.col("n_chars")
    # looked at only where many lines are of a list or a table
    return page.withColumn("marked_chars", F.when(F.col("bullet_share") + F.col("leader_share") + F.col("index_share") + F.col("row_share") >= 0.4, chars).otherwise(F.lit(0.0))).drop("x")


# ------------------------------------------------------------------------------------------------ prose moments
#: Pages within so many scaled median deviations in every statistic count as prose when moments are taken.
NEAR = 4.0
#: No statistic is taken to vary less than this around its prose mean.
LEAST_SD = 0.03
#: A language with fewer pages near its medians uses the moments of all pages together.
LEAST_PAGES = 30


def prose_moments(stats: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """language (and '' for all) -> (mean, inverse covariance) of prose. One row per language and pass reaches the driver; the languages are a fixed list."""
    both = stats.select(F.explode(F.array("language", F.lit(""))).alias("language"), *NAMES)
    medians = both.groupBy("language").agg(*[F.percentile_approx(n, 0.5, 1000).alias(f"m_{n}") for n in NAMES])
    off = both.join(F.broadcast(medians), "language")
    spreads = off.groupBy("language").agg(*[F.percentile_approx(F.abs(F.col(n) - F.col(f"m_{n}")), 0.5, 1000).alias(f"d_{n}") for n in NAMES])
    near = off.join(F.broadcast(spreads), "language")
    for n in NAMES:
        near = near.where(F.abs(F.col(n) - F.col(f"m_{n}")) <= NEAR * F.greatest(1.4826 * F.col(f"d_{n}"), F.lit(LEAST_SD)))
    pairs = [(a, b) for i, a in enumerate(NAMES) for b in NAMES[: i + 1]]
    rows = near.groupBy("language").agg(F.count("*").alias("n"), *[F.avg(n).alias(f"a_{n}") for n in NAMES], *[F.avg(F.col(a) * F.col(b)).alias(f"p_{a}_{b}") for a, b in pairs]).collect()
    out = {}
    for r in rows:
        if r.n < LEAST_PAGES and r.language:
            continue
        mean = np.array([r[f"a_{n}"] for n in NAMES])
        cov = np.zeros((len(NAMES), len(NAMES)))
        for a, b in pairs:
            i, j = NAMES.index(a), NAMES.index(b)
            cov[i, j] = cov[j, i] = r[f"p_{a}_{b}"] - mean[i] * mean[j]
        out[r.language] = (mean, np.linalg.inv(cov + np.eye(len(NAMES)) * LEAST_SD**2))
    return out


def distances(stats: DataFrame, moments: dict[str, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """stats with distance (squared, Mahalanobis) and contributions (one per statistic in the order of NAMES; they add up to distance)."""
    fields = stats.schema.simpleString()[7:-1]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.column_stack([b.column(n).to_numpy(zero_copy_only=False) for n in NAMES]) if b.num_rows else np.zeros((0, len(NAMES)))
            z = np.zeros_like(x)
            w = np.zeros_like(x)
            languages = np.array(b.column("language").to_pylist(), dtype=object)
            for k in set(languages):
                mean, inverse = moments.get(k) or moments.get("", (np.zeros(len(NAMES)), np.eye(len(NAMES)) / LEAST_SD**2))
                at = languages == k
                z[at] = x[at] - mean
                w[at] = z[at] @ inverse
            parts = z * w
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(parts.sum(1)), pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(NAMES), pa.int32()), pa.array(parts.ravel()))],
                names=[*b.schema.names, "distance", "contributions"],
            )

    return stats.mapInArrow(measure, f"{fields}, distance double, contributions array<double>")


#: A page is no prose only beyond this squared distance, and junk only if the statistics of junk contribute this share of it: pages of unusual size are far off by their shape alone.
FAR = 40.0
JUNK_CONTRIBUTION = 0.3
#: The lines of a list or table hold at least this share of its characters; a few of them beside long lines make none.
MARKED_CHARS = 0.3


def _group(name: str) -> Column:
    return sum((F.get("contributions", F.lit(NAMES.index(n))) for n in GROUPS[name]), F.lit(0.0))


def classified(pages: DataFrame, common_words: DataFrame) -> DataFrame:
    """stats, distance, contributions and kind (prose, list, table or junk) of each page with lines."""
    stats = cut(page_statistics(pages, common_words))
    far = distances(stats, prose_moments(stats)).withColumns({f"g_{k}": _group(k) for k in GROUPS})
    c = F.col
    listed = F.greatest(c("bullet_share"), c("leader_share"), c("index_share"), c("bullet_share") + c("leader_share") + c("index_share"))
    lines = c("marked_chars") >= MARKED_CHARS
    evidence = {
        "table": lines & (c("row_share") >= 0.4) & (c("row_share") >= listed - 0.2),
        "list": lines & (listed >= 0.45),
        "junk": (c("g_junk") >= JUNK_CONTRIBUTION * c("distance"))
        & ((c("symbol_ratio") >= 0.2) | (c("run_ratio") >= 0.3) | (c("mixed_share") >= 0.25) | (c("oddness") >= 0.5) | (c("vowels") <= 0.2) | (c("vowels") >= 0.7)),
    }
    most = F.greatest(*[F.when(evidence[k], c(f"g_{k}")).otherwise(F.lit(0.0)) for k in evidence])
    kind = F.when(c("distance") <= FAR, "prose").when(most <= 0, "prose")
    for k in evidence:
        kind = kind.when(evidence[k] & (c(f"g_{k}") == most), k)
    return far.withColumn("kind", kind.otherwise("prose"))
