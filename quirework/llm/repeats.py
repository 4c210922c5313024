"""Lines that recur within one book: titles, notices, stamps.

Lines are compared by a key that drops numbers, dates, case, spacing and punctuation and folds signs that recognition mixes up. The pages
of each key are held as a compressed bitmap in relational form: one row per non-empty 64-page word, (book, key, word number, bits). Rows of a key are
merged by a bitwise or before and after the shuffle, so no group is ever collected; a union of bitmaps is again such an or, and a cardinality the sum of the words' set bits.
Keys that differ from a frequent key of their book by a few letters have their bitmaps united with its own; a key counts as repeated when
the union reaches the thresholds; every line of its variants is then found by a lookup of its key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import cut

MIN_PAGES = 5
MIN_SHARE = 0.05

# Month names by language, matched in lower case.
_MONTHS = (
    "january|february|march|april|may|june|july|august|september|october|november|december",
    "januar|februar|märz|mai|juni|juli|oktober|dezember",
    "janvier|février|mars|avril|juin|juillet|août|septembre|octobre|novembre|décembre",
    "enero|febrero|marzo|abril|mayo|junio|julio|agosto|septiembre|octubre|noviembre|diciembre",
    "января|февраля|марта|апреля|мая|июня|июля|августа|сентября|октября|ноября|декабря",
    "январь|февраль|март|апрель|май|июнь|июль|август|сентябрь|октябрь|ноябрь|декабрь",
    "ιανουαρίου|φεβρουαρίου|μαρτίου|απριλίου|μαΐου|ιουνίου|ιουλίου|αυγούστου|σεπτεμβρίου|οκτωβρίου|νοεμβρίου|δεκεμβρίου",
)
_ALPHABETIC = r"\p{IsLatin}\p{IsGreek}\p{IsCyrillic}"

# Letters that look alike across scripts, and signs that stand for letters inside words.
_ALIKE = ("аеорсухкмтвнιορντυκαηγέάόίήύώё", "aeopcyxkmtbhiopvtukanyeaoinuwe")
_SIGNS = ("0123456789@$€£¢!|¡", "olzeasbtbgaseccili")


# Letter groups that recognition mixes up.
_GROUPS = (("ii", "u"), ("rn", "m"), ("in", "m"), ("vv", "w"), ("li", "h"), ("cl", "d"))
_LOOSE = ("ie", "lc")


def _folded(word: str) -> str:
    """What line_key makes of a word of letters."""
    word = word.translate(str.maketrans(*_ALIKE))
    for wrong, right in _GROUPS:
        word = word.replace(wrong, right)
    return word.translate(str.maketrans(*_LOOSE))


_MONTH = r"(?<!\p{L})(?:" + "|".join(dict.fromkeys(_folded(m) for names in _MONTHS for m in names.split("|"))) + r")(?!\p{L})"


def line_key(text: Column) -> Column:
    """What two lines of the same content have in common; empty if nothing is left, null for null. JVM functions only."""
    # numbers with their separators go, unless letters of an alphabet stand next to them; so do roman ones at either end
    x = F.regexp_replace(F.lower(text), rf"(?<![{_ALPHABETIC}\p{{N}}])\p{{N}}[\p{{N}}.,:/]*(?![{_ALPHABETIC}\p{{N}}])", " ")
    x = F.regexp_replace(x, r"^[^\p{L}]*[ivxlc]{1,7}(?=[^\p{L}])|(?<=[^\p{L}])[ivxlc]{1,7}[^\p{L}]*$", " ")
    # signs count as letters only between or before letters
    x = F.regexp_replace(x, rf"(?<=[{_ALPHABETIC}])([!|¡@$€£¢]+)(?=[{_ALPHABETIC}])|([@$€£¢])(?=[{_ALPHABETIC}])", "§$1$2")
    x = F.translate(F.regexp_replace(x, r"(?<!§)[!|¡]", " "), *_SIGNS)
    x = F.translate(x, _ALIKE[0] + "§", _ALIKE[1])
    for wrong, right in _GROUPS:
        x = F.replace(x, F.lit(wrong), F.lit(right))
    x = F.translate(x, *_LOOSE)
    return F.regexp_replace(F.regexp_replace(x, _MONTH, ""), r"[^\p{L}]+", "")


def bare_number(text: Column) -> Column:
    """Whether a line has nothing but a page number, also a roman or misrecognised one."""
    return text.rlike(r"^[^\p{L}\p{N}]*(?i:(?:p|pp|page|s|seite|pág|pag|с|стр|σ)[^\p{L}\p{N}]+)?(?:\p{N}{1,5}|[ivxlcIVXLC]{1,9}|[0-9oOlIiSsBbzZgGqQtTaA|!]{0,3}[0-9][0-9oOlIiSsBbzZgGqQtTaA|!]{0,3})[^\p{L}\p{N}]*$")


def keyed_lines(pages: DataFrame) -> DataFrame:
    """(record_id, book_id, page_num, line_pos, key) of every line with letters that is not just a page number; key may be empty. Null lines and texts give none.

    The key is costly: cut the lineage before filtering by it, or the filter computes it once more.
    """
    at = pages.select("record_id", "book_id", "page_num", F.posexplode("lines").alias("line_pos", "line")).select(
        "record_id", "book_id", "page_num", "line_pos", F.col("line.text").alias("text")
    )
    at = at.where(F.col("text").rlike(r"\p{L}") & ~bare_number(F.col("text")))
    return at.select("record_id", "book_id", "page_num", "line_pos", line_key(F.col("text")).alias("key"))


def page_bitmaps(lines: DataFrame) -> DataFrame:
    """(book_id, key, word, bits): the pages of each key of each book as the non-empty 64-page words of a bitmap."""
    word = F.floor(F.col("page_num") / 64).cast("int")
    bit = F.expr("shiftleft(1L, pmod(page_num, 64))")
    return lines.where("page_num is not null").groupBy("book_id", "key", word.alias("word")).agg(F.bit_or(bit).alias("bits"))


def cardinality(bitmaps: DataFrame, *by: str) -> DataFrame:
    return bitmaps.groupBy(*by).agg(F.sum(F.bit_count("bits")).alias("n_pages"))


#: Keys of fewer letters have no variants: a letter less or more makes other words of them. Longer ones may differ by one letter in EDIT_EVERY, at most by MAX_EDITS.
MIN_LETTERS = 6
EDIT_EVERY = 8
MAX_EDITS = 3
#: A spelling on so large a share of the pages that a content needs, and on two at least, is a core that others are compared with.
CORE_SHARE = 0.2


def _edits(letters: Column) -> Column:
    return F.least(F.lit(MAX_EDITS), F.floor(letters / EDIT_EVERY) + 1).cast("int")


def _gram(letters: Column) -> Column:
    """The length of the grams by which keys of so many letters meet: one disjoint gram more than there may be edits fits in. Longer keys meet by longer grams, which fewer share."""
    return F.when(letters >= 40, 8).when(letters >= 24, 6).when(letters >= 16, 4).otherwise(F.floor(letters / (_edits(letters) + 1))).cast("int")


def _grams_at(key: Column) -> Column:
    """Disjoint grams of a key, one more than it may have edits: at least one is left unspoilt."""
    n = F.length(key)
    g, last = _gram(n), _edits(n)
    return F.array_distinct(F.transform(F.sequence(F.lit(0), last), lambda i: F.substr(key, F.floor((n - g) * i / last).cast("int") + 1, g)))


def _all_grams(key: Column) -> Column:
    """All grams of a key of the lengths at which a key of up to MAX_EDITS letters more or less may ask."""
    n = F.length(key)
    sizes = F.array_distinct(F.array(*[_gram(F.greatest(n + d, F.lit(2))) for d in range(-MAX_EDITS, MAX_EDITS + 1)]))
    of = lambda g: F.transform(F.sequence(F.lit(1), n - g + 1), lambda i: F.substr(key, i, g))
    return F.array_distinct(F.flatten(F.transform(F.filter(sizes, lambda g: g <= n), of)))


def variants(counts: DataFrame) -> DataFrame:
    """(book_id, core, key): for each key of counts (book_id, key, n_pages, needed) that is a core the keys of its book within a few letters, itself included.

    Keys meet by a gram they share: the core offers all its grams, the other key disjoint ones. Both sides are spread by (book, gram); a large book needs many pages for a
    core, so that a frequent gram of it meets few cores.
    """
    cores = counts.where(F.col("n_pages") >= F.greatest(F.lit(2), CORE_SHARE * F.col("needed"))).select("book_id", F.col("key").alias("core"))
    selves = cores.select("book_id", "core", F.col("core").alias("key"))
    offered = cores.where(F.length("core") >= MIN_LETTERS).select("book_id", "core", F.explode(_all_grams(F.col("core"))).alias("gram"))
    asked = counts.where(F.length("key") >= MIN_LETTERS).select("book_id", "key", F.explode(_grams_at(F.col("key"))).alias("gram"))
    edits = _edits(F.least(F.length("core"), F.length("key")))
    met = asked.join(offered, ["book_id", "gram"]).where((F.col("core") != F.col("key")) & (F.abs(F.length("core") - F.length("key")) <= edits)).select("book_id", "core", "key").distinct()
    near = met.where(F.levenshtein("core", "key") <= edits)
    return selves.unionByName(near)


def repeated_keys(pages: DataFrame, lines: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(book_id, key): keys whose content, variants united, stands on at least min_pages different pages and on min_share of the book's."""
    bitmaps = page_bitmaps(lines)
    books = pages.where("page_num is not null").groupBy("book_id").agg(F.greatest(F.lit(float(min_pages)), F.lit(min_share) * F.count_distinct("page_num")).alias("needed"))
    pairs = variants(cardinality(bitmaps, "book_id", "key").join(books, "book_id"))
    united = bitmaps.join(pairs, ["book_id", "key"]).groupBy("book_id", "core", "word").agg(F.bit_or("bits").alias("bits"))
    passing = cardinality(united, "book_id", "core").join(books, "book_id").where(F.col("n_pages") >= F.col("needed"))
    return pairs.join(passing.select("book_id", "core"), ["book_id", "core"], "left_semi").select("book_id", "key").distinct()


def repeated_lines(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(record_id, line_pos) of every line, also of repeated scans, whose content recurs in its book.

    pages needs record_id, book_id, page_num, lines; other columns are ignored. Null lines, texts and book ids, lines without letters and bare page numbers are
    no cases; pages without page_num count for nothing but their lines can be found. Equal record_ids give equal rows.
    """
    lines = cut(keyed_lines(pages.where("book_id is not null"))).where("key <> ''")
    return lines.join(repeated_keys(pages, lines, min_pages, min_share), ["book_id", "key"], "left_semi").select("record_id", "line_pos")


def cleaned_pages(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(record_id, text): each page's line texts without the repeated lines, joined by newlines; record_id must be unique."""
    found = repeated_lines(pages, min_pages, min_share).groupBy("record_id").agg(F.collect_set("line_pos").alias("drop"))
    texts = F.filter(
        F.transform(F.coalesce("lines", F.array().cast(pages.schema["lines"].dataType)), lambda line, i: F.struct(i.alias("i"), line["text"].alias("t"))),
        lambda x: x["t"].isNotNull() & ~F.coalesce(F.array_contains("drop", x["i"]), F.lit(False)),
    )
    return pages.join(found, "record_id", "left").select("record_id", F.array_join(F.transform(texts, lambda x: x["t"]), "\n").alias("text"))
