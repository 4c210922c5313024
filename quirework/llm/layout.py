"""What each line of a page is: running header, bare page number, notice, heading, list, table, junk or running text."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.lineage import cut
from .repeats import cardinality, keyed_lines, page_bitmaps

BLANK, HEADER, NUMBER, NOTICE, HEADING, LIST, TABLE, JUNK, TEXT = "blank", "header", "number", "notice", "heading", "list", "table", "junk", "text"

#: A line counts as furniture if its key stands on so many pages of its book and on this share of them; long keys need fewer pages.
SHORT_LETTERS, SHORT_PAGES = 8, 3
LONG_LETTERS, LONG_PAGES = 20, 2
LEAST_SHARE = 0.02
#: A recurring line is a title if it stands on top of a page in this share of its places.
TOP_SHARE = 0.4

_NUMBER = re.compile(r"^[^\w]*(?:(?:p|pp|page|s|seite|pág|pag|с|стр)[^\w]+)?(?:\d{1,5}|[ivxlc]{1,9}|[\doOlIiSsBbzZgGqQtTaA|!]{0,3}\d[\doOlIiSsBbzZgGqQtTaA|!]{0,3}|[\doOlI|!]{1,3})[^\w]*$", re.I)
_NUMBER_ENDS = re.compile(r"^[^\w]*(?:\d{1,5}|[ivxlc]{1,7}|[\doOlISsBb|!]{1,4})(?=\s)|(?<=\s)(?:\d{1,5}|[ivxlc]{1,7}|[\doOlISsBb|!]{1,4})[^\w]*$", re.I)
_BULLET = re.compile(r"^\W{0,3}(?:[•*·◦‣▪–—-]|\(?\d{1,3}[.)]|\(?[^\W\d_][.)])\s+(?=\S)")
_LEADER = re.compile(r"(?:\.{4,}|…{2,}|_{4,})\s*[\dOolIiSBxvXV]{1,5}$")
_INDEX = re.compile(r"[^\W\d_](?:[,،、] ?[\dOolISB]{1,4}){1,12}\.?$")
_SEE = re.compile(r" — (?:see|siehe|voir|véase|см\.) ")
_CELL = r"(?:[—–]|\d[\d.,]*(?: \d/\d)?)"
_ROW = re.compile(rf"(?<![^\s|]){_CELL}(?:(?: *\| *| +\.{{2,5}} +| +){_CELL})+ *\|?$")
_RULE = re.compile(r"^[-=_+| ]{5,}$")
_HEADING = re.compile(r"^\W*(?:chapter|kapitel|abschnitt|chapitre|capítulo|capitulo|глава|κεφάλαιο|अध्याय|الفصل|บทที่)\b.{0,20}$|^\W*第.{1,6}[章冊册回]\W*.{0,6}$", re.I)
_RUN = re.compile(r"([^\W\d]|[._=~-]|1)\1{4,}")
_MIXED = re.compile(r"(?<=[A-Za-z])\d|(?<=\d)[A-Za-z]")
_SYMBOL = re.compile(r"[^\w\s.,;:!?'\"()’‘“”„«»—–\-…、。「」『』！？：；，·•।॥؟،؛¿¡\[\]­¬‐‑*|/&ऀ-ॿ฀-๿؀-ۿ]")
_VOWEL = re.compile("[aeiouyàâäãåæèéêëíìîïóòôöœúùûü]", re.I)
_LATIN = re.compile("[A-Za-zÀ-ɏ]")
_MOJIBAKE = re.compile("Ã.|â€|Ð.|ï¿|Â.|æ–")
_TITLE_END = re.compile(r"[.!?…,;:。！？،؛।-]['\"”’»)\]]*\s*$")


def junk_line(t: str) -> bool:
    """Whether a line is noise rather than language; recognised words with a few errors are not."""
    body = t.replace(" ", "")
    n = len(body)
    if n < 4:
        return False
    if len(_SYMBOL.findall(t)) > 0.25 * n or 3 * len(_MOJIBAKE.findall(t)) > 0.4 * n:
        return True
    if sum(len(m[0]) for m in _RUN.finditer(t)) > 0.4 * n:
        return True
    latin = len(_LATIN.findall(t))
    words = t.split()
    if len(_MIXED.findall(t)) > 0.6 * len(words) + 1:
        return True
    if latin >= 10 and latin > 0.5 * n and not 0.2 < len(_VOWEL.findall(t)) / latin < 0.75:
        return True
    return latin > 0.5 * n and max(map(len, words)) > 60


def line_kind(t: str) -> str:
    """The kind of a line taken by itself: blank, number, list, table, junk or text."""
    if not t or t.isspace():
        return BLANK
    if _NUMBER.match(t):
        return NUMBER
    if _RULE.match(t) or _ROW.search(t):
        return TABLE
    if _LEADER.search(t) or _SEE.search(t) or _BULLET.match(t):
        return LIST
    if _INDEX.search(t) and len(t) < 60:
        return LIST
    return JUNK if junk_line(t) else TEXT


def title_like(t: str, width: float, usual: float) -> bool:
    """Whether a line may be a title: short, without a sentence's end, beginning with a capital where the script has any."""
    core = _NUMBER_ENDS.sub("", t).strip(" *[]—–-=•·")
    if not core or len(core) > 48 or re.search(r"\d[^\W\d_]*\s|\d\d|\s\d", core) or _TITLE_END.search(core) or re.search(r"[.!?;。！？；，、]\s?\S|,\s", core):
        return False
    first = next((c for c in core if c.isalpha()), "")
    if not first or first.islower():
        return False
    return width <= 0.75 * usual


def page_roles(texts: Sequence[str | None], widths: Sequence[float | None], repeated: set[int], titles: set[int] = frozenset()) -> list[str]:
    """The role of each line of a page. repeated: positions of lines that recur in the book; titles: those of them that mostly stand on top of a page."""
    flags = repeated - titles
    kinds = [line_kind(t or "") for t in texts]
    solid = [i for i, k in enumerate(kinds) if k != BLANK]
    sizes = sorted(widths[i] or 0 for i in solid if kinds[i] == TEXT)
    usual = sizes[len(sizes) * 3 // 4] if sizes else 0
    usual = min(usual, 3 * sizes[len(sizes) // 2]) if sizes else 0
    roles = list(kinds)
    edge = list(dict.fromkeys([*solid[:2], *solid[-1:], *(solid[-2:-1] if solid and kinds[solid[-1]] == NUMBER else [])]))
    for i in edge:
        t, width = texts[i] or "", widths[i] or 0
        if i in titles and kinds[i] != NUMBER and title_like(t, 0, 1):
            roles[i] = HEADER
    for i in edge:
        t, width = texts[i] or "", widths[i] or 0
        if HEADER in roles or i in flags or roles[i] not in (TEXT, LIST, JUNK, TABLE) or _HEADING.match(t):
            continue
        top = i == solid[0]
        if not title_like(t, width, max(usual, 1.4 * width) if top else usual):
            continue
        cased = any(c.isupper() or c.islower() for c in t)
        number = _NUMBER_ENDS.search(t)
        capital = cased and t.upper() == t and sum(c.isalpha() for c in t) > 3
        titled = cased and all(w[0].isupper() or len(w) < 4 or not w[0].isalpha() for w in t.split())
        short = not cased and number is not None and sum(c.isalpha() for c in t) <= 12
        if short or (top and (capital or titled)) or (number and (capital or titled) and i in (*solid[:2], *solid[-2:])):
            roles[i] = HEADER
    for i in solid:
        if roles[i] in (TEXT, LIST, JUNK, TABLE) and i in flags:
            roles[i] = NOTICE
        elif roles[i] == TEXT and _HEADING.match(texts[i] or ""):
            roles[i] = HEADING
    body = [i for i in solid if roles[i] in (LIST, TABLE, JUNK, TEXT)]
    odd = [roles[i] for i in body if roles[i] != TEXT]
    if body and 2 * len(odd) > len(body):
        most = max(set(odd), key=odd.count)
        for i in body:
            if roles[i] == TEXT:
                roles[i] = most
    elif body:
        # a single line that only looks like a list stays text in a page of prose
        for i in body:
            if roles[i] == LIST and odd.count(LIST) < 3 and not _LEADER.search(texts[i] or ""):
                roles[i] = TEXT
            elif roles[i] == TABLE and odd.count(TABLE) < 3 and not _RULE.match(texts[i] or ""):
                roles[i] = TEXT
    return roles


def furniture(pages: DataFrame) -> DataFrame:
    """(record_id, repeated, titles): positions of the lines of each page whose content recurs in its book, and of those that mostly stand on top; pages without any give no row.

    Keys are counted with page bitmaps as in `repeats`, with lower thresholds and without variants.
    """
    lines = cut(keyed_lines(pages.where("book_id is not null"))).where("key <> ''")
    tops = lines.groupBy("book_id", "key").agg(F.avg(F.when(F.col("line_pos") == 0, 1.0).otherwise(0.0)).alias("top"))
    counts = cardinality(page_bitmaps(lines), "book_id", "key").where(F.col("n_pages") >= LONG_PAGES).join(tops, ["book_id", "key"])
    on_top = F.col("top") >= TOP_SHARE
    letters = F.length("key")
    counts = counts.where(on_top | ((letters >= LONG_LETTERS) & (F.col("n_pages") >= LONG_PAGES)) | ((letters >= SHORT_LETTERS) & (F.col("n_pages") >= SHORT_PAGES)))
    sizes = pages.where("page_num is not null").groupBy("book_id").agg(F.count_distinct("page_num").alias("book_pages"))
    keys = counts.join(sizes, "book_id").where(on_top | (F.col("n_pages") >= LEAST_SHARE * F.col("book_pages"))).select("book_id", "key", on_top.alias("on_top"))
    found = lines.join(keys, ["book_id", "key"])
    return found.groupBy("record_id").agg(F.collect_set("line_pos").alias("repeated"), F.collect_set(F.when(F.col("on_top"), F.col("line_pos"))).alias("titles"))


def page_lines(pages: DataFrame, *more: str) -> DataFrame:
    """(record_id, book_id, page_num, more, texts, widths, repeated, titles): what page_roles needs, one row per page that has lines."""
    texts = F.transform("lines", lambda x: x["text"])
    widths = F.transform("lines", lambda x: (F.get(x["bbox"], F.lit(2)) - F.get(x["bbox"], F.lit(0))).cast("int"))
    rows = pages.where(F.size("lines") > 0).select("record_id", "book_id", "page_num", *more, texts.alias("texts"), widths.alias("widths"))
    return rows.join(furniture(pages), "record_id", "left")


def with_roles(lines: DataFrame) -> DataFrame:
    """lines, as `page_lines` gives them, with `roles` (one per line) in place of repeated and titles: worked out once, however often the pages are read."""
    kept = [n for n in lines.columns if n not in ("repeated", "titles")]
    names = lines.columns

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, widths, repeated, titles = (b.column(names.index(n)).to_pylist() for n in ("texts", "widths", "repeated", "titles"))
            roles = [page_roles(t, [x if x else len(y or "") for x, y in zip(w, t, strict=True)], set(r or ()), set(h or ())) for t, w, r, h in zip(texts, widths, repeated, titles, strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(names.index(n)) for n in kept), pa.array(roles, pa.list_(pa.string()))], names=[*kept, "roles"])

    return lines.mapInArrow(add, T.StructType([*(lines.schema[n] for n in kept), T.StructField("roles", T.ArrayType(T.StringType()))]))
