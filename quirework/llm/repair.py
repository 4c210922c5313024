"""Repair of text from scanned pages: broken words joined, misrecognised words corrected, running headers and page numbers taken out.

The frequent words of the whole corpus are the lexicon. A symmetric-delete index joins every other word with the words of the lexicon that it may stand for:
both sides offer their folded forms (look-alike signs made equal), these with any one letter left out, and the word with each single confusion put in, and meet
where they share one. A weighted edit distance, in which look-alike signs cost little, and the ratio of the counts decide whether a word is a misreading; for words with several near corrections the
word before decides, by the counts of the pairs. A word's confidence against the rest of its line shifts the limit.
"""

from __future__ import annotations

import re
from collections import ChainMap, Counter
from collections.abc import Callable, Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.lineage import cut
from . import lookup
from .layout import HEADER, HEADING, NOTICE, NUMBER, TEXT, page_lines, with_roles

#: A word is in the lexicon from this count on; a misreading's correction must be RATIO times as frequent as itself.
LEXICON_COUNT = 5
RATIO = 15
#: At most so many good words, compounds and first parts of compounds are sent to all tasks, most frequent first; pages get the rest that they ask for by a join.
SENT_WORDS = 100_000
FLUSH = 300_000
#: Points of confidence below the middle of its line that make a word suspect.
SUSPECT = 18.0

_HYPHENS = "-‐¬\xad"
_BROKEN = re.compile(rf"[^\W\d_][{_HYPHENS}]$")
_EDGES = re.compile(r"^[^\w]+|[^\w]+$")

# Signs that recognition takes for one another, letter groups likewise, and the folding of look-alikes.
_ALIKE = {frozenset(p) for p in "il i1 l1 i! l! l| i| 1| ij lj lt ft fl ec oc oe eo ao o0 a@ s5 sſ sf fſ g9 gq q9 z2 bh hk b6 b8 vy uv nu ra nr nh mn k< xк rг пн нn нм хж шщ ии ий ао c( ¢c e€ ss$ s$ t+ tг ьъ".split() if len(set(p)) == 2}
_GROUPS = {("rn", "m"), ("ri", "n"), ("ii", "u"), ("li", "h"), ("cl", "d"), ("vv", "w"), ("in", "m"), ("ni", "m"), ("nn", "m"), ("ll", "u"), ("tl", "d"), ("lc", "k"), ("lt", "h"), ("nl", "m"), ("fi", "h"), ("ci", "a"), ("iii", "m")}
_FOLD = str.maketrans("аеорсухкмтвнιορντυκαηωγіїїёo0@$€5ſ9681!|jtfvyecq2", "aeopcyxkmtbhiopvtukanwyiiieooas" + "essgbbllllffvvccgz")
_FOLD_GROUPS = (("ii", "u"), ("rn", "m"), ("ri", "n"), ("in", "m"), ("nn", "m"), ("vv", "w"), ("li", "h"), ("cl", "d"))

_SIGNS = re.compile(r"[^\w@!|$€]")
_LATIN = re.compile(r"[A-Za-zÀ-ɏ]")
_OTHER_ALPHABET = re.compile(r"[Ͱ-ϿЀ-ӿἀ-῿]")
_INNER_SIGN = re.compile(r"(?<=[^\W\d_])[~^*|@#$€£¢<>{}=+§_(!\\](?=[^\W\d_])|(?<=[a-zà-ÿа-яα-ω])[,;:](?=[a-zà-ÿа-яα-ωά-ώ])|^[~^@|\\](?=[^\W\d_]{2})|(?<=[^\W\d_]{2})[~^@|\\]$")
_DIGIT_INSIDE = re.compile(r"[^\W\d_]\d|\d[^\W\d_]")
_ORDINAL = re.compile(r"^\d+(?:st|nd|rd|th|er|ère|re|e|º|ª|o|a|d|s|p|km|cm|m|x|a)$", re.I)
_INNER_CASE = re.compile(r"[a-zß-öø-ÿа-яα-ω][A-ZÀ-ÖØ-ÞА-ЯΑ-Ω]")
_NUMBER_LIKE = re.compile(r"^[\dlIOoSsBZz|!i]+(?:[.,][\dlIOoSsBZz|!i]+)*$")
_SIGN_FIRST = re.compile(r"[\"'“‘«„]?([(!|@$<])[^\W\d_]+[^\w)]*$")
_LETTER_OF = {"(": "c", "!": "i", "|": "l", "@": "a", "$": "s", "<": "k"}
_ROMAN = re.compile(r"^m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})$")


@lru_cache(1 << 17)
def core(piece: str) -> str:
    """A word without the punctuation around it, in small letters."""
    return _EDGES.sub("", piece).casefold()


def plain_fold(word: str) -> str:
    """A word with single look-alike signs made equal and signs inside it dropped; letter groups stay as they are."""
    return _SIGNS.sub("", word.casefold()).translate(_FOLD).replace("i", "l")


def fold(word: str) -> str:
    """A word with look-alike signs and letter groups made equal and signs inside it dropped."""
    w = _SIGNS.sub("", word.casefold())
    for a, b in _FOLD_GROUPS:
        w = w.replace(a, b)
    return w.translate(_FOLD).replace("i", "l")


#: What each sign or letter group may be taken for; pairs that plain_fold makes equal are left to it.
_SWAPS: dict[str, list[str]] = {}
for _a, _b in [*(sorted(p) for p in _ALIKE), *_GROUPS]:
    if plain_fold(_a) != plain_fold(_b):
        _SWAPS.setdefault(_a, []).append(_b)
        _SWAPS.setdefault(_b, []).append(_a)
_SWAP_SIZES = sorted({len(a) for a in _SWAPS})


def confused(word: str) -> Iterator[str]:
    """The word with each single confusion of _ALIKE and _GROUPS, in either direction, at each of its places."""
    for i in range(len(word)):
        for size in _SWAP_SIZES:
            for b in _SWAPS.get(word[i : i + size], ()) if i + size <= len(word) else ():
                yield word[:i] + b + word[i + size :]


def meeting_keys(word: str, lexicon: bool) -> set[str]:
    """What a word offers to the index, as a word of the lexicon or as one that may be misread.

    Two words meet if they differ by any look-alikes that plain_fold makes equal and, besides, by at most two other confusions, or by one and another letter
    (in words of the lexicon of five letters or more).
    """
    out = deletes(fold(word)) | deletes(plain_fold(word))
    for v in confused(word):
        p = plain_fold(v)
        if lexicon and len(word) > 4:
            out |= deletes(p)
        else:
            out.add(p)
    return out


def deletes(folded: str) -> set[str]:
    """The form itself and, from four letters on, with any one letter left out."""
    out = {folded}
    if len(folded) > 3:
        out |= {folded[:i] + folded[i + 1 :] for i in range(len(folded))}
    return out


#: Pairs of _GROUPS, in either direction, by their two first letters.
_GROUPS_AT: dict[str, list[tuple[str, str]]] = {}
for _a, _b in _GROUPS:
    for _p, _q in ((_a, _b), (_b, _a)):
        _GROUPS_AT.setdefault(_p[0] + _q[0], []).append((_p, _q))


@lru_cache(1 << 16)
def _alike(a: str, b: str) -> bool:
    return frozenset((a, b)) in _ALIKE or a.translate(_FOLD) == b.translate(_FOLD)


def distance(wrong: str, right: str, limit: float = 3.0) -> float:
    """Weighted edit distance: look-alikes 0.3, letter groups 0.4, a sign put into a word 0.2, another letter instead 1, a letter more or less 1.3."""
    n, m = len(wrong), len(right)
    if abs(n - m) > 3:
        return 9.0
    row = [[9.0] * (m + 1) for _ in range(n + 1)]
    row[0][0] = 0.0
    for i in range(n + 1):
        for j in range(m + 1):
            v = row[i][j]
            if v > limit:
                continue
            if i < n and j < m:
                a, b = wrong[i], right[j]
                c = 0.0 if a == b else 0.3 if _alike(a, b) else 1.0
                row[i + 1][j + 1] = min(row[i + 1][j + 1], v + c)
            if i < n:
                row[i + 1][j] = min(row[i + 1][j], v + (0.2 if not wrong[i].isalnum() else 1.3))
            if j < m:
                row[i][j + 1] = min(row[i][j + 1], v + 1.3)
            for p, q in _GROUPS_AT.get(wrong[i : i + 1] + right[j : j + 1], ()):
                if wrong.startswith(p, i) and right.startswith(q, j):
                    row[i + len(p)][j + len(q)] = min(row[i + len(p)][j + len(q)], v + 0.4)
    return row[n][m]


def allowed(length: int, suspect: bool) -> float:
    """How far a word of so many letters may be from its correction."""
    base = 0.35 if length <= 3 else 0.7 if length == 4 else 1.0 if length <= 8 else 1.4
    return base + (0.4 if suspect and length > 2 else 0.0)


def wrong_form(piece: str) -> bool:
    """Whether a word is misread by its form alone: signs, digits, capitals or foreign look-alikes inside a word, letters inside a number."""
    w = _EDGES.sub("", piece)
    if _INNER_SIGN.search(piece.strip(".,;:!?\"'“”‘’«»()[]")):
        return True
    if _NUMBER_LIKE.match(w):
        return any(c.isdigit() for c in w) and any(not c.isdigit() and c not in ".," for c in w)
    if _DIGIT_INSIDE.search(w) and not _ORDINAL.match(w) and sum(c.isalpha() for c in w) >= 2 and not any("⺀" <= c or "؀" <= c <= "๿" for c in w):
        return True
    if _LATIN.search(w) and _OTHER_ALPHABET.search(w):
        return True
    return bool(_INNER_CASE.search(w)) and not w[1:].isupper() and not re.match(r"(?:Mc|Mac|O['’]|D['’]|L['’])[A-Z]", w) and not any(p[:1].isupper() and p[1:].islower() for p in re.split(r"[-’']", w)[1:])


# ----------------------------------------------------------------------------------------------- pages to words
class Page:
    """Lines of a page with roles, and their words. broken: line -> (next text line) where a word goes on."""

    def __init__(self, texts: list[str | None], roles: list[str]) -> None:
        self.texts = texts
        self.roles = roles
        self.pieces = {i: (texts[i] or "").split(" ") for i, r in enumerate(self.roles) if r in (TEXT, HEADER, NOTICE, HEADING, NUMBER)}
        running = [i for i, r in enumerate(self.roles) if r == TEXT]
        self.running = running
        self.broken: dict[int, int | None] = {}
        for a, b in zip(running, [*running[1:], None], strict=False):
            last = self.pieces[a][-1]
            if _BROKEN.search(last):
                first = self.pieces[b][0] if b is not None else ""
                self.broken[a] = b if b is not None and first[:1].isalpha() else None if b is None else -1
        body = [i for i, r in enumerate(self.roles) if r in (TEXT, HEADING, "list", "table", "junk")]
        self.first_body, self.last_body = (body[0], body[-1]) if body else (len(self.roles), -1)

    def outside(self, line: int) -> bool:
        """Whether a line stands above or below everything that is no header, notice or number."""
        return line < self.first_body or line > self.last_body

    def whole_words(self) -> Iterator[tuple[str, int, int, tuple[int, int] | None, str]]:
        """(word as written, line, word_pos, place of its second part, word before) of each word; a broken word once, at its first part."""
        taken = set()
        before = ""
        for i in sorted(self.pieces):
            if self.roles[i] == NUMBER:
                continue
            for k, p in enumerate(self.pieces[i]):
                if (i, k) in taken or not p:
                    continue
                if i in self.broken and k == len(self.pieces[i]) - 1:
                    b = self.broken[i]
                    if b is not None and b >= 0:
                        taken.add((b, 0))
                        yield p[:-1] + "\0" + self.pieces[b][0], i, k, (b, 0), before
                        before = ""
                    continue
                if self.running and i == self.running[0] and k == 0 and p[:1].islower():
                    # may be the rest of a word that began on the page before
                    yield p, i, k, (-1, 0), ""
                    continue
                yield p, i, k, None, before
                before = core(p)


    def asked(self) -> list[tuple[str, str]]:
        """The words that decide about broken words and about signs that stand for first letters, as (known, joined or first; word)."""
        out = []
        for i, nxt in self.broken.items():
            a = core(self.pieces[i][-1][:-1])
            out.append(("first", a + "-"))
            if nxt is not None and nxt >= 0:
                b = core(self.pieces[nxt][0])
                out += [("known", a + b), ("known", a), ("known", b), ("joined", f"{a}-{b}")]
        for w, *_, second, _ in self.whole_words():
            if "\0" in w:
                a, rest = w.split("\0")
                out += [("known", core(a + rest)), ("joined", f"{core(a)}-{core(rest)}")]
            elif sign := _SIGN_FIRST.match(w):
                out += [("known", _LETTER_OF[sign[1]] + core(w)), ("known", core(w))]
        return out


def _pages(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple[int, Page]]:
    columns = (batch.column(names.index(n)).to_pylist() for n in ("texts", "roles"))
    for row, page in enumerate(zip(*columns, strict=True)):
        yield row, Page(*page)


def word_counts(lines: DataFrame) -> DataFrame:
    """(word, n) over all running text, headers and notices; broken words count whole, and as compounds with a hyphen in a row of their own kind."""
    names = lines.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})
            seen.clear()
            return b

        for b in batches:
            for _, page in _pages(b, names):
                for w, _, _, second, _ in page.whole_words():
                    if second != (-1, 0):
                        seen[core(w.replace("\0", ""))] += 1
                if len(seen) > FLUSH:
                    yield out()
        yield out()

    return lines.mapInArrow(count, "word string, n bigint").where("word <> ''").groupBy("word").agg(F.sum("n").alias("n"))


def corrections(counts: DataFrame) -> DataFrame:
    """(word, right, cost, word_n, n): words that may be misread, with the frequent words they may stand for. Spread by the keys that both sides share."""
    kind = "key string, word string, n bigint"

    def index(lexicon: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        # a misread word has three letters at least; its correction may have one less
        least = 2 if lexicon else 3

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, 1000):
                    k, w, n = [], [], []
                    for word, count in zip(*(c.to_pylist() for c in whole.slice(at, 1000).columns), strict=True):
                        if any(c.isalpha() for c in word) and least <= len(word) < 60:
                            keys = meeting_keys(word, lexicon)
                            k += keys
                            w += [word] * len(keys)
                            n += [count] * len(keys)
                    yield pa.RecordBatch.from_pydict({"key": pa.array(k, pa.string()), "word": pa.array(w, pa.string()), "n": pa.array(n, pa.int64())})

        return run

    table = counts.select("word", "n").where("not word rlike '[\\u2e80-\\uffff\\u0e00-\\u0e7f]'")
    right = table.where(F.col("n") >= RATIO).mapInArrow(index(True), kind).select("key", F.col("word").alias("right"), F.col("n").alias("right_n"))
    most = table.agg(F.max("n")).first()[0] or 0
    wrong = table.where(F.col("n") * RATIO <= most).mapInArrow(index(False), kind)
    met = wrong.join(right, "key").where((F.col("right_n") >= RATIO * F.col("n")) & (F.col("word") != F.col("right"))).select("word", "right", "n", "right_n").distinct()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cost = [distance(w, r, allowed(len(w), True)) for w, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cost, pa.float64())], names=["word", "right", "word_n", "n", "cost"])

    far = F.when(F.length("word") <= 3, 0.35).when(F.length("word") == 4, 0.7).when(F.length("word") <= 8, 1.0).otherwise(1.4) + 0.4
    return met.mapInArrow(measure, "word string, right string, word_n bigint, n bigint, cost double").where(F.col("cost") <= far)


_PLACES = T.StructType(
    [T.StructField("line_pos", T.IntegerType()), T.StructField("word_pos", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("word", T.StringType()), T.StructField("part", T.IntegerType()), T.StructField("cut", T.IntegerType()), T.StructField("suspect", T.BooleanType()), T.StructField("before", T.StringType())]
)


def marked(pages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(places, lines, counts): places(record_id, line_pos, word_pos, kind, word, right) of all broken and misread words, headers and page numbers."""
    confidence = F.transform("lines", lambda x: x["words"]["confidence"])
    lines = cut(with_roles(page_lines(pages.withColumn("confidences", confidence), "confidences")).withColumn("row", F.monotonically_increasing_id()))
    counts = cut(word_counts(lines))
    fixes = cut(corrections(counts))
    best = fixes.groupBy("word").agg(F.min_by("right", F.struct("cost", -F.col("n"), "right")).alias("right"), F.min("cost").alias("cost"))
    # words so frequent that they cannot be misreadings are left out early; how often a word stands before a hyphen decides about compounds
    entry = lambda k, t: [F.lit(k).alias("k"), t.alias("t"), F.col("n").alias("v"), F.col("n")]
    good = counts.where(F.col("n") >= LEXICON_COUNT).join(best.select("word"), "word", "left_anti").select(*entry("known", F.col("word")))
    compounds = counts.where((F.col("n") > 1) & F.col("word").contains("-"))
    firsts = compounds.groupBy(F.concat(F.substring_index("word", "-", 1), F.lit("-")).alias("word")).agg(F.sum("n").alias("n"))
    rows, others = lookup.divided(cut(good.unionByName(compounds.select(*entry("joined", F.col("word")))).unionByName(firsts.select(*entry("first", F.col("word"))))), SENT_WORDS)
    sent = lines.sparkSession.sparkContext.broadcast({k: {r.t: r.v for r in rows if r.k == k} for k in ("known", "joined", "first")})
    names = lines.columns
    seen_lines = lookup.attached(lines, others, lambda b: (page.asked() for _, page in _pages(b, names)))
    more_at = len(names)
    kind = lines.schema["record_id"].dataType.simpleString()
    place_type = pa.struct([("line_pos", pa.int32()), ("word_pos", pa.int32()), ("kind", pa.string()), ("word", pa.string()), ("part", pa.int32()), ("cut", pa.int32()), ("suspect", pa.bool_()), ("before", pa.string())])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            more = b.column(more_at).to_pylist()
            conf = b.column(names.index("confidences"))
            inner = conf.values
            values = inner.values.to_numpy(zero_copy_only=False)
            outer_at, inner_at = conf.offsets.to_numpy(), inner.offsets.to_numpy()
            rows, places = [], []

            def suspects(row: int, line: int, word: int, pieces: int) -> bool:
                k = outer_at[row] + line
                if k >= outer_at[row + 1]:
                    return False
                c = values[inner_at[k] : inner_at[k + 1]]
                if len(c) != pieces or len(c) < 3 or not np.isfinite(c[word]):
                    return False
                return bool(c[word] < np.nanmedian(c) - SUSPECT)

            def put(row: int, line: int, word: int, what: str, text: str | None = None, part: int = -1, cut_at: int = 0, suspect: bool = False, before: str = "") -> None:
                rows.append(row)
                places.append({"line_pos": line, "word_pos": word, "kind": what, "word": text, "part": part, "cut": cut_at, "suspect": suspect, "before": before})

            for row, page in _pages(b, names):
                known, joined, firsts = (ChainMap({m["t"]: m["v"] for m in more[row] if m["k"] == k}, sent.value[k]) if more[row] else sent.value[k] for k in ("known", "joined", "first"))
                for i, role in enumerate(page.roles):
                    if role == HEADER:
                        put(row, i, -1, "header")
                        _number_in_header(page, i, lambda k, i=i, row=row: put(row, i, k, "misread"))
                    elif role == NUMBER and page.outside(i):
                        put(row, i, -1, "page_number")
                        for k, p in enumerate(page.pieces[i]):
                            if misread_number(p):
                                put(row, i, k, "misread")
                for i, nxt in page.broken.items():
                    a = page.pieces[i][-1]
                    if nxt == -1:
                        continue
                    if breaks(core(a[:-1]), core(page.pieces[nxt][0]) if nxt is not None else None, known, joined, firsts, a[-1]):
                        put(row, i, len(page.pieces[i]) - 1, "hyphen")
                for w, i, k, second, before in page.whole_words():
                    text = w.replace("\0", "")
                    rest_of_page_before = second == (-1, 0)
                    if rest_of_page_before:
                        second = None
                    if core(text) in known and not (second is None and wrong_form(w)):
                        continue
                    if second is None:
                        sign = _SIGN_FIRST.match(w)
                        if wrong_form(w) or (sign and _LETTER_OF[sign[1]] + core(w) in known):
                            put(row, i, k, "misread", core(w), -2)
                        elif len(core(w)) > 2:
                            put(row, i, k, "word", core(w), -3 if rest_of_page_before else -1, 0, suspects(row, i, k, len(page.pieces[i])), before)
                    else:
                        a, rest = w.split("\0")
                        whole = f"{core(a)}-{core(rest)}"
                        if whole in joined:
                            continue
                        for part, (line, at) in ((a, (i, k)), (rest, second)):
                            if wrong_form(part):
                                put(row, line, at, "misread", core(text), -2)
                        if not wrong_form(a) and not wrong_form(rest):
                            lead = len(a) - len(a.lstrip("\"'“”‘’«»„([{¿¡—-"))
                            put(row, i, k, "word", core(text), second[0], len(a) - lead, suspects(row, i, k, len(page.pieces[i])) or suspects(row, second[0], 0, len(page.pieces[second[0]])), before)
            yield pa.RecordBatch.from_arrays([b.column(names.index("record_id")).take(pa.array(rows, pa.int64())), pa.array(places, place_type)], names=["record_id", "p"])

    seen = seen_lines.mapInArrow(look, T.StructType([T.StructField("record_id", lines.schema["record_id"].dataType), T.StructField("p", _PLACES)])).select("record_id", "p.*")
    seen = seen.join(best, "word", "left")
    del kind
    far = F.when(F.length("word") <= 3, 0.35).when(F.length("word") == 4, 0.7).when(F.length("word") <= 8, 1.0).otherwise(1.4)
    # what may only be the rest of a word has to be very near to one
    fits = F.col("cost") <= F.when(F.col("part") == -3, 0.6).otherwise(far + F.when(F.col("suspect"), 0.4).otherwise(0.0))
    seen = seen.where((F.col("kind") != "word") | fits)
    return seen, lines, fixes


def breaks(a: str, b: str | None, known: Mapping[str, int], compounds: Mapping[str, int], firsts: Mapping[str, int], sign: str) -> bool:
    """Whether the hyphen after `a` only breaks a word that goes on with `b`, rather than being a compound's own."""
    if not a:
        return False
    if b is None:
        # the rest stands on another page: a compound if what is before the hyphen is a known first part and mostly that
        return not (firsts.get(a + "-", 0) > 0 and sign == "-")
    whole, compound = known.get(a + b, 0), compounds.get(f"{a}-{b}", 0)
    if whole or compound:
        return whole >= compound
    # neither is known: a compound if both parts are words, or if the first begins known compounds
    return not (sign == "-" and (firsts.get(a + "-", 0) > 0 or len(a) > 3 and known.get(a, 0) and known.get(b, 0)))


def misread_number(piece: str) -> bool:
    """Whether a page number has a misread sign: signs or letters beside digits, or letters that are no roman number."""
    w = _EDGES.sub("", piece).rstrip(".")
    if not w or w.casefold() in ("p", "pp", "page", "s", "seite", "pág", "pag", "с", "стр"):
        return False
    if re.search(r"[|!]", piece):
        return True
    if w.isdigit():
        return False
    if any(c.isdigit() for c in w):
        return True
    return not _ROMAN.match(w.casefold()) or w.casefold() in ("l", "ll", "li", "il") and w != w.upper()


def _number_in_header(page: Page, i: int, found) -> None:
    pieces = page.pieces[i]
    for k in (0, len(pieces) - 1):
        w = _EDGES.sub("", pieces[k])
        if w and any(c.isdigit() for c in w) and any(c.isalpha() for c in w) and len(w) <= 5 and _NUMBER_LIKE.match(w):
            found(k)


def found(pages: DataFrame) -> DataFrame:
    """(record_id, line_pos, word_pos, kind) of the marked places: hyphen, misread, header, page_number; word_pos -1 marks a line.

    Pages without lines and null texts give no rows; other columns are ignored. Records with the same record_id are told apart by nothing and give the union of their places.
    """
    seen, _, _ = marked(pages)
    # of a broken word, the part that differs from the correction is marked; both if both do
    a = F.substring("word", F.lit(1), F.col("cut"))
    b = F.expr("substring(word, cut + 1)")
    first = (F.col("part") < 0) | ~F.col("right").startswith(a)
    second = (F.col("part") >= 0) & ~F.col("right").endswith(b)
    place = lambda line, word, kind: F.struct(F.col(line).alias("line_pos"), word.alias("word_pos"), kind.alias("kind"))
    misread = F.lit("misread")
    parts = F.array_compact(F.array(F.when(first, place("line_pos", F.col("word_pos"), misread)), F.when(second, place("part", F.lit(0), misread))))
    # one branch for all kinds, so that the pages are read through once
    places = F.when(F.col("kind") == "word", parts).otherwise(F.array(place("line_pos", F.col("word_pos"), F.col("kind"))))
    return seen.select("record_id", F.explode(places).alias("p")).select("record_id", "p.*").distinct()


#: Corrections within this cost of the best one are told apart by the word before.
NEAR_COST = 0.35


def repairs(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repairs, lines): repairs(record_id, line_pos, word_pos, part, right): what to put for each misread word that has a correction; right is null where a hyphen only breaks a word.

    Of several corrections of about the same cost the one wins that most often follows the word before, then the most frequent one.
    """
    seen, lines, fixes = marked(pages)
    seen = cut(seen)
    best = fixes.groupBy("word").agg(F.min("cost").alias("least"))
    near = fixes.join(best, "word").where(F.col("cost") <= F.col("least") + NEAR_COST).select("word", F.col("right").alias("choice"), "cost", "n")
    words = seen.where("kind = 'word' or (kind = 'misread' and word is not null)").select("record_id", "line_pos", "word_pos", "part", "word", F.coalesce("before", F.lit("")).alias("before"))
    options = words.join(near, "word")
    # pairs are counted only for words that compete with another one
    rivals = near.join(near.groupBy("word").count().where("count > 1"), "word", "left_semi").select("choice").distinct()
    few = rivals.limit(SENT_WORDS + 1).collect()
    # too many to be sent: all pairs are counted, and those that compete are picked by a join
    wanted = lines.sparkSession.sparkContext.broadcast(frozenset(r.choice for r in few) if len(few) <= SENT_WORDS else None)
    names = lines.columns

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen_pairs: Counter = Counter()

        def out() -> pa.RecordBatch:
            keys = list(seen_pairs)
            b = pa.RecordBatch.from_pydict({"before": pa.array([k[0] for k in keys], pa.string()), "choice": pa.array([k[1] for k in keys], pa.string()), "times": pa.array(list(seen_pairs.values()), pa.int64())})
            seen_pairs.clear()
            return b

        for b in batches:
            for _, page in _pages(b, names):
                for w, _, _, _, before in page.whole_words():
                    c = core(w.replace("\0", ""))
                    if before and (wanted.value is None or c in wanted.value):
                        seen_pairs[before, c] += 1
                if len(seen_pairs) > FLUSH:
                    yield out()
        yield out()

    counted = lines.mapInArrow(pairs, "before string, choice string, times bigint").groupBy("before", "choice").agg(F.sum("times").alias("times"))
    if len(few) > SENT_WORDS:
        counted = counted.join(rivals, "choice", "left_semi")
    ranked = options.join(counted, ["before", "choice"], "left")
    order = F.struct(-F.coalesce("times", F.lit(0)), "cost", -F.col("n"), "choice")
    chosen = ranked.groupBy("record_id", "line_pos", "word_pos", "part").agg(F.min_by("choice", order).alias("right"))
    hyphens = seen.where("kind = 'hyphen'").select("record_id", "line_pos", "word_pos", "part", F.lit(None).cast("string").alias("right"))
    return chosen.unionByName(hyphens), lines


def _put(piece: str, right: str) -> str:
    """A correction in place of a word, with the punctuation and the capitals of the word."""
    word = _EDGES.sub("", piece) or piece
    at = piece.find(word)
    if word.isupper() and len(word) > 1:
        right = right.upper()
    elif word[:1].isupper():
        right = right[:1].upper() + right[1:]
    return piece[:at] + right + piece[at + len(word) :]


def repaired(pages: DataFrame) -> DataFrame:
    """(record_id, text): each page as continuous paragraphs: broken words whole, misread words corrected, without headers, notices and page numbers.

    record_id must be unique. Pages without lines give no row; lines of lists, tables and junk stay lines of their own.
    """
    fixed, lines = repairs(pages)
    by_page = fixed.groupBy("record_id").agg(F.collect_list(F.struct("line_pos", "word_pos", "part", "right")).alias("fixes"))
    table = lines.select("record_id", "texts", "widths", "roles").join(by_page, "record_id", "left")
    names = table.columns
    kind = lines.schema["record_id"].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            changes, all_widths = b.column(names.index("fixes")).to_pylist(), b.column(names.index("widths")).to_pylist()
            for row, page in _pages(b, names):
                done = {(f["line_pos"], f["word_pos"]): f["right"] for f in changes[row] or () if f["right"]}
                broken = {(f["line_pos"], f["word_pos"]) for f in changes[row] or () if not f["right"]}
                parts: list[str] = []
                now: list[str] = []
                skip_first: set[int] = set()
                line_widths = all_widths[row]
                widths = [w for i, w in enumerate(line_widths) if page.roles[i] == TEXT and w]
                usual = sorted(widths)[len(widths) * 3 // 4] if widths else 0
                for i, role in enumerate(page.roles):
                    if role not in (TEXT, HEADING, "list", "table", "junk"):
                        continue
                    if role != TEXT:
                        if now:
                            parts.append(" ".join(now))
                            now = []
                        parts.append(page.texts[i] or "")
                        continue
                    pieces = page.pieces[i][1:] if i in skip_first else list(page.pieces[i])
                    shift = 1 if i in skip_first else 0
                    nxt = page.broken.get(i, -1)
                    if nxt is not None and nxt >= 0 and pieces:
                        whole = (pieces[-1][:-1] if (i, len(page.pieces[i]) - 1) in broken else pieces[-1]) + page.pieces[nxt][0]
                        right = done.get((i, len(page.pieces[i]) - 1))
                        pieces[-1] = _put(whole, right) if right else whole
                        skip_first.add(nxt)
                    for k, p in enumerate(pieces):
                        right = done.get((i, k + shift))
                        if right and not (nxt is not None and nxt >= 0 and k == len(pieces) - 1):
                            pieces[k] = _put(p, right)
                    now += [p for p in pieces if p]
                    if usual and (line_widths[i] or 0) < 0.8 * usual and (nxt == -1 or i not in page.broken):
                        parts.append(" ".join(now))
                        now = []
                if now:
                    parts.append(" ".join(now))
                out.append("\n\n".join(p for p in parts if p))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["record_id", "text"])

    return table.mapInArrow(build, f"record_id {kind}, text string")
