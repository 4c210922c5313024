"""Evaluation items whose passages stand in training documents.

The items are held in an inverted index of short token sequences with BM25 weights, posting lists in blocks with a maximum each. Every document is read as
overlapping windows of tokens; a window is a query, and block-max WAND returns all items above their threshold. An item's threshold is the least
score that any passage long enough to count can reach, so the search loses none. What it returns is then compared word by word.
"""

from __future__ import annotations

import math
import re
import unicodedata
from array import array
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A leak has so many consecutive words of the item, or so many of its consecutive letters and digits where words have no spaces.
RUN_WORDS = 12
RUN_SIGNS = 25
#: Or so many consecutive words of which one in ALTERED_EVERY may be changed or left out.
ALTERED_WORDS = 20
ALTERED_EVERY = 8

K1, B = 1.2, 0.75
BLOCK = 16
#: Items indexed at once, by the characters of their texts (one text at least); more are searched in several blocks, each against all documents.
CHARS_AT_ONCE = 20_000_000

_ATTRIBUTES = r"""(?:\s++[\w:.-]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'<>=]++))?)*+\s*+/?"""
_INLINE = re.compile(rf"</?(?:b|i|em|strong|span|a|u|s|sup|sub|mark|small)(?![\w:-]){_ATTRIBUTES}>", re.I)
_TAG = re.compile(rf"</?[a-zA-Z][\w:-]*+{_ATTRIBUTES}>|&(?:nbsp|amp|lt|gt|quot|#\d+);")
_BROKEN = re.compile(r"(?<=\w)[-‐¬\xad][ \t]*\r?\n[> \t]*(?=\w)")
_JOINED = re.compile(r"(?<=\w)[-‐‑](?=\w)")
_MARKS = re.compile("[̀-ͯ]")
_HIDDEN = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAC])
_WORD = re.compile(r"[^\W_]+")
_CJK = re.compile("[぀-ヿ㐀-鿿豈-﫿]")


def _without_comments(text: str) -> str:
    parts, at = [], 0
    while (begin := text.find("<!--", at)) >= 0 and (end := text.find("-->", begin + 4)) >= 0:
        parts += [text[at:begin], " "]
        at = end + 3
    return "".join([*parts, text[at:]])


def plain(text: str) -> str:
    """A text without what does not matter: case, accents, markup, digit width, words broken or joined by a hyphen."""
    if "<" in text or "&" in text:
        text = _TAG.sub(" ", _INLINE.sub("", _without_comments(text)))
    if not text.isascii():
        text = _BROKEN.sub("", text)
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text)).translate(_HIDDEN)
    else:
        text = _BROKEN.sub("", text)
    return _JOINED.sub("", text).casefold()


def words_of(plain_text: str) -> list[str]:
    return _WORD.findall(plain_text)


def signs_of(plain_text: str) -> list[str]:
    return list("".join(_WORD.findall(plain_text)))


class Postings:
    """The items of one term in order with their weights, and of each block of BLOCK items the greatest weight and the last item."""

    __slots__ = ("items", "weights", "most", "last")

    def __init__(self, rows: list[tuple[int, float]]) -> None:
        self.items = array("i", (i for i, _ in rows))
        self.weights = array("d", (w for _, w in rows))
        self.most = array("d", (max(self.weights[k : k + BLOCK]) for k in range(0, len(rows), BLOCK)))
        self.last = array("i", (self.items[min(k + BLOCK, len(rows)) - 1] for k in range(0, len(rows), BLOCK)))


@dataclass
class Index:
    """The items of one kind of token: words, or single signs."""

    gram: int
    run: int
    window: int
    altered: bool
    names: list = field(default_factory=list)
    tokens: list[list[int]] = field(default_factory=list)
    vocabulary: dict[str, int] = field(default_factory=dict)
    keys: np.ndarray | None = None
    bounds: np.ndarray | None = None
    postings: list[Postings] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)

    def grams(self, ids: np.ndarray) -> np.ndarray:
        """A number for the sequence of `gram` tokens that begins at each place; 0 if it holds an unknown token."""
        n = len(ids) - self.gram + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out, known = np.zeros(n, np.uint64), np.ones(n, bool)
        for k in range(self.gram):
            part = ids[k : k + n]
            known &= part >= 0
            out = out * np.uint64(0x9E3779B97F4A7C15) + (part + 1).astype(np.uint64)
        out[~known] = 0
        return out

    def build(self, items: list[tuple[object, list[str]]]) -> Index:
        for name, tokens in items:
            if len(tokens) >= self.run:
                self.names.append(name)
                self.tokens.append([self.vocabulary.setdefault(t, len(self.vocabulary)) for t in tokens])
        grams = [self.grams(np.array(t, np.int64)).tolist() for t in self.tokens]
        df = Counter(g for gs in grams for g in set(gs))
        terms = sorted(df)
        number = {g: i for i, g in enumerate(terms)}
        self.keys = np.array(terms, np.uint64)
        mean = sum(map(len, grams)) / max(1, len(grams))
        lists: list[list[tuple[int, float]]] = [[] for _ in terms]
        for i, gs in enumerate(grams):
            weight = {}
            for g, tf in Counter(gs).items():
                idf = math.log(1 + (len(grams) - df[g] + 0.5) / (df[g] + 0.5))
                weight[g] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(gs) / mean))
                lists[number[g]].append((i, weight[g]))
            self.thresholds.append(self._least(gs, weight) * 0.999)
        self.bounds = np.array([max(w for _, w in p) for p in lists]) if lists else np.zeros(0)
        self.postings = [Postings(p) for p in lists]
        return self

    def _least(self, gs: list[int], weight: dict[int, float]) -> float:
        """The least score of a passage that counts: `run` tokens, or ALTERED_WORDS less all sequences that its changes can touch."""

        def over(n: int, spoilt: int) -> float:
            width = n - self.gram + 1
            return min((sum(sorted((weight[g] for g in set(gs[k : k + width])), reverse=True)[spoilt:]) for k in range(max(1, len(gs) - width + 1))), default=0.0)

        least = over(self.run, 0)
        if self.altered and len(gs) + self.gram - 1 >= ALTERED_WORDS:
            least = min(least, over(ALTERED_WORDS, self.gram * (ALTERED_WORDS // ALTERED_EVERY)))
        return least

    def search(self, terms: list[int], least: float) -> dict[int, float]:
        """Block-max WAND: score of every item that reaches `least` for these distinct terms.

        Lists are taken in order of their next items; the first at which the terms' greatest weights together reach `least` is the pivot. If the blocks that may hold the
        pivot's item cannot reach it, all lists up to there jump over the block that ends first; else they move to the item, by bisection.
        """
        lists = [self.postings[t] for t in terms]
        bounds = [float(self.bounds[t]) for t in terms]
        end = len(self.names)
        at = [0] * len(lists)
        now = [p.items[0] for p in lists]
        order = sorted(range(len(lists)), key=now.__getitem__)
        found: dict[int, float] = {}

        def move(k: int, item: int) -> None:
            """List k to its first item of at least `item`: over whole blocks first, then inside one."""
            p = lists[k]
            block = bisect_left(p.last, item, at[k] // BLOCK)
            at[k] = bisect_left(p.items, item, max(at[k], block * BLOCK), min(len(p.items), block * BLOCK + BLOCK)) if block < len(p.last) else len(p.items)
            now[k] = p.items[at[k]] if at[k] < len(p.items) else end

        while True:
            bound, pivot = 0.0, -1
            for place, k in enumerate(order):
                if now[k] >= end:
                    break
                bound += bounds[k]
                if bound >= least:
                    pivot = place
                    break
            if pivot < 0:
                return found
            item = now[order[pivot]]
            while pivot + 1 < len(order) and now[order[pivot + 1]] == item:
                pivot += 1
            front = order[: pivot + 1]
            # the blocks that would hold the item, without going there
            blocks = [bisect_left(lists[k].last, item, at[k] // BLOCK) for k in front]
            held = sum(lists[k].most[b] for k, b in zip(front, blocks, strict=True) if b < len(lists[k].most))
            if held < least:
                beyond = min([lists[k].last[b] + 1 for k, b in zip(front, blocks, strict=True) if b < len(lists[k].last)] + [now[k] for k in order[pivot + 1 : pivot + 2]] + [end])
                for k in front:
                    move(k, max(beyond, item + 1))
            elif now[front[0]] == item:
                score = sum(lists[k].weights[at[k]] for k in front)
                if score >= least:
                    found[item] = score
                for k in front:
                    move(k, item + 1)
            else:
                for k in front:
                    if now[k] < item:
                        move(k, item)
            order.sort(key=now.__getitem__)

    def verify(self, doc: list[int], item: list[int]) -> tuple[int, bool]:
        """Longest run of the item's tokens in doc, and whether a passage counts, unaltered or altered."""
        places = defaultdict(list)
        for i, t in enumerate(item):
            places[t].append(i)
        longest, before, starts = 0, {}, []
        for j, t in enumerate(doc):
            now = {}
            for i in places.get(t, ()):
                now[i] = before.get(i - 1, 0) + 1
                if now[i] == 2:
                    starts.append((i - 1, j - 1))
                longest = max(longest, now[i])
            before = now
        if longest >= self.run or not self.altered:
            return longest, longest >= self.run
        return longest, any(self._altered(doc[max(0, j - k) :], item[max(0, i - k) :]) for i, j in starts for k in (0, 1))

    @staticmethod
    def _altered(doc: list[int], item: list[int]) -> bool:
        band, most = 4, 2 * ALTERED_WORDS
        if len(item) < ALTERED_WORDS or len(doc) < ALTERED_WORDS - most // ALTERED_EVERY:
            return False
        row = [abs(d) if d >= 0 else 99 for d in range(-band, band + 1)]
        for n in range(1, min(most, len(item)) + 1):
            new = []
            for d in range(-band, band + 1):
                j = n + d
                k = d + band
                best = 99
                if j >= 1 and j <= len(doc):
                    best = row[k] + (item[n - 1] != doc[j - 1])
                if j >= 0 and k + 1 < len(row):
                    best = min(best, row[k + 1] + 1)
                if j >= 1 and new:
                    best = min(best, new[-1] + 1)
                new.append(best)
            row = new
            if min(row) > most // ALTERED_EVERY:
                return False
            if n >= ALTERED_WORDS and min(row) <= n // ALTERED_EVERY:
                return True
        return False


def build_indexes(items: list[tuple[object, str | None]]) -> list[Index]:
    """Items with Han or kana signs are read sign by sign, all others word by word."""
    by: dict[bool, list] = {False: [], True: []}
    for name, text in items:
        if text:
            t = plain(text)
            cjk = bool(_CJK.search(t))
            by[cjk].append((name, signs_of(t) if cjk else words_of(t)))
    return [
        Index(3, RUN_WORDS, 2 * ALTERED_WORDS, True).build(by[False]),
        Index(8, RUN_SIGNS, 3 * RUN_SIGNS, False).build(by[True]),
    ]


def leaked(index: Index, docs: list[list[str]]) -> list[tuple[int, int, float, int]]:
    """(doc, item, score, longest run) of every leak; docs are token lists."""
    if not index.names:
        return []
    get = index.vocabulary.get
    gap = index.gram
    sizes = np.array([len(d) for d in docs], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + gap)))
    ids = np.full(int(starts[-1]) + index.window, -1, np.int64)
    for d, begin in zip(docs, starts, strict=False):
        ids[begin : begin + len(d)] = [get(t, -1) for t in d]
    grams = index.grams(ids)
    where = np.searchsorted(index.keys, grams)
    where[where == len(index.keys)] = 0
    hit = (grams != 0) & (index.keys[where] == grams)
    total = np.concatenate(([0.0], np.cumsum(np.where(hit, index.bounds[where], 0.0))))
    step, width = index.window // 2, index.window - index.gram + 1
    first = np.arange(0, len(grams), step)
    last = np.minimum(first + width, len(grams))
    least = min(index.thresholds)
    out: dict[tuple[int, int], tuple[float, int]] = {}
    for k in np.flatnonzero(total[last] - total[first] >= least):
        a, b = int(first[k]), int(last[k])
        terms = np.unique(where[a:b][hit[a:b]]).tolist()
        for item, score in index.search(terms, least).items():
            if score < index.thresholds[item]:
                continue
            # the window with as much on either side, document by document
            lo, hi = max(0, a - index.window), b + index.window
            for d in range(int(np.searchsorted(starts, lo, "right")) - 1, int(np.searchsorted(starts, hi, "left"))):
                if d >= len(docs) or (d, item) in out:
                    continue
                span = ids[max(lo, int(starts[d])) : min(hi, int(starts[d] + sizes[d]))].tolist()
                longest, counts = index.verify(span, index.tokens[item])
                if counts:
                    out[d, item] = (score, longest)
    return [(d, i, s, n) for (d, i), (s, n) in out.items()]


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, score, longest_run): every document that holds a passage of an item, with each item it holds.

    The items are indexed on the driver and sent to all tasks in blocks of CHARS_AT_ONCE; documents are read once for each block and never shuffled before the
    search. Null, empty and too short texts and items leak nothing; repeated rows of either side give one row; other columns are ignored.
    """
    spark = docs.sparkSession
    known = items.where(F.col(item_text).isNotNull()).select(item_id, item_text).distinct().orderBy(item_id, item_text).toLocalIterator()
    kinds = (docs.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString())
    schema = f"`{doc_id}` {kinds[0]}, `{item_id}` {kinds[1]}, score double, longest_run int"
    source = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("d"), F.col(text).cast("string").alias("t"))
    results: list[DataFrame] = []

    def searched(block: list[tuple[object, str]]) -> DataFrame:
        sent = spark.sparkContext.broadcast(build_indexes(block))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, signs = sent.value
            for batch in batches:
                for k in range(0, batch.num_rows, 500):
                    b = batch.slice(k, 500)
                    texts = [plain(t) for t in b.column(1).to_pylist()]
                    found = [(d, words.names[i], s, n) for d, i, s, n in leaked(words, [words_of(t) for t in texts])]
                    if signs.names:
                        at = [j for j, t in enumerate(texts) if not t.isascii() and _CJK.search(t)]
                        found += [(at[d], signs.names[i], s, n) for d, i, s, n in leaked(signs, [signs_of(texts[j]) for j in at])]
                    ids = b.column(0).take(pa.array([f[0] for f in found], pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array([f[1] for f in found], pa.from_numpy_dtype(np.int64) if kinds[1] == "bigint" else None), pa.array([f[2] for f in found], pa.float64()), pa.array([f[3] for f in found], pa.int32())],
                        names=[doc_id, item_id, "score", "longest_run"],
                    )

        return source.mapInArrow(run, schema)

    block: list[tuple[object, str]] = []
    size = 0
    for row in known:
        if block and size + len(row[1]) > CHARS_AT_ONCE:
            results.append(searched(block))
            block, size = [], 0
        block.append((row[0], row[1]))
        size += len(row[1])
    if block or not results:
        results.append(searched(block))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out.groupBy(doc_id, item_id).agg(F.max("score").alias("score"), F.max("longest_run").alias("longest_run"))
