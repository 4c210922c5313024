"""Sentence ends in running text of many scripts.

Every character is inside a sentence or ends one; a linear-chain model gives each place where a sentence may end a score for either tag, from what the
corpus tells about the word before it, the signs at it and what follows, and each step from one end to the next a score from the length between them. Viterbi
decoding picks the best tags of a page. The model learns from places that are certain: ends of paragraphs on one side, small letters and
digits that follow on the other. For Thai, which has no stops, it learns the letters before paragraph ends against those before all spaces.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import ChainMap, Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import cut
from .layout import TEXT, page_lines, page_roles

#: At most so many learnt counts are sent to all tasks, most frequent first; pages get the rest that they ask for by a join.
MAX_COUNTS = 200_000
FLUSH = 200_000

_HYPHENS = "-‐¬\xad"
_CLOSE = "\"'”’»›)\\]」』）】"
_STOP = r"(?:[.…]+|[!?]+|[。！？｡]+|[।॥]+|[؟۔]+)"
_ENDS = re.compile(rf"{_STOP}(?:{_STOP})*(?:[{_CLOSE}]|[   \n]?[»›]|\n[”)\]」』]|(?<=[.!?…])“(?=[\s,;]|$))*(?:{_STOP})?")
_OPEN = "„“‘«‹([「『（【\"'¿¡"
_SPACE_TH = re.compile(r"(?<=[฀-๿])[ \n]+(?=\S)|(?<=[฀-๿])$|(?<=[฀-๿])\n(?=[฀-๿])")
_WORD_BEFORE = re.compile(r"([\w’'\-؀-ۿऀ-ॿ]+)$")
_WORD_AFTER = re.compile(r"\w+")
_TOKENS = re.compile(r"[\w؀-ۿऀ-ॿ]+")

_SCRIPTS = (("th", "[฀-๿]"), ("hi", "[ऀ-ॿ]"), ("ar", "[؀-ۿ]"), ("ja", "[぀-ヿ]"), ("zh", "[一-鿿]"), ("ru", "[Ѐ-ӿ]"), ("el", "[Ͱ-Ͽ]"))
_SCRIPT_RX = [(k, re.compile(rx)) for k, rx in _SCRIPTS]


def script_of(text: str) -> str:
    """The script of a text by its letters; Latin if none prevails."""
    if text.isascii():
        return "la"
    letters = max(1, sum(c.isalpha() for c in text))
    for k, rx in _SCRIPT_RX:
        if len(rx.findall(text)) > (0.1 if k == "ja" else 0.3) * letters:
            return k
    return "la"


@dataclass
class Stream:
    """The running text of a page as one string. starts: where each kept line begins in it; lines: their positions."""

    text: str
    starts: list[int]
    lines: list[int]
    paragraph_ends: set[int]

    @classmethod
    def of(cls, texts: list[str | None], widths: list[float | None], roles: list[str]) -> Stream:
        keep = [i for i, r in enumerate(roles) if r == TEXT]
        sizes = sorted(widths[i] or 0 for i in keep)
        usual = sizes[len(sizes) * 3 // 4] if sizes else 0
        parts, starts, ends, at = [], [], set(), 0
        for n, i in enumerate(keep):
            t = texts[i] or ""
            starts.append(at)
            glue = "" if t[-1:] in _HYPHENS and t[-2:-1].isalpha() else "\n"
            parts += [t, glue]
            at += len(t)
            if (widths[i] or 0) < 0.8 * usual and n + 1 < len(keep) and glue:
                ends.add(at)
            at += len(glue)
        return cls("".join(parts), starts, keep, ends)

    def place(self, end: int) -> tuple[int, int]:
        """(line position, characters of the line up to there) of the end of the character before `end`."""
        lo, hi = 0, len(self.starts)
        while hi - lo > 1:
            mid = (lo + hi) // 2
            if self.starts[mid] < end:
                lo = mid
            else:
                hi = mid
        return self.lines[lo], end - self.starts[lo]


@dataclass
class Candidate:
    end: int
    signs: str
    word: str
    follows: str
    quoted: bool
    tag_follows: bool
    paragraph: bool
    after: str = ""


def _follows(t: str, at: int) -> tuple[str, int]:
    """The class of what follows a place, and where it stands."""
    n = len(t)
    while at < n and (t[at].isspace() or t[at] in "•*"):
        at += 1
    if at >= n:
        return "end", at
    c = t[at]
    if c in "—–-":
        k, where = _follows(t, at + 1)
        return ("lower" if k == "lower" else k), where
    if c in _OPEN:
        return "open", at
    if c.isdigit():
        return "digit", at
    if c in ",;:،؛、，；：":
        return "comma", at
    if c.islower():
        return "lower", at
    if c.isupper():
        return "upper", at
    return ("other" if c.isalpha() else "sign"), at


_SPEECH_STOP = re.compile(r"[.!?…。！？।؟]")


def candidates(s: Stream, script: str) -> list[Candidate]:
    t = s.text
    out = []
    if script == "th":
        for m in _SPACE_TH.finditer(t):
            k, _ = _follows(t, m.end())
            before = t[max(0, m.start() - 8) : m.start()]
            out.append(Candidate(m.start(), " " if " " in m[0] else "\n", before, k, False, False, m.start() in s.paragraph_ends, t[m.end() : m.end() + 3]))
        return out
    for m in _ENDS.finditer(t):
        a, b = m.span()
        signs = m[0]
        if signs[0] in ".…" and set(signs) <= {"."} and b < len(t) and a and t[b].isalnum() and t[a - 1].isalnum():
            continue
        if signs == "." and b < len(t) and t[b].isalnum() and script not in ("zh", "ja"):
            continue
        word = _WORD_BEFORE.search(t, max(0, a - 30), a)
        k, where = _follows(t, b)
        quoted = any(c in "\"'”’»」』“" for c in signs)
        tag = False
        if quoted and k == "other":
            if script == "ja":
                tag = t[where] == "と"
            else:
                stop = _SPEECH_STOP.search(t, where, where + 60)
                clause = t[where : stop.start()] if stop else ""
                flat = clause.replace("\n", "" if script == "zh" else " ")
                short = 0 < len(flat) <= 10 if script == "zh" else 0 < len(flat.split()) <= 4
                # speech that its speaker introduces is already whole
                opened = t.rfind("“", 0, a) if script == "zh" else -1
                introduced = opened > 0 and t[:opened].rstrip("\n")[-1:] in "：:"
                tag = short and not introduced and (script != "zh" or flat[-1:] in "道说答喊问")
        after = _WORD_AFTER.match(t, where) if k == "upper" else None
        out.append(Candidate(b, signs, (word[1] if word else "").casefold(), k, quoted, tag, b in s.paragraph_ends, after[0].casefold() if after else ""))
    return out


@dataclass
class Model:
    """Counts by (script, what, term), and what the chain has learnt: emission weights by feature and the cost of a short step by script. Without these it is the seed."""

    counts: Mapping[tuple[str, str, str], int] = field(default_factory=dict)
    weights: Mapping[tuple, float] | None = None
    short: Mapping[str, float] = field(default_factory=dict)

    def ratio(self, script: str, yes: str, no: str, term: str, least: float = 0.5) -> float:
        """Log odds of a term among the ends against the rest, by each side's share."""
        a, b = self.counts.get((script, yes, term), 0), self.counts.get((script, no, term), 0)
        na, nb = self.counts.get((script, yes, ""), 0), self.counts.get((script, no, ""), 0)
        if not na or not nb:
            return 0.0
        return max(-4.0, min(4.0, math.log((a + least) / (na + 1)) - math.log((b + least) / (nb + 1))))

    def odds(self, script: str, word: str) -> float:
        """Log odds that a stop after this word ends a sentence; words not met before mostly do."""
        a, b = self.counts.get((script, "stop", word), 0), self.counts.get((script, "inner", word), 0)
        return max(-6.0, min(4.0, math.log(a + 0.9) - math.log(b + 0.1)))

    def features(self, c: Candidate, script: str) -> list[tuple[tuple, float]]:
        """What is seen at a place, as (feature, value); numbers come in quarters."""
        if script == "th":
            known = self.counts.get((script, "any4", c.word[-4:]), 0) > 1
            before = self.ratio(script, "last4", "any4", c.word[-4:]) if known else self.ratio(script, "last3", "any3", c.word[-3:])
            n = "4" if known else "3"
            return [(("th", c.signs), 1.0), (("th", "follows", c.follows), 1.0), (("th", "paragraph", c.paragraph), 1.0), (("th", "before", n), round(4 * before) / 4), (("th", "after"), round(4 * self.ratio(script, "first", "next", c.after)) / 4)]
        kind = "strong" if any(x in "!?。！？।॥؟۔" for x in c.signs) else "dots" if "…" in c.signs or ".." in c.signs else "dot"
        group = script if script in ("ja", "zh", "ar", "hi") else "cased"
        out = [((group, kind), 1.0), ((kind, "follows", c.follows), 1.0), ((kind, "paragraph", c.paragraph), 1.0), (("speaker", c.tag_follows), 1.0)]
        if kind == "dot":
            # a word met more often inside than at the end of sentences is an abbreviation
            out += [((kind, "word", round(self.odds(script, c.word)) if c.word else "none"), 1.0), ((kind, "letter", len(c.word) == 1 and not c.word.isdigit() and group == "cased"), 1.0)]
        elif kind == "dots":
            share = sum(self.counts.get((script, k, c.after), 0) for k in ("small", "opens")) / max(1, self.counts.get((script, "word", c.after), 0)) if c.after else -1.0
            out += [((kind, "word", group == "cased" if not c.word else "any"), 1.0), ((kind, "final"), round(4 * self.ratio(script, "final", "word", c.word, 0.3)) / 4 if c.word else 0.0)]
            out.append(((kind, "after", 2 if share >= 0.3 else 1 if share >= 0.05 else 0 if share >= 0 else "none"), 1.0))
        return out

    def score(self, c: Candidate, script: str) -> float:
        """Log odds of an end against none."""
        if self.weights is None:
            return self.seed(c, script)
        return sum(self.weights.get(k, 0.0) * v for k, v in self.features(c, script))

    def seed(self, c: Candidate, script: str) -> float:
        """Log odds by rule of thumb, which only label the first round of training."""
        if script == "th":
            if c.paragraph:
                return 4.0
            if c.follows == "digit" or c.follows == "lower":
                return -4.0
            # four letters met only here tell nothing
            known = self.counts.get((script, "any4", c.word[-4:]), 0) > 1
            before = self.ratio(script, "last4", "any4", c.word[-4:]) if known else self.ratio(script, "last3", "any3", c.word[-3:])
            return before + 0.7 * self.ratio(script, "first", "next", c.after) - (0.6 if c.signs == "\n" else 0.0)
        if c.follows in ("lower", "comma") or c.tag_follows:
            return -9.0
        strong = any(x in "!?。！？।॥؟۔" for x in c.signs)
        if c.paragraph:
            return 6.0
        base = 3.0 if strong else 0.5
        if "…" in c.signs or ".." in c.signs:
            if not strong:
                base = 0.3 if c.follows in ("upper", "open", "other") else -1.0
                base += 1.2 * self.ratio(script, "final", "word", c.word, 0.3) if c.word else (1.0 if script in ("zh", "ja") else -2.0)
                if c.follows == "end":
                    base += 1.0
                if c.after:
                    # a capital tells much before a word that is often written small or often begins sentences, little before a noun
                    share = sum(self.counts.get((script, k, c.after), 0) for k in ("small", "opens")) / max(1, self.counts.get((script, "word", c.after), 0))
                    base += 3.0 if share >= 0.3 else -1.0 if share < 0.05 else 0.0
                return base
        elif not strong:
            base += self.odds(script, c.word) if c.word else -0.5
            if c.word and len(c.word) == 1 and not c.word.isdigit() and script in ("la", "ru", "el"):
                base -= 2.0
        if c.follows == "digit":
            return base - (5.0 if not strong else 1.0)
        return base + {"upper": 2.5, "open": 2.5, "other": 2.5, "end": 2.0, "sign": 0.0}.get(c.follows, 0.0)


def asked(c: Candidate, script: str) -> list[tuple[str, str, str]]:
    """The counts that Model.score may look up for a candidate, besides the totals."""
    if script == "th":
        terms = [("any4", c.word[-4:]), ("last4", c.word[-4:]), ("any3", c.word[-3:]), ("last3", c.word[-3:]), ("first", c.after), ("next", c.after)]
    else:
        terms = [(k, c.word) for k in ("stop", "inner", "final", "word")] + [(k, c.after) for k in ("small", "opens", "word")]
    return [(script, k, t) for k, t in terms if t]


#: Letters that a sentence mostly has at least; what a shorter step between two ends costs is learnt, SHORT before that.
LEAST_LETTERS = {"th": 24}
SHORT = 3.0


def decode(s: Stream, script: str, model: Model) -> list[int]:
    """Ends of the sentences, by Viterbi over the tags of all candidates; the state is the last end so far."""
    cs = candidates(s, script)
    if not cs:
        return []
    least, short = LEAST_LETTERS.get(script, 2), model.short.get(script, SHORT)
    # chain of ends: best score of a path whose last end is candidate k
    best, back = [], []
    # between two ends only the step length matters, and it stops mattering beyond `least` letters
    run = (0.0, -1)
    behind: list[tuple[float, int, int]] = []
    for k, c in enumerate(cs):
        while behind and c.end - behind[0][2] >= least:
            v = behind.pop(0)
            if v[0] > run[0]:
                run = (v[0], v[1])
        here = max([(run[0], run[1]), *[(v[0] - short, v[1]) for v in behind]])
        score = model.score(c, script)
        best.append(here[0] + score)
        back.append(here[1])
        behind.append((best[k], k, c.end))
    top, at = 0.0, -1
    for k, v in enumerate(best):
        if v > top:
            top, at = v, k
    out = []
    while at >= 0:
        out.append(cs[at].end)
        at = back[at]
    return out[::-1]


def _learn(s: Stream, script: str, out: Counter) -> None:
    for c in candidates(s, script):
        if script == "th":
            for n, kind in ((3, "3"), (4, "4")):
                w = c.word[-n:]
                out[script, f"any{kind}", w] += 1
                out[script, f"any{kind}", ""] += 1
                if c.paragraph:
                    out[script, f"last{kind}", w] += 1
                    out[script, f"last{kind}", ""] += 1
            if c.signs == " " or c.paragraph:
                what = "first" if c.paragraph else "next"
                out[script, what, c.after] += 1
                out[script, what, ""] += 1
            continue
        strong = any(x in "!?。！？।॥؟۔" for x in c.signs)
        if c.word and not strong and c.signs[0] == "." and ".." not in c.signs:
            if c.paragraph or c.follows in ("upper", "open") or (c.follows == "other" and script in ("ar", "hi")):
                out[script, "stop", c.word] += 1
                out[script, "stop", ""] += 1
            elif c.follows in ("lower", "digit", "comma"):
                out[script, "inner", c.word] += 1
                out[script, "inner", ""] += 1
        if c.after and "…" not in c.signs and ".." not in c.signs:
            out[script, "opens", c.after] += 1
        if c.word and (strong or c.paragraph) and c.follows != "lower":
            out[script, "final", c.word] += 1
            out[script, "final", ""] += 1
    if script not in ("th", "zh", "ja"):
        words = _TOKENS.findall(s.text)
        out.update((script, "word", w.casefold()) for w in words)
        if script in ("la", "ru", "el"):
            out.update((script, "small", w) for w in words if w.islower())
        out[script, "word", ""] += len(words)


def streams(lines: DataFrame) -> DataFrame:
    """(record_id, book_id, page_num, script, text, starts, lines, ends): the running text of each page (as `page_lines` gives them) as one string."""
    names = lines.columns

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, widths, repeated, titles = (b.column(names.index(n)).to_pylist() for n in ("texts", "widths", "repeated", "titles"))
            made = []
            for t, w, r, h in zip(texts, widths, repeated, titles, strict=True):
                w = [x if x else len(y or "") for x, y in zip(w, t, strict=True)]
                made.append(Stream.of(t, w, page_roles(t, w, set(r or ()), set(h or ()))))
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *(b.column(names.index(n)) for n in ("record_id", "book_id", "page_num")),
                    pa.array([script_of(s.text) for s in made], pa.string()),
                    pa.array([s.text for s in made], pa.string()),
                    pa.array([s.starts for s in made], ints),
                    pa.array([s.lines for s in made], ints),
                    pa.array([sorted(s.paragraph_ends) for s in made], ints),
                ],
                names=["record_id", "book_id", "page_num", "script", "text", "starts", "lines", "ends"],
            )

    kinds = ", ".join(f"{n} {lines.schema[n].dataType.simpleString()}" for n in ("record_id", "book_id", "page_num"))
    return lines.mapInArrow(make, f"{kinds}, script string, text string, starts array<int>, lines array<int>, ends array<int>")


def _streams(batch: pa.RecordBatch) -> Iterator[tuple[int, Stream, str]]:
    for row, (script, *parts, ends) in enumerate(zip(*(c.to_pylist() for c in batch.columns[3:8]), strict=True)):
        yield row, Stream(*parts, set(ends)), script


def learn(running: DataFrame) -> tuple[Model, DataFrame | None]:
    """The model from the running text of all pages, with at most MAX_COUNTS counts, and a table (s, k, t, n) of all others, if there are any. Tasks count before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            keys = list(seen)
            b = pa.RecordBatch.from_pydict({"s": pa.array([k[0] for k in keys], pa.string()), "k": pa.array([k[1] for k in keys], pa.string()), "t": pa.array([k[2] for k in keys], pa.string()), "n": pa.array([seen[k] for k in keys], pa.int64())})
            seen.clear()
            return b

        for b in batches:
            for _, s, script in _streams(b):
                _learn(s, script, seen)
                if len(seen) > FLUSH:
                    yield out()
        yield out()

    table = cut(running.mapInArrow(count, "s string, k string, t string, n bigint").groupBy("s", "k", "t").agg(F.sum("n").alias("n")))
    rows = table.orderBy(F.desc(F.col("t") == ""), F.desc("n"), "s", "k", "t").limit(MAX_COUNTS + 1).collect()
    if len(rows) <= MAX_COUNTS:
        return Model({(r.s, r.k, r.t): r.n for r in rows}), None
    least = rows[-1].n
    return Model({(r.s, r.k, r.t): r.n for r in rows if r.n > least or r.t == ""}), table.where((F.col("n") <= least) & (F.col("t") != ""))


def with_counts(running: DataFrame, model: Model, others: DataFrame | None) -> DataFrame:
    """running with more: the counts of `others` that the candidates of each row ask for and the model lacks."""
    more = "array<struct<s:string,k:string,t:string,n:bigint>>"
    if others is None:
        return running.withColumn("more", F.lit(None).cast(more))
    sent = running.sparkSession.sparkContext.broadcast(model)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.column(b.schema.get_field_index("row")).to_pylist()
            out = [(rows[row], *key) for row, s, script in _streams(b) for key in {x for c in candidates(s, script) for x in asked(c, script)} if key not in sent.value.counts]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.string(), pa.string()))], names=["row", "s", "k", "t"])

    met = running.mapInArrow(ask, "row bigint, s string, k string, t string").join(others, ["s", "k", "t"])
    return running.join(met.groupBy("row").agg(F.collect_list(F.struct("s", "k", "t", "n")).alias("more")), "row", "left").select(*running.columns, "more")


#: The chain is trained on at most so many pages, spread by a hash of their ids, in so many rounds, with so strong a pull of all weights to zero.
TRAINING_PAGES = 20_000
ROUNDS = 2
RIDGE = 0.5


def _examples(s: Stream, script: str, model: Model, out: Counter) -> None:
    """Counts (features, label) of a page as the model decodes it, and of its steps: (script, short or not, from an end to an end or to any candidate)."""
    cs, ends = candidates(s, script), set(decode(s, script, model))
    least, last = LEAST_LETTERS.get(script, 2), 0
    for c in cs:
        is_end = c.end in ends
        out["place", tuple(model.features(c, script)), is_end] += 1
        out["step", (script, c.end - last < least), is_end] += 1
        if is_end:
            last = c.end


def fitted(examples: Mapping[tuple, int]) -> tuple[dict[tuple, float], dict[str, float]]:
    """(weights, short) by the greatest likelihood of the labels, with a ridge; counts stand for equal examples."""
    rows: dict[tuple, list[int]] = {}
    for (what, seen, label), n in examples.items():
        if what == "place":
            rows.setdefault(seen, [0, 0])[label] += n
    names = sorted({k for seen in rows for k, _ in seen}, key=repr)
    at = {k: i for i, k in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for i, seen in enumerate(sorted(rows, key=repr)):
        for k, v in seen:
            x[i, at[k]] += v
    no, yes = (np.array([rows[seen][label] for seen in sorted(rows, key=repr)], float) for label in (0, 1))
    w = np.zeros(len(names))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (yes - (yes + no) * p) - RIDGE * w
        bend = (x * ((yes + no) * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(names))
        step = np.linalg.solve(bend, slope)
        w += np.clip(step, -2, 2)
        if np.abs(step).max(initial=0) < 1e-4:
            break
    short = {}
    for script in {seen[0] for (what, seen, _) in examples if what == "step"}:
        n = {(is_short, label): examples.get(("step", (script, is_short), label), 0) for is_short in (False, True) for label in (False, True)}
        # how much rarer short steps are between ends than from an end to any candidate
        between = (n[True, True] + 0.5) / (n[True, True] + n[False, True] + 1)
        any_ = (n[True, True] + n[True, False] + 0.5) / (sum(n.values()) + 1)
        short[script] = max(0.0, math.log(any_ / between))
    return dict(zip(names, w.tolist(), strict=True)), short


def trained(running: DataFrame, model: Model) -> Model:
    """The model with weights and step costs learnt by Viterbi training: pages are decoded, the chain is fitted to what was decoded, and once more.

    The first labels are the seed's: places before small letters and commas are none, ends of paragraphs are ends, words mostly met inside sentences speak against one.
    """
    ids = running.select("row").orderBy(F.xxhash64("row"), "row").limit(TRAINING_PAGES)
    pages = cut(running.join(F.broadcast(ids), "row", "left_semi").select(*running.columns).repartition(max(1, running.sparkSession.sparkContext.defaultParallelism)))
    for _ in range(ROUNDS):
        sent = running.sparkSession.sparkContext.broadcast(model)

        def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: Counter = Counter()
            for b in batches:
                more = b.column(b.schema.get_field_index("more")).to_pylist()
                for row, s, script in _streams(b):
                    _examples(s, script, _own(sent.value, more[row]), seen)
            yield pa.RecordBatch.from_pydict({"seen": pa.array([pickle.dumps(k) for k in seen], pa.binary()), "n": pa.array(list(seen.values()), pa.int64())})

        counts = pages.mapInArrow(label, "seen binary, n bigint").groupBy("seen").agg(F.sum("n").alias("n")).toArrow()
        examples: Counter = Counter()
        for k, n in zip(counts.column("seen").to_pylist(), counts.column("n").to_pylist(), strict=True):
            examples[pickle.loads(k)] += n
        weights, short = fitted(examples)
        model = Model(model.counts, weights, short)
    return model


def _own(model: Model, more: list[dict] | None) -> Model:
    """The model with the counts that a row brings along."""
    return Model(ChainMap({(x["s"], x["k"], x["t"]): x["n"] for x in more}, model.counts), model.weights, model.short) if more else model


def _page_units(pages: DataFrame) -> DataFrame:
    """The sentences of each page by itself, with book_id, page_num, script, row (one for each row of pages) and first (the page's first piece).

    The last piece of a page has null line_pos and end_char: what no end closes, empty if nothing is left.
    """
    running = cut(streams(page_lines(pages)).withColumn("row", F.monotonically_increasing_id()))
    kinds = ", ".join(f"{n} {running.schema[n].dataType.simpleString()}" for n in ("record_id", "book_id", "page_num"))
    model, others = learn(running)
    running = with_counts(running, model, others)
    model = trained(running, model)
    sent = running.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, numbers, lines, ends, texts, firsts = [], [], [], [], [], []
            more = b.column(b.schema.get_field_index("more")).to_pylist()
            for row, s, script in _streams(b):
                found = decode(s, script, _own(sent.value, more[row]))
                begin, first = 0, True
                for n, end in enumerate([*found, None]):
                    text = s.text[begin:end].strip()
                    if text or (end is None and not first):
                        line, at = s.place(end) if end is not None else (None, None)
                        rows.append(row)
                        numbers.append(n)
                        lines.append(line)
                        ends.append(at)
                        texts.append(_glue(script).join(text.split("\n")))
                        firsts.append(first)
                        first = False
                    begin = end
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k).take(at) for k in (0, 1, 2, 3, 8)), pa.array(firsts, pa.bool_()), pa.array(numbers, pa.int32()), pa.array(lines, pa.int32()), pa.array(ends, pa.int32()), pa.array(texts, pa.string())],
                names=["record_id", "book_id", "page_num", "script", "row", "first", "sentence_no", "line_pos", "end_char", "sentence"],
            )

    return running.mapInArrow(run, f"{kinds}, script string, row bigint, first boolean, sentence_no int, line_pos int, end_char int, sentence string")


def _glue(script: str) -> str:
    return "" if script in ("ja", "zh", "th") else " "


def _joined(script: str, parts: list[str]) -> str:
    """Parts of a sentence from consecutive pages; a word broken at the end of a page goes on as at the end of a line."""
    out = ""
    for t in parts:
        glue = "" if not out or (out[-1] in _HYPHENS and out[-2:-1].isalpha()) else _glue(script)
        out += glue + t
    return out


def _chains(places: DataFrame, chosen: DataFrame) -> DataFrame:
    """(book_id, page_num, start): for each page of a book the page where the piece begins that is open at its end.

    A page that ends no sentence, or has no running text, carries on what the page before leaves open. Pointers are doubled, so that no book is ordered in one task.
    """
    nodes = cut(places.join(chosen.select("book_id", "page_num", "first"), ["book_id", "page_num"], "left").select("book_id", "page_num", F.coalesce("first", F.lit(True)).alias("passing")))
    before = nodes.select("book_id", (F.col("page_num") + 1).alias("page_num"))
    links = cut(nodes.where("passing").join(before, ["book_id", "page_num"], "left_semi").select("book_id", "page_num", (F.col("page_num") - 1).alias("to")))
    while True:
        on = links.select("book_id", F.col("page_num").alias("to"), F.col("to").alias("further"))
        links = cut(links.join(on, ["book_id", "to"], "left").select("book_id", "page_num", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")))
        if links.where("moved").isEmpty():
            break
        links = links.drop("moved")
    return nodes.join(links.drop("moved"), ["book_id", "page_num"], "left").select("book_id", "page_num", F.coalesce("to", "page_num").alias("start"))


def _whole(script_parts: list[dict], heads: list[dict]) -> Iterator[dict]:
    """Sentences of one chain: each head with the open parts before it that are of its script; parts that no head takes stand together."""
    parts = sorted(script_parts, key=lambda m: m["page_num"])
    used = len(parts)
    for h in heads:
        k = len(parts)
        while k and parts[k - 1]["script"] == h["script"]:
            k -= 1
        used = min(used, k)
        yield h | {"sentence": _joined(h["script"], [m["sentence"] for m in parts[k:]] + [h["sentence"]])}
    run: list[dict] = []
    for m in parts[:used]:
        if run and run[-1]["script"] != m["script"]:
            yield run[-1] | {"sentence": _joined(run[-1]["script"], [x["sentence"] for x in run])}
            run = []
        run.append(m)
    if run:
        yield run[-1] | {"sentence": _joined(run[-1]["script"], [x["sentence"] for x in run])}


def sentence_units(pages: DataFrame) -> DataFrame:
    """(record_id, sentence_no, line_pos, end_char, sentence): every sentence of running text with the place where it ends.

    A sentence that runs over pages comes out once, whole, with the record where it ends; pages without running text are passed over, a missing page_num or another script
    breaks it off. What nothing closes has null line_pos and end_char. Of several scans of a page the one with the highest record_id goes on; another scan's open part stands by itself
    where it differs. Line breaks become spaces, nothing in scripts without spaces between words. The defined cases are those of `sentence_ends`.
    """
    units = cut(_page_units(pages))
    out = ["record_id", "sentence_no", "line_pos", "end_char", "sentence"]
    numbered = units.where("book_id is not null and page_num is not null")
    ends_open = numbered.where("line_pos is null")
    scan = F.max(F.struct("record_id", "row", "sentence", "first")).alias("c")
    chosen = cut(ends_open.groupBy("book_id", "page_num").agg(scan).select("book_id", "page_num", "c.row", "c.first", F.col("c.sentence").alias("going_on")))
    places = pages.where("book_id is not null and page_num is not null").select("book_id", "page_num").distinct()
    starts = cut(_chains(places, chosen))
    opens = ends_open.join(chosen.select("book_id", "page_num", F.col("row").alias("taken"), "going_on"), ["book_id", "page_num"])
    parts = opens.where("row = taken and sentence <> ''").join(starts, ["book_id", "page_num"])
    others = opens.where("row <> taken and sentence <> '' and sentence <> going_on")
    before = starts.select("book_id", (F.col("page_num") + 1).alias("page_num"), "start")
    heads = numbered.where("first and line_pos is not null").join(before, ["book_id", "page_num"], "left")
    member = F.struct("page_num", "script", *out)
    members = parts.select("book_id", "start", member.alias("m")).unionByName(heads.where("start is not null").select("book_id", "start", member.alias("m")))
    chains = members.groupBy("book_id", "start").agg(F.collect_list("m").alias("ms")).select("ms")
    made = units.select(*out).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kind = b.schema.field(0).type.value_type
            names = pa.schema([kind.field(kind.get_field_index(n)) for n in out])
            rows = []
            for ms in b.column(0).to_pylist():
                rows += _whole([m for m in ms if m["line_pos"] is None], [m for m in ms if m["line_pos"] is not None])
            yield pa.RecordBatch.from_pylist([{n: r[n] for n in out} for r in rows], schema=names)

    whole = chains.mapInArrow(run, made)
    inner = units.where("line_pos is not null and not (first and book_id is not null and page_num is not null)")
    lone = units.where("line_pos is null and sentence <> '' and (book_id is null or page_num is null)")
    rest = [x.select(*out) for x in (inner, lone, others, heads.where("start is null"))]
    for x in rest:
        whole = whole.unionByName(x)
    return whole


def sentence_ends(pages: DataFrame) -> DataFrame:
    """(record_id, line_pos, end_char): each place where a sentence of running text ends; end_char counts the characters of the line's text up to and with its last one.

    pages needs record_id, book_id, page_num, lines; other columns are ignored. Pages without lines, null lines and texts, headers, notices, page numbers, headings, lists,
    tables and junk end no sentence. Repeated rows with one record_id give the same places for each.
    """
    return _page_units(pages).where("line_pos is not null").select("record_id", "line_pos", "end_char")
