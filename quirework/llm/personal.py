"""Personal information in free text: places, kinds, and the text with typed placeholders instead.

Numbers, addresses and mail boxes are found by their notations. Names are found by what the corpus tells about its terms: pairs of neighbouring
capitalised words are counted over all documents; how many bits the beginnings and endings of a word, and each of its own uses, reveal about its standing
beside a known given name gives every word a disclosure score, and words that mostly stand beside such surnames are given names themselves, also if no
list has them; this goes on until no given name comes or goes. A place is a name when the terms in it disclose more than a threshold; sanitising also removes
terms that disclose more than a higher one where they stand alone.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import ChainMap, Counter
from collections.abc import Container, Iterable, Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import cut
from . import lookup

KINDS = ("NAME", "EMAIL", "PHONE", "ID", "ADDRESS")

#: Bits by which a word must favour a surname: behind an initial, and beside a known given name, which by itself tells much.
SURNAME_BITS, BESIDE_BITS = 3.0, -1.0
#: The same for words from which given names are learnt.
LEARN_BITS = 4.5
#: Bits by which a word that stands alone discloses a person, so that sanitising removes it too.
ALONE_BITS = 6.0
#: Share of a surname's uses that stand beside a given name, and of another word's; what each use of a word tells follows from them. Bound of what all uses together tell.
SURNAME_USES, OTHER_USES, MOST_BITS = 0.5, 0.01, 12.0
#: A word is a given name if it stands beside at least so many different surnames, and in at least this share of its uses beside one.
GIVEN_TIMES = 2
GIVEN_SHARE = 0.4
#: Rounds of learning at most; it ends when a round changes no given name.
ROUNDS = 12
#: A word is a town if it follows a street at least so often.
TOWN_TIMES = 2
#: Word ends are counted in so many bins, which bounds the model that is sent to all tasks (four bytes each).
BINS = 1 << 20
#: At most so many terms (given names, words that the ends misjudge, towns) are sent to all tasks, most frequent first; texts get the rest that they ask for by a join.
MAX_TERMS = 100_000
FLUSH = 200_000

# Words that are never part of a name though they stand before one, and particles that are.
_TITLES = frozenset(
    "mr mrs ms miss dr prof sir lady mx herr herrn frau dear to as the our from by for with yours and cher chère mme mlle m monsieur madame estimado estimada señor señora sr sra don doña "
    "sehr geehrte geehrter an уважаемый уважаемая г г-н г-жа том note reader tel card in of or flat apt apartment unit suite room floor street road lane der die das le la les el los las ein eine un une am im".split()
)
_PARTICLES = r"(?i:van der|van den|von der|van|von|de la|de|del|du|di|da|zu|ter|ten)"

_SEP = r"(?:[   ]+|[ \t]*\n[ \t>]*)"
_UP = "A-ZÀ-ÖØ-ÞŁŠŽА-ЯЁΆΈ-ΏΑ-Ω"
_CAP = rf"[{_UP}][^\W\d_]+(?:[-'’][^\W\d_]+)*"
_TOKEN = re.compile(r"(?<![\w@.+-])" + _CAP + r"(?![\w@])")
_INITIAL = re.compile(rf"(?<![\w.])[{_UP}]\.(?=\s)")
_AFTER = re.compile(rf"(?:{_SEP}[{_UP}]\.){{0,2}}(?:{_SEP}{_PARTICLES})?{_SEP}({_CAP})")
_AFTER_INITIAL = re.compile(rf"[{_UP}]\.(?:{_SEP}?[{_UP}]\.)?(?:{_SEP}{_PARTICLES})?{_SEP}({_CAP})")
_BEFORE = re.compile(rf"(?:(?<!\w){_PARTICLES}{_SEP})?(?<![\w.@-])({_CAP})(,{_SEP}|{_SEP})\Z")
_PARTNER = re.compile(rf"(?<![^\W\d_])({_CAP})")
_MIDDLE = re.compile(rf"(?:{_SEP}[{_UP}]\.(?!\w))?")

# ------------------------------------------------------------------------------------------------ notations
_WIDE = {0xFF10 + i: 0x30 + i for i in range(10)} | {0xFF0D: 0x2D, 0xFF0B: 0x2B, 0xFF20: 0x40, 0xFF0E: 0x2E, 0xFF08: 0x28, 0xFF09: 0x29, 0x3000: 0x20, 0xA0: 0x20, 0x202F: 0x20, 0x2010: 0x2D, 0x2011: 0x2D, 0x2013: 0x2D}
_WIDE_SIGNS = re.compile("[" + "".join(map(chr, _WIDE)) + "]")
_DOT = r"(?:\.|[ \n]\.[ \n]| ?[\[({]\.[\])}] ?|\s(?:dot|DOT|Dot)\s| ?[\[({](?:dot|DOT)[\])}] ?|\.\n(?=(?:example|test|invalid|com|org|net)\b)|\n\.)"
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
_LOCAL = r"(?<![A-Za-z0-9._+-])[A-Za-z0-9][A-Za-z0-9._+-]*"
_EMAIL = re.compile(rf"{_LOCAL}(?:\s?@\s?{_LABEL}(?:{_DOT}{_LABEL})*{_DOT}[A-Za-z]{{2,}}|\s?[\[({{]\s?(?:at|AT|@)\s?[\])}}]\s?{_LABEL}(?:{_DOT}{_LABEL})*{_DOT}[A-Za-z]{{2,}}|\s(?:at|AT)\s{_LABEL}(?:{_DOT}{_LABEL})*\s(?:dot|DOT)\s[A-Za-z]{{2,}})(?![A-Za-z0-9])")
#: A text without any of these has no e-mail address.
_AT = ("@", "(at", "[at", "{at", "( at", "[ at", "{ at", "(AT", "[AT", "{AT", "( AT", "[ AT", " dot ", "\ndot ", " dot\n", " DOT ", "\nDOT ", " DOT\n")

_S = r"[ \n]"
_EXT = r"(?:,?\s?(?:ext\.?|x|доб\.|poste|Durchwahl)\s?\d{1,5})?"
_PHONES = re.compile(
    r"(?<![A-Za-z0-9.,/+-])(?:"
    + "|".join(
        (
            rf"(?:\+|00){_S}?\d{{1,3}}[ .\n-]?\(?0?\)?[ .\n-]?(?:\(?\d{{1,5}}\)?[ .\n/-]?){{2,6}}\d",
            rf"(?:1[ .-])?\(?[2-9]\d\d\)?(?:[ .\n-]|(?<=\d))\n?\d{{3}}[ .\n-]\d{{4}}",
            r"[2-9]\d{9}",
            rf"\(0\d{{2,4}}\){_S}\d{{3}}[ \n-]?\d{{3,5}}(?:-\d{{1,4}})?",
            rf"\(?0\d{{2,4}}\)?[ /\n]\d{{4,6}}[ \n-]\d{{1,4}}",
            rf"0\d{{2,4}}[ /\n-]\d{{3}}[ \n-]?\d{{3,5}}(?:-\d{{1,4}})?",
            rf"0\d(?:[ .\n]\d\d){{4}}",
            rf"[0-9][ -]?\(?\d{{3}}\)?[ \n-]\d{{3}}[ -]\d\d[ -]\d\d",
            r"0\d{1,3}[-\n ]\d{3,4}[-\n ]\d{4}",
            r"[2-9]\d\d-\d{4}",
        )
    )
    + rf"){_EXT}(?![A-Za-z0-9/]|[.,-]\d)"
)
_IDS = re.compile(
    r"(?<![A-Za-z0-9.,/+-])(?:"
    + "|".join(
        (
            rf"[A-Z]{{2}}\d\d(?:{_S}?[A-Z0-9]{{4}}){{3,7}}(?:{_S}?[A-Z0-9]{{1,3}})?",
            rf"\d{{4}}(?:[ \n-]\d{{4}}){{3}}",
            rf"\d{{3}}-\n?\d\d-\n?\d{{4}}",
            rf"\d{{3}}{_S}\d\d{_S}\d{{4}}",
            rf"[A-Z]{{2}}{_S}?\d\d{_S}?\d\d{_S}?\d\d{_S}?[A-D]",
            r"[A-Z]{2}\d{7}",
            r"[XYZ]\d{7,8}[A-Z]",
            r"\d{8}[A-Z]",
            r"\d{6}-\n?\d{4}",
        )
    )
    + r")(?![A-Za-z0-9/]|[-]\d)"
)
_NUMBERS = re.compile(r"\d(?:[ ().\n/-]{0,3}\d){6}|X\d{7}|[A-Z]{2}[ \n]?\d\d[ \n]?\d\d")

_STREET = r"(?:Terrace|Close|Road|Rd\.?|Row|Lane|Ln\.?|Street|St\.?|Avenue|Ave\.?|Hill|Way|Drive|Dr\.|Court|Ct\.|Place|Square|Sq\.|Gardens|Crescent|Walk|Mews)"
_STREETS = re.compile(rf"(?<=[\w’'][ \n])(?:{_STREET}|TERRACE|CLOSE|ROAD|RD\\.?|ROW|LANE|STREET|ST\\.?|AVENUE|AVE\\.?|HILL)(?!\w)".replace("\\\\", "\\"))
_UNIT = r"(?:Flat|Apt\.?|Apartment|Unit|Suite|Room)\s\w{1,4}"
_BEFORE_STREET = re.compile(rf"(?<![\w./-])(?:{_UNIT},?\s)?\d{{1,4}}[a-z]?,?\s(?:[NSEW]\.\s)?(?:[A-Z][\w]*(?:['’]s)?\s){{1,3}}\Z")
_PLACE = r"[A-ZÀ-ÖØ-Þ][\w]+(?:-[\w]+)*"
_AFTER_STREET = re.compile(rf"(?:,\s{_UNIT})?(?:(?P<sep>,\s|\s)(?P<town>{_PLACE}))?")
_POSTCODE = re.compile(r",?\s(?:[A-Z]{1,2}\d[A-Z\d]?\s\d[A-Z]{2}|[A-Z]{2}\s\d{5}|\d{5})(?!\w)")
_TOWNED = rf"(?:,\s\d{{5}}\s{_PLACE})?"
_ADDRESSES = {
    "de": (re.compile(r"(?:str\.|straße|strasse|weg|gasse|platz|allee|ufer|damm)\s\d"), re.compile(rf"(?<!\w)[A-ZÄÖÜ]\w*(?:str\.|straße|strasse|weg|gasse|platz|allee|ufer|damm)\s\d{{1,4}}(?:\s?[a-z](?!\w))?{_TOWNED}")),
    "de, with a preposition": (
        re.compile(r",\s\d{5}\s"),
        re.compile(rf"(?<!\w)(?:Am|Im|An de[rnm]|Auf de[rnm]|In de[rnm]|Zum|Zur|Unter de[rnm]|Hinter de[rnm]|Vor de[rnm])\s(?:[A-ZÄÖÜ]\w+\s){{1,2}}\d{{1,4}}(?:\s?[a-z](?!\w))?,\s\d{{5}}\s{_PLACE}"),
    ),
    "fr": (re.compile(r"\d,?\s(?:bis|ter|rue|impasse|avenue|av\.|quai|place|chemin|boulevard|bd|allée)"), re.compile(rf"(?<!\w)\d{{1,4}}(?:\s(?:bis|ter))?,?\s(?:rue|impasse|avenue|av\.|quai|place|chemin|boulevard|bd|allée)\s(?:de\sla\s|de\sl['’]|d['’]|des\s|du\s|de\s)?{_PLACE}{_TOWNED}")),
    "es": (re.compile(r"Calle|C/|Plaza|Avda|Avenida|Paseo|Camino"), re.compile(rf"(?<!\w)(?:Calle|C/|Plaza|Avda\.?|Avenida|Paseo|Camino)\s(?:del?\s)?(?:la\s|los\s|las\s)?{_PLACE}(?:\s{_PLACE})?,\s\d{{1,4}}(?:,\s\d{{1,2}}\.?[ºª]\s?\w?(?!\w))?{_TOWNED}")),
    "ru": (re.compile(r"ул\."), re.compile(rf"ул\.\s[А-ЯЁ]\w+(?:,)?\sд\.\s\d{{1,4}}\w?(?:,\sкв\.\s\d{{1,4}})?(?:,\s(?:\d{{5,6}}\s)?(?:г\.\s)?{_PLACE}(?=\s*(?:\n|\Z)))?")),
}


def _streets(t: str) -> Iterator[tuple[int, int]]:
    """(start, end of the street) of English street addresses."""
    for m in _STREETS.finditer(t):
        lead = _BEFORE_STREET.search(t, max(0, m.start() - 70), m.start())
        if not lead or re.search(r"(?i:\b(?:the|a|an|of|in)\s)", lead[0]) or t[max(0, lead.start() - 4) : lead.start()].endswith(("No. ", "No.\n", "Nr. ")):
            continue
        yield lead.start(), m.end()


def _behind_streets(t: str) -> Iterator[re.Match]:
    return (m for _, end in _streets(t) if (m := _AFTER_STREET.match(t, end)))


def _names_of_towns(t: str) -> Iterator[str]:
    return (m["town"] for m in _behind_streets(t) if m["town"] and m["sep"][0] == ",")


def _narrow(text: str) -> str:
    """A text with wide digits and signs made narrow, one for one."""
    return text if text.isascii() or not _WIDE_SIGNS.search(text) else text.translate(_WIDE)


# ---------------------------------------------------------------------------------------------------- terms
def _ends(word: str) -> list[str]:
    """The beginnings and endings of a word, of each part if it is hyphenated."""
    out = []
    for part in re.split(r"[-'’]", word):
        if len(part) > 2:
            w = f"^{part}$"
            out += [w[:4], w[:5], w[-4:], w[-5:]]
    return out


def _counts(texts: Iterable[str | None]) -> Counter:
    """(what, a, b) -> times: 'word' a; 'pair' a before b, with what may stand between a given name and a surname; 'turned' b, a; 'town' a."""
    out: Counter = Counter()
    for t in texts:
        if not t:
            continue
        words = list(_TOKEN.finditer(t))
        for m in words:
            w = m[0].casefold()
            out["word", w, ""] += 1
            if w not in _TITLES and len(w) > 2:
                after = _AFTER.match(t, m.end())
                if after and after[1][0].isupper() and after[1].casefold() not in _TITLES:
                    out["pair", w, after[1].casefold()] += 1
                if t[m.end() : m.end() + 1] == ",":
                    nxt = _TOKEN.match(t, m.end() + 2)
                    if nxt and nxt[0].casefold() not in _TITLES:
                        out["turned", nxt[0].casefold(), w] += 1
        if words:
            for town in _names_of_towns(t):
                out["town", town, ""] += 1
    return out


def _bins(word: str) -> list[int]:
    return [zlib.crc32(e.encode()) % BINS for e in _ends(word)]


def _level(bits: float) -> int:
    """0: no surname, 1: one beside a given name, 2: one behind an initial, 3: disclosing when alone."""
    return (bits >= BESIDE_BITS) + (bits >= SURNAME_BITS) + (bits >= ALONE_BITS)


@dataclass
class Terms:
    """What the corpus tells: bits of word ends by bin, given names, levels of words whose uses overrule their ends, towns."""

    bits: np.ndarray
    given: Container[str] = frozenset()
    own: Mapping[str, int] = field(default_factory=dict)
    towns: Container[str] = frozenset()

    def ends_bits(self, word: str) -> float:
        """Bits of a word's ends; of a hyphenated word the least of its parts."""
        parts = [p for p in re.split(r"[-'’]", word) if len(p) > 2]
        return min((float(sum(self.bits[g] for g in _bins(p))) for p in parts), default=-99.0)

    def level(self, word: str) -> int:
        w = word.casefold()
        if w in _TITLES or w in self.given or len(w) < 3:
            return 0
        known = self.own.get(w)
        return _level(self.ends_bits(w)) if known is None else known

    def with_more(self, more: list[dict]) -> Terms:
        """These terms and others, as a row of `with_terms` has them."""
        if not more:
            return self
        given = frozenset(m["t"] for m in more if m["k"] == "given")
        towns = frozenset(m["t"] for m in more if m["k"] == "town")
        return Terms(self.bits, _Either(self.given, given), ChainMap({m["t"]: m["v"] for m in more if m["k"] == "word"}, self.own), _Either(self.towns, towns))


@dataclass
class _Either:
    one: Container[str]
    other: Container[str]

    def __contains__(self, x: object) -> bool:
        return x in self.other or x in self.one


def learn(docs: DataFrame, given_names: DataFrame, text: str = "text", given: str = "given_name") -> tuple[Terms, DataFrame | None]:
    """The terms of all documents, with at most MAX_TERMS sent, and a table (k, t, v) of all others, if there are any. Tasks count before the shuffle.

    Each round weighs every word's share of uses beside the given names known so far against its share of uses behind no capitalised word at all, so that surnames beside given
    names that are not known yet tell neither for nor against; the weights are shares, so that the number of different words does not matter.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            keys = list(seen)
            b = pa.RecordBatch.from_pydict({"what": pa.array([k[0] for k in keys], pa.string()), "a": pa.array([k[1] for k in keys], pa.string()), "b": pa.array([k[2] for k in keys], pa.string()), "n": pa.array(list(seen.values()), pa.int64())})
            seen.clear()
            return b

        for b in batches:
            for k in range(0, b.num_rows, 500):
                seen.update(_counts(b.column(0).slice(k, 500).to_pylist()))
                if len(seen) > FLUSH:
                    yield out()
        yield out()

    counts = docs.select(F.col(text).cast("string")).mapInArrow(count, "what string, a string, b string, n bigint").groupBy("what", "a", "b").agg(F.sum("n").alias("n"))
    counts = cut(counts)
    pairs = cut(counts.where("what in ('pair', 'turned') and length(b) > 2").groupBy("a", "b").agg(F.sum("n").alias("n")))
    behind = pairs.groupBy("b").agg(F.sum("n").alias("behind"))
    words = counts.where("what = 'word' and length(a) > 2").where(~F.col("a").isin(*sorted(_TITLES))).select(F.col("a").alias("w"), "n")
    words = cut(words.join(behind, F.col("w") == F.col("b"), "left").select("w", "n", F.coalesce("behind", F.lit(0)).alias("behind")))

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([(x or "").strip().casefold() for x in b.column(0).to_pylist()], pa.string())], names=["a"])

    names = listed = cut(given_names.select(F.col(given).cast("string")).mapInArrow(folded, "a string").where("a <> ''").distinct())
    for _ in range(ROUNDS):
        bits, scored = _scored(words, pairs, names)
        learnt = cut(listed.union(_given_names(words, pairs, scored)).distinct())
        moved = learnt.join(names, "a", "left_anti").select("a").union(names.join(learnt, "a", "left_anti").select("a")).limit(1).count()
        if not moved:
            break
        names = learnt
    else:
        bits, scored = _scored(words, pairs, names)
    uses = names.join(words, F.col("a") == F.col("w"), "left").select(F.lit("given").alias("k"), F.col("a").alias("t"), F.lit(1).alias("v"), F.coalesce("n", F.lit(0)).alias("n"))
    own = scored.where("level <> ends_level").select(F.lit("word").alias("k"), F.col("w").alias("t"), F.col("level").alias("v"), "n")
    towns = counts.where(f"what = 'town' and n >= {TOWN_TIMES}").select(F.lit("town").alias("k"), F.col("a").alias("t"), F.lit(1).alias("v"), "n")
    table = cut(uses.unionByName(own).unionByName(towns))
    rows, others = lookup.divided(table, MAX_TERMS)
    of = lambda k: frozenset(r.t for r in rows if r.k == k)
    return Terms(bits, of("given"), {r.t: r.v for r in rows if r.k == "word"}, of("town")), others


def _scored(words: DataFrame, pairs: DataFrame, names: DataFrame) -> tuple[np.ndarray, DataFrame]:
    """The bits of word ends by bin, and (w, n, bits, ends_level, level) of all words that are no given names."""
    beside = pairs.join(names, "a", "left_semi").groupBy("b").agg(F.sum("n").alias("p"))
    typed = words.join(names, F.col("w") == F.col("a"), "left_anti").join(beside, F.col("w") == F.col("b"), "left")
    typed = cut(typed.select("w", "n", "behind", F.least("n", F.coalesce("p", F.lit(0))).alias("p")))

    def ballots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # shares are counted in thousandths: whole numbers add up alike in any order
        yes, no = Counter(), Counter()
        for b in batches:
            for w, n, behind, p in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for g in set(_bins(w)):
                    yes[g] += 1000 * p // n
                    no[g] += 1000 * max(0, n - behind) // n
        keys = list(yes)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([yes[k] for k in keys], pa.int64()), pa.array([no[k] for k in keys], pa.int64())], names=["g", "yes", "no"])

    votes = typed.mapInArrow(ballots, "g int, yes bigint, no bigint").groupBy("g").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).toArrow()
    at = votes.column("g").to_numpy()
    yes, no = np.zeros(BINS), np.zeros(BINS)
    yes[at], no[at] = votes.column("yes").to_numpy() / 1000, votes.column("no").to_numpy() / 1000
    bits = (np.log2((yes + 0.3) / (yes.sum() + 1)) - np.log2((no + 0.3) / (no.sum() + 1))).astype(np.float32)
    sent = typed.sparkSession.sparkContext.broadcast(bits)
    for_use, against = math.log2(SURNAME_USES / OTHER_USES), math.log2((1 - SURNAME_USES) / (1 - OTHER_USES))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(sent.value)
        for b in batches:
            ws, ns, _, ps = (c.to_pylist() for c in b.columns)
            ends = [terms.ends_bits(w) for w in ws]
            total = [e + max(-MOST_BITS, min(MOST_BITS, p * for_use + (n - p) * against)) for e, n, p in zip(ends, ns, ps, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(total, pa.float64()), pa.array([_level(x) for x in ends], pa.int32()), pa.array([_level(x) for x in total], pa.int32())],
                names=["w", "n", "bits", "ends_level", "level"],
            )

    return bits, typed.mapInArrow(score, "w string, n bigint, bits double, ends_level int, level int")


def _given_names(words: DataFrame, pairs: DataFrame, scored: DataFrame) -> DataFrame:
    """(a): words that mostly stand beside different words that disclose a surname, and disclose none themselves."""
    surnames = scored.where(F.col("bits") >= LEARN_BITS).select(F.col("w").alias("b"))
    beside = pairs.join(surnames, "b", "left_semi").groupBy("a").agg(F.sum("n").alias("p"), F.count("*").alias("partners"))
    found = beside.join(words.select(F.col("w").alias("a"), F.col("n").alias("uses")), "a").where((F.col("partners") >= GIVEN_TIMES) & (F.col("p") >= GIVEN_SHARE * F.col("uses")))
    return found.join(scored.where("level >= 2").select(F.col("w").alias("a")), "a", "left_anti").select("a")


def _asked(batch: pa.RecordBatch) -> Iterator[list[tuple[str, str]]]:
    """The terms that `find` may look up for a text."""
    for text in batch.column(1).to_pylist():
        t = _narrow(text) if text else None
        words = {m[0].casefold() for m in _TOKEN.finditer(t)} if t else set()
        # a capitalised word behind another may be more than a token
        words |= {m[1].casefold() for m in _PARTNER.finditer(t)} if t else set()
        yield [(k, w) for w in words for k in ("given", "word")] + [("town", m["town"]) for m in (_behind_streets(t) if words else ()) if m["town"]]


def with_terms(docs: DataFrame, key: str, text: str, others: DataFrame | None) -> DataFrame:
    """(key, text, more) of docs, where more holds those of `others` that stand in the text."""
    docs = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    if others is not None:
        docs = cut(docs.withColumn("row", F.monotonically_increasing_id()))
    return lookup.attached(docs, others, _asked).select("key", "text", "more")


# ----------------------------------------------------------------------------------------------------- places
def find(text: str, terms: Terms) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pieces of personal information in a text, in order, without overlap."""
    out: list[tuple[int, int, str]] = []
    t = _narrow(text)
    if any(x in t for x in _AT):
        out += [(m.start(), m.end(), "EMAIL") for m in _EMAIL.finditer(t)]
    if _NUMBERS.search(t):
        for rx, kind in ((_IDS, "ID"), (_PHONES, "PHONE")):
            for m in rx.finditer(t):
                before = t[max(0, m.start() - 12) : m.start()]
                if re.search(r"(?:ISBN|ISSN|MS|No\.|lot|vol\.|pp?\.)[\s:]*$", before) and not before.rstrip().endswith(("ID no.",)):
                    continue
                end = m.end()
                while t[end - 1] in " \n.-/(":
                    end -= 1
                out.append((m.start(), end, kind))
    for start, end in _streets(t):
        m = _AFTER_STREET.match(t, end)
        if t[end : end + 9].strip().startswith("edition"):
            continue
        if m:
            unit = re.match(rf",\s{_UNIT}", t[end : end + 20])
            stop = end + unit.end() if unit else end
            if m["town"] and m["town"] in terms.towns:
                stop = m.end("town")
                code = _POSTCODE.match(t, stop)
                stop = code.end() if code else stop
            else:
                code = _POSTCODE.match(t, stop)
                stop = code.end() if code else stop
            end = stop
        out.append((start, end, "ADDRESS"))
    for cue, rx in _ADDRESSES.values():
        if cue.search(t):
            out += [(m.start(), m.end(), "ADDRESS") for m in rx.finditer(t)]
    out += _names(t, terms)
    # of overlapping places the one that begins first wins, then the longer one
    rank = {"EMAIL": 0, "ADDRESS": 1, "ID": 2, "PHONE": 3, "NAME": 4}
    out.sort(key=lambda x: (rank[x[2]], x[0], -x[1]))
    kept: list[tuple[int, int, str]] = []
    for p in out:
        if all(p[1] <= q[0] or p[0] >= q[1] for q in kept):
            kept.append(p)
    return sorted(kept)


def _names(t: str, terms: Terms) -> list[tuple[int, int, str]]:
    out, last = [], 0
    marks = [m for m in _TOKEN.finditer(t) if m[0].casefold() in terms.given]
    marks += [m for m in _INITIAL.finditer(t)]
    marks.sort(key=lambda m: m.start())
    for m in marks:
        if m.start() < last:
            continue
        initial = m[0].endswith(".")
        after = (_AFTER_INITIAL.match(t, m.start()) if initial else _AFTER.match(t, m.end()))
        if after and after[1][0].isupper() and terms.level(after[1]) >= (2 if initial else 1):
            last = after.end()
            out.append((m.start(), last, "NAME"))
            continue
        if initial:
            continue
        low = max(last, m.start() - 60)
        before = _BEFORE.search(t, low, m.start())
        if before and before[1][0].isupper() and terms.level(before[1]) >= 1:
            last = m.end()
            if before[2][0] == ",":
                last = _MIDDLE.match(t, m.end()).end()
            out.append((before.start(), last, "NAME"))
    return out


def _alone(t: str, found: list[tuple[int, int, str]], terms: Terms) -> list[tuple[int, int, str]]:
    """Words outside the places found that disclose a person by themselves: given names, and words whose bits exceed ALONE_BITS."""
    out, k = [], 0
    for m in _TOKEN.finditer(t):
        while k < len(found) and found[k][1] <= m.start():
            k += 1
        if (k == len(found) or m.end() <= found[k][0]) and (m[0].casefold() in terms.given or terms.level(m[0]) >= 3):
            out.append((m.start(), m.end(), "NAME"))
    return out


def find_personal(docs: DataFrame, learnt: tuple[Terms, DataFrame | None], key: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """(key, places, text with placeholders if keep_text): one row per document; places is an array of (start_char, end_char, kind).

    In the text placeholders also stand for words that disclose a person by themselves, as a surname without its given name; they are no places.
    Characters are code points, counted from 0. Null and empty texts have no places and stay as they are; repeated rows give repeated rows; other columns are dropped.
    """
    terms, others = learnt
    sent = docs.sparkSession.sparkContext.broadcast(terms)
    kind = docs.schema[key].dataType.simpleString()
    place = pa.list_(pa.struct([("start_char", pa.int32()), ("end_char", pa.int32()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            places, clean = [], []
            for t, more in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                model = sent.value.with_more(more)
                found = find(t, model) if t else []
                places.append([{"start_char": s, "end_char": e, "kind": k} for s, e, k in found])
                if keep_text:
                    parts, at = [], 0
                    for s, e, k in sorted(found + _alone(t, found, model)) if t else []:
                        parts += [t[at:s], f"[{k}]"]
                        at = e
                    clean.append("".join([*parts, t[at:]]) if t is not None else None)
            columns = [b.column(0), pa.array(places, place)] + ([pa.array(clean, pa.string())] if keep_text else [])
            yield pa.RecordBatch.from_arrays(columns, names=["key", "places", "text"][: len(columns)])

    schema = f"key {kind}, places array<struct<start_char:int,end_char:int,kind:string>>" + (", text string" if keep_text else "")
    return with_terms(docs, key, text, others).mapInArrow(run, schema).withColumnRenamed("key", key)


def places(docs: DataFrame, given_names: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start_char, end_char, kind): a row for each piece of personal information."""
    found = find_personal(docs, learn(docs, given_names, text), key, text)
    return found.select(key, F.explode("places").alias("p")).select(key, "p.start_char", "p.end_char", "p.kind")


def sanitised(docs: DataFrame, given_names: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text): each text with [NAME], [EMAIL], [PHONE], [ID] or [ADDRESS] in place of personal information and of terms that disclose a person."""
    return find_personal(docs, learn(docs, given_names, text), key, text, keep_text=True).select(key, "text")
