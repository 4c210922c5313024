"""Encoding of a corpus with a public byte-level BPE through a table of distinct words, and decoding through a join.

A text is cut into words at places over which no piece of the tokenizer's own split can run, so that the ids of the words, one after
another, are the ids of the text. The words are counted over the whole corpus and each distinct one is encoded once. Ids go
back by position: the most frequent words, up to a fixed number, travel to all tasks; the rest is joined by word.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.lineage import cut

#: Default place of the vocabulary files; a parameter of every operator here.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")

#: Words that are sent to all tasks: of those up to so many characters at most so many, the most frequent ones. Bounds their size to 50 million characters.
HOT = ((64, 262_144), (4_096, 4_096), (65_536, 256))

#: A task hands on its counts after so many distinct words.
FLUSH = 500_000

# White space as the split has it (it differs from Python's \s).
_WS = "\t-\r \x85\xa0  -     　"
_ALNUM = r"[^\W_]+"
_OTHER = rf"(?:[^\w{_WS}]|_)"
#: Cuts between white space and what goes before, and between letters or digits and other signs, but never inside a possible contraction.
_WORDS = re.compile(rf"[{_WS}]*{_ALNUM}(?:'{_ALNUM})*|[{_WS}]*{_OTHER}*'{_ALNUM}(?:'{_ALNUM})*|[{_WS}]*{_OTHER}+|[{_WS}]+")
#: Cuts only before white space; right whatever Unicode version decides what is a letter.
_CHUNKS = re.compile(rf"[{_WS}]*[^{_WS}]+|[{_WS}]+")
#: Signs that are letters or digits in some Unicode versions only, or may become so.
_NEW = re.compile("[ᲉᲊꟋ-ꟍꟚ-Ƛ\U00010000-\U0010ffff]")

IDS = T.ArrayType(T.IntegerType(), False)


def split_words(text: str) -> list[str]:
    """The words of a text; joined they are the text."""
    return (_CHUNKS if _NEW.search(text) else _WORDS).findall(text)


def _encoder(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def word_table(docs: DataFrame, text: str = "text", vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.json") -> DataFrame:
    """(word, n, ids): every distinct word of all texts, how often it occurs, and its ids. Tasks count before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})
            seen.clear()
            return b

        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    seen.update(split_words(t))
                if len(seen) > FLUSH:
                    yield out()
        yield out()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _encoder(vocabulary)
        for b in batches:
            ids = [t.encode(w, add_special_tokens=False).ids for w in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"word": b.column(0), "n": b.column(1), "ids": pa.array(ids, pa.list_(pa.int32()))})

    counted = docs.select(F.col(text).cast("string")).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.mapInArrow(encode, "word string, n bigint, ids array<int>")


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.json", hot: tuple[tuple[int, int], ...] = HOT) -> DataFrame:
    """(key, ids): the ids of each text, without special tokens; their strings inside a text are ordinary text.

    Null and empty texts give an empty list, a null key stays null, repeated rows give repeated rows, other columns are dropped.
    hot bounds what is sent to all tasks; it changes the cost, never the result.
    """
    words = cut(word_table(docs, text, vocabulary))
    rows, longer = [], 0
    for chars, most in hot:
        tier = words.where((F.length("word") > longer) & (F.length("word") <= chars)).orderBy(F.desc("n"), "word").limit(most).select("word", "ids").toArrow()
        rows += zip(tier.column(0).to_pylist(), tier.column(1).to_pylist(), strict=True)
        longer = chars
    # ids travel as bytes: a text's ids are then one join of byte strings
    small = max((max(ids) for _, ids in rows if ids), default=0) < 1 << 16 and not words.where(F.array_max("ids") >= 1 << 16).limit(1).count()
    width = np.dtype("<u2" if small else "<i4")
    table = {w: np.array(ids, width).tobytes() for w, ids in rows}
    all_hot = len(table) == words.count()
    known = docs.sparkSession.sparkContext.broadcast(table)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.value.get
        for b in batches:
            buffers, missing = [], []
            for t in b.column(1).to_pylist():
                split = split_words(t) if t else []
                parts = list(map(get, split))
                gaps = []
                if None in parts:
                    at = 0
                    for i, p in enumerate(parts):
                        if p is None:
                            gaps.append({"at": at, "word": split[i]})
                            parts[i] = b""
                        else:
                            at += len(p)
                buffers.append(b"".join(parts))
                missing.append(gaps)
            if all_hot:
                yield pa.RecordBatch.from_arrays([b.column(0), _as_ids(buffers, width)], names=["key", "ids"])
            else:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(buffers, pa.binary()), pa.array(missing, pa.list_(pa.struct([("at", pa.int32()), ("word", pa.string())])))], names=["key", "packed", "missing"])

    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    if all_hot:
        return source.mapInArrow(look_up, f"key {kind}, ids array<int>").select(F.col("key").alias(key), "ids")

    # Words that did not travel are joined by word and put in where they stand. Texts are read through once; what is kept of them until then are their ids in two bytes each.
    part = cut(source.mapInArrow(look_up, f"key {kind}, packed binary, missing array<struct<at:int,word:string>>").withColumn("row", F.monotonically_increasing_id()))
    gaps = part.select("row", F.posexplode("missing").alias("i", "gap")).select("row", "i", "gap.at", "gap.word")
    filled = gaps.join(words.select("word", F.col("ids").alias("more")), "word").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("i", "at", "more"))).alias("gaps"))

    def weave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buffers = []
            for packed, gaps in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                parts, at = [], 0
                for g in gaps or ():
                    parts += [packed[at : g["at"]], np.array(g["more"], width).tobytes()]
                    at = g["at"]
                buffers.append(b"".join([*parts, packed[at:]]))
            yield pa.RecordBatch.from_arrays([b.column(0), _as_ids(buffers, width)], names=["key", "ids"])

    return part.join(filled, "row", "left").select("key", "packed", "gaps").mapInArrow(weave, f"key {kind}, ids array<int>").select(F.col("key").alias(key), "ids")


def _as_ids(buffers: list[bytes], width: np.dtype) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(x) // width.itemsize for x in buffers]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(buffers), width).astype(np.int32)))


def pieces(spark, vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """(id, piece): the vocabulary as a table of bytes; it has a fixed size."""
    lines = spark.read.text(f"file://{vocabulary}").where("value <> ''")
    part = F.split("value", " ")
    return lines.select(part[1].cast("int").alias("id"), F.unbase64(part[0]).alias("piece"))


def decode(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """(key, text): ids back to text by a join with the vocabulary, whose size is fixed and therefore broadcast.

    key must tell rows apart; of repeated rows one is kept. Null or empty ids give an empty text.
    """
    one = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids")).dropDuplicates(["key"])
    at = one.select("key", F.posexplode_outer("ids").alias("at", "id"))
    table = F.broadcast(pieces(encoded.sparkSession, vocabulary))
    joined = at.join(table, "id", "left").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", F.hex("piece").alias("h")))).alias("h"))
    text = F.decode(F.unhex(F.array_join(F.transform("h", lambda x: F.coalesce(x["h"], F.lit(""))), "")), "UTF-8")
    return joined.select(F.col("key").alias(key), text.alias("text"))
