"""Pages as they arrive: the per-page operators on a file stream, and the switch to arabic page numbers with one number of state per book."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import quality
from ..schema import PAGES


def page_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """A stream of corpus files (one page per line) that arrive in a folder."""
    return spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def quality_stream(pages: DataFrame) -> DataFrame:
    """(book_id, page_num, low_quality, alpha_ratio, garbage_ratio) of each page as it arrives; no state."""
    m = pages.select("book_id", "page_num", quality.metrics(F.col("lines")).alias("m"))
    return m.select("book_id", "page_num", quality.low_quality(F.col("m")).alias("low_quality"), "m.alpha_ratio", "m.garbage_ratio")


def first_arabic_stream(pages: DataFrame, switch_min: int = 10) -> DataFrame:
    """(book_id, switch_page): emitted whenever an earlier page of a book turns out to switch it to arabic numbers.

    The state of a book is the least such page so far, so pages may come in any order; a reader nulls roman numbers after the latest switch_page it has seen.
    """

    def update(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        least = state.get[0] if state.exists else None
        before = least
        for f in frames:
            if len(f):
                low = int(f.page_num.min())
                least = low if least is None else min(least, low)
        if least is not None:
            state.update((least,))
        if least != before:
            yield pd.DataFrame({"book_id": [key[0]], "switch_page": [least]})

    hits = pages.where((F.col("printed_page_kind") == "arabic") & (F.col("printed_page") >= switch_min)).select("book_id", "page_num")
    return hits.groupBy("book_id").applyInPandasWithState(update, "book_id string, switch_page int", "least int", "update", GroupStateTimeout.NoTimeout)
