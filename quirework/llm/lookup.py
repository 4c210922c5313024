"""Small tables for all tasks: the most frequent rows are sent, a row of data gets the others that it asks for by a join."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def divided(table: DataFrame, most: int) -> tuple[list[Row], DataFrame | None]:
    """The rows (k, t, v, n) of a table to be sent, at most `most` and the most frequent ones, and a table (k, t, v) of all others, if there are any. (k, t) must be unique."""
    rows = table.orderBy(F.desc("n"), "k", "t").limit(most + 1).collect()
    if len(rows) <= most:
        return rows, None
    least = rows[-1].n
    return [r for r in rows if r.n > least], table.where(F.col("n") <= least).select("k", "t", "v")


def attached(docs: DataFrame, others: DataFrame | None, asked: Callable[[pa.RecordBatch], Iterable[Iterable[tuple[str, str]]]]) -> DataFrame:
    """docs with `more`: array<struct<k, t, v>> of the rows of others that each row asks for; null if it asks for none or there are no others.

    asked gives the (k, t) of each row of a batch of docs. docs must have a column `row` that tells its rows apart, and must have its lineage cut.
    """
    if others is None:
        return docs.withColumn("more", F.lit(None).cast("array<struct<k:string,t:string,v:bigint>>"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, ks, ts = [], [], []
            for row, wanted in zip(b.column(b.schema.get_field_index("row")).to_pylist(), asked(b), strict=True):
                for k, t in set(wanted):
                    rows.append(row)
                    ks.append(k)
                    ts.append(t)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(ks, pa.string()), pa.array(ts, pa.string())], names=["row", "k", "t"])

    met = docs.mapInArrow(ask, "row bigint, k string, t string").join(others.withColumn("v", F.col("v").cast("bigint")), ["k", "t"])
    return docs.join(met.groupBy("row").agg(F.collect_list(F.struct("k", "t", "v")).alias("more")), "row", "left").select(*docs.columns, "more")
