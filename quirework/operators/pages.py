"""Which record of a page counts, and where a row stands in its book."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.lineage import cut


#: At most so many ids of outdated records are sent to all tasks; more are met in a join.
MAX_OUTDATED = 1_000_000


def latest(pages: DataFrame) -> DataFrame:
    """One record per (book_id, page_num): the last one ingested, of equals the one with the largest record_id.

    Most pages have one record, so the outdated ones are found, from ids alone, and left out; the nested records themselves are not shuffled unless very many are outdated.
    A null ingested_at counts as the earliest; null keys are keys like any other.
    """
    order = F.struct(F.coalesce("ingested_at", F.lit("0001-01-01").cast("timestamp_ntz")).alias("at"), "record_id")
    ids = pages.select("book_id", "page_num", "record_id", order.alias("o"))
    several = ids.groupBy(F.col("book_id").alias("b"), F.col("page_num").alias("p")).agg(F.max("o").alias("best"), F.count("*").alias("n")).where("n > 1")
    same_page = F.col("book_id").eqNullSafe(F.col("b")) & F.col("page_num").eqNullSafe(F.col("p"))
    outdated = cut(ids.join(several, same_page).where("o.record_id <> best.record_id").select("record_id").distinct())
    few = outdated.limit(MAX_OUTDATED + 1).count() <= MAX_OUTDATED
    return pages.join(F.broadcast(outdated) if few else outdated, "record_id", "left_anti")


def boxed_lines(lines: Column) -> Column:
    """The lines that have a box of four numbers; null lines and lines without a box cannot be placed."""
    return F.filter(F.coalesce(lines, F.array().cast("array<struct<line_id:string,bbox:array<int>,words:array<struct<text:string,bbox:array<int>,confidence:double>>,text:string>>")), lambda x: F.size(x["bbox"]) == 4)


def ordinal(df: DataFrame, group: str, *order: Column | str, name: str = "ordinal") -> DataFrame:
    """df with the 1-based place of each row in its group. No group has to fit one task.

    Rows are spread by ranges of (group, order), numbered inside each range, and moved by the number of the group's rows in earlier ranges.
    """
    keys = [F.col(group), *[F.col(c) if isinstance(c, str) else c for c in order]]
    ranged = cut(df.repartitionByRange(*keys).withColumn("__part", F.spark_partition_id()))
    sizes = ranged.groupBy(group, "__part").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(F.col(group).alias("__g"), F.col("__part").alias("__p"), before.alias("__before"))
    inside = F.row_number().over(Window.partitionBy(group, "__part").orderBy(*keys[1:]))
    placed = ranged.withColumn("__inside", inside).join(offsets, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__part") == F.col("__p")))
    return placed.withColumn(name, (F.col("__inside") + F.col("__before")).cast("int")).drop("__part", "__inside", "__g", "__p", "__before")
