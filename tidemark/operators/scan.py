"""Running values over a key's rows in order, dealt over all tasks however large a key is.

Rows are dealt by ranges of (key, order), so a key spans as many tasks as it needs. Each task numbers and sums its part of
a key; the parts' totals, a row for each key and range, are summed in order, and joined back as what came before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..folders import scratch

#: Ranges that are broadcast with what came before them (about 32 MB); more are joined by exchange.
FEW = 500_000


def cut(df: DataFrame) -> DataFrame:
    """df, written to the shared checkpoint folder, so that rows stay in the ranges that they were dealt to."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch(df.sparkSession))
    return df.checkpoint()


@dataclass
class Ordered:
    """Rows dealt and sorted by (key, order): rows has them with __part and __at, their place in it."""

    rows: DataFrame
    key: str

    def running(self, name: str, value: Column, kind: str = "sum") -> Ordered:
        """Adds a column: the sum or the greatest of value from the key's first row to this one; nulls don't count."""
        f = {"sum": F.sum, "max": F.max}[kind]
        local = W.partitionBy(self.key, "__part").orderBy("__at").rowsBetween(W.unboundedPreceding, 0)
        rows = self.rows.withColumn("__own", f(value).over(local))
        totals = self.rows.groupBy(F.col(self.key).alias("__key"), F.col("__part").alias("__range")).agg(f(value).alias("__total"))
        before = f("__total").over(W.partitionBy("__key").orderBy("__range").rowsBetween(W.unboundedPreceding, -1))
        before = cut(totals.select("__key", "__range", before.alias("__before")).where("__before is not null"))
        before = F.broadcast(before) if before.count() <= FEW else before
        rows = rows.join(before, F.col(self.key).eqNullSafe(F.col("__key")) & (F.col("__part") == F.col("__range")), "left")
        both = F.coalesce(F.col("__own") + F.col("__before"), "__own", "__before") if kind == "sum" else F.greatest("__own", "__before")
        return Ordered(rows.withColumn(name, both).drop("__own", "__before", "__key", "__range"), self.key)

    def numbered(self, name: str = "place") -> Ordered:
        """Adds the row's number in its key, from 1."""
        return self.running(name, F.lit(1).cast("long"))

    def done(self) -> DataFrame:
        return self.rows.drop("__part", "__at")


def ordered(df: DataFrame, key: str, order: list[str]) -> Ordered:
    """df dealt and sorted by (key, order), nulls first. Rows of equal key and order stay in some order, the same in all
    that is derived from it. df must not have columns __part or __at."""
    by = [key, *order]
    tied = df.withColumn("__at", F.monotonically_increasing_id())
    held = cut(tied.repartitionByRange(*by, "__at").sortWithinPartitions(*by, "__at").drop("__at"))
    at = F.monotonically_increasing_id()
    return Ordered(held.withColumn("__at", at).withColumn("__part", F.shiftright("__at", 33)), key)
