"""Structured Streaming over arriving rows. Each job runs until its source is used up and returns the sink's table.

Aggregations run in append mode: a window is written once, when the watermark has passed it, and its state goes then;
rows later than that are dropped. The last windows stay open until later rows arrive.

A table that changes is merged when it is read. A micro-batch appends the rows that it changes, as a delta of their hash
bucket, `part=p/batch=n/kind=delta`; readers take the newest row of each key. Where a bucket's deltas outgrow a share of
its base, a new base is written beside them. So what a batch writes follows the batch, and what is read stays near the
table. A batch that runs again after a failure writes the same, and nothing is held in the driver, so a job goes on from
its folder. What lies before a bucket's last base may be deleted at any time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from ..folders import scratch
from ..operators import joins
from . import runs

#: Hash buckets of a table that micro-batches change, and the share of a bucket's base that its deltas may reach.
BUCKETS, SHARE = 16, 0.5
#: The state store that map state needs.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _append(df: DataFrame, at: str | None = None) -> DataFrame:
    at = at or scratch(df.sparkSession)
    df.writeStream.outputMode("append").option("checkpointLocation", f"{at}/check").trigger(availableNow=True).start(f"{at}/out", format="parquet").awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{at}/out")


def _layers(spark: SparkSession, at: str, schema: StructType, before: int | None = None) -> DataFrame:
    """The table's rows with part, batch and kind: of each bucket its last base and the deltas after it."""
    kept = StructType([*schema.fields]).add("part", "integer").add("batch", "long").add("kind", "string")
    try:
        held = spark.read.schema(kept).parquet(f"{at}/out")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        held = spark.createDataFrame([], kept)
    if before is not None:
        held = held.where(F.col("batch") < before)
    base = held.where("kind = 'base'").groupBy("part").agg(F.max("batch").alias("__base"))  # a row a bucket
    held = held.join(F.broadcast(base), "part", "left")
    after = F.col("batch") > F.coalesce("__base", F.lit(-1))
    return held.where(F.when(F.col("kind") == "base", F.col("batch") == F.col("__base")).otherwise(after)).drop("__base")


def read_merged(spark: SparkSession, at: str, schema: StructType, key: list[str], before: int | None = None, parts: list[int] | None = None) -> DataFrame:
    """The newest row of each key of the table in `at`, or what it was before a batch. parts: of these buckets only."""
    held = _layers(spark, at, schema, before)
    if parts is not None:
        held = held.where(F.col("part").isin(parts))
    newest = held.groupBy(*key).agg(F.max_by(F.struct(*schema.names), "batch").alias("__r"))
    return newest.select("__r.*")


def _merge(rows: DataFrame, at: str, key: list[str], schema: StructType, fold: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = BUCKETS, share: float = SHARE) -> DataFrame:
    """Fold each micro-batch into the table in `at`: fold(rows of the batch, rows of the same keys so far) gives the rows
    that change, one a key."""
    spark = rows.sparkSession
    part = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")

    def write(made: DataFrame, n: int, kind: str) -> None:
        made = made.select(*schema.names).withColumns({"part": part, "batch": F.lit(n).cast("long"), "kind": F.lit(kind)})
        made.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part", "batch", "kind").parquet(f"{at}/out")

    def run(batch: DataFrame, n: int) -> None:
        touched = [r["part"] for r in batch.select(part.alias("part")).distinct().collect()]  # as many as buckets at most
        if not touched:
            return
        old = read_merged(spark, at, schema, key, n, touched).join(batch.select(*key).distinct(), key, "left_semi")
        write(fold(batch, old), n, "delta")
        sizes = _layers(spark, at, schema, n + 1).where(F.col("part").isin(touched)).groupBy("part").agg(F.count_if(F.col("kind") == "delta").alias("d"), F.count_if(F.col("kind") == "base").alias("b"))
        grown = [r["part"] for r in sizes.where(F.col("d") > F.col("b") * share).collect()]
        if grown:
            write(read_merged(spark, at, schema, key, n + 1, grown), n, "base")

    rows.writeStream.outputMode("append").foreachBatch(run).option("checkpointLocation", f"{at}/check").trigger(availableNow=True).start().awaitTermination()
    return read_merged(spark, at, schema, key)


def stream_week_counts(events: DataFrame, iso: str, source: str, ts: str, late: str = "30 days", at: str | None = None) -> DataFrame:
    """Distinct (year, week) of each iso and source.

    A key passes once while the watermark is within `late` of it, so the state holds the keys of that time only, and
    what is written is one row a key. The few that pass again (a year's first and last week may bear one number) are made
    one by the count. Rows without a time, and rows later than the watermark, are dropped.
    """
    day = F.to_date(ts)
    keys = events.where(F.col(ts).isNotNull()).withWatermark(ts, late).select(F.col(iso).alias("iso"), F.col(source).alias("source"), ts, F.year(day).alias("year"), F.weekofyear(day).alias("week"))
    once = keys.dropDuplicatesWithinWatermark(["iso", "source", "year", "week"])
    seen = _append(once.select("iso", "source", "year", "week"), at)
    return seen.distinct().groupBy("iso", "source").agg(F.count("*").alias("weeks"))


def stream_data_blocks(rows: DataFrame, key: str, ts: str, gap_days: int = 14, late: str = "30 days", at: str | None = None) -> DataFrame:
    """Blocks of dates with steps of at most gap_days: session windows, whose gap is taken off the end again."""
    w = F.session_window(ts, f"{gap_days} days")
    x = rows.withWatermark(ts, late).groupBy(F.col(key).alias("iso"), w.alias("w")).agg(F.count("*").alias("n"))
    return _append(x.select("iso", F.to_date("w.start").alias("block_start"), F.date_sub(F.to_date("w.end"), gap_days).alias("block_end")), at)


def stream_weekly_totals(events: DataFrame, ts: str, value: str, late: str = "7 days", at: str | None = None) -> DataFrame:
    """Totals of Monday weeks (windows start on Thursdays, so four days on); rows later than `late` are dropped."""
    x = events.withWatermark(ts, late).groupBy(F.window(ts, "7 days", "7 days", "4 days").alias("w")).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return _append(x.select(F.to_date("w.start").alias("week_start"), "n", "total"), at)


class StopRule(StatefulProcessor):
    """State of a key: its runs of consecutive batches, by their first one. A run that closes a gap merges with its
    neighbours, so a key that came whole is one run, and state follows the gaps that are open, not the batches seen."""

    def __init__(self, threshold: float, n_low: int, min_batches: int, idle_ms: int | None):
        self.threshold, self.rule, self.idle_ms = threshold, (n_low, min_batches), idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getMapState("runs", "first long", "last long, prefix long, suffix long, starts array<long>, ends array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = {k[0]: runs.Run(k[0], v[0], v[1], v[2], list(zip(v[3], v[4], strict=True))) for k, v in self.runs.iterator()}
        before = {first: (r.last, tuple(r.streaks)) for first, r in held.items()}
        fresh = 0
        for part in rows:
            for b, y in zip(part["batch"].tolist(), part["found"].tolist(), strict=True):
                if not pd.isna(b):
                    fresh += runs.add(held, int(b), not pd.isna(y) and y < self.threshold, *self.rule)
        for first in before.keys() - held.keys():
            self.runs.removeKey((first,))
        for first, r in held.items():
            if before.get(first) != (r.last, tuple(r.streaks)):
                self.runs.updateValue((first,), (r.last, r.prefix, r.suffix, [s for s, _ in r.streaks], [e for _, e in r.streaks]))
        if self.idle_ms is not None:
            for t in self.handle.listTimers():
                self.handle.deleteTimer(t)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        if fresh:
            yield pd.DataFrame({"iso": [key[0]], "stop_batch": pd.array([runs.stop(held, *self.rule)], "Int64"), "seen": [sum(r.rows for r in held.values())]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.runs.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_stop_rule(batches: DataFrame, threshold: float, n_low: int, min_batches: int, at: str | None = None, idle_ms: int | None = None) -> DataFrame:
    """The first batch of each key (iso, batch, yield) after n_low low yields in a row, in order of batch.

    Rows may arrive in any order: an earlier batch may change the stop or undo it. Each change is written with the number
    of batches seen; the last one counts. A batch number that came before is left out, as are rows without one; a null
    yield isn't low. idle_ms: a key without rows for so long is forgotten, and starts anew if more come.
    """
    spark, name = batches.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)
    try:
        kind = batches.schema["iso"].dataType.simpleString()
        mode = "None" if idle_ms is None else "ProcessingTime"
        named = batches.select("iso", "batch", F.col("yield").alias("found"))  # Python's own words can't name columns there
        out = named.groupBy("iso").transformWithStateInPandas(StopRule(threshold, n_low, min_batches, idle_ms), f"iso {kind}, stop_batch long, seen long", "Append", mode)
        held = _append(out, at)
    finally:
        spark.conf.set(name, before)
    last = held.groupBy("iso").agg(F.max(F.struct("seen", "stop_batch")).alias("r"))
    return last.select("iso", F.col("r.stop_batch").alias("stop_batch")).where("stop_batch is not null")


def stream_refresh(rows: DataFrame, key: str, order: str, previous: DataFrame | None = None, at: str | None = None) -> DataFrame:
    """The latest row of each key, upserted by micro-batch, with the manual notes carried on.

    A micro-batch writes those of its rows that are newer than what the table holds. rows have a text column notes, made automatically; previous(key, notes) is where manual notes stand before the
    first batch, and the table itself afterwards. Rows with equal order are told apart by their content.
    """

    def fold(new: DataFrame, old: DataFrame) -> DataFrame:
        all_ = new.withColumn("__new", F.lit(True)).unionByName(old.withColumn("__new", F.lit(False)))
        plain = [c for c in rows.columns if c != "notes"]
        best = F.max_by(F.struct(*rows.columns, "__new"), F.struct(order, F.xxhash64(*plain), "__new"))
        last = all_.groupBy(key).agg(best.alias("r")).select("r.*").withColumnRenamed(key, "iso")
        notes = old.select(F.col(key).alias("iso"), "notes")
        if previous is not None:
            first = previous.select(F.col(key).alias("iso"), "notes").join(notes.select("iso"), "iso", "left_anti")
            notes = notes.unionByName(first)
        changed = joins.merge_manual_notes(last.where("__new").drop("__new"), notes).withColumnRenamed("iso", key)
        return changed.select(*rows.columns).subtract(old.select(*rows.columns))  # what came again as it was isn't written

    return _merge(rows, at or scratch(rows.sparkSession), [key], rows.schema, fold)
