"""Progress figures from work logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import joins, metrics
from .scan import ordered

# What counts as a tool call and as an addition.
TOOLS, ADDS = r"(?i)(WebSearch|WebFetch)", r"(?i)(added|new[^\n]*row|observations\.csv)"
YIELD = r"(?i)(\d+)\s*(?:successful queries)?\s*/\s*(\d+)"


def agent_status(logs: DataFrame, markers: tuple[str, ...] = ("INITIALIZATION", "INITIALIZED"), short: int = 10) -> DataFrame:
    """logs(iso, agent, content): initialized if all markers stand in a text of few lines, else completed."""
    marked = F.lit(True)
    for m in markers:
        marked = marked & F.col("content").contains(m)
    lines = F.size(F.split(F.trim("content"), "\n"))
    return logs.withColumn("status", F.when(marked & (lines <= short), "initialized").otherwise("completed"))


def execution_metrics(logs: DataFrame, tools: str = TOOLS, adds: str = ADDS) -> DataFrame:
    """Tool mentions, additions, additions per hundred mentions (0 without any) and minutes at 0.3 each."""
    n = lambda p: F.coalesce(F.sum(F.regexp_count("content", F.lit(p))), F.lit(0))
    x = logs.groupBy("iso").agg(n(tools).alias("queries"), n(adds).alias("additions"))
    return x.withColumns({"yield_pct": F.coalesce(F.try_divide(F.col("additions") * 100.0, "queries"), F.lit(0.0)), "minutes": F.floor(F.col("queries") * 3 / 10)})


def batch_yields(logs: DataFrame) -> DataFrame:
    """(iso, agent, batch, ok, asked, yield_pct) of each batch's last yield line.

    A line that names `BATCH b` opens batch b. Yields are spelled `rows: k/n` on a line of its own, `BATCH b YIELD: ...
    k/n queries ...` on the batch's line, or `... yield: ... (k successful queries / n total queries)`.
    """
    x = logs.select("iso", "agent", F.posexplode(F.split("content", "\n")).alias("line", "text"))
    b = F.regexp_extract("text", r"(?i)batch\s+(\d+)", 1).try_cast("int")
    x = x.withColumn("batch", F.last(b, ignorenulls=True).over(W.partitionBy("iso", "agent").orderBy("line").rowsBetween(W.unboundedPreceding, 0)))
    part = lambda i: F.regexp_extract("text", YIELD, i).try_cast("int")
    x = x.withColumns({"ok": part(1), "asked": part(2)})
    told = F.col("text").rlike(r"(?i)\b(quer|yield|rows?)") & (~F.col("text").rlike("(?i)batch") | F.col("text").rlike("(?i)yield:"))
    out = x.where(F.col("batch").isNotNull() & (F.col("asked") > 0) & told).groupBy("iso", "agent", "batch").agg(F.max_by("ok", "line").alias("ok"), F.max_by("asked", "line").alias("asked"))
    return out.withColumn("yield_pct", F.round(F.col("ok") * 100.0 / F.col("asked"), 1))


def stop_batches(batches: DataFrame, threshold: float, n_low: int, min_batches: int) -> DataFrame:
    """The first batch with n_low yields in a row below the threshold, at least min_batches in.

    A row ends such a streak if the last row that wasn't low stands n_low or more before it. A key may have any number of
    batches; a null yield isn't low.
    """
    held = ordered(batches.select("iso", "batch", "yield"), "iso", ["batch"]).numbered("k")
    high = F.when(F.coalesce(F.col("yield") >= threshold, F.lit(True)), F.col("k"))
    x = held.running("high", high, "max").done()
    stops = (F.col("k") - F.coalesce("high", F.lit(0)) >= n_low) & (F.col("k") >= min_batches)
    return x.where(stops).groupBy("iso").agg(F.min("batch").alias("stop_batch"))


def cumulative_yield(batches: DataFrame) -> DataFrame:
    """Running yield of each key's batches, of which it may have any number."""
    return ordered(batches, "iso", ["batch"]).running("total", F.col("yield")).done()


def checklist(
    files: DataFrame, logs: DataFrame, obs: DataFrame, src: DataFrame, places: DataFrame, previous: DataFrame,
    protocol: str = "search_protocol_", tools: str = TOOLS, adds: str = ADDS,
) -> DataFrame:
    """The progress row of each of the places(iso, country), with notes carried over from the previous one.

    files(iso, name, modified), as read_inventory lists them, tell the status, the last update, whether the audit is done
    and whether a file whose name starts with `protocol` is there; logs and tables tell the rest. A place without files
    has not started.
    """
    summary = metrics.observation_summary(obs).select("iso", "row_count", "date_range")
    agents = agent_status(logs).groupBy("iso").agg(F.count_distinct("agent").alias("agents"), F.max(F.when(F.col("status") == "completed", F.col("agent"))).alias("last_done"))
    held = files.groupBy("iso").agg(F.bool_or(F.col("name") == metrics.AUDIT).alias("audit"), F.bool_or(F.col("name").startswith(protocol)).alias("protocol"))
    out = places.select("iso", "country")
    for part in (
        metrics.status_from_files(files, summary), metrics.latest_update(files).withColumnRenamed("latest", "datetime"), held, summary,
        metrics.source_counts(src), execution_metrics(logs, tools, adds), agents,
    ):
        out = out.join(part, "iso", "left")
    out = out.na.fill(0, ["row_count", "sources", "queries", "agents", "yield_pct", "minutes"]).na.fill("NOT_STARTED", ["status"]).na.fill(False, ["audit", "protocol"])
    notes = S.compose_auto_notes(F.col("audit"), F.col("agents"), F.col("last_done"), F.col("row_count"), F.col("protocol"))
    out = out.withColumns({"priority": S.row_count_priority(F.col("row_count")), "notes": notes})
    return joins.merge_manual_notes(out, previous).select(
        "country", "iso", "status", "datetime", "sources", F.col("row_count").alias("observations"), "date_range", "priority", F.col("minutes").alias("execution_time"), "queries", F.round("yield_pct", 1).alias("yield_pct"), "notes"
    )
