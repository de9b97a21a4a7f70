"""Per-place metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalars as S
from .scan import ordered

# The report that an audit leaves; logs whose changes count as an update; scores of reliability levels.
AUDIT = "quality_audit_report_agent_6.txt"
LOGS = [f"search_log_agent_{i}.txt" for i in range(1, 7)]
SCORES = {"Level_1": 4, "Level_2": 3, "Level_3": 2, "Level_4": 1}


def observation_summary(obs: DataFrame) -> DataFrame:
    y1, y2 = F.year("first_date"), F.year("last_date")
    x = obs.groupBy("iso").agg(F.count("*").alias("row_count"), F.min(F.least("tl", "tr")).alias("first_date"), F.max(F.greatest("tl", "tr")).alias("last_date"))
    return x.withColumn("date_range", F.when(y1 == y2, y1.cast("string")).otherwise(F.concat_ws("-", y1, y2)))


def source_counts(src: DataFrame) -> DataFrame:
    return src.groupBy("iso").agg(F.count("*").alias("sources"))


def case_totals(obs: DataFrame) -> DataFrame:
    n = lambda c: F.sum(F.coalesce(F.col(c).try_cast("long"), F.lit(0)))
    return obs.groupBy("iso").agg(n("scases").alias("total_cases"), n("deaths").alias("total_deaths"))


def peak_year(obs: DataFrame) -> DataFrame:
    """Year with most cases; the later one of equals."""
    y = obs.where("tl is not null and scases is not null").groupBy("iso", F.year("tl").alias("year")).agg(F.sum("scases").alias("cases"))
    return y.groupBy("iso").agg(F.max_by("year", F.struct("cases", "year")).alias("peak_year"))


def reliability_class(src: DataFrame, normalize_levels: bool = False) -> DataFrame:
    level = S.normalize_level(F.col("reliability")) if normalize_levels else F.col("reliability")
    score = F.create_map(*[F.lit(v) for kv in SCORES.items() for v in kv])[level]
    x = src.groupBy("iso").agg(F.sum(score).alias("score"), F.count(score).alias("scored"))
    mean = F.try_divide("score", "scored")
    return x.withColumn("reliability_class", F.when(mean >= 3.5, "High").when(mean >= 2.5, "Medium").when(mean.isNotNull(), "Low").otherwise("N/A"))


def source_type_count(src: DataFrame) -> DataFrame:
    return src.groupBy("iso").agg(F.count_distinct(F.nullif("data_type", F.lit(""))).alias("source_types"))


def coverage_approx(wc: DataFrame, possible: int = (2025 - 1970) * 52) -> DataFrame:
    """Percent of possible weeks, the sources' weeks added, half rounded up."""
    return wc.withColumn("coverage_pct", F.floor((F.col("ai_weeks") + F.col("who_weeks") + F.col("jhu_weeks")) * 100 / possible + 0.5))


def span_metrics(summary: DataFrame) -> DataFrame:
    y = F.split("date_range", "-")
    first, last = F.element_at(y, 1).cast("int"), F.element_at(y, -1).cast("int")
    two = F.size(y) >= 2
    return summary.select("iso", F.when(two, last - first + 1).alias("span_years"), F.when(two, first).alias("first_year"), F.when(two, last).alias("last_year"))


def country_metrics(obs: DataFrame, src: DataFrame, places: DataFrame, week_counts: DataFrame) -> DataFrame:
    """All metrics of each place in one row; week_counts as presence.week_counts gives them."""
    out = places.select("iso")
    summary = observation_summary(obs)
    for part in (summary.select("iso", "row_count", "date_range"), coverage_approx(week_counts).select("iso", "coverage_pct"), source_counts(src), case_totals(obs), peak_year(obs), reliability_class(src).select("iso", "reliability_class"), source_type_count(src), span_metrics(summary)):
        out = out.join(part, "iso", "left")
    return out.na.fill(0, ["row_count", "coverage_pct", "sources", "total_cases", "total_deaths", "source_types"])


def status_progress(checklist: DataFrame) -> DataFrame:
    """Places by status, and the percentage that is complete (0 without any)."""
    c = F.count_if
    s = F.col("status")
    out = checklist.agg(F.count("*").alias("places"), c(s == "COMPLETED").alias("completed"), c(s == "PENDING").alias("pending"), c(s == "NOT_STARTED").alias("not_started"))
    return out.withColumn("pct_complete", F.round(F.coalesce(F.try_divide(F.col("completed") * 100.0, "places"), F.lit(0.0)), 1))


def week_count_totals(wc: DataFrame) -> DataFrame:
    cols = ("ai_weeks", "who_weeks", "jhu_weeks")
    return wc.agg(*[F.sum(c).alias(c) for c in cols], *[F.count_if(F.col(c) > 0).alias(c.replace("_weeks", "_places")) for c in cols])


def subregion_breakdown(places: DataFrame, most: int = 100_000) -> DataFrame:
    """(subregion, part, members, places, framework): members by name in numbered parts of `most` at most, each with the
    subregion's number of places and of those with the flag. A subregion may have any number of members."""
    sums = places.groupBy("subregion").agg(F.count("*").alias("places"), F.count_if("flag").alias("framework"))
    held = ordered(places.select("subregion", "iso"), "subregion", ["iso"]).numbered("n").done()
    part = F.floor((F.col("n") - 1) / most).cast("long").alias("part")
    parts = held.groupBy("subregion", part).agg(F.array_join(F.sort_array(F.collect_list("iso")), ",").alias("members"))
    sums = sums.withColumnRenamed("subregion", "__s")
    return parts.join(sums, F.col("subregion").eqNullSafe(F.col("__s"))).drop("__s")


def source_quality_counts(src: DataFrame) -> DataFrame:
    return src.groupBy("iso").agg(F.count("*").alias("total"), F.count_if(F.col("reliability") == "Level_1").alias("level_1"), F.count_if(F.col("status") == "Active").alias("active"))


def level_distribution(src: DataFrame) -> DataFrame:
    x = src.groupBy(S.normalize_level(F.col("reliability")).alias("level")).agg(F.count("*").alias("n"))
    x = x.withColumn("total", F.sum("n").over(W.partitionBy()))
    return x.withColumn("pct", F.round(F.col("n") * 100.0 / F.col("total"), 1))


def weight_stats(obs: DataFrame) -> DataFrame:
    return obs.groupBy("iso").agg(F.round(F.avg("weight"), 6).alias("mean_weight"), F.round(F.avg("cfr"), 6).alias("mean_cfr"), F.min("cfr").alias("min_cfr"), F.max("cfr").alias("max_cfr"))


def admin_level_counts(obs: DataFrame) -> DataFrame:
    return S.parse_location(obs).cube("iso", "level").agg(F.count("*").alias("n"), F.grouping_id().alias("grp"))


def hierarchy_check(obs: DataFrame) -> DataFrame:
    x = S.parse_location(obs).groupBy("iso", F.year("tl").alias("year")).agg(F.sum(F.when(F.col("level") == "national", F.col("scases"))).alias("national"), F.sum(F.when(F.col("level") != "national", F.col("scases"))).alias("subnational"))
    return x.withColumn("double_count", F.coalesce((F.col("national") > 0) & (F.col("subnational") > 0), F.lit(False)))


def status_from_files(files: DataFrame, counts: DataFrame, data: str = "observations.csv", meta: str = "metadata.csv", log: str = "search_log_agent_", audit: str = AUDIT) -> DataFrame:
    """Status of each place in files(iso, name), given counts(iso, row_count) of the observations in them.

    COMPLETED with both tables and the audit's report, or with both tables, six logs of whatever number and at least one
    observation; PENDING once there is a log or the observations' file; else NOT_STARTED.
    """
    name = F.col("name")
    is_log = name.startswith(log) & name.endswith(".txt")
    x = files.groupBy("iso").agg(
        F.bool_or(name == data).alias("d"), F.bool_or(name == meta).alias("m"), F.bool_or(name == audit).alias("a"), F.count_distinct(F.when(is_log, name)).alias("logs"),
    ).join(counts.select("iso", F.col("row_count").alias("n")), "iso", "left")
    done = F.col("d") & F.col("m") & (F.col("a") | ((F.col("logs") >= 6) & (F.coalesce("n", F.lit(0)) > 0)))
    return x.select("iso", F.when(done, "COMPLETED").when((F.col("logs") > 0) | F.col("d"), "PENDING").otherwise("NOT_STARTED").alias("status"))


def latest_update(files: DataFrame, data: str = "observations.csv", meta: str = "metadata.csv", audit: str = AUDIT) -> DataFrame:
    """Last modification of each place's key files(iso, name, modified): both tables, the audit's report and logs 1 to 6."""
    return files.where(F.col("name").isin(data, meta, audit, *LOGS)).groupBy("iso").agg(F.max("modified").alias("latest"))
