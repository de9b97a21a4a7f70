"""Week and month frames, presence matrices, counts and ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalars as S
from .periods import coverage_periods


def week_frame(places: DataFrame, start_year: int, as_of: str, sources: list[str]) -> DataFrame:
    """places x weeks x sources. Weeks start on the Monday on or before Jan 1 and run to as_of."""
    first = F.date_trunc("week", F.make_date(F.lit(start_year), F.lit(1), F.lit(1))).cast("date")
    weeks = places.sparkSession.range(1).select(F.explode(F.sequence(first, F.lit(as_of).cast("date"), F.expr("interval 7 days"))).alias("date_from"))
    weeks = S.week_key(weeks, "date_from").withColumn("date_to", F.date_add("date_from", 6))
    kinds = places.sparkSession.createDataFrame([(s,) for s in sources], "source string")
    return places.crossJoin(F.broadcast(weeks)).crossJoin(F.broadcast(kinds))


def month_frame(places: DataFrame, start_year: int, as_of: str) -> DataFrame:
    months = places.sparkSession.range(1).select(F.explode(F.sequence(F.make_date(F.lit(start_year), F.lit(1), F.lit(1)), F.lit(as_of).cast("date"), F.expr("interval 1 month"))).alias("m"))
    return places.crossJoin(F.broadcast(months.select(F.year("m").alias("year"), F.month("m").alias("month"))))


def key_set(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys; the partial distinct before the exchange cuts what interval expansion multiplies."""
    return df.select(*keys).distinct()


def mined_week_keys(intervals: DataFrame, step_days: int = 7, key: str = "iso", tl: str = "tl", tr: str = "tr") -> DataFrame:
    """Distinct (key, year, week) of intervals expanded by steps of step_days from each start.

    Daily keys depend on the union of a place's intervals only, so these are merged before they are expanded; longer
    steps depend on the start, so the longest interval of each start is. Either way what is expanded is bounded by the
    calendar, not by the rows.
    """
    if step_days == 1:
        few = coverage_periods(intervals, key, tl, tr, 1).select(key, F.col("first_date").alias(tl), F.col("last_date").alias(tr))
    else:
        few = intervals.groupBy(key, tl).agg(F.max(tr).alias(tr))
    return key_set(S.expand_weeks(few, step_days, tl, tr), [key, "year", "week"])


def mined_month_keys(intervals: DataFrame, key: str = "iso", tl: str = "tl", tr: str = "tr") -> DataFrame:
    """Distinct (key, year, month) that intervals touch; merged before they are expanded, as above."""
    few = coverage_periods(intervals, key, tl, tr, 1).select(key, F.col("first_date").alias(tl), F.col("last_date").alias(tr))
    return key_set(S.expand_months(few, tl, tr), [key, "year", "month"])


def combine_sources(base: DataFrame, mined: DataFrame) -> DataFrame:
    return base.unionByName(mined)


def weekly_presence(frame: DataFrame, keys: DataFrame) -> DataFrame:
    """present 0/1 of each frame row; keys: distinct (iso, source, year, week)."""
    on = ["iso", "source", "year", "week"]
    return frame.join(keys.select(*on).withColumn("__p", F.lit(1)), on, "left").withColumn("present", F.coalesce("__p", F.lit(0))).drop("__p")


def monthly_presence(frame: DataFrame, base: DataFrame, mined: DataFrame) -> DataFrame:
    on = ["iso", "year", "month"]
    a, b = base.select(*on).withColumn("__a", F.lit(1)), mined.select(*on).withColumn("__b", F.lit(1))
    return frame.join(a, on, "left").join(b, on, "left").select(*frame.columns, F.coalesce("__a", F.lit(0)).alias("surveillance_orig"), F.coalesce("__b", F.lit(0)).alias("surveillance_ai"))


def filled_weeks(weekly: DataFrame, base: list[str], mined: str) -> DataFrame:
    """Of each place: weeks absent in the base sources but present in the mined one, and their share of all weeks."""
    x = weekly.groupBy("iso", "year", "week", "date_from").agg(F.max(F.when(F.col("source").isin(base), F.col("present"))).alias("b"), F.max(F.when(F.col("source") == mined, F.col("present"))).alias("m"))
    out = x.groupBy("iso").agg(F.count("*").alias("weeks"), F.count_if(F.col("b") == 0).alias("absent"), F.count_if((F.col("b") == 0) & (F.col("m") == 1)).alias("filled"))
    return out.withColumn("filled_pct", F.round(F.col("filled") * 100.0 / F.col("weeks"), 1))


def week_counts(df: DataFrame, places: DataFrame, sources: list[str]) -> DataFrame:
    """Rows per place and source in columns, 0 where there are none."""
    x = df.groupBy("iso").pivot("source", sources).count()
    x = places.join(x, "iso", "left")
    return x.select(*places.columns, *[F.coalesce(F.col(s), F.lit(0)).alias(f"{s.lower()}_weeks") for s in sources])


def monthly_coverage_summary(matrix: DataFrame) -> DataFrame:
    o, a = F.col("surveillance_orig") == 1, F.col("surveillance_ai") == 1
    n = {"base": F.count_if(o), "mined": F.count_if(a), "any_source": F.count_if(o | a), "mined_only": F.count_if(a & ~o)}
    out = matrix.agg(F.count("*").alias("months"), *[c.alias(k) for k, c in n.items()], F.count_distinct("iso").alias("places"))
    return out.withColumns({f"{k}_pct": F.round(F.coalesce(F.try_divide(F.col(k) * 100.0, "months"), F.lit(0.0)), 1) for k in n})


def source_coverage(weekly: DataFrame) -> DataFrame:
    return weekly.groupBy("source").agg(F.sum("present").alias("present"), F.count("*").alias("total")).withColumn("pct", F.round(F.coalesce(F.try_divide(F.col("present") * 100.0, "total"), F.lit(0.0)), 1))


def place_source_rollup(weekly: DataFrame) -> DataFrame:
    return weekly.rollup("source", "iso").agg(F.sum("present").alias("weeks"), F.grouping_id().alias("grp"))


def dedup_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return df.withColumn("__k", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__k = 1").drop("__k")


def rank_places(df: DataFrame, metric: str, n: int = 10) -> DataFrame:
    """Top n places; ties by iso. Only n rows a partition reach the last step."""
    top = df.orderBy(F.desc(metric), "iso").limit(n)
    return top.withColumn("rank", F.row_number().over(W.orderBy(F.desc(metric), "iso")))
