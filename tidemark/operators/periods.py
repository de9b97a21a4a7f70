"""Coverage periods, blocks, gaps and the summaries made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalars as S


def coverage_periods(df: DataFrame, key: str = "iso", start: str = "date_start", end: str = "date_stop", tolerance_days: int = 56) -> DataFrame:
    """Merge intervals whose distance from the running maximal end is within the tolerance.

    Equal starts are reduced to their longest interval first, so a hot key sorts its distinct starts only.
    """
    x = df.groupBy(key, F.col(start).alias("__s")).agg(F.max(end).alias("__e")).where("__s is not null")
    by = W.partitionBy(key).orderBy("__s")
    reach = F.max("__e").over(by.rowsBetween(W.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.datediff("__s", reach) > tolerance_days), 1).otherwise(0)
    part = F.sum("__new").over(by.rowsBetween(W.unboundedPreceding, 0))
    return x.withColumn("__new", new).withColumn("period", part).groupBy(key, "period").agg(F.min("__s").alias("first_date"), F.max("__e").alias("last_date"))


def data_blocks(df: DataFrame, keys: list[str], date: str, max_gap_days: int = 14) -> DataFrame:
    """Islands of point dates: a new block where the step is larger."""
    by = W.partitionBy(*keys).orderBy(date)
    x = df.select(*keys, date).where(F.col(date).isNotNull()).distinct()
    new = F.when(F.datediff(date, F.lag(date).over(by)) <= max_gap_days, 0).otherwise(1)
    x = x.withColumn("__new", new).withColumn("block", F.sum("__new").over(by))
    return x.groupBy(*keys, "block").agg(F.min(date).alias("block_start"), F.max(date).alias("block_end"), F.count("*").alias("points"))


def major_gaps(periods: DataFrame, key: str = "iso", min_days: int = 90) -> DataFrame:
    by = W.partitionBy(key).orderBy("first_date")
    x = periods.withColumn("__next", F.lead("first_date").over(by)).where("__next is not null")
    x = x.select(key, F.date_add("last_date", 1).alias("gap_start"), F.date_sub("__next", 1).alias("gap_end"), (F.datediff("__next", "last_date") - 1).alias("gap_days"))
    return x.where(F.col("gap_days") > min_days).withColumn("gap_years", F.round(F.col("gap_days") / 365.25, 1))


def coverage_summary(periods: DataFrame, key: str = "iso", min_days: int = 90) -> DataFrame:
    """First and last day, span, covered share, numbers of periods and major gaps, interval texts of each key."""
    by = W.partitionBy(key).orderBy("first_date")
    x = periods.withColumn("__next", F.lead("first_date").over(by))
    gap = F.datediff("__next", "last_date") - 1 > min_days
    span = F.datediff(F.max("last_date"), F.min("first_date"))
    covered = F.sum(F.datediff("last_date", "first_date") + 1)
    texts = lambda a: F.array_join(F.transform(F.sort_array(a), lambda s: F.concat(s["a"].cast("string"), F.lit(" to "), s["b"].cast("string"))), "; ")
    out = x.groupBy(key).agg(
        F.min("first_date").alias("first_data"), F.max("last_date").alias("last_data"), covered.alias("covered_days"), (span + 1).alias("span_days"), F.count("*").alias("data_periods"),
        F.count_if(gap).alias("major_gaps"), texts(F.collect_list(F.struct(F.col("first_date").alias("a"), F.col("last_date").alias("b")))).alias("covered_intervals"),
        texts(F.collect_list(F.when(gap, F.struct(F.date_add("last_date", 1).alias("a"), F.date_sub("__next", 1).alias("b"))))).alias("__gaps"),
    )
    none = F.col("__gaps") == ""
    around = F.format_string("Pre-%d and Post-%d data", F.year("first_data"), F.year("last_data"))
    return out.withColumns({
        "coverage_percentage": F.round(F.col("covered_days") * 100.0 / F.col("span_days"), 1),
        "total_span_years": F.round((F.col("span_days") - 1) / 365.25, 1),
        "major_gap_periods": F.when(none, "None").otherwise(F.col("__gaps")),
        "priority_search_periods": F.when(none, around).otherwise(F.col("__gaps")),
    }).drop("__gaps")


def quick_lookup(periods: DataFrame, summary: DataFrame, key: str = "iso", order: str = "text") -> DataFrame:
    """Search priorities and the first ten missing recent years; `sort_key` orders HIGH, LOW, MEDIUM as text or by rank."""
    years = periods.groupBy(key).agg(F.collect_list(F.struct("first_date", "last_date")).alias("periods"))
    x = summary.join(years, key).withColumn("__missing", S.missing_years(S.covered_years()))
    missing = F.when(F.size("__missing") == 0, "None").otherwise(F.array_join(F.slice("__missing", 1, 10).cast("array<string>"), ", "))
    x = x.withColumn("search_priority", S.coverage_priority(F.col("coverage_percentage")))
    rank = F.col("search_priority") if order == "text" else F.expr("cast(case search_priority when 'HIGH' then 1 when 'MEDIUM' then 2 else 3 end as string)")
    return x.select(key, F.col("coverage_percentage").alias("coverage_pct"), F.format_string("%d-%d", F.year("first_data"), F.year("last_data")).alias("data_span"), "search_priority", missing.alias("missing_recent_years"), F.col("priority_search_periods").alias("priority_periods"), rank.alias("sort_key"))


def zero_transmission_spans(obs: DataFrame) -> DataFrame:
    """Runs of consecutive years whose observations report neither cases nor deaths."""
    zero = S.parse_interval(obs).where("scases = 0 and deaths = 0").select("iso", F.year("tl").alias("a"), F.year("tr").alias("b")).distinct()
    y = zero.select("iso", F.explode(F.sequence("a", "b")).alias("year")).distinct()
    y = y.withColumn("__g", F.col("year") - F.row_number().over(W.partitionBy("iso").orderBy("year")))
    return y.groupBy("iso", "__g").agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count("*").alias("years")).drop("__g")
