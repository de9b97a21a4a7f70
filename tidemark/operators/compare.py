"""Two datasets year by year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


def _years(df: DataFrame) -> DataFrame:
    """Years that intervals touch; equal pairs of years are expanded once."""
    ends = S.parse_interval(df).select("iso", F.year("tl").alias("a"), F.year("tr").alias("b")).distinct()
    return ends.select("iso", F.explode(F.sequence("a", "b")).alias("year")).distinct()


def year_coverage(a: DataFrame, b: DataFrame, first: int, last: int) -> DataFrame:
    """Both, A, B or Neither for each place in either and each year."""
    x, y = _years(a).withColumn("in_a", F.lit(1)), _years(b).withColumn("in_b", F.lit(1))
    places = x.select("iso").union(y.select("iso")).distinct()
    frame = places.withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last))))
    z = frame.join(x, ["iso", "year"], "left").join(y, ["iso", "year"], "left")
    code = F.when(F.col("in_a").isNotNull() & F.col("in_b").isNotNull(), "Both").when(F.col("in_a").isNotNull(), "A").when(F.col("in_b").isNotNull(), "B").otherwise("Neither")
    return z.select("iso", "year", code.alias("code"))


def decade_timeline(coverage: DataFrame) -> DataFrame:
    """A string of the years' codes (X, A, B, -) for each decade."""
    letter = F.expr("case code when 'Both' then 'X' when 'Neither' then '-' else code end")
    x = coverage.groupBy("iso", (F.floor(F.col("year") / 10) * 10).cast("int").alias("decade")).agg(F.sort_array(F.collect_list(F.struct("year", letter.alias("c")))).alias("s"))
    return x.select("iso", "decade", F.array_join(F.transform("s", lambda v: v["c"]), "").alias("timeline"))


def discrepancy(a: DataFrame, b: DataFrame) -> DataFrame:
    """a, b (iso, year, n): how far apart, in percent of the smaller, and its class."""
    x = a.withColumnRenamed("n", "a").join(b.withColumnRenamed("n", "b"), ["iso", "year"], "full")
    pct = F.round(F.try_divide(F.abs(F.col("a") - F.col("b")) * 100.0, F.least("a", "b")), 1)
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    kind = F.when(~both, "single").when(pct < 1, "perfect").when(pct <= 5, "excellent").when(pct <= 15, "acceptable").when(pct < 100, "moderate").otherwise("major")
    return x.withColumn("class", kind)


def dataset_overview(a: DataFrame, b: DataFrame) -> DataFrame:
    """Span, years and rows of each dataset and of both."""
    part = lambda d, n: S.parse_interval(d).select(F.lit(n).alias("dataset"), "tl", "tr")
    x = part(a, "A").unionAll(part(b, "B"))
    few = x.groupBy("dataset", F.year("tl").alias("y")).agg(F.min("tl").alias("l"), F.max("tr").alias("r"), F.count("*").alias("c"))
    both = few.rollup("dataset").agg(F.min("l").alias("first_date"), F.max("r").alias("last_date"), F.count_distinct("y").alias("years"), F.sum("c").alias("n"))
    return both.withColumn("dataset", F.coalesce("dataset", F.lit("all")))
