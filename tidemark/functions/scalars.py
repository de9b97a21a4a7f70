"""Column-level functions: parsing, classes, texts, interval expansion. All are Spark built-ins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The mapping of sources; all others are dropped.
SOURCES = {"WHO": "WHO", "JHU": "JHU", "SUPP": "WHO"}


def observed(df: DataFrame, rule: str = "any") -> DataFrame:
    """Rows with data: any of cases, deaths, source; or cases and date_start; or cases alone."""
    rules = {"any": "coalesce(cast(cases as string), cast(deaths as string), source) is not null", "cases_date": "cases is not null and date_start is not null", "cases": "cases is not null"}
    return df.where(rules[rule])


def map_source(df: DataFrame, mapping: dict[str, str] | None = None, drop_unknown: bool = True) -> DataFrame:
    mapping = SOURCES if mapping is None else mapping
    to = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[F.col("source")]
    return df.withColumn("source", to).where("source is not null") if drop_unknown else df.withColumn("source", F.coalesce(to, "source"))


def parse_interval(df: DataFrame, tl: str = "tl", tr: str = "tr") -> DataFrame:
    """Dates from text or dates; an empty end is the start; bad or reversed intervals go."""
    dated = {c for c, kind in df.dtypes if kind == "date"}  # these are taken as they are
    date = lambda c: F.col(c) if c in dated else F.expr(f"try_to_date(nullif(trim(cast({c} as string)), ''), 'yyyy-MM-dd')")
    blank = F.col(tr).isNull() if tr in dated else F.expr(f"coalesce(trim(cast({tr} as string)), '') = ''")
    out = df.withColumns({"__l": date(tl), "__r": date(tr)}).withColumns({tl: F.col("__l"), tr: F.when(blank, F.col("__l")).otherwise(F.col("__r"))})
    return out.drop("__l", "__r").where(f"{tl} <= {tr}")


def filter_by_attribute(places: DataFrame, column: str, value: str | bool | None = True) -> DataFrame:
    """Places whose attribute has the value: a flag, a subregion or any other; None asks for those without one."""
    return places.where(F.col(f"`{column}`").eqNullSafe(F.lit(value)))


def search_any_column(df: DataFrame, text: str) -> DataFrame:
    hit = F.lit(False)
    for c in df.columns:
        hit = hit | F.coalesce(F.upper(F.col(c).cast("string")).contains(text.upper()), F.lit(False))
    return df.where(hit)


def parse_location(df: DataFrame, column: str = "location") -> DataFrame:
    part = F.split(column, "::")
    names = ("continent", "place", "province", "district")
    return df.withColumns({n: F.get(part, F.lit(i)) for i, n in enumerate(names)} | {"level": F.when(F.size(part) >= 4, "district").when(F.size(part) == 3, "province").otherwise("national")})


def confidence_band(weight: Column) -> Column:
    w = F.coalesce(weight.try_cast("double"), F.lit(0.0))
    return F.when(w >= 0.8, "high").when(w >= 0.5, "medium").otherwise("low")


def coverage_priority(pct: Column) -> Column:
    return F.when(pct < 70, "HIGH").when(pct < 90, "MEDIUM").otherwise("LOW")


def row_count_priority(n: Column) -> Column:
    return F.when(n == 0, "").when(n < 15, "HIGH").when(n < 30, "MEDIUM").otherwise("LOW")


def truncate_text(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def normalize_level(c: Column) -> Column:
    """`Level 1`, `1` and the like as `Level_1`; anything else stays."""
    n = F.regexp_extract(F.trim(c), r"(?i)^(?:level[ _-]?)?([1-4])$", 1)
    return F.when(n != "", F.concat(F.lit("Level_"), n)).otherwise(c)


def normalize_status(c: Column) -> Column:
    return F.initcap(F.trim(c))


def compose_auto_notes(audit: Column, agents: Column, last_done: Column, rows: Column, has_protocol: Column) -> Column:
    work = F.when(audit, "Quality audit completed").when(agents >= 6, "All agents executed").when(last_done.isNotNull(), F.format_string("Agent %d completed", last_done)).when(agents > 0, "Agent 1 initialized - starting work")
    text = F.concat_ws("; ", work, F.when(rows > 0, F.format_string("%d data observations", rows)), F.when(~has_protocol, F.lit("Setup incomplete")))
    return F.when(text == "", "No activity detected").otherwise(text)


def week_key(df: DataFrame, date: str, key: str = "calendar") -> DataFrame:
    """year and week of a date: calendar year with ISO week, or the ISO year as well."""
    year = F.expr(f"extract(yearofweek from {date})") if key == "iso" else F.year(date)
    return df.withColumns({"year": year.cast("int"), "week": F.weekofyear(date).cast("int")})


def expand_weeks(df: DataFrame, step_days: int = 7, tl: str = "tl", tr: str = "tr", key: str = "calendar") -> DataFrame:
    """A row each step of an interval with year, week and week_start, week_end. Steps of a day are few: only the weeks'
    first days, the interval's ends and New Year's days are made, which give the same keys after distinct."""
    if step_days == 1:
        mondays = F.expr(f"sequence({tl}, {tr}, interval 7 days)")
        years = F.expr(f"flatten(transform(sequence(year({tl}), year({tr})), y -> array(make_date(y, 1, 1), make_date(y, 12, 31))))")
        days = F.array_distinct(F.concat(mondays, F.array(F.col(tr)), F.filter(years, lambda d: (d >= F.col(tl)) & (d <= F.col(tr)))))
    else:
        days = F.expr(f"sequence({tl}, {tr}, interval {step_days} days)")
    out = week_key(df.withColumn("date_from", F.explode(days)), "date_from", key)
    return out.withColumn("date_to", F.date_add("date_from", 6))


def expand_months(df: DataFrame, tl: str = "tl", tr: str = "tr") -> DataFrame:
    d = F.explode(F.expr(f"sequence(trunc({tl}, 'MM'), {tr}, interval 1 month)"))
    return df.withColumn("month_start", d).withColumns({"year": F.year("month_start"), "month": F.month("month_start")})


def parse_interval_text(df: DataFrame, column: str) -> DataFrame:
    """Rows (tl, tr) of `a to b; c to d`; `None` and bad parts give none."""
    part = df.withColumn("__p", F.explode(F.split(F.coalesce(column, F.lit("")), ";")))
    ends = F.split(F.trim("__p"), " to ")
    day = lambda i: F.try_to_date(F.get(ends, F.lit(i)), "yyyy-MM-dd")
    return part.withColumns({"tl": day(0), "tr": day(1)}).drop("__p").where("tl <= tr")


def covered_years(first: str = "first_date", last: str = "last_date", periods: str = "periods") -> Column:
    """Distinct years in an array of periods."""
    return F.expr(f"array_sort(array_distinct(flatten(transform({periods}, p -> sequence(year(p.{first}), year(p.{last}))))))")


def missing_years(years: Column, first: int = 2000, last: int = 2025) -> Column:
    return F.array_except(F.sequence(F.lit(first), F.lit(last)), years)


def global_date_range(df: DataFrame, date: str, floor: str = "1970-01-01", fallback: str = "2025-12-31") -> DataFrame:
    return df.agg(F.lit(floor).cast("date").alias("first_date"), F.coalesce(F.max(date), F.lit(fallback).cast("date")).alias("last_date"))
