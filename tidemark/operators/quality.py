"""Data-quality checks: flags per row, and counts of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalars as S
from .scan import ordered

# Columns of the two files of a place; bands of confidence weights by reliability level.
WIDTHS = {"data": 13, "meta": 14}
BANDS = {"Level_1": (0.9, 1.0), "Level_2": (0.7, 0.9), "Level_3": (0.3, 0.6), "Level_4": (0.1, 0.3)}


def header_compliance(files: DataFrame) -> DataFrame:
    """files(iso, kind, header), kind data or meta: whether each place has both files with the required columns and
    width, and what is wrong, parted by ` | `. A file without a header has the header ''."""
    h = F.split(F.trim(F.coalesce("header", F.lit(""))), ",")
    lacks = lambda c: F.when(~F.array_contains(h, c), F.format_string(f"%s: no {c} column", "kind"))
    width = F.when(F.col("kind") == "data", WIDTHS["data"]).otherwise(WIDTHS["meta"])
    wide = F.when(F.size(h) != width, F.format_string("%s: %d columns, %d needed", F.col("kind"), F.size(h), width))
    issues = F.array_compact(F.array(lacks("Index"), F.when(F.col("kind") == "data", lacks("source_index")), wide))
    kinds = files.select("iso", "kind", issues.alias("i")).groupBy("iso").agg(
        F.count("*").alias("files"), F.array_sort(F.flatten(F.collect_list("i"))).alias("i"), *[F.bool_or(F.col("kind") == k).alias(k) for k in WIDTHS]
    )
    missing = F.array_compact(F.array(*[F.when(~F.col(k), f"{k}: no file") for k in WIDTHS]))
    found = F.array_distinct(F.concat("i", missing))
    return kinds.select("iso", "files", (F.size(found) == 0).alias("compliant"), F.array_join(found, " | ").alias("issues"))


def compliance_rate(places: DataFrame) -> DataFrame:
    """Of header_compliance's rows: places, compliant ones and their percentage (0 without any)."""
    x = places.agg(F.count("*").alias("places"), F.count_if("compliant").alias("compliant"))
    return x.withColumn("pct", F.round(F.coalesce(F.try_divide(F.col("compliant") * 100.0, "places"), F.lit(0.0)), 1))


def split_malformed(lines: DataFrame, columns: list[str], value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Lines of CSV with as many fields as there are columns, as those columns of text, and the others as they stand.

    Quotes may hold commas. Null and blank lines are malformed.
    """
    schema = ", ".join(f"`{c}` string" for c in columns) + ", `__bad` string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad", "quote": '"', "escape": '"'}
    x = lines.withColumn("__r", F.from_csv(F.col(f"`{value}`"), schema, options))
    bad = F.coalesce(F.trim(F.col(f"`{value}`")), F.lit("")).eqNullSafe("") | F.col("__r").isNull() | F.col("__r.__bad").isNotNull()
    others = [F.col(f"`{c}`") for c in lines.columns if c != value and c not in columns]
    return x.where(~bad).select(*others, *[F.col(f"__r.`{c}`") for c in columns]), x.where(bad).select(*[F.col(f"`{c}`") for c in lines.columns])


def date_logic(obs: DataFrame) -> DataFrame:
    return obs.withColumns({"ends_late": F.coalesce(F.col("tl") > F.col("tr"), F.lit(False)), "reported_early": F.coalesce(F.col("reporting_date") < F.coalesce("tr", "tl"), F.lit(False))})


def count_logic(obs: DataFrame) -> DataFrame:
    return obs.withColumns({"too_deadly": F.coalesce(F.col("deaths") > F.col("scases"), F.lit(False)), "negative": F.coalesce((F.col("deaths") < 0) | (F.col("scases") < 0), F.lit(False))})


def cfr_check(obs: DataFrame, tolerance: float = 0.1, low: float = 0.1, high: float = 15.0) -> DataFrame:
    made = F.try_divide(F.col("deaths") * 100.0, F.col("scases").cast("double"))
    return obs.withColumns({"cfr_differs": F.coalesce(F.abs(made - F.col("cfr")) > tolerance, F.lit(False)), "cfr_odd": F.coalesce(~made.between(low, high), F.lit(False))})


def weight_band(obs: DataFrame, src: DataFrame) -> DataFrame:
    """Whether each weight lies in the band of its source's level; null without a linked source or level."""
    s = src.groupBy("iso", F.col("idx").alias("source_index")).agg(F.min(S.normalize_level(F.col("reliability"))).alias("level"))
    low = F.create_map(*[F.lit(v) for k, b in BANDS.items() for v in (k, b[0])])[F.col("level")]
    high = F.create_map(*[F.lit(v) for k, b in BANDS.items() for v in (k, b[1])])[F.col("level")]
    return obs.join(s, ["iso", "source_index"], "left").withColumn("in_band", F.col("weight").between(low, high))


def location_format(obs: DataFrame) -> DataFrame:
    good = F.col("location").rlike(r"^AFR::[A-Z0-9]+(::[^:]+){0,2}$") & (F.get(F.split("location", "::"), F.lit(1)) == F.col("iso"))
    return obs.withColumn("good_location", F.coalesce(good, F.lit(False)))


def duplicates(obs: DataFrame) -> DataFrame:
    """Places and periods that several rows report, a row of each source there.

    n: rows of the source, exact if there are several; rows, sources and counts (different numbers of cases) of the
    period; conflict if the counts differ.
    """
    by = ["location", "tl", "tr"]
    each = obs.groupBy(*by, "source").agg(F.count("*").alias("n"))
    whole = obs.groupBy(*by).agg(F.count("*").alias("rows"), F.count_distinct("source").alias("sources"), F.count_distinct("scases").alias("counts")).where("rows > 1")
    whole = whole.withColumnsRenamed({c: f"__{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    x = each.join(whole, same[0] & same[1] & same[2]).drop(*[f"__{c}" for c in by])
    return x.withColumns({"exact": F.col("n") > 1, "conflict": F.col("counts") > 1})


def has_quantity(obs: DataFrame) -> DataFrame:
    return obs.withColumn("has_quantity", F.coalesce("scases", "deaths", "ccases").isNotNull())


def validation_funnel(obs: DataFrame) -> DataFrame:
    """How many rows pass each stage, all of them, and that in percent (0 without rows)."""
    x = has_quantity(location_format(cfr_check(count_logic(date_logic(obs)))))
    d, c = ~F.col("ends_late") & ~F.col("reported_early"), ~F.col("too_deadly") & ~F.col("negative")
    f, p = ~F.col("cfr_odd"), F.col("good_location") & F.col("has_quantity")
    out = x.agg(F.count("*").alias("n"), F.count_if(d).alias("dates"), F.count_if(c).alias("quantities"), F.count_if(f).alias("cfr"), F.count_if(p).alias("form"), F.count_if(d & c & f & p).alias("passed"))
    return out.withColumn("pass_pct", F.round(F.coalesce(F.try_divide(F.col("passed") * 100.0, "n"), F.lit(0.0)), 1))


def domain_tier(src: DataFrame, tiers: DataFrame) -> DataFrame:
    """src with host and tier: that of the longest domain in tiers(host, tier) that the URL's host is or lies in, else 0.

    A host stands for its domains, from its last label up: `apps.who.int` is also in `who.int`, `notwho.int` isn't. Hosts
    are sought once each, however often they occur; case and a dot at the end don't count.
    """
    x = src.withColumn("host", F.rtrim(F.lower(F.try_parse_url("url", F.lit("HOST"))), F.lit(".")))
    labels = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("domain"), (-i).alias("labels")))
    known = tiers.select(F.lower("host").alias("domain"), F.col("tier").alias("__tier"))
    each = x.select("host").where("host is not null").distinct().withColumn("d", F.explode(domains)).select("host", "d.*")
    best = each.join(known, "domain").groupBy("host").agg(F.max_by("__tier", F.struct("labels", "__tier")).alias("tier"))
    return x.join(best, "host", "left").withColumn("tier", F.coalesce("tier", F.lit(0)))


def index_sequence_gaps(df: DataFrame, key: str = "iso", index: str = "idx") -> DataFrame:
    """Rows whose index isn't its rank from 1. A place may be of any size."""
    x = ordered(df.select(key, index), key, [index]).numbered("expected").done()
    return x.where(F.col(index) != F.col("expected"))
