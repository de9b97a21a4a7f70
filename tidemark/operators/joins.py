"""Links between observations, sources, places and intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalars as S
from .periods import coverage_periods
from .presence import dedup_first
from .scan import cut


def restrict_places(df: DataFrame, places: DataFrame, flag: str) -> DataFrame:
    return df.join(places.where(flag).select("iso"), "iso", "left_semi")


def completed_only(df: DataFrame, checklist: DataFrame) -> DataFrame:
    """Rows of the places that the checklist(iso, status) calls COMPLETED."""
    return df.join(checklist.where("status = 'COMPLETED'").select("iso"), "iso", "left_semi")


def attach_source(obs: DataFrame, src: DataFrame) -> DataFrame:
    """URL of each observation's source; the first of sources with one index wins."""
    one = dedup_first(src.select(F.col("iso"), F.col("idx").alias("source_index"), "url"), ["iso", "source_index"], ["url"])
    return obs.join(one, ["iso", "source_index"], "left")


def orphan_sources(obs: DataFrame, src: DataFrame) -> DataFrame:
    return obs.join(src.select("iso", F.col("idx").alias("source_index")), ["iso", "source_index"], "left_anti")


def unused_sources(src: DataFrame, obs: DataFrame) -> DataFrame:
    return src.join(obs.select("iso", F.col("source_index").alias("idx")), ["iso", "idx"], "left_anti")


def source_name_mismatch(obs: DataFrame, src: DataFrame) -> DataFrame:
    s = src.select("iso", F.col("idx").alias("source_index"), F.col("source").alias("listed"))
    return obs.join(s, ["iso", "source_index"]).where(~F.col("source").eqNullSafe(F.col("listed")))


def enrich_place(df: DataFrame, places: DataFrame) -> DataFrame:
    """Country and subregion; places is a dimension of a few dozen rows, Spark broadcasts it by its size."""
    return df.join(places.select("iso", "country", "subregion"), "iso", "left")


def merge_manual_notes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Carry what stands after the last `| Manual:` of the previous note, unless it equals the automatic one."""
    old = previous.select("iso", F.trim("notes").alias("__old"), F.trim(F.substring_index("notes", "| Manual:", -1)).alias("__m"))
    x = current.join(old, "iso", "left")
    keep = F.coalesce((F.col("__old") != "") & ~F.col("__old").startswith(F.col("notes")) & (F.col("__m") != F.col("notes")), F.lit(False))
    return x.withColumn("notes", F.when(keep, F.concat("notes", F.lit(" | Manual: "), "__m")).otherwise(F.col("notes"))).drop("__m", "__old")


#: Days of the smallest block that intervals are covered by, and rows of a block from which it is split.
UNIT, HOT = 64, 1_000_000


def _unit(day: str) -> Column:
    return F.floor(F.unix_date(F.col(day)) / UNIT).cast("long")


def dyadic_cover(first: Column, last: Column, levels: int) -> Column:
    """Aligned blocks (level, number) of 2 ** level units that tile the units first..last: two a level at most."""

    def at(k: Column) -> Column:
        low, high = -F.call_function("shiftright", -first, k), F.call_function("shiftright", last + 1, k)
        odd = lambda x: F.pmod(x, F.lit(2)) == 1
        block = lambda when, n: F.when((low < high) & when, F.struct(k.alias("level"), n.alias("block")))
        return F.array_compact(F.array(block(odd(low), low), block(odd(high), high - 1)))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), at))


def _blocks_of(unit: Column, levels: int) -> Column:
    """The block of each level that holds a unit."""
    return F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), lambda k: F.struct(k.alias("level"), F.call_function("shiftright", unit, k).alias("block")))


def _stabbed(intervals: DataFrame, points: DataFrame, key: str, at: tuple[str, str], day: str, levels: int, hot: int) -> DataFrame:
    """Pairs of an interval and a row whose day lies in it. They meet in the one block of the interval's cover that holds
    the day. Where a block has very many rows of points, these are split, and the intervals that it covers are repeated."""
    cell = [key, "__level", "__block"]
    named = lambda df, c: df.withColumn("__c", F.explode(c)).withColumns({"__level": F.col("__c.level"), "__block": F.col("__c.block")}).drop("__c")
    x = named(intervals, dyadic_cover(_unit(at[0]), _unit(at[1]), levels))
    y = named(points, _blocks_of(_unit(day), levels))
    large = cut(y.groupBy(*cell).count().where(F.col("count") > hot).withColumn("__parts", F.ceil(F.col("count") / hot).cast("int")).drop("count"))
    if not large.isEmpty():  # each has over `hot` rows, so they are few
        x, y = x.join(F.broadcast(large), cell, "left"), y.join(F.broadcast(large), cell, "left")
        parts = F.coalesce("__parts", F.lit(1))
        x = x.withColumn("__salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
        y = y.withColumn("__salt", F.pmod(F.xxhash64(*points.columns), parts).cast("int")).drop("__parts")
        cell = [*cell, "__salt"]
    return x.join(y, cell).where(F.col(day).between(F.col(at[0]), F.col(at[1]))).drop("__level", "__block", "__salt")


def overlap_join(a: DataFrame, b: DataFrame, key: str, at: tuple[str, str], bt: tuple[str, str], hot: int = HOT) -> DataFrame:
    """Pairs of intervals of one key that overlap, each once. Column names of a and b must differ but for the key.

    Of two that overlap, one holds the other's start: a holds b's, or b holds a's and starts before it. An interval is
    covered by blocks of days, a few for each doubling of its length, and a start is sought in the block of each length.
    Intervals without a key or an end, or that end before they start, overlap nothing.
    """
    valid = lambda df, t: df.where(F.col(key).isNotNull() & (F.col(t[0]) <= F.col(t[1])))
    a, b = valid(a, at), valid(b, bt)
    long = [df.agg(F.max(_unit(t[1]) - _unit(t[0]))).first()[0] or 0 for df, t in ((a, at), (b, bt))]
    out = [key, *[c for c in a.columns if c != key], *[c for c in b.columns if c != key]]
    one = _stabbed(a, b, key, at, bt[0], (long[0] + 1).bit_length() + 1, hot)
    two = _stabbed(b, a, key, bt, at[0], (long[1] + 1).bit_length() + 1, hot).where(F.col(bt[0]) < F.col(at[0]))
    return one.select(*out).unionByName(two.select(*out))


def gap_fill(gaps: DataFrame, intervals: DataFrame) -> DataFrame:
    """Of each gap: overlapping intervals, days they fill (each once), days in all and the filled percentage.

    Counted along the days of a place, without listing pairs: what overlaps a gap has started by its end and not ended
    before its start, and a day is filled while some have started and not ended. Equal intervals go first, so a place
    sorts its different ones only, and all of a place is dealt once. Gaps of a place differ in their days.
    """
    i = intervals.select("iso", "tl", "tr").where("iso is not null and tl <= tr").distinct()
    i = i.withColumns({"days": F.lit(None).cast("int"), "gap": F.lit(False)})
    g = gaps.select("iso", F.col("gap_start").alias("tl"), F.col("gap_end").alias("tr"), F.col("gap_days").alias("days"), F.lit(True).alias("gap"))
    held = i.unionByName(g).repartition("iso")
    asked = lambda start: F.when(F.col("gap"), F.struct("tl", "tr", "days", F.lit(start).alias("start"))).alias("gap")
    one = lambda when, name: F.when(when & ~F.col("gap"), 1).otherwise(0).alias(name)
    side = lambda day, start: F.struct(day.alias("day"), one(F.lit(start), "s"), one(F.lit(not start), "e"), asked(start))
    rows = held.select("iso", F.explode(F.array(side(F.unix_date("tl"), True), side(F.unix_date("tr") + 1, False))).alias("x")).select("iso", "x.*")
    by = W.partitionBy("iso").orderBy("day")
    upto, until = by.rangeBetween(W.unboundedPreceding, 0), by.rangeBetween(W.unboundedPreceding, -1)
    rows = rows.withColumns({"begun": F.sum("s").over(upto), "over": F.sum("e").over(upto), "before": F.sum("s").over(until), "next": F.lead("day").over(by)})
    filled = F.when(F.col("begun") > F.col("over"), F.col("next") - F.col("day"))
    rows = rows.withColumn("filled", F.sum(filled).over(until)).where("gap is not null")
    at = lambda c, start: F.coalesce(F.max(F.when(F.col("gap.start") == start, F.col(c))), F.lit(0))
    counts = (at("before", False) - at("over", True)).alias("n"), (at("filled", False) - at("filled", True)).alias("d")
    out = rows.groupBy("iso", F.col("gap.tl").alias("gap_start"), F.col("gap.tr").alias("gap_end"), F.col("gap.days").alias("gap_days")).agg(*counts)
    valid = lambda c: F.when(F.col("gap_start") <= F.col("gap_end"), F.col(c)).otherwise(F.lit(0).cast("long"))
    out = out.select("iso", "gap_start", "gap_days", valid("n").alias("intervals"), valid("d").alias("filled_days"))
    return out.withColumn("filled_pct", F.round(F.col("filled_days") * 100.0 / F.col("gap_days"), 1))


def confirm_major(obs: DataFrame, min_cases: int = 1000) -> DataFrame:
    """Outbreaks above min_cases with the number of other sources that overlap in time at the place.

    Counted by ranks, without listing pairs: each source's intervals become few merged periods, and a source whose k
    periods meet an outbreak has k - 1 of its gaps inside it. So the sources are the periods that have started by its end
    and not ended before its start, less the gaps inside. An outbreak's own source always overlaps it, and is taken off.
    """
    o = S.parse_interval(obs)
    major = cut(o.where(F.col("scases") > min_cases).select("idx", "location", "source", "tl", "tr").distinct())
    held = o.where("location is not null and source is not null").select(F.struct("location", "source").alias("__k"), "tl", "tr")
    follows = F.lead("first_date").over(W.partitionBy("__k").orderBy("first_date"))
    periods = coverage_periods(held, "__k", "tl", "tr", 0).withColumn("next", follows)
    periods = cut(periods.select(F.col("__k.location").alias("iso"), "first_date", "last_date", "next"))
    asked = major.where("location is not null").select(F.col("location").alias("iso"), "tl", "tr").distinct()
    met = _meeting(periods, "first_date", "last_date", asked)
    inside = _inside(periods.where("next is not null"), "last_date", "next", asked)
    n = met.join(inside, ["iso", "tl", "tr"], "left").withColumn("others", F.col("n") - F.coalesce("inside", F.lit(0)) - 1)
    out = major.join(n.withColumnRenamed("iso", "location"), ["location", "tl", "tr"], "left")
    known = F.when(F.col("source").isNotNull(), F.col("others"))
    return out.select("idx", "location", F.coalesce(known, F.lit(0).cast("long")).alias("others"))


def _up_to(counts: DataFrame, asked: DataFrame, day: str) -> DataFrame:
    """asked(iso, day) with n: the sum of counts(iso, day, n) up to that day. Days of a place are ordered, not rows."""
    both = counts.select("iso", day, "n").unionAll(asked.select("iso", day, F.lit(0).cast("long")))
    daily = both.groupBy("iso", day).agg(F.sum("n").alias("n"))
    return daily.withColumn("n", F.sum("n").over(W.partitionBy("iso").orderBy(day)))


def _meeting(intervals: DataFrame, start: str, end: str, asked: DataFrame) -> DataFrame:
    """asked(iso, tl, tr) with n: how many intervals(iso, start, end) of the place meet tl..tr. None is listed as a pair."""
    starts = intervals.groupBy("iso", F.col(start).alias("day")).agg(F.count("*").alias("n"))
    ends = intervals.groupBy("iso", F.date_add(end, 1).alias("day")).agg(F.count("*").alias("n"))
    begun = _up_to(starts, asked.select("iso", F.col("tr").alias("day")).distinct(), "day").withColumnsRenamed({"day": "tr", "n": "__begun"})
    over = _up_to(ends, asked.select("iso", F.col("tl").alias("day")).distinct(), "day").withColumnsRenamed({"day": "tl", "n": "__over"})
    met = asked.join(begun, ["iso", "tr"]).join(over, ["iso", "tl"])
    return met.withColumn("n", F.col("__begun") - F.col("__over")).drop("__begun", "__over")


def _inside(intervals: DataFrame, start: str, end: str, asked: DataFrame) -> DataFrame:
    """asked(iso, tl, tr) with `inside`, how many intervals(iso, start, end) lie in tl..tr, where there are any.

    What is asked is covered by blocks of days, a few for each doubling of its length, and an interval stands in the block
    of each length that holds its start; in a block ends are counted up to the last day asked for.
    """
    long = asked.agg(F.max(F.datediff("tr", "tl"))).first()[0] or 0
    levels = (long + 1).bit_length() + 1
    cell = lambda c: F.struct("iso", F.col(f"{c}.level").alias("level"), F.col(f"{c}.block").alias("block")).alias("iso")
    day = lambda c: F.unix_date(F.col(c)).cast("long")
    few = intervals.where(F.datediff(end, start) <= long).groupBy("iso", start, end).agg(F.count("*").alias("n"))
    held = few.withColumn("__c", F.explode(_blocks_of(day(start), levels))).groupBy(cell("__c"), F.col(end).alias("day")).agg(F.sum("n").alias("n"))
    sought = asked.withColumn("__c", F.explode(dyadic_cover(day("tl"), day("tr"), levels))).select(cell("__c"), "tl", "tr")
    sought = sought.join(held.select("iso"), "iso", "left_semi")
    ends = _up_to(held, sought.select("iso", F.col("tr").alias("day")).distinct(), "day").withColumnRenamed("day", "tr")
    found = sought.join(ends.where("n > 0"), ["iso", "tr"])
    return found.groupBy(F.col("iso.iso").alias("iso"), "tl", "tr").agg(F.sum("n").alias("inside"))


def neighbour_overlap(obs: DataFrame, neighbours: DataFrame) -> DataFrame:
    """Outbreaks of a place with how many of neighbouring places overlap in time. neighbours: iso, list of iso.

    Counted by ranks, without listing pairs: what overlaps an outbreak has started by its end and not ended before its
    start. Starts and ends are summed by day first, so a place sorts its days only.
    """
    o = S.parse_interval(obs).select("idx", "iso", "tl", "tr").distinct()
    near = neighbours.select(F.col("iso").alias("__own"), F.explode("neighbours").alias("iso"))
    asked = o.withColumnRenamed("iso", "__own").join(near, "__own")
    starts = o.groupBy("iso", F.col("tl").alias("day")).agg(F.count("*").alias("n"))
    ends = o.groupBy("iso", F.date_add("tr", 1).alias("day")).agg(F.count("*").alias("n"))
    begun = _up_to(starts, asked.select("iso", F.col("tr").alias("day")).distinct(), "day").withColumnsRenamed({"day": "tr", "n": "begun"})
    over = _up_to(ends, asked.select("iso", F.col("tl").alias("day")).distinct(), "day").withColumnsRenamed({"day": "tl", "n": "over"})
    met = asked.join(begun, ["iso", "tr"]).join(over, ["iso", "tl"])
    return met.groupBy("idx", F.col("__own").alias("iso")).agg(F.sum(F.col("begun") - F.col("over")).alias("overlaps")).where("overlaps > 0").select("idx", "iso", "overlaps")
