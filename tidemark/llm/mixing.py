"""Mixing sources to target weights by entropy balancing (operator 9).

Of all document rates r in [0, 2] that meet each source's token target, take those nearest to one copy each in
entropy. The dual is convex with one multiplier t a source, and the rates are exponentially tilted by size:
r = 2 / (1 + exp(-t * size / mean size)). Newton steps on the dual are aggregations over (source, size, rows) - all
that the rates depend on. Rates become whole copies by cumulative rounding in order of size. What a source is then off
is mended by single copies of some documents: which sizes, and how many of each, is found from counts by (source, size,
copies), so that documents are rewritten once.

Defined cases: null text has size 0; null is a source of its own, last in order; sources or tables without words take
nothing; repeated rows are documents of their own; an empty table gives an empty result; other columns are kept, but
for the text and those that the result names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, cut, small

#: Parts, at least, in which documents of one source and size are numbered, and rows to a part where there are more.
SALT, PART = 64, 500_000


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """sources(source, source_size) with target: `share` of all sizes split by weight, none above most * its size.

    Weights go to the sources in code-point order, null last, repeating. The water level at which the capped shares
    use up the budget is found in order of cap / weight. Sources are put in order in one task: a row each.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    every = Window.partitionBy()
    x = sources.withColumn("weight", w).withColumn("cap", F.col("source_size") * float(most))
    x = x.withColumn("ratio", F.col("cap") / F.col("weight")).withColumn("budget", F.sum("source_size").over(every) * float(share))
    by = Window.orderBy("ratio")
    x = x.withColumn("rank", F.dense_rank().over(by))
    lower = Window.orderBy("rank").rangeBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("cap_below", F.coalesce(F.sum("cap").over(lower), F.lit(0.0)))
    x = x.withColumn("weight_from", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(lower), F.lit(0.0)))
    x = x.withColumn("capped", F.col("cap_below") + F.col("ratio") * F.col("weight_from") <= F.col("budget"))
    used = F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0.0))
    rest = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("weight") * (F.col("budget") - used) / rest))
    return x.select("source", "source_size", target.alias("target"))


def _rate(most: float) -> F.Column:
    return F.when(F.col("full"), F.lit(float(most))).otherwise(F.lit(float(most)) / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.col("t") * F.col("x"))))))


def tilt(sizes: DataFrame, goals: DataFrame, most: float = 2.0, steps: int = 60, tolerance: float = 1e-9) -> DataFrame:
    """goals(source, source_size, target, docs) with the multiplier t; sizes(source, size, rows) feed the Newton steps."""
    now = cut(
        goals.withColumns({
            "t": F.lit(0.0),
            "mean": F.col("source_size") / F.col("docs"),
            "full": F.col("target") >= F.col("source_size") * float(most) * (1 - 1e-12),
            "off": F.lit(1.0),
            "low": F.lit(-1e6),
            "high": F.lit(1e6),
        })
    )
    for _ in range(steps):
        open_ = now.where(~F.col("full") & (F.col("source_size") > 0)).withColumnRenamed("source", "s")
        one = sizes.join(open_, F.col("source").eqNullSafe(F.col("s"))).withColumn("x", F.col("size") / F.col("mean"))
        r = _rate(most)
        sums = one.groupBy("source").agg(
            F.sum(F.col("rows") * F.col("x") * r).alias("got"),
            F.sum(F.col("rows") * F.col("x") * F.col("x") * r * (1 - r / float(most))).alias("slope"),
        )
        j = now.join(sums.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
        miss = F.col("got") - F.col("target") / F.col("mean")
        # Newton inside the bracket that the signs seen so far leave, else its middle
        low = F.when(miss < 0, F.col("t")).otherwise(F.col("low"))
        high = F.when(miss > 0, F.col("t")).otherwise(F.col("high"))
        jump = F.col("t") - miss / F.col("slope")
        limit = 2.0 + F.abs(F.col("t"))
        jump = F.greatest(F.col("t") - limit, F.least(F.col("t") + limit, jump))
        jump = F.when((F.col("slope") > 1e-12) & (jump > low) & (jump < high), jump).otherwise((low + high) / 2)
        live = F.col("got").isNotNull()
        off = F.when(live, F.abs(miss) * F.col("mean") / F.greatest(F.col("target"), F.lit(1e-9))).otherwise(0.0)
        now = cut(j.select(
            "source", "source_size", "target", "docs", "mean", "full", off.alias("off"),
            F.when(live & (off > tolerance), jump).otherwise(F.col("t")).alias("t"),
            F.when(live, low).otherwise(F.col("low")).alias("low"),
            F.when(live, high).otherwise(F.col("high")).alias("high"),
        ))
        if (now.agg(F.max("off")).first()[0] or 0) <= tolerance:
            return now
    off = now.agg(F.max("off")).first()[0]
    if off > 1e-6:
        raise RuntimeError(f"a source's rates are still {off:.1e} of its target away after {steps} steps")
    return now


def _moves(cells: DataFrame, state: DataFrame, most: int, mend: int, near: float) -> DataFrame:
    """state(source, goal, miss) after at most `mend` moves a source: miss, and the moves.

    cells(source, size, copies, rows) counts documents. A move changes n documents of one (size, copies) by one copy:
    those after the first `used`, which earlier moves have taken. Of all moves the one that leaves least is made.
    """
    state = state.withColumn("moves", F.array().cast("array<struct<z:bigint,c:int,by:int,used:bigint,n:bigint>>"))
    for step in range(mend):
        off = state.where(F.abs("miss") > near * F.col("goal")).select(F.col("source").alias("s"), "miss", "moves")
        could = cells.where("size > 0").join(off, F.col("source").eqNullSafe(F.col("s")))
        could = could.withColumn("used", F.expr("aggregate(filter(moves, m -> m.z = size and m.c = copies), 0L, (a, m) -> a + m.n)"))
        could = could.withColumn("n", F.least(F.col("rows") - F.col("used"), F.greatest(F.lit(1), F.round(F.abs("miss") / F.col("size")).cast("long"))))
        could = could.withColumn("left", F.abs(F.abs("miss") - F.col("n") * F.col("size")))
        could = could.where(((F.col("miss") > 0) & (F.col("copies") < most) | (F.col("miss") < 0) & (F.col("copies") > 0)) & (F.col("n") > 0) & (F.col("left") < F.abs("miss")))
        pick = could.groupBy("s").agg(F.min(F.struct("left", "n", "size", "copies", "used")).alias("p"))
        by = F.signum("miss").cast("int")
        move = F.struct(F.col("p.size").alias("z"), F.col("p.copies").alias("c"), by.alias("by"), F.col("p.used").alias("used"), F.col("p.n").alias("n"))
        made = F.col("p").isNotNull()
        state = cut(state.join(pick, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", "goal",
            F.when(made, F.col("miss") - by * F.col("p.n") * F.col("p.size")).otherwise(F.col("miss")).alias("miss"),
            F.when(made, F.concat("moves", F.array(move))).otherwise(F.col("moves")).alias("moves"),
        ))
        if state.where(F.size("moves") > step).isEmpty():
            break
    return state


def _moved(out: DataFrame, moves: DataFrame) -> DataFrame:
    """out with the moves(s, z, c, moves) made. Documents of other (source, size, copies) aren't exchanged; the others
    are numbered by parts, whose counts give each part its first number."""
    marked = out.join(small(moves), F.col("__source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("copies") == F.col("c")), "left").drop("s", "z", "c")
    cell = ["__source", "size", "copies"]
    some = marked.where("moves is not null")
    prior = Window.partitionBy(*cell).orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = some.groupBy(*cell, "__salt").agg(F.count("*").alias("n")).withColumn("skip", F.coalesce(F.sum("n").over(prior), F.lit(0)))
    parts = parts.select(F.col("__source").alias("s"), F.col("size").alias("z"), F.col("copies").alias("c"), F.col("__salt").alias("a"), "skip")
    ranked = some.withColumn("at", F.row_number().over(Window.partitionBy(*cell, "__salt").orderBy("__k")))
    same = F.col("__source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("copies") == F.col("c")) & (F.col("__salt") == F.col("a"))
    ranked = ranked.join(parts, same).withColumn("at", F.col("at") + F.col("skip"))
    by = F.expr("aggregate(filter(moves, m -> m.used < at and at <= m.used + m.n), 0, (a, m) -> a + m.by)")
    ranked = ranked.withColumn("copies", (F.col("copies") + by).cast("int"))
    return marked.where("moves is null").select(*out.columns).unionAll(ranked.select(*out.columns))


def mix_sources(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: int = 2,
    text: str = "text", source: str = "source", doc_id: str = "doc_id", mend: int = 6, near: float = 0.001,
) -> DataFrame:
    """docs with size, source_size, target, rate, copies (0 .. most), taken = copies * size, and miss: the source's
    target less all that it takes.

    mend: sizes at most, of whose documents a source that is more than `near` off its target changes some by a copy. What
    is missed after these, as where single documents are larger than the miss, is told by `miss`.
    """
    made = ("size", "source_size", "target", "rate", "copies", "taken", "miss")
    kept = {f"__c{i}": c for i, c in enumerate(docs.columns) if c != text and c not in made}
    size = F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")
    held = docs.select(*[F.col(f"`{c}`").alias(n) for n, c in kept.items()], F.col(f"`{source}`").alias("__source"), F.col(f"`{doc_id}`").alias("__id"), size.alias("__size"), F.xxhash64(F.col(f"`{text}`")).alias("__text"))
    salts_ = max(SALT, -(-docs.count() // PART))
    held = cut(held.withColumn("__salt", F.pmod(F.xxhash64("__id", "__text"), F.lit(salts_)).cast("int")))  # null and repeated ids part by their texts
    sizes = cut(held.groupBy(F.col("__source").alias("source"), F.col("__size").alias("size")).agg(F.count("*").alias("rows")))
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum("rows").alias("docs"))
    goals = targets(per, weights, share, most).join(per.select(F.col("source").alias("s"), "docs"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    solved = tilt(sizes, goals, most).select(F.col("source").alias("s"), "source_size", "target", "t", "mean", "full")
    # cumulative copies before each (source, size), longest first, then before each salt of it
    rated = sizes.join(solved, F.col("source").eqNullSafe(F.col("s"))).withColumn("x", F.when(F.col("mean") > 0, F.col("size") / F.col("mean")).otherwise(0.0))
    rated = rated.withColumn("rate", _rate(most))
    ahead = Window.partitionBy("source").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    rated = rated.select("source", "size", "source_size", "target", "rate", F.coalesce(F.sum(F.col("rate") * F.col("rows")).over(ahead), F.lit(0.0)).alias("before"))
    salts = held.groupBy("__source", "__size", "__salt").agg(F.count("*").alias("n"))
    prior = Window.partitionBy("__source", "__size").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    salts = salts.withColumn("skip", F.coalesce(F.sum("n").over(prior), F.lit(0)))
    plan = salts.join(rated, F.col("__source").eqNullSafe(F.col("source")) & (F.col("__size") == F.col("size")))
    plan = plan.select(F.col("__source").alias("s"), "size", F.col("__salt").alias("salt"), "skip", "source_size", "target", "rate", "before")
    rank = Window.partitionBy("__source", "__size", "__salt").orderBy("__id", "__text")
    ranked = held.withColumn("__k", F.row_number().over(rank))
    j = ranked.join(plan, F.col("__source").eqNullSafe(F.col("s")) & (F.col("__size") == F.col("size")) & (F.col("__salt") == F.col("salt")))
    end = F.col("before") + (F.col("skip") + F.col("__k")) * F.col("rate")
    copies = F.floor(end + 0.5 + 1e-9) - F.floor(end - F.col("rate") + 0.5 + 1e-9)
    copies = F.when(F.col("rate") >= most, F.lit(most)).otherwise(F.greatest(F.lit(0), F.least(F.lit(most), copies))).cast("int")
    out = cut(j.select(*kept, "__source", "__salt", "__k", "size", "source_size", "target", "rate", copies.alias("copies")))
    cells = cut(out.groupBy(F.col("__source").alias("source"), "size", "copies").agg(F.count("*").alias("rows"), F.max("target").alias("target")))
    miss = F.max("target") - F.sum(F.col("copies") * F.col("size") * F.col("rows"))
    state = _moves(cells, cut(cells.groupBy("source").agg(F.max("target").alias("goal"), miss.alias("miss"))), most, mend, near)
    made = state.select(F.col("source").alias("s"), F.explode("moves").alias("m")).groupBy("s", "m.z", "m.c").agg(F.collect_list("m").alias("moves"))  # mend a source at most
    made = cut(made)
    if not made.isEmpty():
        out = _moved(out, made)
    told = out.join(small(state.select(F.col("source").alias("s"), "miss")), F.col("__source").eqNullSafe(F.col("s")))
    taken = (F.col("copies") * F.col("size")).cast("long")
    return told.select(*[F.col(n).alias(c) for n, c in kept.items()], "size", "source_size", "target", "rate", "copies", taken.alias("taken"), "miss")
