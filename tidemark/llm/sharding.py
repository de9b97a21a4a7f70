"""Histogram sort into shards of equal bytes (operator 4). DataFrame functions only.

Splitters are refined: each round counts the exact bytes below candidate boundaries over all partitions (one
aggregation into a bounded number of cells) and narrows each splitter's bracket to one cell, until the cell holds no
more than the tolerance or a single place. Then the rows are exchanged once, by shard and range within it; the ranges'
edges come from the same histogram, so outlying keys crowd no task.

Rows of equal or null keys are told apart by a hash, so that they may be parted between shards: the law is near-equal
bytes, whatever the keys. The order among them is arbitrary, but fixed once by a checkpoint: a task that runs again
gives the same. Documents of equal text are documents of their own here; nothing is merged, and they share no shard
unless their keys are neighbours.

Defined cases: null keys sort first; a null size counts as 0; an empty table gives an empty result; other columns are
kept, but for `shard` and `slot`, which the result names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut

CELLS = 128
#: Ranges of a shard, each numbered by a task of its own; their edges come from histograms too. There are more where a
#: range would hold more than RANGE_BYTES, up to MOST, as the driver gets counts of cells of each.
RANGES, MOST, RANGE_BYTES = 16, 256, 256_000_000
_LOWEST = -(2**63)
#: A row's place in the order is one number of 104 bits: its key, 24 bits of a hash of the row and 16 bits that tell
#: equal rows apart.
_HASH, _SALT = 1 << 24, 1 << 16
_WIDE = "decimal(38,0)"


def _numbers(rows: list[list[int]]) -> F.Column:
    return F.array(*[F.array(*[F.lit(str(n)).cast(_WIDE) for n in row]).cast(f"array<{_WIDE}>") for row in rows])


def _at_or_below(at: F.Column, numbers: F.Column) -> F.Column:
    return F.size(F.filter(numbers, lambda n: n <= at))


def splitters(df: DataFrame, at: str, size: str, parts: int, groups: int = 1, group: F.Column | None = None, tolerance: float = 1e-4) -> list[list[int]]:
    """Of each group, the lowest places of parts 1.. so that the bytes below each are as near its share as whole rows
    allow. `at` is a whole number of type decimal(38,0), group an int from 0.

    Each round counts the exact bytes in at most groups * parts * CELLS cells between the probes, and narrows each
    splitter's bracket to one cell; the driver gets these counts only. tolerance: of a part's ideal bytes; a cell that
    holds less, or a single row or place, is not refined further.
    """
    group = F.lit(0) if group is None else group
    df = df.select(F.col(at).alias("at"), F.col(size).alias("bytes"), group.cast("int").alias("g"))
    floor = lambda n: int(n) // _SALT * _SALT  # noqa: E731  (edges don't depend on what tells equal rows apart)
    ends = {r["g"]: (floor(r["low"]), floor(r["high"]) + _SALT - 1, int(r["n"] or 0)) for r in df.groupBy("g").agg(F.min("at").alias("low"), F.max("at").alias("high"), F.sum("bytes").alias("n")).collect()}
    done: dict[tuple[int, int], int] = {(g, k): 0 for g in range(groups) for k in range(1, parts) if g not in ends}
    state = {(g, k): (ends[g][0], ends[g][1], 0) for g in ends for k in range(1, parts)}
    while state:
        open_ = [sorted({b[:2] for (h, _), b in state.items() if h == g}) for g in range(groups)]
        width = [[max(1, -(-(b - a + 1) // CELLS)) for a, b in o] for o in open_]
        pick = lambda rows, i: F.get(F.get(_numbers(rows), F.col("g")), i)
        i = _at_or_below(F.col("at"), F.get(_numbers([[a for a, _ in o] for o in open_]), F.col("g"))) - 1
        x = df.withColumn("i", i).where("i >= 0").withColumns({"low": pick([[a for a, _ in o] for o in open_], F.col("i")), "high": pick([[b for _, b in o] for o in open_], F.col("i")), "w": pick(width, F.col("i"))})
        cell = F.floor((F.col("at") - F.col("low")) / F.col("w")).cast("int")
        counted = x.where("at <= high").groupBy("g", "i", F.least(cell, F.lit(CELLS - 1)).alias("cell")).agg(F.sum("bytes").alias("n"), F.count("*").alias("rows")).collect()
        cells = {(r["g"], r["i"], r["cell"]): int(r["n"]) for r in counted}
        rows = {(r["g"], r["i"], r["cell"]): r["rows"] for r in counted}
        left: dict = {}
        for (g, k), (a, b, below) in state.items():
            total = ends[g][2]
            goal, j = total * k / parts, open_[g].index((a, b))
            w, c = width[g][j], 0
            while c < CELLS - 1 and a + (c + 1) * w <= b and below + cells.get((g, j, c), 0) < goal:
                below += cells.get((g, j, c), 0)
                c += 1
            held, low, high = cells.get((g, j, c), 0), a + c * w, min(b, a + (c + 1) * w - 1)
            if low == high or rows.get((g, j, c), 0) <= 1 or held <= tolerance * total / parts:
                done[g, k] = low if goal - below <= below + held - goal else high + 1
            else:
                left[g, k] = (low, high, below)
        state = left
    return [[done[g, k] for k in range(1, parts)] for g in range(groups)]


def histogram_sort(df: DataFrame, key: str, size: str, shards: int = 16, tolerance: float = 1e-4) -> DataFrame:
    """df with shard (0 .. shards-1, contiguous in key) and slot (gapless from 0 within a shard, in key order)."""
    own = [c for c in df.columns if c not in ("shard", "slot")]
    cols = [F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(own)]
    high = F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(_LOWEST)).cast("decimal(20,0)") - F.lit(_LOWEST).cast("decimal(20,0)")
    low = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in own]), F.lit(_HASH)) * _SALT + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(_SALT))
    at = (high.cast("decimal(21,0)") * F.lit(_HASH * _SALT).cast("decimal(14,0)")).cast(_WIDE) + low.cast("decimal(14,0)").cast(_WIDE)
    held = cut(df.select(*cols, at.cast(_WIDE).alias("__at"), F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0)).alias("__bytes")))
    edges = splitters(held, "__at", "__bytes", shards, tolerance=tolerance)
    shard = _at_or_below(F.col("__at"), F.get(_numbers([sorted(edges[0])]), F.lit(0)))
    dealt = held.withColumn("__shard", shard)
    total = held.agg(F.sum("__bytes")).first()[0] or 0
    n = max(RANGES, min(MOST, -(-int(total) // shards // RANGE_BYTES)))
    ranges = splitters(dealt, "__at", "__bytes", n, shards, F.col("__shard"), 0.1)
    part = F.col("__shard") * n + _at_or_below(F.col("__at"), F.get(_numbers([sorted(r) for r in ranges]), F.col("__shard")))
    dealt = dealt.withColumn("__part", part)
    count = dealt.groupBy("__part").agg(F.count("*").alias("__n"))  # shards * MOST rows at most
    before = Window.partitionBy(F.floor(F.col("__part") / n)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offset = count.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    ranked = dealt.withColumn("__rank", F.row_number().over(Window.partitionBy("__part").orderBy("__at")))
    numbered = ranked.join(F.broadcast(offset), "__part")
    return numbered.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(own)], F.col("__shard").cast("int").alias("shard"), (F.col("__before") + F.col("__rank") - 1).cast("long").alias("slot"))
