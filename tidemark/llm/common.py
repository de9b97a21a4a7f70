"""Helpers that the operators share: word hashing in numpy, checkpoints, connected components."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that are hashed at once; bounds a worker's memory, not what it reads.
SLICE = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from there.

    The folder is spark.checkpoint.dir; where it is unset, a temporary one is taken if Spark runs locally (as in
    tests), and nothing else will do.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if shared is None and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return df.checkpoint()


def as_text(id_: F.Column) -> F.Column:
    """A 64-bit id on its way through pandas, which has no longs with nulls but doubles; `as_ids` reads it back."""
    return id_.cast("long").cast("string")


def as_ids(values) -> list[int | None]:
    return [int(v) if isinstance(v, str) else None for v in values]


#: Rows that go to a Python worker at once; texts are long, and a worker's memory is what a batch and its copies take.
BATCH = 1000


def small_batches(df: DataFrame) -> None:
    """Lower the session's limit of rows an Arrow batch to BATCH. It stays lowered: plans read it when they run."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH:
        conf.set(key, str(BATCH))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (splitmix64), vectorised."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def weights(n: int, seed: int = 0) -> np.ndarray:
    """n odd 64-bit multipliers."""
    base = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)
    return mix(base * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


_MULT = weights(1 << 12)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Words of several UTF-8 texts at once: (text number, start, end, 64-bit hash) and the joined bytes.

    Separators are ASCII, so splitting bytes is splitting characters.
    """
    joined = b" ".join(texts) + b" "
    data = np.frombuffer(joined, np.uint8)
    ends_of_text = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
    space = _SPACE[data]
    edge = np.diff(space.astype(np.int8), prepend=np.int8(1))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if start.size == 0:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64), joined
    owner = np.searchsorted(ends_of_text, start, side="right")
    length = end - start
    keep = np.flatnonzero(~space)
    place = keep - np.repeat(start, length)
    mult = _MULT if length.max() <= _MULT.size else weights(int(length.max()))
    value = (_LOWER[data[keep]] if lower else data[keep]).astype(np.uint64) + np.uint64(1)
    value *= mult[place]
    offset = np.concatenate(([0], np.cumsum(length)[:-1]))
    return owner, start, end, mix(np.add.reduceat(value, offset)), joined


def slices(texts: list[bytes], size: int = SLICE):
    """Index ranges of consecutive texts with about `size` bytes."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t) + 1
        if held >= size:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def utf8(values) -> list[bytes]:
    """Texts as UTF-8; null counts as empty."""
    return [v.encode("utf-8", "surrogatepass") if isinstance(v, str) else b"" for v in values]


#: Ids that may be broadcast at most (about 32 MB); more are joined by exchange.
FEW = 1_000_000


def small(df: DataFrame) -> DataFrame:
    """df, to be broadcast if it was counted to be FEW rows at most; so a hot key of the other side stays in its tasks."""
    return F.broadcast(df) if df.count() <= FEW else df


def without(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of df whose key isn't in ids(key). Spares the exchange of df where the counted ids are few."""
    ids = cut(ids.select(key).where(F.col(key).isNotNull()).distinct())
    return df.join(F.broadcast(ids) if ids.count() <= FEW else ids, key, "left_anti")


@contextmanager
def by_exchange(spark: SparkSession) -> Iterator[None]:
    """Joins that run meanwhile aren't turned into broadcasts when a side is found to be small; those marked so still are.

    Each such broadcast leaves megabytes in the driver, however few its rows, until a full collection of garbage finds
    it: a step of a hundred joins fills the driver with them, most of all on small input.
    """
    conf, key = spark.conf, "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = conf.get(key, None)
    conf.set(key, "-1")
    try:
        yield
    finally:
        if before is None:
            conf.unset(key)
        else:
            conf.set(key, before)


#: Bits of the filter of ids that spares rows an exchange: 8 MB, whatever the input.
BITS = 1 << 26


def slot(id_: F.Column) -> F.Column:
    """Place of an id in the filter; null for a null id."""
    at = F.pmod(F.xxhash64(F.lit(3), id_), F.lit(BITS)) + 1
    return F.when(id_.isNotNull(), ((F.bitmap_bucket_number(at) - 1) * 32768 + F.bitmap_bit_position(at)).cast("long"))


def bitmap(ids: DataFrame) -> np.ndarray:
    """The filter of ids(id), 8 MB at most. It may hold more than the ids, never less: an exact join must follow."""
    at = (F.pmod(F.xxhash64(F.lit(3), F.col("id")), F.lit(BITS)) + 1).alias("s")
    maps = ids.where("id is not null").select(at).groupBy(F.bitmap_bucket_number("s").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("m")).collect()
    bits = np.zeros(BITS // 8, np.uint8)
    for r in maps:
        bits[(r["b"] - 1) * 4096 : r["b"] * 4096] = np.frombuffer(r["m"], np.uint8)
    return bits


class Union:
    """Union by smallest id, for the ids that one task holds."""

    def __init__(self) -> None:
        self.up: dict = {}

    def find(self, a):
        up = self.up
        while up.setdefault(a, a) != a:
            up[a] = a = up[up[a]]
        return a

    def join(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest reachable id of every id in links(a, b): (id, component).

    Large-star and small-star steps, each an aggregation and a join; stops when the edges no longer change.
    Nothing is collected but three sums. An empty table gives an empty result.
    """
    both = links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = cut(both.distinct())
    before = None
    for _ in range(rounds):
        state = edges.agg(F.count("*"), F.sum("v"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        sym = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = sym.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.unionAll(low.select("u", F.col("m").alias("v"))).where("u > v").distinct())
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    lead = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id")
    roots = lead.select(F.col("component").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return lead.unionAll(roots)
