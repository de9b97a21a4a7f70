"""Exact top-k search (operator 6) and near-duplicates among embeddings (operator 8)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Union, components, cut

# ---------------------------------------------------------------------------------------------------------------
# Exact top-k: multi-resolution segment statistics.
#
# Vectors are turned by an orthogonal transform, which changes no inner product but gathers what varies in front, and
# cut into segments: the first m components one by one, the rest into segments of L components, of which L halves from
# level to level. A segment has a mean and a deviation. By Cauchy-Schwarz in every segment the squared distance of two vectors is at least the sum of
# L * ((difference of means)^2 + (difference of deviations)^2); with both norms known, that is an upper bound of the
# inner product: the sum of L * (product of means + product of deviations), where a segment of one component is its own
# mean. From coarse to fine, m grows and L shrinks, and pairs whose bound is below the query's k-th best score so far drop out; only
# survivors get the exact integer product.

#: Bytes of queries that a pass over the rows carries at most; a broadcast of this bound.
CHUNK = 32_000_000
#: Queries among which first scores are looked for and the transform is found; rows and queries that are compared at
#: once, which bound a worker's arrays whatever the number of queries.
SEEDS, ROWS, QUERIES = 4096, 512, 2048
#: Shares of the components that stand one by one, coarse to fine; segments of all components at the coarsest level.
LEVELS, COARSE = (0.0, 0.125, 0.25, 0.5, 0.625, 0.75, 0.875), 4


def quantise(vectors: DataFrame, scale: int, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, x): floor(scale * component), components as doubles. Vectors that are null, or hold a null or a
    component that is not finite, go; so do rows without an id."""
    good = F.col(embedding).isNotNull() & F.forall(embedding, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    held = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias(embedding))
    return held.where(good & F.col("vec_id").isNotNull()).select("vec_id", F.transform(embedding, lambda c: F.floor(c * scale).cast("double")).alias("x"))


def _statistics(x: np.ndarray, single: int, length: int) -> np.ndarray:
    """Columns whose products, beside those of the first `single` components, bound the inner products from above:
    sqrt(L) * mean and sqrt(L) * deviation of each segment of `length` components of the rest, the last one shorter."""
    rest = x[:, single:]
    if not rest.shape[1]:
        return np.zeros((len(x), 0))
    start = np.arange(0, rest.shape[1], length)
    size = np.diff(start, append=rest.shape[1])
    total = np.add.reduceat(rest, start, axis=1)
    apart = rest - np.repeat(total / size, size, axis=1)
    return np.concatenate([total / np.sqrt(size), np.sqrt(np.add.reduceat(apart * apart, start, axis=1))], 1)


def _levels(dim: int) -> list[tuple[int, int]]:
    """(components one by one, length of the others' segments), coarse to fine: lengths halve, down to two."""
    singles = sorted({int(dim * share) for share in LEVELS})
    return [(m, max(2, -(-dim // COARSE) >> k)) for k, m in enumerate(singles)]


def _transform(x: np.ndarray) -> np.ndarray:
    """Orthogonal directions of x, those with most energy first."""
    return np.linalg.eigh(x.T @ x)[1][:, ::-1]


def _exact(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows of whole numbers: doubles where these hold them exactly, else Python's integers."""
    top = max(np.abs(queries).max(initial=0), np.abs(rows).max(initial=0))
    if top * top * max(1, rows.shape[1]) < 2**53:
        return np.einsum("ij,ij->i", rows, queries)
    return np.array([sum(int(a) * int(b) for a, b in zip(r, q, strict=True)) for r, q in zip(rows, queries, strict=True)], object)


class Search:
    """Queries of one length, with what bounds need of them and the k-th best score that each is known to reach."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int):
        self.ids, self.x, self.k = ids, x, k
        self.turn = _transform(x[:SEEDS]) if x.shape[1] else np.zeros((0, 0))
        self.y = x @ self.turn
        self.levels = [(m, length, _statistics(self.y, m, length)) for m, length in _levels(x.shape[1])]
        self.norm = np.sqrt((x * x).sum(1))
        self.least = np.full(len(ids), -np.inf)

    def survivors(self, rows: np.ndarray, rid: np.ndarray, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row) that may be among a query's k best, of the queries first to last; every pair that is, is
        here."""
        y, of = rows @ self.turn, slice(first, len(self.ids) if last is None else last)
        slack = 1e-9 * (1 + np.sqrt((rows * rows).sum(1))[:, None] * self.norm[None, of])
        open_ = rid[:, None] != self.ids[None, of]
        held, done = np.zeros(open_.shape), 0
        for m, length, stats in self.levels:
            held += y[:, done:m] @ self.y[of, done:m].T
            done = m
            open_ &= held + _statistics(y, m, length) @ stats[of].T + slack >= self.least[of]
            if not open_.any():
                break
        at = np.nonzero(open_)
        return at[1] + first, at[0]

    def best(self, rows: np.ndarray, rid: np.ndarray) -> list[tuple[int, int, int]]:
        """(query number, row id, score) of each query's k best rows but itself, fewer where others are known to be
        better: larger score, then smaller id. What is found raises the bar for the rows that follow."""
        out: list[tuple[int, int, int]] = []
        for a, b in ((a, b) for a in range(0, len(rows), ROWS) for b in range(0, len(self.ids), QUERIES)):
            part, ids = rows[a : a + ROWS], rid[a : a + ROWS]
            q, r = self.survivors(part, ids, b, min(b + QUERIES, len(self.ids)))
            score = np.concatenate([_exact(part[r[i : i + 65536]], self.x[q[i : i + 65536]]) for i in range(0, len(q), 65536)] or [np.zeros(0)])
            order = np.lexsort((ids[r], -score, q)) if score.dtype != object else np.array(sorted(range(len(q)), key=lambda i: (q[i], -score[i], ids[r[i]])), int)
            q, r, score = q[order], r[order], score[order]
            first = np.searchsorted(q, q, "left")
            keep = np.arange(len(q)) - first < self.k
            out += zip(q[keep].tolist(), ids[r[keep]].tolist(), [int(v) for v in score[keep]], strict=True)
            kth = np.flatnonzero(np.arange(len(q)) - first == self.k - 1)
            for i, v in zip(q[kth].tolist(), score[kth].tolist(), strict=True):
                self.least[i] = max(self.least[i], float(v) - 1e-6 * abs(float(v)) if score.dtype == object else v)
        out.sort(key=lambda t: (t[0], -t[2], t[1]))
        number = np.array([t[0] for t in out])
        return [t for t, n in zip(out, np.arange(len(out)) - np.searchsorted(number, number, "left"), strict=True) if n < self.k]


def _searches(rows: list[tuple[int, bytes]], k: int) -> dict[int, Search]:
    """Of (id, vector as doubles): a search for each length, with first scores from among the queries themselves - they
    are rows too, so what a query reaches there it reaches among all."""
    by: dict[int, list] = {}
    for i, b in rows:
        by.setdefault(len(b) // 8, []).append((i, np.frombuffer(b)))
    out = {}
    for dim, some in by.items():
        s = Search(np.array([i for i, _ in some]), np.stack([x for _, x in some]).reshape(len(some), dim), k)
        seeds, ids = s.x[:SEEDS], s.ids[:SEEDS]
        for a in range(0, len(s.ids), ROWS):
            score = s.x[a : a + ROWS] @ seeds.T
            score[s.ids[a : a + ROWS, None] == ids[None, :]] = -np.inf
            if len(seeds) > k:
                score.partition(score.shape[1] - k, axis=1)
                kth = score[:, -k]
                s.least[a : a + ROWS] = np.where(np.isfinite(kth), kth - 1e-9 * (1 + np.abs(kth)), -np.inf)
        out[dim] = s
    return out


def top_k(vectors: DataFrame, every: int = 100, k: int = 10, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows of each query; queries: ids divisible by `every`.

    Queries are taken in chunks of CHUNK bytes. A pass over the rows carries one chunk to them, so rows are never
    exchanged; each task returns at most k rows a query, and only those that beat the k-th score known, which are
    ranked at last. Passes follow each other and write their finds, so a lost executor repeats tasks, not passes.
    Scores beyond 64 bits are null.

    Defined cases: vectors of different length aren't compared; repeated ids are rows of their own as candidates (but
    for the query's own id) and one query; fewer than k candidates give all; empty tables give empty results; further
    columns of any name are left out.
    """
    held = cut(quantise(vectors, scale))
    asked = held.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("x").alias("x"))
    size = asked.agg(F.sum(8 * F.size("x") + 64)).first()[0] or 0
    chunks = max(1, -(-size // (CHUNK // 2)))  # of half the bound on average; more than the bound raises
    asked = cut(asked.withColumn("chunk", F.pmod(F.xxhash64(F.lit(2), "vec_id"), F.lit(chunks)).cast("int")))
    schema = "query_id long, vec_id long, score long"
    found = []
    for c in range(chunks):
        rows = [(r["vec_id"], np.array(r["x"]).tobytes()) for r in asked.where(F.col("chunk") == c).select("vec_id", "x").collect()]
        if sum(len(b) for _, b in rows) > CHUNK:
            raise RuntimeError("a chunk of queries is larger than its bound")
        if not rows:
            continue
        shared = held.sparkSession.sparkContext.broadcast(sorted(rows))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            searches, out = _searches(shared.value, k), {}
            for batch in batches:
                ids, x = batch.column(0).to_numpy(), batch.column(1)
                size = np.diff(x.offsets.to_numpy())
                flat = x.flatten().to_numpy()
                start = np.cumsum(size) - size
                for dim in np.unique(size).tolist():
                    if dim in searches:
                        at = np.flatnonzero(size == dim)
                        rows = flat[(start[at][:, None] + np.arange(dim)[None, :])].reshape(len(at), dim)
                        for q, r, v in searches[dim].best(rows, ids[at]):
                            out.setdefault((dim, q), []).append((-v, r))
                for key in [key for key, v in out.items() if len(v) > 4 * k]:
                    out[key] = sorted(out[key])[:k]
            rows = [(int(searches[d].ids[q]), r, -v if abs(v) < 2**63 else None) for (d, q), vs in out.items() for v, r in sorted(vs)[:k]]
            yield pa.RecordBatch.from_arrays([pa.array([t[i] for t in rows], pa.int64()) for i in range(3)], ["query_id", "vec_id", "score"])

        part = held.mapInArrow(run, schema)
        found.append(cut(part) if chunks > 1 else part)
    if not found:
        return held.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    got = reduce(DataFrame.unionAll, found)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = got.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


# ---------------------------------------------------------------------------------------------------------------
# Near-duplicates: sorted projection passes.

#: Rows of one component that are compared with as many others in a task, STRIP of them at once.
BLOCK = 2048
STRIP = 512


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(n == 0, 1, n)


def _distinct(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, key, x): rows that take part. key: digest of label and vector, equal for equal vectors."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for v, x, label in zip(p["vec_id"].tolist(), p["x"], p["label"].tolist(), strict=True):
                y = np.asarray(x, np.float64) + 0.0  # one zero, not two
                big = np.abs(y).max(initial=0)
                if big > 0:
                    u = y / big  # so that squares neither overflow nor vanish
                    out.append((v, str(label), hashlib.blake2b(str(label).encode() + b"\0" + y.tobytes(), digest_size=16).hexdigest(), u / np.sqrt((u * u).sum())))
            yield pd.DataFrame(out, columns=["vec_id", "label", "key", "x"])

    good = F.col("x").isNotNull() & (F.size("x") > 0) & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.where(good & F.col("label").isNotNull() & F.col("vec_id").isNotNull()).mapInPandas(run, "vec_id long, label string, key string, x array<double>")


def _codes(x: np.ndarray, passes: int, bits: int, seed: int) -> np.ndarray:
    """passes codes of each row: the signs of `bits` random projections, concatenated."""
    planes = np.random.default_rng([seed, x.shape[1]]).standard_normal((x.shape[1], passes * bits))
    signs = (x @ planes > 0).reshape(len(x), passes, bits)
    return signs @ (np.int64(1) << np.arange(bits - 1, -1, -1, dtype=np.int64))


def _windows(tag: np.ndarray, ids: np.ndarray, x: np.ndarray, window: int, least: float, fresh: int = 0, wide: int = 0) -> tuple[list[tuple[int, int]], list[int]]:
    """Links among rows of one tag that unite them, from row `fresh` on, and the rows whose reach goes on behind the last.

    Rows within `window` of each other are compared. A row that united anything reaches `window` rows further, on both
    sides, and again as long as that unites something: so a hub sees all the copies that crowd around it, and the work
    stays in proportion to rows and unions. The first `wide` rows are such rows of an earlier batch.
    """
    union, out, grown, n = Union(), [], set(), len(ids)

    def unites(row: int, others: np.ndarray) -> bool:
        new = [o for o in others.tolist() if union.join(row, o)]
        out.extend((int(ids[row]), int(ids[o])) for o in new)
        return bool(new)

    for d in range(1, min(window, n - 1) + 1):
        low = max(0, fresh - d)
        hit = np.flatnonzero((tag[low:-d] == tag[low + d :]) & (np.einsum("ij,ij->i", x[low:-d], x[low + d :]) >= least)) + low
        for row in hit.tolist():
            if unites(row, np.array([row + d])):
                grown |= {row, row + d}
    starts = np.concatenate([[0], np.flatnonzero(tag[1:] != tag[:-1]) + 1])
    stops, open_ = np.append(starts[1:], n), []
    for row in sorted(grown | set(range(wide))):
        run = np.searchsorted(starts, row, "right") - 1
        first, last = int(starts[run]), int(stops[run])
        at = max(row + window + 1, fresh if row < wide else 0)
        while at < last and unites(row, at + np.flatnonzero(x[at : min(at + window, last)] @ x[row] >= least)):
            at += window
        if at >= last == n:
            open_.append(row)
        at = row - window if row >= wide else first
        while at > first and unites(row, max(first, at - window) + np.flatnonzero(x[max(first, at - window) : at] @ x[row] >= least)):
            at -= window
    return out, open_


def _tally(a: pd.DataFrame, b: pd.DataFrame | None, least: float) -> list[tuple[int, int]]:
    """(rep, links) of the rows of a with those of b, or with each other."""
    alone = b is None
    b = a if alone else b
    if not len(a) or not len(b):
        return []
    x, y = np.stack(a["x"].to_list()), np.stack(b["x"].to_list())
    many, na, nb = [d["many"].to_numpy() for d in (a, b)], np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    for k in range(0, len(a), STRIP):
        hit = x[k : k + STRIP] @ y.T >= least
        if alone:
            at = np.arange(len(hit))
            hit[at, k + at] = False
        na[k : k + STRIP] = hit @ many[1]
        nb += many[0][k : k + STRIP] @ hit
    counts = [(a, na)] if alone else [(a, na), (b, nb)]
    return [(r, n) for d, m in counts for r, n in zip(d["rep"].tolist(), m.tolist(), strict=True)]


def _passes(rows: int, least: float, window: int, miss: float) -> int:
    """Passes after which a link of cosine `least` among so many rows of a label is missed with a chance of `miss`.

    Two vectors at angle t agree in a bit with chance 1 - t / pi, and stand within the window when they agree in as many
    bits as part the label's rows into windows.
    """
    agree = (1 - np.arccos(np.clip(least, -1, 1)) / np.pi) ** max(0.0, np.log2(max(rows, 1) / window))
    return max(1, int(np.ceil(np.log(miss) / np.log(max(1e-300, 1 - min(agree, 1 - 1e-9))))))


def near_duplicates(vectors: DataFrame, least: float = 0.93, window: int = 48, miss: float = 1e-4, bits: int = 40, seed: int = 5) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row; rows with the same non-null label and a cosine of at least
    `least` link.

    1. Equal vectors of one label become one row with a count.
    2. In each pass the rows are ordered lexicographically by label and the concatenated signs of `bits` random
       projections, by a range exchange and a sort; neighbours within `window` are compared by their true cosine, also
       across the borders of partitions, and further as long as that unites rows (within a partition). The number of
       passes grows with the largest label so that a link of cosine `least` is missed with a chance of about `miss`.
    3. The links of all passes are united by connected components.
    4. Links are counted among the rows of a component, a large one in blocks of BLOCK x BLOCK. The work of this step is
       the square of a component's different vectors, not of a label's rows.

    A link that no pass and no chain of links unites is missed.
    Defined cases: vectors that are null, zero or hold null or non-finite components, null labels and null ids link with nothing and are components of their
    own; vectors of different length aren't compared; repeated ids get the same result; empty tables, empty results;
    further columns of any name are left out.
    """
    held = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"), F.col("label"))
    rows = cut(_distinct(held))
    dim = F.size("x")
    reps = cut(rows.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("many"), F.first("label").alias("label"), F.first("x").alias("x")))

    def code(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for _, g in p.groupby("dim"):
                x = np.stack(g["x"].to_list())
                codes = _codes(x, passes, bits, seed)
                x = [r.astype(np.float64).tobytes() for r in x]
                for k in range(passes):
                    yield pd.DataFrame({"tag": [f"{k}\x1f{d}\x1f{s}" for d, s in zip(g["dim"], g["label"], strict=True)], "code": codes[:, k], "rep": g["rep"].to_numpy(), "x": x})

    largest = reps.groupBy("label", dim).count().agg(F.max("count")).first()[0] or 0
    passes = _passes(largest, least, window, miss)
    coded = reps.select("rep", "label", "x", dim.alias("dim")).mapInPandas(code, "tag string, code long, rep long, x binary")
    total = reps.count() * passes
    parts = max(1, min(100_000, -(-total // 50_000)))

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid = TaskContext.get().partitionId()
        tail = wide = None
        columns = ["a", "b", "part", "place", "tag", "x"]
        for p in batches:
            if not len(p):
                continue
            now = p[["tag", "rep", "x"]]
            if tail is None:
                head = now.head(window)
                yield pd.DataFrame({"a": head["rep"].to_numpy(), "b": 0, "part": pid, "place": np.arange(len(head)), "tag": head["tag"].to_numpy(), "x": head["x"].to_numpy()})[columns]
                tail = wide = now.head(0)
            held = pd.concat([wide, tail, now], ignore_index=True)
            goes_on = []
            # vectors of one tag have one length; others never meet
            for _, g in held.groupby(held["x"].map(len).to_numpy()):
                at = g.index.to_numpy()
                older, fresh = int((at < len(wide)).sum()), int((at < len(wide) + len(tail)).sum())
                links, open_ = _windows(g["tag"].to_numpy(), g["rep"].to_numpy(), np.stack([np.frombuffer(b, np.float64) for b in g["x"]]), window, least, fresh, older)
                goes_on += at[open_].tolist()
                yield pd.DataFrame(links, columns=["a", "b"]).assign(part=-1, place=0, tag="", x=None)[columns]
            last = pd.concat([tail, now], ignore_index=True)
            tail = last.tail(window)
            wide = held.loc[[i for i in sorted(goes_on) if i < len(held) - len(tail) and held.at[i, "tag"] == held["tag"].iloc[-1]]]
        if tail is not None:
            yield pd.DataFrame({"a": tail["rep"].to_numpy(), "b": 0, "part": pid, "place": np.arange(-len(tail), 0), "tag": tail["tag"].to_numpy(), "x": tail["x"].to_numpy()})[columns]

    swept = cut(coded.repartitionByRange(parts, "tag", "code", "rep").sortWithinPartitions("tag", "code", "rep").mapInPandas(sweep, "a long, b long, part int, place int, tag string, x binary"))
    edge = swept.where("part >= 0")
    nums = edge.select("part").distinct().withColumn("nth", F.row_number().over(Window.orderBy("part")))  # one row a partition
    border = edge.join(F.broadcast(nums), "part").select("a", "tag", "x", "place", (F.col("nth") - F.when(F.col("place") >= 0, 1).otherwise(0)).alias("border"))

    def meet(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("place")
        out = []
        for _, g in p.groupby("tag"):
            links = _windows(g["tag"].to_numpy(), g["a"].to_numpy(), np.stack([np.frombuffer(b, np.float64) for b in g["x"]]), window, least)[0]
            out += links
        return pd.DataFrame(out, columns=["a", "b"])

    links = swept.where("part = -1").select("a", "b").unionAll(border.groupBy("border").applyInPandas(meet, "a long, b long"))
    comp = cut(components(links))
    inside = reps.join(comp, F.col("rep") == F.col("id")).select("component", "rep", "many", "x")
    sizes = cut(inside.groupBy("component").agg(F.count("*").alias("rows"), F.ceil(F.count("*") / BLOCK).cast("int").alias("n")))
    own = inside.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("n")).cast("int"))
    met = own.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    met = met.select("component", "rep", "many", "x", "own", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"))
    copies = sizes.agg(F.sum(F.col("n") * F.col("rows"))).first()[0] or 0
    bucket = F.pmod(F.xxhash64("component", "i", "j"), F.lit(max(1, -(-int(copies) // BLOCK))))

    def tally(p: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, i, j), g in p.groupby(["component", "i", "j"]):
            out += _tally(g[g["own"] == i], None if i == j else g[g["own"] == j], least)
        return pd.DataFrame(out, columns=["rep", "n"])

    counts = met.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(tally, "rep long, n long").groupBy("rep").agg(F.sum("n").alias("n"))
    found = reps.select("key", "rep", "many").join(counts, "rep", "left").join(comp, F.col("rep") == F.col("id"), "left")
    found = found.select("key", (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    told = rows.select("vec_id", "key").join(found, "key").groupBy("vec_id").agg(F.max("n").alias("n"), F.min("c").alias("c"))
    out = held.select("vec_id").join(told.withColumnRenamed("vec_id", "v"), F.col("vec_id") == F.col("v"), "left")
    component = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
