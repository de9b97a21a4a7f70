"""N-gram Jaccard join by a token-group matrix (operator 7).

Similar documents are put into groups, each group has the union of its members' shingles as a row of the token-group
matrix, the overlap of a query with a union bounds its overlap with every member, and only groups that qualify are
opened. Spread over a cluster:

1. Equal shingle sets become one node (pre-aggregation: groups of exact copies shrink to one row).
2. Grouping: nodes that share a band of min-hashes are compared with their bucket's leaders, at most BLOCK nodes a
   task; those at the threshold or above join the leader's star, whose members are thus linked. Three bands, each over
   the leaders left. Three more put stars whose leaders are at half the threshold into one group.
3. Candidates between groups, exact: a pair at the threshold shares several shingles of both prefixes (rarest first by
   a fixed order), so an equi-join of the matrix's prefix rows (shingle, group) finds every pair of groups that can
   hold a link, whatever step 2 missed. Many similar texts that aren't linked share a group, and make no pairs here.
4. Opening: each candidate group's members and the documents that query it meet in blocks of BLOCK x BLOCK; there the
   matrix of sub-groups bounds the overlap and qualifying sub-groups are compared exactly. A group is also opened for
   its own documents outside its largest star.
5. Connected components over the links between stars.

Links that span a component are enough, so copies aren't expanded: a block passes over what it has already joined.
Shingles are 64-bit hashes; of these 48 bits are sent where sets are compared.

Defined cases: null or empty texts have no shingles and are linked with nothing; a text of fewer than n words has one
shingle, all its words; rows with a null doc_id keep their row, take no part and have a null component; rows that
repeat a doc_id count as that document; an empty table gives an empty result; other columns of docs aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Union, as_ids, as_text, bitmap, components, cut, mix, slices, slot, small, small_batches, weights, words

BANDS, BAND_ROWS = 3, 3
#: Rows of one side that meet in a task at once.
BLOCK = 512
#: Leaders that a bucket tries in a band; what fits none of them is left to step 3.
LEADERS = 8
#: Shingles that two prefixes must share: one, and one more for every STEP shingles of the smaller set, up to SHARED.
SHARED, STEP = 12, 64
#: Frequent shingles whose order is broadcast; the order of any others is by hash. It bears on speed, not on results.
FREQUENT = 100_000
_W = weights(64, 7)
_SEEDS = weights(BANDS * BAND_ROWS, 11)


def shingle_sets(texts: list[bytes], n: int, lower: bool = True) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's n-word shingles."""
    owner, _, _, h, _ = words(texts, lower)
    edge = np.searchsorted(owner, np.arange(len(texts) + 1))
    if len(h) >= n:
        grams = np.zeros(len(h) - n + 1, np.uint64)
        for k in range(n):
            grams += h[k : len(h) - n + 1 + k] * _W[k]
        grams = mix(grams).view(np.int64)
    out = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        if b - a >= n:
            s = np.sort(grams[a : b - n + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif b > a:
            short = (h[a:b] * _W[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([short ^ np.uint64(0x5BD1E995)])).view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def _sets(part: pd.DataFrame, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row number, shingle set) of a batch with the column text as bytes, 4 MB of text at a time."""
    texts = [t if isinstance(t, (bytes, bytearray)) else b"" for t in part["text"]]
    for a, b in slices(texts):
        yield from zip(range(a, b), shingle_sets([bytes(t) for t in texts[a:b]], n), strict=True)


def _bands(s: np.ndarray) -> list[int]:
    u = s.view(np.uint64)
    low = [int(mix(u ^ seed).min()) for seed in _SEEDS]
    groups = [np.array(low[k * BAND_ROWS : (k + 1) * BAND_ROWS], np.uint64) for k in range(BANDS)]
    return [int(mix((g * _W[:BAND_ROWS]).sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0]) for g in groups]


def _describe(docs: DataFrame, n: int) -> DataFrame:
    """A row of each document - size, digest of the set, bands - and shingles frequent within a partition."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count: dict[int, int] = {}
        seen: set[bytes] = set()
        rows = 0
        for p in parts:
            out, fresh = [], []
            ids = as_ids(p["doc_id"])
            for i, s in _sets(p, n):
                d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                out.append((ids[i], len(s), d.hex(), _bands(s) if len(s) else [0] * BANDS))
                if d not in seen:
                    seen.add(d)
                    fresh.append(s)
                if len(seen) > 1_000_000:
                    seen.clear()
            if fresh:
                rows += len(fresh)
                t, c = np.unique(np.concatenate(fresh), return_counts=True)
                for k, v in zip(t[c >= 2].tolist(), c[c >= 2].tolist(), strict=True):
                    count[k] = count.get(k, 0) + v
                if len(count) > 2_000_000:
                    count = {k: v for k, v in count.items() if v >= 16}
            f = pd.DataFrame(out, columns=["doc_id", "n", "digest", "bands"])
            f["doc_id"], f["bands"] = pd.array([r[0] for r in out], "Int64"), f["bands"].astype(object)
            yield f.assign(token=pd.array([pd.NA] * len(f), "Int64"), df=0)
        least = max(6, rows // 5000)
        often = [(k, v) for k, v in count.items() if v >= least]
        f = pd.DataFrame({"token": pd.array([k for k, _ in often], "Int64"), "df": [v for _, v in often]})
        yield f.assign(doc_id=pd.array([pd.NA] * len(f), "Int64"), n=0, digest="", bands=pd.Series([[]] * len(f), dtype=object, index=f.index))[["doc_id", "n", "digest", "bands", "token", "df"]]

    told = docs.select(as_text(F.col("doc_id")).alias("doc_id"), "text")
    return told.mapInPandas(run, "doc_id long, n long, digest string, bands array<long>, token long, df long")


def _prefixes(docs: DataFrame, n: int, percent: int, order: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(doc_id, n, prefix): the shingles of each set that come first in the order (count if frequent else 0, hash)."""
    shared = docs.sparkSession.sparkContext.broadcast(order)  # FREQUENT pairs of numbers at most

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        token, df = shared.value
        for p in parts:
            out = []
            ids = p["doc_id"].tolist()
            for i, s in _sets(p, n):
                if len(s):
                    length = min(len(s), len(s) - -(-percent * len(s) // 100) + min(SHARED, 1 + len(s) // STEP))
                    w = np.zeros(len(s), np.int64)
                    if len(token):
                        at = np.minimum(np.searchsorted(token, s), len(token) - 1)
                        w = np.where(token[at] == s, df[at], 0)
                    out.append((int(ids[i]), len(s), s[np.lexsort((s, w))[:length]]))
            yield pd.DataFrame(out, columns=["doc_id", "n", "prefix"])

    return docs.where("doc_id is not null").mapInPandas(run, "doc_id long, n long, prefix array<long>")


def _pack(s: np.ndarray) -> bytes:
    """48 bits of each hash, sorted."""
    low = np.sort(s & np.int64(2**48 - 1)).astype("<i8")
    return low.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.view("<i8").ravel()


def _fetch(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """ids(node, ...), a row or more a node, with n and tokens of the documents.

    A bitmap of hashed ids, of a fixed 8 MB, spares most other documents the work and the exchange; an exact join
    follows, so a full bitmap costs time, not results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(ids.select(F.col("node").alias("id"))))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        b = shared.value
        for p in parts:
            s = p["slot"].to_numpy()
            hit = (b[s >> 3] >> (s & 7).astype(np.uint8)) & 1
            p = p[hit.astype(bool)]
            if len(p):
                ids_ = p["doc_id"].tolist()
                rows = [(int(ids_[i]), len(x), _pack(x)) for i, x in _sets(p, n)]
                yield pd.DataFrame(rows, columns=["node", "n", "tokens"])

    asked = docs.where("doc_id is not null").select("doc_id", "text", slot(F.col("doc_id")).alias("slot"))
    got = asked.mapInPandas(run, "node long, n long, tokens binary")
    return got.dropDuplicates(["node", "n"]).join(ids, "node")


def _link(s: np.ndarray, flat: np.ndarray, start: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which sets (joined in flat) are at the threshold with s."""
    at = np.minimum(np.searchsorted(s, flat), len(s) - 1)
    inter = np.add.reduceat((s[at] == flat).astype(np.int64), start)
    return 100 * inter >= percent * (len(s) + sizes - inter)


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(s) for s in sets])
    return np.concatenate(sets), np.cumsum(sizes) - sizes, sizes


def _stars(nodes: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """(node, smaller leader) of nodes that are at the threshold with one of the first leaders."""
    left = sorted(range(len(nodes)), key=nodes.__getitem__)
    out = []
    for _ in range(LEADERS):
        if len(left) < 2:
            break
        lead, rest = left[0], left[1:]
        hit = _link(sets[lead], *_flat([sets[i] for i in rest]), percent)
        out += [(nodes[i], nodes[lead]) for i, h in zip(rest, hit, strict=True) if h]
        left = [i for i, h in zip(rest, hit, strict=True) if not h]
    return out


def _open(members: list[tuple[int, np.ndarray]], guests: list[tuple[int, np.ndarray]], percent: int) -> list[tuple[int, int]]:
    """Links of the guests' stars with the members' by the matrix of sub-groups; a spanning set of them. Rows: (star, set)."""
    order = sorted(range(len(members)), key=lambda i: (int(members[i][1][0]), len(members[i][1])))
    groups = [order[k : k + 16] for k in range(0, len(order), 16)]
    union = [np.unique(np.concatenate([members[i][1] for i in g])) for g in groups]
    token = np.concatenate(union)
    column = np.repeat(np.arange(len(groups)), [len(u) for u in union])
    by = np.argsort(token, kind="stable")
    token, column = token[by], column[by]
    joined, out = Union(), []
    for star, s in guests:
        low, high = np.searchsorted(token, s, "left"), np.searchsorted(token, s, "right")
        n = high - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        bound = np.bincount(column[at], minlength=len(groups))
        need = -(-percent * len(s) // 100)
        for g in np.flatnonzero(bound >= need):
            own = joined.find(star)
            left = [i for i in groups[g] if joined.find(members[i][0]) != own]
            if left:
                for k in np.flatnonzero(_link(s, *_flat([members[i][1] for i in left]), percent)):
                    if joined.join(star, members[left[k]][0]):
                        out.append((star, members[left[k]][0]))
    return out


def _group(nodes: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Step 2: (node, comp, cluster), the star and the group of nodes that share a band."""
    keys = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    full = keys.groupBy("band", "key").agg(F.count("*").alias("c")).where("c > 1")
    shared = cut(keys.join(full.select("band", "key"), ["band", "key"], "left_semi"))
    tokens = cut(_fetch(docs, shared.select("node").distinct(), n))
    rows_of = {r["band"]: r["c"] for r in shared.groupBy("band").agg(F.count("*").alias("c")).collect()}  # BANDS rows

    def gather(now: DataFrame, band: int, least: int) -> DataFrame:
        """now(node, lead) after the leaders that share a key of the band have been compared."""

        def run(p: pd.DataFrame) -> pd.DataFrame:
            out = []
            for _, g in p.groupby(["key", "sub"]):
                if len(g) > 1:
                    out += _stars(g["node"].tolist(), [_unpack(t) for t in g["tokens"]], least)
            return pd.DataFrame(out, columns=["node", "lead"])

        leads = now.where("node = lead").select("node")
        own = shared.where(F.col("band") == band).join(leads, "node", "left_semi").select("node", "key")
        sized = own.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
        dealt = own.join(sized, "key").withColumn("sub", F.pmod(F.xxhash64("node"), F.ceil(F.col("c") / BLOCK)))
        bucket = F.pmod(F.xxhash64("key", "sub"), F.lit(max(1, -(-rows_of.get(band, 0) // 500))))
        rows = dealt.join(tokens, "node").select("key", "sub", "node", "tokens", bucket.alias("bucket"))
        moved = rows.groupBy("bucket").applyInPandas(run, "node long, lead long").withColumnRenamed("node", "lead0").withColumnRenamed("lead", "lead1").groupBy("lead0").agg(F.min("lead1").alias("lead1"))
        return cut(now.join(moved, F.col("lead") == F.col("lead0"), "left").select("node", F.coalesce("lead1", "lead").alias("lead")))

    stars = tokens.select("node", F.col("node").alias("lead")).distinct()
    for band in range(BANDS):
        stars = gather(stars, band, percent)
    groups = stars.where("node = lead")
    for band in range(BANDS):
        groups = gather(groups, band, percent // 2)
    return stars.withColumnRenamed("lead", "comp").join(groups.select(F.col("node").alias("comp"), F.col("lead").alias("cluster")), "comp")


def jaccard_join(docs: DataFrame, n: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row of each document: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    Two documents link when 100 * shared shingles >= percent * all their shingles.
    """
    small_batches(docs)
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text"))
    told = cut(_describe(docs, n))
    sets = told.where("token is null").select("doc_id", "n", "digest", "bands")
    often = told.where("token is not null").groupBy("token").agg(F.sum("df").alias("df")).orderBy(F.desc("df"), "token").limit(FREQUENT).toPandas()
    often = often.sort_values("token")
    order = (often["token"].to_numpy(np.int64), often["df"].to_numpy(np.int64))
    whole = sets.where("n > 0 and doc_id is not null")
    nodes = cut(whole.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands")))
    lead = _group(nodes, docs, n, percent)
    member = nodes.join(lead, "node", "left")
    member = cut(member.select("digest", "node", "n", F.coalesce("comp", "node").alias("comp"), F.coalesce("cluster", "comp", "node").alias("cluster")))
    # step 3
    prefix = _prefixes(docs, n, percent, order).withColumnRenamed("doc_id", "node").join(member.select("node", "cluster").distinct(), "node")
    matrix = prefix.select("cluster", "n", F.explode("prefix").alias("token")).groupBy("token", "cluster").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    a, b = matrix.alias("a"), matrix.alias("b")
    near = (F.col("a.token") == F.col("b.token")) & (F.col("a.cluster") < F.col("b.cluster")) & (F.col("a.least") * percent <= F.col("b.most") * 100) & (F.col("b.least") * percent <= F.col("a.most") * 100)
    pairs = a.join(b, near).groupBy(F.col("a.cluster").alias("a"), F.col("b.cluster").alias("b")).agg(F.count("*").alias("c"), F.min(F.least("a.least", "b.least")).alias("m"))
    pairs = cut(pairs.where(F.col("c") >= F.least(F.lit(SHARED), 1 + F.floor(F.col("m") / STEP), F.ceil(F.col("m") * percent / 100))).select("a", "b"))
    # step 4: the larger group is opened for the documents of the smaller one, and for its own outside its largest star
    stars = member.groupBy("cluster", "comp").agg(F.countDistinct("node").alias("k"))
    size = cut(stars.groupBy("cluster").agg(F.sum("k").alias("size"), F.max(F.struct("k", "comp")).alias("top")).select("cluster", "size", "top.comp", (F.col("size") - F.col("top.k")).alias("rest")).withColumnRenamed("comp", "main"))
    held = cut(size.join(pairs.select(F.col("a").alias("cluster")).unionAll(pairs.select(F.col("b").alias("cluster"))).distinct(), "cluster", "left_semi").select("cluster", "size"))
    of = lambda c, n: small(held).select(F.col("cluster").alias(c), F.col("size").alias(n))
    sided = pairs.join(of("a", "sa"), "a").join(of("b", "sb"), "b")
    sided = sided.select(F.when(F.col("sa") >= F.col("sb"), F.col("a")).otherwise(F.col("b")).alias("host"), F.when(F.col("sa") >= F.col("sb"), F.col("b")).otherwise(F.col("a")).alias("guest"), F.greatest("sa", "sb").alias("hosts"), F.least("sa", "sb").alias("guests"))
    sided = cut(sided.unionByName(size.where("rest > 0").select(F.col("cluster").alias("host"), F.col("cluster").alias("guest"), F.col("size").alias("hosts"), F.col("rest").alias("guests"))))
    needed = sided.select(F.col("host").alias("cluster")).unionAll(sided.select(F.col("guest").alias("cluster"))).distinct()
    # what is unique by group is broadcast where it was counted to be small, so that a large group's rows stay apart
    main = cut(size.join(needed, "cluster", "left_semi").select("cluster", "main"))
    ids = cut(member.select("node", "comp", "cluster").distinct().join(small(main), "cluster"))
    hosts = sided.groupBy("host").agg(F.ceil(F.max("hosts") / BLOCK).cast("int").alias("nm"), F.ceil(F.sum("guests") / BLOCK).cast("int").alias("nq"))
    hosts = cut(hosts)
    block = lambda of: F.pmod(F.xxhash64(F.col("node")), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    inside = ids.join(small(hosts), F.col("cluster") == F.col("host")).select("host", F.lit(0).alias("side"), "node", "comp", block("nm").alias("mb"), every("nq").alias("qb"))
    asking_ = cut(sided.select("host", "guest").join(small(hosts), "host"))
    asked = ids.join(small(asking_), F.col("guest") == F.col("cluster")).where("host <> guest or comp <> main")
    asking = asked.select("host", F.lit(1).alias("side"), "node", "comp", every("nm").alias("mb"), block("nq").alias("qb"))
    both = _fetch(docs, cut(inside.unionByName(asking)), n)
    parts = max(1, -(-sided.count() // 250))

    def run(p: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, g in p.groupby(["host", "mb", "qb"]):
            side = g["side"].to_numpy()
            rows = [(v, _unpack(t)) for v, t in zip(g["comp"].tolist(), g["tokens"], strict=True)]
            members, guests = [r for r, s in zip(rows, side, strict=True) if s == 0], [r for r, s in zip(rows, side, strict=True) if s == 1]
            if members and guests:
                out += _open(members, guests, percent)
        return pd.DataFrame(out, columns=["a", "b"])

    bucket = F.pmod(F.xxhash64("host", "mb", "qb"), F.lit(parts))
    links = both.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(run, "a long, b long")
    final = components(links)
    where = member.join(final, F.col("comp") == F.col("id"), "left").select("digest", F.coalesce("component", "comp").alias("component_id"))
    out = sets.join(where, "digest", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
