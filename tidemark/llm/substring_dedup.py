"""Removal of repeated word sequences (operator 2).

A word goes if it lies in a window of WINDOW consecutive words that also starts in a document with a smaller doc_id.

Method: a compressed FM-index per shard; backward search over its wavelet matrix gives the matching statistics of the
streamed documents, and intervals at the threshold are reported. Shards are made by content, so that one pass over
each finds everything: a window belongs to its minimizer (of the hashes of its GRAM-word sequences the least), and a
maximal run of windows of one minimizer - a segment - goes to the minimizer's shard. Equal windows have equal
minimizers and meet. Every shard's size is bounded by the number of shards, and the work grows with the input.
Shards travel in groups of SUB: so the packs that a task sends stay long enough to compress well.

Segments that are equal as a whole are pre-aggregated, in the map task and again in the shard: only those of the
smallest doc_id go on, the others are covered at once. This keeps copies and common passages small everywhere.

Words are compared by 64-bit hashes. Defined cases: null or empty texts have no words; texts shorter than a window
lose nothing; rows with a null doc_id neither give nor lose words; rows that repeat a doc_id do not remove words from
each other; an empty table gives an empty result; other columns of docs aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_ids, as_text, bitmap, cut, mix, slices, slot, small_batches, weights, words
from .fm_index import FmIndex

WINDOW, GRAM = 13, 4
#: Bytes of text whose segments make a shard, on average; shards to a group; bytes of text dealt at once.
SHARD, SUB, DEALT = 2_000_000, 4, 3_000_000
_G, _NONE = weights(GRAM, 23), np.uint64(2**64 - 1)


def _grams(h: np.ndarray) -> np.ndarray:
    out = np.zeros(max(0, len(h) - GRAM + 1), np.uint64)
    for k in range(GRAM):
        out += h[k : len(h) - GRAM + 1 + k] * _G[k]
    return mix(out)


def _segments(owner: np.ndarray, h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, number of words, minimizer) of each maximal run of windows with one minimizer."""
    n = len(h) - window + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64)
    low, held = _grams(h), 1
    wide = window - GRAM + 1
    while held < wide:
        step = min(held, wide - held)
        low = np.minimum(low[:-step], low[step:])
        held += step
    inside = np.flatnonzero(owner[:n] == owner[window - 1 :])
    v = low[inside]
    new = np.concatenate(([True], (np.diff(inside) != 1) | (v[1:] != v[:-1]) | (owner[inside[1:]] != owner[inside[:-1]]))) if len(inside) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(inside)))
    return inside[head], count + window - 1, v[head]


def _spread(first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word index of every word of every segment, its place in the segment, and where segments start."""
    start = np.cumsum(length) - length
    place = np.arange(int(length.sum())) - np.repeat(start, length)
    return np.repeat(first, length) + place, place, start


def _names(h: np.ndarray, place: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """128-bit names of segments by their words."""
    most = int(length.max(initial=1))
    out = np.empty(len(start), [("a", np.uint64), ("b", np.uint64)])
    for name, seed in (("a", 31), ("b", 37)):
        out[name] = mix(np.add.reduceat(h * weights(most, seed)[place], start) + length.astype(np.uint64))
    return out


def _least(names: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The smallest doc_id of the segments of each segment's name."""
    _, group = np.unique(names, return_inverse=True)
    least = np.full(int(group.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, doc)
    return least[group]


def _spans(doc: np.ndarray, tid: np.ndarray, low: np.ndarray, high: np.ndarray) -> pd.DataFrame:
    """Rows (doc_id, tid, low, high); spans of a document that touch become one."""
    f = pd.DataFrame({"doc_id": doc, "tid": tid, "low": low, "high": high}).sort_values(["doc_id", "tid", "low"], kind="stable")
    if f.empty:
        return f
    key = (f["doc_id"].diff() != 0) | (f["tid"].diff() != 0)
    run = key.cumsum()
    reach = f["high"].groupby(run).cummax().shift(fill_value=-1)
    part = (key | (f["low"] > reach)).cumsum()
    return f.groupby(part, sort=False).agg({"doc_id": "first", "tid": "first", "low": "min", "high": "max"})


_COLUMNS = ["team", "blob", "doc_id", "tid", "low", "high"]


def _deal(docs: DataFrame, teams: int, window: int) -> DataFrame:
    """Segments packed by group of shards (blob), and spans found within the task (no blob), dealt over the groups."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(level=3)
        for p in parts:
            texts, ids, tids = utf8_bytes(p["text"]), p["doc_id"].to_numpy(np.int64), p["tid"].to_numpy(np.int64)
            for a, b in slices(texts, DEALT):
                owner, start, end, h, data = words(texts[a:b], lower=False)
                first, length, v = _segments(owner, h, window)
                if not len(first):
                    continue
                local = owner[first] + a
                at, place, begin = _spread(first, length)
                doc = ids[local]
                copy = doc > _least(_names(h[at], place, begin, length), doc)
                base = np.searchsorted(owner, np.arange(b - a))  # a document's first word
                offset = first - base[owner[first]]
                spans = _spans(doc[copy], tids[local][copy], offset[copy], offset[copy] + length[copy])
                yield spans.assign(team=spans["doc_id"] % teams, blob=None)[_COLUMNS]
                keep = np.flatnonzero(~copy)
                shard = (v[keep] % np.uint64(teams * SUB)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                keep, shard = keep[order], shard[order]
                cuts = np.flatnonzero(np.diff(shard // SUB, prepend=-1, append=teams))
                rows = []
                for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    k, sub = keep[x:y], np.searchsorted(shard[x:y] % SUB, np.arange(SUB + 1))
                    text = [data[i:j] for i, j in zip(start[first[k]].tolist(), end[first[k] + length[k] - 1].tolist(), strict=True)]
                    text = [b" ".join(text[i:j]) for i, j in zip(sub[:-1].tolist(), sub[1:].tolist(), strict=True)]
                    own, which = np.unique(local[k], return_inverse=True)
                    head = np.array([len(k), len(own), *sub, *map(len, text)], "<i8").tobytes() + ids[own].tobytes() + tids[own].tobytes()
                    body = which.astype("<i4").tobytes() + offset[k].astype("<i4").tobytes() + length[k].astype("<i4").tobytes()
                    rows.append((int(shard[x]) // SUB, pack.compress(head + body + b"".join(text))))
                yield pd.DataFrame(rows, columns=["team", "blob"]).assign(doc_id=0, tid=0, low=0, high=0)[_COLUMNS]

    return docs.mapInPandas(run, "team int, blob binary, doc_id long, tid long, low int, high int")


def utf8_bytes(values) -> list[bytes]:
    return [bytes(v) if isinstance(v, (bytes, bytearray)) else b"" for v in values]


def _unpack(blobs: list[bytes]) -> list[list[tuple]]:
    """Of each shard of a group: (doc_id, tid, offset, length, text) of the segments in every blob."""
    shards: list[list[tuple]] = [[] for _ in range(SUB)]
    for blob in blobs:
        raw = zstandard.decompress(blob)
        head = np.frombuffer(raw, "<i8", 3 + 2 * SUB)
        n, m, at = int(head[0]), int(head[1]), 8 * len(head)
        sub, size = head[2 : 3 + SUB].tolist(), head[3 + SUB :].tolist()
        ids, tids = np.frombuffer(raw, "<i8", m, at), np.frombuffer(raw, "<i8", m, at + 8 * m)
        at += 16 * m
        which, off, length = (np.frombuffer(raw, "<i4", n, at + 4 * n * k) for k in range(3))
        at += 12 * n
        for k in range(SUB):
            own = which[sub[k] : sub[k + 1]]
            if len(own):
                shards[k].append((ids[own], tids[own], off[sub[k] : sub[k + 1]].copy(), length[sub[k] : sub[k + 1]].copy(), raw[at : at + size[k]]))
            at += size[k]
    return shards


def _search(packed: list[tuple], window: int) -> pd.DataFrame:
    """Spans that a shard's FM-index reports, and those of its equal segments."""
    doc, tid, offset, length = (np.concatenate([x[k] for x in packed]) for k in range(4))
    h = np.concatenate([words([x[4]], lower=False)[3] for x in packed])
    offset, length = offset.astype(np.int64), length.astype(np.int64)
    start = np.cumsum(length) - length
    place = np.arange(len(h)) - np.repeat(start, length)
    names = _names(h, place, start, length)
    copy = doc > _least(names, doc)
    out = [(doc[copy], tid[copy], offset[copy], offset[copy] + length[copy])]
    # index entries: one of each name; only minimizers with several entries can still find something
    _, entry, group = np.unique(names, return_index=True, return_inverse=True)
    g = np.append(_grams(h), np.full(GRAM - 1, _NONE))
    g[place > (np.repeat(length, length) - GRAM)] = _NONE
    v = np.minimum.reduceat(g, start)[entry]
    _, same, often = np.unique(v, return_inverse=True, return_counts=True)
    entry_doc = np.full(len(entry), np.iinfo(np.int64).max)
    np.minimum.at(entry_doc, group, doc)
    use = np.flatnonzero(often[same] > 1)
    if use.size:
        size = length[entry[use]]
        at, _, _ = _spread(start[entry[use]], size)
        _, number = np.unique(h[at], return_inverse=True)
        first = np.cumsum(size + 1) - (size + 1)
        text = np.zeros(int((size + 1).sum()), np.int64)
        inside = np.ones(len(text), bool)
        inside[first + size] = False
        text[inside] = number + 1
        index = FmIndex(text, int(number.max()) + 2, window)
        found, low, high = index.matching_statistics(text, first, size)
        owner = np.repeat(entry_doc[use], size + 1)
        full = np.flatnonzero(found == window)
        runs, back = np.unique(low[full], return_inverse=True)
        until = np.zeros(len(runs), np.int64)
        until[back] = high[full]
        by_suffix = owner[index.suffix]
        edges = np.stack([runs, until], 1).ravel()
        least = np.minimum.reduceat(np.append(by_suffix, np.iinfo(np.int64).max), edges)[::2][back]
        hit = full[least < owner[full]]
        # every occurrence of the entry in its smallest document
        entry_of = np.repeat(np.arange(len(use)), size + 1)[hit]
        shift = hit - first[entry_of]
        held = np.flatnonzero(~copy)
        by = held[np.argsort(group[held], kind="stable")]
        lo, hi = np.searchsorted(group[by], use[entry_of], "left"), np.searchsorted(group[by], use[entry_of], "right")
        times = hi - lo
        row = by[np.repeat(lo - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))]
        where = offset[row] + np.repeat(shift, times)
        out.append((doc[row], tid[row], where, where + window))
    return _spans(*(np.concatenate(x) for x in zip(*out, strict=True)))


def remove_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by one space) of every row."""
    small_batches(docs)
    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    teams = max(8, -(-size // (SHARD * SUB)))
    named = own.where("doc_id is not null").withColumn("tid", F.xxhash64("text"))

    def run(p: pd.DataFrame) -> pd.DataFrame:
        columns, packs = ["doc_id", "tid", "low", "high"], p["blob"].notna()
        found, shards = [p.loc[~packs, columns]], _unpack(p.loc[packs, "blob"].tolist())
        while shards:
            packed = shards.pop()
            if packed:
                found.append(_search(packed, window)[columns])
        return pd.concat(found)

    # as many tasks as groups, so that the largest one doesn't grow with the input
    dealt = _deal(named, teams, window).repartition(int(min(teams, 100_000)), "team")
    spans = dealt.groupBy("team").applyInPandas(run, "doc_id long, tid long, low int, high int")
    per = cut(spans.groupBy("doc_id", "tid").agg(F.collect_list(F.struct("low", "high")).alias("spans")))
    # most documents lose nothing and need no exchange; the bitmap has a fixed size and may only err on the safe side
    bits = own.sparkSession.sparkContext.broadcast(bitmap(per.select(F.col("doc_id").alias("id"))))

    def kept(values, spans) -> list[tuple]:
        rows = []
        for t, s in zip(values, spans, strict=True):
            w = (bytes(t) if t is not None else b"").split()
            n = len(w)
            gone = 0
            if s is not None and len(s):
                left, out = 0, []
                for x in sorted((r["low"], r["high"]) for r in s):
                    if x[0] > left:
                        out += w[left : x[0]]
                    left = max(left, x[1])
                w = out + w[left:]
                gone = n - len(w)
            rows.append((n, gone, b" ".join(w).decode("utf-8", "surrogatepass")))
        return rows

    @F.pandas_udf("boolean")
    def loses(at: pd.Series) -> pd.Series:
        s = at.to_numpy(np.int64)
        return pd.Series(((bits.value[s >> 3] >> (s & 7).astype(np.uint8)) & 1).astype(bool))

    def whole(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = pd.DataFrame(kept(p["text"], [None] * len(p)), columns=["n_words", "n_removed", "kept"])
            yield out.assign(doc_id=pd.array(as_ids(p["doc_id"]), "Int64"))

    def finish(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = pd.DataFrame(kept(p["text"], p["spans"]), columns=["n_words", "n_removed", "kept"])
            yield out.assign(doc_id=pd.array(as_ids(p["doc_id"]), "Int64"))

    # two reads of the input, which cost less than a copy of all texts
    schema = "doc_id long, n_words long, n_removed long, kept string"
    split = own.withColumn("loses", F.coalesce(loses(F.coalesce(slot(F.col("doc_id")), F.lit(0))), F.lit(False)))
    told = as_text(F.col("doc_id")).alias("doc_id")
    clear = split.where("not loses").select(told, "text").mapInPandas(whole, schema)
    some = split.where("loses").select("doc_id", "text", F.xxhash64("text").alias("tid")).join(per, ["doc_id", "tid"], "left")
    return clear.unionByName(some.select(told, "text", "spans").mapInPandas(finish, schema))
