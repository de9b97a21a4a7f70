"""Alignment of two tokenizers over the same bytes, and how often the corpus links their tokens.

Both token streams of a text are laid over its bytes. Where a space-marked token starts in both, the bytes before it are
shared; such anchors, verified by the texts' own bytes, cut a document into short windows of token ids. How the tokens in
a window line up depends on their ids alone, so windows are aligned once by their id tuples and remembered; natural text
has few different ones. What is left of a document is a list of (pair of ids, how often), which Spark counts over the
corpus.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from .common import cut, mix, slices, small_batches, weights

#: Chunks, and windows, that a worker remembers. Bounds memory, not what is aligned.
REMEMBERED = 300_000
#: Links of a group from which equal ids in it are counted first.
LARGE = 4096
#: Pairs that are broadcast with their counts (16 MB), from the most frequent; the others are joined by exchange.
HEAD = 1_000_000
_MULT = weights(1 << 12, 7)
#: White space before a space.
_WIDE = re.compile(r"\s ")


def _byte_level() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pool:
    """Rows of numbers, one after the other in one array."""

    def __init__(self, rows=(), dtype=np.int64) -> None:
        self.size = np.array([len(r) for r in rows], np.int64)
        self.flat = np.array([x for r in rows for x in r], dtype)
        self.first = np.cumsum(self.size) - self.size

    def put(self, at: int, size: np.ndarray, flat: np.ndarray) -> None:
        """Rows from `at` on are replaced by new ones."""
        end = int(self.size[:at].sum())
        self.size, self.flat = np.concatenate((self.size[:at], size)), np.concatenate((self.flat[:end], flat.astype(self.flat.dtype)))
        self.first = np.cumsum(self.size) - self.size

    def take(self, rows: np.ndarray) -> np.ndarray:
        return self.flat[ranges(self.first[rows], self.size[rows])]


class Memo:
    """Numbers of keys in the order of their first appearance, up to REMEMBERED; what comes later gets passing numbers.

    When many more were missed than are held, all is forgotten, as the texts have changed.
    """

    def __init__(self) -> None:
        self.known: dict = {}
        self.missed = 0

    def look(self, keys: list) -> tuple[int, list[int], list]:
        """(held before, number of each key, new keys). keys are distinct; a new one's number is held + its place."""
        if self.missed > 10 * REMEMBERED:
            self.known, self.missed = {}, 0
        known, held, numbers, new = self.known, len(self.known), [], []
        for k in keys:
            n = known.get(k)
            if n is None:
                n = held + len(new)
                new.append(k)
            numbers.append(n)
        room = REMEMBERED - held
        known.update(zip(new[:room], range(held, REMEMBERED), strict=False))
        self.missed += max(0, len(new) - room)
        return held, numbers, new


class _Side:
    """One tokenizer: encode(chunks) to ids, and each id's bytes."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.bytes = Pool(pieces, np.uint8)
        self.lengths = self.bytes.size
        self.spaced = np.array([p[:1] == b" " for p in pieces])


class ByteLevel(_Side):
    """A byte-level BPE of the tokenizers library; special tokens' strings in texts are ordinary text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        byte = _byte_level()
        vocabulary = {i: t for t, i in self.model.get_vocab().items()}
        names = [vocabulary.get(i, "") for i in range(max(vocabulary) + 1)]
        super().__init__([bytes(byte[c] for c in t) if all(c in byte for c in t) else b"" for t in names])

    def encode(self, chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(chunks, add_special_tokens=False)]


class Pieces(_Side):
    """A sentencepiece model, which puts a space before a text of its own."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in names):
            raise ValueError("a piece goes on after a space, so texts can't be cut before spaces")
        super().__init__([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)])

    def encode(self, chunks: list[str]) -> list[list[int]]:
        return self.model.encode([c[1:] for c in chunks], num_threads=1)


def chunks(text: str) -> list[str]:
    """space + text, cut before spaces that follow no white space. Neither side merges across such a cut.

    A byte-level pattern takes white space only in front of what follows it; pieces have spaces only in front.
    """
    parts = text.split(" ")
    if not _WIDE.search(text) and parts[0] and parts[-1]:
        return [" " + p for p in parts]
    out, held = [], ""
    for p in parts:
        held += " " + p
        if p and not p[-1].isspace():
            out.append(held)
            held = ""
    if held:  # white space at the end stays with what it follows
        out[-1:] = [(out[-1] if out else "") + held]
    return out


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, .. (size[0] of them), first[1], .."""
    at = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(first - at, size)


class Aligner:
    """Tokenizes and aligns texts; what it remembers only saves work."""

    def __init__(self, a: str, b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are what runs side by side
        self.a, self.b = ByteLevel(a), Pieces(b)
        self.base = len(self.b.lengths)
        self.digits = Pool([str(i).encode() for i in range(max(len(self.a.lengths), self.base))], np.uint8)
        self.chunks, self.ids, self.good = Memo(), (Pool(), Pool()), np.zeros(0, bool)
        self.windows, self.text, self.codes, self.groups = Memo(), [], Pool(), np.zeros(0, np.int64)

    def _learn(self, held: int, new: list[str]) -> None:
        """Tokens of new chunks, and whether both sides' bytes are the chunk's."""
        raw = [c.encode("utf-8", "surrogatepass") for c in new]
        size = np.array([len(r) for r in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        good = np.ones(len(new), bool)
        for side, pool in ((self.a, self.ids[0]), (self.b, self.ids[1])):
            lists = side.encode(new)
            count = np.array([len(x) for x in lists], np.int64)
            ids = np.fromiter(chain.from_iterable(lists), np.int64, int(count.sum()))
            pool.put(held, count, ids)
            owner = np.repeat(np.arange(len(new)), count)
            good &= np.bincount(owner, side.lengths[ids], len(new)) == size
            like = good[owner]
            mine, own = side.bytes.take(ids[like]), np.repeat(owner[like], side.lengths[ids[like]])
            theirs = data[ranges((np.cumsum(size) - size)[good], size[good])]
            good[own[mine != theirs]] = False
        self.good = np.concatenate((self.good[:held], good))

    def tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """([ids a, ids b], [tokens of each text in a, b]); null and empty texts, and those not covered, have none."""
        cut_up = [chunks(t) if t else [] for t in texts]
        different = list(dict.fromkeys(chain.from_iterable(cut_up)))
        held, numbers, new = self.chunks.look(different)
        if new:
            self._learn(held, new)
        number = dict(zip(different, numbers, strict=True))
        flat = np.array([number[c] for c in chain.from_iterable(cut_up)], np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(p) for p in cut_up])
        covered = np.ones(len(texts), bool)
        covered[owner[~self.good[flat]]] = False
        flat, owner = flat[covered[owner]], owner[covered[owner]]
        return [pool.take(flat) for pool in self.ids], [np.bincount(owner, pool.size[flat], len(texts)).astype(np.int64) for pool in self.ids]

    def _align(self, held: int, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> None:
        """Groups, their text and linked pairs of new windows, whose tokens stand one after the other."""
        end_a, end_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        mark = np.zeros(int(end_a[-1]) + 1, np.uint8)
        mark[end_a] = 1
        mark[end_b] += 2
        last_a, last_b = mark[end_a] == 3, mark[end_b] == 3  # a group ends where both end
        stop_a, stop_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        n_a, n_b = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)
        start_a, start_b = stop_a - n_a, stop_b - n_b
        window = np.repeat(np.arange(size_a.size), size_a)[start_a]
        self.groups = np.concatenate((self.groups[:held], np.bincount(window, minlength=size_a.size)))
        # text: a's tokens of a group, then b's, each followed by a separator
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        slot_a, slot_b = np.arange(a.size) + start_b[group_a], np.arange(b.size) + stop_a[group_b]
        ids, after = np.empty(a.size + b.size, np.int64), np.full(a.size + b.size, ord(","), np.uint8)
        ids[slot_a], ids[slot_b] = a, b
        after[slot_a[last_a]], after[slot_b[last_b]] = ord("|"), ord(";")
        after[slot_b[np.cumsum(size_b) - 1]] = ord("\n")
        width = self.digits.size[ids]
        begin = np.cumsum(width + 1) - width - 1
        out = np.empty(int(width.sum()) + ids.size, np.uint8)
        out[ranges(begin, width)] = self.digits.take(ids)
        out[begin + width] = after
        self.text[held:] = out.tobytes().decode("ascii").split("\n")[:-1]
        # pairs: each token of a with each of b; in very large groups, different ids only
        times = n_a * n_b
        large = times > LARGE
        some = np.flatnonzero(~large)
        place = ranges(np.zeros(some.size, np.int64), times[some])
        n, x, y = (np.repeat(v[some], times[some]) for v in (n_b, start_a, start_b))
        codes, each, where = a[x + place // np.maximum(n, 1)] * self.base + b[y + place % np.maximum(n, 1)], np.ones(place.size, np.int64), np.repeat(window[some], times[some])
        for g in np.flatnonzero(large).tolist():
            left, k = np.unique(a[start_a[g] : stop_a[g]], return_counts=True)
            right, m = np.unique(b[start_b[g] : stop_b[g]], return_counts=True)
            codes = np.concatenate((codes, (left[:, None] * self.base + right).ravel()))
            each = np.concatenate((each, (k[:, None] * m).ravel()))
            where = np.concatenate((where, np.full(left.size * right.size, window[g])))
        order = np.argsort(where, kind="stable")
        pairs = np.column_stack((codes[order], each[order])).ravel()
        self.codes.put(held, 2 * np.bincount(where, minlength=size_a.size), pairs)

    def rows(self, texts: list[str | None]) -> dict:
        """Columns of the texts' alignment: n_a, n_b, n_groups, n_links, groups, and the pairs as (offsets, codes, times)."""
        (a, b), (n_a, n_b) = self.tokens(texts)
        none = np.zeros(len(texts), np.int64)
        if not a.size:
            return {"n_a": n_a, "n_b": n_b, "n_groups": none, "n_links": none, "groups": [""] * len(texts), "pairs": (np.zeros(len(texts) + 1, np.int64), none[:0], none[:0])}
        at_a, at_b = (np.cumsum(side.lengths[ids]) - side.lengths[ids] for side, ids in ((self.a, a), (self.b, b)))
        mark = np.zeros(int(max(at_a[-1], at_b[-1])) + 1, np.uint8)
        mark[at_a[self.a.spaced[a]]] = 1
        mark[at_b[self.b.spaced[b]]] += 2
        # every covered text starts with a space in both, so each starts a window
        first_a, first_b = np.flatnonzero(mark[at_a] == 3), np.flatnonzero(mark[at_b] == 3)
        size_a, size_b = np.diff(first_a, append=a.size), np.diff(first_b, append=b.size)
        key = np.zeros(first_a.size, np.uint64)
        for ids, first, size in ((a, first_a, size_a), (b, first_b, size_b)):
            place = np.arange(ids.size) - np.repeat(first, size)
            mult = _MULT if size.max() <= _MULT.size else weights(int(size.max()), 7)
            key = mix(key) + np.add.reduceat((ids + 1).astype(np.uint64) * mult[place], first)
        _, example, which = np.unique(key, return_index=True, return_inverse=True)
        fa, sa, fb, sb = first_a[example], size_a[example], first_b[example], size_b[example]
        raw_a, raw_b = a.astype("<i4").tobytes(), b.astype("<i4").tobytes()
        keys = [(raw_a[i:j], raw_b[k:m]) for i, j, k, m in zip((4 * fa).tolist(), (4 * (fa + sa)).tolist(), (4 * fb).tolist(), (4 * (fb + sb)).tolist(), strict=True)]
        held, numbers, new = self.windows.look(keys)
        number = np.array(numbers, np.int64)
        if new:
            fresh = number >= held
            self._align(held, a[ranges(fa[fresh], sa[fresh])], b[ranges(fb[fresh], sb[fresh])], sa[fresh], sb[fresh])
        text = [self.text[i] for i in numbers]
        owner = np.searchsorted(np.cumsum(n_a), first_a, side="right")  # text of each window
        pick, groups, at = which.tolist(), [], 0
        for end in np.cumsum(np.bincount(owner, minlength=len(texts))).tolist():
            groups.append(";".join([text[i] for i in pick[at:end]]))
            at = end
        of = number[which]
        pairs = self.codes.take(of).reshape(-1, 2)
        text_of = np.repeat(owner, self.codes.size[of] // 2)
        both = text_of * (len(self.a.lengths) * self.base) + pairs[:, 0]
        order = np.argsort(both)
        both = both[order]
        start = np.flatnonzero(np.diff(both, prepend=-1))
        times = np.add.reduceat(pairs[order, 1], start)
        offsets = np.concatenate(([0], np.cumsum(np.bincount(text_of[order[start]], minlength=len(texts)))))
        count = lambda v, by: np.bincount(by, v, len(texts)).astype(np.int64)
        return {"n_a": n_a, "n_b": n_b, "n_groups": count(self.groups[of], owner), "n_links": count(pairs[:, 1], text_of), "groups": groups, "pairs": (offsets, pairs[order[start], 0], times)}


def size(b: str) -> int:
    """Ids of a sentencepiece model, by which codes of pairs are made."""
    return len(Pieces(b).lengths)


@lru_cache(maxsize=1)
def _aligner(a: str, b: str) -> Aligner:
    return Aligner(a, b)


def alignments(docs: DataFrame, a: str, b: str, text: str = "text") -> DataFrame:
    """docs without their texts, with n_a, n_b, n_groups, n_links (long), groups (`a1,a2|b1;a3|b2`), codes and times.

    a: file of a byte-level BPE, which encodes space + text; b: file of a sentencepiece model. codes: the linked pairs,
    each once, as id of a * size of b + id of b; times: how often the document links them. Null and empty texts, and
    texts whose tokens don't give their bytes back, have no tokens: zeros, empty text and empty arrays. Texts of any
    length are aligned whole; ties can't occur, and repeated rows are rows of their own. An empty table gives an empty
    result. Extra columns are kept, but for names that this adds: those are replaced.
    """
    added = {"n_a": LongType(), "n_b": LongType(), "n_groups": LongType(), "n_links": LongType(), "groups": "string", "codes": ArrayType(LongType()), "times": ArrayType(IntegerType())}
    kept = [c for c in docs.columns if c != text and c not in added]
    slim = docs.select(F.col(text).cast("string").alias("__text"), *[F.col(c).alias(f"__c{i}") for i, c in enumerate(kept)])
    out = StructType([*slim.schema.fields[1:]])
    for name, kind in added.items():
        out = out.add(name, kind)
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a, b)
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            for start, end in slices([t or "" for t in texts]):
                got = aligner.rows(texts[start:end])
                offsets, codes, times = got["pairs"]
                ends = pa.array(offsets, pa.int32())
                new = [pa.array(got[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
                new += [pa.array(got["groups"], pa.string()), pa.ListArray.from_arrays(ends, pa.array(codes)), pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32)))]
                rest = [batch.column(i).slice(start, end - start) for i in range(1, batch.num_columns)]
                table = pa.Table.from_arrays([*rest, *new], schema.names).cast(schema)
                yield from table.to_batches()

    small_batches(docs)
    made = slim.mapInArrow(run, out)
    return made.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(kept)], *added)


def linked(aligned: DataFrame, size_b: int) -> tuple[DataFrame, DataFrame]:
    """(rows with n_best and count_sum, pairs(code, a, b, documents, best)) of what `alignments` gave, without its groups
    and without columns of its own named n_best, count_sum or __at.

    A pair's documents are counted over the corpus after each task has added up its own. The HEAD most frequent pairs
    are broadcast to the documents' pairs; the rest, each in few documents, meet theirs by exchange.
    """
    rows = cut(aligned.drop("groups", "n_best", "count_sum", "__at")).withColumn("__at", F.monotonically_increasing_id())
    counts = rows.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("documents"))
    a = F.expr(f"code div {size_b}").cast("int")
    counts = cut(counts.withColumn("a", a))
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))  # a row an id of a
    pairs = cut(counts.join(F.broadcast(most), "a").select("code", "a", F.pmod("code", F.lit(size_b)).cast("int").alias("b"), "documents", (F.col("documents") == F.col("most")).alias("best")))
    level = F.floor(F.log2("documents")).cast("int").alias("level")
    above, from_level = 0, 64
    for r in pairs.groupBy(level).count().orderBy(F.desc("level")).collect():  # 63 rows at most
        above += r["count"]
        if above > HEAD:
            break
        from_level = r["level"]
    frequent = F.col("documents") >= F.lit(2**from_level if from_level < 63 else 2**62)
    told = ("code", "documents", "best")
    head, tail = F.broadcast(pairs.where(frequent).select(*told)), pairs.where(~frequent).select(*told)
    each = rows.select("__at", F.explode(F.arrays_zip("codes", "times")).alias("p")).select("__at", F.col("p.codes").alias("code"), F.col("p.times").cast("long").alias("times"))
    sums = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("documents")).alias("count_sum")
    found = each.join(head, "code").groupBy("__at").agg(*sums)
    if above > HEAD:
        found = found.unionByName(each.join(head, "code", "left_anti").join(tail, "code").groupBy("__at").agg(*sums))
        found = found.groupBy("__at").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = rows.drop("codes", "times").join(found, "__at", "left").drop("__at")
    return out.na.fill(0, ["n_best", "count_sum"]), pairs
