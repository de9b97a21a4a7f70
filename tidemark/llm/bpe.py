"""BPE encoding and decoding (operator 1).

Method: a segment tree over the ranks of adjacent pairs. A leaf holds rank * size + position, so the root is the
leftmost pair of lowest rank; a merge changes three leaves and the nodes above them. Words of up to 64 symbols are
merged many at a time (one tree per row of a numpy array), longer ones one by one with the same tree.

Defined cases: null text is empty; an empty text has no ids and decodes to ""; strings of special tokens inside a
text become their ids, as the library does; any length of text or word is handled whole; other columns are kept.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .common import small_batches

#: Words remembered by a worker; beyond that it starts afresh (memory only, results are the same).
REMEMBERED = 200_000
_NONE = np.int64(1) << np.int64(60)


def _byte_symbols() -> dict[int, str]:
    """The printable symbol of each byte in byte-level vocabularies: itself if printable, else the next free one."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordBpe:
    """A byte-level BPE with word ends, read from a tokenizers JSON file."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        model, self.suffix = spec["model"], spec["model"]["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in model["merges"]]
        self.token = [""] * (1 + max(*self.vocab.values(), *self.special.values()))
        for s, i in [*self.vocab.items(), *self.special.items()]:
            self.token[i] = s
        self.base = len(self.token)
        keys = np.array([self.vocab[a] * self.base + self.vocab[b] for a, b in pairs], np.int64)
        first = {}
        for r, k in enumerate(keys.tolist()):
            first.setdefault(k, r)
        self.rank = first
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        sym = _byte_symbols()
        self.inner = np.array([self.vocab[sym[b]] for b in range(256)], np.int64)
        self.last = np.array([self.vocab[sym[b] + self.suffix] for b in range(256)], np.int64)
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(pattern, regex.V0).findall
        self.white = regex.compile(r"\s+")
        self.stops = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.known: dict[str, bytes] = {}

    # -- text to words
    def words(self, text: str) -> list[str]:
        """Normalised words; an id of a special token stands for its string."""
        out: list = []
        for k, part in enumerate(self.stops.split(text) if self.stops else [text]):
            if k % 2:
                out.append(self.special[part])
            elif part:
                part = unicodedata.normalize("NFC", part)
                out += self.pieces(self.white.sub(" ", part).replace("Σ", "σ").lower())
        return out

    # -- words to ids
    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, _NONE if it doesn't merge (or a side is -1)."""
        key = a * self.base + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.ranks[at], _NONE)

    def _many(self, words: list[bytes], size: int) -> list[bytes]:
        """One segment tree per word, all words a merge at a time. size: leaves, a power of two over the length."""
        n = len(words)
        ids = np.full((n, size), -1, np.int64)
        lengths = np.array([len(w) for w in words])
        flat = np.frombuffer(b"".join(words), np.uint8)
        row = np.repeat(np.arange(n), lengths)
        col = np.arange(flat.size) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        ids[row, col] = self.inner[flat]
        ids[np.arange(n), lengths - 1] = self.last[flat[np.cumsum(lengths) - 1]]
        place = np.arange(size)
        after, before = np.tile(place + 1, (n, 1)), np.tile(place - 1, (n, 1))
        tree = np.full((n, 2 * size), _NONE, np.int64)
        rank = self._ranks(ids[:, :-1], ids[:, 1:])
        tree[:, size : 2 * size - 1] = np.where(rank < _NONE, rank * size + place[:-1], _NONE)
        level = size
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level = half
        live = np.flatnonzero(tree[:, 1] < _NONE)

        def put(rows: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            node = at + size
            tree[rows, node] = value
            while node[0] > 1:
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        while live.size:
            root = tree[live, 1]
            at, r = root % size, root // size
            gone = after[live, at]
            ids[live, at] = self.made[r]
            ids[live, gone] = -1
            nxt = after[live, gone]
            after[live, at] = nxt
            more = nxt < size
            before[live[more], nxt[more]] = at[more]
            put(live, gone, np.full(live.size, _NONE))
            right = np.where(more, ids[live, np.minimum(nxt, size - 1)], -1)
            rank = self._ranks(ids[live, at], right)
            put(live, at, np.where(rank < _NONE, rank * size + at, _NONE))
            prev = before[live, at]
            has = prev >= 0
            if has.any():
                rows, p = live[has], prev[has]
                rank = self._ranks(ids[rows, p], ids[rows, at[has]])
                put(rows, p, np.where(rank < _NONE, rank * size + p, _NONE))
            live = live[tree[live, 1] < _NONE]
        left = ids >= 0
        out = ids[left].astype("<u4").tobytes()
        stop = (np.cumsum(left.sum(1)) * 4).tolist()
        return [out[a:b] for a, b in zip([0, *stop], stop, strict=False)]

    def _one(self, word: bytes) -> bytes:
        """A long word: the same tree, merged one pair at a time."""
        data = np.frombuffer(word, np.uint8)
        ids = self.inner[data].tolist()
        ids[-1] = int(self.last[data[-1]])
        n = len(ids)
        size = 1 << (n - 1).bit_length()
        none = int(_NONE)
        rank = self._ranks(np.array(ids[:-1]), np.array(ids[1:]))
        tree = [none] * (2 * size)
        tree[size : size + n - 1] = np.where(rank < _NONE, rank * size + np.arange(n - 1), _NONE).tolist()
        for k in range(size - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(at: int, value: int) -> None:
            node = at + size
            tree[node] = value
            while node > 1:
                node >>= 1
                best = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == best:
                    break
                tree[node] = best

        def leaf(a: int, b: int) -> int:
            r = self.rank.get(ids[a] * self.base + ids[b]) if b < n else None
            return none if r is None else r * size + a

        while tree[1] < none:
            r, at = divmod(tree[1], size)
            gone = after[at]
            ids[at], ids[gone] = int(self.made[r]), -1
            after[at] = nxt = after[gone]
            if nxt < n:
                before[nxt] = at
            put(gone, none)
            put(at, leaf(at, nxt))
            if before[at] >= 0:
                put(before[at], leaf(before[at], at))
        return np.array([i for i in ids if i >= 0], "<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        """Put the ids of words not known yet into self.known."""
        by_size: dict[int, list[str]] = {}
        raw: dict[str, bytes] = {}
        for w in words:
            raw[w] = b = w.encode("utf-8", "surrogatepass")
            by_size.setdefault(max(2, 1 << (len(b) - 1).bit_length()), []).append(w)
        for size, group in by_size.items():
            if size > 64:
                self.known.update((w, self._one(raw[w])) for w in group)
                continue
            step = 262_144 // size
            for k in range(0, len(group), step):
                part = group[k : k + step]
                self.known.update(zip(part, self._many([raw[w] for w in part], size), strict=True))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.words(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        fresh = {w for ws in split for w in ws if isinstance(w, str)}.difference(self.known)
        self.learn(list(fresh))
        known = self.known
        return [
            b"".join([known[w] if isinstance(w, str) else w.to_bytes(4, "little") for w in ws])
            if any(isinstance(w, int) for w in ws)
            else b"".join(map(known.__getitem__, ws))
            for ws in split
        ]

    def decode(self, ids: bytes) -> str:
        """Token strings joined by one space, as the library does where a file names no decoder."""
        token = self.token
        return " ".join([token[i] for i in np.frombuffer(ids, "<u4").tolist()])


KINDS = {"long": LongType(), "string": StringType(), "binary": BinaryType()}
ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

_loaded: dict[str, WordBpe] = {}


def _load(spec: str) -> WordBpe:
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _loaded:
        _loaded[key] = WordBpe(spec)
    return _loaded[key]


def _portions(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, list[str]]]:
    """Texts of a batch in portions of about 4 MB, to bound memory."""
    texts, held, first = [], 0, 0
    for i in range(batch.num_rows):
        t = batch.column(at)[i].as_py() or ""
        texts.append(t)
        held += len(t)
        if held > 4_000_000:
            yield first, texts
            texts, held, first = [], 0, i + 1
    if texts:
        yield first, texts


def encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """docs with a binary column `ids`: the text's ids as little-endian unsigned 32-bit integers."""
    return _apply(docs, vocabulary, text, [(ids, "binary")], lambda bpe, texts: [(e,) for e in bpe.encode_batch(texts)])


def decode(docs: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """docs with a string column `text`: the decoded ids. Null ids decode to ""."""
    return _apply(docs, vocabulary, ids, [(text, "string")], lambda bpe, held: [(bpe.decode(i or b""),) for i in held])


def digests(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """Encode and decode in one pass over the texts and keep only count and digests of both."""

    def work(bpe: WordBpe, texts: list[str]) -> list[tuple]:
        return [
            (len(e) // 4, hashlib.sha256(e).hexdigest(), hashlib.sha256(bpe.decode(e).encode("utf-8", "surrogatepass")).hexdigest())
            for e in bpe.encode_batch(texts)
        ]

    return _apply(docs, vocabulary, text, [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")], work)


def _apply(docs: DataFrame, vocabulary: str, column: str, added: list[tuple[str, str]], work) -> DataFrame:
    """Add columns made by work(bpe, values). A column of the same name is replaced; columns of any other name are kept.

    Null and empty values give empty results, of no tokens; repeated rows stay rows of their own.
    """
    small_batches(docs)
    with open(vocabulary, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # 2 MB, whatever the input
    names = {n.lower() for n, _ in added}
    kept = [f for f in docs.schema.fields if f.name.lower() not in names]
    # by place, so that no name of the input meets one of these; the last one is what the work reads
    held = docs.select(*[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(kept)], F.col(f"`{column}`").alias(f"c{len(kept)}"))
    schema = StructType([*kept, *[StructField(n, KINDS[t]) for n, t in added]])
    out = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _load(spec.value)
        for batch in batches:
            for first, values in _portions(batch, len(out) - len(added)):
                rows = work(bpe, values)
                arrays = batch.slice(first, len(values)).columns[:-1]
                arrays += [pa.array(c, ARROW[t]) for c, (_, t) in zip(zip(*rows, strict=True), added, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, out)

    return held.mapInArrow(run, schema)
