"""Language identification by hierarchical discrimination (operator 10).

First the language family, then one-versus-one linear support vector machines between the languages of that family.
Features are hashed byte n-grams of the whole text. The machines are fitted on a bounded sample of labelled rows
(`per_language` rows a language, chosen by a hash of doc_id and text); every text is then classified whole.

Defined cases: null texts and texts without a letter are `und` with score 0; null labels teach nothing; with no
labelled row all texts are `und`; with one language all others get it; an empty table gives an empty result; other
columns are kept, but for those that the result names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, small_batches

DIM = 4096
#: Languages of common families, by ISO 639-1 code. A code that is in none is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "indic": "hi ur bn pa mr gu ne",
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}
_letter = regex.compile(r"\p{L}").search
#: Bytes of lower-case ASCII letters and of all beyond ASCII stand for themselves, all others for a space.
_TABLE = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def features(text: str) -> np.ndarray:
    """Square roots of the counts of hashed byte bi- and trigrams and words' edges, at unit length."""
    b = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace").translate(_TABLE), np.uint8)
    x = b.astype(np.uint32)
    pair = x[:-1] * np.uint32(257) + x[1:]
    keep = (b[:-1] != 32) | (b[1:] != 32)
    triple = pair[:-1] * np.uint32(263) + x[2:]
    grams = np.concatenate((pair[keep], triple[keep[:-1] & keep[1:]]))
    at = (grams * np.uint32(2654435761)) >> np.uint32(20)
    v = np.sqrt(np.bincount(at, minlength=DIM))
    n = np.linalg.norm(v)
    return (v / n if n else v).astype(np.float32)


def svm(x: np.ndarray, y: np.ndarray, c: float = 20.0, steps: int = 150) -> np.ndarray:
    """Linear machine with squared hinge loss and bias (last weight), by accelerated gradient steps. y: -1 or 1."""
    x, y = np.hstack([x, np.ones((len(x), 1), np.float32)]), y.astype(np.float32)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = v = np.zeros(x.shape[1], np.float32)
    rate = 1 / (1 / c + 4.0)
    for k in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v))
        grad = v / np.float32(c) - 2 * (x.T @ (weight * y * slack))
        step = v - np.float32(rate) * grad
        v, w = step + np.float32(k / (k + 3)) * (step - w), step
    return w


class Hierarchy:
    """A machine for each pair of families, and for each pair of languages of one family."""

    def __init__(self, x: np.ndarray, lang: list[str]):
        self.langs = sorted(set(lang))
        self.family = {s: _FAMILY.get(s.lower().split("-")[0], s) for s in self.langs}
        lang_of = np.array(lang)
        family_of = np.array([self.family[s] for s in lang])
        self.families = sorted(set(self.family.values()))
        self.machines = []
        for pick, of in [(self.families, family_of)] + [([s for s in self.langs if self.family[s] == f], lang_of) for f in self.families]:
            for a, b in combinations(pick, 2):
                rows = (of == a) | (of == b)
                self.machines.append((a, b, svm(x[rows], np.where(of[rows] == a, 1, -1))))
        self.w = np.stack([m for _, _, m in self.machines], 1) if self.machines else np.zeros((x.shape[1] + 1, 0))

    def _vote(self, margin: np.ndarray, pick: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of each row the class with most wins (then the larger sum of margins), and how sure that is."""
        wins = np.zeros((len(margin), len(pick)))
        total, least = np.zeros_like(wins), np.full(wins.shape, 8.0)
        for k, (a, b, _) in enumerate(self.machines):
            if a in pick and b in pick:
                i, j, m = pick.index(a), pick.index(b), margin[:, k]
                wins[:, i] += m > 0
                wins[:, j] += m <= 0
                total[:, i] += np.tanh(m)
                total[:, j] -= np.tanh(m)
                least[:, i], least[:, j] = np.minimum(least[:, i], m), np.minimum(least[:, j], -m)
        best = (wins + total / (1 + 2 * len(pick))).argmax(1)
        sure = 1 / (1 + np.exp(-4 * least[np.arange(len(best)), best]))
        return best, sure

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        margin = x @ self.w[:-1] + self.w[-1]
        best, sure = self._vote(margin, self.families)
        out, score = [""] * len(x), sure.copy()
        for f, name in enumerate(self.families):
            rows = np.flatnonzero(best == f)
            pick = [s for s in self.langs if self.family[s] == name]
            if rows.size:
                inner, sure_in = self._vote(margin[rows], pick)
                for r, i in zip(rows, inner, strict=True):
                    out[r] = pick[i]
                score[rows] *= sure_in
        return out, np.clip(score, 0.0, 1.0)


def held_out(doc_id: F.Column) -> F.Column:
    """Rows that are kept from training: crc32 of doc_id as text, mod 4, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


#: Rows that teach at most, in all languages: about 16 KB each in the driver.
ROWS = 30_000


def fit(docs: DataFrame, per_language: int = 300, most: int = 1000, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Hierarchy | None:
    """Fit on at most per_language labelled rows a language that aren't held out; None without any.

    Rows are chosen by a hash of doc_id and text; rows that repeat both count once. Each teaches its whole text and, so
    that short texts are known as well, an excerpt of 80 characters from its middle. More than `most` languages raise;
    where there are so many that ROWS would be exceeded, each teaches ROWS / languages rows.
    """
    rows = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{doc_id}`").alias("id"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("id")))
    rows = rows.withColumn("h", F.xxhash64(F.lit(17), "id", "text"))
    sized = cut(rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")))  # different rows, however often they repeat
    languages = sized.count()
    if languages > most:
        raise ValueError(f"more than {most} languages are labelled")
    per_language = min(per_language, ROWS // max(1, languages))
    # about four times what is asked of each language passes, in every partition alike; the rank is exact among these
    share = F.col("h") / F.lit(2.0**64) + 0.5
    some = rows.join(F.broadcast(sized), "lang").where(share < F.lit(4.0 * per_language) / F.col("n"))  # `most` rows
    few = some.groupBy("lang", "h").agg(F.first("text").alias("text"))
    order = Window.partitionBy("lang").orderBy("h")
    chosen = few.withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_language).select("lang", "h", "text")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = [(r.lang, features(t).astype("<f2").tobytes(), r.h) for r in p.itertuples() for t in (r.text, r.text[len(r.text) // 2 :][:80])]
            yield pd.DataFrame(out, columns=["lang", "x", "h"])

    sample = chosen.mapInPandas(run, "lang string, x binary, h long").toPandas().sort_values(["lang", "h", "x"])
    if sample.empty:
        return None
    return Hierarchy(np.stack([np.frombuffer(b, "<f2") for b in sample["x"]]).astype(np.float32), list(sample["lang"]))


def identify(docs: DataFrame, model: Hierarchy | None, text: str = "text") -> DataFrame:
    """docs with lang_pred (`und` where there is no letter) and score in 0..1. Only the text is read for it."""
    small_batches(docs)
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"__c{i}" for i in range(len(kept))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("__text"))
            lang, score = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows)
            for first in range(0, batch.num_rows if m is not None else 0, 256):
                texts = column.slice(first, 256).to_pylist()
                rows = [i for i, t in enumerate(texts) if t is not None and _letter(t)]
                if rows:
                    found, sure = m.predict(np.stack([features(texts[i]) for i in rows]))
                    at = np.array(rows) + first
                    lang[at], score[at] = found, sure
            arrays = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(lang, pa.string()), pa.array(score)], [*names, "lang_pred", "score"])

    schema = ", ".join([f"{n} {f.dataType.simpleString()}" for f, n in zip(kept, names, strict=True)] + ["lang_pred string", "score double"])
    found = docs.select(*[F.col(f"`{f.name}`").alias(n) for f, n in zip(kept, names, strict=True)], F.col(f"`{text}`").alias("__text")).mapInArrow(run, schema)
    return found.select(*[F.col(n).alias(f.name) for f, n in zip(kept, names, strict=True)], "lang_pred", "score")
