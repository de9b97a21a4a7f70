"""Secret scan with corpus-wide ownership: who else holds a candidate tells an example from a live credential.

A text is searched once for each kind of candidate. What goes on from there is small: where a candidate stands, how long
it is and the SHA-256 of its value. Hashes are then aggregated over the corpus by distinct owners and repositories: a
value that many owners hold was copied from documentation, one that a single owner holds looks live. Labelled
candidates (`assign`, `access`, `hex`) are reported either way, with that verdict; bare ones, random strings without any
label, become findings only if the corpus says that they are an owner's own.

DataFrame functions only: positions are running sums over the pieces between matches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    group: int = 0  # of the value
    least: int = 0  # characters of the value; shorter matches are dropped after the search


# Labelled candidates in the order that breaks ties. Where a run is matched from its first character to its
# last, a least length inside the pattern gives the same matches as dropping shorter ones.
BASE = (
    Kind("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Kind("access", r"AKIA[A-Z0-9]{14,}"),
    Kind("hex", r"[0-9a-f]{16,}"),
)
#: Candidates without a label: long runs, of which `random_looking` ones count.
BARE = Kind("bare", r"[A-Za-z0-9+/_=-]{20,}")
#: Neighbours of different class, counted without overlap; random letters and digits have one in three characters.
_TURN = r"[a-z][A-Z0-9]|[A-Z][a-z0-9]|[0-9][A-Za-z]"
#: Owners that may share a live credential (forks and copies); more make it an example.
OWNERS = 2
#: Parts that the rows of one hash are dealt to when verdicts are joined.
SALTS = 16
#: Columns that results have of their own; those of the input that are named so are left out.
ADDED = ("__at", "__all", *[f"n_{k.name}" for k in BASE], "base", "spans")


def random_looking(v: Column) -> Column:
    """Upper case, lower case, three digits, not all in one place, and a change of class in every fourth character."""
    return v.rlike("[A-Z]") & v.rlike("[a-z]") & (F.regexp_count(v, F.lit("[0-9]")) >= 3) & v.rlike("[0-9][^0-9]+[0-9]") & (F.regexp_count(v, F.lit(_TURN)) * 4 >= F.length(v))


def _found(text: Column, kind: Kind, place: int) -> Column:
    """Matches of a kind in order: (kind, before: characters since the last match, size, value hash, ok).

    Each piece that `split` gives is followed by the match that `regexp_extract_all` gives; the last by none.
    """
    whole = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)) if kind.group else whole

    def one(z: Column) -> Column:
        ok = F.length(z["value"]) >= kind.least if kind is not BARE else random_looking(z["value"])
        return F.struct(
            F.lit(place).alias("kind"), F.length(z["piece"]).alias("before"), F.length(z["whole"]).alias("size"),
            F.when(ok, F.sha2(z["value"].cast("binary"), 256)).alias("hash"),
        )

    zipped = F.arrays_zip(whole.alias("whole"), value.alias("value"), F.split(text, kind.pattern, -1).alias("piece"))
    made = F.transform(F.filter(zipped, lambda z: z["whole"].isNotNull()), one)
    return F.when(text.rlike(kind.pattern), made)


def candidates(docs: DataFrame, text: str = "text", owner: str = "source", repository: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows, hits): docs without their texts and with a row number __at; (__at, owner, repository, kind, start, end, hash).

    rows are written once, so both sides number them alike. kind is a place in (*BASE, BARE); start and end count code
    points, end exclusive. A null owner or repository is one of its own. Hits are those that pass their kind's test.
    """
    kinds = (*BASE, BARE)
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.toDF(*names.values())
    own = {c: n for c, n in names.items() if c not in (text, *ADDED)}
    body = F.coalesce(F.col(names[text]).cast("string"), F.lit(""))
    held = F.col(names[owner]).cast("string").alias("__owner"), F.col(names[repository]).cast("string").alias("__repository")
    rows = cut(renamed.select(*own.values(), *held, *[_found(body, k, i).alias(f"__k{i}") for i, k in enumerate(kinds)]))
    rows = rows.withColumn("__at", F.monotonically_increasing_id())
    per_kind = F.array_compact(F.array(*[F.col(f"__k{i}") for i in range(len(kinds))]))
    each = rows.select("__at", "__owner", "__repository", F.explode(per_kind).alias("m")).select("__at", "__owner", "__repository", F.posexplode("m").alias("i", "m"))
    each = each.repartition("__at").select("__at", "__owner", "__repository", "i", "m.*")
    so_far = W.partitionBy("__at", "kind").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    each = each.withColumn("end", F.sum(F.col("before") + F.col("size")).over(so_far))
    hits = each.where("hash is not null").select("__at", "__owner", "__repository", "kind", (F.col("end") - F.col("size")).alias("start"), "end", "hash")
    plain = rows.select("__at", *[F.col(n).alias(c) for c, n in own.items()])
    return plain, hits


def ownership(hits: DataFrame, owners: int = OWNERS) -> DataFrame:
    """(hash, seen, owners, repositories, labelled, verdict): over the corpus, of each candidate hash.

    Distinct owners and repositories are counted on partial aggregates, so a value that a third of all rows hold is
    one row a task before it is exchanged. verdict: `example` with more than `owners` owners, else `live`.
    """
    named = lambda c: F.coalesce(F.concat(F.lit("+"), F.col(c)), F.lit(""))
    x = hits.groupBy("hash", named("__owner").alias("o"), named("__repository").alias("r")).agg(F.count("*").alias("n"), F.min("kind").alias("k"))
    x = x.groupBy("hash").agg(F.sum("n").alias("seen"), F.count_distinct("o").alias("owners"), F.count_distinct("r").alias("repositories"), (F.min("k") < len(BASE)).alias("labelled"))
    return x.withColumn("verdict", F.when(F.col("owners") > owners, "example").otherwise("live"))


def scan(docs: DataFrame, text: str = "text", owner: str = "source", repository: str = "doc_id", owners: int = OWNERS) -> tuple[DataFrame, DataFrame]:
    """(rows, findings) of docs: rows without their texts and with a row number __at, and for each finding
    (__at, kind, start, end, hash, owners, repositories, verdict).

    Labelled findings are matches from the left without overlap, kind by kind. Bare ones are added where they overlap
    none of these and are `live`. Null and empty texts have no finding; texts of any length are searched whole; rows that
    repeat are rows of their own, and their value counts once for each distinct owner and repository; null owners are one
    owner. An empty table gives empty results. Extra columns are kept, but for those named as in
    ADDED.
    """
    rows, hits = candidates(docs, text, owner, repository)
    hits = cut(hits)
    known = ownership(hits, owners).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = hits.withColumn("salt", F.pmod("__at", F.lit(SALTS)).cast("int"))
    told = salted.join(known, ["hash", "salt"]).select("__at", "kind", "start", "end", "hash", "owners", "repositories", "verdict")
    bare = F.col("kind") == len(BASE)
    told = told.where(~bare | (F.col("verdict") == "live")).repartition("__at")
    by = W.partitionBy("__at")
    others = W.unboundedPreceding, -1
    before = F.max(F.when(~bare, F.col("end"))).over(by.orderBy("start", "kind").rowsBetween(*others))
    after = F.min(F.when(~bare, F.col("start"))).over(by.orderBy(F.desc("start"), F.desc("kind")).rowsBetween(*others))
    told = told.withColumns({"__before": before, "__after": after})
    alone = (F.coalesce("__before", F.lit(0)) <= F.col("start")) & (F.coalesce(F.col("__after") >= F.col("end"), F.lit(True)))
    names = F.element_at(F.array(*[F.lit(k.name) for k in (*BASE, BARE)]), F.col("kind") + 1)
    return rows, told.where(~bare | alone).select("__at", names.alias("kind"), F.col("kind").alias("place"), "start", "end", "hash", "owners", "repositories", "verdict")


def spans(rows: DataFrame, findings: DataFrame) -> DataFrame:
    """rows with the findings of each: n_assign, n_access, n_hex, and base and all as sorted `kind:start:end` texts.

    The findings of one document are gathered in its row.
    """
    one = F.struct("start", "place", "end", "kind")
    each = findings.groupBy("__at").agg(F.sort_array(F.collect_list(one)).alias("__all"))

    def told(a: Column) -> Column:
        return F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(k: int) -> Column:
        return F.coalesce(F.size(F.filter("__all", lambda s: s["place"] == k)), F.lit(0)).cast("long")

    base = F.filter("__all", lambda s: s["place"] < len(BASE))
    out = rows.join(each, "__at", "left").withColumn("__all", F.coalesce("__all", F.array().cast(each.schema["__all"].dataType)))
    return out.withColumns({**{f"n_{k.name}": count(i) for i, k in enumerate(BASE)}, "base": told(base), "spans": told(F.col("__all"))}).drop("__at", "__all")
