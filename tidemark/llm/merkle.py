"""Merkle manifest of a dataset: a root digest, and for every row a witness that folds to it.

Leaves stream into an `Appender` in order. Each open subtree holds its leaves with their partial witnesses; when the
last sibling of a run arrives, the witness of every leaf below the run grows by the digests beside its own subtree, and
the run's digest is appended one level up. Spark deals aligned blocks of arity ** levels leaves to tasks; the digest of a
block is a further append to the tree above, which is dealt in blocks again until a tree has one node. So no task holds
more than a block, whatever the size of a source.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructType

from .common import cut, small

#: Children of a node.
ARITY = 16
#: Levels of a block: 16 ** 3 = 4096 leaves, about 12 MB of witnesses in a task.
LEVELS = 3
_WITNESS = ArrayType(StructType().add("at", "integer").add("siblings", "string"))
_ROOTS = StructType().add("__k", "string").add("__block", "long").add("__n", "long").add("__node", "string")


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Appender:
    """A tree that grows by appends. A leaf's witness is [(its subtree's place in the run, the other digests), ..]."""

    def __init__(self, arity: int = ARITY) -> None:
        self.arity = arity
        self.open: list[list[tuple[str, list[list]]]] = [[]]

    def append(self, node: str) -> list:
        """Add a node on the lowest level; the witness that is returned goes on growing."""
        witness: list = []
        self._add(0, node, [witness])
        return witness

    def _add(self, level: int, node: str, below: list[list]) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append((node, below))
        if len(self.open[level]) == self.arity:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        nodes = [node for node, _ in run]
        for at, (_, below) in enumerate(run):
            step = (at, "".join(nodes[:at] + nodes[at + 1 :]))
            for witness in below:
                witness.append(step)
        self._add(level + 1, digest(nodes), [witness for _, below in run for witness in below])

    def close(self, levels: int | None = None) -> str:
        """End short runs and return the root. levels: raise to that level, as a block that has others beside it."""
        level = 0
        while level < levels if levels is not None else len(self.open[level]) > 1 or any(self.open[level + 1 :]):
            if self.open[level]:
                self._complete(level)
            level += 1
        return self.open[level][0][0]


def leaves(docs: DataFrame, columns: list[str], text: str = "text", lower: bool = False) -> Column:
    """Digest of a row: each column `-` if null, else UTF-8 byte count, `:`, value. lower: A-Z of the text lowered."""

    def part(c: str) -> Column:
        v = F.col(c).cast("string")
        if lower and c == text:
            v = F.translate(v, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))

    return F.sha2(F.concat(*[part(c) for c in columns]).cast("binary"), 256)


def placed(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """rows with __pos, a row's place in its key's order (from 0), and __n, the key's rows. Both long.

    Rows are written, dealt and sorted by (key, order), and written again; places are a row's number within its partition, less the
    key's first there, plus the key's rows in partitions before. A key may span all partitions.
    """
    by = [key, *order, "__tie"]
    held = cut(rows.withColumn("__tie", F.monotonically_increasing_id()))
    held = cut(held.repartitionByRange(*by).sortWithinPartitions(*by)).withColumn("__at", F.monotonically_increasing_id())
    part = F.shiftright("__at", 33)
    runs = held.groupBy(F.col(key).alias("__key"), part.alias("__part")).agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    each = W.partitionBy("__key")
    before = F.sum("__rows").over(each.orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    runs = cut(runs.withColumns({"__before": F.coalesce(before, F.lit(0)), "__n": F.sum("__rows").over(each)}))
    joined = held.withColumn("__part", part).join(small(runs), F.col(key).eqNullSafe(F.col("__key")) & (part == runs["__part"]))
    return joined.withColumn("__pos", F.col("__at") - F.col("__first") + F.col("__before")).select(*rows.columns, "__pos", "__n")


def _stream(arity: int, levels: int, witnesses: bool, schema: pa.Schema):
    """Blocks arrive whole and in order in each partition; a block's rows may span batches."""
    size = arity**levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, tree, held, grown = None, None, [], []

        def done() -> pa.RecordBatch:
            key, block, n = at
            root = tree.close(levels if n > size else None)
            if not witnesses:
                return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(([key], [block], [n], [root]), schema.types, strict=True)], schema=schema)
            rows = pa.Table.from_batches(held).combine_chunks()
            more = pa.array([[{"at": a, "siblings": s} for a, s in w] for w in grown], schema.field("__own").type)
            table = rows.append_column("__own", more).append_column("__root", pa.array([root] * len(grown), pa.string()))
            return table.cast(schema).to_batches()[0]

        for batch in batches:
            keys, places, sizes, nodes = (batch.column(c).to_pylist() for c in ("__k", "__pos", "__n", "__node"))
            first = 0
            for i, (key, pos, n, node) in enumerate(zip(keys, places, sizes, nodes, strict=True)):
                here = (key, pos // size, n)
                if here != at:
                    if at is not None:
                        if witnesses:
                            held.append(batch.slice(first, i - first))
                        yield done()
                    at, tree, held, grown, first = here, Appender(arity), [], [], i
                grown.append(tree.append(node))
            if witnesses and at is not None:
                held.append(batch.slice(first))
        if at is not None:
            yield done()

    return run


def grow(nodes: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """Trees over nodes(__k, __pos, __n, __node, ..): (nodes with their whole __witness, a root for each key).

    __k is text and not null; a key's places run from 0 to __n - 1.
    """
    size = arity**levels
    plain = nodes.columns
    dealt = nodes.withColumn("__block", F.expr(f"__pos div {size}")).repartition("__k", "__block").sortWithinPartitions("__k", "__block", "__pos")
    out = StructType([*dealt.schema.fields]).add("__own", _WITNESS).add("__root", "string")
    own = dealt.mapInArrow(_stream(arity, levels, True, to_arrow_schema(out)), out)
    roots = cut(dealt.select("__k", "__pos", "__n", "__node").mapInArrow(_stream(arity, levels, False, to_arrow_schema(_ROOTS)), _ROOTS))
    most = nodes.agg(F.max("__n")).first()[0]
    if most is None or most <= size:
        return own.withColumn("__witness", F.col("__own")).select(*plain, "__witness"), roots.select("__k", "__node")
    above = roots.select("__k", F.col("__block").alias("__pos"), F.expr(f"(__n + {size - 1}) div {size}").alias("__n"), "__node")
    grown, tops = grow(above, arity, levels)
    grown = small(grown.select(F.col("__k").alias("__k2"), F.col("__pos").alias("__b2"), F.col("__witness").alias("__above")))
    whole = own.join(grown, (F.col("__k") == F.col("__k2")) & (F.col("__block") == F.col("__b2")))
    return whole.withColumn("__witness", F.concat("__own", "__above")).select(*plain, "__witness"), tops


def fold(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and its witness give."""

    def step(acc: Column, w: Column) -> Column:
        left = F.substring(w["siblings"], F.lit(1), w["at"] * 64)
        return F.sha2(F.concat(left, acc, F.substr(w["siblings"], w["at"] * 64 + 1)).cast("binary"), 256)

    return F.aggregate(witness, leaf, step)


def manifest(docs: DataFrame, columns: list[str], group: str = "source", order: str = "doc_id", carried: dict[str, Column] | None = None, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """(order, the carried columns, leaf, subroot, root, witness) of each row of docs.

    columns go into the leaves. A tree for each group holds its leaves by `order`; one above holds the groups' roots by
    name. witness: array of (at, siblings), from the leaf's run to the root: the digests beside its own subtree, and
    where among them it stands; `fold` gives the root again.

    A null group is a group of its own and first; null orders come first in a group, equal ones by digest, and rows that
    are equal in all columns stand in any order, which changes no digest. Null and empty texts are leaves like others;
    texts of any length are hashed whole. An empty table gives an empty result. Extra columns are left out, whatever
    their names; `carried` gives those to keep, none of them named leaf, subroot, root, witness or __*.
    """
    key = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))  # sorts as the groups do, null first
    extra = {f"__x{i}": c for i, c in enumerate((carried or {}).values())}
    rows = docs.select(key.alias("__k"), F.col(order).alias("__order"), leaves(docs, columns).alias("__node"), *[c.alias(n) for n, c in extra.items()])
    below, subroots = grow(placed(rows, "__k", ["__order", "__node"]), arity, levels)
    tops = placed(subroots.select(F.lit("").alias("__k"), F.col("__k").alias("__name"), "__node"), "__k", ["__name"])
    above, root = grow(tops, arity, levels)
    top = root.first()  # one row, none if the table is empty
    above = small(above.select("__name", F.col("__node").alias("__sub"), F.lit(top and top["__node"]).cast("string").alias("__top"), F.col("__witness").alias("__up")))
    joined = below.join(above, F.col("__k") == F.col("__name"))
    kept = [F.col(n).alias(name) for n, name in zip(extra, carried or {}, strict=True)]
    return joined.select(F.col("__order").alias(order), *kept, F.col("__node").alias("leaf"), F.col("__sub").alias("subroot"), F.col("__top").alias("root"), F.concat("__witness", "__up").alias("witness"))
