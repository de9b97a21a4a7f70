"""The training-data pipeline: five stages from documents to token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, langid, mixing, ngram_join, pii
from tidemark.llm.common import by_exchange, cut, table, without
from tidemark.llm.queries import PII_KEY, VOCABULARY

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language can be told go; null labels are filled in with the language found.

    Null and empty texts, and texts without a letter, go; texts of any length are read whole; null and repeated ids
    and repeated rows stay as they are; an empty table gives an empty one; other columns than documents' go.
    """
    found = langid.identify(docs.select(*COLUMNS), langid.fit(docs))
    return found.where("lang_pred <> 'und'").withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group linked by five-word shingles at a similarity of 0.8: the smallest doc_id.

    Rows that repeat a doc_id are one document if their whole text is equal, else documents of their own; of equal ids
    in a group the one with the smaller hash of its text stays, so reruns agree. Rows without an id, and null or empty
    texts, link with nothing and stay; an empty table gives an empty one.
    """
    with by_exchange(spark):
        return _one_of_each_group(docs.select(*COLUMNS))


def _one_of_each_group(docs: DataFrame) -> DataFrame:
    often = cut(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if often.isEmpty():
        found = ngram_join.jaccard_join(docs.select("doc_id", "text"), n=5, percent=80)
        return without(docs, found.where("component_id <> doc_id"), "doc_id").select(*COLUMNS)
    repeats = docs.join(often, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct("lang", "source", "n_chars")).alias("r"))
    rows = without(docs, often, "doc_id").select(*COLUMNS).unionByName(repeats.select("doc_id", "text", "r.*"))
    rows = cut(rows.withColumn("at", F.monotonically_increasing_id()).withColumn("at", F.expr("if(doc_id is null, null, at)")))
    found = ngram_join.jaccard_join(rows.select("at", "text"), n=5, percent=80, doc_id="at").select(F.col("doc_id").alias("at"), "component_id")
    named = cut(found.join(rows.select("at", "doc_id", F.xxhash64("text").alias("h")), "at"))
    first = named.groupBy("component_id").agg(F.min(F.struct("doc_id", "h", "at")).alias("first"))
    gone = named.join(first, "component_id").where(F.col("at") != F.col("first.at"))
    return without(rows, gone, "at").select(*COLUMNS)


def replace_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Private data in the texts become surrogates, and n_chars follows.

    Rows keep their number and ids, null or repeated; null texts stay null, with a null n_chars; texts without private
    data, of any length, stay as they are; an empty table gives an empty one.
    """
    done = pii.replace(docs.select(*COLUMNS), PII_KEY)
    return done.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it: 0, 1 or 2 rows. Copies go to rows, so ids may be null or repeated.

    Null sources are a source of their own. Rows of null, empty or blank texts have size 0 and take part in no token
    count: they stay as often as the rate of their source's smallest rows says. An empty table gives an empty one.
    """
    rows = cut(docs.select(*COLUMNS).withColumn("at", F.monotonically_increasing_id()))
    sized = rows.select("at", "text", "source", F.struct("doc_id", F.xxhash64("text").alias("h")).alias("id"))
    copies = mixing.mix_sources(sized, doc_id="id").where("copies > 0").select("at", "copies")
    taken = rows.join(copies, "at")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every row.

    A row each, whatever its id; null texts count as empty, with no token; an empty table gives an empty one.
    """
    return bpe.digests(docs.select("doc_id", "text"), VOCABULARY).drop("text")


STAGES = [
    ("language", keep_known_language),
    ("near_duplicates", keep_one_of_each_group),
    ("private_data", replace_private_data),
    ("mixing", mix),
    ("encoding", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each is cut from its predecessor by a checkpoint in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs
