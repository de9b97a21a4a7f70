"""Readers and writers. Paths may be anything that Spark's readers open."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scan import FEW, ordered

# Layouts of the files.
OBSERVATIONS = "Index int, Location string, TL date, TR date, deaths long, sCh long, cCh long, CFR double, reporting_date date, source_index int, source string, confidence_weight double, processing_notes string"
SOURCES = "Index int, Source string, URL string, Description string, Date_Range string, Data_Type string, Status string, Reliability_Level string, Validation_Status string, Search_Technique string, Language_Original string, Citation_Depth string, Cross_References string, Discovery_Method string"
SURVEILLANCE = "country string, iso_code string, year int, week int, date_start date, date_stop date, cases long, deaths long, source string"
PLACES = "iso_code string, country_name string, region string, subregion string, mosaic_framework boolean, who_afro boolean, ssa boolean, ai_cholera_coverage boolean"
#: The place of a file: the folder that it stands in, as name or as name=value; agent=n or name=file may stand between.
_PLACE = r"/(?:[^/=]+=)?([^/=]+)(?:/(?:agent|name)=[^/]+)?/[^/]+$"
_AGENT = r"agent[_=](\d+)(?:\.txt)?(?:$|/)"
_NAME = r"/(?:name=)?([^/=]+)(?:/part-[^/]+)?$"


def _csv(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    return spark.read.schema(schema + ", _corrupt_record string").options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record", quote='"', escape='"', recursiveFileLookup="true", **options).csv(path)


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """All places' observation files in one read; malformed rows keep their text in _corrupt_record."""
    return _csv(spark, path, OBSERVATIONS).withColumn("iso", F.regexp_extract("_metadata.file_path", _PLACE, 1))


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, SOURCES).withColumn("iso", F.regexp_extract("_metadata.file_path", _PLACE, 1))


def read_surveillance(spark: SparkSession, path: str) -> DataFrame:
    """The weekly baseline; NA is null, stray quotes go."""
    names = [c.split()[0] for c in SURVEILLANCE.split(", ")]
    raw = spark.read.schema(", ".join(f"{n} string" for n in names)).options(header=True, quote="\u0000").csv(path)
    types = dict(c.split() for c in SURVEILLANCE.split(", "))
    clean = lambda n: F.nullif(F.regexp_replace(n, '"', ""), F.lit("NA"))
    return raw.select(*[clean(n).try_cast(types[n]).alias(n) for n in names])


def read_places(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PLACES).options(header=True).csv(path)


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """One row a log: iso, agent, content."""
    x = spark.read.text(path, wholetext=True, recursiveFileLookup=True).withColumn("p", F.col("_metadata.file_path"))
    return x.select(F.regexp_extract("p", _PLACE, 1).alias("iso"), F.regexp_extract("p", _AGENT, 1).try_cast("int").alias("agent"), F.col("value").alias("content"))


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """The files below a folder of places: iso, name, bytes, modified. Files are listed, their contents aren't read.

    A folder name=... with parts, as Spark writes it, is one file of that name.
    """
    x = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    x = x.select(F.regexp_extract("path", _PLACE, 1).alias("iso"), F.regexp_extract("path", _NAME, 1).alias("name"), "length", "modificationTime")
    return x.groupBy("iso", "name").agg(F.sum("length").alias("bytes"), F.max("modificationTime").alias("modified"))


#: Files of many places in few containers: a row a line, lines in order of `at`, the line of names at -1.
PACKED = "iso string, name string, at long, bytes long, value string"
_LOG = "search_log_agent_"


def pack(lines: DataFrame, path: str) -> None:
    """Appends lines(iso, name, at, value) of places' files to the containers at path.

    With a file in a folder for each place and name, what it takes to make, commit and open them outweighs what they
    hold. A container takes the lines of any number of files, and lines of one file may stand in several containers.
    """
    size = (F.octet_length("value") + 1).cast("long").alias("bytes")
    lines.select("iso", "name", F.col("at").cast("long").alias("at"), size, "value").write.mode("append").parquet(path)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PACKED).parquet(path)


def packed_inventory(spark: SparkSession, path: str) -> DataFrame:
    """What read_inventory tells of a folder, of containers: iso, name, bytes, modified. Contents aren't read; a file is as
    new as the newest container that holds a line of it."""
    x = read_packed(spark, path).select("iso", "name", "bytes", F.col("_metadata.file_modification_time").alias("modified"))
    return x.groupBy("iso", "name").agg(F.sum("bytes").alias("bytes"), F.max("modified").alias("modified"))


def _packed_csv(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "quote": '"', "escape": '"'}
    x = read_packed(spark, path).where((F.col("name") == name) & (F.col("at") >= 0))
    return x.select("iso", F.from_csv("value", schema + ", _corrupt_record string", options).alias("r")).select("r.*", "iso")


def packed_observations(spark: SparkSession, path: str) -> DataFrame:
    return _packed_csv(spark, path, "observations.csv", OBSERVATIONS)


def packed_sources(spark: SparkSession, path: str) -> DataFrame:
    return _packed_csv(spark, path, "metadata.csv", SOURCES)


def packed_logs(spark: SparkSession, path: str) -> DataFrame:
    """One row a log: iso, agent, content."""
    x = read_packed(spark, path).where(F.col("name").startswith(_LOG))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda r: F.concat(r["value"], F.lit("\n")))
    x = x.groupBy("iso", "name").agg(F.array_join(lines, "").alias("content"))
    return x.select("iso", F.regexp_extract("name", _AGENT, 1).try_cast("int").alias("agent"), "content")


def read_text_safe(spark: SparkSession, path: str) -> DataFrame:
    """Files as text: UTF-8, else Latin-1."""
    x = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return x.select("path", F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string")).otherwise(F.decode("content", "ISO-8859-1")).alias("text"))


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """(iso, kind, header): the first line of each file, whose kind is a folder kind=... or `meta` by its name, else
    `data`. Only the first block of a file is looked at; within it rows keep their order."""
    x = spark.read.option("recursiveFileLookup", True).text(path).where("_metadata.file_block_start = 0")
    x = x.select(F.col("_metadata.file_path").alias("p"), "value", F.monotonically_increasing_id().alias("at"))
    first = x.groupBy("p").agg(F.min_by("value", "at").alias("header"))
    named = F.nullif(F.regexp_extract("p", r"/kind=([^/]+)/", 1), F.lit(""))
    kind = F.coalesce(named, F.when(F.col("p").rlike(r"/meta[^/]*$"), "meta").otherwise("data"))
    return first.select(F.regexp_extract("p", _PLACE, 1).alias("iso"), kind.alias("kind"), "header")


def align_versions(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite").partitionBy(*(partition_by or []))
    w.option("header", True).csv(path) if fmt == "csv" else w.format(fmt).save(path)


def in_parts(rows: DataFrame, key: str, order: list[str], text: str, glue: str, bound: int) -> DataFrame:
    """(key, part, text) of rows(key, order.., text): the texts of a key in order, glued, as parts that join up.

    Part p holds the rows whose bytes begin between p and p + 1 times `bound`, with the glue before each row but the key's
    first; so a part has fewer than `bound` bytes and its last row. Where rows begin is a running sum over ranges of a
    key, so no task or value holds a key whole.
    """
    size = F.octet_length(text) + len(glue.encode())
    held = ordered(rows.select(key, *order, text), key, [*order, text]).numbered("__n").running("__end", size.cast("long")).done()
    start = F.col("__end") - size
    body = F.when(F.col("__n") > 1, F.concat(F.lit(glue), text)).otherwise(F.col(text))
    held = held.select(key, F.floor(start / bound).cast("long").alias("part"), "__n", body.alias("__body"))
    gathered = F.array_sort(F.collect_list(F.struct("__n", "__body")))
    return held.groupBy(key, "part").agg(gathered.alias("__r")).select(key, "part", F.array_join(F.transform("__r", lambda r: r["__body"]), "").alias(text))


#: Bytes of a payload's part.
PART = 4_000_000


def csv_payload_per_key(df: DataFrame, key: str, order: list[str], bound: int = PART) -> DataFrame:
    """(key, part, payload): CSV text of each key's rows in order, escaped for a template literal, in numbered parts.

    Part -1 is the line of names; the parts of a key, one after the other, are its whole text. A part has fewer than
    `bound` bytes and one row.
    """
    cols = [c for c in df.columns if c != key]
    text = F.to_csv(F.struct(*cols))
    for a, b in (("\\", "\\\\"), ("`", "\\`"), ("${", "\\${")):
        text = F.replace(text, F.lit(a), F.lit(b))
    names = df.select(key).distinct().select(key, F.lit(-1).cast("long").alias("part"), F.lit(",".join(cols) + "\n").alias("payload"))
    return names.unionByName(in_parts(df.select(key, *order, text.alias("payload")), key, order, "payload", "\n", bound))


def json_rows(df: DataFrame, integers: list[str], doubles: list[str]) -> DataFrame:
    """Each row as JSON: counts as integers, shares as doubles (0 for blanks), all else as text ('' for null)."""

    def typed(c: str) -> Column:
        if c in integers or c in doubles:
            kind = "bigint" if c in integers else "double"
            return F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).try_cast(kind), F.lit(0).cast(kind)).alias(c)
        return F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)

    return df.select(F.col(df.columns[0]).alias("key"), F.to_json(F.struct(*[typed(c) for c in df.columns])).alias("json"))


def place_groups_json(places: DataFrame, flags: list[str], attributes: list[str], main: str | None = None, bound: int = PART) -> DataFrame:
    """(section, name, part, json) of a place table with iso and subregion.

    groups: members of `all`, of each flag and of each subregion, as a JSON list in parts that join up; places: the
    attributes of each place; breakdown: of each subregion how many places it has and how many have the flag `main`, its
    members being its group. Part 0 opens a list, and a list's last part closes it.
    """
    names = F.array(F.lit("all"), *[F.when(F.col(c), F.lit(c)) for c in flags], F.col("subregion"))
    member = places.select("iso", F.explode(F.array_compact(names)).alias("name"))
    quoted = member.select("name", "iso", F.regexp_replace(F.to_json(F.array("iso")), r"^\[|\]$", "").alias("json"))
    parts = in_parts(quoted, "name", ["iso"], "json", ",", bound)
    last = parts.groupBy("name").agg(F.max("part").alias("__last"))
    parts = parts.join(F.broadcast(last) if last.count() <= FEW else last, "name")
    ends = F.concat(F.when(F.col("part") == 0, "[").otherwise(""), "json", F.when(F.col("part") == F.col("__last"), "]").otherwise(""))
    groups = parts.select(F.lit("groups").alias("section"), "name", "part", ends.alias("json"))
    zero = F.lit(0).cast("long").alias("part")
    each = places.select(F.lit("places").alias("section"), F.col("iso").alias("name"), zero, F.to_json(F.struct(*attributes), {"ignoreNullFields": "false"}).alias("json"))
    sums = places.groupBy("subregion").agg(F.count("*").alias("count"), F.count_if(main or flags[0]).alias("main"))
    counts = sums.select(F.lit("breakdown").alias("section"), F.col("subregion").alias("name"), zero, F.to_json(F.struct("count", "main")).alias("json"))
    return groups.unionByName(each).unionByName(counts)
