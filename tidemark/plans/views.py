"""The coverage schema as views of the given tables, for Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# One text serves both: Spark and DuckDB read the same SQL here.
SQL = {
    "v_place": "select concat('N', n_nationkey) as iso, n_name as country, r_name as subregion, n_regionkey in (0, 2) as flag, cast(n_nationkey as bigint) as num from nation join region on n_regionkey = r_regionkey",
    "v_site": "select concat('C', c_custkey) as iso, c_name as country, n_name as region, r_name as subregion, n_regionkey in (0, 2) as flag, c_mktsegment = 'BUILDING' as flag2 from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey",
    "v_seller": "select concat('S', s_suppkey) as iso from supplier",
    "v_base": "select concat('N', c_nationkey) as iso, cast(o_orderdate as date) as date_start, date_add(cast(o_orderdate as date), 6) as date_stop, case when o_orderstatus = 'P' then null else cast(floor(o_totalprice) as bigint) end as cases, case when o_orderstatus = 'F' then null else o_orderkey % 50 end as deaths, case o_orderpriority when '1-URGENT' then 'WHO' when '2-HIGH' then 'JHU' when '3-MEDIUM' then 'SUPP' else null end as source, concat('C', o_custkey) as cust from orders join customer on o_custkey = c_custkey",
    "v_cust": "select concat('C', o_custkey) as iso, cast(o_orderdate as date) as date_start, date_add(cast(o_orderdate as date), 6) as date_stop, case when o_orderstatus = 'P' then null else cast(floor(o_totalprice) as bigint) end as cases, case when o_orderstatus = 'F' then null else o_orderkey % 50 end as deaths, case o_orderpriority when '1-URGENT' then 'WHO' when '2-HIGH' then 'JHU' when '3-MEDIUM' then 'SUPP' else null end as source from orders",
    "v_obs": "select l_orderkey * 10 + l_linenumber as idx, concat('N', s_nationkey) as iso, case s_suppkey % 3 when 0 then concat('AFR::N', s_nationkey) when 1 then concat('AFR::N', s_nationkey, '::P', s_suppkey % 7) else concat('AFR::N', s_nationkey, '::P', s_suppkey % 7, '::D', s_suppkey) end as location, cast(o_orderdate as date) as tl, case when l_linenumber = 7 then null else date_add(cast(o_orderdate as date), cast(l_quantity as int)) end as tr, cast(round(l_tax * 100) as bigint) as deaths, cast(l_quantity as bigint) as scases, cast(null as bigint) as ccases, cast(round(l_discount * 100) as double) as cfr, cast(l_shipdate as date) as reporting_date, s_suppkey as source_index, concat('S', s_suppkey) as source, cast(l_linenumber as double) / 8 as weight, l_returnflag as notes from lineitem join orders on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey",
    "v_src": "select s_suppkey as idx, concat('N', s_nationkey) as iso, case when s_suppkey % 10 = 0 then 'S0' else concat('S', s_suppkey) end as source, concat('https://www.site', s_suppkey % 5, '.org/x') as url, case when s_suppkey % 7 = 0 then '' else concat('T', s_suppkey % 3) end as data_type, case when s_suppkey % 2 = 0 then 'Active' else 'Archived' end as status, case s_suppkey % 4 when 0 then 'Level_1' when 1 then 'Level 2' when 2 then '3' else 'Level_4' end as reliability from supplier where s_acctbal > 0",
    "v_batch": "select conv_id as iso, turn as batch, cast(length(text) % 20 as bigint) as yield from (select conv_id, turn, max(text) as text from conversations where text is not null group by conv_id, turn) t",
    "v_log": "select concat('N', doc_id % 25) as iso, cast(doc_id % 6 + 1 as bigint) as agent, coalesce(text, '') as content from documents",
    "v_held": "select concat('S', s_suppkey) as iso, s_name as country, cast(s_suppkey as bigint) as num from supplier",
    "v_slog": "select concat('S', cast(floor(doc_id / 10) as bigint) + 1) as iso, cast(doc_id % 6 + 1 as bigint) as agent, coalesce(text, '') as content from documents",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations")


class Views:
    """v.obs, v.base, ... as DataFrames; v.table(name) for the tables themselves."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        text = SQL[f"v_{name}"]
        names = [t for t in TABLES if f" {t} " in f"{text} " or f" {t})" in text]
        return self.spark.sql(_braced(text, names), **{t: self.table(t) for t in names})


def _braced(text: str, names: list[str]) -> str:
    for t in names:
        for lead in ("from ", "join "):
            text = text.replace(f"{lead}{t} ", f"{lead}{{{t}}} {t} ") if f"{lead}{t} " in f"{text} " else text
            if text.endswith(f"{lead}{t}"):
                text = text[: -len(t)] + f"{{{t}}} {t}"
    return text


def oracle(body: str) -> str:
    """body with the views it names in front, in DuckDB's words."""
    used = [v for v in SQL if v in body]
    duck = {v: SQL[v].replace("date_add(cast(o_orderdate as date), 6)", "cast(o_orderdate as date) + 6").replace("date_add(cast(o_orderdate as date), cast(l_quantity as int))", "cast(o_orderdate as date) + cast(l_quantity as int)") for v in used}
    rest = body.strip()
    views = ", ".join(f"{v} as ({duck[v]})" for v in used)
    if rest.lower().startswith("with recursive "):
        return f"with recursive {views}, {rest[15:]}"
    if rest.lower().startswith("with "):
        return f"with {views}, {rest[5:]}" if views else rest
    return f"with {views} {rest}" if views else rest
