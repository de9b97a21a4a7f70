"""The queries of the coverage operators over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import compare as C
from ..operators import joins as J
from ..operators import logs as L
from ..operators import metrics as M
from ..operators import periods as P
from ..operators import presence as R
from ..operators import quality as Q
from ..sources import io
from ..streaming import jobs
from . import workspace
from .views import Views, oracle
from .workspace import Workspace

_QUERIES: dict = {}
_SQL: dict[str, str] = {}
AS_OF, START, WEEK_SOURCES = "2001-12-31", 1995, ["AI", "WHO", "JHU"]


def _add(name: str, plan, sql: str | None = None) -> None:
    """plan: from Views to a DataFrame."""
    _QUERIES[name] = lambda spark, sf_dir: plan(Views(spark, sf_dir))
    if sql:
        _SQL[name] = oracle(sql)


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# ---- 2.1 sources and sinks: written from the tables, then read back
def _written(v: Views, df, fmt: str, partition: str | None = None, **options) -> str:
    at = jobs.scratch(v.spark) + "/t"
    w = df.write.options(**options)
    (w.partitionBy(partition) if partition else w).format(fmt).save(at)
    return at


def _obs_file(v: Views):
    o = v.obs
    return o.select("iso", F.col("idx").alias("Index"), F.col("location").alias("Location"), F.col("tl").alias("TL"), F.col("tr").alias("TR"), "deaths", F.col("scases").alias("sCh"), F.col("ccases").alias("cCh"), F.col("cfr").alias("CFR"), "reporting_date", "source_index", "source", F.col("weight").alias("confidence_weight"), F.concat(F.lit("a, "), "notes").alias("processing_notes"))


def _read_observations(v: Views):
    x = io.read_observations(v.spark, _written(v, _obs_file(v), "csv", "iso", header=True))
    return x.where("_corrupt_record is null").groupBy("iso").agg(F.count("*").alias("n"), F.sum("sCh").alias("cases"), F.min("TL").alias("first_date"), F.count("TR").alias("ends"), F.min("processing_notes").alias("note"))


def _read_sources(v: Views):
    names = [c.split()[0] for c in io.SOURCES.split(", ")]
    own = {"Index": "idx", "Source": "source", "URL": "url", "Data_Type": "nullif(data_type, '')", "Status": "status", "Reliability_Level": "reliability"}
    f = v.src.select("iso", *[F.expr(own[n]).alias(n) if n in own else F.lit("x").alias(n) for n in names])
    x = io.read_sources(v.spark, _written(v, f, "csv", "iso", header=True))
    return x.select("iso", F.col("Index").cast("long").alias("idx"), F.col("Source").alias("source"), F.col("Reliability_Level").alias("reliability"))


def _read_surveillance(v: Views):
    b = v.base
    f = b.select(F.lit("x").alias("country"), F.concat(F.lit('"'), "iso", F.lit('"')).alias("iso_code"), F.year("date_start").alias("year"), F.weekofyear("date_start").alias("week"), *[F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(c) for c in ("date_start", "date_stop", "cases", "deaths", "source")])
    x = io.read_surveillance(v.spark, _written(v, f, "csv", header=True, quote="\u0000"))
    return x.groupBy("iso_code", "source").agg(F.count("*").alias("n"), F.sum("cases").alias("cases"), F.count("deaths").alias("deaths"))


def _read_places(v: Views):
    flags = [F.upper(F.expr(e).cast("string")).alias(f"f{i}") for i, e in enumerate(("flag", "flag2", "flag", "flag2"))]
    f = v.site.select("iso", "country", "region", "subregion", *flags).toDF(*[c.split()[0] for c in io.PLACES.split(", ")])
    return io.read_places(v.spark, _written(v, f, "csv", header=True)).select("iso_code", "country_name", "subregion", "mosaic_framework", "who_afro")


def _log_files(v: Views) -> str:
    """A log of each place and agent, as text files; those of odd agents are in Latin-1."""
    line = F.concat(F.lit("lot \u00e9 "), "batch", F.lit(": "), F.col("yield"), F.lit("/20")).alias("value")
    lines = v.batch.select(F.concat(F.lit("N"), (F.col("iso") % 25)).alias("iso"), (F.col("iso") % 6 + 1).alias("agent"), line).repartition("iso", "agent")
    at = jobs.scratch(v.spark) + "/t"
    lines.where("agent % 2 = 0").write.partitionBy("iso", "agent").text(at)
    plain = {"encoding": "ISO-8859-1", "quote": "", "sep": "\u0001", "escapeQuotes": False}
    lines.where("agent % 2 = 1").write.mode("append").options(**plain).partitionBy("iso", "agent").csv(at)
    return at


_add("read_observations", _read_observations, "select iso, count(*) as n, cast(sum(scases) as bigint) as cases, min(tl) as first_date, count(tr) as ends, concat('a, ', min(notes)) as note from v_obs group by iso")
_add("read_sources", _read_sources, "select iso, idx, source, reliability from v_src")
_add("read_surveillance", _read_surveillance, "select iso as iso_code, source, count(*) as n, cast(sum(cases) as bigint) as cases, count(deaths) as deaths from v_base group by iso, source")
_add("read_places", _read_places, "select iso as iso_code, country as country_name, subregion, flag as mosaic_framework, flag2 as who_afro from v_site")
_add("read_logs", lambda v: io.read_logs(v.spark, _log_files(v)).select("iso", "agent", F.regexp_count("content", F.lit("\n")).alias("lines")).groupBy("iso", "agent").agg(F.sum("lines").alias("lines")), "select concat('N', iso % 25) as iso, cast(iso % 6 + 1 as int) as agent, count(*) as lines from v_batch group by 1, 2")
_add("read_text_safe", lambda v: io.read_text_safe(v.spark, _log_files(v)).agg(F.sum(F.length("text")).alias("chars"), F.sum(F.regexp_count("text", F.lit("\u00e9"))).alias("accents")), "select cast(sum(length(concat('lot x ', batch, ': ', yield, '/20')) + 1) as bigint) as chars, count(*) as accents from v_batch")
_add("align_versions", lambda v: io.align_versions([v.obs.select("iso", "idx"), v.obs.where("idx % 2 = 0").select("iso", "idx", "notes")]).groupBy("iso", "notes").agg(F.count("*").alias("n")), "select iso, notes, count(*) as n from (select iso, cast(null as varchar) as notes from v_obs union all select iso, notes from v_obs where idx % 2 = 0) t group by iso, notes")


def _write_table(v: Views):
    at = jobs.scratch(v.spark)
    io.write_table(v.base, f"{at}/a", "parquet", ["iso"])
    io.write_table(v.base, f"{at}/b", "csv", ["iso"])
    count = lambda df, name: df.groupBy("iso").agg(F.count("*").alias(name), F.sum("cases").alias(f"{name}_cases"))
    csv = v.spark.read.option("header", True).schema(v.base.drop("iso").schema.simpleString()[7:-1].replace(":", " ") + ", iso string").csv(f"{at}/b")
    return count(v.spark.read.parquet(f"{at}/a"), "n").join(count(csv, "n_csv"), "iso")


_add("write_table", _write_table, "select iso, count(*) as n, cast(sum(cases) as bigint) as n_cases, count(*) as n_csv, cast(sum(cases) as bigint) as n_csv_cases from v_base group by iso")
_ROW = """concat(idx, ',"', source, ', ', chr(92), '`a', chr(92), '` ', chr(92), '${b} ', chr(92), chr(92), chr(92), chr(92), 'c"')"""
#: Rows n.. of a key with their text r: what `in_parts` makes of them, with a glue of one byte and parts of 500 bytes.
_PARTS = """select {key}, cast(floor(cast(start as double) / 500) as bigint) as part, string_agg(case when n > 1 then concat('{glue}', r) else r end, '' order by n) as text
 from (select {key}, r, n, sum(strlen(r) + 1) over (partition by {key} order by n) - strlen(r) - 1 as start from ({rows}) x) y group by 1, 2"""
_add(
    "csv_payload_per_key",
    lambda v: io.csv_payload_per_key(v.src.select("iso", "idx", F.concat("source", F.lit(", `a` ${b} \\c")).alias("source")), "iso", ["idx", "source"], bound=500),
    f"""select iso, part, text as payload from ({_PARTS.format(key="iso", glue=chr(10), rows=f"select iso, {_ROW} as r, row_number() over (partition by iso order by idx, source) as n from v_src")}) p
    union all select distinct iso, -1, concat('idx,source', chr(10)) from v_src""",
)
_add("json_rows", lambda v: io.json_rows(v.src.select("idx", "source", F.nullif("data_type", F.lit("")).alias("kind"), F.expr("case when idx % 3 = 0 then '' else concat(' ', idx * 2) end").alias("rows"), F.expr("case when idx % 4 > 0 then idx % 8 / 4 end").alias("share")), ["rows"], ["share"]), """select idx as "key", concat('{"idx":"', idx, '","source":"', source, '","kind":"', coalesce(nullif(data_type, ''), ''), '","rows":', case when idx % 3 = 0 then 0 else idx * 2 end, ',"share":', case when idx % 4 > 0 then cast(idx % 8 as double) / 4 else cast(0 as double) end, '}') as json from v_src""")
_GROUPS = """select iso, 'all' as name from v_site union all select iso, 'flag' from v_site where flag union all select iso, 'flag2' from v_site where flag2 union all select iso, subregion from v_site"""
_add(
    "place_groups_json",
    lambda v: io.place_groups_json(v.site, ["flag", "flag2"], ["country", "region", "subregion", "flag", "flag2"], bound=500),
    f"""with p as ({_PARTS.format(key="name", glue=",", rows=f"select name, concat(chr(34), iso, chr(34)) as r, row_number() over (partition by name order by iso) as n from ({_GROUPS}) g")})
    select 'groups' as section, name, part, concat(case when part = 0 then '[' else '' end, text, case when part = max(part) over (partition by name) then ']' else '' end) as json from p
    union all select 'places', iso, 0, concat('{{"country":"', country, '","region":"', region, '","subregion":"', subregion, '","flag":', flag, ',"flag2":', flag2, '}}') from v_site
    union all select 'breakdown', subregion, 0, concat('{{"count":', count(*), ',"main":', count(*) filter (flag), '}}') from v_site group by subregion""",
)

# ---- 2.2 filters and predicates
_O = "iso, cust, date_start, cases, deaths, source"
for _rule, _cond in {"any": "(cases is not null or deaths is not null or source is not null)", "cases_date": "cases is not null and date_start is not null", "cases": "cases is not null"}.items():
    _add(f"observed_{_rule}", lambda v, r=_rule: S.observed(v.base, r).select(*_O.split(", ")), f"select {_O} from v_base where {_cond}")
_MAP = "case source when 'WHO' then 'WHO' when 'JHU' then 'JHU' when 'SUPP' then 'WHO' end"
_add("map_source", lambda v: S.map_source(v.base).groupBy("iso", "source").agg(F.count("*").alias("n")), f"select iso, {_MAP} as source, count(*) as n from v_base where source is not null group by 1, 2")
_add("restrict_places", lambda v: J.restrict_places(v.base, v.place, "flag").select("iso", "date_start", "cases"), "select iso, date_start, cases from v_base where iso in (select iso from v_place where flag)")
_add("completed_only", lambda v: Workspace(v).completed_observations(), workspace.COMPLETED_SQL)
_PI = "select idx, iso, location, tl, coalesce(tr, tl) as tr, scases, deaths, source from v_obs where coalesce(tr, tl) >= tl"
_add("parse_interval", lambda v: S.parse_interval(v.obs).select("idx", "iso", "location", "tl", "tr", "scases", "deaths", "source"), _PI)
_add("search_any_column", lambda v: S.search_any_column(v.src.select("idx", "source", "url", "status"), "site3"), "select idx, source, url, status from v_src where contains(upper(url), 'SITE3')")
_add("parse_location", lambda v: S.parse_location(v.obs).select("idx", "continent", "place", "province", "district", "level"), "select idx, split_part(location, '::', 1) as continent, split_part(location, '::', 2) as place, nullif(split_part(location, '::', 3), '') as province, nullif(split_part(location, '::', 4), '') as district, case len(string_split(location, '::')) when 4 then 'district' when 3 then 'province' else 'national' end as level from v_obs")
_add("confidence_band", lambda v: v.obs.groupBy(S.confidence_band(F.col("weight")).alias("band")).agg(F.count("*").alias("n")), "select case when weight >= 0.8 then 'high' when weight >= 0.5 then 'medium' else 'low' end as band, count(*) as n from v_obs group by 1")
_add("filter_by_attribute", lambda v: S.filter_by_attribute(v.site, "subregion", "ASIA").unionAll(S.filter_by_attribute(v.site, "flag2")).select("iso", "country"), "select iso, country from v_site where subregion = 'ASIA' union all select iso, country from v_site where flag2")

# ---- 2.3 joins
_add("attach_source", lambda v: J.attach_source(v.obs, v.src).select("idx", "iso", "source_index", "url"), "select o.idx, o.iso, o.source_index, s.url from v_obs o left join (select iso, idx, min(url) as url from v_src group by iso, idx) s on o.iso = s.iso and o.source_index = s.idx")
_add("orphan_sources", lambda v: J.orphan_sources(v.obs, v.src).select("idx", "iso", "source_index"), "select idx, iso, source_index from v_obs o where not exists (select 1 from v_src s where s.iso = o.iso and s.idx = o.source_index)")
_listed = "select concat('N', p_partkey % 25) as iso, p_partkey as idx from part"
_add("unused_sources", lambda v: J.unused_sources(v.table("part").select(F.concat(F.lit("N"), (F.col("p_partkey") % 25)).alias("iso"), F.col("p_partkey").alias("idx")), v.obs).select("iso", "idx"), f"select iso, idx from ({_listed}) s where not exists (select 1 from v_obs o where s.iso = o.iso and s.idx = o.source_index)")
_add("source_name_mismatch", lambda v: J.source_name_mismatch(v.obs, v.src).select("idx", "source", "listed"), "select o.idx, o.source, s.source as listed from v_obs o join v_src s on s.iso = o.iso and s.idx = o.source_index where s.source is distinct from o.source")
_WF = f"""with weeks as (select cast(d as date) as date_from, year(d) as year, week(d) as week from unnest(generate_series(cast(date_trunc('week', date '{START}-01-01') as timestamp), timestamp '{AS_OF}', interval 7 day)) t(d)), kinds as (select unnest(['AI', 'WHO', 'JHU']) as source), frame as (select iso, date_from, date_from + 6 as date_to, cast(year as int) as year, cast(week as int) as week, source from v_place, weeks, kinds)"""


def _frame(v: Views):
    return R.week_frame(v.place.select("iso"), START, AS_OF, WEEK_SOURCES)


def _base_keys(v: Views):
    return R.key_set(S.week_key(S.map_source(S.observed(v.base, "cases")), "date_start"), ["iso", "source", "year", "week"])


def _mined_keys(v: Views, step: int = 1):
    return R.mined_week_keys(S.parse_interval(v.obs.select("iso", "tl", "tr")), step).withColumn("source", F.lit("AI"))


def _weekly(v: Views):
    return R.weekly_presence(_frame(v), R.combine_sources(_base_keys(v), _mined_keys(v)))


_WEEK = "cast(year({0}) as int) as year, cast(week({0}) as int) as week"
_BK = f"select distinct iso, {_MAP} as source, {_WEEK.format('date_start')} from v_base where cases is not null and source is not null"
_DAYS = f"select iso, cast(unnest(generate_series(cast(tl as timestamp), cast(tr as timestamp), interval {{}} day)) as date) as d from ({_PI}) p"
_MK = f"select distinct iso, 'AI' as source, {_WEEK.format('d')} from ({_DAYS.format(1)}) q"
_WP = f"{_WF}, keys as ({_BK} union all {_MK}), weekly as (select f.*, case when k.iso is null then 0 else 1 end as present from frame f left join keys k on f.iso = k.iso and f.source = k.source and f.year = k.year and f.week = k.week)"
_MF = f"with months as (select year(d) as year, month(d) as month from unnest(generate_series(timestamp '{START}-01-01', timestamp '{AS_OF}', interval 1 month)) t(d)), frame as (select iso, cast(year as int) as year, cast(month as int) as month from v_site, months)"
_CI = "select concat('C', o_custkey) as iso, cast(o_orderdate as date) as tl, cast(o_orderdate as date) + cast(l_quantity as int) as tr from orders join lineitem on l_orderkey = o_orderkey + 1"
_MP = f"""{_MF}, b as (select distinct iso, cast(year(date_start) as int) as year, cast(month(date_start) as int) as month from v_cust where cases is not null), m as (select distinct iso, cast(year(d) as int) as year, cast(month(d) as int) as month from (select iso, unnest(generate_series(date_trunc('month', cast(tl as timestamp)), cast(tr as timestamp), interval 1 month)) as d from ({_CI}) p) q),
 mx as (select f.*, case when b.iso is null then 0 else 1 end as surveillance_orig, case when m.iso is null then 0 else 1 end as surveillance_ai from frame f left join b on f.iso = b.iso and f.year = b.year and f.month = b.month left join m on f.iso = m.iso and f.year = m.year and f.month = m.month)"""


def _month_keys(v: Views):
    b = v.cust.where("cases is not null").select("iso", F.year("date_start").alias("year"), F.month("date_start").alias("month")).distinct()
    return b, R.mined_month_keys(_cust_intervals(v))


def _matrix(v: Views):
    return R.monthly_presence(R.month_frame(v.site.select("iso"), START, AS_OF), *_month_keys(v))


_add("week_frame", lambda v: R.week_frame(v.seller.select("iso"), START, AS_OF, WEEK_SOURCES), f"{_WF.replace('v_place', 'v_seller')} select * from frame")
_add("month_frame", lambda v: R.month_frame(v.site.select("iso"), START, AS_OF), f"{_MF} select * from frame")
_add("weekly_presence", _weekly, f"{_WP} select * from weekly")
_add("monthly_presence", _matrix, f"{_MP} select * from mx")
_add("enrich_place", lambda v: J.enrich_place(v.src, v.place).select("idx", "iso", "country", "subregion"), "select s.idx, s.iso, p.country, p.subregion from v_src s left join v_place p on s.iso = p.iso")
_NOTES = ("concat('auto ', idx % 3)", "case idx % 4 when 0 then concat('auto ', idx % 3) when 1 then concat('old | Manual: by hand ', idx) when 2 then '' else concat('hand ', idx) end")
_add("merge_manual_notes", lambda v: J.merge_manual_notes(v.src.select(F.col("idx").alias("iso"), F.expr(_NOTES[0]).alias("notes")), v.src.select(F.col("idx").alias("iso"), F.expr(_NOTES[1]).alias("notes"))), f"select idx as iso, case idx % 4 when 1 then concat({_NOTES[0]}, ' | Manual: by hand ', idx) when 3 then concat({_NOTES[0]}, ' | Manual: hand ', idx) else {_NOTES[0]} end as notes from v_src")


def _periods_cust(v: Views):
    return P.coverage_periods(S.observed(v.cust, "any"))


_PER = """with b as (select iso, date_start as s, max(date_stop) as e from v_cust where (cases is not null or deaths is not null or source is not null) group by 1, 2),
 r as (select *, max(e) over (partition by iso order by s rows between unbounded preceding and 1 preceding) as reach from b), f as (select *, case when reach is null or s - reach > 56 then 1 else 0 end as new from r), g as (select *, sum(new) over (partition by iso order by s) as period from f),
 per as (select iso, cast(period as bigint) as period, min(s) as first_date, max(e) as last_date from g group by iso, period), nx as (select *, lead(first_date) over (partition by iso order by first_date) as nxt from per), gaps as (select iso, last_date + 1 as gap_start, nxt - 1 as gap_end, nxt - last_date - 1 as gap_days from nx where nxt - last_date - 1 > 90)"""
_add("gap_fill", lambda v: J.gap_fill(P.major_gaps(_periods_cust(v)), _cust_intervals(v)), f"""{_PER}, i as (select distinct * from ({_CI}) t),
 h as (select g.iso, g.gap_start, greatest(tl, gap_start) as s, least(tr, gap_end) as e from gaps g join i on g.iso = i.iso and i.tl <= g.gap_end and i.tr >= g.gap_start), d as (select iso, gap_start, count(distinct day) as days from (select iso, gap_start, cast(unnest(generate_series(cast(s as timestamp), cast(e as timestamp), interval 1 day)) as date) as day from h) t group by 1, 2), n as (select iso, gap_start, count(*) as intervals from h group by 1, 2)
 select g.iso, g.gap_start, g.gap_days, coalesce(n.intervals, 0) as intervals, coalesce(d.days, 0) as filled_days, round(coalesce(d.days, 0) * 100.0 / g.gap_days, 1) as filled_pct from gaps g left join n on g.iso = n.iso and g.gap_start = n.gap_start left join d on g.iso = d.iso and g.gap_start = d.gap_start""")


def _cust_intervals(v: Views):
    o, l = v.table("orders"), v.table("lineitem")
    return o.join(l, l["l_orderkey"] == o["o_orderkey"] + 1).select(F.concat(F.lit("C"), "o_custkey").alias("iso"), F.to_date("o_orderdate").alias("tl"), F.expr("date_add(to_date(o_orderdate), cast(l_quantity as int))").alias("tr"))


_add("filled_weeks", lambda v: R.filled_weeks(_weekly(v), ["WHO", "JHU"], "AI"), f"{_WP}, w as (select iso, date_from, max(case when source in ('WHO', 'JHU') then present end) as b, max(case when source = 'AI' then present end) as m from weekly group by 1, 2) select iso, count(*) as weeks, count(*) filter (b = 0) as absent, count(*) filter (b = 0 and m = 1) as filled, round(count(*) filter (b = 0 and m = 1) * 100.0 / count(*), 1) as filled_pct from w group by iso")
_add("confirm_major", lambda v: J.confirm_major(v.obs, 45), f"with p as (select * from ({_PI}) t), m as (select distinct idx, location, source, tl, tr from p where scases > 45) select m.idx, m.location, count(distinct o.source) as others from m left join p o on o.location = m.location and o.source <> m.source and o.tl <= m.tr and m.tl <= o.tr group by m.idx, m.location, m.source, m.tl, m.tr")
_NB = "array(concat('N', (num + 1) % 25), concat('N', (num + 24) % 25))"
_add("neighbour_overlap", lambda v: J.neighbour_overlap(v.obs, v.place.select("iso", F.expr(_NB.replace("(num", "cast((num").replace("% 25)", "% 25 as int))")).alias("neighbours"))), f"""with p as (select distinct idx, iso, tl, tr from ({_PI}) t), nb as (select iso, concat('N', (num + 1) % 25) as near from v_place union all select iso, concat('N', (num + 24) % 25) from v_place), same as (select iso, tl, tr, count(*) as n from p group by 1, 2, 3),
 met as (select a.iso, a.tl, a.tr, sum(b.n) as k from same a join nb on a.iso = nb.iso join same b on b.iso = nb.near and a.tl <= b.tr and b.tl <= a.tr group by 1, 2, 3) select p.idx, p.iso, cast(sum(k) as bigint) as overlaps from p join met on p.iso = met.iso and p.tl = met.tl and p.tr = met.tr group by 1, 2""")


# ---- 2.4 aggregations
def _counts(v: Views):
    rows = R.combine_sources(S.map_source(S.observed(v.base, "cases_date")).select("iso", "source"), _mined_keys(v, 7).select("iso", "source"))
    return R.week_counts(rows, v.place.select("iso"), WEEK_SOURCES)


_WC = f"with k as (select iso, {_MAP} as source from v_base where cases is not null and source is not null union all select iso, 'AI' from (select distinct iso, {_WEEK.format('d')} from ({_DAYS.format(7)}) q) z), wc as (select p.iso, count(*) filter (k.source = 'AI') as ai_weeks, count(*) filter (k.source = 'WHO') as who_weeks, count(*) filter (k.source = 'JHU') as jhu_weeks from v_place p left join k on p.iso = k.iso group by p.iso)"
_add("week_counts", _counts, f"{_WC} select * from wc")
_SUM = "select iso, count(*) as row_count, min(least(tl, coalesce(tr, tl))) as first_date, max(greatest(tl, coalesce(tr, tl))) as last_date, case when year(min(least(tl, coalesce(tr, tl)))) = year(max(greatest(tl, coalesce(tr, tl)))) then cast(year(min(tl)) as varchar) else concat(year(min(least(tl, coalesce(tr, tl)))), '-', year(max(greatest(tl, coalesce(tr, tl))))) end as date_range from v_obs group by iso"
_add("observation_summary", lambda v: M.observation_summary(v.obs), _SUM)
_add("source_counts", lambda v: M.source_counts(v.src), "select iso, count(*) as sources from v_src group by iso")
_add("case_totals", lambda v: M.case_totals(v.obs), "select iso, cast(sum(coalesce(scases, 0)) as bigint) as total_cases, cast(sum(coalesce(deaths, 0)) as bigint) as total_deaths from v_obs group by iso")
_PK = "select iso, year as peak_year from (select iso, cast(year(tl) as int) as year, row_number() over (partition by iso order by sum(scases) desc, year(tl) desc) as k from v_obs group by iso, year(tl)) t where k = 1"
_add("peak_year", lambda v: M.peak_year(v.obs), _PK)
_LV = "case when regexp_matches(trim(reliability), '^(?i:level[ _-]?)?[1-4]$') then concat('Level_', right(trim(reliability), 1)) else reliability end"
_SC = "case {} when 'Level_1' then 4 when 'Level_2' then 3 when 'Level_3' then 2 when 'Level_4' then 1 end"
_RC = "select iso, cast(sum({0}) as bigint) as score, count({0}) as scored, case when count({0}) = 0 then 'N/A' when avg({0}) >= 3.5 then 'High' when avg({0}) >= 2.5 then 'Medium' else 'Low' end as reliability_class from v_src group by iso"
_add("reliability_class", lambda v: M.reliability_class(v.src), _RC.format(_SC.format("reliability")))
_add("reliability_class_normalized", lambda v: M.reliability_class(v.src, True), _RC.format(_SC.format(f"({_LV})")))
_ST = "select iso, count(distinct nullif(data_type, '')) as source_types from v_src group by iso"
_add("source_type_count", lambda v: M.source_type_count(v.src), _ST)
_add("coverage_approx", lambda v: M.coverage_approx(_counts(v)), f"{_WC} select *, cast(floor((ai_weeks + who_weeks + jhu_weeks) * 100.0 / 2860 + 0.5) as bigint) as coverage_pct from wc")
_SP = f"select iso, cast(split_part(date_range, '-', 2) as int) - cast(split_part(date_range, '-', 1) as int) + 1 as span_years, cast(split_part(date_range, '-', 1) as int) as first_year, cast(split_part(date_range, '-', 2) as int) as last_year from ({_SUM}) s"
_add("span_metrics", lambda v: M.span_metrics(M.observation_summary(v.obs)), _SP)
_add("country_metrics", lambda v: M.country_metrics(v.obs, v.src, v.place, _counts(v)), f"{_WC} select p.iso, s.date_range, coalesce(cast(floor((w.ai_weeks + w.who_weeks + w.jhu_weeks) * 100.0 / 2860 + 0.5) as bigint), 0) as coverage_pct, coalesce(s.row_count, 0) as row_count, coalesce(c.sources, 0) as sources, coalesce(t.total_cases, 0) as total_cases, coalesce(t.total_deaths, 0) as total_deaths, pk.peak_year, r.reliability_class, coalesce(st.source_types, 0) as source_types, sp.span_years, sp.first_year, sp.last_year from v_place p left join wc w on p.iso = w.iso left join ({_SUM}) s on p.iso = s.iso left join (select iso, count(*) as sources from v_src group by iso) c on p.iso = c.iso left join (select iso, cast(sum(scases) as bigint) as total_cases, cast(sum(deaths) as bigint) as total_deaths from v_obs group by iso) t on p.iso = t.iso left join ({_PK}) pk on p.iso = pk.iso left join ({_RC.format(_SC.format('reliability'))}) r on p.iso = r.iso left join ({_ST}) st on p.iso = st.iso left join ({_SP}) sp on p.iso = sp.iso")
_add("status_from_files", lambda v: Workspace(v).status(), workspace.STATUS_SQL)
_add("status_progress", lambda v: M.status_progress(Workspace(v).status()), workspace.PROGRESS_SQL)
_add("latest_update", lambda v: Workspace(v).latest(), workspace.LATEST_SQL)
_add("week_count_totals", lambda v: M.week_count_totals(_counts(v)), f"{_WC} select cast(sum(ai_weeks) as bigint) as ai_weeks, cast(sum(who_weeks) as bigint) as who_weeks, cast(sum(jhu_weeks) as bigint) as jhu_weeks, count(*) filter (ai_weeks > 0) as ai_places, count(*) filter (who_weeks > 0) as who_places, count(*) filter (jhu_weeks > 0) as jhu_places from wc")
_add("monthly_coverage_summary", lambda v: R.monthly_coverage_summary(_matrix(v)), f"{_MP} select count(*) as months, count(*) filter (surveillance_orig = 1) as base, count(*) filter (surveillance_ai = 1) as mined, count(*) filter (surveillance_orig = 1 or surveillance_ai = 1) as any_source, count(*) filter (surveillance_orig = 0 and surveillance_ai = 1) as mined_only, count(distinct iso) as places, round(count(*) filter (surveillance_orig = 1) * 100.0 / count(*), 1) as base_pct, round(count(*) filter (surveillance_ai = 1) * 100.0 / count(*), 1) as mined_pct, round(count(*) filter (surveillance_orig = 1 or surveillance_ai = 1) * 100.0 / count(*), 1) as any_source_pct, round(count(*) filter (surveillance_orig = 0 and surveillance_ai = 1) * 100.0 / count(*), 1) as mined_only_pct from mx")
_add("source_coverage", lambda v: R.source_coverage(_weekly(v)), f"{_WP} select source, cast(sum(present) as bigint) as present, count(*) as total, round(sum(present) * 100.0 / count(*), 1) as pct from weekly group by source")
_add("place_source_rollup", lambda v: R.place_source_rollup(_weekly(v)), f"{_WP} select source, iso, cast(sum(present) as bigint) as weeks, cast(grouping_id(source, iso) as bigint) as grp from weekly group by rollup (source, iso)")
_add("coverage_periods", _periods_cust, f"{_PER} select * from per")
_add("major_gaps", lambda v: P.major_gaps(_periods_cust(v)), f"{_PER} select *, round(gap_days / 365.25, 1) as gap_years from gaps")
_SY = f"""{_PER}, ct as (select iso, string_agg(concat(first_date, ' to ', last_date), '; ' order by first_date) as covered_intervals, min(first_date) as first_data, max(last_date) as last_data, cast(sum(last_date - first_date + 1) as bigint) as covered_days, max(last_date) - min(first_date) + 1 as span_days, count(*) as data_periods, list(first_date) as fs, list(last_date) as ls from per group by iso), gt as (select iso, count(*) as major_gaps, string_agg(concat(gap_start, ' to ', gap_end), '; ' order by gap_start) as t from gaps group by iso),
 sy as (select ct.*, coalesce(gt.major_gaps, 0) as major_gaps, round(covered_days * 100.0 / span_days, 1) as coverage_percentage, round((span_days - 1) / 365.25, 1) as total_span_years, coalesce(gt.t, 'None') as major_gap_periods, coalesce(gt.t, concat('Pre-', year(first_data), ' and Post-', year(last_data), ' data')) as priority_search_periods from ct left join gt on ct.iso = gt.iso)"""
_add("coverage_summary", lambda v: P.coverage_summary(_periods_cust(v)), f"{_SY} select * exclude (fs, ls) from sy")


def _lookup(v: Views, order: str = "text"):
    p = _periods_cust(v)
    return P.quick_lookup(p, P.coverage_summary(p), order=order)


_QL = f"""{_SY}, yr as (select distinct iso, unnest(generate_series(year(first_date), year(last_date))) as y from per), ms as (select s.iso, string_agg(cast(y as varchar), ', ' order by y) as m from (select s.iso, t.y, row_number() over (partition by s.iso order by t.y) as k from sy s cross join (select unnest(generate_series(2000, 2025)) as y) t where not exists (select 1 from yr where yr.iso = s.iso and yr.y = t.y)) s where k <= 10 group by s.iso),
 ql as (select sy.iso, coverage_percentage as coverage_pct, concat(year(first_data), '-', year(last_data)) as data_span, case when coverage_percentage < 70 then 'HIGH' when coverage_percentage < 90 then 'MEDIUM' else 'LOW' end as search_priority, coalesce(ms.m, 'None') as missing_recent_years, priority_search_periods as priority_periods from sy left join ms on sy.iso = ms.iso)"""
_add("quick_lookup", _lookup, f"{_QL} select *, search_priority as sort_key from ql")
_add("quick_lookup_top", lambda v: _lookup(v).orderBy("sort_key", "coverage_pct", "iso").limit(5).select("iso", "search_priority", "coverage_pct"), f"{_QL} select iso, search_priority, coverage_pct from ql order by search_priority, coverage_pct, iso limit 5")
_add(
    "subregion_breakdown",
    lambda v: M.subregion_breakdown(v.site, most=50),
    """select subregion, cast(floor((n - 1) / 50) as bigint) as part, string_agg(iso, ',' order by iso) as members, max(places) as places, max(framework) as framework
    from (select subregion, iso, row_number() over (partition by subregion order by iso) as n, count(*) over (partition by subregion) as places, count(*) filter (flag) over (partition by subregion) as framework from v_site) t
    group by 1, 2""",
)
_add("source_quality_counts", lambda v: M.source_quality_counts(v.src), "select iso, count(*) as total, count(*) filter (reliability = 'Level_1') as level_1, count(*) filter (status = 'Active') as active from v_src group by iso")
_add("level_distribution", lambda v: M.level_distribution(v.src), f"select {_LV} as level, count(*) as n, cast(sum(count(*)) over () as bigint) as total, round(count(*) * 100.0 / sum(count(*)) over (), 1) as pct from v_src group by 1")
_add("weight_stats", lambda v: M.weight_stats(v.obs), "select iso, round(avg(weight), 6) as mean_weight, round(avg(cfr), 6) as mean_cfr, min(cfr) as min_cfr, max(cfr) as max_cfr from v_obs group by iso")
_LEVEL = "case len(string_split(location, '::')) when 4 then 'district' when 3 then 'province' else 'national' end"
_add("admin_level_counts", lambda v: M.admin_level_counts(v.obs), f"select iso, level, count(*) as n, cast(grouping_id(iso, level) as bigint) as grp from (select iso, {_LEVEL} as level from v_obs) t group by cube (iso, level)")
_add("hierarchy_check", lambda v: M.hierarchy_check(v.obs), f"select iso, cast(year(tl) as int) as year, cast(sum(scases) filter ({_LEVEL} = 'national') as bigint) as national, cast(sum(scases) filter ({_LEVEL} <> 'national') as bigint) as subnational, coalesce(sum(scases) filter ({_LEVEL} = 'national') > 0 and sum(scases) filter ({_LEVEL} <> 'national') > 0, false) as double_count from v_obs group by 1, 2")

# ---- 2.5 windows, 2.6 sorts and top-k
_add("data_blocks", lambda v: P.data_blocks(v.cust, ["iso"], "date_start"), "with d as (select distinct iso, date_start from v_cust), f as (select *, case when date_start - lag(date_start) over (partition by iso order by date_start) <= 14 then 0 else 1 end as new from d), g as (select *, sum(new) over (partition by iso order by date_start) as block from f) select iso, cast(block as bigint) as block, min(date_start) as block_start, max(date_start) as block_end, count(*) as points from g group by iso, block")
_add("dedup_first", lambda v: R.dedup_first(v.base.select("iso", "source", "date_start", "cases"), ["iso", "source", "date_start"], ["cases"]), "select iso, source, date_start, min(cases) filter (cases is not null) as cases from v_base group by 1, 2, 3 having count(*) = count(cases) union all select iso, source, date_start, null from v_base group by 1, 2, 3 having count(*) > count(cases)")
_Z = "select idx, iso, tl, tr, case when iso in ('N1', 'N2') and scases % 2 = 0 then 0 else scases end as scases, case when iso in ('N1', 'N2') then 0 else deaths + 1 end as deaths from v_obs"
_add("zero_transmission_spans", lambda v: P.zero_transmission_spans(v.obs.withColumns({"scases": F.expr("case when iso in ('N1', 'N2') and scases % 2 = 0 then 0 else scases end"), "deaths": F.expr("case when iso in ('N1', 'N2') then 0 else deaths + 1 end")})), f"with z as ({_Z}), y as (select distinct iso, unnest(generate_series(year(tl), year(coalesce(tr, tl)))) as y from z where scases = 0 and deaths = 0 and coalesce(tr, tl) >= tl), g as (select *, y - row_number() over (partition by iso order by y) as g from y) select iso, cast(min(y) as int) as first_year, cast(max(y) as int) as last_year, count(*) as years from g group by iso, g")
_STOP = "with w as (select *, sum(case when yield < 10 then 1 else 0 end) over (partition by iso order by batch rows between 1 preceding and current row) as low, row_number() over (partition by iso order by batch) as k from v_batch) select iso, min(batch) as stop_batch from w where low >= 2 and k >= 2 group by iso"
_add("stop_batches", lambda v: L.stop_batches(v.batch, 10, 2, 2), _STOP)
_add("cumulative_yield", lambda v: L.cumulative_yield(v.batch), "select iso, batch, yield, cast(sum(yield) over (partition by iso order by batch) as bigint) as total from v_batch")
_add("index_sequence_gaps", lambda v: Q.index_sequence_gaps(v.src), "select iso, idx, expected from (select iso, idx, cast(row_number() over (partition by iso order by idx) as int) as expected from v_src) t where idx <> expected")
_add("rank_places", lambda v: R.rank_places(v.base.groupBy("iso").agg(F.count("*").alias("n")), "n", 10), "select iso, n, cast(row_number() over (order by n desc, iso) as int) as rank from (select iso, count(*) as n from v_base group by iso order by 2 desc, 1 limit 10) t")
_add("gaps_by_days", lambda v: P.major_gaps(_periods_cust(v)).orderBy(F.desc("gap_days"), "iso", "gap_start"), f"{_PER} select *, round(gap_days / 365.25, 1) as gap_years from gaps order by gap_days desc, iso, gap_start")
_add("summary_by_coverage", lambda v: P.coverage_summary(_periods_cust(v)).orderBy("coverage_percentage", "iso").select("iso", "coverage_percentage"), f"{_SY} select iso, coverage_percentage from sy")
_add("rows_by_week", lambda v: S.week_key(v.base, "date_start").groupBy("iso").agg(F.sort_array(F.collect_set(F.struct("year", "week"))).alias("w")).select("iso", F.array_join(F.transform("w", lambda x: F.concat_ws("-", x["year"], x["week"])), ",").alias("weeks")), f"select iso, string_agg(concat(year, '-', week), ',' order by year, week) as weeks from (select distinct iso, {_WEEK.format('date_start')} from v_base) t group by iso")
_add("completed_first", lambda v: Workspace(v).completed_first(), workspace.FIRST_SQL)

# ---- 2.7 sets, 2.8 expansion and scalars
_add("combine_sources", lambda v: R.combine_sources(_base_keys(v), _mined_keys(v)).groupBy("source").agg(F.count("*").alias("n")), f"select source, count(*) as n from ({_BK} union all {_MK}) t group by source")
_add("distinct_keys", _base_keys, _BK)
_add("missing_years", lambda v: _lookup(v).select("iso", "missing_recent_years"), f"{_QL} select iso, missing_recent_years from ql")
#: Every row is in A or in B: some years of a place go whole into one of them, the others are dealt.
_IN_A = "case (year(tl) + source_index) % 4 when 0 then true when 1 then false else idx % 2 = 1 end"
_DEALT = f"select * replace (concat(iso, '-', source_index) as iso), {_IN_A} as in_a from v_obs"
_A, _B = f"select * from ({_DEALT}) a where in_a", f"select * from ({_DEALT}) b where not in_a"
_ys = lambda q: f"select distinct iso, cast(unnest(generate_series(year(tl), year(coalesce(tr, tl)))) as int) as year from ({q}) t where coalesce(tr, tl) >= tl"


def _ab(v: Views):
    """All observations dealt over two datasets by place and year, so that years of a place are in A, in B or in both."""
    dealt = v.obs.withColumn("in_a", F.expr(_IN_A)).withColumn("iso", F.concat("iso", F.lit("-"), F.col("source_index")))
    return dealt.where("in_a").drop("in_a"), dealt.where("not in_a").drop("in_a")


_add("years_only_in_first", lambda v: C._years(_ab(v)[0]).subtract(C._years(_ab(v)[1])), f"{_ys(_A)} except {_ys(_B)}")
_add("years_in_both", lambda v: C._years(_ab(v)[0]).intersect(C._years(_ab(v)[1])), f"{_ys(_A)} intersect {_ys(_B)}")
_add("months_any", lambda v: _month_keys(v)[0].union(_month_keys(v)[1]).distinct(), f"{_MP} select * from b union select * from m")
_add("months_mined_only", lambda v: _month_keys(v)[1].subtract(_month_keys(v)[0]), f"{_MP} select * from m except select * from b")
_add("expand_weeks_7", lambda v: _mined_keys(v, 7).drop("source"), f"select distinct iso, {_WEEK.format('d')} from ({_DAYS.format(7)}) q")
_add("expand_weeks_1", lambda v: _mined_keys(v, 1).drop("source"), f"select distinct iso, {_WEEK.format('d')} from ({_DAYS.format(1)}) q")
_add("expand_months", lambda v: _month_keys(v)[1], f"{_MP} select * from m")
_add("parse_interval_text", lambda v: S.parse_interval_text(P.coverage_summary(_periods_cust(v)).select("iso", "major_gap_periods"), "major_gap_periods").select("iso", "tl", "tr"), f"{_PER} select iso, gap_start as tl, gap_end as tr from gaps")
_add("month_keys_from_summary", lambda v: S.expand_months(S.parse_interval_text(P.coverage_summary(_periods_cust(v)), "covered_intervals")).select("iso", "year", "month").distinct(), f"{_PER} select distinct iso, cast(year(d) as int) as year, cast(month(d) as int) as month from (select iso, unnest(generate_series(date_trunc('month', cast(first_date as timestamp)), cast(last_date as timestamp), interval 1 month)) as d from per) t")
_add("covered_years", lambda v: _periods_cust(v).groupBy("iso").agg(F.collect_list(F.struct("first_date", "last_date")).alias("periods")).select("iso", F.array_join(S.covered_years(), ",").alias("years")), f"{_PER} select iso, string_agg(y, ',' order by y) as years from (select distinct iso, unnest(generate_series(year(first_date), year(last_date))) as y from per) t group by iso")
_add("data_span", lambda v: _lookup(v).select("iso", "data_span", "priority_periods"), f"{_QL} select iso, data_span, priority_periods from ql")
_add("coverage_priority", lambda v: _lookup(v, "rank").groupBy("search_priority", "sort_key").agg(F.count("*").alias("n")), f"{_QL} select search_priority, case search_priority when 'HIGH' then '1' when 'MEDIUM' then '2' else '3' end as sort_key, count(*) as n from ql group by 1, 2")
_add("row_count_priority", lambda v: v.cust.groupBy("iso").agg(F.count("*").alias("n")).select("iso", S.row_count_priority(F.col("n")).alias("priority")), "select iso, case when count(*) < 15 then 'HIGH' when count(*) < 30 then 'MEDIUM' else 'LOW' end as priority from v_cust group by iso")
_add("compose_auto_notes", lambda v: v.src.select("idx", S.compose_auto_notes(F.expr("idx % 5 = 0"), F.expr("idx % 8"), F.expr("case when idx % 3 = 0 then cast(idx % 8 as int) end"), F.expr("idx % 4"), F.expr("idx % 2 = 0")).alias("notes")), "select idx, case when t = '' then 'No activity detected' else t end as notes from (select idx, concat_ws('; ', case when idx % 5 = 0 then 'Quality audit completed' when idx % 8 >= 6 then 'All agents executed' when idx % 3 = 0 then concat('Agent ', idx % 8, ' completed') when idx % 8 > 0 then 'Agent 1 initialized - starting work' end, case when idx % 4 > 0 then concat(idx % 4, ' data observations') end, case when idx % 2 <> 0 then 'Setup incomplete' end) as t from v_src) s")
_add("truncate_text", lambda v: v.table("conversations").select("conv_id", "turn", S.truncate_text(F.col("text"), 40).alias("short")), "select conv_id, turn, case when length(text) > 40 then concat(substring(text, 1, 40), '...') else text end as short from conversations")
_add("global_date_range", lambda v: S.global_date_range(v.base, "date_stop"), "select date '1970-01-01' as first_date, coalesce(max(date_stop), date '2025-12-31') as last_date from v_base")
_add("normalize_level", lambda v: v.src.select("idx", S.normalize_level(F.col("reliability")).alias("level"), S.normalize_status(F.upper("status")).alias("status")), f"select idx, {_LV} as level, status from v_src")

# ---- 2.9 quality
_DATA = ["Index", "Location", "TL", "TR", "deaths", "sCh", "cCh", "CFR", "reporting_date", "source_index", "source", "confidence_weight", "processing_notes"]


def _header_files(v: Views) -> str:
    """Two files a place, a header line first; some headers lack a column or have another, some places lack a file."""
    num = F.expr("cast(substring(iso, 2) as int)")
    data = v.obs.select("iso", F.lit("data").alias("kind"), "idx", F.concat_ws(",", "idx", "location", "tl").alias("value"))
    meta = v.src.where(num % 7 != 2).select("iso", F.lit("meta").alias("kind"), "idx", F.concat_ws(",", "idx", "source").alias("value"))
    lines = data.unionByName(meta)
    good = F.when(F.col("kind") == "data", ",".join(_DATA)).otherwise(",".join(["Index", *[f"c{i}" for i in range(13)]]))
    head = F.when(num % 3 == 0, F.replace(good, F.lit("source_index"), F.lit("src"))).when(num % 5 == 1, F.concat(good, F.lit(",more"))).otherwise(good)
    heads = lines.select("iso", "kind").distinct().select("iso", "kind", F.lit(-1).cast("long").alias("idx"), head.alias("value"))
    at = jobs.scratch(v.spark) + "/t"
    dealt = lines.unionByName(heads).repartition("kind", "iso").sortWithinPartitions("kind", "iso", "idx")
    dealt.select("kind", "iso", "value").write.partitionBy("kind", "iso").text(at)
    return at


_HC = """with k as (select iso, cast(substring(iso, 2) as int) as num, true as d, false as m from v_obs union all select iso, cast(substring(iso, 2) as int), false, true from v_src),
 f as (select iso, num, bool_or(d) as d, bool_or(m and num % 7 <> 2) as m from k group by 1, 2 having bool_or(d or num % 7 <> 2)),
 hc as (select iso, cast(d as bigint) + cast(m as bigint) as files, array_to_string([x for x in [case when d and num % 3 <> 0 and num % 5 = 1 then 'data: 14 columns, 13 needed' end, case when d and num % 3 = 0 then 'data: no source_index column' end, case when m and num % 3 <> 0 and num % 5 = 1 then 'meta: 15 columns, 14 needed' end, case when not d then 'data: no file' end, case when not m then 'meta: no file' end] if x is not null], ' | ') as issues from f)"""
_add("header_compliance", lambda v: Q.header_compliance(io.read_headers(v.spark, _header_files(v))), f"{_HC} select iso, files, issues = '' as compliant, issues from hc")
_add("compliance_rate", lambda v: Q.compliance_rate(Q.header_compliance(io.read_headers(v.spark, _header_files(v)))), f"{_HC} select count(*) as places, count(*) filter (issues = '') as compliant, round(count(*) filter (issues = '') * 100.0 / count(*), 1) as pct from hc")


def _malformed(v: Views):
    """Lines with a comma in quotes, and among them some with an empty field too many and some that lack a field."""
    s = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    blank = F.lit("")
    note = F.concat(F.lit('"Source states: '), F.col("scases").cast("string"), F.lit(' cases, ""so"" read"'))
    tail = ["source_index", "source", "weight"]
    whole = [s(c) for c in ("idx", "location", "tl", "tr", "deaths", "scases", "ccases", "cfr", "reporting_date", *tail)]
    line = F.concat_ws(",", *whole, note)
    line = F.when(F.expr("idx % 11 = 3"), F.concat_ws(",", *whole[:8], blank, *whole[8:], note)).when(F.expr("idx % 13 = 5"), F.concat_ws(",", *whole[:7], *whole[8:], note)).otherwise(line)
    lines = v.spark.read.text(_written(v, v.obs.select(line.alias("value")), "text"))
    good, bad = Q.split_malformed(lines, _DATA)
    sums = good.agg(F.count("*").alias("good"), F.sum(F.col("sCh").cast("long")).alias("cases"), F.sum(F.length("processing_notes")).alias("chars"))
    return sums.crossJoin(bad.agg(F.count("*").alias("bad")))  # a row each


_add("split_malformed", _malformed, "with m as (select *, idx % 11 = 3 or idx % 13 = 5 as bad from v_obs) select count(*) filter (not bad) as good, cast(sum(scases) filter (not bad) as bigint) as cases, cast(sum(length(concat('Source states: ', scases, ' cases, \"so\" read'))) filter (not bad) as bigint) as chars, count(*) filter (bad) as bad from m")
_DL = "coalesce(tl > tr, false) as ends_late, coalesce(reporting_date < coalesce(tr, tl), false) as reported_early"
_CL = "coalesce(deaths > scases, false) as too_deadly, coalesce(deaths < 0 or scases < 0, false) as negative"
_CF = "coalesce(abs(deaths * 100.0 / nullif(cast(scases as double), 0) - cfr) > 0.1, false) as cfr_differs, coalesce(not (deaths * 100.0 / nullif(cast(scases as double), 0) between 0.1 and 15), false) as cfr_odd"
_LF = "(regexp_matches(location, '^AFR::[A-Z0-9]+(::[^:]+){0,2}$') and split_part(location, '::', 2) = iso) as good_location"
_add("date_logic", lambda v: Q.date_logic(v.obs).select("idx", "ends_late", "reported_early"), f"select idx, {_DL} from v_obs")
_add("count_logic", lambda v: Q.count_logic(v.obs).select("idx", "too_deadly", "negative"), f"select idx, {_CL} from v_obs")
_add("cfr_check", lambda v: Q.cfr_check(v.obs).select("idx", "cfr_differs", "cfr_odd"), f"select idx, {_CF} from v_obs")
_add("weight_band", lambda v: Q.weight_band(v.obs, v.src).select("idx", "in_band"), f"select o.idx, case l.level when 'Level_1' then weight between 0.9 and 1.0 when 'Level_2' then weight between 0.7 and 0.9 when 'Level_3' then weight between 0.3 and 0.6 when 'Level_4' then weight between 0.1 and 0.3 end as in_band from v_obs o left join (select iso, idx, min({_LV}) as level from v_src group by iso, idx) l on o.iso = l.iso and o.source_index = l.idx")
_add("location_format", lambda v: Q.location_format(v.obs).select("idx", "good_location"), f"select idx, {_LF} from v_obs")
_add("duplicates", lambda v: Q.duplicates(v.obs), "with w as (select location, tl, tr, count(*) as rows, count(distinct source) as sources, count(distinct scases) as counts from v_obs group by 1, 2, 3 having count(*) > 1), e as (select location, tl, tr, source, count(*) as n from v_obs group by 1, 2, 3, 4) select e.*, w.rows, w.sources, w.counts, e.n > 1 as exact, w.counts > 1 as conflict from e join w on e.location is not distinct from w.location and e.tl is not distinct from w.tl and e.tr is not distinct from w.tr")
_add("has_quantity", lambda v: Q.has_quantity(v.obs).select("idx", "has_quantity"), "select idx, coalesce(scases, deaths, ccases) is not null as has_quantity from v_obs")
_add("validation_funnel", lambda v: Q.validation_funnel(v.obs), f"select count(*) as n, count(*) filter (not ends_late and not reported_early) as dates, count(*) filter (not too_deadly and not negative) as quantities, count(*) filter (not cfr_odd) as cfr, count(*) filter (good_location) as form, count(*) filter (not ends_late and not reported_early and not too_deadly and not negative and not cfr_odd and good_location) as passed, round(count(*) filter (not ends_late and not reported_early and not too_deadly and not negative and not cfr_odd and good_location) * 100.0 / count(*), 1) as pass_pct from (select {_DL}, {_CL}, {_CF}, {_LF} from v_obs) t")
_TIERS = [("site1.org", 1), ("www.site1.org", 4), ("WWW.site2.org", 2), ("site3.org", 3), ("c.site3.org", 5), ("te4.org", 6)]
_HOSTS = "select idx, concat(case idx % 4 when 0 then '' when 1 then 'www.' when 2 then 'apps.' else 'b.c.' end, 'site', idx % 5, '.org') as host from v_src"


def _tiers(v: Views):
    """The sources of places under hosts of one to four labels, and a short list of domains."""
    lead = F.element_at(F.array(F.lit("https://"), F.lit("https://WWW."), F.lit("http://apps."), F.lit("https://b.c.")), (F.col("idx") % 4 + 1).cast("int"))
    src = v.src.withColumn("url", F.concat(lead, F.lit("Site"), F.col("idx") % 5, F.lit(".org/x?y=www.site1.org")))
    return Q.domain_tier(src, v.spark.createDataFrame(_TIERS, "host string, tier int")).select("idx", "host", "tier")


_add("domain_tier", _tiers, f"""with h as ({_HOSTS}), t(domain, tier) as (values {", ".join(f"('{d.lower()}', {t})" for d, t in _TIERS)}),
 m as (select idx, tier, row_number() over (partition by idx order by length(domain) desc) as n from h join t on host = domain or ends_with(host, concat('.', domain)))
 select h.idx, h.host, coalesce(m.tier, 0) as tier from h left join (select * from m where n = 1) m on m.idx = h.idx""")

# ---- 2.10 logs
_add("agent_status", lambda v: L.agent_status(v.log, ("the",), 4).groupBy("iso", "agent", "status").agg(F.count("*").alias("n")), "select iso, agent, case when contains(content, 'the') and len(string_split(trim(content), chr(10))) <= 4 then 'initialized' else 'completed' end as status, count(*) as n from v_log group by 1, 2, 3")
_EM = r"select iso, cast(sum(len(regexp_extract_all(content, '(?i)(tion|ment)'))) as bigint) as queries, cast(sum(len(regexp_extract_all(content, '(?i)(new|the )'))) as bigint) as additions from v_log group by iso"
_EMX = f"select *, case when queries = 0 then cast(0 as double) else cast(additions as double) * 100 / queries end as yield_pct, cast(floor(queries * 3 / 10) as bigint) as minutes from ({_EM}) t"
_add("execution_metrics", lambda v: L.execution_metrics(v.log, r"(?i)(tion|ment)", "(?i)(new|the )"), _EMX)
def _yield_logs(v: Views):
    """A log a place, in one of the three spellings by its number, with a heading that holds a fraction too."""
    b, y = F.col("batch").cast("string"), F.col("yield").cast("string")
    lit = F.lit
    spelt = (
        F.when(F.col("iso") % 3 == 0, F.concat(lit("=== BATCH "), b, lit(": PRIORITY (1/20 - 20/20) ===\nBATCH "), b, lit(" YIELD CALCULATION:\n- Queries resulting in NEW rows: "), y, lit("/20\n- Data observation yield: 40%")))
        .when(F.col("iso") % 3 == 1, F.concat(lit("=== BATCH "), b, lit(" START ===\nBATCH "), b, lit(" YIELD: 0 new data observations found, "), y, lit("/20 queries successful = 0% yield")))
        .otherwise(F.concat(lit("# BATCH "), b, lit(" (Queries 1-20): COMPLETED\n# Data Observation Yield: 0% ("), y, lit(" successful queries / 20 total queries)")))
    )
    parts = v.batch.select("iso", F.struct("batch", spelt.alias("t")).alias("p")).groupBy("iso").agg(F.sort_array(F.collect_list("p")).alias("p"))
    return parts.select("iso", lit(1).alias("agent"), F.array_join(F.transform("p", lambda s: s["t"]), "\n").alias("content"))


_add("batch_yields", lambda v: L.batch_yields(_yield_logs(v)).select("iso", "batch", "ok", "asked", "yield_pct"), "select iso, cast(batch as int) as batch, cast(yield as int) as ok, 20 as asked, round(yield * 100.0 / 20, 1) as yield_pct from v_batch")
_add("checklist", lambda v: Workspace(v).checklist(), workspace.CHECKLIST_SQL)

# ---- 2.11 two datasets
_YC = f"with ya as ({_ys(_A)}), yb as ({_ys(_B)}), fr as (select iso, cast(y as int) as year from (select iso from ya union select iso from yb) p, unnest(generate_series(1995, 2005)) t(y)), yc as (select fr.iso, fr.year, case when ya.iso is not null and yb.iso is not null then 'Both' when ya.iso is not null then 'A' when yb.iso is not null then 'B' else 'Neither' end as code from fr left join ya on fr.iso = ya.iso and fr.year = ya.year left join yb on fr.iso = yb.iso and fr.year = yb.year)"
_add("year_coverage", lambda v: C.year_coverage(*_ab(v), 1995, 2005), f"{_YC} select * from yc")
_add("decade_timeline", lambda v: C.decade_timeline(C.year_coverage(*_ab(v), 1995, 2005)), f"{_YC} select iso, cast(floor(year / 10) * 10 as int) as decade, string_agg(case code when 'Both' then 'X' when 'Neither' then '-' else code end, '' order by year) as timeline from yc group by 1, 2")


def _per_year(df):
    return df.groupBy("iso", F.year("tl").alias("year")).agg(F.sum("scases").alias("n"))


_add("discrepancy", lambda v: C.discrepancy(*[_per_year(d) for d in _ab(v)]), f"with a as (select iso, cast(year(tl) as int) as year, cast(sum(scases) as bigint) as a from ({_A}) x group by 1, 2), b as (select iso, cast(year(tl) as int) as year, cast(sum(scases) as bigint) as b from ({_B}) x group by 1, 2) select coalesce(a.iso, b.iso) as iso, coalesce(a.year, b.year) as year, a.a, b.b, case when a.a is null or b.b is null then 'single' when round(abs(a - b) * 100.0 / least(a, b), 1) < 1 then 'perfect' when round(abs(a - b) * 100.0 / least(a, b), 1) <= 5 then 'excellent' when round(abs(a - b) * 100.0 / least(a, b), 1) <= 15 then 'acceptable' when round(abs(a - b) * 100.0 / least(a, b), 1) < 100 then 'moderate' else 'major' end as class from a full join b on a.iso = b.iso and a.year = b.year")
_add("dataset_overview", lambda v: C.dataset_overview(*_ab(v)), f"with x as (select 'A' as dataset, tl, coalesce(tr, tl) as tr from ({_A}) a union all select 'B', tl, coalesce(tr, tl) from ({_B}) b) select coalesce(dataset, 'all') as dataset, min(tl) as first_date, max(tr) as last_date, count(distinct year(tl)) as years, count(*) as n from x where tr >= tl group by grouping sets ((dataset), ())")


# ---- 2.12 streaming
def _stream(v: Views, df, ts: str | None = None, close: bool = True):
    """A table as arriving files: four slices written one after the other, each a micro-batch. With ts, slices follow
    time, and unless close is false a last row with nothing but a far later time closes the windows of the last slice."""
    df = df.select(*[F.col(c).cast("timestamp").alias(c) if k == "timestamp_ntz" else F.col(c) for c, k in df.dtypes])
    at = jobs.scratch(v.spark) + "/t"
    nth = F.pmod(F.xxhash64(*df.columns), F.lit(4))
    if ts:
        low, high = df.agg(F.min(F.col(ts).cast("double")), F.max(F.col(ts).cast("double"))).first()
        share = (F.col(ts).cast("double") - F.lit(low or 0.0)) / F.lit(max(1.0, (high or 0.0) - (low or 0.0)))
        nth = F.coalesce(F.least(F.floor(share * 4), F.lit(3)), F.lit(0))
    for k in range(4):
        df.where(nth == k).repartition(2).write.mode("append").parquet(at)
    if ts and close:
        last = df.agg((F.max(ts) + F.expr("interval 400 days")).alias(ts))
        last.select(*[F.col(c) if c == ts else F.lit(None).cast(k).alias(c) for c, k in df.dtypes]).write.mode("append").parquet(at)
    return v.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(at)


_add("stream_week_counts", lambda v: jobs.stream_week_counts(_stream(v, v.table("events"), "ts", close=False), "user_id", "event_type", "ts"), "select user_id as iso, event_type as source, count(distinct concat(year(ts), '-', week(ts))) as weeks from events where ts is not null group by 1, 2")
_add("stream_data_blocks", lambda v: jobs.stream_data_blocks(_stream(v, v.table("orders"), "o_orderdate"), "o_custkey", "o_orderdate"), "with d as (select distinct o_custkey as iso, cast(o_orderdate as date) as d from orders), f as (select *, case when d - lag(d) over (partition by iso order by d) <= 14 then 0 else 1 end as new from d), g as (select *, sum(new) over (partition by iso order by d) as block from f) select iso, min(d) as block_start, max(d) as block_end from g group by iso, block")
_add("stream_weekly_totals", lambda v: jobs.stream_weekly_totals(_stream(v, v.table("events").withColumn("value", F.col("value").cast("decimal(18,2)")), "ts"), "ts", "value").withColumn("total", F.col("total").cast("double")), "select cast(date_trunc('week', ts) as date) as week_start, count(*) as n, cast(sum(cast(value as decimal(18,2))) as double) as total from events where ts is not null group by 1")
_add("stream_stop_rule", lambda v: jobs.stream_stop_rule(_stream(v, v.batch), 10, 2, 2), _STOP)
_add("stream_refresh", lambda v: jobs.stream_refresh(_stream(v, v.table("orders").select("o_custkey", "o_orderkey", "o_orderdate", F.concat(F.lit("order "), "o_orderkey", F.lit(" seen")).alias("notes"))), "o_custkey", "o_orderkey", v.table("customer").select(F.col("c_custkey").alias("o_custkey"), F.concat(F.lit("old | Manual: call "), "c_name").alias("notes"))).select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("latest"), "notes"), "select o_custkey, o_orderkey, cast(o_orderdate as date) as latest, concat('order ', o_orderkey, ' seen | Manual: call ', c_name) as notes from (select *, row_number() over (partition by o_custkey order by o_orderkey desc) as k from orders) o left join customer on c_custkey = o_custkey where k = 1")
