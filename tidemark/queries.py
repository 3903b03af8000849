"""A query for each operator over the generic tables, and the same in DuckDB's SQL."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import fixed, schemas, views
from tidemark.functions import ids
from tidemark.functions import text as X
from tidemark.functions import time as T
from tidemark.operators import backtest, classify, dedup, evidence, graphs, rules, signals
from tidemark.plans import analysis, report
from tidemark.sources import backfill, collect, feeds, history, landing, series, shared, tables
from tidemark.streaming import clusters, rolling

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


#: The views of views.py in SQL.
EV = """with ev as (
  select event_id as id, 'evt_' || event_id as event_id, date_trunc('second', ts) as event_at, user_id, event_type, value,
    date_trunc('second', case when user_id = 0 then greatest(ts, timestamp '2024-01-10') else ts end) + to_hours((event_id % 4)::int) as observed_at,
    'src_' || user_id as source_id, 'r' || (user_id % 3) as region, ['A','B','C','D'][(user_id % 4) + 1] as grade, event_id % 7 <> 0 as prim,
    json_extract(props, '$.k')::bigint as k, 'sec_s' || (json_extract(props, '$.k')::bigint % 16) as sector,
    case event_type when 'signup' then 'policy_regulation' when 'error' then 'macro' when 'click' then 'technology' when 'view' then 'capex' else 'supply_demand' end as category
  from events),
vis as (select * from ev where observed_at <= timestamp '2024-01-30 23:59:59'),
pri as (select * from vis where prim)
"""
DOC = """with doc as (
  select doc_id, 'raw_' || lpad(doc_id::varchar, 12, '0') as raw_id, source, coalesce(text, '') as body, split_part(coalesce(text, ''), chr(10), 1) as title, lang,
    date '2024-01-01' + (case lang when 'en' then 0 when 'fr' then 1 when 'de' then 2 else 3 end) as day
  from documents),
nrm as (select *, trim(regexp_replace(lower(regexp_replace(body, 'https?://[^\\s]+', ' ', 'g')), '\\s+', ' ', 'g'), ' ') as nbody,
  trim(regexp_replace(lower(regexp_replace(title, 'https?://[^\\s]+', ' ', 'g')), '\\s+', ' ', 'g'), ' ') as ntitle from doc)
"""
PRD = """with prd as (
  select 'prd_' || o_orderkey as prediction_id, o_orderkey, o_orderdate as issued_at, o_orderdate::date + 90 as due_date, ['>=','>','<=','<','==','between'][(o_orderkey % 6) + 1] as op, o_totalprice as v,
    case when o_orderkey % 12 = 5 then o_totalprice * 1.5 end as up, case when o_orderkey % 11 <> 0 then 'f' end as falsifier, o_orderpriority as sector from orders),
act as (select l_orderkey, round_even(sum(l_extendedprice), 2) as actual from lineitem group by 1),
jud as (select p.*, a.actual, case when actual is null then 'unresolvable' when case op when '>=' then actual >= v when '>' then actual > v when '<=' then actual <= v when '<' then actual < v when '==' then actual = v
    else up is not null and actual between v and up end then 'hit' else 'miss' end as verdict from prd p left join act a on l_orderkey = o_orderkey),
res as (select 'bt_' || prediction_id as result_id, prediction_id, issued_at + interval 100 day as evaluated_at, verdict, sector as cause from jud where o_orderkey % 5 <> 0)
"""
ISO = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')"


def normal(c: Column) -> Column:
    return X.normalize_text(c)


# visibility, windows, coverage


@query(EV + "select strftime(observed_at, '%Y-%m-%d') as day, count(*) as n, count(*) filter (where prim) as n_primary from vis group by 1")
def visibility_filter(spark, sf_dir):
    e = tables.known(views.events(spark, sf_dir), views.AS_OF)
    return e.groupBy(F.date_format("observed_at", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"), F.count_if("is_cluster_primary").alias("n_primary"))


@query(EV + "select source_id, count(*) as n, max(id) as last_id from pri group by 1")
def primary_filter(spark, sf_dir):
    return tables.known(views.events(spark, sf_dir), views.AS_OF, primary_only=True).groupBy("source_id").agg(F.count("*").alias("n"), F.max("id").alias("last_id"))


COUNTS = """, cnt as (
  select event_type as signal_type, count(*) filter (where event_at::date between date '2024-01-26' and date '2024-01-30') as n,
    round_even(count(*) filter (where event_at::date between date '2024-01-06' and date '2024-01-25') * 0.25::double, 3) as base
  from pri where event_at::date between date '2024-01-06' and date '2024-01-30' group by 1)
"""


@query(EV + COUNTS + "select signal_type, n as count, base as baseline_count, case when base > 0 then round_even(n / base - 1, 3) end as delta_ratio, n >= 2 and n > base as rising from cnt")
def signal_window_counts(spark, sf_dir):
    e = views.primary_events(spark, sf_dir).withColumn("topic", F.lit("all"))
    return signals.type_counts(e, views.WINDOW).select("signal_type", "count", "baseline_count", "delta_ratio", "rising")


def _windows_sql(start: str, base_start: str, base_end: str, end: str = "2024-01-30", scale: str = "0.25") -> str:
    return EV + f""", m as (select *, event_at::date between date '{start}' and date '{end}' as w, event_at::date between date '{base_start}' and date '{base_end}' as b from pri),
cnt as (select sector, event_type, count(*) filter (where w) as n, round_even(count(*) filter (where b) * {scale}::double, 3) as base from m where w or b group by 1, 2),
rising as (select sector, event_type from cnt where n >= 2 and n > base),
part as (select m.* from m join rising using (sector, event_type) where w),
starts as (select source_id, min(observed_at) as s from pri group by 1),
agg as (select sector, count(distinct source_id) as srcs, count(distinct region) as regs, bool_and(s <= timestamp '{base_start}') as cov from part join starts using (source_id) group by 1),
topics as (select 'sec_s' || i as sector from range(16) t(i)),
j as (select t.sector, (select count(*) from rising r where r.sector = t.sector) as types, coalesce(srcs, 0) as srcs, coalesce(regs, 0) as regs, coalesce(cov, false) as cov from topics t left join agg using (sector))
select 'sig_' || substr(sector, 5) || '_20240130' as window_id, types as distinct_signal_types, srcs as distinct_sources, regs as distinct_regions, cov as baseline_covered,
  round_even(least(types, 4) / 4 * 50 + least(srcs, 4) / 4 * 30 + least(regs, 3) / 3 * 20, 1) as score, cov and types >= 2 and srcs >= 2 as threshold_met from j"""


WINDOW_COLUMNS = ["window_id", "distinct_signal_types", "distinct_sources", "distinct_regions", "baseline_covered", "score", "threshold_met"]


@query(_windows_sql("2024-01-26", "2024-01-06", "2024-01-25"))
def signal_cooccurrence(spark, sf_dir):
    return signals.windows(views.primary_events(spark, sf_dir), views.TOPICS, views.WINDOW, views.AS_OF).select(*WINDOW_COLUMNS)


@query(_windows_sql("2024-01-24", "2023-12-27", "2024-01-23"))
def signal_default_window(spark, sf_dir):
    w = T.Window.ending(T.instant(views.AS_OF).date())
    return signals.windows(views.primary_events(spark, sf_dir), views.TOPICS, w, views.AS_OF).select(*WINDOW_COLUMNS)


@query(f"""with w as ({_windows_sql("2024-01-26", "2024-01-06", "2024-01-25")}), {EV.removeprefix("with ").rstrip()},
c as (select sector, event_type, count(*) filter (where event_at::date >= date '2024-01-26') as n, round_even(count(*) filter (where event_at::date < date '2024-01-26') * 0.25::double, 3) as base
  from pri where event_at::date between date '2024-01-06' and date '2024-01-30' group by all),
r as (select *, row_number() over (partition by sector order by n desc, event_type) as nth from c),
d as (select sector, string_agg(event_type || '=' || n || ' (' || regexp_replace(base::varchar, '\\.0$', '') || ')', ', ' order by nth) as detail from r where nth <= 4 group by sector)
select 'sector ' || substr(sector, 6) as label, case when threshold_met then '*' when not baseline_covered and distinct_signal_types >= 1 then '!' else '' end as mark, distinct_signal_types, distinct_sources, distinct_regions, score, detail
from w join d on 'sig_' || substr(sector, 5) || '_20240130' = window_id""")
def signal_overview(spark, sf_dir):
    return signals.overview(signals.windows(views.primary_events(spark, sf_dir), views.TOPICS, views.WINDOW, views.AS_OF), everything=True)


@query(f"select count(*) as windows, count(*) filter (where threshold_met) as fired, count(*) filter (where not baseline_covered) as held, count(*) filter (where not baseline_covered and distinct_signal_types >= 1) as held_rising from ({_windows_sql('2024-01-26', '2024-01-06', '2024-01-25')})")
def window_totals(spark, sf_dir):
    return report.window_totals(signal_cooccurrence(spark, sf_dir))


@query(EV + f"select source_id, {ISO.format('min(observed_at)')} as starts from pri group by 1")
def observation_coverage(spark, sf_dir):
    return signals.coverage_starts(views.primary_events(spark, sf_dir)).select("source_id", T.fmt(F.col("starts")).alias("starts"))


@query(EV + f""", live as (select source_id, user_id, min(observed_at) as s from pri group by 1, 2)
select source_id, {ISO.format("case when user_id % 5 = 0 and (user_id % 2 = 0 or date '2023-12-20' >= s::date - 1) then least(s, timestamp '2023-12-01') else s end")} as starts from live""")
def backfill_coverage(spark, sf_dir):
    e = views.primary_events(spark, sf_dir)
    known = e.select("source_id").distinct().withColumn("u", F.substring_index("source_id", "_", -1).cast("long")).filter("u % 5 = 0")
    spans = known.select("source_id", F.lit("2023-12-01").cast("date").alias("from_day"), F.when(F.col("u") % 2 == 0, F.lit("2024-02-01")).otherwise(F.lit("2023-12-20")).cast("date").alias("to_day"))
    return signals.coverage_starts(e, spans).select("source_id", T.fmt(F.col("starts")).alias("starts"))


@query(EV + "select topic, count(*) as n, count(distinct id) as n_events from (select 's3' as topic, id from pri where sector = 'sec_s3' or event_type = 'purchase' union all select 'clicks' as topic, id from pri where event_type = 'click' union all select 's5' as topic, id from pri where sector = 'sec_s5') group by 1")
def topic_match_union(spark, sf_dir):
    specs = [signals.Topic("three", ("purchase",), "sec_s3"), signals.Topic("Clicks", ("Click",), None, True), signals.Topic("five", (), "sec_s5")]
    return signals.match_topics(views.primary_events(spark, sf_dir), specs).groupBy("topic").agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_events"))


# landing


@query("""with b as (select doc_id, sha256(coalesce(text, '')) as key, source from documents where doc_id % 3 <> 1),
t as (select distinct sha256(coalesce(text, '')) as key from documents where doc_id % 3 = 1)
select key, min(doc_id) as doc_id from b where key not in (select key from t) group by 1""")
def insert_if_absent(spark, sf_dir):
    d = views.table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("key"))
    return tables.absent(d.filter("doc_id % 3 <> 1"), "key", [F.col("doc_id")], d.filter("doc_id % 3 = 1")).select("key", "doc_id")


@query("select case when source in ('src0','src1','src2','src3') then 'normalized' else 'skipped' end as status, count(*) as n from documents group by 1")
def source_lookup_skipped(spark, sf_dir):
    reg = tables.registry(spark, [{"source_id": f"src{i}", "name": f"Source {i}", "kind": "rss", "tier": "tier1", "reliability": "A"} for i in range(4)])
    return tables.with_sources(views.documents(spark, sf_dir), F.broadcast(reg)).groupBy("status").agg(F.count("*").alias("n"))


@query(EV + "select source_id as key, arg_max(event_type, (event_at, id)) as value from ev group by 1")
def last_wins(spark, sf_dir):
    e = views.events(spark, sf_dir).select(F.col("source_id").alias("key"), F.struct("event_at", "id").alias("day"), F.col("signal_types")[0].alias("value"))
    return tables.last_by_day(e)


# text and identity


@query("""select page_id, regexp_extract(url, '^([a-z]+)://', 1) || '://' || regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^www\\.', '') ||
  case when rtrim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') = '' then '/' else rtrim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') end ||
  case when q = '' then '' else '?' || q end as url from (
    select page_id, url, array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda p: p <> '' and split_part(p, '=', 1) not in ('utm_source','utm_medium','utm_campaign','ref'))), '&') as q from pages)""")
def canonical_url(spark, sf_dir):
    return views.table(spark, sf_dir, "pages").select("page_id", X.canonical_url(F.col("url")).alias("url"))


@query(DOC + "select doc_id, sha256(nbody) as normal_sha256, sha256(case when title <> '' and body <> '' then ntitle || chr(10) || nbody when body <> '' then nbody else '' end) as content_hash from nrm")
def normalize_and_hash(spark, sf_dir):
    d = views.documents(spark, sf_dir)
    return d.select("doc_id", F.sha2(normal(F.col("body")), 256).alias("normal_sha256"), X.content_hash(F.col("title"), F.col("body")).alias("content_hash"))


@query("""select page_id, 'raw_' || substr(sha256(url), 1, 16) as raw_id, 'evt_20240130_' || substr(sha256(html), 1, 10) as event_id, 'clu_' || substr(sha256('raw_' || substr(sha256(url), 1, 16)), 1, 10) as cluster_id, substr(sha256('a ' || page_id), 1, 8) as short from pages""")
def short_ids(spark, sf_dir):
    p = views.table(spark, sf_dir, "pages")
    raw = ids.raw_id(F.col("url"))
    return p.select("page_id", raw.alias("raw_id"), ids.event_id(T.at(views.AS_OF), F.sha2("html", 256)).alias("event_id"), ids.cluster_id(raw).alias("cluster_id"), X.short_hash(F.lit("a"), F.col("page_id").cast("string"), length=8).alias("short"))


@query("select p_partkey, 'nd_' || substr(trim(regexp_replace(lower(p_name || ' / ' || p_type), '[^a-z0-9]+', '_', 'g'), '_'), 1, 60) as node_id from part")
def slug_names(spark, sf_dir):
    return views.table(spark, sf_dir, "part").select("p_partkey", ids.named("nd_", F.concat_ws(" / ", "p_name", "p_type")).alias("node_id"))


TOKENS = DOC + ", tok as (select doc_id, raw_id, source, day, list_distinct(list_filter(regexp_extract_all(nbody, '[a-z0-9]+(?:[.\\-_][a-z0-9]+)*'), lambda w: length(w) > 1)) as t from nrm)\n"


@query(TOKENS + "select doc_id, len(t)::int as n, sha256(array_to_string(list_sort(t), ' ')) as tokens_sha256 from tok")
def token_sets(spark, sf_dir):
    t = X.tokens(normal(F.col("body")))
    return views.documents(spark, sf_dir).select("doc_id", t.alias("t")).select("doc_id", F.size("t").alias("n"), F.sha2(F.array_join(F.array_sort("t"), " "), 256).alias("tokens_sha256"))


@query(TOKENS + """select a.doc_id, case when len(list_intersect(a.t, b.t)) = 0 then 0.0::double else round_even(len(list_intersect(a.t, b.t)) / (len(a.t) + len(b.t) - len(list_intersect(a.t, b.t))), 6) end as jaccard,
case when len(list_intersect(a.t, b.t)) = 0 then 0.0::double when least(len(a.t), len(b.t)) < 8 then round_even(len(list_intersect(a.t, b.t)) / (len(a.t) + len(b.t) - len(list_intersect(a.t, b.t))), 6)
  else round_even(len(list_intersect(a.t, b.t)) / least(len(a.t), len(b.t)), 6) end as similarity from tok a join tok b on b.doc_id = a.doc_id + 1""")
def neighbour_similarity(spark, sf_dir):
    t = views.documents(spark, sf_dir).select("doc_id", X.tokens(normal(F.col("body"))).alias("t"))
    b = t.select((F.col("doc_id") - 1).alias("doc_id"), F.col("t").alias("u"))
    return t.join(b, "doc_id").select("doc_id", F.bround(X.jaccard(F.col("t"), F.col("u")), 6).alias("jaccard"), F.bround(X.similarity(F.col("t"), F.col("u")), 6).alias("similarity"))


@query(TOKENS + """, ex as (select day, raw_id, len(t) as n, unnest(t) as w from tok), pairs as (select a.raw_id as a, b.raw_id as b, any_value(a.n) as n, any_value(b.n) as m, count(*) as shared from ex a join ex b on a.day = b.day and a.w = b.w and a.raw_id < b.raw_id group by 1, 2)
select a, b, shared::int as shared, round_even(case when least(n, m) < 8 then shared / (n + m - shared) else shared / least(n, m) end, 6) as similarity from pairs where case when least(n, m) < 8 then shared / (n + m - shared) else shared / least(n, m) end >= 0.9""")
def containment_pairs(spark, sf_dir):
    d = views.documents(spark, sf_dir).select(F.to_date("event_at").alias("event_date"), "raw_id", X.tokens_of(F.col("body")).alias("tokens"))
    return dedup.similar_pairs(d, 0.9).select("a", "b", F.col("both").alias("shared"), F.bround("similarity", 6).alias("similarity"))


RULES = {"legal": ("license", "all rights"), "phrase": ("on the", "of the"), "word": ("the",)}
SECTORS = (("sec_x", "X", ("the", "of")), ("sec_y", "Y", ("license", "und")), ("sec_z", "Z", ("apache license",)))
EDGE = "[^\\p{L}\\p{N}_]"


@query(DOC + f"""select doc_id, array_to_string(list_filter([case when regexp_matches(nbody, '(^|{EDGE})(license|all rights($|{EDGE}))') then 'legal' end, case when regexp_matches(nbody, '(^|{EDGE})(on the|of the)($|{EDGE})') then 'phrase' end,
case when regexp_matches(nbody, '(^|{EDGE})the') then 'word' end], lambda x: x is not null), ',') as signal_types from nrm""")
def keyword_signals(spark, sf_dir):
    t = classify.signal_types(F.col("n"), rules=RULES)
    return views.documents(spark, sf_dir).select("doc_id", normal(F.col("body")).alias("n")).select("doc_id", F.array_join(t, ",").alias("signal_types"))


@query(DOC + f"""select doc_id, array_to_string(list_filter([case when regexp_matches(nbody, '(^|{EDGE})(the|of)(e?s)?($|{EDGE})') then 'sec_x' end, case when regexp_matches(nbody, '(^|{EDGE})(license|und)(e?s)?($|{EDGE})') then 'sec_y' end,
case when regexp_matches(nbody, '(^|{EDGE})apache license(e?s)?($|{EDGE})') then 'sec_z' end, case when source = 'src1' and not regexp_matches(nbody, '(^|{EDGE})(the|of)(e?s)?($|{EDGE})') then 'sec_x' end], lambda x: x is not null), ',') as sectors from nrm""")
def sector_links(spark, sf_dir):
    d = views.documents(spark, sf_dir).select("doc_id", "source_id", normal(F.col("body")).alias("n"))
    found = classify.sector_ids(F.col("n"), F.when(F.col("source_id") == "src1", F.array(F.lit("sec_x"))), SECTORS)
    return d.select("doc_id", F.array_join(F.transform(classify.sector_links(found), lambda s: s["sector_id"]), ",").alias("sectors"))


@query("""select l_orderkey, l_linenumber, case when l_shipmode in ('patent','paper') then 'technology' when l_shipmode in ('capex_guidance','new_facility') then 'capex' when l_shipmode in ('tariff') then 'x' when l_shipmode = 'subsidy' then 'policy_regulation'
 when l_shipmode = 'supply_contract' then 'supply_demand' when l_shipmode = 'new_standard' then 'standard' when l_shipmode = 'vc_investment' then 'corporate_action' else case when l_partkey % 3 = 0 then 'market_data' else 'macro' end end as category,
 ['high','high','medium','low'][(l_suppkey % 4) + 1] as confidence from (select *, ['paper','subsidy','new_facility','supply_contract','new_standard','vc_investment','job_posting'][(l_partkey % 7) + 1] as l_shipmode from lineitem)""")
def category_case(spark, sf_dir):
    li = views.table(spark, sf_dir, "lineitem")
    kinds = F.array(*map(F.lit, ("paper", "subsidy", "new_facility", "supply_contract", "new_standard", "vc_investment", "job_posting")))
    types = F.array(F.get(kinds, (F.col("l_partkey") % 7).cast("int")))
    cats = F.when(F.col("l_partkey") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("macro")))
    grade = F.get(F.array(*map(F.lit, fixed.RELIABILITY)), (F.col("l_suppkey") % 4).cast("int"))
    return li.select("l_orderkey", "l_linenumber", classify.category(types, cats).alias("category"), classify.confidence(grade).alias("confidence"))


@query("""select s_suppkey, case when s_suppkey % 3 = 0 then case when s_suppkey % 2 = 0 then 'government' else 'company' end else 'institution' end as kind from supplier""")
def actor_kinds(spark, sf_dir):
    s = views.table(spark, sf_dir, "supplier")
    tier, name = F.when(F.col("s_suppkey") % 3 == 0, "tier1").otherwise("tier2"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("Federal "), "s_name")).otherwise(F.col("s_name"))
    return s.select("s_suppkey", classify.actor_kind(tier, F.lit("A"), F.lit(None).cast("string"), name).alias("kind"))


@query(DOC + "select doc_id, sha256(case when length(s) <= 600 then s else rtrim(substr(s, 1, 600)) || '…' end) as summary_sha256 from (select doc_id, trim(regexp_replace(body, '\\s+', ' ', 'g'), ' ') as s from doc)")
def summarize_text(spark, sf_dir):
    return views.documents(spark, sf_dir).select("doc_id", F.sha2(X.summarize(F.col("body")), 256).alias("summary_sha256"))


@query(r"""select page_id, regexp_replace(regexp_replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;?', '&', 'g'), '^\s+|\s+$', '', 'g') as text from pages""")
def strip_markup(spark, sf_dir):
    return views.table(spark, sf_dir, "pages").select("page_id", X.strip_markup(F.col("html")).alias("text"))


@query("select p_partkey, case when x = floor(x) then format('{:,}', x::bigint) else regexp_replace(format('{:,.3f}', x), '\\.?0+$', '') end as shown from (select p_partkey, case when p_partkey % 5 = 0 then floor(p_retailprice) else p_retailprice end * 10 as x from part)")
def format_values(spark, sf_dir):
    x = F.when(F.col("p_partkey") % 5 == 0, F.floor("p_retailprice").cast("double")).otherwise(F.col("p_retailprice")) * 10
    return views.table(spark, sf_dir, "part").select("p_partkey", X.format_value(x).alias("shown"))


@query(DOC + "select doc_id, regexp_matches(body, '\\$[A-Z]{2,5}\\b|\\b(NASDAQ|NYSE):') or regexp_matches(lower(body), '\\b(top|best|worst)\\s*[0-9]+\\b') and regexp_matches(lower(body), '\\btop\\s*[0-9]+\\b|\\b(best|worst)\\s+[0-9]+\\b') as prohibited from (select doc_id, body || case when doc_id % 3 = 0 then ' Top 10' when doc_id % 3 = 1 then ' $AAPL' else ' plain' end as body from doc)")
def prohibited_text(spark, sf_dir):
    d = views.documents(spark, sf_dir)
    tail = F.when(F.col("doc_id") % 3 == 0, " Top 10").when(F.col("doc_id") % 3 == 1, " $AAPL").otherwise(" plain")
    return d.select("doc_id", X.prohibited(F.concat("body", tail)).alias("prohibited"))


@query("select 'raw_' || lpad(doc_id::varchar, 12, '0') as raw_id, greatest(doc_id % 4 - 1, 0)::int as batch from documents")
def landing_index(spark, sf_dir):
    """Documents arrive in four batches, half of each again in the next, the last one twice; the batch in which each landed."""
    d = views.documents(spark, sf_dir).select("raw_id", "doc_id", "source_id", "title", "observed_at")
    held = landing.Landing(spark, shared.folder(spark, "landing"), buckets=16)
    for i in (0, 1, 2, 3, 3):
        held.put(d.filter(F.pmod("doc_id", F.lit(4)).isin(i, i + 1)).drop("doc_id").withColumn("batch", F.lit(i)), [F.col("observed_at"), F.col("raw_id")])
    return held.read().select("raw_id", "batch")


HISTORY_AS_OF = "1996-03-01T00:00:00Z"


@query("""with o as (select *, case when month(o_orderdate) >= 7 then make_timestamp(year(o_orderdate), 7, 1, 0, 0, 0) else make_timestamp(year(o_orderdate), 1, 1, 0, 0, 0) end as half from orders),
b as (select half, o_custkey, max(o_orderkey) as o_orderkey from o group by all),
v as (select b.*, o_orderpriority, o_totalprice > 200000 as large from b join orders using (o_orderkey)),
c as (select *, row_number() over (partition by o_custkey order by half) as r, lag(o_orderpriority) over (partition by o_custkey order by half) as p, lag(large) over (partition by o_custkey order by half) as l from v),
d as (select *, lead(half) over (partition by o_custkey order by half) as until from c where r = 1 or p is distinct from o_orderpriority or l is distinct from large)
select o_custkey, o_orderpriority, large, half as valid_from, until as valid_to from d where half <= timestamp '1996-03-01' and (until is null or until > timestamp '1996-03-01')""")
def history_as_of(spark, sf_dir):
    """Customers' last orders are put every half year, unless nothing changed; the table as it stood in March 1996, with later versions in it."""
    o = views.table(spark, sf_dir, "orders").withColumn("half", F.make_timestamp(F.year("o_orderdate"), F.when(F.month("o_orderdate") >= 7, 7).otherwise(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    last = o.groupBy("half", "o_custkey").agg(F.max_by(F.struct("o_orderpriority", (F.col("o_totalprice") > 200000).alias("large")), "o_orderkey").alias("x")).select("half", "o_custkey", "x.*")
    made = history.History(spark, shared.folder(spark, "history"), "o_custkey")
    for at in sorted(r.half for r in last.select("half").distinct().collect()):
        made.put(last.filter(F.col("half") == F.lit(at)).drop("half"), f"{at:%Y-%m-%dT%H:%M:%SZ}")
    return made.read(HISTORY_AS_OF)


# clusters


@query(DOC + """, k as (select raw_id, doc_id, source, day, sha256(nbody) as h, ntitle as key from nrm),
w as (select *, first_value(raw_id) over (partition by day, h order by doc_id) as hf, first_value(source) over (partition by day, h order by doc_id) as hs,
  first_value(raw_id) over (partition by day, key order by doc_id) as kf, first_value(source) over (partition by day, key order by doc_id) as ks from k)
select raw_id, case when hf <> raw_id and hs <> source then hf end as hash_of, case when kf <> raw_id and ks <> source then kf end as key_of,
  coalesce(case when hf <> raw_id and hs <> source then hf end, case when kf <> raw_id and ks <> source then kf end, raw_id) as primary_of from w""")
def dedup_exact_keys(spark, sf_dir):
    d = views.documents(spark, sf_dir)
    k = d.select("raw_id", "source_id", "observed_at", F.to_date("event_at").alias("event_date"), F.col("url").alias("canonical_url"), F.sha2(normal(F.col("body")), 256).alias("content_hash"), normal(F.col("title")).alias("event_key"))
    return dedup.exact_clusters(k).select("raw_id", "hash_of", "key_of", "primary_of")


@query(DOC + """, k as (select raw_id, doc_id, source, day, sha256(nbody) as h from nrm),
w as (select *, first_value(raw_id) over o as f, first_value(source) over o as fs from k window o as (partition by day, h order by doc_id)),
j as (select *, raw_id <> f and (source <> fs or coalesce(max((source <> fs)::int) over (partition by day, h order by doc_id rows between unbounded preceding and 1 preceding), 0) = 1) as joins from w)
select raw_id, case when joins then f else raw_id end as primary_of, case when joins then 'content_hash' else 'event_key' end as method from j""")
def day_state_clusters(spark, sf_dir):
    """The days' documents arrive in three runs of a stream, which carry the clusters by URL and hash as state."""
    d = views.documents(spark, sf_dir)
    k = d.select("doc_id", "raw_id", "source_id", "observed_at", F.to_date("event_at").alias("event_date"), F.col("url").alias("canonical_url"), F.sha2(normal(F.col("body")), 256).alias("content_hash"), F.lit(None).cast("string").alias("event_key"), F.array().cast("array<string>").alias("tokens"))
    cuts = k.agg(F.percentile_approx("doc_id", [1 / 3, 2 / 3])).first()[0]
    arriving, found, state = (shared.folder(spark, f"day-{x}") for x in ("arriving", "found", "state"))
    for here in (F.col("doc_id") <= cuts[0], (F.col("doc_id") > cuts[0]) & (F.col("doc_id") <= cuts[1]), F.col("doc_id") > cuts[1]):
        k.filter(here).write.mode("append").parquet(arriving)
        clusters.follow(spark.readStream.schema(k.schema).parquet(arriving), found, state, methods=("canonical_url", "content_hash")).awaitTermination()
    return spark.read.schema(dedup.ASSIGNED).parquet(found).select("raw_id", F.coalesce("duplicate_of", "raw_id").alias("primary_of"), "method")


#: The clusters of each day, one document after the other; a day's state are lists of clusters, and of keys with the cluster that each led to.
CLUSTERS = """
d as (select t.day, row_number() over (partition by t.day order by t.doc_id) as n, t.raw_id, t.source, n.ntitle || chr(10) || n.nbody as h, n.ntitle as k, list_sort(t.t) as t from tok t join nrm n using (doc_id)),
rec(day, n, raw_id, method, sim, c, heads, srcs, toks, hs, ks, cs) as (
  select day, n, raw_id, 'event_key', 1.0::double, 1, [raw_id], [[source]], [t[:400]], [h], [k], [1] from d where n = 1
  union all
  select day, n, raw_id, case when c1 is not null then 'content_hash' when c2 is not null then 'event_key' when c3 is not null then 'token_similarity' else 'event_key' end,
    case when c1 is null and c2 is null and c3 is not null then round_even(best, 4) else 1.0 end, c,
    case when c > len(heads) then list_append(heads, raw_id) else heads end,
    case when c > len(heads) then list_append(srcs, [source]) else list_transform(srcs, lambda x, i: case when i = c then list_distinct(list_append(x, source)) else x end) end,
    case when c > len(heads) then list_append(toks, t[:400]) else list_transform(toks, lambda x, i: case when i = c and not list_has_all(x, t) then list_sort(list_distinct(list_concat(x, t)))[:400] else x end) end,
    list_append(hs, h), list_append(ks, k), list_append(cs, c)
  from (select *, coalesce(c1, c2, c3, len(heads) + 1) as c from (
    select *, case when best >= 0.6 then list_position(sims, best) end as c3 from (
      select *, list_max(sims) as best from (
        select d.*, r.heads, r.srcs, r.toks, r.hs, r.ks, r.cs,
          case when len(list_filter(r.srcs[r.cs[list_position(r.hs, d.h)]], lambda x: x <> d.source)) > 0 then r.cs[list_position(r.hs, d.h)] end as c1,
          case when len(list_filter(r.srcs[r.cs[list_position(r.ks, d.k)]], lambda x: x <> d.source)) > 0 then r.cs[list_position(r.ks, d.k)] end as c2,
          list_transform(r.toks, lambda x, i: case when len(list_filter(r.srcs[i], lambda y: y <> d.source)) = 0 or len(x) = 0 or len(d.t) = 0 then 0.0::double
            when least(len(x), len(d.t)) >= 8 then len(list_intersect(x, d.t)) / least(len(x), len(d.t)) else len(list_intersect(x, d.t)) / len(list_distinct(list_concat(x, d.t))) end) as sims
        from rec r join d on d.day = r.day and d.n = r.n + 1)))))
select raw_id, 'clu_' || substr(sha256(heads[c]), 1, 10) as cluster_id, heads[c] = raw_id as is_cluster_primary, method, sim as similarity, case when heads[c] <> raw_id then heads[c] end as duplicate_of from rec"""


@query(TOKENS.replace("with doc", "with recursive doc", 1) + "," + CLUSTERS)
def dedup_cluster(spark, sf_dir):
    return dedup.assign_clusters(dedup.keyed(views.documents(spark, sf_dir), F.lit("publisher")))


# evidence and statistics

ORDER = "grade, event_at desc, observed_at, event_id"


@query(EV + f"""select position, event_id, kind from (
  select row_number() over (order by late, {ORDER}) as position, event_id, 'report' as kind from (
    select *, case when n <= 150 then false else nth > 4 end as late from (select *, count(*) over () as n, row_number() over (partition by source_id, event_at::date order by {ORDER}) as nth from pri where sector = 'sec_s3' and event_type <> 'purchase'))
  union all select row_number() over (order by {ORDER}), event_id, 'statistic' from pri where sector = 'sec_s3' and event_type = 'purchase') where position <= case kind when 'report' then 150 else 60 end""")
def evidence_bundle(spark, sf_dir):
    topic = signals.Topic("three", (), "sec_s3")
    return evidence.bundle(views.events(spark, sf_dir), topic, views.AS_OF).select(F.col("position").cast("long").alias("position"), "event_id", "kind")


@query(EV + f"""select sector, position, event_id from (select *, row_number() over (partition by sector order by late, {ORDER}) as position from (
  select *, case when n <= 40 then false else nth > 1 end as late from (select *, count(*) over (partition by sector) as n, row_number() over (partition by sector, source_id, event_at::date order by {ORDER}) as nth from pri))) where position <= 40""")
def evidence_diversified(spark, sf_dir):
    e = views.primary_events(spark, sf_dir).withColumn("sector", F.col("sector_links")[0]["sector_id"])
    order = [F.col("max_reliability"), F.col("event_at").desc(), F.col("observed_at"), F.col("event_id")]
    return evidence.diversify(e, order, 40, ("sector",), 1).select("sector", F.col("position").cast("long").alias("position"), "event_id")


@query(EV + f"select * from (select sector, event_id, row_number() over (partition by sector order by {ORDER}) as position from pri) where position <= 10")
def evidence_topk(spark, sf_dir):
    e = views.primary_events(spark, sf_dir).withColumn("sector", F.col("sector_links")[0]["sector_id"])
    order = [F.col("max_reliability"), F.col("event_at").desc(), F.col("observed_at"), F.col("event_id")]
    return e.withColumn("position", evidence.ordered(order, ("sector",)).cast("long")).filter("position <= 10").select("sector", "event_id", "position")


@query(EV + "select count(*) filter (where grade = 'A') as \"A\", count(*) filter (where grade = 'B') as \"B\", count(*) filter (where grade = 'C') as \"C\", count(*) filter (where grade = 'D') as \"D\" from pri")
def reliability_histogram(spark, sf_dir):
    return evidence.reliability_counts(views.primary_events(spark, sf_dir))


@query(EV + f"select {ISO.format('min(observed_at)')} as oldest, {ISO.format('max(observed_at)')} as newest from pri where event_type <> 'purchase'")
def evidence_span(spark, sf_dir):
    e = views.primary_events(spark, sf_dir).withColumn("kind", F.when(evidence.is_statistic(), "statistic").otherwise("report"))
    return evidence.evidence_span(e).select(T.fmt(F.col("oldest")).alias("oldest"), T.fmt(F.col("newest")).alias("newest"))


@query(EV + "select 'k' || (k % 10) as label, 'USD' as unit, count(*)::int as n, sha256(string_agg(strftime(event_at, '%Y-%m-%d') || event_id, ',' order by strftime(event_at, '%Y-%m-%d'), event_id)) as points_sha256 from pri where event_type = 'purchase' group by 1")
def statistics_series(spark, sf_dir):
    s = evidence.series(views.primary_events(spark, sf_dir))
    return s.select("label", "unit", F.size("points").alias("n"), F.sha2(F.array_join(F.transform("points", lambda p: F.concat(p["period"], p["event_id"])), ","), 256).alias("points_sha256"))


@query("""select label, 'USD' as unit, period, value, n from (select l_returnflag || l_linestatus as label, strftime(l_shipdate, '%Y-%m') as period, l_extendedprice as value, count(*) over (partition by l_returnflag || l_linestatus) as n,
row_number() over (partition by l_returnflag || l_linestatus order by strftime(l_shipdate, '%Y-%m') desc, l_shipdate, l_orderkey || '_' || lpad(l_linenumber::varchar, 2, '0')) as nth from lineitem) where nth = 1 order by label limit 8""")
def latest_statistics(spark, sf_dir):
    return evidence.latest_points(views.quantity_events(spark, sf_dir))


@query("""with known as (select doc_id from documents where doc_id % 5 <> 0) select 'labels[' || doc_id || ']' as path, 'doc' || doc_id as event_id from labels where doc_id not in (select doc_id from known)""")
def grounding_violations(spark, sf_dir):
    doc = F.concat(F.lit("doc"), "doc_id")
    cited = views.table(spark, sf_dir, "labels").select(F.concat(F.lit("labels["), "doc_id", F.lit("]")).alias("path"), doc.alias("event_id"))
    return evidence.ungrounded(cited, views.table(spark, sf_dir, "documents").filter("doc_id % 5 <> 0").select(doc.alias("event_id"))).select("path", "event_id")


# report

TODAY = EV + ", tod as (select * from pri where observed_at::date = date '2024-01-30')\n"


@query(TODAY + "select category as value, count(*) as n from tod group by 1")
def category_counts(spark, sf_dir):
    return report.counts(report.today(views.primary_events(spark, sf_dir), "2024-01-30"), "category")


@query(TODAY + "select event_type as value, count(*) as n from tod group by 1")
def signal_type_counts(spark, sf_dir):
    return report.counts(report.today(views.primary_events(spark, sf_dir), "2024-01-30"), "signal_types")


@query(TODAY + "select i::int as position, 'sec_s' || i as sector_id, 'sector ' || i as name, (select count(*) from tod where sector = 'sec_s' || i) as n from range(18) t(i)")
def sector_monitor(spark, sf_dir):
    sectors = spark.range(18).select(F.col("id").cast("int").alias("position"), F.concat(F.lit("sec_s"), "id").alias("sector_id"), F.concat(F.lit("sector "), "id").alias("name"))
    return report.sector_counts(report.today(views.primary_events(spark, sf_dir), "2024-01-30"), sectors)


@query(EV + "select count(*) as events_ingested, count(*) filter (where prim) as events_after_dedup, 34 as sources_polled from vis where observed_at::date = date '2024-01-30'")
def report_coverage(spark, sf_dir):
    return report.coverage(views.events(spark, sf_dir), views.AS_OF, "2024-01-30", 34)


@query(TODAY + "select category, position, line from (select category, row_number() over (partition by category order by grade desc, event_at desc, observed_at, event_id)::int as position, '[' || grade || '] ' || strftime(event_at, '%Y-%m-%d') || ' ' || event_type || ' ' || id || ' (' || event_id || ')' as line from tod where event_type <> 'purchase') where position <= 8")
def report_section_rows(spark, sf_dir):
    return report.section_rows(report.today(views.primary_events(spark, sf_dir), "2024-01-30"))


@query()
def daily_report(spark, sf_dir):
    w = signals.windows(views.primary_events(spark, sf_dir), views.TOPICS, views.WINDOW, views.AS_OF)
    made = report.build(views.events(spark, sf_dir), w, views.AS_OF, "2024-01-30", 34, {"predictions": views.predictions(spark, sf_dir), "results": views.results(spark, sf_dir)})
    return spark.createDataFrame([(s["no"], s["key"], s["body"]) for s in made["sections"]], "no int, section string, body string")


ROLLING_ENDS = (date(2024, 1, 8), date(2024, 1, 15), date(2024, 1, 22), date(2024, 1, 30))


@query(EV + """, ends as (select unnest([date '2024-01-08', date '2024-01-15', date '2024-01-22', date '2024-01-30']) as end_day),
c as (select end_day, sector, event_type as signal_type, count(*) filter (where event_at::date > end_day - 3) as count, count(*) filter (where event_at::date <= end_day - 3) as before
  from ev, ends where prim and observed_at::date <= end_day and event_at::date between end_day - 14 and end_day group by all)
select strftime(end_day, '%Y-%m-%d') as end_day, sector[5:] as topic, signal_type, count, round_even(before * 0.25::double, 3) as baseline_count, case when before > 0 then round_even(count / round_even(before * 0.25::double, 3) - 1, 3) end as delta_ratio from c""")
def rolling_windows(spark, sf_dir):
    """Events arrive in the order of observation, in four runs; windows of three days with baselines of twelve are moved on after each."""
    matched = signals.match_topics(views.events(spark, sf_dir).filter(F.coalesce("is_cluster_primary", F.lit(True))), views.TOPICS)
    kept = rolling.Rolling(spark, shared.folder(spark, "rolling"), days=3, multiplier=4)
    found, last = [], None
    for i, end in enumerate(ROLLING_ENDS):
        seen = F.to_date("observed_at")
        kept.add(matched.filter((seen <= F.lit(end)) & (F.lit(True) if last is None else seen > F.lit(last))), i)
        kept.advance(end)
        found.append(kept.counts().select(F.lit(end.isoformat()).alias("end_day"), "topic", "signal_type", "count", "baseline_count", "delta_ratio"))
        last = end
    return reduce(DataFrame.unionByName, found)


# sources


def _payloads(lines: DataFrame, payload: Column) -> DataFrame:
    """A payload of each order's lines."""
    return lines.groupBy("l_orderkey").agg(payload.alias("payload")).select(F.concat(F.lit("src_"), "l_orderkey").alias("source_id"), "payload", T.at(views.AS_OF).alias("observed_at"))


@query("""select 'src_' || l_orderkey as source_id, '2026-0' || l_linenumber as period, sum(l_quantity) as value, 'Output（' || case l_returnflag when 'A' then 'Gas' when 'R' then 'Solid' else 'N' end || '）' as label, 'TJ' as unit, l_returnflag as siec
from lineitem where l_quantity <> 7 group by l_orderkey, l_linenumber, l_returnflag""")
def jsonstat_unflatten(spark, sf_dir):
    """Each order as a sparse cube of flag and line number, of which one flag has no caption."""
    lines = views.table(spark, sf_dir, "lineitem").filter("l_quantity <> 7").groupBy("l_orderkey", "l_returnflag", "l_linenumber").agg(F.sum("l_quantity").alias("q"))
    flat = (F.instr(F.lit("ANR"), F.col("l_returnflag")) - 1) * 7 + F.col("l_linenumber") - 1
    values = F.to_json(F.map_from_entries(F.collect_list(F.struct(flat.cast("string"), "q"))))
    months = ",".join(f'"2026-0{i + 1}":{i}' for i in range(7))
    head = '{"label":"Output","id":["siec","time"],"size":[3,7],"dimension":{"siec":{"category":{"index":{"A":0,"N":1,"R":2},"label":{"A":"Gas","R":"Solid"}}},"time":{"category":{"index":{%s}}}},"value":' % months
    found = series.jsonstat(_payloads(lines, F.concat(F.lit(head), values, F.lit("}"))), {}, {"unit": "TJ"})
    return found.select("source_id", "period", "value", "label", "unit", F.try_element_at("keys", F.lit("siec")).alias("siec"))


@query("""select 'src_' || l_orderkey as source_id, strftime(l_shipdate, '%Y-%m-%d') as period, l_extendedprice as value, 'Yield 10y' as label, '%' as unit, '10y' as tenor from lineitem
union all select 'src_' || l_orderkey, strftime(l_shipdate, '%Y-%m-%d'), l_discount, 'Yield 2y', '%', '2y' from lineitem where l_returnflag <> 'N'""")
def odata_unpivot(spark, sf_dir):
    """Each order as a feed with an entry a line; one column is empty in some."""
    row = F.concat(
        F.lit("<entry><content><m:properties><d:NEW_DATE m:type='x'>"), F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("</d:NEW_DATE><d:BC_10YEAR>"), F.col("l_extendedprice").cast("string"),
        F.lit("</d:BC_10YEAR><d:BC_2YEAR>"), F.when(F.col("l_returnflag") != "N", F.col("l_discount").cast("string")).otherwise(""), F.lit("</d:BC_2YEAR><d:NOTE m:null='true'/></m:properties></content></entry>"),
    )
    feed = F.concat(F.lit("<feed>"), F.array_join(F.collect_list(row), ""), F.lit("</feed>"))
    found = series.odata(_payloads(views.table(spark, sf_dir, "lineitem"), feed), {}, {"label": "Yield", "unit": "%", "fields": {"10y": "BC_10YEAR", "2y": "BC_2YEAR"}})
    return found.select("source_id", "period", "value", "label", "unit", F.element_at("keys", "tenor").alias("tenor"))


@query("""select 'src_' || l_orderkey as source_id, year(l_shipdate)::varchar as period, round_even(l_extendedprice, 2) as value, 'GDP（' || l_returnflag || '）' as label, 'USD' as unit, l_returnflag as country from lineitem where l_linestatus = 'O'""")
def records_explode(spark, sf_dir):
    """Each order as meta data and a list of records, some without a value, numbers with separators."""
    value = F.when(F.col("l_linestatus") == "O", F.format_number("l_extendedprice", 2))
    item = F.struct(F.struct(F.lit("GDP").alias("value")).alias("indicator"), F.struct(F.col("l_returnflag").alias("value")).alias("country"), F.year("l_shipdate").cast("string").alias("date"), value.alias("value"))
    doc = F.concat(F.lit('[{"lastupdated":"2026-07-13"},'), F.to_json(F.collect_list(item)), F.lit("]"))
    spec = {"points_path": "1", "label": "indicator.value", "key_fields": {"country": "country.value"}}
    found = series.records(_payloads(views.table(spark, sf_dir, "lineitem"), doc), spec, {"unit": "USD"})
    return found.select("source_id", "period", "value", "label", "unit", F.element_at("keys", "country").alias("country"))


@query("""with s as (select o_custkey % 400 as code, 'src_' || (o_custkey % 20) as source_id, count(*) as n, sum(o_totalprice) as total from orders group by all),
j as (select *, case when code % 5 = 2 then 'HTTP 503' when code % 3 = 2 then 'not JSON' when code % 3 = 1 then 'LIMIT: quota; wait' end as error from s),
a as (select source_id, bool_or(error is null) as alive from j group by 1),
e as (select source_id, code || ': ' || error as why, row_number() over (partition by source_id order by '{"code":"' || code || '"}') as r from j where error is not null)
select a.source_id, coalesce(sum(n) filter (where error is null), 0)::bigint as n_points, round_even(sum(total) filter (where error is null), 2) as total, count(error) filter (where alive) as n_failed,
  any_value(case when not alive then w.whys end) as failed
from a join j using (source_id) left join (select source_id, string_agg(why, '; ' order by r) filter (where r <= 3) as whys from e group by 1) w using (source_id) group by a.source_id""")
def series_partial_failures(spark, sf_dir):
    """400 series of 20 sources made of orders: some answer with an error, a status or no JSON; four sources fail as a whole."""
    code = F.col("o_custkey") % 400
    item = F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_totalprice").alias("value"))
    made = views.table(spark, sf_dir, "orders").groupBy(code.alias("code"), F.concat(F.lit("src_"), (F.col("o_custkey") % 20).cast("string")).alias("source_id")).agg(F.to_json(F.collect_list(item)).alias("data"))
    odd = F.col("code") % 3
    payload = F.when(odd == 2, F.concat(F.lit("<html>"), "data")).when(odd == 1, F.lit('{"status":"LIMIT","message":["quota","wait"]}')).otherwise(F.concat(F.lit('{"status":"OK","data":'), "data", F.lit("}")))
    down = F.col("code") % 5 == 2
    spec = {"format": "records", "points_path": "data", "status_path": "status", "status_ok": ["OK"], "point_url_template": "https://x.org/{code}/{period}", "key_fields": {"day": "date"}}
    rows = made.select("source_id", F.lit("json_series").alias("kind"), F.lit(json.dumps(spec)).alias("spec"), F.format_string('{"code":"%s"}', F.col("code").cast("string")).alias("part"), F.when(~down, payload).alias("payload"), F.when(down, "HTTP 503").alias("error"), T.at(views.AS_OF).alias("observed_at"))
    points, failed = collect.statistics(rows)
    points = points.groupBy("source_id").agg(F.count("*").alias("n_points"), F.bround(F.sum(F.get("quantities", F.lit(0))["value"]), 2).alias("total"))
    failed = failed.groupBy("source_id").agg(F.count_if(~F.col("whole")).alias("n_failed"), F.max(F.when(F.col("whole"), F.col("error"))).alias("failed"))
    both = points.join(failed, "source_id", "full")
    return both.select("source_id", F.coalesce("n_points", F.lit(0)).alias("n_points"), "total", F.coalesce("n_failed", F.lit(0)).alias("n_failed"), "failed")


@query("""with e as (select *, event_id % 6 as k from events)
select 'src_' || event_id as source_id, case k when 4 then 'no collector for kind gopher' when 5 then 'no mapping: the source doesn''t say how it is read' else
  case when event_id % 7 = 0 then case k when 0 then 'empty' when 3 then 'a: not JSON' else 'not JSON' end when event_id % 11 = 0 then case k when 0 then 'html' when 3 then 'a: WAIT: quota' else 'WAIT: quota' end
  else case k when 3 then event_type || ' ' || strftime(ts, '%Y-%m-%d') else event_type || ' ' || event_id end end end as outcome from e""")
def collect_all_kinds(spark, sf_dir):
    """Each event as the answer of a source of its own: feeds, lists under two mappings, statistics, an unknown kind and one without mapping. All give a document or an error."""
    e = views.table(spark, sf_dir, "events")
    k, i, none = F.col("event_id") % 6, F.col("event_id").cast("string"), F.lit(None).cast("string")
    title = F.concat_ws(" ", "event_type", i)
    spec = F.element_at(F.create_map(*[F.lit(x) for n, m in (
        (1, {"items_path": "d.rows.-1", "url_template": "https://x.org/{id}/{kind}", "title": ["none", "t"]}), (2, {"items_path": "rows", "url": ["u.0", "u.1"], "title": "t"}),
        (3, {"format": "records", "points_path": "rows", "label": "kind", "point_url_template": "https://x.org/{code}/{period}"}),
    ) for x in (n, json.dumps(m | {"status_path": "status", "status_ok": ["OK"], "status_message_path": "why"}))]), k.cast("int"))
    head = F.when(F.col("event_id") % 11 == 0, F.lit('"status":"WAIT","why":"quota"')).otherwise('"status":"OK"')
    rss = F.when(F.col("event_id") % 11 == 0, F.lit("<html></html>")).otherwise(F.concat(F.lit("<rss><item><link>https://x.org/"), i, F.lit("</link><title>"), title, F.lit("</title></item></rss>")))
    lists = F.concat(F.lit("{"), head, F.lit(',"d":{"rows":[[],['), F.to_json(F.struct(i.alias("id"), title.alias("t"), F.col("event_type").alias("kind"))), F.lit("]]}}"))
    flat = F.concat(F.lit("{"), head, F.lit(',"rows":['), F.to_json(F.struct(F.array(F.lit(""), F.concat(F.lit("https://x.org/"), i)).alias("u"), title.alias("t"))), F.lit("]}"))
    points = F.concat(F.lit("{"), head, F.lit(',"rows":['), F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd").alias("date"), "value", F.col("event_type").alias("kind"))), F.lit("]}"))
    whole = F.when(k == 0, rss).when(k == 1, lists).when(k == 2, flat).otherwise(points)
    kinds = F.array(*map(F.lit, ("rss", "json_api", "json_api", "json_series", "gopher", "json_api")))
    rows = e.select(F.concat(F.lit("src_"), i).alias("source_id"), F.get(kinds, k.cast("int")).alias("kind"), spec.alias("spec"), F.when(k == 3, F.lit('{"code":"a"}')).otherwise(none).alias("part"), F.when(F.col("event_id") % 7 == 0, F.when(k == 0, "<rss></rss>").otherwise("plain")).otherwise(whole).alias("payload"), T.at(views.AS_OF).alias("observed_at"))
    raw, failed = collect.documents(rows)
    first = F.get("quantities", F.lit(0))
    return raw.select("source_id", F.coalesce(F.concat_ws(" ", F.nullif(first["label"], F.lit("")), first["period"]), F.lit("")).alias("q"), "title").select("source_id", F.when(F.col("q") != "", F.col("q")).otherwise(F.col("title")).alias("outcome")).unionByName(failed.select("source_id", F.col("error").alias("outcome")))


@query("""with e as (select *, 'evt_20240101_' || lpad(event_id::varchar, 10, '0') as key, event_id % 13 as f from events)
select key, 'schema_' || r as rule, d as detail from e, lateral (
  select 'pattern' as r, '$.event_id x' || event_id as d where f = 1 union all select 'required', '$ category' where f = 2 union all select 'minItems', '$.sources 0' where f = 3
  union all select 'enum', '$.sources[1].reliability E' where f = 4 union all select 'type', '$.title integer' where f = 5 union all select 'additionalProperties', '$.sources[0].note note' where f = 6
  union all select 'minItems', '$.claims[1].basis 0' where f = 7 union all select 'pattern', '$.observed_at ' || strftime(ts, '%Y-%m-%d') where f = 8 union all select 'type', '$.claims[0].statement null' where f = 9
  union all select 'minLength', '$.quantities[0].label ' where f = 10 union all select 'type', '$.quantities[0].value string' where f = 10 union all select 'type', '$ array' where f = 11) as v""")
def schema_violations(spark, sf_dir):
    """Each event as a document; of every thirteen, eleven have a fault of their own, some deep inside."""
    f, i = F.col("event_id") % 13, F.col("event_id").cast("string")
    key = F.concat(F.lit("evt_20240101_"), F.lpad(i, 10, "0"))
    text = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    known = '"source_id":"src_a","raw_id":"raw_0123456789abcdef"'
    one = F.when(f == 6, F.lit("{%s,\"note\":1}" % known)).otherwise(F.lit("{%s}" % known))
    sources = F.when(f == 3, F.lit("[]")).otherwise(F.concat(F.lit("["), one, F.lit(",{%s,\"reliability\":" % known), F.when(f == 4, F.lit('"E"')).otherwise(F.lit('"B"')), F.lit("}]")))
    claims = F.concat(F.lit('[{"claim_id":"c1","type":"observed","statement":'), F.when(f == 9, F.lit("null")).otherwise(F.lit('"s"')), F.lit('},{"claim_id":"c2","type":"inferred","statement":"s","basis":['), F.when(f == 7, F.lit("")).otherwise(F.lit('"c1"')), F.lit("]}]"))
    figure = F.when(f == 10, F.lit('{"label":"","unit":"t","period":"2026","value":"1"}')).otherwise(F.lit('{"label":"l","unit":"t","period":"2026","value":1.5}'))
    parts = (
        ("event_id", text(F.when(f == 1, F.concat(F.lit("x"), i)).otherwise(key))), ("category", F.when(f != 2, text(F.lit("macro")))), ("sources", sources), ("title", F.when(f == 5, i).otherwise(text(F.col("event_type")))), ("claims", claims),
        ("observed_at", text(F.when(f == 8, F.date_format("ts", "yyyy-MM-dd")).otherwise(T.fmt(F.col("ts"))))), ("event_at", text(T.fmt(F.col("ts")))), ("quantities", F.concat(F.lit("["), figure, F.lit("]"))),
        ("raw_id", text(F.lit("raw_0123456789abcdef"))), ("cluster_id", text(F.lit("clu_0123456789"))), ("is_cluster_primary", F.lit("true")), ("max_reliability", text(F.lit("A"))),
    )
    whole = F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{n}":'), c) for n, c in parts]), F.lit("}"))
    docs = views.table(spark, sf_dir, "events").select(key.alias("k"), F.when(f == 11, F.lit("[]")).otherwise(whole).alias("doc"))
    return schemas.check(docs, "k", "doc", "event")


@query("""with e as (select event_id as i from events), known as (select event_id as i from events where event_id % 5 <> 0),
c as (select i, '$.claims[0].basis[0]' as path, i as cites from e union all select i, '$.claims[0].basis[1]', i + 1 from e union all select i, '$.claims[0].deep.x[0].event_id', i + 2 from e
  union all select i, '$.other.event_ids[0]', i + 3 from e union all select i, '$.other.event_ids[1].event_id', i + 4 from e union all select i, '$.a.a.a.a.a.a[0].event_id', i from e where i % 3 = 0)
select i::varchar as key, 'not_in_evidence' as rule, path || ' evt_' || cites as detail from c where cites not in (select i from known)""")
def nested_references(spark, sf_dir):
    """Each event as an answer that cites others at several depths; four fifths of the events are in evidence."""
    e = views.table(spark, sf_dir, "events")
    i = F.col("event_id")
    cite = lambda n: F.concat(F.lit('"evt_'), (i + n).cast("string"), F.lit('"'))
    parts = (
        '{"claims":[{"basis":[', cite(0), ",", cite(1), ',7],"deep":{"x":[{"event_id":', cite(2), '}],"basis":{"note":"evt_none"}}}],"other":{"event_ids":[', cite(3), ',{"event_id":', cite(4), '},["evt_deeper"]],"title":"evt_title"}',
        F.when(i % 3 == 0, F.concat(F.lit(',"a":{"a":{"a":{"a":{"a":{"a":[{"event_id":'), cite(0), F.lit("}]}}}}}}"))).otherwise(F.lit("}")),
    )
    answers = e.select("event_id", F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]).alias("answer"))
    bundle = e.filter("event_id % 5 <> 0").select(F.concat(F.lit("evt_"), "event_id").alias("event_id"))
    return analysis.review_answers(answers.withColumnRenamed("event_id", "answer_id"), "answer_id", "answer", bundle)


@query("""with p as (select user_id, ts::date as day, count(*) as n from events group by all),
r as (select 'src_' || user_id as source_id, day, case when (user_id + day(day)) % 13 = 0 then 'HTTP 500' end as error, case when (user_id + day(day)) % 13 = 0 or day(day) % 6 = 0 then 0 else n end as n from p),
f as (select *, max((error is not null)::int) over (partition by source_id order by day) as bad from r)
select source_id, strftime(min(day), '%Y-%m-%d') as from_day, strftime(max(day), '%Y-%m-%d') as to_day, sum(n)::bigint as n from f where bad = 0 group by 1""")
def backfill_outcome(spark, sf_dir):
    """Each user's days as answers to a backfill, some failed, some empty: what of each source counts as taken in."""
    e = views.table(spark, sf_dir, "events").select(F.concat(F.lit("src_"), "user_id").alias("source_id"), F.to_date("ts").alias("day"), "event_id", "user_id")
    item = F.concat(F.lit("<item><title>t</title><link>https://x.org/"), F.col("event_id").cast("string"), F.lit("</link></item>"))
    failed, empty = (F.col("user_id") + F.day("day")) % 13 == 0, F.day("day") % 6 == 0
    pieces = e.groupBy("source_id", "user_id", "day").agg(F.concat(F.lit("<rss>"), F.when(~empty, F.array_join(F.collect_list(item), "")).otherwise(""), F.lit("</rss>")).alias("rss"))
    part = F.to_json(F.struct(F.col("day").cast("string").alias("start"), F.col("day").cast("string").alias("end")))
    payloads = pieces.select("source_id", F.lit("rss").alias("kind"), F.lit(None).cast("string").alias("spec"), part.alias("part"), F.when(~failed, F.col("rss")).alias("payload"), F.when(failed, "HTTP 500").alias("error"), T.at(views.AS_OF).alias("observed_at"))
    found, _ = collect.entries(payloads)
    results = backfill.outcome(payloads, payloads, found)
    return backfill.covered(results).select("source_id", F.date_format("from_day", "yyyy-MM-dd").alias("from_day"), F.date_format("to_day", "yyyy-MM-dd").alias("to_day"), "n")


@query("select 'https://x.org/' || event_id as url, event_type || ' & ' || event_id as title, 'told ' || event_id as body, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as published_at from events")
def feed_entries(spark, sf_dir):
    """Each event as a feed of its own: RSS for even ids, Atom under a prefix for odd ones."""
    e = views.table(spark, sf_dir, "events")
    item = "<rss><channel><title>c</title><item><title>%2$s &amp;amp; %1$s</title><link>https://www.x.org/%1$s/?utm_source=q#f</link><description><![CDATA[<p>told</p> %1$s]]></description><pubDate>%3$s +0000</pubDate></item><item><title>no link</title></item></channel><entry><title>not read</title><link href='https://x.org/no'/></entry></rss>"
    atom = "<a:feed xmlns:a='http://www.w3.org/2005/Atom'><a:entry><a:title>%2$s &amp;amp; %1$s</a:title><a:link rel='self' href='https://x.org/self'/><a:link href='https://x.org/%1$s'/><a:summary>told %1$s</a:summary><a:published>%3$s</a:published></a:entry></a:feed>"
    made = lambda pattern, form: F.format_string(pattern, F.col("event_id").cast("string"), "event_type", F.date_format("ts", form))
    payload = F.when(F.col("event_id") % 2 == 0, made(item, "EEE, dd MMM yyyy HH:mm:ss")).otherwise(made(atom, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    found = feeds.feed_entries(e.select(F.lit("src_a").alias("source_id"), payload.alias("payload"), T.at(views.AS_OF).alias("observed_at")))
    return found.select(X.canonical_url(F.col("link")).alias("url"), "title", F.regexp_replace("body", r"\s+", " ").alias("body"), T.fmt(F.col("published_at")).alias("published_at"))


@query("select event_id, event_type as title, 'https://x.org/' || event_id as link from events")
def json_entries(spark, sf_dir):
    e = views.table(spark, sf_dir, "events").select(F.lit("src_a").alias("source_id"), T.at(views.AS_OF).alias("observed_at"), "event_id", "event_type")
    item = F.to_json(F.struct(F.col("event_id").alias("id"), F.struct(F.col("event_type").alias("name")).alias("kind")))
    p = e.select("source_id", "observed_at", F.concat(F.lit('{"data":{"rows":['), item, F.lit("]}}")).alias("payload"), "event_id")
    found = feeds.json_entries(p.drop("event_id"), {"items_path": "data.rows", "url_template": "https://x.org/{id}", "title": ["missing", "kind.name"]})
    return found.select(F.substring_index("link", "/", -1).cast("long").alias("event_id"), "title", "link")


# time


@query("""select o_orderkey, case o_orderkey % 4 when 3 then null else strftime(case o_orderkey % 4 when 2 then o_orderdate::date + interval 3 hour else o_orderdate::date::timestamp end, '%Y-%m-%dT%H:%M:%SZ') end as published, case o_orderkey % 4 when 3 then 'x' else strftime(o_orderdate, '%Y-%m-%d') end as period from orders""")
def published_parse(spark, sf_dir):
    o = views.table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"), (F.col("o_orderkey") % 4).alias("m"))
    text = F.when(F.col("m") == 0, F.col("d")).when(F.col("m") == 1, F.concat("d", F.lit(" 23:57:56"))).when(F.col("m") == 2, F.concat("d", F.lit("T12:00:00+09:00"))).otherwise("x")
    stamp = F.when(F.col("m") == 3, "x").otherwise(F.concat("d", F.lit("T00:00:00")))
    return o.select("o_orderkey", T.fmt(T.published(text)).alias("published"), T.period(stamp).alias("period"))


@query("select strftime(d, '%Y-%m-%d') as \"end\", strftime(d - 6, '%Y-%m-%d') as start, strftime(d - 34, '%Y-%m-%d') as baseline_start, strftime(d - 7, '%Y-%m-%d') as baseline_end, 0.25::double as scale from (select distinct ts::date as d from events)")
def window_bounds(spark, sf_dir):
    days = views.table(spark, sf_dir, "events").select(F.to_date("ts").alias("d")).distinct()
    w = T.Window.ending(T.instant(views.AS_OF).date())
    text = lambda n: F.date_format(F.date_sub("d", n), "yyyy-MM-dd")
    return days.select(text(0).alias("end"), text((w.end - w.start).days).alias("start"), text((w.end - w.baseline_start).days).alias("baseline_start"), text((w.end - w.baseline_end).days).alias("baseline_end"), F.lit(w.scale).alias("scale"))


@query("""select source_id, strftime(s, '%Y-%m-%d') as start, strftime(least(s + n - 1, date '2026-08-14'), '%Y-%m-%d') as "end" from (select 'src_' || n_nationkey as source_id, (n_nationkey % 5 + 1) as n, unnest(generate_series(0, 34 // (n_nationkey % 5 + 1)))::int as i from nation), lateral (select date '2026-07-11' + i * n as s)""")
def chunk_spans(spark, sf_dir):
    s = views.table(spark, sf_dir, "nation").select(F.concat(F.lit("src_"), "n_nationkey").alias("source_id"), (F.col("n_nationkey") % 5 + 1).cast("int").alias("chunk_days"))
    return backfill.plan(spark, s, 35, "2026-08-14T12:00:00Z").select("source_id", F.date_format("start", "yyyy-MM-dd").alias("start"), F.date_format("end", "yyyy-MM-dd").alias("end"))


@query("""with p as (select user_id, ts::date as start, count(*) as n, bool_or(event_type = 'error' and user_id % 3 = 0) as bad from events group by 1, 2), w as (select *, max(bad::int) over (partition by user_id order by start) as failed from p)
select 'src_' || user_id as source_id, strftime(min(start), '%Y-%m-%d') as from_day, strftime(max(start), '%Y-%m-%d') as to_day, sum(n)::bigint as n from w where failed = 0 group by user_id""")
def covered_prefix(spark, sf_dir):
    e = views.table(spark, sf_dir, "events").withColumn("start", F.to_date("ts"))
    p = e.groupBy(F.concat(F.lit("src_"), "user_id").alias("source_id"), "start").agg(F.count("*").alias("n"), F.max(F.when((F.col("event_type") == "error") & (F.col("user_id") % 3 == 0), "failed")).alias("error")).withColumn("end", F.col("start"))
    return backfill.covered(p).select("source_id", F.date_format("from_day", "yyyy-MM-dd").alias("from_day"), F.date_format("to_day", "yyyy-MM-dd").alias("to_day"), "n")


@query("""with s as (select c_custkey as k, date '2024-01-01' + (c_custkey % 20)::int as f, date '2024-01-10' + (c_custkey % 20)::int as t, date '2024-01-15' + (c_custkey % 31)::int as nf, date '2024-01-20' + (c_custkey % 31)::int as nt from customer)
select 'src_' || k as source_id, strftime(case when nf <= t + 1 and f <= nt + 1 then least(f, nf) else nf end, '%Y-%m-%d') as from_day, strftime(case when nf <= t + 1 and f <= nt + 1 then greatest(t, nt) else nt end, '%Y-%m-%d') as to_day from s""")
def backfill_span_merge(spark, sf_dir):
    c = views.table(spark, sf_dir, "customer").select(F.concat(F.lit("src_"), "c_custkey").alias("source_id"), F.col("c_custkey").alias("k"))
    day = lambda base, m: F.date_add(F.lit(base).cast("date"), (F.col("k") % m).cast("int"))
    old = c.select("source_id", day("2024-01-01", 20).alias("from_day"), day("2024-01-10", 20).alias("to_day"))
    new = c.select("source_id", day("2024-01-15", 31).alias("from_day"), day("2024-01-20", 31).alias("to_day"))
    return backfill.merge_spans(old, new).select("source_id", F.date_format("from_day", "yyyy-MM-dd").alias("from_day"), F.date_format("to_day", "yyyy-MM-dd").alias("to_day"))


@query("select o_orderkey, o_orderkey % 7 = 0 or m < 1440 or date '2001-08-02' - o_orderdate::date >= m // 1440 as due from (select *, [60, 1440, 10080, 43200][(o_orderkey % 4) + 1] as m from orders)")
def poll_due(spark, sf_dir):
    o = views.table(spark, sf_dir, "orders")
    minutes = F.get(F.array(*map(F.lit, (60, 1440, 10080, 43200))), (F.col("o_orderkey") % 4).cast("int"))
    return o.select("o_orderkey", T.due(minutes, F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate").cast("timestamp")), "2001-08-02T06:00:00Z").alias("due"))


# predictions


@query(PRD + "select prediction_id, verdict, round_even(actual - v, 6) as error_absolute, case when v <> 0 then round_even((actual - v) / v, 6) end as error_relative from jud")
def judge_predictions(spark, sf_dir):
    p = views.predictions(spark, sf_dir).join(views.actuals(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return backtest.judge(p).select("prediction_id", "verdict", "error_absolute", "error_relative")


@query(PRD + """, j as (select p.sector, r.verdict from prd p left join (select * from res where evaluated_at <= timestamp '1998-01-01') r using (prediction_id) where issued_at <= timestamp '1998-01-01')
select sector as sector_id, count(*) as total, count(*) filter (where verdict = 'hit') as hit, count(*) filter (where verdict = 'miss') as miss, count(*) filter (where verdict = 'partial') as partial, count(*) filter (where verdict = 'unresolvable') as unresolvable, count(*) filter (where verdict is null) as pending,
  count(*) filter (where verdict in ('hit', 'miss', 'partial')) as resolved, case when count(*) filter (where verdict in ('hit', 'miss')) > 0 then round_even(count(*) filter (where verdict = 'hit') / count(*) filter (where verdict in ('hit', 'miss')), 3) end as hit_rate from j group by 1""")
def accuracy_pivot(spark, sf_dir):
    return backtest.accuracy(views.predictions(spark, sf_dir), views.results(spark, sf_dir), "1998-01-01T00:00:00Z", ("sector_id",))


@query(PRD + "select cause as cause_category, count(*) as n from res where verdict = 'miss' and evaluated_at <= timestamp '1998-01-01' group by 1")
def cause_breakdown(spark, sf_dir):
    return backtest.causes(views.predictions(spark, sf_dir), views.results(spark, sf_dir), "1998-01-01T00:00:00Z")


@query(PRD + "select prediction_id, strftime(due_date, '%Y-%m-%d') as due_date from prd where issued_at <= timestamp '1998-01-01' and due_date <= date '1998-01-01' and prediction_id not in (select prediction_id from res where evaluated_at <= timestamp '1998-01-01')")
def due_predictions(spark, sf_dir):
    return backtest.due(views.predictions(spark, sf_dir), views.results(spark, sf_dir), "1998-01-01T00:00:00Z").select("prediction_id", F.date_format("due_date", "yyyy-MM-dd").alias("due_date"))


@query(EV + ", c as (select id as prediction_id, timestamp '2024-01-15' + to_hours((id % 200)::int) as issued_at, 'evt_' || (id + 1) as event_id from ev) select prediction_id, c.event_id from c join ev e on c.event_id = e.event_id and e.observed_at <= c.issued_at")
def missed_signals(spark, sf_dir):
    e = views.events(spark, sf_dir)
    issued = F.timestamp_seconds(F.lit("2024-01-15").cast("timestamp").cast("long") + F.col("id") % 200 * 3600)
    claimed = e.select(F.col("id").alias("prediction_id"), issued.alias("issued_at"), F.concat(F.lit("evt_"), (F.col("id") + 1).cast("string")).alias("event_id"))
    return backtest.missed_signals(claimed, e).select("prediction_id", "event_id")


# rules


@query(EV + """select event_id as "key", 'inferred_without_basis' as rule, event_id || '#c1' as detail from ev where id % 3 = 0 and id % 2 = 0 union all select event_id, 'no_source', '' from ev where id % 13 = 0
union all select event_id, 'observed_after_as_of', strftime(observed_at, '%Y-%m-%dT%H:%M:%SZ') from ev where observed_at > timestamp '2024-01-30 23:59:59'""")
def rule_event(spark, sf_dir):
    e = views.events(spark, sf_dir)
    claim = F.struct(F.concat("event_id", F.lit("#c1")).alias("claim_id"), F.when(F.col("id") % 3 == 0, "inferred").otherwise("observed").alias("type"), F.when(F.col("id") % 2 == 1, F.array(F.lit("b"))).otherwise(F.array().cast("array<string>")).alias("basis"))
    return rules.events(e.withColumns({"claims": F.array(claim), "sources": F.when(F.col("id") % 13 != 0, F.col("sources"))}), views.AS_OF)


@query(f"select window_id as \"key\", 'fires_without_coverage' as rule, '' as detail from ({_windows_sql('2024-01-26', '2024-01-06', '2024-01-25')}) where not baseline_covered and distinct_sources > 3 union all select window_id, 'promoted_without_firing', '' from ({_windows_sql('2024-01-26', '2024-01-06', '2024-01-25')}) where distinct_sources <= 3")
def rule_signal(spark, sf_dir):
    w = signals.windows(views.primary_events(spark, sf_dir), views.TOPICS, views.WINDOW, views.AS_OF)
    return rules.windows(w.withColumns({"threshold_met": F.col("distinct_sources") > 3, "promoted": F.lit(True)}))


@query(PRD + "select prediction_id as \"key\", 'no_falsifier' as rule, '' as detail from prd where falsifier is null union all select prediction_id, 'no_due_date', '' from prd where o_orderkey % 17 = 0 union all select prediction_id, 'no_metric', '' from prd where o_orderkey % 19 = 0")
def rule_prediction(spark, sf_dir):
    p = views.predictions(spark, sf_dir).withColumns({"due_date": F.when(F.col("o_orderkey") % 17 != 0, F.col("due_date")), "metric": F.when(F.col("o_orderkey") % 19 != 0, F.col("metric")).otherwise(" ")})
    return rules.predictions(p)


@query("""with g as (select o_orderkey, o_orderkey // 16 as q from orders), s as (select q - (q % 9 = 1)::int as r, row_number() over (partition by q - (q % 9 = 1)::int order by o_orderkey) as no from g),
k as (select r, case when r % 11 = 5 and no = 16 then 17 else no end as no, r % 4 = 1 and no = 3 as blank from s)
select 'rpt_' || r as "key", 'section_count' as rule, count(*)::varchar as detail from k group by r having count(*) <> 16
union all select 'rpt_' || r, 'section_numbers', string_agg(no::varchar, ',' order by no) from k group by r having list(no order by no) <> range(1, 17)
union all select 'rpt_' || r, 'empty_sections', count(*)::varchar from k where blank group by r union all select distinct 'rpt_' || r, 'ranks', '' from k where r % 7 = 0""")
def rule_report(spark, sf_dir):
    """A report is made of 16 consecutive orders; every ninth takes the next one's too, every eleventh skips a number."""
    o = views.table(spark, sf_dir, "orders").withColumn("q", F.floor(F.col("o_orderkey") / 16))
    s = o.withColumn("r", F.col("q") - (F.col("q") % 9 == 1).cast("int"))
    s = s.withColumn("nth", F.row_number().over(Window.partitionBy("r").orderBy("o_orderkey"))).withColumn("no", F.when((F.col("r") % 11 == 5) & (F.col("nth") == 16), 17).otherwise(F.col("nth")))
    s = s.select(F.concat(F.lit("rpt_"), "r").alias("report_id"), "no", F.col("nth").cast("string").alias("section"), F.when((F.col("r") % 4 == 1) & (F.col("nth") == 3), " ").otherwise("x").alias("body"), F.lit(False).alias("contains_ticker_recommendation"), (F.col("r") % 7 == 0).alias("contains_ranking"))
    return rules.reports(s)


@query("""with p as (select n_regionkey as k, year(o_orderdate) as y, case o_orderkey % 3 when 0 then 'bear' when 1 then 'base' else 'bull' end as s, max(o_totalprice) as a from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2, 3),
w as (select k, y, max(a) filter (where s = 'bear') as bear, max(a) filter (where s = 'base') as base, max(a) filter (where s = 'bull') as bull from p group by 1, 2)
select k::varchar as "key", 'bear_above_base' as rule, y::varchar as detail from w where bear > base union all select k::varchar, 'base_above_bull', y::varchar from w where base > bull""")
def rule_market_order(spark, sf_dir):
    o, c, n = (views.table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    rows = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    scenario = F.get(F.array(*map(F.lit, fixed.SCENARIOS)), (F.col("o_orderkey") % 3).cast("int"))
    return rules.scenario_order(rows.select("n_regionkey", F.year("o_orderdate").alias("year"), scenario.alias("scenario"), F.col("o_totalprice").alias("amount")), "n_regionkey")


@query("""with t as (select l_orderkey, l_linenumber, max(case l_returnflag when 'A' then 2 when 'N' then 1 else 0 end) as r from lineitem group by 1, 2)
select a.l_orderkey::varchar as "key", 'surer_than_the_wave_before' as rule, a.l_linenumber::varchar as detail from t a join t b on a.l_orderkey = b.l_orderkey and a.l_linenumber = b.l_linenumber + 1 where a.r > b.r""")
def rule_wave_order(spark, sf_dir):
    rank = F.when(F.col("l_returnflag") == "A", 2).when(F.col("l_returnflag") == "N", 1).otherwise(0)
    return rules.wave_order(views.table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("wave"), rank.alias("rank")), "l_orderkey")


@query("""select l_orderkey::varchar as "key", 'inferred_without_evidence' as rule, 'wave ' || l_linenumber as detail from lineitem where l_partkey % 4 = 0 and l_returnflag = 'R' union all select l_orderkey::varchar, 'inferred_without_falsifier', 'wave ' || l_linenumber from lineitem where l_partkey % 4 = 0 and l_linestatus = 'F'
union all select l_orderkey::varchar, 'no_mechanism', 'wave ' || l_linenumber from lineitem where l_suppkey % 9 = 0""")
def rule_wave_links(spark, sf_dir):
    li = views.table(spark, sf_dir, "lineitem")
    links = li.select(
        F.col("l_orderkey").alias("chain_id"), F.col("l_linenumber").alias("wave"), F.when(F.col("l_suppkey") % 9 != 0, "m").alias("mechanism"), F.when(F.col("l_partkey") % 4 == 0, "inferred").otherwise("observed").alias("claim_type"),
        F.lit("low").alias("causal_confidence"), F.when(F.col("l_linestatus") != "F", "f").alias("falsifier"), F.when(F.col("l_returnflag") != "R", F.array(F.lit("e"))).alias("evidence"),
    )
    return rules.waves(links)


@query("""select (s_suppkey % 3)::varchar as "key", side as rule, id::varchar as detail from (select s_suppkey, 'unknown_from' as side, s_suppkey as id from supplier where s_suppkey % 10 = 0 union all select s_suppkey, 'unknown_to', 100000 + s_nationkey from supplier where s_nationkey = 7)""")
def rule_edges(spark, sf_dir):
    s = views.table(spark, sf_dir, "supplier")
    key = (F.col("s_suppkey") % 3).alias("map_id")
    edges = s.select(key, F.col("s_suppkey").alias("source"), (F.lit(100000) + F.col("s_nationkey")).cast("long").alias("target"))
    nodes = s.filter("s_suppkey % 10 <> 0").select(key, F.col("s_suppkey").alias("node_id")).unionByName(s.filter("s_nationkey <> 7").select(key, (F.lit(100000) + F.col("s_nationkey")).cast("long").alias("node_id")))
    return rules.edges(edges, nodes)


@query("""select 'm/' || p_partkey as "key", 'no_trigger' as rule, '' as detail from part where p_size > 40 and p_partkey % 3 = 0 union all select 'm/' || p_partkey, 'no_monetizer', '' from part where p_size > 40 and p_partkey % 5 = 0""")
def rule_bottlenecks(spark, sf_dir):
    p = views.table(spark, sf_dir, "part")
    nodes = p.select(F.lit("m").alias("map_id"), F.col("p_partkey").cast("string").alias("node_id"), (F.col("p_size") > 40).alias("is_bottleneck"), F.when(F.col("p_partkey") % 3 != 0, "t").alias("trigger_condition"), F.when(F.col("p_partkey") % 5 != 0, "m").alias("monetizer_type"))
    return rules.bottlenecks(nodes)


@query("""select s_suppkey, case when s_suppkey % 4 <> 0 then 'n' || s_suppkey else 'nd_' || trim(regexp_replace(lower(s_name), '[^a-z0-9]+', '_', 'g'), '_') end as source, 'nd_' || trim(regexp_replace(lower(n_name), '[^a-z0-9]+', '_', 'g'), '_') as target from supplier join nation on s_nationkey = n_nationkey""")
def edge_name_resolution(spark, sf_dir):
    s, n = views.table(spark, sf_dir, "supplier"), views.table(spark, sf_dir, "nation")
    edges = s.join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey")).select(F.lit("m").alias("map_id"), "s_suppkey", F.col("s_name").alias("source_name"), F.col("n_name").alias("target_name"))
    nodes = s.filter("s_suppkey % 4 <> 0").select(F.lit("m").alias("map_id"), F.col("s_name").alias("name"), F.concat(F.lit("n"), "s_suppkey").alias("node_id"))
    return graphs.resolve_names(edges, nodes).select("s_suppkey", "source", "target")


@query("select p_brand as node_id, count(distinct p_type) as n from part group by 1 having count(distinct p_type) > 1")
def slug_collisions(spark, sf_dir):
    p = views.table(spark, sf_dir, "part").select(F.lit("m").alias("map_id"), F.col("p_brand").alias("node_id"), F.col("p_type").alias("name"))
    return graphs.slug_collisions(p).select("node_id", "n")
