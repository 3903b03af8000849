"""The daily report: sixteen sections made from aggregates of the day's events, the windows, maps, chains, profiles and predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import time as T
from tidemark.operators import backtest, evidence, graphs
from tidemark.sources import shared

NONE = "本日該当なし"


def today(events: DataFrame, day: str) -> DataFrame:
    return events.filter(F.to_date("observed_at") == F.lit(day).cast("date"))


def coverage(events: DataFrame, as_of: str, day: str, sources: int) -> DataFrame:
    """events_ingested, events_after_dedup, sources_polled of the day, as known at as_of."""
    rows = today(events.filter(T.visible(F.col("observed_at"), as_of)), day)
    return rows.agg(F.count("*").alias("events_ingested"), F.count_if(F.coalesce("is_cluster_primary", F.lit(True))).alias("events_after_dedup")).withColumn("sources_polled", F.lit(sources))


def counts(events: DataFrame, column: str) -> DataFrame:
    """value, n of a column (arrays exploded), most frequent first, then first seen."""
    value = F.explode(column) if events.schema[column].dataType.typeName() == "array" else F.col(column)
    rows = events.select("observed_at", "event_id", value.alias("value"))
    return rows.groupBy("value").agg(F.count("*").alias("n"), F.min(F.struct("observed_at", "event_id")).alias("_first")).orderBy(F.col("n").desc(), "_first").drop("_first")


def section_rows(events: DataFrame, most: int = fixed.REPORT_ITEMS) -> DataFrame:
    """category, position and line of each category's reports, reliability letters and times both descending."""
    w = Window.partitionBy("category").orderBy(F.coalesce("max_reliability", F.lit("D")).desc(), F.col("event_at").desc(), "observed_at", "event_id")
    rows = events.filter(~evidence.is_statistic() & F.col("category").isin(*fixed.SECTION_OF)).withColumn("position", F.row_number().over(w)).filter(F.col("position") <= most)
    line = F.concat(F.lit("["), F.coalesce("max_reliability", F.lit("?")), F.lit("] "), F.date_format("event_at", "yyyy-MM-dd"), F.lit(" "), "title", F.lit(" ("), "event_id", F.lit(")"))
    return rows.select("category", "position", line.alias("line"))


def sector_counts(events: DataFrame, sectors: DataFrame) -> DataFrame:
    """position, sector_id, name, n of each sector in the order of sectors (position, sector_id, name); zero is a count."""
    linked = events.select("event_id", F.explode(F.array_distinct(F.transform("sector_links", lambda s: s["sector_id"]))).alias("sector_id")).groupBy("sector_id").agg(F.count("*").alias("_n"))
    return F.broadcast(sectors).join(linked, "sector_id", "left").select("position", "sector_id", "name", F.coalesce("_n", F.lit(0).cast("long")).alias("n")).orderBy("position")


def window_totals(windows: DataFrame) -> DataFrame:
    """Windows that fire; those held, by the report's rule (all uncovered) and by the console's (uncovered with something rising)."""
    held = ~F.col("baseline_covered")
    return windows.agg(F.count("*").alias("windows"), F.count_if("threshold_met").alias("fired"), F.count_if(held).alias("held"), F.count_if(held & (F.col("distinct_signal_types") >= 1)).alias("held_rising"))


def _bullets(lines: list[str], most: int = fixed.REPORT_ITEMS) -> str:
    return "".join(f"\n- {x}" for x in lines[:most])


def build(events: DataFrame, windows: DataFrame, as_of: str, day: str, sources: int = 0, extra: Mapping[str, DataFrame] | None = None, watched: Sequence[tuple[str, str, tuple[str, ...]]] = fixed.SECTORS) -> dict:
    """The report as a document. What comes to the driver is aggregates and at most eight rows a section.

    extra: nodes, edges, links, profiles, predictions and results, each optional. watched: the sectors that are monitored.
    """
    extra = dict(extra or {})
    spark = events.sparkSession
    for name, time in (("profiles", "as_of"), ("nodes", "as_of"), ("links", "as_of")):
        if name in extra and time in extra[name].columns:
            extra[name] = extra[name].filter(F.col(time) <= T.at(as_of))
    # a day's events and a row a topic: read once, then told from
    rows = shared.kept(today(events.filter(T.visible(F.col("observed_at"), as_of) & F.coalesce("is_cluster_primary", F.lit(True))), day), "report-day")
    windows = shared.kept(windows, "report-windows")
    by_category = {r.value: r.n for r in counts(rows, "category").collect()}
    by_type = [(r.value, r.n) for r in counts(rows, "signal_types").collect()]
    lines: dict[str, list[str]] = {}
    for r in section_rows(rows).orderBy("category", "position").collect():
        lines.setdefault(r.category, []).append(r.line)
    totals = window_totals(windows).first()
    bodies: dict[int, str] = {}
    kv = lambda pairs: " / ".join(f"{k} {n}" for k, n in pairs)
    bodies[1] = f"{NONE}（観測イベントなし）" if not by_category else f"本日の観測は {sum(by_category.values())} 件。内訳（分類別）: {kv(by_category.items())}。シグナル種別: {kv(by_type) or 'なし'}。しきい値を満たした topic: {totals.fired} 件（判定保留: {totals.held} 件）。"
    for category, no in fixed.SECTION_OF.items():
        if not by_category.get(category):
            bodies[no] = f"{NONE}（本日の新規観測なし）"
            continue
        figures = evidence.latest_points(rows.filter((F.col("category") == category) & evidence.is_statistic())).collect()
        shown = [f"統計 {r.label} = {r.value:,} {r.unit}（{r.period or '期間不明'}, 本日 {r.n} 期ぶんを観測）" for r in figures]
        bodies[no] = f"本日 {by_category[category]} 件を観測。" + _bullets(shown + lines.get(category, []), fixed.REPORT_ITEMS + len(shown))
    fired = windows.filter("threshold_met").orderBy("window_id").limit(fixed.REPORT_ITEMS).collect()
    if not totals.windows:
        bodies[7] = f"{NONE}（シグナル集計が未実行）"
    elif fired:
        bodies[7] = f"同時増加のしきい値を満たした topic が {totals.fired} 件。" + _bullets([f"{r.label}: 増加した種別 {r.distinct_signal_types} / ソース {r.distinct_sources}" for r in fired])
    else:
        bodies[7] = f"しきい値を満たした topic はなし。うち {totals.held} 件は判定を保留している。"
    sectors = spark.createDataFrame([(i, s, n) for i, (s, n, _) in enumerate(watched)], "position int, sector_id string, name string")
    bodies[8] = f"常時監視 {len(watched)} セクターの本日の観測件数。" + _bullets([f"{r.name} ({r.sector_id}): 本日 {r.n} 件" for r in sector_counts(rows, sectors).collect()])
    new = windows.filter("threshold_met and is_new_concept")
    n = new.count()
    bodies[9] = f"{n} 件の新概念候補を検出。" + _bullets([r.label for r in new.orderBy("window_id").limit(fixed.REPORT_ITEMS).collect()]) if n else f"{NONE}（既知セクターに属さない同時増加は検出されていない）"
    bodies[11] = bodies[12] = f"{NONE}（サプライチェーン分析がまだ作成されていない）"
    if "nodes" in extra:
        found = graphs.bottleneck_nodes(extra["nodes"])
        n = found.count()
        if n:
            bodies[11] = f"{n} 件のボトルネックを特定済み。" + _bullets([f"{r.map_id} / {r['name']}: {r.trigger_condition}（回収主体の類型: {r.monetizer_type}）" for r in found.orderBy("map_id", "node_id").limit(fixed.REPORT_ITEMS).collect()])
        if "edges" in extra:
            sizes = graphs.map_sizes(extra["nodes"], extra["edges"])
            bodies[12] = f"{sizes.count()} セクターのサプライチェーンを分解済み。" + _bullets([f"{r.map_id}: ノード {r.nodes} / 接続 {r.edges}" for r in sizes.orderBy("map_id").limit(fixed.REPORT_ITEMS).collect()])
    bodies[13] = f"{NONE}（波及連鎖がまだ作成されていない）"
    if "links" in extra:
        n = extra["links"].select("chain_id").distinct().count()
        if n:
            shown = extra["links"].orderBy("chain_id", "position").limit(fixed.REPORT_ITEMS).collect()
            bodies[13] = f"{n} 本の連鎖を追跡中。" + _bullets([f"[波{r.wave}/{r.claim_type}/確信度 {r.causal_confidence}] {r.source} → {r.target}: {r.mechanism[:60]}" for r in shown])
    bodies[14] = bodies[15] = f"{NONE}（セクター評価がまだ作成されていない）"
    if "profiles" in extra and (n := extra["profiles"].count()):
        shown = extra["profiles"].orderBy("sector_id").limit(fixed.REPORT_ITEMS).collect()
        bodies[14] = f"{n} セクターの評価が存在する。" + _bullets([f"{r['name']}: フェーズ {r.phase} / 成長確率 {r.growth_probability} / 拡大規模 {r.growth_magnitude}" for r in shown])
        bodies[15] = f"{n} セクターの評価が存在する。" + _bullets([f"{r['name']}: {r.divergence}" for r in shown])
    bodies[16] = f"{NONE}（追跡対象の予測がまだ無い）"
    if "predictions" in extra:
        a = backtest.accuracy(extra["predictions"], extra["results"], f"{day}T23:59:59Z").first()
        if a.total:
            late = backtest.due(extra["predictions"], extra["results"], f"{day}T23:59:59Z")
            shown = [f"期限超過: {r.prediction_id} ({r.due_date})" for r in late.orderBy("prediction_id").limit(fixed.REPORT_ITEMS).collect()]
            bodies[16] = f"発行済みの予測 {a.total} 件。判定済み {a.resolved}（的中 {a.hit} / 外れ {a.miss} / 部分 {a.partial}）、判定不能 {a.unresolvable}、未判定 {a.pending}。期限を迎えた未処理の予測 {late.count()} 件。" + _bullets(shown)
    for no, key in fixed.SECTIONS:
        guard(bodies[no].split("\n", 1)[0], key)
    c = coverage(events, as_of, day, sources).first()
    return {
        "report_id": "rpt_" + day.replace("-", ""), "report_date": day, "as_of": as_of, "coverage": c.asDict(), "sections": [{"no": no, "key": key, "body": bodies[no]} for no, key in fixed.SECTIONS],
        "prohibited_output_check": {"contains_ticker_recommendation": False, "contains_ranking": False},
    }


class Prohibited(ValueError):
    """A report's own words name tickers or ranks."""


def guard(text: str, where: str) -> None:
    import re

    for p in (*fixed.TICKERS, *fixed.RANKINGS):
        if re.search(p, text):
            raise Prohibited(f"{where}: {p}")


def markdown(report: dict) -> str:
    c = report["coverage"]
    head = [f"# Report {report['report_date']}", "", f"as_of: {report['as_of']}", f"観測 {c['events_ingested']} 件 / 重複統合後 {c['events_after_dedup']} 件 / 巡回ソース {c['sources_polled']}", ""]
    return "\n".join([*head, *(f"## {s['no']}. {s['key']}\n\n{s['body']}\n" for s in report["sections"])])
