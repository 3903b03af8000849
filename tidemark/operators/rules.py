"""Rules of data quality. Each takes a table and gives (key, rule, detail), one row for each violation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import time as T


def violations(rows: DataFrame, key: str, rules: list[tuple[str, Column, Column]]) -> DataFrame:
    """Rules are (name, whether it is broken, detail); one pass over rows for all of them."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.struct(F.lit(name).alias("rule"), detail.cast("string").alias("detail"))) for name, broken, detail in rules]))
    return rows.select(F.col(key).cast("string").alias("key"), F.explode(found).alias("v")).select("key", "v.rule", "v.detail")


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def events(rows: DataFrame, as_of: str | None = None) -> DataFrame:
    """Inferred claims need a basis, events a source; nothing observed after as_of."""
    baseless = F.filter("claims", lambda c: (c["type"] == "inferred") & (F.coalesce(F.size(c["basis"]), F.lit(0)) <= 0))
    rules = [
        ("inferred_without_basis", F.size(baseless) > 0, F.array_join(F.transform(baseless, lambda c: c["claim_id"]), ",")),
        ("no_source", F.coalesce(F.size("sources"), F.lit(0)) <= 0, F.lit("")),
    ]
    if as_of:
        rules.append(("observed_after_as_of", ~T.visible(F.col("observed_at"), as_of), T.fmt(F.col("observed_at"))))
    return violations(rows, "event_id", rules)


def windows(rows: DataFrame) -> DataFrame:
    """Windows end by as_of and after their baseline; firing needs coverage, promotion needs firing, ratios need a baseline."""
    loose = F.filter("counts", lambda c: (c["baseline_count"] == 0) & c["delta_ratio"].isNotNull())
    return violations(rows, "window_id", [
        ("ends_after_as_of", F.col("window_end") > F.to_date("as_of"), F.col("window_end")),
        ("baseline_overlaps", F.col("baseline_end") >= F.col("window_start"), F.col("baseline_end")),
        ("fires_without_coverage", ~F.col("baseline_covered") & F.col("threshold_met"), F.lit("")),
        ("promoted_without_firing", F.col("promoted") & ~F.col("threshold_met"), F.lit("")),
        ("ratio_of_zero_baseline", F.size(loose) > 0, F.array_join(F.transform(loose, lambda c: c["signal_type"]), ",")),
    ])


def sectors(rows: DataFrame) -> DataFrame:
    """A profile needs all three scenarios with falsifiers, both growth figures, both views, an internal score and no evidence from after as_of."""
    kinds = F.array_sort(F.array_distinct(F.transform("scenarios", lambda s: s["scenario"])))
    bare = F.filter("scenarios", lambda s: blank(s["falsifier"]))
    return violations(rows, "sector_id", [
        ("scenarios", ~(kinds == F.array(*map(F.lit, sorted(fixed.SCENARIOS)))) | F.col("scenarios").isNull(), F.array_join(kinds, ",")),
        ("no_falsifier", F.size(bare) > 0, F.array_join(F.transform(bare, lambda s: s["scenario"]), ",")),
        ("growth", F.col("growth_probability").isNull() | F.col("growth_magnitude").isNull(), F.lit("")),
        ("score_not_internal", F.col("score").isNotNull() & ~F.coalesce("internal_only", F.lit(False)), F.col("score")),
        ("views", blank(F.col("consensus")) | blank(F.col("independent")), F.lit("")),
        ("evidence_after_as_of", F.col("newest_evidence_at") > F.col("as_of"), T.fmt(F.col("newest_evidence_at"))),
    ]).unionByName(market_sizes(rows))


def market_sizes(rows: DataFrame) -> DataFrame:
    """Sizes need evidence; in every year bear <= base <= bull, where stated."""
    unfounded = violations(rows, "sector_id", [(f"{k}_without_evidence", (F.coalesce(k, F.lit(0.0)) != 0) & (F.coalesce(F.size("market_evidence"), F.lit(0)) <= 0), F.col(k)) for k in ("tam", "sam", "som")])
    points = rows.select("sector_id", F.explode("scenarios").alias("s")).select("sector_id", "s.scenario", F.explode("s.projections").alias("p")).select("sector_id", "scenario", "p.year", "p.amount")
    return unfounded.unionByName(scenario_order(points, "sector_id"))


def scenario_order(points: DataFrame, key: str) -> DataFrame:
    """points: key, scenario, year, amount. A later point of a scenario and year replaces an earlier one; zero counts as not stated."""
    stated = points.filter("amount <> 0").groupBy(key, "year").pivot("scenario", list(fixed.SCENARIOS)).agg(F.max("amount"))
    found = violations(stated.withColumn("_key", F.col(key)), "_key", [
        ("bear_above_base", F.col("bear") > F.col("base"), F.col("year")),
        ("base_above_bull", F.col("base") > F.col("bull"), F.col("year")),
    ])
    return found


def waves(links: DataFrame) -> DataFrame:
    """links: chain_id, wave, mechanism, claim_type, causal_confidence, falsifier, evidence (array). Inferred links need evidence and falsifier, all a mechanism; no wave is surer than the one before."""
    inferred = F.col("claim_type") == "inferred"
    where = F.concat(F.lit("wave "), F.col("wave").cast("string"))
    rows = violations(links, "chain_id", [
        ("inferred_without_evidence", inferred & (F.coalesce(F.size("evidence"), F.lit(0)) <= 0), where),
        ("inferred_without_falsifier", inferred & blank(F.col("falsifier")), where),
        ("no_mechanism", blank(F.col("mechanism")), where),
    ])
    rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in fixed.CONFIDENCE_RANK.items() for x in p]), F.col("causal_confidence")), F.lit(0))
    return rows.unionByName(wave_order(links.select("chain_id", "wave", rank.alias("rank")), "chain_id"))


def wave_order(links: DataFrame, key: str) -> DataFrame:
    """links: key, wave, rank. A wave's highest rank may not exceed that of the wave numbered one less, if there is one."""
    top = links.groupBy(key, "wave").agg(F.max("rank").alias("rank"))
    before = Window.partitionBy(key).orderBy("wave").rangeBetween(-1, -1)
    top = top.withColumn("previous", F.max("rank").over(before))
    return violations(top.withColumn("_key", F.col(key)), "_key", [("surer_than_the_wave_before", F.col("rank") > F.col("previous"), F.col("wave"))])


def edges(edge_rows: DataFrame, nodes: DataFrame, key: str = "map_id") -> DataFrame:
    """edge_rows: key, source, target; nodes: key, node_id. Both ends of an edge must be nodes of its map."""
    ends = edge_rows.select(key, F.stack(F.lit(2), F.lit("from"), F.col("source"), F.lit("to"), F.col("target")).alias("side", "node_id"))
    lost = ends.join(nodes.select(key, "node_id").distinct(), [key, "node_id"], "left_anti")
    return lost.select(F.col(key).cast("string").alias("key"), F.concat(F.lit("unknown_"), "side").alias("rule"), F.col("node_id").cast("string").alias("detail"))


def bottlenecks(nodes: DataFrame, key: str = "map_id") -> DataFrame:
    """nodes: key, node_id, is_bottleneck, trigger_condition, monetizer_type."""
    rows = nodes.filter("is_bottleneck").withColumn("_key", F.concat_ws("/", key, "node_id"))
    return violations(rows, "_key", [("no_trigger", blank(F.col("trigger_condition")), F.lit("")), ("no_monetizer", blank(F.col("monetizer_type")), F.lit(""))])


def predictions(rows: DataFrame) -> DataFrame:
    """A prediction needs a falsifier, a due date, a metric and a criterion."""
    return violations(rows, "prediction_id", [
        ("no_falsifier", blank(F.col("falsifier")), F.lit("")), ("no_due_date", F.col("due_date").isNull(), F.lit("")),
        ("no_metric", blank(F.col("metric")), F.lit("")), ("no_criterion", F.col("operator").isNull() | F.col("value").isNull(), F.lit("")),
    ])


def reports(sections: DataFrame) -> DataFrame:
    """sections: report_id, no, section, body, and the two flags. Sixteen, numbered in order, keys distinct, bodies not blank, flags false."""
    numbers = F.array_sort(F.collect_list("no"))
    per = sections.groupBy("report_id").agg(
        F.count("*").alias("n"), numbers.alias("numbers"), F.count_distinct("section").alias("keys"), F.count_if(blank(F.col("body"))).alias("empty"),
        F.bool_or(F.coalesce("contains_ticker_recommendation", F.lit(True))).alias("tickers"), F.bool_or(F.coalesce("contains_ranking", F.lit(True))).alias("ranks"),
    )
    return violations(per, "report_id", [
        ("section_count", F.col("n") != len(fixed.SECTIONS), F.col("n")), ("section_numbers", F.col("numbers") != F.array(*[F.lit(n) for n, _ in fixed.SECTIONS]), F.array_join("numbers", ",")),
        ("duplicate_sections", F.col("keys") != F.col("n"), F.col("n") - F.col("keys")), ("empty_sections", F.col("empty") > 0, F.col("empty")),
        ("tickers", F.col("tickers"), F.lit("")), ("ranks", F.col("ranks"), F.lit("")),
    ])


#: Rules by the table they apply to.
CHECKS: dict[str, Callable[..., DataFrame]] = {"event": events, "signal": windows, "sector": sectors, "wave": waves, "supply_chain": edges, "prediction": predictions, "daily_report": reports}
