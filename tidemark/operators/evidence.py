"""Evidence for a sector: visible primary events, best sources first, no source and day crowding out the rest."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import time as T
from tidemark.operators import signals


def is_statistic(quantities: str = "quantities") -> Column:
    return F.coalesce(F.size(quantities), F.lit(0)) > 0


def ordered(order: Sequence[Column], keys: Sequence[str] = ()) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order))


def first_rows(rows: DataFrame, order: Sequence[Column], limit: int, keys: Sequence[str] = ()) -> DataFrame:
    """The first `limit` rows of each group: cut before they are exchanged, so no task sees a whole group."""
    if not keys:
        return rows.orderBy(*order).limit(limit)
    return rows.withColumn("_first", ordered(order, keys)).filter(F.col("_first") <= limit).drop("_first")


def placed(rows: DataFrame, order: Sequence[Column], keys: Sequence[str] = ()) -> DataFrame:
    """rows with their position in their group; for groups that first_rows has cut."""
    return rows.withColumn("position", F.row_number().over((Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))).orderBy(*order)))


def diversify(rows: DataFrame, order: Sequence[Column], limit: int, keys: Sequence[str] = (), per_day: int = fixed.PER_SOURCE_AND_DAY) -> DataFrame:
    """The first `limit` rows of each group. Where a group has more, at most per_day of a source and day, the others only after those.

    One row beyond the limit tells whether a group has more, so groups are cut to limit + 1 rows, and those of
    a source and day to that number, before they are ranked as wholes.
    """
    out = rows.withColumns({"_source": F.col("sources")[0]["source_id"], "_day": F.to_date("event_at")})
    out = out.withColumn("_nth", ordered(order, [*keys, "_source", "_day"])).filter(F.col("_nth") <= limit + 1)
    out = first_rows(out.withColumn("_late", F.col("_nth") > per_day), [F.col("_late"), *order], limit + 1, keys)
    more = F.count("*").over(Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))) > limit
    out = placed(out.withColumn("_late", more & F.col("_late")), [F.col("_late"), *order], keys)
    return out.filter(F.col("position") <= limit).drop("_source", "_day", "_nth", "_late")


def bundle(events: DataFrame, topic: signals.Topic, as_of: str, days: int = fixed.EVIDENCE_DAYS, limit: int = fixed.EVIDENCE_LIMIT, statistics: int = fixed.STATISTICS_LIMIT) -> DataFrame:
    """The events that an analysis of the topic may cite: reports, diversified, and statistics, each with its position."""
    since = T.instant(as_of).date() - timedelta(days=days)
    rows = events.filter(T.visible(F.col("observed_at"), as_of) & F.coalesce("is_cluster_primary", F.lit(True)) & (F.to_date("event_at") >= F.lit(since)))
    rows = signals.match_topics(rows, [topic]).drop("topic")
    order = [F.col("max_reliability"), F.col("event_at").desc(), F.col("observed_at"), F.col("event_id")]
    reports = diversify(rows.filter(~is_statistic()), order, limit).withColumn("kind", F.lit("report"))
    figures = placed(first_rows(rows.filter(is_statistic()), order, statistics), order).withColumn("kind", F.lit("statistic"))
    return reports.unionByName(figures)


def reliability_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(*[F.count_if(F.col("max_reliability") == r).alias(r) for r in fixed.RELIABILITY])


def evidence_span(rows: DataFrame) -> DataFrame:
    """When the reports in a bundle were observed, first and last; statistics don't count."""
    return rows.filter("kind = 'report'").agg(F.min("observed_at").alias("oldest"), F.max("observed_at").alias("newest"))


def series(events: DataFrame) -> DataFrame:
    """label, unit, scale, points of each statistic series; points in the order of period, event and value."""
    rows = events.select("event_id", F.explode("quantities").alias("q"))
    points = F.array_sort(F.collect_list(F.struct("q.period", "event_id", "q.value")))
    return rows.groupBy("q.label", "q.unit", F.coalesce("q.scale", F.lit("")).alias("scale")).agg(points.alias("points"))


def latest_points(events: DataFrame, limit: int = fixed.REPORT_ITEMS) -> DataFrame:
    """label, unit, period, value, n of each series' last period, the first such point in order of observation."""
    rows = events.select("event_id", "observed_at", F.explode("quantities").alias("q")).select("event_id", "observed_at", "q.*")
    # counts by period are partial before the exchange, however long a series is; only the last periods of the series returned are read again
    periods = rows.groupBy("label", "unit", "period").agg(F.count("*").alias("n"))
    latest = periods.groupBy("label", "unit").agg(F.max(F.struct(F.col("period").isNotNull(), "period")).alias("last"), F.sum("n").alias("n"))
    latest = latest.orderBy("label", "unit").limit(limit).select(*[F.col(c).alias(f"_{c}") for c in ("label", "unit")], F.col("last.period").alias("_period"), "n")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("label", "unit", "period")]
    last = rows.join(F.broadcast(latest), reduce(Column.__and__, same))
    first = last.groupBy("label", "unit", "period", "n").agg(F.min_by(F.struct("value"), F.struct("observed_at", "event_id")).alias("first"))
    return first.select("label", "unit", "period", "first.value", "n").orderBy("label", "unit")


def ungrounded(cited: DataFrame, known: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The rows of cited (path, event_id, keys) whose event isn't among the known."""
    return cited.filter("event_id is not null").join(known.select(*keys, "event_id").distinct(), [*keys, "event_id"], "left_anti")


#: Bytes of JSON that are walked at once.
PORTION = 256_000_000


def cited(documents: DataFrame, key: str, text: str, name: str = "event_id") -> DataFrame:
    """key, path, event_id of every reference in documents (JSON text): strings under `name`, its plural or `basis`, alone or in a list, at any depth.

    Documents are walked level by level in the plan, by a recursive query over VARIANT for each PORTION of their text, as all that such a query
    finds on its way meets in a fixed number of tasks; text that is no JSON cites nothing. A
    document nested deeper than 1,000 levels is an error. Lifts the session's limit on the rows of such queries.
    """
    spark = documents.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    names = ", ".join(f"'{n}'" for n in (name, f"{name}s", "basis"))
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    portions = -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PORTION) or 1
    found = []
    for i in range(portions):
        here = rows.filter(F.pmod(F.xxhash64("key"), F.lit(portions)) == i) if portions > 1 else rows
        # listed: how many lists lie between a value and the name that it is under
        found.append(spark.sql(
            """WITH RECURSIVE walk(key, path, name, listed, v) MAX RECURSION LEVEL 1000 AS (
                 SELECT key, '$', CAST(NULL AS STRING), 0, v FROM {rows} WHERE v IS NOT NULL
                 UNION ALL
                 SELECT w.key, concat(w.path, CASE WHEN e.key IS NULL THEN concat('[', e.pos, ']') ELSE concat('.', e.key) END), coalesce(e.key, w.name), CASE WHEN e.key IS NULL THEN w.listed + 1 ELSE 0 END, e.value
                 FROM walk w, LATERAL variant_explode(w.v) AS e(pos, key, value))
               SELECT key, path, try_variant_get(v, '$', 'string') AS event_id FROM walk WHERE listed <= 1 AND name IN (""" + names + ") AND schema_of_variant(v) = 'STRING'",
            rows=here.select("key", F.try_parse_json("text").alias("v")),
        ))
    found = reduce(DataFrame.unionByName, found)
    return found.withColumnRenamed("key", key)
