"""The domain's tables, derived from generic ones (events, documents, orders, lineitem, suppliers)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import time as T
from tidemark.operators import signals

#: The analysis's time over the generic events, and its window.
AS_OF = "2024-01-30T23:59:59Z"
WINDOW = T.Window.ending(date(2024, 1, 30), days=5, multiplier=4)
TOPICS = [signals.Topic(f"sector {i}", (), f"sec_s{i}") for i in range(16)]
CATEGORIES = ("policy_regulation", "macro", "technology", "capex", "supply_demand")
TYPES = ("signup", "error", "click", "view", "purchase")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signal events. Source 0 is observed late; every seventh event is a duplicate; purchases carry a figure."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    late = F.when(F.col("user_id") == 0, F.greatest("ts", F.lit("2024-01-10").cast("timestamp"))).otherwise(F.col("ts"))
    observed = (late.cast("long") + F.col("event_id") % 4 * 3600).cast("timestamp")
    k = F.get_json_object("props", "$.k").cast("long")
    source, grade = F.concat(F.lit("src_"), F.col("user_id")), F.get(F.array(*map(F.lit, "ABCD")), (F.col("user_id") % 4).cast("int"))
    category = F.element_at(F.create_map(*[F.lit(x) for p in zip(TYPES, CATEGORIES, strict=True) for x in p]), F.col("event_type"))
    base = e.select(
        F.col("event_id").alias("id"), F.concat(F.lit("evt_"), "event_id").alias("event_id"), F.timestamp_seconds(F.col("ts").cast("long")).alias("event_at"), observed.alias("observed_at"),
        F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("title"), F.lit("").alias("summary"), category.alias("category"), F.array("event_type").alias("signal_types"),
        F.array(F.concat(F.lit("r"), (F.col("user_id") % 3).cast("string"))).alias("regions"), F.array(F.struct(F.concat(F.lit("sec_s"), (k % 16).cast("string")).alias("sector_id"))).alias("sector_links"),
        source.alias("source_id"), grade.alias("max_reliability"), (F.col("event_id") % 7 != 0).alias("is_cluster_primary"), "value", k.alias("k"), "event_type",
    )
    figure = F.when(F.col("event_type") == "purchase", F.array(F.struct(F.concat(F.lit("k"), (F.col("k") % 10).cast("string")).alias("label"), F.lit("USD").alias("unit"), F.lit("one").alias("scale"), F.date_format("event_at", "yyyy-MM-dd").alias("period"), F.col("value").alias("value"))))
    return base.withColumns({"sources": F.array(F.struct("source_id", F.col("max_reliability").alias("reliability"), "observed_at")), "quantities": figure}).drop("event_type", "k", "value")


def visible_events(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    return events(spark, sf_dir).filter(T.visible(F.col("observed_at"), as_of))


def primary_events(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    return visible_events(spark, sf_dir, as_of).filter(F.coalesce("is_cluster_primary", F.lit(True)))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw documents; the first line is the title and each language has a day of its own."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang", "source")
    day = F.element_at(F.create_map(*[F.lit(x) for x in ("en", "2024-01-01", "fr", "2024-01-02", "de", "2024-01-03", "es", "2024-01-04")]), F.col("lang"))
    return d.select(
        F.concat(F.lit("raw_"), F.lpad(F.col("doc_id").cast("string"), 12, "0")).alias("raw_id"), "doc_id", F.col("source").alias("source_id"), F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("body"),
        F.concat(F.lit("https://example.org/"), F.col("doc_id").cast("string")).alias("url"), day.cast("timestamp").alias("event_at"), F.timestamp_seconds(day.cast("timestamp").cast("long") + F.col("doc_id")).alias("observed_at"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as predictions of what their lines will cost; those of every eleventh order lack a falsifier."""
    o = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    operator = F.get(F.array(*map(F.lit, (">=", ">", "<=", "<", "==", "between"))), (F.col("o_orderkey") % 6).cast("int"))
    return o.select(
        F.concat(F.lit("prd_"), "o_orderkey").alias("prediction_id"), "o_orderkey", F.col("o_orderdate").alias("issued_at"), F.date_add(F.to_date("o_orderdate"), 90).alias("due_date"), F.lit("cost").alias("metric"),
        operator.alias("operator"), F.col("o_totalprice").alias("value"), F.when(F.col("o_orderkey") % 12 == 5, F.col("o_totalprice") * 1.5).alias("value_upper"), F.when(F.col("o_orderkey") % 11 != 0, F.lit("f")).alias("falsifier"), F.col("o_orderpriority").alias("sector_id"),
    )


def actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.bround(F.sum("l_extendedprice"), 2).alias("actual"))
    return lines


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judged predictions: all but every fifth; causes by priority."""
    from tidemark.operators import backtest

    p = predictions(spark, sf_dir).filter("o_orderkey % 5 <> 0").join(actuals(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    judged = backtest.judge(p)
    evaluated = (F.col("issued_at").cast("long") + 100 * 86400).cast("timestamp")
    return judged.select(F.concat(F.lit("bt_"), "prediction_id").alias("result_id"), "prediction_id", evaluated.alias("evaluated_at"), "verdict", "actual", "error_absolute", "error_relative", F.col("sector_id").alias("cause_category"))


def quantity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics: prices by flag, status and month."""
    li = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    q = F.struct(F.concat("l_returnflag", "l_linestatus").alias("label"), F.lit("USD").alias("unit"), F.lit("one").alias("scale"), F.date_format("l_shipdate", "yyyy-MM").alias("period"), F.col("l_extendedprice").alias("value"))
    return li.select(F.concat_ws("_", F.col("l_orderkey").cast("string"), F.lpad(F.col("l_linenumber").cast("string"), 2, "0")).alias("event_id"), F.col("l_shipdate").alias("observed_at"), F.array(q).alias("quantities"))


def literal(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))
