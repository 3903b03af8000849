"""Predictions against outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import time as T


def verdict(operator: Column, actual: Column, value: Column, upper: Column) -> Column:
    """hit or miss by the criterion; unresolvable without a measurement. between without an upper value is a miss."""
    met = (
        F.when(operator == ">=", actual >= value).when(operator == ">", actual > value).when(operator == "<=", actual <= value)
        .when(operator == "<", actual < value).when(operator == "==", actual == value).when(operator == "between", upper.isNotNull() & (actual >= value) & (actual <= upper))
    )
    return F.when(actual.isNull(), "unresolvable").when(F.coalesce(met, F.lit(False)), "hit").otherwise("miss")


def errors(actual: Column, value: Column) -> tuple[Column, Column]:
    """Absolute error, and relative to the signed expectation where that isn't zero."""
    return F.bround(actual - value, 6), F.when(value != 0, F.bround((actual - value) / value, 6))


def judge(rows: DataFrame) -> DataFrame:
    """rows (operator, value, value_upper, actual, given: an overriding verdict or null) with verdict and errors."""
    absolute, relative = errors(F.col("actual"), F.col("value"))
    given = F.col("given") if "given" in rows.columns else F.lit(None).cast("string")
    return rows.withColumns({"verdict": F.coalesce(given, verdict(F.col("operator"), F.col("actual"), F.col("value"), F.col("value_upper"))), "error_absolute": absolute, "error_relative": relative})


def latest_results(results: DataFrame, as_of: str | None = None) -> DataFrame:
    """The last result of each prediction; with as_of, of those evaluated by then."""
    rows = results if as_of is None else results.filter(F.col("evaluated_at") <= T.at(as_of))
    nth = F.row_number().over(Window.partitionBy("prediction_id").orderBy(F.col("result_id").desc()))
    return rows.withColumn("_nth", nth).filter("_nth = 1").drop("_nth")


def due(predictions: DataFrame, results: DataFrame, as_of: str) -> DataFrame:
    """Visible predictions whose time has come and that have no result."""
    rows = predictions.filter((F.col("issued_at") <= T.at(as_of)) & (F.col("due_date") <= F.to_date(T.at(as_of))))
    return rows.join(latest_results(results, as_of).select("prediction_id"), "prediction_id", "left_anti")


def accuracy(predictions: DataFrame, results: DataFrame, as_of: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Counts by verdict; the hit rate is over those resolved and null without any."""
    rows = predictions.filter(F.col("issued_at") <= T.at(as_of)).join(latest_results(results, as_of).select("prediction_id", "verdict"), "prediction_id", "left")
    per = rows.groupBy(*keys).agg(F.count("*").alias("total"), *[F.count_if(F.col("verdict") == v).alias(v) for v in fixed.VERDICTS], F.count_if(F.col("verdict").isNull()).alias("pending"))
    resolved = F.col("hit") + F.col("miss") + F.col("partial")
    return per.withColumn("resolved", resolved).withColumn("hit_rate", F.when(F.col("resolved") > 0, F.bround(F.col("hit") / F.col("resolved"), 3)))


def causes(predictions: DataFrame, results: DataFrame, as_of: str) -> DataFrame:
    """cause_category, n of what failed, most frequent first."""
    seen = predictions.filter(F.col("issued_at") <= T.at(as_of)).select("prediction_id")
    rows = latest_results(results, as_of).filter(F.col("verdict").isin("miss", "partial")).join(seen, "prediction_id", "left_semi")
    return rows.groupBy("cause_category").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "cause_category")


def missed_signals(claimed: DataFrame, events: DataFrame) -> DataFrame:
    """claimed (prediction_id, issued_at, event_id) as far as the event had been observed when the prediction was issued."""
    seen = events.select(F.col("event_id").alias("_event"), F.col("observed_at").alias("_seen"))
    return claimed.join(seen, (F.col("event_id") == F.col("_event")) & (F.col("_seen") <= F.col("issued_at")), "left_semi")


def open_improvements(results: DataFrame) -> DataFrame:
    return latest_results(results).filter(F.col("improvement.status").isin("open", "in_progress")).select("result_id", "improvement.*")
