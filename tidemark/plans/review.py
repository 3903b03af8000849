"""Predictions: issuing, recording, and the monthly review."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ids
from tidemark.functions import time as T
from tidemark.operators import backtest, rules


# The texts of a review.
TITLE, ACCURACY, CAUSES = "# 予測レビュー", "## 予測精度 (§41)", "## 外れた原因の内訳 (§43)"
DUE, OPEN = "## 判定期限を迎えた未処理の予測", "## 未着手の改善アクション (§43)"
NO_RATE, NOTHING = "判定済みの予測がまだ無い", "- 該当なし"
WARNING = "件数が少ないうちは率を読まない。的中率はセクターの優劣ではなく、本システムの誤差の測定値である。"


class Refused(ValueError):
    """Predictions that could not be verified."""


def issue(rows: DataFrame) -> DataFrame:
    """rows (statement, issued_at, due_date, metric, operator, value, value_upper, falsifier) with ids; refused if one breaks a rule."""
    out = rows.withColumn("prediction_id", ids.prediction_id(F.col("issued_at"), F.col("statement"), T.fmt(F.col("issued_at"))))
    broken = rules.predictions(out).limit(20).collect()
    if broken:
        raise Refused("; ".join(f"{r.key}: {r.rule}" for r in broken))
    return out


def record(predictions: DataFrame, measured: DataFrame, evaluated_at: str, events: DataFrame | None = None) -> DataFrame:
    """measured (prediction_id, actual, cause_category, narrative) judged against their predictions.

    Optional columns of measured: given, a verdict that overrides the criterion's, and missed_signals, ids of events; of these only such stay
    as had been observed when the prediction was issued, by events (event_id, observed_at).
    """
    rows = backtest.judge(predictions.join(measured, "prediction_id"))
    at = T.at(evaluated_at)
    out = rows.select(
        ids.result_id(at, F.col("prediction_id"), T.fmt(at)).alias("result_id"), "prediction_id", at.alias("evaluated_at"), "verdict", "actual", "error_absolute", "error_relative", "cause_category", "narrative",
        *(["missed_signals", "issued_at"] if "missed_signals" in measured.columns else []),
    )
    if "missed_signals" not in measured.columns:
        return out
    if events is None:
        raise ValueError("missed signals can only be told from the events")
    claimed = out.select("result_id", "prediction_id", "issued_at", F.posexplode("missed_signals").alias("_at", "event_id"))
    seen = backtest.missed_signals(claimed, events).groupBy("result_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "event_id"))), lambda x: x["event_id"]).alias("missed_signals"))
    return out.drop("missed_signals", "issued_at").join(seen, "result_id", "left")


def monthly(predictions: DataFrame, results: DataFrame, as_of: str) -> str:
    """The month's review as text, with all that is due and open."""
    return "\n".join(monthly_lines(predictions, results, as_of)) + "\n"


def monthly_lines(predictions: DataFrame, results: DataFrame, as_of: str) -> Iterator[str]:
    """The lines of the month's review; a partition at a time comes to the driver."""
    a = backtest.accuracy(predictions, results, as_of).first()
    yield from [
        f"{TITLE} {T.instant(as_of):%Y-%m}", "", f"as_of: {as_of}", "", ACCURACY, "", f"- 発行済み {a.total} / 判定済み {a.resolved}（的中 {a.hit} / 外れ {a.miss} / 部分 {a.partial}）",
        f"- 判定不能 {a.unresolvable} / 未判定 {a.pending}", f"- 的中率: {a.hit_rate if a.hit_rate is not None else NO_RATE}", "", WARNING, "", CAUSES, "",
    ]
    yield from _or_none(f"- {r.cause_category}: {r.n} 件" for r in backtest.causes(predictions, results, as_of).collect())
    yield from ["", DUE, ""]
    statement = F.concat(F.lit(": "), F.col("statement")) if "statement" in predictions.columns else F.lit(None).cast("string")
    late = backtest.due(predictions, results, as_of).select("prediction_id", "due_date", F.coalesce(statement, F.lit("")).alias("said"))
    yield from _or_none(f"- {r.prediction_id} 期限 {r.due_date}{r.said}" for r in late.orderBy("prediction_id").toLocalIterator())
    yield from ["", OPEN, ""]
    if "improvement" in results.columns:
        todo = backtest.open_improvements(results).orderBy("result_id")
        yield from _or_none(f"- [{r.status}] " + (f"{r.target or '-'}: " if "target" in todo.columns else "") + (r.action or "") for r in todo.toLocalIterator())
    else:
        yield NOTHING


def save_monthly(predictions: DataFrame, results: DataFrame, as_of: str, folder: str | Path) -> Path:
    """The month's review as a file of the folder; a later one of the same month replaces it whole."""
    path = Path(folder, f"review_{T.instant(as_of):%Y-%m}.md")
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_suffix(".part")
    with part.open("w", encoding="utf-8") as out:
        out.writelines(line + "\n" for line in monthly_lines(predictions, results, as_of))
    part.replace(path)
    return path


def _or_none(lines: Iterator[str]) -> Iterator[str]:
    first = next(lines, None)
    yield NOTHING if first is None else first
    yield from lines
