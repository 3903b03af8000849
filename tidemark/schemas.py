"""Tables of the domain, and checks of values that a type alone can't tell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import jsonschema
from tidemark.operators import rules

RAW_DOCUMENT = "raw_id string, source_id string, observed_at timestamp, published_at timestamp, url string, canonical_url string, title string, body string, content_hash string, quantities array<struct<label:string,unit:string,scale:string,period:string,value:double>>, sector_ids array<string>"
EVENT = "raw_id string, event_id string, cluster_id string, is_cluster_primary boolean, category string, title string, summary string, observed_at timestamp, event_at timestamp, signal_types array<string>, regions array<string>, sector_links array<struct<sector_id:string,relation:string,confidence:string>>, sources array<struct<source_id:string,raw_id:string,url:string,reliability:string,observed_at:timestamp>>, max_reliability string"
PREDICTION = "prediction_id string, statement string, issued_at timestamp, due_date date, metric string, unit string, operator string, value double, value_upper double, falsifier string, sector_id string"
RESULT = "result_id string, prediction_id string, evaluated_at timestamp, verdict string, actual double, cause_category string"

#: Patterns of identifiers, by kind.
PATTERNS = {
    "raw_id": r"^raw_[0-9a-f]{16}$", "event_id": r"^evt_\d{8}_[0-9a-f]{10}$", "cluster_id": r"^clu_[0-9a-f]{10}$", "source_id": r"^src_[a-z0-9_]+$", "sector_id": r"^sec_[a-z0-9_]+$", "window_id": r"^sig_[a-z0-9_]+_\d{8}$",
    "prediction_id": r"^prd_\d{8}_[0-9a-f]{8}$", "result_id": r"^bt_\d{8}_[0-9a-f]{8}$",
}
DOMAINS = {"max_reliability": fixed.RELIABILITY, "verdict": fixed.VERDICTS, "operator": fixed.OPERATORS}


def ill_formed(rows: DataFrame, key: str) -> DataFrame:
    """Violations of the patterns and enumerations of the columns that rows has; nulls aside."""
    checks: list[tuple[str, Column, Column]] = []
    for name in rows.columns:
        if name in PATTERNS:
            checks.append((f"{name}_pattern", ~F.rlike(name, F.lit(PATTERNS[name])), F.col(name)))
        if name in DOMAINS:
            checks.append((f"{name}_domain", ~F.col(name).isin(*DOMAINS[name]), F.col(name)))
    return rules.violations(rows, key, checks)


def _object(required: str, closed: bool = True, **properties: dict) -> dict:
    return {"type": "object", "required": required.split(), "properties": properties} | ({"additionalProperties": False} if closed else {})


def _list(items: dict, least: int = 0) -> dict:
    return {"type": "array", "items": items} | ({"minItems": least} if least else {})


def _id(kind: str) -> dict:
    return {"type": "string", "pattern": PATTERNS[kind]}


TEXT, WORD, NUMBER, COUNT, FLAG = {"type": "string"}, {"type": "string", "minLength": 1}, {"type": "number"}, {"type": "integer", "minimum": 0}, {"type": "boolean"}
TIME, DAY = {"type": "string", "pattern": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z$"}, {"type": "string", "pattern": r"^\d{4}-\d{2}-\d{2}$"}
SHARE = {"type": "number", "minimum": 0, "maximum": 1}
GRADE = {"enum": list(fixed.RELIABILITY)}
_QUANTITY = _object("label unit period value", label=WORD, unit=TEXT, scale=TEXT, period=WORD, value=NUMBER)
_CLAIM = _object("claim_id type statement", claim_id=WORD, type={"enum": ["observed", "inferred"]}, statement=TEXT, confidence=TEXT, basis=_list(TEXT))
_CLAIM |= {"if": {"properties": {"type": {"const": "inferred"}}}, "then": {"required": ["basis"], "properties": {"basis": {"minItems": 1}}}}
_SOURCE = _object("source_id raw_id", source_id=_id("source_id"), raw_id=_id("raw_id"), url=TEXT, reliability=GRADE, observed_at=TIME)
_SECTION = _object("no key body", closed=False, no=COUNT, key=WORD, body=WORD)

#: JSON Schemas of what is stored, by kind; columns that are null are left out of a document.
DOCUMENTS: dict[str, dict] = {
    "raw": _object("raw_id source_id observed_at url canonical_url content_hash", raw_id=_id("raw_id"), source_id=_id("source_id"), observed_at=TIME, published_at=TIME, url=WORD, canonical_url=WORD, title=TEXT, body=TEXT, content_hash={"type": "string", "pattern": "^[0-9a-f]{64}$"}, quantities=_list(_QUANTITY), sector_ids=_list(_id("sector_id")), observed_day=DAY),
    "event": _object("event_id raw_id cluster_id is_cluster_primary category title observed_at event_at sources", closed=False, raw_id=_id("raw_id"), event_id=_id("event_id"), cluster_id=_id("cluster_id"), is_cluster_primary=FLAG, category=WORD, title=TEXT, observed_at=TIME, event_at=TIME, signal_types=_list(WORD), regions=_list(TEXT), sector_links=_list(_object("sector_id", closed=False, sector_id=_id("sector_id"))), sources=_list(_SOURCE, 1), max_reliability=GRADE, claims=_list(_CLAIM), quantities=_list(_QUANTITY)),
    "signal": _object("window_id label window_start window_end baseline_start baseline_end counts threshold_met", closed=False, window_id=_id("window_id"), window_start=DAY, window_end=DAY, baseline_start=DAY, baseline_end=DAY, threshold_met=FLAG, counts=_list(_object("signal_type count baseline_count", closed=False, signal_type=WORD, count=COUNT, baseline_count=COUNT))),
    "sector": _object("sector_id name as_of views scenarios", closed=False, sector_id=_id("sector_id"), name=WORD, as_of=TIME, scenarios=_list(_object("scenario falsifier", closed=False, scenario={"enum": list(fixed.SCENARIOS)}, falsifier=WORD, projections=_list(_object("year amount", closed=False, year=COUNT, amount=NUMBER))), 3), views=_object("consensus independent", closed=False)),
    "prediction": _object("prediction_id statement issued_at due_date metric operator value falsifier", closed=False, prediction_id=_id("prediction_id"), statement=WORD, issued_at=TIME, due_date=DAY, metric=WORD, operator={"enum": list(fixed.OPERATORS)}, value=NUMBER, value_upper=NUMBER, falsifier=WORD, probability=SHARE)
    | {"if": {"properties": {"operator": {"const": "between"}}}, "then": {"required": ["value_upper"]}},
    "result": _object("result_id prediction_id evaluated_at verdict cause_category narrative", closed=False, result_id=_id("result_id"), prediction_id=_id("prediction_id"), evaluated_at=TIME, verdict={"enum": list(fixed.VERDICTS)}, actual=NUMBER, cause_category=WORD, narrative=WORD),
    "report": _object("report_id report_date as_of sections", closed=False, report_id=WORD, report_date=DAY, as_of=TIME, sections={**_list(_SECTION, len(fixed.SECTIONS)), "maxItems": len(fixed.SECTIONS)}),
    "source": _object("source_id name kind tier reliability", closed=False, source_id=_id("source_id"), name=WORD, kind={"enum": ["rss", "atom", "json", "json_api", "json_series"]}, tier={"enum": ["tier1", "tier2", "tier3", "tier4"]}, reliability=GRADE, enabled=FLAG, poll_interval_minutes=COUNT),
}


def document(rows: DataFrame) -> Column:
    """A row as the JSON that its schema tells of: instants in UTC, nulls left out."""
    return F.to_json(F.struct(*rows.columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'", "timeZone": "UTC"})


def check(documents: DataFrame, key: str, text: str, kind: str) -> DataFrame:
    """key, rule, detail of what in the documents (JSON text) breaks the schema of their kind; detail begins with the path."""
    if kind not in DOCUMENTS:
        raise ValueError(f"no schema for {kind!r}; there are: {', '.join(sorted(DOCUMENTS))}")
    found = documents.select(F.col(key).cast("string").alias("key"), F.explode(jsonschema.violations(F.col(text), DOCUMENTS[kind])).alias("v"))
    return found.select("key", F.concat(F.lit("schema_"), "v.rule").alias("rule"), F.concat_ws(" ", "v.path", "v.detail").alias("detail"))


def check_rows(rows: DataFrame, key: str, kind: str) -> DataFrame:
    """check of a table's rows."""
    return check(rows.select(key, document(rows).alias("_text")), key, "_text", kind)
