"""JSON Schemas as columns."""

import json

import pytest
from pyspark.sql import functions as F
from tidemark import schemas
from tidemark.functions import jsonschema

SCHEMA = {
    "type": "object", "required": ["id", "tags"], "additionalProperties": False,
    "properties": {"id": {"type": "string", "pattern": "^a\\d+$"}, "tags": {"type": "array", "minItems": 1, "maxItems": 3, "items": {"$ref": "#/$defs/tag"}}, "n": {"type": ["number", "null"], "minimum": 0}, "k": {"enum": ["x", 1, None]},
                   "m": {"type": "object", "additionalProperties": {"type": "integer"}}, "o": {"$ref": "other#/$defs/short", "description": "an annotation"}, "e": {"anyOf": [{"type": "string"}, {"type": "array", "items": {"const": 1}}]}},
    "$defs": {"tag": {"type": "object", "required": ["t"], "properties": {"t": {"type": "string", "minLength": 2}, "sub": {"type": "array", "items": {"type": "integer", "maximum": 5}}}}},
}
OTHER = {"$defs": {"short": {"maxLength": 2, "allOf": [{"$ref": "#/$defs/text"}]}, "text": {"type": "string"}}}
CASES = [
    ({"id": "a1", "tags": [{"t": "ab", "sub": [1, 2.0]}], "n": 1.5, "k": None, "m": {"x": 1}, "o": "ab", "e": [1, 1]}, []),
    ({"id": "b", "tags": [], "n": -1, "z": 1, "k": 2}, [("$.id", "pattern", "b"), ("$.tags", "minItems", "0"), ("$.n", "minimum", "-1"), ("$.k", "enum", "2"), ("$.z", "additionalProperties", "z")]),
    ({"tags": [{"t": "x"}, {"sub": [1, 9, 1.5, "q"]}, 3]}, [("$", "required", "id"), ("$.tags[0].t", "minLength", "x"), ("$.tags[1]", "required", "t"), ("$.tags[1].sub[1]", "maximum", "9"), ("$.tags[1].sub[2]", "type", "number"), ("$.tags[1].sub[3]", "type", "string"), ("$.tags[2]", "type", "integer")]),
    ({"id": "a2", "tags": [{"t": "ab"}] * 4, "m": {"x": 1, "y": "n"}, "o": "abc", "e": [1, 2]}, [("$.tags", "maxItems", "4"), ("$.m.y", "type", "string"), ("$.o", "maxLength", "abc"), ("$.e", "anyOf", "[1,2]")]),
    ({"id": "a3", "tags": [{"t": "ab"}], "o": 7, "e": "s", "k": "x"}, [("$.o", "type", "integer")]),
    ([1], [("$", "type", "array")]), ("{", [("$", "not_json", None)]), (None, [("$", "not_json", None)]),
]


def test_violations_with_their_paths(spark):
    texts = [d if d is None or isinstance(d, str) else json.dumps(d) for d, _ in CASES]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, d string")
    got = {r.i: sorted(map(tuple, r.v), key=str) for r in df.select("i", jsonschema.violations(F.col("d"), SCHEMA, {"other": OTHER}).alias("v")).collect()}
    assert got == {i: sorted(want, key=str) for i, (_, want) in enumerate(CASES)}


def test_schemas_that_cannot_be_compiled():
    for schema, why in (({"type": "object", "uniqueItems": True}, "uniqueItems"), ({"$ref": "#/$defs/a", "$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}}, "itself"), ({"$ref": "no#/x"}, "no schema")):
        with pytest.raises(ValueError, match=why):
            jsonschema.Compiler(schema).at(schema, F.lit(None), F.lit("$"), "", ())


GOOD = {
    "raw": {"raw_id": "raw_0123456789abcdef", "source_id": "src_a", "observed_at": "2026-01-01T00:00:00Z", "url": "u", "canonical_url": "u", "content_hash": "0" * 64, "quantities": [{"label": "l", "unit": "", "period": "2026", "value": 1}]},
    "event": {"event_id": "evt_20260101_0123456789", "raw_id": "raw_0123456789abcdef", "cluster_id": "clu_0123456789", "is_cluster_primary": True, "category": "macro", "title": "t", "observed_at": "2026-01-01T00:00:00Z", "event_at": "2026-01-01T00:00:00Z", "sources": [{"source_id": "src_a", "raw_id": "raw_0123456789abcdef"}]},
    "signal": {"window_id": "sig_x_20260101", "label": "x", "window_start": "2026-01-01", "window_end": "2026-01-02", "baseline_start": "2025-12-01", "baseline_end": "2025-12-31", "threshold_met": False, "counts": [{"signal_type": "s", "count": 1, "baseline_count": 0}]},
    "sector": {"sector_id": "sec_x", "name": "x", "as_of": "2026-01-01T00:00:00Z", "views": {"consensus": "c", "independent": "i"}, "scenarios": [{"scenario": s, "falsifier": "f", "projections": [{"year": 2030, "amount": 1.5}]} for s in ("bear", "base", "bull")]},
    "prediction": {"prediction_id": "prd_20260101_01234567", "statement": "s", "issued_at": "2026-01-01T00:00:00Z", "due_date": "2026-03-01", "metric": "m", "operator": "between", "value": 1, "value_upper": 2, "falsifier": "f"},
    "result": {"result_id": "bt_20260101_01234567", "prediction_id": "prd_20260101_01234567", "evaluated_at": "2026-03-01T00:00:00Z", "verdict": "hit", "cause_category": "c", "narrative": "n"},
    "report": {"report_id": "r", "report_date": "2026-01-01", "as_of": "2026-01-01T00:00:00Z", "sections": [{"no": i + 1, "key": "k", "body": "b"} for i in range(16)]},
    "source": {"source_id": "src_a", "name": "n", "kind": "rss", "tier": "tier1", "reliability": "A"},
}
BAD = {
    "raw": ("quantities", [{"label": "l"}], ["required", "required", "required"]), "event": ("sources", [], ["minItems"]), "signal": ("counts", [{"signal_type": "s", "count": -1, "baseline_count": 0}], ["minimum"]),
    "sector": ("scenarios", [{"scenario": "bear", "falsifier": ""}], ["minItems", "minLength"]), "prediction": ("value_upper", None, ["type"]), "result": ("verdict", "maybe", ["enum"]), "report": ("sections", [], ["minItems"]), "source": ("kind", "gopher", ["enum"]),
}


def test_eight_kinds(spark):
    assert set(GOOD) == set(BAD) == set(schemas.DOCUMENTS)
    for kind, good in GOOD.items():
        name, value, rules = BAD[kind]
        df = spark.createDataFrame([("good", json.dumps(good)), ("bad", json.dumps({**good, name: value}))], "k string, d string")
        assert sorted((r.key, r.rule) for r in schemas.check(df, "k", "d", kind).collect()) == [("bad", f"schema_{r}") for r in sorted(rules)], kind
    without = {k: v for k, v in GOOD["prediction"].items() if k != "value_upper"}
    df = spark.createDataFrame([("a", json.dumps(without)), ("b", json.dumps({**without, "operator": ">"}))], "k string, d string")
    assert [(r.key, r.rule, r.detail) for r in schemas.check(df, "k", "d", "prediction").collect()] == [("a", "schema_required", "$ value_upper")]


def test_rows_of_a_table(spark):
    rows = spark.createDataFrame([("evt", None, ["a"])], "event_id string, title string, signal_types array<string>")
    found = {(r.rule, r.detail) for r in schemas.check_rows(rows, "event_id", "event").collect()}
    assert ("schema_pattern", "$.event_id evt") in found and ("schema_required", "$ title") in found and not any("signal_types" in d for _, d in found)
