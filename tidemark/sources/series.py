"""Statistics as data points: records, JSON-stat cubes and OData rows, and points as raw documents."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ids
from tidemark.functions import text as X
from tidemark.functions import time as T
from tidemark.sources import feeds
from tidemark.sources.shared import once

POINT = ["source_id", "observed_at", "period", "value", "label", "unit", "keys", "note"]
POINTS = "source_id string, observed_at timestamp, period string, value double, label string, unit string, keys map<string,string>, note string, part string, spec string, requested string, published_at timestamp"


def number(text: Column) -> Column:
    """A number, thousands separators dropped; null for what is none, booleans among it."""
    return F.try_cast(F.replace(F.trim(text), F.lit(","), F.lit("")), "double") if hasattr(F, "try_cast") else F.replace(F.trim(text), F.lit(","), F.lit("")).try_cast("double")


def check_status(payload: Column, spec: dict) -> Column:
    """payload, or an error if its body tells of a failure."""
    if not spec.get("status_path") or not spec.get("status_ok"):
        return payload
    status = feeds.dig(payload, spec["status_path"])
    message = F.concat_ws(": ", status, feeds.dig(payload, spec.get("status_message_path", "message")))
    return F.when(F.coalesce(status, F.lit("")).isin(*spec["status_ok"]), payload).otherwise(F.raise_error(message).cast("string"))


def _keys(pairs: list[tuple[str, Column]]) -> Column:
    if not pairs:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[x for name, c in pairs for x in (F.lit(name), F.coalesce(c, F.lit("")))])


def _label(base: Column, details: list[Column]) -> Column:
    detail = F.concat_ws(", ", *[F.nullif(d, F.lit("")) for d in details]) if details else F.lit("")
    return F.when(detail != "", F.concat(base, F.lit("（"), detail, F.lit("）"))).otherwise(base)


def _entry(entry: dict | Column, name: str) -> Column:
    """What a series says of itself; null where it doesn't. The series is a dict, or a column of JSON."""
    if isinstance(entry, dict):
        return F.lit(entry[name] if entry.get(name) else None).cast("string")
    return F.nullif(F.get_json_object(entry, f"$.{name}"), F.lit(""))


def _kept(rows: DataFrame) -> list[str]:
    """What of a payload its points keep."""
    return [c for c in ("source_id", "observed_at", "part", "spec", "requested", "published_at") if c in rows.columns]


def problem(payload: Column, spec: Column, part: Column) -> Column:
    """Why a payload gives no points, by its spec and series (JSON): an unknown format, an address with names that nothing fills, another form, or a status that tells of a failure; else null."""
    form = F.coalesce(F.get_json_object(spec, "$.format"), F.lit("records"))
    xml = F.when(~F.rlike(payload, F.lit(r"^\s*<[?\w]")) | ~F.rlike(payload, F.lit(r">\s*$")), "not XML")
    json = F.coalesce(F.when(F.try_parse_json(payload).isNull(), "not JSON"), feeds.status_by(payload, spec))
    named = F.regexp_extract_all(F.coalesce(F.get_json_object(spec, "$.point_url_template"), F.lit("")), F.lit(r"\{(\w+)\}"), F.lit(1))
    known = F.concat(F.array(F.lit("period"), F.lit("keys"), F.lit("tenor")), *[F.coalesce(F.json_object_keys(x), F.array().cast("array<string>")) for x in (F.get_json_object(spec, "$.key_fields"), part)])
    lost = F.array_except(named, known)
    # the names of a cube's dimensions are only known once it is read
    unfilled = F.when((form != "jsonstat") & (F.size(lost) > 0), F.concat(F.lit("no value for: "), F.array_join(lost, ", ")))
    return F.when(~form.isin(*PARSERS), F.concat(F.lit("unknown format of series: "), form)).otherwise(F.coalesce(unfilled, F.when(form == "odata_xml", xml).otherwise(json)))


def records(payloads: DataFrame, spec: dict, entry: dict | Column) -> DataFrame:
    """Points that come as arrays of objects, perhaps within arrays of series. Points without value or period are dropped."""
    kept = _kept(payloads)
    rows = payloads.withColumn("payload", check_status(F.col("payload"), spec))
    if spec.get("series_path"):
        rows = rows.withColumn("payload", F.explode(F.from_json(feeds.dig(F.col("payload"), spec["series_path"]), "array<string>")))
    points = feeds.dig(F.col("payload"), spec["points_path"]) if spec.get("points_path") else F.col("payload")
    rows = rows.withColumn("item", F.explode(F.from_json(points, "array<string>")))
    item, paths = F.col("item"), {}

    def text(path: str) -> Column:
        return F.trim(paths.setdefault(path, f"_p{len(paths)}"))

    period = [spec.get("period", "date")] if isinstance(spec.get("period", "date"), str) else spec["period"]
    period = T.period(*[text(p) for p in period])
    keys = [(name, text(path)) for name, path in (spec.get("key_fields") or {}).items()]
    named = spec.get("label_fields")
    base = F.coalesce(_entry(entry, "label"), F.lit(""))
    if spec.get("label"):
        base = F.coalesce(F.nullif(text(spec["label"]), F.lit("")), base)
    unit = F.coalesce(_entry(entry, "unit"), text(spec["unit_path"]) if spec.get("unit_path") else F.lit(None), F.lit(""))
    label = _label(base, [c for name, c in keys if named is None or name in named])
    note = F.concat_ws(" ", *[F.nullif(text(p), F.lit("")) for p in spec.get("note_fields") or []])
    plain = spec.get("value", "value")
    value = feeds.dig(item, entry.get("value") or plain) if isinstance(entry, dict) else F.when(_entry(entry, "value").isNull(), feeds.dig(item, plain)).otherwise(feeds.dig_by(item, _entry(entry, "value")))
    # items without a value go first; of the others each path is read once, however often its text is asked for
    rows = once(rows, [*kept, "item"], value=number(value)).filter("value is not null")
    rows = once(rows, [*kept, "value"], **{name: feeds.dig(item, path) for path, name in paths.items()})
    rows = once(rows, [*kept, "value", *paths.values()], period=period).filter("period <> ''")
    return rows.select(*kept, "period", "value", label.alias("label"), unit.alias("unit"), _keys(keys).alias("keys"), note.alias("note"))


def jsonstat(payloads: DataFrame, spec: dict, entry: dict | Column) -> DataFrame:
    """Points of a sparse cube: a flat index is divided by the strides of its dimensions. Values may be a map or a list.

    What a payload says of its dimensions is read once, before its values become rows.
    """
    kept = _kept(payloads)
    form = "label string, value string, id array<string>, size array<int>, dimension map<string,struct<category:struct<index:string,label:map<string,string>>>>"
    read = once(payloads.withColumn("payload", check_status(F.col("payload"), spec)), kept, d=F.from_json(F.when(F.startswith(F.ltrim("payload"), F.lit("{")), F.col("payload")), form))
    told = read.select(*kept, "d.value", "d.label", F.col("d.id").alias("dims"), F.col("d.size").alias("sizes"), "d.dimension").filter(F.size("dims") == F.size("sizes"))
    raw = F.col("value")
    as_map = F.coalesce(F.from_json(raw, "map<string,string>"), F.create_map().cast("map<string,string>"))
    as_list = F.from_json(raw, "array<string>")
    of_list = F.get(F.transform(F.array(as_list), lambda x: F.map_from_arrays(F.transform(x, lambda _, i: i.cast("string")), x)), F.lit(0))
    values = F.when(F.startswith(F.ltrim(raw), F.lit("[")), of_list).otherwise(as_map)
    title = F.coalesce(F.nullif(F.trim("label"), F.lit("")), _entry(entry, "label"), F.lit(""))
    cube = once(told, [*kept, "dims", "sizes", "dimension"], values=values, title=title, of=F.transform("dims", lambda d: F.try_element_at("dimension", d)["category"]))

    def listed(category: Column) -> Column:
        """The codes of a dimension in their order."""
        index = category["index"]
        in_order = lambda m: F.transform(F.array_sort(F.transform(F.map_entries(m), lambda e: F.named_struct(F.lit("p"), e["value"], F.lit("c"), e["key"]))), lambda e: e["c"])
        return F.when(F.startswith(F.ltrim(index), F.lit("[")), F.from_json(index, "array<string>")).otherwise(in_order(F.from_json(index, "map<string,int>")))

    stride = lambda i: F.aggregate(F.slice("sizes", i + 2, F.greatest(F.size("sizes") - i - 1, F.lit(0))), F.lit(1), lambda a, x: a * x)
    axes = F.transform("of", lambda c, i: F.named_struct(F.lit("name"), F.get("dims", i), F.lit("size"), F.get("sizes", i), F.lit("stride"), stride(i), F.lit("codes"), listed(c), F.lit("captions"), c["label"]))
    units = F.try_element_at("dimension", F.lit("unit"))["category"]["label"]
    rows = once(cube, [*kept, "title", "values"], axes=axes, units=units).select(*kept, "title", "axes", "units", F.explode("values").alias("flat", "raw"))
    place = lambda a: F.floor(F.col("flat").cast("int") / a["stride"]).cast("int") % a["size"]
    # a lambda's variable holds the place, so that it is computed once
    code = lambda a: F.get(F.transform(F.array(place(a)), lambda n: F.coalesce(F.get(a["codes"], n), n.cast("string"))), F.lit(0))
    rows = once(rows, [*kept, "title", "axes", "units"], value=number(F.col("raw")), flat=F.col("flat")).filter("value is not null")
    rows = once(rows, [*kept, "title", "axes", "units", "value"], codes=F.transform("axes", code), names=F.transform("axes", lambda a: a["name"]))
    rows = once(rows, [*kept, "title", "axes", "units", "value", "codes"], at=F.map_from_arrays("names", "codes"))
    time = spec.get("period", "time")
    at = lambda k: F.coalesce(F.try_element_at("at", F.lit(k)), F.lit(""))
    caption = lambda captions, c: F.coalesce(F.try_element_at(captions, c), c)
    unit = F.coalesce(_entry(entry, "unit"), caption(F.col("units"), at("unit")), F.lit(""))
    detail = F.array_join(F.transform("axes", lambda a, i: F.when(~a["name"].isin("freq", "unit", time), caption(a["captions"], F.get("codes", i)))), ", ")
    out = once(
        rows, [*kept, "title", "value"], period=at(time), detail=detail, unit=unit, keys=F.map_filter("at", lambda k, v: ~k.isin("freq", time)),
    ).filter("period <> ''")
    named = F.when(F.col("detail") != "", F.concat("title", F.lit("（"), "detail", F.lit("）"))).otherwise(F.col("title"))
    return out.select(*kept, "period", "value", named.alias("label"), "unit", "keys", F.lit("").alias("note"))


def odata(payloads: DataFrame, spec: dict, entry: dict | Column) -> DataFrame:
    """Points of OData feeds: a row has a column for each series, which `fields` of the entry names."""
    kept = _kept(payloads)
    if isinstance(entry, dict):
        fields = _keys([(k, F.lit(v)) for k, v in entry.get("fields", {}).items()])
    else:
        fields = F.coalesce(F.from_json(_entry(entry, "fields"), "map<string,string>"), F.create_map().cast("map<string,string>"))
    rows = payloads.select(*kept, _or_empty(_entry(entry, "label")).alias("_label"), _or_empty(_entry(entry, "unit")).alias("_unit"), fields.alias("_fields"), F.explode(F.regexp_extract_all("payload", F.lit(r"(?s)<entry(?:\s[^>]*)?>(.*?)</entry\s*>"), 1)).alias("e"))
    found = lambda group: F.regexp_extract_all("e", F.lit(r"(?s)<d:(\w+)(?:\s[^>/]*)?>(.*?)</d:\1\s*>"), group)
    rows = once(rows, [*kept, "_label", "_unit", "_fields"], _names=found(F.lit(1)), _texts=found(F.lit(2)))
    # the first of that name; none is at place 0
    cell = lambda name: F.get("_texts", F.array_position("_names", name).cast("int") - 1)
    rows = once(rows, [*kept, "_label", "_unit", "_fields", "_names", "_texts"], period=F.substring(F.trim(cell(F.lit(spec.get("period", "NEW_DATE")))), 1, 10)).filter("period <> ''")
    rows = rows.select(*kept, "_label", "_unit", "_names", "_texts", "period", F.explode("_fields").alias("tenor", "_column"))
    rows = once(rows, [*kept, "_label", "_unit", "period", "tenor"], value=number(cell(F.col("_column")))).filter("value is not null")
    return rows.select(
        *kept, "period", "value", F.trim(F.concat_ws(" ", "_label", "tenor")).alias("label"), F.col("_unit").alias("unit"), F.create_map(F.lit("tenor"), "tenor").alias("keys"), F.lit("").alias("note"),
    )


def _or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


#: Parsers by format.
PARSERS = {"records": records, "jsonstat": jsonstat, "odata_xml": odata}


#: Fixed texts of a data point's document.
LABELS = {"period": "期間: ", "value": "値: ", "keys": "区分: ", "note": "注記: ", "requested": "取得元: "}


def points(payloads: DataFrame) -> DataFrame:
    """The points of payloads that have no problem. Each brings its spec and, as `part`, its series (both JSON).

    A branch for each spec, that is for each source of statistics, however many series it has.
    """
    # specs come from the registry, a row a source
    specs = sorted(r.spec for r in payloads.select("spec").filter("spec is not null").distinct().collect())
    rows = payloads.withColumn("part", F.coalesce("part", F.lit("{}")))
    found = None
    for text in specs:
        spec = {k: v for k, v in json.loads(text).items() if k != "status_path"}
        mine = rows.filter(F.col("spec") == text)
        mine = mine.withColumn("published_at", T.published(feeds.dig(F.col("payload"), spec["updated_path"])) if spec.get("updated_path") and spec.get("format") != "odata_xml" else F.lit(None).cast("timestamp"))
        made = PARSERS[spec.get("format", "records")](mine, spec, F.col("part")).select(*POINT, "part", "spec", "requested", "published_at")
        found = made if found is None else found.unionByName(made)
    return payloads.sparkSession.createDataFrame([], POINTS) if found is None else found


def documents(found: DataFrame) -> DataFrame:
    """points as raw documents, their addresses by point_url_template of their spec, else the one that was asked."""
    pattern = F.coalesce(F.nullif(F.get_json_object("spec", "$.point_url_template"), F.lit("")), F.col("requested"))
    return point_documents(found, F.col("part"), pattern)


def point_documents(points: DataFrame, entry: dict | Column, url_template: str | Column) -> DataFrame:
    """Points as raw documents. A revised value is a document of its own: the value is part of the identity. Names of the template are the point's keys, else the series' own."""
    pattern = F.lit(url_template) if isinstance(url_template, str) else url_template
    joined = F.array_join(F.map_values("keys"), "/")
    own = F.lit(json.dumps(entry, ensure_ascii=False)) if isinstance(entry, dict) else entry
    value = lambda k: F.when(k == "period", F.col("period")).when(k == "keys", joined).otherwise(F.coalesce(F.try_element_at("keys", k), feeds.json_at(own, F.concat(F.lit("$."), k))))
    url = F.aggregate(F.regexp_extract_all(pattern, F.lit(r"\{(\w+)\}"), F.lit(1)), pattern, lambda text, k: F.replace(text, F.concat(F.lit("{"), k, F.lit("}")), value(k)))
    shown = X.format_value(F.col("value"))
    keys = F.array_join(F.transform(F.map_entries("keys"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ", ")
    line = lambda name, text: F.concat(F.lit(LABELS[name]), text)
    asked = [line("requested", F.col("requested"))] if "requested" in points.columns else []
    body = F.concat_ws("\n", "label", line("period", F.col("period")), F.concat(F.lit(LABELS["value"]), shown, F.lit(" "), "unit"), F.when(F.size("keys") > 0, line("keys", keys)), F.when(F.col("note") != "", line("note", F.col("note"))), *asked)
    at = F.col("published_at") if "published_at" in points.columns else F.lit(None).cast("timestamp")
    rows = points.withColumns({"url": url, "title": F.concat("label", F.lit(" "), "period", F.lit(": "), shown, F.lit(" "), "unit"), "body": body, "canonical_url": X.canonical_url(url), "published_at": at})
    quantity = F.struct("label", "unit", F.coalesce(_entry(entry, "scale"), F.lit("one")).alias("scale"), "period", "value")
    sectors = F.from_json(F.get_json_object(own, "$.sectors"), "array<string>")
    return rows.withColumns({
        "raw_id": ids.raw_id(F.concat_ws("|", "url", F.col("value").cast("string"))), "content_hash": X.content_hash(F.col("title"), F.col("body")), "quantities": F.array(quantity),
        "sector_ids": F.when(F.size(sectors) > 0, sectors),
    }).select(*feeds.RAW)
