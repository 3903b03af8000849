"""RSS, Atom and JSON payloads as raw documents.

Payloads come as a table (source_id, payload, observed_at): fetching is the caller's. Parsing is by XPath and
JSON functions, so it runs where the payloads are. A payload that isn't a feed, or has no entries, is told by `problem`.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ids
from tidemark.functions import text as X
from tidemark.functions import time as T
from tidemark.sources.shared import once

RAW = ["raw_id", "source_id", "observed_at", "published_at", "url", "canonical_url", "title", "body", "content_hash", "quantities", "sector_ids"]


def problem(payload: Column) -> Column:
    """Why a payload is no feed: html, or empty; else null."""
    head = F.lower(F.ltrim(F.substring(payload, 1, 500)))
    entries = F.regexp_count(payload, F.lit(r"<(?:\w+:)?(?:item|entry)[\s>]"))
    return F.when(F.startswith(head, F.lit("<!doctype html")) | F.startswith(head, F.lit("<html")), "html").when(F.coalesce(entries, F.lit(0)) == 0, "empty")


def _cdata(raw: Column) -> Column:
    """What a tag's content holds as CDATA; null where it is no CDATA."""
    return F.when(F.contains(raw, F.lit("<![CDATA[")), F.nullif(F.regexp_extract(raw, r"(?s)^\s*<!\[CDATA\[(.*?)\]\]>\s*$", 1), F.lit("")))


def _own_names(payload: Column) -> Column:
    """The payload with the feed's own namespace as the default: prefixes that are bound to Atom or to RSS 1.0 go."""
    bound = F.regexp_extract_all(payload, F.lit(r"xmlns:([\w.-]+)\s*=\s*[\"'](?:http://www\.w3\.org/2005/Atom|http://purl\.org/rss/1\.0/)[\"']"), 1)
    plain = F.aggregate(bound, payload, lambda text, prefix: F.regexp_replace(text, F.concat(F.lit("(</?)"), prefix, F.lit(r":(?=\w)")), F.lit("$1")))
    return F.when(F.rlike(payload, F.lit(r"<[\w.-]+:(?:item|entry|feed|RDF)[\s>]")), plain).otherwise(payload)


def feed_entries(payloads: DataFrame, keep: Sequence[str] = ("source_id",)) -> DataFrame:
    """observed_at, link, title, body, published_at and the columns to keep, of every entry that has a link and a title."""
    items, entries = (F.regexp_extract_all("payload", F.lit(rf"(?s)<{n}(?:\s[^>]*)?>(.*?)</{n}\s*>"), 1) for n in ("item", "entry"))
    # entries count only where there are no items
    entry = F.explode(F.when(F.size(items) > 0, items).otherwise(entries))
    rows = payloads.withColumn("payload", _own_names(F.col("payload"))).select(*keep, "observed_at", entry.alias("entry"))
    # each step is computed once an entry: contents of tags, what is CDATA, their text; references of texts and of the address are resolved in this one step
    tags = ("link", "guid", "title", "description", "summary", "content", "content:encoded", "pubDate", "published", "updated", "dc:date")
    links = F.regexp_extract_all("entry", F.lit(r"(<link\s[^>]*>)"), 1)
    raw = {f"_{i}": F.nullif(F.regexp_extract("entry", rf"(?s)<{t}(?:\s[^>]*)?>(.*?)</{t}\s*>", 1), F.lit("")) for i, t in enumerate(tags)}
    kept = [*keep, "observed_at"]
    rows = once(rows, kept, _links=links, **raw)
    alternate = F.filter("_links", lambda x: F.contains(x, F.lit("href")) & (~F.rlike(x, F.lit(r"\brel\s*=")) | F.rlike(x, F.lit(r"\brel\s*=\s*[\"']alternate[\"']"))))
    href = F.when(F.size("_links") > 0, F.nullif(F.regexp_extract(F.coalesce(F.get(alternate, F.lit(0)), F.lit("")), r"href\s*=\s*[\"']([^\"']*)[\"']", 1), F.lit("")))
    rows = once(rows, [*kept, *raw], _href=href, **{f"_cdata{n}": _cdata(F.col(n)) for n in raw})
    has = F.contains("_href", F.lit("&"))
    href = F.coalesce(F.when(~has, F.col("_href")), X._unescape(F.when(has, F.col("_href"))))
    texts = {n: X.content_of(F.coalesce(f"_cdata{n}", n), F.col(f"_cdata{n}").isNotNull()) for n in raw}
    rows = once(rows, kept, _href=href, **{n: F.nullif(c, F.lit("")) for n, c in texts.items()})
    text = {t: F.col(n) for t, n in zip(tags, raw, strict=True)}
    link = F.coalesce(text["link"], F.nullif("_href", F.lit("")), F.when(F.startswith(text["guid"], F.lit("http")), text["guid"]))
    rows = once(rows.filter(text["title"].isNotNull()), [*kept, *raw], link=link).filter("link is not null")
    body = F.coalesce(*[text[t] for t in ("description", "summary", "content", "content:encoded")], F.lit(""))
    when = F.coalesce(*[T.feed_time(text[t]) for t in ("pubDate", "published", "updated", "dc:date")])
    return once(rows, [*kept, "link"], title=text["title"], body=body, published_at=when)


def _path(path: str) -> str:
    return "$" + "".join(f"[{p}]" if p.isdigit() else f".{p}" for p in path.split("."))


def dig(document: Column, path: str) -> Column:
    """A dotted path into JSON text. Numbers index arrays, negative ones from the end."""
    parts = path.split(".")
    for i, p in enumerate(parts):
        if re.fullmatch(r"-\d+", p):
            head = F.get_json_object(document, _path(".".join(parts[:i]))) if i else document
            item = F.try_element_at(F.from_json(head, "array<string>"), F.lit(int(p)))
            return dig(item, ".".join(parts[i + 1 :])) if parts[i + 1 :] else item
    return F.get_json_object(document, _path(path))


def first_text(item: Column, paths: str | Sequence[str]) -> Column:
    found = [F.trim(dig(item, p)) for p in ([paths] if isinstance(paths, str) else paths)]
    return F.coalesce(*[F.when(x != "", x) for x in found], F.lit(""))


def joined_text(item: Column, paths: Sequence[str]) -> Column:
    return F.concat_ws("\n\n", *[F.nullif(F.trim(dig(item, p)), F.lit("")) for p in paths])


def template(item: Column, pattern: str) -> Column:
    """A template with {names} filled from the item; empty if one is missing."""
    parts = re.split(r"\{(\w+)\}", pattern)
    return F.coalesce(F.concat(*[F.lit(p) if i % 2 == 0 else dig(item, p) for i, p in enumerate(parts) if p or i % 2]), F.lit(""))


def json_entries(payloads: DataFrame, mapping: dict) -> DataFrame:
    """Entries of JSON payloads by a mapping: items_path, url or url_template, title, body, published_at."""
    items = dig(F.col("payload"), mapping["items_path"]) if mapping.get("items_path") else F.col("payload")
    rows = payloads.select("source_id", "observed_at", F.explode(F.from_json(items, "array<string>")).alias("item"))
    item = F.col("item")
    link = template(item, mapping["url_template"]) if mapping.get("url_template") else first_text(item, mapping.get("url", "url"))
    body = mapping.get("body", [])
    when = T.published(dig(item, mapping["published_at"])) if mapping.get("published_at") else F.lit(None).cast("timestamp")
    out = rows.select("source_id", "observed_at", link.alias("link"), first_text(item, mapping.get("title", "title")).alias("title"), (joined_text(item, [body] if isinstance(body, str) else body) if body else F.lit("")).alias("body"), when.alias("published_at"))
    return out.filter("link <> '' and title <> ''")


def json_at(document: Column, path: Column) -> Column:
    """get_json_object by a path that a row brings."""
    return F.call_function("get_json_object", document, path)


def dig_by(document: Column, path: Column) -> Column:
    """A dotted path that a row brings, into JSON text. Numbers index arrays; one from the end may come first or last."""
    plain = lambda p: F.concat(F.lit("$"), F.regexp_replace(F.concat(F.lit("."), p), r"\.(\d+)(?=\.|$)", "[$1]"))
    head = F.regexp_extract(path, r"^(?:(.*?)\.)?-\d+(?:\.(.*))?$", 1)
    rest = F.regexp_extract(path, r"^(?:(.*?)\.)?-\d+(?:\.(.*))?$", 2)
    nth = F.regexp_extract(path, r"(?:^|\.)(-\d+)(?:\.|$)", 1)
    items = F.from_json(F.when(head == "", document).otherwise(json_at(document, plain(head))), "array<string>")
    item = F.try_element_at(items, F.when(nth != "", nth.cast("int")))
    return F.when(nth == "", json_at(document, plain(path))).otherwise(F.when(rest == "", item).otherwise(json_at(item, plain(rest))))


def _paths(spec: Column, name: str, default: str | None = None) -> Column:
    """One path or several of a spec, as a list."""
    given = F.get_json_object(spec, f"$.{name}")
    listed = F.when(F.startswith(given, F.lit("[")), F.from_json(given, "array<string>")).when(given != "", F.array(given))
    return F.coalesce(listed, F.array(F.lit(default)) if default else F.array().cast("array<string>"))


def status_by(payload: Column, spec: Column) -> Column:
    """Why a payload's body tells of a failure, by the status that its spec names; null where it doesn't."""
    path, fine = F.get_json_object(spec, "$.status_path"), F.from_json(F.get_json_object(spec, "$.status_ok"), "array<string>")
    status = F.coalesce(dig_by(payload, path), F.lit(""))
    told = dig_by(payload, F.coalesce(F.get_json_object(spec, "$.status_message_path"), F.lit("message")))
    message = F.coalesce(F.when(F.startswith(told, F.lit("[")), F.array_join(F.from_json(told, "array<string>"), "; ")), told)
    return F.when((F.size(fine) > 0) & ~F.array_contains(fine, status), F.concat_ws(": ", F.nullif(status, F.lit("")), message))


def _items(payload: Column, spec: Column) -> Column:
    path = F.nullif(F.get_json_object(spec, "$.items_path"), F.lit(""))
    return F.from_json(F.when(path.isNull(), payload).otherwise(dig_by(payload, path)), "array<string>")


def json_problem(payload: Column, spec: Column) -> Column:
    """Why a payload gives no entries: no JSON, a status that tells of a failure, no list, or nothing in it."""
    items = _items(payload, spec)
    return F.coalesce(F.when(F.try_parse_json(payload).isNull(), "not JSON"), status_by(payload, spec), F.when(items.isNull(), "no list of items"), F.when(F.size(items) == 0, "empty"))


def mapped_entries(payloads: DataFrame, keep: Sequence[str] = ("source_id",)) -> DataFrame:
    """Like json_entries, by the mapping that each row brings as `spec` (JSON)."""
    rows = payloads.select(*keep, "observed_at", "spec", F.explode(_items(F.col("payload"), F.col("spec"))).alias("item"))
    item, spec = F.col("item"), F.col("spec")
    texts = lambda paths: F.filter(F.transform(paths, lambda p: F.trim(dig_by(item, p))), lambda x: x != "")
    first = lambda paths: F.coalesce(F.get(texts(paths), F.lit(0)), F.lit(""))
    pattern = F.nullif(F.get_json_object(spec, "$.url_template"), F.lit(""))
    names = F.regexp_extract_all(pattern, F.lit(r"\{(\w+)\}"), F.lit(1))
    filled = F.aggregate(names, pattern, lambda text, n: F.replace(text, F.concat(F.lit("{"), n, F.lit("}")), dig_by(item, n)))
    link = F.when(pattern.isNotNull(), F.coalesce(filled, F.lit(""))).otherwise(first(_paths(spec, "url", "url")))
    out = rows.select(*keep, "observed_at", link.alias("link"), first(_paths(spec, "title", "title")).alias("title"), F.array_join(texts(_paths(spec, "body")), "\n\n").alias("body"), T.published(dig_by(item, F.get_json_object(spec, "$.published_at"))).alias("published_at"))
    return out.filter("link <> '' and title <> ''")


def raw_documents(entries: DataFrame) -> DataFrame:
    """Entries as raw documents with their identity."""
    url = X.canonical_url(F.col("link"))
    none = {"quantities": F.lit(None).cast("array<struct<label:string,unit:string,scale:string,period:string,value:double>>"), "sector_ids": F.lit(None).cast("array<string>")}
    out = entries.withColumns({"url": F.col("link"), "canonical_url": url, "raw_id": ids.raw_id(url), "content_hash": X.content_hash(F.col("title"), F.col("body"))})
    return out.withColumns({k: v for k, v in none.items() if k not in entries.columns}).select(*RAW)
