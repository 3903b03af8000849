"""JSON Schema compiled to a column: the violations of a document, each with its path, keyword and detail.

A schema becomes one expression over the parsed document (VARIANT); nested arrays are walked by higher-order functions, so
documents stay in their rows. Keywords: type, enum, const, required, properties, additionalProperties, items, pattern, minLength,
maxLength, minimum, maximum, minItems, maxItems, allOf, anyOf, if/then/else, and $ref to $defs of the schema or of other ones by name. Formats
are annotations. A keyword that isn't known, other than annotations, is an error, as is a schema that refers to itself.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

VIOLATION = "array<struct<path:string,rule:string,detail:string>>"
ANNOTATIONS = {"$schema", "$id", "$defs", "$comment", "title", "description", "default", "examples", "format", "deprecated"}
KNOWN = {"type", "enum", "const", "required", "properties", "additionalProperties", "items", "pattern", "minLength", "maxLength", "minimum", "maximum", "minItems", "maxItems", "allOf", "anyOf", "if", "then", "else", "$ref"}


def _none() -> Column:
    return F.array().cast(VIOLATION)


def _found(path: Column, rule: str, detail: Column) -> Column:
    return F.struct(path.alias("path"), F.lit(rule).alias("rule"), detail.cast("string").alias("detail"))


def _kind(value: Column) -> Column:
    """The JSON type of a value; whole numbers are integers."""
    told = F.schema_of_variant(value)
    number = F.try_variant_get(value, "$", "double")
    return (
        F.when(F.startswith(told, F.lit("OBJECT")), "object").when(F.startswith(told, F.lit("ARRAY")), "array").when(told == "STRING", "string").when(told == "BOOLEAN", "boolean")
        .when(told == "VOID", "null").when(number == F.floor(number), "integer").otherwise("number")
    )


class Compiler:
    """files: the other schemas that this one may refer to, by name."""

    def __init__(self, schema: dict, files: Mapping[str, dict] | None = None):
        self.files = {"": schema, **(files or {})}

    def resolve(self, ref: str, home: str) -> tuple[dict, str]:
        name, _, pointer = ref.partition("#")
        home = name or home
        if home not in self.files:
            raise ValueError(f"no schema {home!r}")
        node: Any = self.files[home]
        for part in filter(None, pointer.split("/")):
            node = node[part]
        return node, home

    def at(self, schema: dict | bool, value: Column, path: Column, home: str, above: tuple[str, ...]) -> Column:
        """The violations of a value that is there. The value and its kind are computed once, as variables of a lambda."""
        if schema is True or schema == {}:
            return _none()
        if schema is False:
            return F.array(_found(path, "false", F.to_json(value)))
        bound = F.transform(F.array(value), lambda v: F.struct(v.alias("v"), _kind(v).alias("k"), path.alias("p")))
        return F.flatten(F.transform(bound, lambda b: self.checks(schema, b["v"], b["k"], b["p"], home, above)))

    def checks(self, schema: dict, v: Column, kind: Column, path: Column, home: str, above: tuple[str, ...]) -> Column:
        odd = set(schema) - KNOWN - ANNOTATIONS
        if odd:
            raise ValueError(f"keywords that aren't known: {sorted(odd)}")
        flat: list[Column] = []
        parts: list[Column] = []

        def broken(rule: str, when: Column, detail: Column) -> None:
            flat.append(F.when(F.coalesce(when, F.lit(False)), _found(path, rule, detail)))

        text = F.when(kind == "string", F.try_variant_get(v, "$", "string"))
        number = F.when(kind.isin("integer", "number"), F.try_variant_get(v, "$", "double"))
        shown = F.coalesce(text, F.to_json(v))
        if "type" in schema:
            allowed = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
            broken("type", ~kind.isin(*allowed, *(["integer"] if "number" in allowed else [])), kind)
        if "enum" in schema:
            broken("enum", ~F.to_json(v).isin(*[json.dumps(x, ensure_ascii=False) for x in schema["enum"]]), shown)
        if "const" in schema:
            broken("const", F.to_json(v) != json.dumps(schema["const"], ensure_ascii=False), shown)
        if "pattern" in schema:
            broken("pattern", ~F.rlike(text, F.lit(schema["pattern"])), text)
        for rule, compare in (("minLength", F.length(text) < schema.get("minLength", 0)), ("maxLength", F.length(text) > schema.get("maxLength", 0)), ("minimum", number < schema.get("minimum", 0)), ("maximum", number > schema.get("maximum", 0))):
            if rule in schema:
                broken(rule, compare, shown)
        items = F.when(kind == "array", F.try_variant_get(v, "$", "array<variant>"))
        for rule, compare in (("minItems", F.size(items) < schema.get("minItems", 0)), ("maxItems", F.size(items) > schema.get("maxItems", 0))):
            if rule in schema:
                broken(rule, items.isNotNull() & compare, F.size(items))
        member = lambda name: F.try_variant_get(v, f'$["{name}"]', "variant")
        for name in schema.get("required", []):
            broken("required", (kind == "object") & member(name).isNull(), F.lit(name))
        properties = schema.get("properties", {})
        for name, sub in properties.items():
            parts.append(F.when((kind == "object") & member(name).isNotNull(), self.at(sub, member(name), F.concat(path, F.lit(f".{name}")), home, above)).otherwise(_none()))
        more = schema.get("additionalProperties", True)
        if more is not True:
            members = F.when(kind == "object", F.try_variant_get(v, "$", "map<string,variant>"))
            names = F.array_except(F.coalesce(F.map_keys(members), F.array().cast("array<string>")), F.array(*map(F.lit, properties)).cast("array<string>"))
            where = lambda n: F.concat(path, F.lit("."), n)
            if more is False:
                parts.append(F.transform(names, lambda n: _found(where(n), "additionalProperties", n)))
            else:
                parts.append(F.flatten(F.transform(names, lambda n: self.at(more, F.try_element_at(members, n), where(n), home, above))))
        if "items" in schema:
            each = F.transform(F.coalesce(items, F.array().cast("array<variant>")), lambda x, i: self.at(schema["items"], x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), home, above))
            parts.append(F.flatten(each))
        if "$ref" in schema:
            name = f"{home}:{schema['$ref']}"
            if name in above:
                raise ValueError(f"a schema that refers to itself: {schema['$ref']}")
            sub, there = self.resolve(schema["$ref"], home)
            parts.append(self.at(sub, v, path, there, (*above, name)))
        inner = lambda sub: self.at(sub, v, path, home, above)
        parts += [inner(sub) for sub in schema.get("allOf", [])]
        if "anyOf" in schema:
            broken("anyOf", F.forall(F.array(*[F.size(inner(s)) for s in schema["anyOf"]]), lambda n: n > 0), shown)
        if "if" in schema:
            holds = F.size(inner(schema["if"])) == 0
            parts.append(F.when(holds, inner(schema.get("then", True))).otherwise(inner(schema.get("else", True))))
        return F.concat(F.array_compact(F.array(*flat)) if flat else _none(), *parts)


def violations(document: Column, schema: dict, files: Mapping[str, dict] | None = None) -> Column:
    """The violations of a document (JSON text); text that is null or no JSON is one of them."""
    whole = F.try_parse_json(document)
    return F.when(whole.isNull(), F.array(_found(F.lit("$"), "not_json", F.lit(None)))).otherwise(Compiler(schema, files).at(schema, whole, F.lit("$"), "", ()))
