"""Signal types, sectors and categories of texts, by patterns folded into the plan as constants."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import text as X


def matching(normal: Column, patterns: Sequence[tuple[str, str | None]]) -> Column:
    """The names whose pattern is found in normalised text, in the order given."""
    return F.array_compact(F.array(*[F.when(F.rlike(normal, F.lit(p)), F.lit(name)) for name, p in patterns if p]))


def signal_types(normal: Column, defaults: Column | None = None, is_statistic: Column | None = None, rules: Mapping[str, Iterable[str]] = fixed.SIGNAL_KEYWORDS) -> Column:
    """Types by keyword, none for statistics, with the source's own; sorted."""
    found = matching(normal, [(name, X.rule_pattern(words)) for name, words in rules.items()])
    if is_statistic is not None:
        found = F.when(F.coalesce(is_statistic, F.lit(False)), F.array().cast("array<string>")).otherwise(found)
    if defaults is not None:
        found = F.array_union(found, F.coalesce(defaults, F.array().cast("array<string>")))
    return F.array_sort(F.array_distinct(found))


def sector_ids(normal: Column, declared: Column | None = None, sectors: Sequence[tuple[str, str, Iterable[str]]] = fixed.SECTORS) -> Column:
    """Sectors by keyword, then those declared that aren't among them."""
    found = matching(normal, [(s, X.topic_pattern(words)) for s, _, words in sectors])
    return found if declared is None else F.array_union(found, F.coalesce(declared, F.array().cast("array<string>")))


def sector_links(ids: Column) -> Column:
    return F.transform(ids, lambda s: F.struct(s.alias("sector_id"), F.lit("unclassified").alias("relation"), F.lit("low").alias("confidence")))


def category(types: Column, source_categories: Column) -> Column:
    """By the first group of signal types that is met; else the source's first category."""
    out = None
    for names, value in fixed.CATEGORY_OF:
        hit = F.arrays_overlap(types, F.array(*map(F.lit, names)))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(F.coalesce(F.get(source_categories, F.lit(0)), F.lit("market_data")))


def actor_kind(tier: Column, reliability: Column, publisher: Column, name: Column) -> Column:
    whole = F.lower(F.concat_ws(" ", F.coalesce(publisher, F.lit("")), name))
    public = F.lit(False)
    for part in fixed.PUBLIC_BODY:
        public = public | F.contains(whole, F.lit(part))
    first = (tier == "tier1") & (reliability == "A")
    return F.when(first & public, "government").when(first, "company").otherwise("institution")


def confidence(reliability: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in fixed.CONFIDENCE_OF.items() for x in pair]), reliability)
