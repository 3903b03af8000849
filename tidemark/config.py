"""Rules that a folder may bring: keywords of signal types and the sectors that are watched."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from tidemark import fixed

Sectors = tuple[tuple[str, str, tuple[str, ...]], ...]


@dataclass(frozen=True)
class Rules:
    """signal_types: keywords by type; sectors: id, name and keywords."""

    signal_types: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(fixed.SIGNAL_KEYWORDS))
    sectors: Sectors = fixed.SECTORS


def parse(text: str) -> Rules:
    """Rules from JSON: {"signal_types": {type: [keywords]}, "sectors": [{"sector_id", "name", "keywords"}]}, either of which may be left out."""
    given = json.loads(text)
    odd = set(given) - {"signal_types", "sectors"}
    if odd:
        raise ValueError(f"rules that aren't known: {sorted(odd)}")
    words = lambda x: tuple(w.lower() for w in x)
    made = Rules()
    types = {k: words(v) for k, v in given["signal_types"].items()} if "signal_types" in given else made.signal_types
    sectors = tuple((s["sector_id"], s["name"], words(s.get("keywords", []))) for s in given["sectors"]) if "sectors" in given else made.sectors
    ids = [s for s, _, _ in sectors]
    if len(set(ids)) != len(ids) or not all(s.startswith("sec_") for s in ids):
        raise ValueError("sectors need ids of their own that begin with sec_")
    return Rules(types, sectors)


def load(root: str) -> Rules:
    """The rules of a data folder's rules.json, the library's own where there is none."""
    path = Path(root, "rules.json")
    return parse(path.read_text(encoding="utf-8")) if path.is_file() else Rules()
