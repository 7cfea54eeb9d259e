"""Rule packs: named rule lists stored as JSON next to this module.

A pack is configuration; running it over a table is the rule engine's job.
Packs are looked up by id (clinical, financial, inventory, web_analytics,
generic), not by their ``domain`` label.

Fixed values: the rule ids, column patterns, bounds and value lists in the JSON
files; they decide which rows are flagged.
"""

from __future__ import annotations

import copy
import json
from collections.abc import Iterable, Mapping
from functools import lru_cache
from pathlib import Path

PACK_DIR = Path(__file__).resolve().parent
PACK_IDS = ("clinical", "financial", "inventory", "web_analytics", "generic")


@lru_cache(maxsize=None)
def _load(pack_id: str) -> dict:
    return json.loads((PACK_DIR / f"{pack_id}.json").read_text(encoding="utf-8"))


def all_packs() -> dict[str, dict]:
    return {k: copy.deepcopy(_load(k)) for k in PACK_IDS}


def get_pack(pack_id: str, fallback: bool = False) -> dict:
    """Pack by id. Unknown ids raise, unless ``fallback`` (auto-detection) asks for the generic pack."""
    key = (pack_id or "").lower()
    if key in PACK_IDS:
        return copy.deepcopy(_load(key))
    if fallback:
        return copy.deepcopy(_load("generic"))
    raise KeyError(f"unknown rule pack {pack_id!r}; known: {', '.join(PACK_IDS)}")


def rule_counts() -> dict[str, int]:
    """Pack id -> number of rules."""
    return {pack_id: len(_load(pack_id)["rules"]) for pack_id in PACK_IDS}


def adapted(base: str, on: Iterable[str] = (), off: Iterable[str] = (),
            changes: Mapping[str, Mapping] | None = None) -> list[dict]:
    """The rules of pack ``base`` with some switched on or ``off`` (which wins) and settings changed by rule id."""
    switch = dict.fromkeys(on, True) | dict.fromkeys(off, False)
    changes = changes or {}
    return [rule | ({"enabled": switch[rule["id"]]} if rule["id"] in switch else {})
            | copy.deepcopy(dict(changes.get(rule["id"], {})))
            for rule in get_pack(base)["rules"]]


def load_rules(path: str | Path) -> list[dict]:
    """Rules from a JSON file holding either a pack object (with ``rules``) or a bare list."""
    data = json.loads(Path(path).read_text(encoding="utf-8"))
    if isinstance(data, list):
        return data
    if isinstance(data, dict):
        return list(data.get("rules", []))
    raise ValueError(f"{path}: expected a JSON list of rules or an object with 'rules'")
