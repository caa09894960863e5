"""Short text settings parsed once, before any plan is built."""

from __future__ import annotations

import re


def parse_column_map(setting: str) -> dict[str, str]:
    """``col:expr, col`` as an ordered mapping; a backslash keeps a comma or colon."""
    mapping: dict[str, str] = {}
    for item in re.split(r"(?<!\\),", setting):
        item = item.strip().replace("\\,", ",")
        if not item:
            continue
        sides = [side.strip().replace("\\:", ":") for side in re.split(r"(?<!\\):", item)]
        if len(sides) > 2:
            raise ValueError(f"'{item}' is neither 'column' nor 'column:expression'")
        mapping[sides[0]] = sides[-1]
    return mapping


def parse_kv_list(setting: str) -> dict[str, str]:
    """``a=v1,v2,b=o1`` as a mapping; a comma ends a pair only before another ``key=``."""
    pairs = (pair.partition("=") for pair in re.split(r",(?=[^,]*=)", setting) if "=" in pair)
    return {key.strip(): value.strip() for key, _, value in pairs}
