"""File-name and header-name patterns as regular expressions."""

from __future__ import annotations

import re


def ant_to_regex(pattern: str) -> str:
    """Ant path pattern (``?``, ``*``, ``**``) as an anchored regular expression."""
    pieces = []
    for token in re.findall(r"\*\*/|\*\*|\*|\?|[^*?]+", pattern):
        match token:
            case "**/":
                pieces.append("(?:[^/]+/)*")
            case "**":
                pieces.append(".*")
            case "*":
                pieces.append("[^/]*")
            case "?":
                pieces.append("[^/]")
            case _:
                pieces.append(quote(token))
    return "^" + "".join(pieces) + "$"


def simple_pattern(name: str) -> str:
    """A name in which ``*`` stands for any run of characters, as a regular expression."""
    return "^" + ".*".join(quote(part) for part in name.split("*")) + "$"


def quote(text: str) -> str:
    """Escape everything that is special in both Java and RE2 regular expressions."""
    return re.sub(r"([\\.\[\]{}()^$|+*?])", r"\\\1", text)


def full_match(pattern: str) -> str:
    """Anchor a user's regular expression at both ends."""
    return f"^(?:{pattern})$"


def names_of(setting: str | list[str]) -> list[str]:
    """Comma or space separated names, or a list, as a list."""
    if isinstance(setting, str):
        return [name for name in re.split(r"[,\s]+", setting) if name]
    return list(setting)
