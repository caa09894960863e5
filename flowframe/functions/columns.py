"""Turn user settings (Spark SQL text or ``Column``) into columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEADERS_TYPE = "map<string,string>"

# Space and the control characters below it.
BLANKS = "".join(chr(code) for code in range(1, 33))


def as_col(value: str | Column) -> Column:
    """Spark SQL text or a ``Column``, as a ``Column``."""
    return F.expr(value) if isinstance(value, str) else value


def fixed_or_expr(fixed: str | None, expression: str | Column | None, what: str) -> Column:
    """One of a literal and an expression; giving both, or neither, is an error."""
    if (fixed is None) == (expression is None):
        raise ValueError(f"give exactly one of a fixed {what} and a {what} expression")
    return F.lit(fixed) if expression is None else as_col(expression)


def strip(value: Column) -> Column:
    """The text without leading and trailing blanks of any kind."""
    return F.btrim(value, F.lit(BLANKS))


def text_of(data: Column, charset: str = "UTF-8") -> Column:
    """Bytes as text; in UTF-8 bytes that fit no character become U+FFFD."""
    if charset.upper() == "UTF-8":
        return F.make_valid_utf8(data.cast("string"))
    return F.decode(data, charset)


def text_or_null(value: Column) -> Column:
    """Null where the text is null, empty or only white space."""
    return F.when(strip(value) != "", value)


def headers_of(pairs: dict[str, str | Column]) -> Column:
    """A header map column from name to expression pairs."""
    if not pairs:
        return F.create_map().cast(HEADERS_TYPE)
    entries = []
    for name, value in pairs.items():
        entries += [F.lit(name), as_col(value).cast("string")]
    return F.create_map(*entries)


def content_type_of(headers: str = "headers") -> Column:
    """The ``contentType`` header; JSON where it is absent."""
    return F.coalesce(F.col(headers)["contentType"], F.lit("application/json"))


def is_text_like(headers: str = "headers", markers: tuple[str, ...] = ("text", "json")) -> Column:
    """True where the content type holds one of the text markers."""
    kind = content_type_of(headers)
    found = F.lit(False)
    for marker in markers:
        found = found | kind.contains(marker)
    return found
