"""Named steps chained with a pipe into one DataFrame plan."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame

Step = Callable[[DataFrame], DataFrame]


def compose(definition: str, steps: dict[str, Step]) -> Step:
    """``"a|b|c"`` as one step: the named steps applied from left to right."""
    names = [name.strip() for name in definition.split("|")]
    unknown = [name for name in names if name not in steps]
    if unknown:
        raise KeyError(f"no step named {', '.join(unknown)}")
    chain = [steps[name] for name in names]
    return lambda df: reduce(DataFrame.transform, chain, df)
