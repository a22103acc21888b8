"""Column headings."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame


def heading_rule(spaces: str) -> Callable[[str], str]:
    """A rule for headings: lower case, trimmed, without line breaks, and each space inside written as `spaces`."""

    def rule(name: str) -> str:
        words = re.sub(r"[\r\n]", "", name).strip(" \t\x0b\x0c").lower()
        return words.translate({ord(" "): spaces})

    return rule


squeeze = heading_rule("")
snake = heading_rule("_")


def underscore(name: str) -> str:
    """Every character outside letters, digits and `_` becomes `_`."""
    return re.sub(r"[^A-Za-z0-9_]", "_", name).lower()


def distinct_names(names: list[str]) -> list[str]:
    """A repeated name gets `_2`, `_3` and so on, skipping names already taken."""
    taken, out = set(names), []
    seen: set[str] = set()
    for name in names:
        new, n = name, 1
        while new in seen or (n > 1 and new in taken):
            n += 1
            new = f"{name}_{n}"
        seen.add(new)
        out.append(new)
    return out


def rename_all(df: DataFrame, rule) -> DataFrame:
    """All headings through `rule` at once."""
    return df.toDF(*distinct_names([rule(c) for c in df.columns]))


def name_blank(df: DataFrame, name: str, first_only: bool = True) -> DataFrame:
    """Call a blank heading `name`. Spark shows an empty heading in position i as `_ci`."""
    new = []
    for i, c in enumerate(df.columns):
        blank = not c.strip() or c == f"_c{i}"
        new.append(name if blank and (i == 0 or not first_only) else c)
    return df.toDF(*distinct_names(new))


def drop_spill(df: DataFrame, known: int) -> DataFrame:
    """Drop the unnamed columns Spark adds behind the `known` ones (`_c24` and on, for 24 known)."""
    return df.drop(*[c for i, c in enumerate(df.columns) if i >= known and c == f"_c{i}"])
