"""Names of derived features, and the way back to their source column."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Suffixes of the features made from a number column.
AGGREGATES = ("mean", "max", "last", "diff")


def numeric_feature(col: str, how: str) -> str:
    return f"{col}_{how}"


def share_feature(col: str, level: str) -> str:
    return f"{col}_{level}"


def last_feature(col: str) -> str:
    return f"{col}_last"


def feature_names(numeric: list[str], vocabulary: dict[str, list[str]]) -> list[str]:
    """Every feature of a collapse, in output order. Raises on a name clash."""
    names = [numeric_feature(c, how) for c in numeric for how in AGGREGATES]
    names += [share_feature(c, level) for c, levels in vocabulary.items() for level in levels]
    names += [last_feature(c) for c in vocabulary]
    clashes = sorted({n for n in names if names.count(n) > 1}) if len(set(names)) < len(names) else []
    if clashes:
        raise ValueError(f"feature names clash: {clashes[:5]}")
    return names


def base_column(feature: Column, cat_cols: list[str] | tuple[str, ...]) -> Column:
    """The source column a feature was derived from.

    Category columns go by prefix, so a level that looks like an aggregate
    suffix stays with its column; number columns lose their suffix.
    """
    stripped = F.regexp_replace(feature, f"_({'|'.join(AGGREGATES)})$", "")
    if not cat_cols:
        return stripped
    owner = F.regexp_extract(feature, f"^({'|'.join(map(re.escape, cat_cols))})_", 1)
    return F.when(owner != "", owner).otherwise(stripped)
