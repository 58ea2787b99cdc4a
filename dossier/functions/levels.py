"""Category levels: labels, missing values, natural order and codes."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F, types as T

# A number as plain text. Guards the cast below, which would also take "1d".
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# A whole number as it is written by its label.
WHOLE = re.compile(r"0|-?[1-9]\d*")

_EXACT_LONG = 9.0e15
_EXACT_DECIMAL = 1.0e37


def is_fractional(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def present(col: Column, dtype: T.DataType) -> Column:
    """NaN as NULL, so that aggregates skip it."""
    if is_fractional(dtype):
        return F.nanvl(col, F.lit(None).cast(dtype))
    return col


def level_label(col: Column, dtype: T.DataType) -> Column:
    """The text of a level; whole floats lose their ``.0`` and NaN is NULL."""
    if isinstance(dtype, T.BooleanType):
        return F.initcap(col.cast("string"))
    if not is_fractional(dtype):
        return col.cast("string")
    value = present(col, dtype)
    whole = value == F.rint(value)
    return (
        F.when(whole & (F.abs(value) < _EXACT_LONG), value.cast("bigint").cast("string"))
        .when(whole & (F.abs(value) < _EXACT_DECIMAL),
              value.cast("decimal(38,0)").cast("string"))
        .otherwise(value.cast("string")))


def folded_label(col: Column, dtype: T.DataType, missing: str) -> Column:
    """The level label with null, NaN and the empty string all as ``missing``."""
    return F.coalesce(F.nullif(level_label(col, dtype), F.lit("")), F.lit(missing))


def level_order(label: Column) -> list[Column]:
    """Sort keys: levels that read as numbers first, by value; then the rest."""
    number = F.when(label.rlike(NUMBER), label.try_cast("double"))
    return [number.isNull(), number, label]


def level_code(col: Column, dtype: T.DataType, levels: list[str], missing: str) -> Column:
    """Index of the row's level in ``levels``; unseen levels get the missing code.

    A number column with whole-number levels is matched by value, so the usual
    case builds no text per row; anything else is matched by its label.
    """
    known = {level: code for code, level in enumerate(levels) if level != missing}
    if not known:
        return F.lit(len(levels) - 1)
    whole = all(WHOLE.fullmatch(level) and abs(int(level)) < _EXACT_LONG for level in known)
    if whole and isinstance(dtype, T.IntegralType):
        value, wanted = col.cast("bigint"), [F.lit(int(v)).cast("bigint") for v in known]
    elif whole and is_fractional(dtype):
        value, wanted = present(col, dtype).cast("double"), [F.lit(float(v)) for v in known]
    else:
        value, wanted = level_label(col, dtype), [F.lit(v) for v in known]
    place = F.array_position(F.array(*wanted), value)
    codes = F.array(*[F.lit(code) for code in known.values()])
    return F.coalesce(F.get(codes, (place - 1).cast("int")), F.lit(len(levels) - 1))
