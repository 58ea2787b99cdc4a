"""Reading statements, labels and feature tables."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# A value's text may be read as some of these; a column is what all of its values may be read as.
WHOLE, FRACTION, DAY, MOMENT = 1, 2, 4, 8
PROBED_TYPES = ((WHOLE, "bigint"), (DAY, "date"), (MOMENT, "timestamp"), (FRACTION, "double"))
ANY = WHOLE | FRACTION | DAY | MOMENT
# Beside the types: bytes that are no text.
ODD = 16
# Only texts that the number gives back: no sign but a minus, no leading zeros, no suffix letters.
SHORT_WHOLE = "^(0|-?[1-9][0-9]{0,14})$"       # also exact as a double
LONG_WHOLE = "^-?[1-9][0-9]{15,18}$"
NUMBER = ("^(-?((0|[1-9][0-9]*)([.][0-9]*)?|[.][0-9]+)([eE][-+]?[0-9]{1,2})?|NaN|nan|-?(Infinity|inf))$")
DATE_TEXT = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
TIME_TEXT = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[T ][0-9]"
# Control characters, and the mark a decoder leaves for bytes that are no text.
NOT_TEXT = "[\\x00-\\x08\\x0E-\\x1F\uFFFD]"


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A parquet table; naming columns narrows the scan."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, probed: bool = False) -> DataFrame:
    """A CSV table under a fixed schema: no inference pass, and splits read in parallel.

    A value that is not of its column's type, or a row with too many or too few
    values, fails the job; nothing but an empty text is turned into a null, and no number into another.
    ``probed`` says that ``probe_schema`` found the schema, so that values need no second test.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = (spark.read.schema(texts).option("header", True).option("enforceSchema", False)
           .option("mode", "FAILFAST").csv(path))
    return raw.select(*[_typed(F.col(f"`{f.name}`"), f, probed) for f in schema.fields])


def readable_as(text: Column) -> Column:
    """A bit per type that a text may be read as without changing it; a missing or empty text fits them all.

    The tests come in an order in which most texts need one: each sees the whole text once. A number of more
    digits than a double tells apart is no fraction, so a column that also holds fractions stays text.
    """
    many_digits = (F.length(text) > 15) & text.rlike("^-?[0-9]{16}")
    return (
        F.when(text.isNull() | (text == ""), ANY)
        .when(text.rlike(SHORT_WHOLE), WHOLE | FRACTION)
        .when(text.rlike(NUMBER), F.when(~many_digits, FRACTION).when(
            text.rlike(LONG_WHOLE) & text.try_cast("bigint").isNotNull(), WHOLE).otherwise(0))
        .when(text.rlike(DATE_TEXT), F.when(text.try_cast("date").isNotNull(), DAY).otherwise(0))
        .when(text.rlike(TIME_TEXT), F.when(text.try_cast("timestamp").isNotNull(), MOMENT).otherwise(0))
        .when(text.rlike(NOT_TEXT), ODD).otherwise(0))


_BITS = {"bigint": WHOLE, "int": WHOLE, "smallint": WHOLE, "tinyint": WHOLE, "double": FRACTION, "float": FRACTION}


def _typed(text: Column, field: T.StructField, probed: bool) -> Column:
    """A text as its column's type, or an error that shows it; the texts of a probed column are known to fit."""
    if isinstance(field.dataType, T.StringType):
        return text.alias(field.name)
    kind = field.dataType.simpleString()
    if probed:
        return F.nullif(text, F.lit("")).cast(kind).alias(field.name)
    value = text.try_cast(kind)
    fits = value.isNotNull()
    if kind in _BITS:
        fits &= readable_as(text).bitwiseAND(_BITS[kind]) != 0
    odd = F.raise_error(F.concat(F.lit(f"column {field.name} holds a value that is no {kind}: "), text))
    return F.when(text.isNotNull() & (text != "") & ~fits, odd.cast(kind)).otherwise(value).alias(field.name)


def probe_schema(spark: SparkSession, path: str,
                 text_cols: list[str] | tuple[str, ...] = ()) -> T.StructType:
    """The schema of a CSV table, judged by all of its rows in one aggregate.

    Every value says as what it may be read, and a column is what all of them allow: ``1d`` and ``007`` are text,
    and so is a column that holds one of them. A column without any value counts as a number; ``text_cols`` (ids)
    stay text whatever they look like. A file that holds control characters or bytes that are no text is refused.
    """
    raw = spark.read.option("header", True).csv(path)
    marks = raw.select(*[
        (F.when(F.col(f"`{name}`").rlike(NOT_TEXT), ODD).otherwise(ANY) if name in text_cols
         else readable_as(F.col(f"`{name}`"))).alias(f"c{i}") for i, name in enumerate(raw.columns)])
    verdict = marks.agg(*[one for i in range(len(raw.columns)) for one in (
        F.coalesce(F.bit_and(f"c{i}"), F.lit(ANY)).alias(f"{i}_types"),
        F.coalesce(F.bit_or(f"c{i}"), F.lit(0)).alias(f"{i}_marks"))]).first()
    fields = []
    for i, name in enumerate(raw.columns):
        if verdict[f"{i}_marks"] & ODD or re.search(NOT_TEXT, name):
            raise ValueError(f"{path} is not a text table: column {i + 1} holds control characters")
        if name in text_cols:
            kind = "string"
        elif verdict[f"{i}_types"] == ANY:      # no value at all
            kind = "double"
        else:
            kind = next((t for bit, t in PROBED_TYPES if verdict[f"{i}_types"] & bit), "string")
        fields.append(T.StructField(name, T._parse_datatype_string(kind)))
    return T.StructType(fields)


def _no_parquet(error: Exception) -> bool:
    """Whether an error says that a file has no parquet footer."""
    return any(sign in str(error) for sign in (
        "CANNOT_READ_FILE_FOOTER", "is not a Parquet file", "UNABLE_TO_INFER_SCHEMA"))


def read_statements(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                    text_cols: list[str] | tuple[str, ...] = (),
                    kind: str | None = None, id_col: str | None = None) -> DataFrame:
    """Statements or labels, parquet or CSV.

    The format follows the file extension; a file without one is parquet if it
    has a parquet footer, else CSV. Other errors (a missing file, no permission)
    are raised as they are. A CSV without a given schema is probed. Id columns
    named in ``text_cols`` are text in both formats; ``id_col``, where given, must
    be there.
    """
    kind = kind or next((k for k in ("parquet", "csv") if path.rstrip("/").endswith(f".{k}")), None)
    if kind not in (None, "parquet", "csv"):
        raise ValueError(f"cannot read {kind!r}: expected parquet or csv")
    rows = None
    if kind != "csv":
        try:
            rows = spark.read.parquet(path)
            rows = rows.withColumns({c: F.col(f"`{c}`").cast("string") for c in text_cols if c in rows.columns})
        except (PySparkException, Py4JJavaError) as error:
            if kind == "parquet" or not _no_parquet(error):
                raise
    if rows is None:
        rows = read_csv(spark, path, schema or probe_schema(spark, path, text_cols), probed=schema is None)
    if id_col and id_col not in rows.columns:
        raise ValueError(f"{path} has no column {id_col}: it is no statement table")
    return rows


def table_shape(df: DataFrame) -> DataFrame:
    """``(n_rows, n_columns)``; the scan reads file metadata and no column."""
    return df.agg(F.count("*").alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)))
