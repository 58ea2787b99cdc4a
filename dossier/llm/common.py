"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dossier.session import scratch_path

K1, K2 = "llm__k1", "llm__k2"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends here, nothing is computed twice."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_keys(doc_id: str = "doc_id", text: str = "text") -> tuple[Column, Column]:
    """128 bits that name a row by its id and text; repeated rows share them."""
    parts = (F.col(doc_id).isNull(), F.col(doc_id), F.col(text).isNull(), F.col(text))
    return (F.xxhash64(*parts).alias(K1), F.xxhash64(F.lit(1), *parts).alias(K2))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows, so that what a task holds stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def raw(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; a null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def kept_columns(docs: DataFrame, keep: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose row keys stand in ``keep``, each (id, text) once."""
    k1, k2 = row_keys()
    found = docs.select("*", k1, k2).join(keep.select(K1, K2), [K1, K2], "left_semi")
    return found.dropDuplicates([K1, K2]).select(*docs.columns)
