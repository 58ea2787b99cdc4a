"""Digests of tables and of small JSON values."""

from __future__ import annotations

import hashlib
import json
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, functions as F

NULL_TEXT = "-"

# Fixed value: digests of artifacts are cut to this many hex digits.
DIGEST_CHARS = 12


def row_text(columns: list[str]) -> Column:
    """One row as text that no other row has: each value after its length, a null as a bare mark."""
    texts = [F.col(f"`{c}`").cast("string") for c in columns]
    return F.concat_ws("|", *[
        F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit(NULL_TEXT)) for t in texts])


def row_number_of(columns: list[str]) -> Column:
    """32 bits of a row's md5, as a decimal that sums without overflow."""
    return F.conv(F.substring(F.md5(row_text(columns)), 1, 8), 16, 10).cast("decimal(20,0)")


def table_digest(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(n_rows, digest)``: equal for equal rows, whatever their order.

    Adds up 32 bits of each row's md5, which combines map-side into one number
    per task. The sum is a decimal so that it cannot overflow.
    """
    return df.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(row_number_of(columns or df.columns)), F.lit(0)).cast("string").alias("digest"))


#: Lanes of a content digest: as many times 32 bits of a row's sha256.
LANES = 8


def _lane(text: Column, k: int) -> Column:
    """Lane ``k`` of a row: eight hex digits of its sha256, as a number that sums without overflow."""
    return F.conv(F.substring(F.sha2(text, 256), 8 * k + 1, 8), 16, 10).cast("decimal(20,0)")


def content_digest(df: DataFrame, columns: list[str] | None = None, by: list[Column] | None = None) -> DataFrame:
    """``n_rows`` and ``lanes``: a digest of a multiset of rows that adds up over its parts.

    Rows add up lane by lane, so order and partitioning do not matter, repeated rows count, and the digest of
    two tables together is the sum of theirs (``add_digests``). ``by`` gives one digest per group, such as per
    file. Combines map-side into one row per task and group.
    """
    rows = df.select(*(by or []), row_text(columns or df.columns).alias("_text"))
    groups = [c for c in rows.columns if c != "_text"]
    sums = rows.groupBy(*groups).agg(F.count("*").alias("n_rows"), *[
        F.coalesce(F.sum(_lane(F.col("_text"), k)), F.lit(0)).cast("decimal(38,0)").alias(f"_{k}") for k in range(LANES)])
    return sums.select(*groups, "n_rows", F.array(*[f"_{k}" for k in range(LANES)]).alias("lanes"))


def add_digests(digests: DataFrame, sign: Column | None = None) -> DataFrame:
    """The digest of all parts together; ``sign`` -1 takes a part away again."""
    sign = (F.lit(1) if sign is None else sign).cast("int")
    return digests.agg(
        F.coalesce(F.sum(F.col("n_rows") * sign), F.lit(0)).alias("n_rows"),
        F.array(*[F.coalesce(F.sum((F.col("lanes")[k] * sign).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)")
                  for k in range(LANES)]).alias("lanes"))


def digest_text(n_rows: Column, lanes: Column) -> Column:
    """A content digest as hex digits: its row count and lanes, hashed."""
    return F.sha2(F.concat_ws(":", n_rows.cast("string"), F.transform(lanes, lambda x: x.cast("string"))), 256)


def file_digests(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``file, n_rows, lanes`` per file of a frame read from files, by what the files hold.

    A copied file has the digest of its original; one rewritten in place, with its size and time kept, has not.
    """
    return content_digest(df, columns or df.columns, [F.col("_metadata.file_path").alias("file")])


def files_digest(df: DataFrame) -> str:
    """A digest of the files behind a frame: paths, sizes and write times.

    The files are listed, not read: one row per file, no column data.
    """
    paths = [unquote(p) for p in df.inputFiles()]
    if not paths:
        raise ValueError("the frame is not read from files: give its content digest instead")
    files = df.sparkSession.read.format("binaryFile").load(paths).select(
        "path", F.col("length").cast("string").alias("bytes"),
        F.unix_micros("modificationTime").alias("written"))
    row = table_digest(files).first()
    return json_digest({"files": row.n_rows, "digest": row.digest})


def json_digest(value) -> str:
    """Twelve hex digits that depend on a value but not on its key order."""
    text = json.dumps(value, sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:DIGEST_CHARS]


def split_digest(source_digest: Column, seed: int, ratios: dict[str, int]) -> Column:
    """The id of one way to cut one source (labels and statements): twelve hex digits."""
    cuts = ",".join(f"{name}={share}" for name, share in sorted(ratios.items()))
    return F.substring(
        F.sha2(F.concat_ws("|", source_digest, F.lit(str(seed)), F.lit(cuts)), 256), 1, DIGEST_CHARS)
