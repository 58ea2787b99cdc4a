"""Lineage: where each artifact came from, as an append-only table."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

LINEAGE_SCHEMA = (
    "artifact string, written timestamp, split_id string, seed long, source string, "
    "source_digest string, categories_digest string, feature_version long, run_id string, "
    "produced_by string, customers long, rows long, features long, code_version string, "
    "ratios string, levels long, positives long, unlabelled long")
FIELDS = [part.split()[0] for part in LINEAGE_SCHEMA.split(", ")]


def record(spark: SparkSession, log: str, artifact: str, **fields) -> None:
    """Append the provenance of one artifact, keyed by its full path."""
    unknown = set(fields) - set(FIELDS)
    if unknown:
        raise KeyError(f"not lineage fields: {sorted(unknown)}")
    row = {**fields, "artifact": artifact, "written": datetime.now(timezone.utc)}
    (spark.createDataFrame([tuple(row.get(f) for f in FIELDS)], LINEAGE_SCHEMA)
     .write.mode("append").json(log))


def load(spark: SparkSession, log: str) -> DataFrame:
    """Every record ever written; empty when there is no log yet."""
    try:
        return spark.read.schema(LINEAGE_SCHEMA).json(log)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LINEAGE_SCHEMA)
        raise


def current(log: DataFrame, key: str = "artifact", written: list[str] | None = None) -> DataFrame:
    """The latest record per artifact: an upsert read from an append-only table."""
    order = F.struct(*[F.col(c) for c in written or ["written"]])
    others = [c for c in log.columns if c != key]
    return (log.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("r"))
            .select(key, *[F.col(f"r.{c}").alias(c) for c in others]))


def get(spark: SparkSession, log: str, artifact: str) -> Row | None:
    return current(load(spark, log).where(F.col("artifact") == artifact)).first()


def split_id_of(spark: SparkSession, log: str, artifact: str) -> str | None:
    entry = get(spark, log, artifact)
    return entry.split_id if entry else None


def inherit(spark: SparkSession, log: str, artifact: str, source: str, **fields) -> None:
    """Record an artifact under the split its source came from."""
    record(spark, log, artifact, source=source,
           split_id=split_id_of(spark, log, source), **fields)


def split_guard(log: DataFrame, groups: list[str], split_id: str = "split_id") -> DataFrame:
    """Per group of artifacts: how many splits they mix, and how many have no known split."""
    return log.groupBy(*groups).agg(
        F.countDistinct(split_id).alias("n_splits"),
        F.count_if(F.col(split_id).isNull()).alias("n_unknown")
    ).withColumn("same_split", F.col("n_splits") <= 1)


def require_same_split(spark: SparkSession, log: str, *artifacts: str) -> str | None:
    """The one split the artifacts share; an error when those known differ.

    None when any of them has no recorded origin.
    """
    rows = (current(load(spark, log).where(F.col("artifact").isin(list(artifacts))))
            .select("artifact", "split_id").collect())      # at most one row per argument
    known = {row.artifact: row.split_id for row in rows if row.split_id}
    if len(set(known.values())) > 1:
        listed = ", ".join(f"{a}={s}" for a, s in sorted(known.items()))
        raise ValueError(f"these come from different splits: {listed}")
    return next(iter(known.values())) if len(known) == len(set(artifacts)) and known else None
