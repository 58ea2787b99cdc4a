"""Joins on the entity id: labels, scores and split lookups, with their audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from dossier.session import scratch_path
from dossier.spec import EntitySpec

BROADCAST_BYTES = 64 << 20      # a lookup is broadcast only when measured below this
HOT_SHARE = 0.01                # a key with more than this share of rows is salted
SALTS = 64


def unique_rows(df: DataFrame, key: str) -> DataFrame:
    """The frame itself, failing the job when a key occurs twice.

    Grouping by the key costs nothing extra before a shuffle join on that key,
    which reuses the partitioning.
    """
    others = [c for c in df.columns if c != key]
    counted = df.groupBy(key).agg(
        F.count("*").alias("_n"), *[F.first(c).alias(c) for c in others])
    clash = F.raise_error(F.concat(F.lit(f"more than one row for {key} "),
                                   F.col(key).cast("string")))
    return counted.select(key, *[
        F.when(F.col("_n") == 1, F.col(c)).otherwise(clash.cast(df.schema[c].dataType)).alias(c)
        for c in others])


def join_labels(rows: DataFrame, labels: DataFrame, spec: EntitySpec,
                observation: Observation | None = None) -> DataFrame:
    """Feature or score rows with their target; rows without a label drop out.

    Pass an ``Observation`` to learn, from the same run, how many rows came in
    (``n_rows``) and how many had no label (``n_unlabelled``).
    """
    truth = unique_rows(labels.select(spec.id_col, spec.target_col), spec.id_col)
    if observation is None:
        return rows.join(truth, spec.id_col, "inner")
    marked = truth.withColumn("_labelled", F.lit(True))
    joined = rows.join(marked, spec.id_col, "left").observe(
        observation, F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("_labelled").isNull()).alias("n_unlabelled"))
    return joined.where(F.col("_labelled")).drop("_labelled")


def label_audit(rows: DataFrame, labels: DataFrame, spec: EntitySpec) -> DataFrame:
    """``(n_rows, n_evaluated, n_unmatched)`` of a label join, without keeping the join."""
    known = labels.select(spec.id_col).distinct().withColumn("_labelled", F.lit(True))
    return (rows.select(spec.id_col).join(known, spec.id_col, "left")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(F.col("_labelled")).alias("n_evaluated"),
                 F.count_if(F.col("_labelled").isNull()).alias("n_unmatched")))


def measured_bytes(df: DataFrame) -> int:
    """About how much memory a frame's rows take, from one pass over it."""
    width = 16 + 16 * len(df.columns)
    texts = [f.name for f in df.schema.fields
             if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    row = df.agg(F.count("*").alias("n"), *[
        F.coalesce(F.sum(F.octet_length(c)), F.lit(0)).alias(f"t{i}")
        for i, c in enumerate(texts)]).first()
    return row["n"] * width + sum(row[f"t{i}"] for i in range(len(texts)))


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Every key with more than ``share`` of the rows, and maybe a few others.

    A frequent-items sketch: one narrow scan, at most ``1 / share`` keys kept.
    """
    return [k for k in df.select(key).stat.freqItems([key], share).first()[0] if k is not None]


def salted_join(facts: DataFrame, lookup: DataFrame, key: str, hot: list,
                how: str = "left", salts: int | None = None, salt_on: list[str] | None = None) -> DataFrame:
    """A shuffle join that spreads hot keys (and rows without a key) over many tasks.

    A hot key is cut into as many parts as a shuffle has, ``SALTS`` at least, so
    that even a key with half of all rows fills no task more than others do.
    Only the lookup rows of hot keys are repeated, so the lookup grows by at
    most ``len(hot) * salts`` rows. The salt is a hash of row content: a retried
    task places its rows as before.
    """
    salts = salts or max(SALTS, int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in salt_on or facts.columns]),
                    F.lit(salts)).cast("int")
    is_hot = F.col(key).isNull() | (F.col(key).isin(hot) if hot else F.lit(False))
    left = facts.withColumn("_salt", F.when(is_hot, spread).otherwise(0))
    copies = F.when(F.col(key).isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))) \
        .otherwise(F.array(F.lit(0))) if hot else F.array(F.lit(0))
    right = lookup.withColumn("_salt", F.explode(copies))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def lookup_join(facts: DataFrame, lookup: DataFrame, key: str, how: str = "left",
                broadcast_bytes: int = BROADCAST_BYTES, salt_on: list[str] | None = None) -> DataFrame:
    """Join a large table to a one-row-per-key lookup.

    The lookup is written and measured first, so that its plan runs once. A small
    one is broadcast and the facts do not move at all; a large one is joined by
    shuffle with hot keys salted.
    """
    path = scratch_path(lookup.sparkSession, "lookup")
    lookup.write.parquet(path)
    lookup = lookup.sparkSession.read.parquet(path)
    if measured_bytes(lookup) <= broadcast_bytes:
        return facts.join(F.broadcast(lookup), key, how)
    return salted_join(facts, lookup, key, hot_keys(facts, key), how, salt_on=salt_on)


def route_statements(statements: DataFrame, assigned: DataFrame, spec: EntitySpec,
                     default: str | None = None, **options) -> DataFrame:
    """Statements with the split of their entity; unknown entities go to the first split."""
    default = default or next(iter(spec.ratios))
    lookup = assigned.select(spec.id_col, "split")
    return lookup_join(statements, lookup, spec.id_col, "left",
                       salt_on=[spec.id_col, *spec.order_cols] if spec.seq_col else None,
                       **options).withColumn("split", F.coalesce("split", F.lit(default)))


def members(rows: DataFrame, ids: DataFrame, key: str, **options) -> DataFrame:
    """Rows whose key is among ``ids``."""
    return lookup_join(rows, ids.select(key).distinct(), key, "left_semi", **options)


def remainder(rows: DataFrame, held_out: DataFrame, key: str, **options) -> DataFrame:
    """Rows whose key is in none of the held-out ids."""
    return lookup_join(rows, held_out.select(key).distinct(), key, "left_anti", **options)


def require_matches(audit: DataFrame) -> DataFrame:
    """The audit itself; the job fails where no scored id has a label."""
    nothing = F.raise_error(F.lit("none of the scored ids has a label: different datasets?"))
    checked = F.when(F.col("n_evaluated") == 0, nothing.cast("bigint"))
    return audit.select(*[F.coalesce(checked, F.col(c)).alias(c) for c in audit.columns])
