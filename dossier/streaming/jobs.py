"""Statements arriving as files: routed to splits, or collapsed and scored as they come."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from dossier.operators.collapse import collapse
from dossier.operators.joins import BROADCAST_BYTES, measured_bytes, salted_join
from dossier.operators.vocabulary import Vocabulary
from dossier.sources.artifacts import mark_done, receipt
from dossier.sources.writers import write_table
from dossier.spec import EntitySpec


def read_stream(spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet",
                glob: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """A folder of statement files as a stream, under a fixed schema."""
    reader = spark.readStream.schema(schema).format(kind)
    if kind == "csv":
        reader = reader.option("header", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def route_stream(stream: DataFrame, assigned: DataFrame, spec: EntitySpec, out: str,
                 checkpoint: str, hot: list = (), broadcast_bytes: int = BROADCAST_BYTES) -> StreamingQuery:
    """Send arriving statements to the split of their entity; unknown entities go first.

    A stream-static join. An assignment measured small is broadcast; a larger
    one is joined by shuffle, with the entities listed in ``hot`` salted, as a
    stream cannot be scanned for them. The file sink makes replays exact.
    """
    first = next(iter(spec.ratios))
    lookup = assigned.select(spec.id_col, "split")
    if measured_bytes(lookup) <= broadcast_bytes:
        joined = stream.join(F.broadcast(lookup), spec.id_col, "left")
    else:
        joined = salted_join(stream, lookup, spec.id_col, list(hot))
    routed = joined.withColumn("split", F.coalesce("split", F.lit(first)))
    return (routed.writeStream.format("parquet").partitionBy("split")
            .option("path", out).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def collapse_stream(stream: DataFrame, spec: EntitySpec, vocabulary: Vocabulary, out: str,
                    checkpoint: str, then=None, value_type: str = "float") -> StreamingQuery:
    """Keep the feature row of every entity up to date as statements arrive.

    The batch collapse itself runs as a streaming aggregate: state is one row per
    entity, and arrival order is irrelevant because "last" goes by date. Each
    batch writes only the entities it changed, to a folder named by its number,
    so a replayed batch overwrites itself. ``then`` maps the changed feature
    rows before they are written, e.g. to score them. A new checkpoint starts at
    batch 0 again, so it is refused over a folder that already holds batches.
    """
    spark = stream.sparkSession
    if holds_files(spark, out) and not holds_files(spark, checkpoint):
        raise ValueError(f"{out} holds batches of another checkpoint than {checkpoint}")
    features = collapse(stream, spec, vocabulary, value_type)

    def write(batch: DataFrame, number: int) -> None:
        rows = then(batch) if then else batch
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (features.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def holds_files(spark: SparkSession, path: str) -> bool:
    """Whether there is any file under ``path``; the files are listed, not read."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        return not files.select("path").isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def compact_features(spark: SparkSession, out: str, snapshot: str, id_col: str) -> DataFrame:
    """The current row per entity, from the last snapshot and the batches written since.

    Each call reads the new batches only and writes the next snapshot into a
    folder of its own, named by a receipt once it is whole.
    """
    done = receipt(spark, snapshot)
    since = int(done["inputs"]) if done else -1
    newer = spark.read.parquet(out).where(F.col("batch") > since)
    last = newer.agg(F.max("batch")).first()[0]
    if last is not None:
        rows = newer
        if done:
            rows = newer.unionByName(spark.read.parquet(done["target"]).withColumn("batch", F.lit(since)))
        target = f"{snapshot}/upto={last}-{uuid.uuid4().hex}"
        write_table(latest_features(rows, id_col), target)
        mark_done(spark, snapshot, target, str(last))
        done = {"target": target}
    return spark.read.parquet(done["target"])


def latest_features(changes: DataFrame, id_col: str, batch: str = "batch") -> DataFrame:
    """The current row per entity from the change table of ``collapse_stream``."""
    others = [c for c in changes.columns if c not in (id_col, batch)]
    packed: Column = F.struct(*[F.col(f"`{c}`") for c in others])
    return (changes.groupBy(id_col).agg(F.max_by(packed, batch).alias("r"))
            .select(id_col, *[F.col(f"r.`{c}`").alias(c) for c in others]))
