"""Stratified entity splits: assignment, routing inputs and audits."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from dossier.operators.joins import BROADCAST_BYTES, measured_bytes, route_statements
from dossier.operators.prefix import hash_rank
from dossier.session import scratch_path
from dossier.spec import EntitySpec

MAX_STRATA = 1000       # class labels; more than this and the ranked way is taken
PREFIX_DIGITS = 3       # hex digits: 4096 hash ranges per class


def split_hash(spec: EntitySpec) -> Column:
    """Places an entity in the cut order: a hash of seed and id."""
    return F.md5(F.concat_ws(":", F.lit(str(spec.seed)), F.col(spec.id_col).cast("string")))


def _last_ranks(total: Column, spec: EntitySpec) -> dict[str, Column]:
    """Rank of the last member of each split but the final one, in whole numbers."""
    shares = list(spec.ratios.items())
    whole = sum(spec.ratios.values())
    taken, ranks = 0, {}
    for name, share in shares[:-1]:
        taken += share
        scaled = total * taken
        ranks[name] = ((scaled - F.pmod(scaled, F.lit(whole))) / whole).cast("bigint")
    return ranks


def split_thresholds(labels: DataFrame, spec: EntitySpec) -> DataFrame:
    """Per class, the hash of the last member of each split but the final one.

    Counts per hash prefix say which prefix each cut falls into; only the rows
    of those prefixes, one in thousands, are ranked.
    """
    strata, prefix = spec.target_col, "_prefix"
    hashed = labels.select(F.col(strata), split_hash(spec).alias("_hash")).withColumn(
        prefix, F.substring("_hash", 1, PREFIX_DIGITS))
    counts = hashed.groupBy(strata, prefix).agg(F.count("*").alias("n"))
    in_class = Window.partitionBy(strata)
    before = in_class.orderBy(prefix).rowsBetween(Window.unboundedPreceding, -1)
    counts = (counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
              .withColumn("total", F.sum("n").over(in_class)))
    cuts = counts.select(strata, prefix, "n", "before", F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), rank.alias("rank"))
        for name, rank in _last_ranks(F.col("total"), spec).items()])).alias("cut"))
    cuts = cuts.where((F.col("cut.rank") > F.col("before"))
                      & (F.col("cut.rank") <= F.col("before") + F.col("n")))
    cuts = cuts.select(F.col(strata).alias("_class"), F.col(prefix).alias("_at"),
                       F.col("cut.name").alias("name"),
                       (F.col("cut.rank") - F.col("before")).alias("nth"))
    # One row per class and cut; Spark broadcasts it where it measures it small.
    edge = hashed.join(cuts, hashed[strata].eqNullSafe(cuts["_class"])
                       & (hashed[prefix] == cuts["_at"]))
    nth = F.row_number().over(Window.partitionBy("_class", "_at", "name").orderBy("_hash"))
    return (edge.withColumn("place", nth).where(F.col("place") == F.col("nth"))
            .groupBy("_class").agg(*[
                F.coalesce(F.max(F.when(F.col("name") == name, F.col("_hash"))), F.lit(""))
                .alias(name) for name in list(spec.ratios)[:-1]]))


@dataclass(frozen=True)
class SplitPlan:
    """A fitted split: per class, the hash thresholds between the splits.

    ``cuts`` has one ``(class, threshold, ...)`` tuple per class, at most
    ``MAX_STRATA`` of them. A class too small to reach a cut has an empty
    threshold there; a class absent here lies wholly in the last split.
    """

    spec: EntitySpec
    class_type: str
    cuts: tuple[tuple, ...]
    complete: bool      # whether every class is listed in ``cuts``

    @property
    def names(self) -> list[str]:
        return list(self.spec.ratios)

    def place(self, thresholds: list[Column]) -> Column:
        """The split of a row, given the thresholds of its class."""
        hashed = split_hash(self.spec)
        split = F.lit(self.names[-1])
        for name, threshold in reversed(list(zip(self.names, thresholds))):
            split = F.when(hashed <= threshold, F.lit(name)).otherwise(split)
        return split

    def assign(self, labels: DataFrame) -> DataFrame:
        """``labels`` with their ``split``: a comparison, no shuffle of the label table."""
        inner = self.names[:-1]
        if not self.cuts:
            return labels.withColumn("split", F.lit(self.names[-1]))
        schema = ", ".join([f"_class {self.class_type}", *[f"`_{n}` string" for n in inner]])
        table = labels.sparkSession.createDataFrame(list(self.cuts), schema)
        joined = labels.join(F.broadcast(table),        # one row per class
                             labels[self.spec.target_col].eqNullSafe(table["_class"]), "left")
        split = self.place([F.col(f"`_{n}`") for n in inner])
        return joined.select(*[labels[c] for c in labels.columns], split.alias("split"))

    def bounds(self) -> tuple[list[str], list[str]]:
        """Per cut, the lowest and the highest threshold of any class."""
        columns = list(zip(*[c[1:] for c in self.cuts])) or [("",)] * (len(self.names) - 1)
        low = [min(c) if self.complete else "" for c in columns]
        return low, [max(c) for c in columns]


def fit_split(labels: DataFrame, spec: EntitySpec) -> SplitPlan | None:
    """Find the thresholds of an exact stratified split; None with too many classes."""
    classes = labels.select(spec.target_col).distinct().limit(MAX_STRATA + 1).count()
    if classes > MAX_STRATA:
        return None
    cuts = split_thresholds(labels, spec).collect()         # at most MAX_STRATA rows
    return SplitPlan(spec, labels.schema[spec.target_col].dataType.simpleString(),
                     tuple(tuple(c) for c in cuts), len(cuts) == classes)


def require_unique_ids(labels: DataFrame, spec: EntitySpec) -> None:
    """Refuse a label table that names an entity twice: it could land in two splits."""
    twice = labels.groupBy(spec.id_col).count().where(F.col("count") > 1).select(spec.id_col).take(3)
    if twice:
        raise ValueError(f"labels name an entity more than once: {[r[0] for r in twice]}")


def assign_splits(labels: DataFrame, spec: EntitySpec, checked: bool = False) -> DataFrame:
    """``labels`` with a ``split`` column: exact ratios inside every class.

    An entity may stand there once only, however many classes there are;
    ``checked`` says that this is known. Entities of a class are ordered by hash and cut at whole-number ranks
    (``n * 7 // 10`` and ``n * 9 // 10`` for 7:2:1), so the same seed gives the
    same split everywhere.
    """
    if not checked:
        require_unique_ids(labels, spec)
    plan = fit_split(labels, spec)
    return plan.assign(labels) if plan else assign_splits_ranked(labels, spec)


def assign_splits_ranked(labels: DataFrame, spec: EntitySpec) -> DataFrame:
    """The same assignment from full ranks: for labels with very many classes."""
    names = list(spec.ratios)
    ranked = hash_rank(labels.withColumn("_hash", split_hash(spec)), "_hash", [spec.target_col])
    place = F.lit(names[-1])
    for name, rank in reversed(_last_ranks(F.col("rank_total"), spec).items()):
        place = F.when(F.col("rank") <= rank, F.lit(name)).otherwise(place)
    return ranked.select(*labels.columns, place.alias("split"))


def route_by_plan(statements: DataFrame, labels: DataFrame, plan: SplitPlan,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Statements with the split of their entity, without shuffling the statements.

    The thresholds of all classes lie close together, so the hash of an id
    alone tells its split, but for two kinds of ids: labelled ones between the
    thresholds of two classes, and unlabelled ones, which go to the first
    split. Those exceptions are found from ids alone, written once, and
    broadcast when measured small; otherwise routing falls back to a salted
    shuffle join on the whole assignment.
    """
    spec, spark = plan.spec, statements.sparkSession
    key, first = spec.id_col, plan.names[0]
    low, high = plan.bounds()
    earliest = plan.place([F.lit(t) for t in high])     # the split if every class cut late
    latest = plan.place([F.lit(t) for t in low])        # the split if every class cut early

    between = plan.assign(labels).where(earliest != latest).select(key, "split")
    beyond = F.coalesce(latest != first, F.lit(False))
    strangers = (statements.select(key).where(beyond).distinct()
                 .join(labels.select(key).where(beyond), key, "left_anti")
                 .select(key, F.lit(first).alias("split")))
    path = scratch_path(spark, "split-exceptions")
    between.unionByName(strangers).write.parquet(path)
    exceptions = spark.read.parquet(path)
    if measured_bytes(exceptions) > broadcast_bytes:
        return route_statements(statements, plan.assign(labels), spec,
                                broadcast_bytes=broadcast_bytes)
    named = exceptions.withColumnRenamed("split", "_exception")
    default = F.when(F.col(key).isNull(), first).otherwise(earliest)
    return (statements.join(F.broadcast(named), key, "left")
            .withColumn("split", F.coalesce("_exception", default)).drop("_exception"))


def route_labelled(statements: DataFrame, labels: DataFrame, spec: EntitySpec) -> DataFrame:
    """Route by the fitted plan where there is one, else by join."""
    plan = fit_split(labels, spec)
    if plan:
        return route_by_plan(statements, labels, plan)
    return route_statements(statements, assign_splits_ranked(labels, spec), spec)


def split_report(statements: DataFrame, spec: EntitySpec, split: str = "split") -> DataFrame:
    """Rows and distinct entities per split."""
    return statements.groupBy(split).agg(
        F.count("*").alias("n_rows"), F.countDistinct(spec.id_col).alias("n_entities"))


def class_balance(labels: DataFrame, spec: EntitySpec, by: str | None = "split") -> DataFrame:
    """Labelled entities and share of positives, overall or per split."""
    return labels.groupBy(*([by] if by else [])).agg(
        F.count("*").alias("n_entities"),
        F.sum(F.col(spec.target_col).cast("bigint")).alias("n_positive"),
        F.avg(spec.target_col).alias("positive_share"))


def split_overlap(rows: DataFrame, spec: EntitySpec, split: str = "split",
                  names: list[str] | None = None) -> DataFrame:
    """Entities found in both splits, for every pair of splits.

    Each entity folds into a bit mask of its splits, one number per entity and
    map task.
    """
    names = names or list(spec.ratios)
    bit = F.lit(0)
    for i, name in enumerate(names):
        bit = F.when(F.col(split) == name, F.lit(1 << i)).otherwise(bit)
    masks = rows.groupBy(spec.id_col).agg(F.bit_or(bit).alias("mask"))
    pairs = list(combinations(range(len(names)), 2))
    counted = masks.agg(*[
        F.count_if(F.col("mask").bitwiseAND(F.lit((1 << a) | (1 << b))) == ((1 << a) | (1 << b)))
        .alias(f"p{k}") for k, (a, b) in enumerate(pairs)])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(names[a]).alias("split_a"), F.lit(names[b]).alias("split_b"),
                 F.col(f"p{k}").alias("n_shared")) for k, (a, b) in enumerate(pairs)])))


def label_coverage(assigned: DataFrame, statements: DataFrame, spec: EntitySpec) -> DataFrame:
    """Per split: labelled entities, and how many of them have no statement at all."""
    seen = statements.select(spec.id_col).distinct().withColumn("_seen", F.lit(1))
    return (assigned.join(seen, spec.id_col, "left")
            .groupBy("split")
            .agg(F.count("*").alias("n_labelled"),
                 F.count_if(F.col("_seen").isNull()).alias("n_never_seen")))
