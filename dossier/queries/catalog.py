"""Every registered query: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from dossier.functions.digest import (
    add_digests, content_digest, digest_text, file_digests, split_digest, table_digest)
from dossier.functions.levels import folded_label, level_label
from dossier.functions.naming import base_column
from dossier.functions.numeric import half_round
from dossier.operators import audits, importance, joins, metric, rounds, splits, vocabulary
from dossier.operators.collapse import (
    BATCH_AGGREGATES, category_features, collapse, numeric_features)
from dossier.operators.prefix import prefix_sum
from dossier.operators.selection import best_iteration
from dossier.plans import model as trees
from dossier.plans.workflow import code_levels
from dossier.queries import standins as st
from dossier.queries.standins import CUSTOMERS, DOCUMENTS, EVENT_LEVELS, EVENTS, ORDERS, PARTS
from dossier.session import scratch_path
from dossier.sources import artifacts, lineage, readers, registry, writers
from dossier.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- entity collapse -------------------------------------------------------

@query
def entity_collapse(spark, sf_dir):
    rows = st.statements(spark, sf_dir)
    return collapse(rows, ORDERS, vocabulary.fit_vocabulary(rows, ORDERS))


@query
def entity_collapse_shuffled(spark, sf_dir):
    """The same rows spread by an unrelated key: order must not matter."""
    rows = st.statements(spark, sf_dir).repartition("o_orderkey")
    return collapse(rows, ORDERS, vocabulary.fit_vocabulary(rows, ORDERS))


@query
def numeric_mean_max_last_diff(spark, sf_dir):
    return numeric_features(st.event_statements(spark, sf_dir), EVENTS)


def _wide_statements(spark, sf_dir):
    return st.statements(spark, sf_dir).select("o_custkey", "o_orderdate", "o_orderkey", *[
        F.when((F.col("o_orderkey") + i) % 7 != 0, F.col("o_orderkey") * (i + 3) % 1009)
        .alias(f"x{i}") for i in range(40)])


@query
def wide_collapse(spark, sf_dir):
    """Forty number columns in one pass."""
    return collapse(_wide_statements(spark, sf_dir), replace(ORDERS, cat_cols=()), {}, "double")


@query
def wide_collapse_batched(spark, sf_dir):
    """The same in batches of columns, joined on the entity."""
    return collapse(_wide_statements(spark, sf_dir), replace(ORDERS, cat_cols=()), {}, "double",
                    batch=BATCH_AGGREGATES)


@query
def wide_collapse_unsequenced(spark, sf_dir):
    """177 number columns and no sequence number: rows of one day tie, and go by their content."""
    rows = st.statements(spark, sf_dir).select("o_custkey", "o_orderdate", *[
        F.when((F.col("o_orderkey") + i) % 7 != 0, F.col("o_orderkey") * (i + 3) % 1009)
        .alias(f"x{i}") for i in range(177)])
    out = collapse(rows, replace(ORDERS, seq_col=None, cat_cols=()), {}, "double", batch=BATCH_AGGREGATES)
    return out.select("o_custkey", *[f"x{i}_{part}" for i in range(177) for part in ("mean", "max")])


@query
def level_shares(spark, sf_dir):
    rows = st.statements(spark, sf_dir)
    out = category_features(rows, ORDERS, vocabulary.fit_vocabulary(rows, ORDERS))
    return out.drop("o_orderstatus_last", "o_orderpriority_last")


@query
def last_level_code(spark, sf_dir):
    rows = st.statements(spark, sf_dir)
    out = category_features(rows, ORDERS, vocabulary.fit_vocabulary(rows, ORDERS))
    return out.select("o_custkey", F.col("o_orderstatus_last").cast("int").alias("o_orderstatus_last"),
                      F.col("o_orderpriority_last").cast("int").alias("o_orderpriority_last"))


@query
def entity_uniqueness(spark, sf_dir):
    rows = st.statements(spark, sf_dir)
    before = audits.entity_uniqueness(rows, "o_custkey")
    features = numeric_features(rows, ORDERS)
    after = audits.entity_uniqueness(features, "o_custkey")
    return (before.withColumn("stage", F.lit("statements"))
            .unionByName(after.withColumn("stage", F.lit("features"))))


# --- categories ------------------------------------------------------------

@query
def category_vocabulary(spark, sf_dir):
    fitted = vocabulary.fit_vocabulary(st.statements(spark, sf_dir), ORDERS)
    fitted |= vocabulary.fit_vocabulary(st.table(spark, sf_dir, "part"), PARTS)
    return vocabulary.vocabulary_table(spark, fitted)


@query
def vocabulary_roundtrip(spark, sf_dir):
    fitted = vocabulary.fit_vocabulary(st.table(spark, sf_dir, "part"), PARTS)
    path = artifacts.save_vocabulary(spark, fitted, scratch_path(spark, "vocabulary"))
    return vocabulary.vocabulary_table(spark, artifacts.load_vocabulary(spark, path))


@query
def vocabulary_digest(spark, sf_dir):
    levels = vocabulary.observed_levels(st.table(spark, sf_dir, "part"), PARTS)
    return levels.groupBy("col").agg(
        F.substring(F.sha2(F.array_join(F.array_sort(F.collect_list("level")), "|"), 256), 1, 12)
        .alias("digest"))


@query
def unseen_levels(spark, sf_dir):
    rows = st.event_statements(spark, sf_dir, EVENT_LEVELS)
    early = rows.where(F.col("ts") < F.lit("2024-01-01 01:00:00").cast("timestamp_ntz").cast("timestamp"))
    fitted = vocabulary.fit_vocabulary(early, EVENT_LEVELS)
    return vocabulary.unseen_levels(rows, EVENT_LEVELS, fitted).select(
        "col", "n_rows", F.array_join("levels", "|").alias("levels"))


@query
def level_labels(spark, sf_dir):
    p = st.table(spark, sf_dir, "part")
    return p.select(
        "p_partkey", level_label(F.col("p_retailprice"), p.schema["p_retailprice"].dataType)
        .alias("price_label"),
        folded_label(F.when(F.col("p_type") != "SMALL", F.col("p_type")).otherwise(""),
                     p.schema["p_type"].dataType, "NaN").alias("type_label"))


# --- splits and routing ----------------------------------------------------

@query
def stratified_split(spark, sf_dir):
    return splits.assign_splits(st.customer_labels(spark, sf_dir), CUSTOMERS)


@query
def stratified_split_ranked(spark, sf_dir):
    return splits.assign_splits_ranked(st.customer_labels(spark, sf_dir), CUSTOMERS)


def _routed(spark, sf_dir):
    return splits.route_labelled(
        st.statements(spark, sf_dir), st.customer_labels(spark, sf_dir), CUSTOMERS)


@query
def route_statements(spark, sf_dir):
    assigned = splits.assign_splits(st.customer_labels(spark, sf_dir), CUSTOMERS)
    return joins.route_statements(st.statements(spark, sf_dir), assigned, ORDERS).select(
        "o_orderkey", "o_custkey", "split")


@query
def route_statements_salted(spark, sf_dir):
    """The shuffle way of routing, as taken when the assignment is too large to broadcast."""
    assigned = splits.assign_splits(st.customer_labels(spark, sf_dir), CUSTOMERS)
    return joins.route_statements(
        st.statements(spark, sf_dir), assigned, ORDERS, broadcast_bytes=0
    ).select("o_orderkey", "o_custkey", "split")


@query
def route_statements_by_hash(spark, sf_dir):
    """Labels of customers with a balance, so that many statements have no label."""
    labels = st.customer_labels(spark, sf_dir)
    known = st.table(spark, sf_dir, "customer").where("c_acctbal < 6000").select(
        F.col("c_custkey").alias("o_custkey"))
    labels = labels.join(known, "o_custkey", "left_semi")
    plan = splits.fit_split(labels, CUSTOMERS)
    return splits.route_by_plan(st.statements(spark, sf_dir), labels, plan).select(
        "o_orderkey", "o_custkey", "split")


@query
def membership_filter(spark, sf_dir):
    assigned = splits.assign_splits(st.customer_labels(spark, sf_dir), CUSTOMERS)
    return joins.members(st.statements(spark, sf_dir), assigned.where("split = 'test'"),
                         "o_custkey").select("o_orderkey", "o_custkey")


@query
def remainder_filter(spark, sf_dir):
    assigned = splits.assign_splits(st.customer_labels(spark, sf_dir), CUSTOMERS)
    return joins.remainder(st.statements(spark, sf_dir), assigned.where("split <> 'train'"),
                           "o_custkey").select("o_orderkey", "o_custkey")


def _order_labels(spark, sf_dir):
    return st.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("o_custkey"), (F.col("o_orderkey") % 1200).cast("int").alias("target"))


@query
def many_class_split(spark, sf_dir):
    """More classes than thresholds are kept for."""
    return splits.assign_splits(_order_labels(spark, sf_dir), CUSTOMERS)


@query
def label_sink(spark, sf_dir):
    """Label files, one folder per split, read back."""
    assigned = splits.assign_splits(st.customer_labels(spark, sf_dir), CUSTOMERS)
    path = writers.write_splits(assigned, scratch_path(spark, "labels"))
    return spark.read.parquet(path).groupBy("split").agg(
        F.count("*").alias("n_entities"), F.sum("target").alias("n_positive"))


@query
def aligned_features(spark, sf_dir):
    """Feature columns in another order, and one too many, put back as a model wants them."""
    features = numeric_features(st.statements(spark, sf_dir), ORDERS)
    expected = [c for c in features.columns if c != "o_custkey"]
    mixed = features.withColumn("extra", F.lit(1)).select("extra", *reversed(features.columns))
    out = audits.align_features(mixed, "o_custkey", expected)
    audits.require_same_columns(out, features)
    return out


@query
def model_inputs(spark, sf_dir):
    """Missing features as the value below all others, per feature."""
    features = numeric_features(st.statements(spark, sf_dir), ORDERS)
    expected = [c for c in features.columns if c != "o_custkey"]
    rows = trees.model_input(features, ORDERS, expected, {})
    return rows.unpivot(["o_custkey"], expected, "feature", "value").groupBy("feature").agg(
        F.count("value").alias("n_values"), F.count_if(F.col("value") == trees.MISSING_VALUE).alias("n_missing"))


@query
def split_report(spark, sf_dir):
    return splits.split_report(_routed(spark, sf_dir), ORDERS)


@query
def class_balance(spark, sf_dir):
    assigned = splits.assign_splits(st.customer_labels(spark, sf_dir), CUSTOMERS)
    return splits.class_balance(assigned, CUSTOMERS).withColumn(
        "positive_share", F.round("positive_share", 6))


@query
def split_overlap(spark, sf_dir):
    """Orders filed by status put most customers in several "splits"."""
    return splits.split_overlap(st.statements(spark, sf_dir), ORDERS, "o_orderstatus",
                                ["F", "O", "P"])


@query
def label_coverage(spark, sf_dir):
    """Every customer is labelled twice, once under an id that has no statement."""
    known = st.customer_labels(spark, sf_dir)
    absent = known.withColumn("o_custkey", F.col("o_custkey") + 10_000_000)
    assigned = splits.assign_splits(known.unionByName(absent), CUSTOMERS)
    return splits.label_coverage(assigned, st.statements(spark, sf_dir), CUSTOMERS)


@query
def concat_splits(spark, sf_dir):
    path = writers.write_splits(_routed(spark, sf_dir), scratch_path(spark, "splits"))
    parts = [spark.read.parquet(f"{path}/split={n}").withColumn("split", F.lit(n))
             for n in ORDERS.ratios]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return whole.groupBy("split").agg(
        F.count("*").alias("n_rows"), F.sum("amount").alias("amount"))


# --- label joins -----------------------------------------------------------

@query
def features_with_labels(spark, sf_dir):
    return joins.join_labels(
        st.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"),
        st.table(spark, sf_dir, "labels"), DOCUMENTS)


@query
def label_audit(spark, sf_dir):
    return joins.label_audit(st.table(spark, sf_dir, "documents"),
                             st.table(spark, sf_dir, "labels"), DOCUMENTS)


@query
def evaluate_counts(spark, sf_dir):
    docs = st.table(spark, sf_dir, "documents").withColumnRenamed("n_chars", "prediction")
    labels = st.table(spark, sf_dir, "labels")
    counts = joins.require_matches(joins.label_audit(docs, labels, DOCUMENTS))
    scored = joins.join_labels(docs.select("doc_id", "prediction"), labels, DOCUMENTS)
    auc = metric.ranking_metric(scored, "doc_id", "quality").select(F.round("auc", 6)).scalar()
    return counts.select("n_evaluated", "n_unmatched", auc.alias("auc"))


# --- ranking metric --------------------------------------------------------

@query
def ranking_metric(spark, sf_dir):
    return metric.rounded_metric(metric.ranking_metric(
        st.document_scores(spark, sf_dir), "doc_id"))


@query
def ranking_metric_orders(spark, sf_dir):
    return metric.rounded_metric(metric.ranking_metric(
        st.order_scores(spark, sf_dir), "o_orderkey"))


@query
def ranking_metric_tied(spark, sf_dir):
    """Five distinct scores over all orders: every range is one tie."""
    scored = st.order_scores(spark, sf_dir).withColumn(
        "prediction", F.substring("o_orderpriority", 1, 1).cast("double"))
    return metric.rounded_metric(metric.ranking_metric(scored, "o_orderkey"))


@query
def metric_by_group(spark, sf_dir):
    return metric.rounded_metric(metric.ranking_metric(
        st.order_scores(spark, sf_dir), "o_orderkey", groups=["o_orderpriority"]))


@query
def metric_by_lang(spark, sf_dir):
    return metric.rounded_metric(metric.ranking_metric(
        st.document_scores(spark, sf_dir), "doc_id", groups=["lang"]))


@query
def gini(spark, sf_dir):
    return metric.ranking_metric(st.order_scores(spark, sf_dir), "o_orderkey").select(
        F.round("gini", 6).alias("gini"))


@query
def top4_capture(spark, sf_dir):
    return metric.ranking_metric(st.order_scores(spark, sf_dir), "o_orderkey").select(
        F.round("top4", 6).alias("top4"))


@query
def metric_totals(spark, sf_dir):
    return metric.metric_totals(st.order_scores(spark, sf_dir), groups=["o_orderpriority"])


@query
def gain_curve(spark, sf_dir):
    curve = metric.gain_curve(st.document_scores(spark, sf_dir), "doc_id")
    return curve.withColumn("lorentz", F.round("lorentz", 6)).withColumn(
        "random", F.round("random", 6))


@query
def gain_curve_orders(spark, sf_dir):
    return metric.gain_curve(st.order_scores(spark, sf_dir), "o_orderkey").select(
        "o_orderkey", "cum_weight", "cum_positive")


@query
def running_total_of_large_keys(spark, sf_dir):
    """Order keys moved past the whole numbers that a double tells apart."""
    rows = st.table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderkey") + F.lit(1 << 60)).alias("key"),
        st.cents("o_totalprice").alias("amount"))
    return prefix_sum(rows, "key", "o_orderkey", {"amount": "cum_amount"}, descending=False).select(
        "o_orderkey", "cum_amount")


@query
def running_total(spark, sf_dir):
    rows = st.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", st.cents("o_totalprice").alias("amount"))
    return prefix_sum(rows, "o_totalprice", "o_orderkey", {"amount": "cum_amount"},
                      ["o_orderstatus"]).select(
        "o_orderkey", "o_orderstatus", "cum_amount", "cum_amount_total")


@query
def running_total_partitioned(spark, sf_dir):
    """The same total over ranges that Spark's range partitioner makes, one value shared by a tenth of the rows."""
    rows = st.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 10 == 0, 150_000.0).otherwise(
            F.col("o_totalprice")).alias("price"), st.cents("o_totalprice").alias("amount"))
    return prefix_sum(rows, "price", "o_orderkey", {"amount": "cum_amount"}, ["o_orderstatus"], literal=0).select(
        "o_orderkey", "o_orderstatus", "cum_amount", "cum_amount_total")


@query
def best_iteration_by_run(spark, sf_dir):
    """Users are runs, days are rounds, the day's highest value is the score."""
    daily = st.table(spark, sf_dir, "events").groupBy(
        "user_id", F.dayofmonth("ts").alias("iteration")).agg(F.max("value").alias("score"))
    return best_iteration(daily, runs=["user_id"], patience=6)


# --- audits ----------------------------------------------------------------

@query
def overflow_audit(spark, sf_dir):
    return audits.overflow_audit(st.table(spark, sf_dir, "lineitem")).withColumn(
        "peak", F.col("peak").cast("double"))


@query
def half_precision(spark, sf_dir):
    price = half_round(F.col("l_extendedprice")).cast("double")
    return st.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        half_round(F.col("l_discount")).cast("double").alias("discount"),
        half_round(F.col("l_tax")).cast("double").alias("tax"),
        F.when(price != float("inf"), price).alias("price"),
        (price == float("inf")).alias("overflows"))


@query
def contiguity_audit(spark, sf_dir):
    return audits.contiguity_audit(st.table(spark, sf_dir, "events"), "user_id", "event_id")


@query
def contiguity_tied(spark, sf_dir):
    """Half of the events share one place in the sequence, a fifth has none."""
    key = F.col("event_id")
    rows = st.table(spark, sf_dir, "events").select("user_id", F.when(key % 5 != 0, F.when(
        key % 2 == 0, 1000).otherwise(key)).alias("seq"))
    return audits.contiguity_audit(rows, "user_id", "seq")


@query
def contiguity_of_files(spark, sf_dir):
    """Events written in another order to several files, judged as the files hold them."""
    path, group = scratch_path(spark, "event-files"), F.col("user_id") % 7
    (st.table(spark, sf_dir, "events").withColumn("part", group).repartitionByRange(4, "part", "event_id")
     .sortWithinPartitions("part", "event_id").write.parquet(path))
    return audits.file_contiguity_audit(spark.read.parquet(path), "user_id", part_rows=1000)


@query
def order_audit(spark, sf_dir):
    return audits.order_audit(st.table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate",
                              "o_orderkey")


@query
def entity_sample(spark, sf_dir):
    return audits.entity_sample(st.statements(spark, sf_dir), "o_custkey", 30).select(
        "o_custkey", "o_orderkey", "amount")


@query
def scan_metadata(spark, sf_dir):
    shapes = [readers.table_shape(st.table(spark, sf_dir, name)).withColumn(
        "table_name", F.lit(name)) for name in TABLES]
    out = shapes[0]
    for shape in shapes[1:]:
        out = out.unionByName(shape)
    return out


# --- importance ------------------------------------------------------------

def _importance(spark, sf_dir):
    return importance.importance_table(st.part_gains(spark, sf_dir), st.FEATURE_CATEGORIES)


@query
def importance_table(spark, sf_dir):
    return importance.ranked(_importance(spark, sf_dir)).withColumn(
        "gain_pct", F.round("gain_pct", 6))


@query
def importance_merged(spark, sf_dir):
    return importance.ranked(importance.merge_by_base(_importance(spark, sf_dir))).withColumn(
        "gain_pct", F.round("gain_pct", 6))


@query
def importance_topk(spark, sf_dir):
    return importance.top_features(_importance(spark, sf_dir), 20).withColumns(
        {"gain_pct": F.round("gain_pct", 6), "cum_pct": F.round("cum_pct", 6)})


@query
def unused_features(spark, sf_dir):
    return importance.unused_features(_importance(spark, sf_dir))


@query
def base_columns(spark, sf_dir):
    return st.part_gains(spark, sf_dir).select(
        "feature", base_column(F.col("feature"), st.FEATURE_CATEGORIES).alias("base"))


# --- sources and sinks -----------------------------------------------------

@query
def csv_statements(spark, sf_dir):
    """Statements written as CSV, probed, and read back under the pinned schema."""
    path = writers.write_csv(st.statements(spark, sf_dir), scratch_path(spark, "statements-csv"))
    rows = readers.read_statements(spark, path, kind="csv", id_col="o_custkey")
    return rows.withColumn("half", F.nanvl("half", F.lit(None).cast("double")))


@query
def csv_late_types(spark, sf_dir):
    """The last orders turn a whole number into a fraction and fill an empty column."""
    orders = st.table(spark, sf_dir, "orders")
    late = F.col("o_orderkey") > orders.agg(F.max("o_orderkey")).scalar() * 0.9
    rows = orders.select(
        "o_orderkey", F.concat(F.col("o_custkey"), F.when(late, ".5").otherwise("")).alias("v"),
        F.when(late, F.concat(F.lit("text "), "o_orderkey")).alias("w"))
    path = writers.write_csv(rows.orderBy("o_orderkey"), scratch_path(spark, "late-csv"))
    return readers.read_statements(spark, path)


@query
def csv_strict_types(spark, sf_dir):
    """Texts that only look like numbers stay as they are, next to numbers in every notation."""
    key = F.col("o_orderkey")
    rows = st.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 3 == 0, "1d").when(key % 3 == 1, "01").otherwise("1").alias("level"),
        F.when(key % 5 == 0, "007").otherwise(key.cast("string")).alias("padded"),
        F.when(key % 4 == 0, "1e3").when(key % 4 == 1, "NaN").when(key % 4 == 2, ".5").otherwise("-12").alias("number"),
        F.when(key % 2 == 0, F.concat(F.lit("9007199254"), F.lpad(key.cast("string"), 8, "0"))).otherwise("0.5")
        .alias("precise"),
        F.concat(F.lit("9007199254"), F.lpad(key.cast("string"), 8, "0")).alias("long_key"))
    got = readers.read_statements(spark, writers.write_csv(rows, scratch_path(spark, "strict-csv")))
    return got.withColumn("number", F.nanvl("number", F.lit(None).cast("double")))


@query
def format_sniffing(spark, sf_dir):
    """The same rows as parquet and as CSV, both without an extension."""
    rows = st.statements(spark, sf_dir).select("o_orderkey", "o_custkey", "amount")
    paths = {"parquet": writers.write_table(rows, scratch_path(spark, "sniffed")),
             "csv": writers.write_csv(rows, scratch_path(spark, "sniffed"))}
    read = [readers.read_statements(spark, path).withColumn("kind", F.lit(kind)) for kind, path in paths.items()]
    return read[0].unionByName(read[1]).groupBy("kind").agg(
        F.count("*").alias("n_rows"), F.count("amount").alias("n_amounts"), F.sum("amount").alias("amount"))


@query
def split_sink(spark, sf_dir):
    path = writers.write_splits(_routed(spark, sf_dir), scratch_path(spark, "splits"))
    return spark.read.parquet(path).where("split = 'test'").select(
        "o_orderkey", "o_custkey", "amount")


@query
def prediction_sink(spark, sf_dir):
    scored = st.document_scores(spark, sf_dir).select(
        "doc_id", (F.col("prediction") / 8).alias("prediction"))
    path = writers.write_table(scored, scratch_path(spark, "predictions"))
    text = writers.write_csv(spark.read.parquet(path), scratch_path(spark, "predictions-csv"))
    return readers.read_csv(spark, text, "doc_id bigint, prediction double")


@query
def materialize_features(spark, sf_dir):
    rows = st.statements(spark, sf_dir)
    path = scratch_path(spark, "features")
    key = {"table": "orders", "version": 2}
    build = lambda: numeric_features(rows, ORDERS)                      # noqa: E731
    artifacts.materialize(spark, build, path, key)
    return artifacts.materialize(spark, build, path, key)


# --- lineage and runs ------------------------------------------------------

@query
def table_digests(spark, sf_dir):
    rows = st.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", st.cents("o_totalprice").alias("cents"))
    return table_digest(rows)


@query
def content_digests(spark, sf_dir):
    """Orders in files of their own: what is left after taking the second half's files away again."""
    orders = st.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path = scratch_path(spark, "order-files")
    orders.repartition(6, "o_custkey").write.parquet(path)
    per_file = file_digests(spark.read.parquet(path))
    late = content_digest(orders.where("o_orderkey % 2 = 1"))
    left = add_digests(
        per_file.select("n_rows", "lanes", F.lit(1).alias("sign")).unionByName(
            late.withColumn("sign", F.lit(-1))), F.col("sign"))
    return left.select("n_rows", digest_text(F.col("n_rows"), F.col("lanes")).alias("digest"))


@query
def split_id(spark, sf_dir):
    """Labels and statements both go into the id."""
    labels = table_digest(st.customer_labels(spark, sf_dir))
    rows = table_digest(st.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"))
    parts = [c for frame in (labels, rows) for c in (
        frame.select(F.col("n_rows").cast("string")).scalar(), frame.select("digest").scalar())]
    return spark.range(1).select(split_digest(
        F.concat_ws(":", *parts), CUSTOMERS.seed, CUSTOMERS.ratios).alias("split_id"))


@query
def lineage_current(spark, sf_dir):
    return lineage.current(st.order_lineage(spark, sf_dir), "artifact",
                           ["written", "record_no"]).select("artifact", "record_no", "split_id")


@query
def same_split_guard(spark, sf_dir):
    latest = lineage.current(st.order_lineage(spark, sf_dir), "artifact", ["written", "record_no"])
    nations = st.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("artifact"), "c_nationkey")
    return lineage.split_guard(latest.join(nations, "artifact"), ["c_nationkey"])


@query
def inherited_split(spark, sf_dir):
    """Line items are derived artifacts: each takes the split of its order's customer record."""
    latest = lineage.current(st.order_lineage(spark, sf_dir), "artifact", ["written", "record_no"])
    orders = st.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    derived = joins.lookup_join(
        orders, latest.select(F.col("artifact").alias("o_custkey"), "split_id"), "o_custkey")
    return derived.groupBy("split_id").agg(F.count("*").alias("n_derived"))


@query
def latest_run(spark, sf_dir):
    return registry.latest_run(st.event_runs(spark, sf_dir))


@query
def latest_run_by_user(spark, sf_dir):
    return registry.latest_run(st.event_runs(spark, sf_dir), ["user_id"])


@query
def best_run(spark, sf_dir):
    return registry.best_run(st.event_runs(spark, sf_dir), ["user_id"])


@query
def run_log(spark, sf_dir):
    """Runs appended to the log in two writes and read back under its schema."""
    root = scratch_path(spark, "registry")
    runs = st.event_runs(spark, sf_dir).select(
        F.col("run_id").cast("string").alias("run_id"), F.col("written").cast("timestamp").alias("written"),
        "score", F.col("user_id").cast("string").alias("split_id"))
    early = F.col("written") < F.lit("2024-01-15").cast("timestamp")
    runs.where(early).write.mode("append").json(f"{root}/runs")
    runs.where(~early).write.mode("append").json(f"{root}/runs")
    return registry.list_runs(spark, root).select("run_id", "score", "split_id")


@query
def run_metadata(spark, sf_dir):
    """Run metadata emitted as JSON text, parsed under its schema, and summarised."""
    meta = st.table(spark, sf_dir, "customer").select(F.to_json(F.struct(
        F.col("c_name").alias("run_id"), F.col("c_mktsegment").alias("split_id"),
        F.col("c_nationkey").alias("feature_version"),
        F.array("c_name", "c_mktsegment").alias("feature_name"),
        F.create_map(F.col("c_mktsegment"), F.array(F.col("c_name"), F.lit("NaN"))).alias("categories"),
        F.struct(F.col("c_acctbal").alias("score")).alias("valid_metric"))).alias("text"))
    parsed = meta.select(F.from_json("text", registry.META_SCHEMA).alias("m")).select("m.*")
    return parsed.select(
        "run_id", "split_id", "feature_version", F.col("valid_metric.score").alias("score"),
        F.size("feature_name").alias("n_features"),
        F.element_at("categories", F.col("split_id"))[1].alias("last_level"))


@query
def statement_tables(spark, sf_dir):
    """Which tables hold the columns of a statement table, and how many rows they have."""
    parts = []
    for name in ("orders", "lineitem", "customer", "events", "documents"):
        rows, fits = st.table(spark, sf_dir, name), True
        try:
            ORDERS.require(rows.columns)
        except KeyError:
            fits = False
        parts.append(rows.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("tab"), "n_rows", F.lit(fits).alias("is_statements")))
    return reduce(DataFrame.unionByName, parts)


@query
def lacking_features(spark, sf_dir):
    """Features built without one level, where a model expects all: refused, with the feature's name."""
    rows = st.statements(spark, sf_dir)
    whole = vocabulary.fit_vocabulary(rows, ORDERS)
    expected = [c for c in category_features(rows, ORDERS, whole).columns if c != "o_custkey"]
    fewer = rows.where("o_orderstatus <> 'P'")
    features = category_features(fewer, ORDERS, vocabulary.fit_vocabulary(fewer, ORDERS) | {
        "o_orderpriority": whole["o_orderpriority"]})
    refused = False
    try:
        audits.align_features(features, "o_custkey", expected)
    except KeyError:
        refused = True
    return features.agg(F.count("*").alias("n_entities")).select(
        "n_entities", F.lit(refused).alias("refused"),
        F.array(*[F.lit(c) for c in expected if c not in features.columns]).alias("lacking"))


# --- models ----------------------------------------------------------------

def _fitted(spark, sf_dir):
    """A small model on order features, fitted on the train customers."""
    rows = st.statements(spark, sf_dir)
    labels = st.customer_labels(spark, sf_dir)
    routed = splits.route_labelled(rows, labels, CUSTOMERS)
    path = writers.write_splits(routed, scratch_path(spark, "model-splits"))
    train_rows = spark.read.parquet(f"{path}/split=train")
    levels = vocabulary.fit_vocabulary(train_rows, ORDERS)
    features = writers.write_table(collapse(train_rows, ORDERS, levels),
                                   scratch_path(spark, "train-features"))
    train = joins.join_labels(spark.read.parquet(features), labels, CUSTOMERS)
    expected = [c for c in train.columns if c not in ("o_custkey", "target")]
    small = {"maxIter": 4, "maxDepth": 3, "featureSubsetStrategy": "all", "subsamplingRate": 1.0}
    model = trees.fit_trees(train, CUSTOMERS, expected, code_levels(levels), small)
    held_out = spark.read.parquet(f"{path}/split=test")
    return model, levels, held_out, labels, expected


@query
def train_score_evaluate(spark, sf_dir):
    from dossier.plans.workflow import evaluate_job
    model, levels, held_out, labels, _ = _fitted(spark, sf_dir)
    return evaluate_job(spark, held_out, labels, model, replace(ORDERS, target_col="target"), levels)


@query
def staged_metric(spark, sf_dir):
    model, levels, held_out, labels, _ = _fitted(spark, sf_dir)
    labelled = joins.join_labels(collapse(held_out, ORDERS, levels), labels, CUSTOMERS)
    path = writers.write_table(
        trees.staged_scores(labelled, model, CUSTOMERS, code_levels(levels), 2, ["target"]),
        scratch_path(spark, "staged"))
    return metric.rounded_metric(trees.staged_metric(spark.read.parquet(path), CUSTOMERS))


@query
def staged_rounds(spark, sf_dir):
    """Every round's scores against those of the model cut to that many trees."""
    model, levels, held_out, labels, _ = _fitted(spark, sf_dir)
    features = spark.read.parquet(writers.write_table(
        collapse(held_out, ORDERS, levels), scratch_path(spark, "held-out-features")))
    staged = spark.read.parquet(writers.write_table(
        trees.staged_scores(features, model, CUSTOMERS, code_levels(levels)), scratch_path(spark, "staged")))
    parts = [trees.score(features, model, CUSTOMERS, code_levels(levels), k, "cut").withColumn("iteration", F.lit(k))
             for k in range(1, trees.trees_of(model).getNumTrees + 1)]
    cut = parts[0]
    for part in parts[1:]:
        cut = cut.unionByName(part)
    return staged.join(cut, ["o_custkey", "iteration"], "full").groupBy("iteration").agg(
        F.count("*").alias("n_rows"),
        (F.max(F.abs(F.col("prediction") - F.col("cut"))) < 1e-9).alias("equal"))


@query
def evaluated_counts(spark, sf_dir):
    from dossier.plans.workflow import evaluate_job
    model, levels, held_out, labels, _ = _fitted(spark, sf_dir)
    report = evaluate_job(spark, held_out, labels.where("target IS NOT NULL"), model,
                          replace(ORDERS, target_col="target"), levels)
    return report.select("n_evaluated", "n_unmatched", F.col("auc").between(0, 1).alias("auc_in_range"))


@query
def importance_shares(spark, sf_dir):
    """The share of each feature in the node table against the model's own."""
    model, _, _, _, expected = _fitted(spark, sf_dir)
    path = scratch_path(spark, "model")
    model.write().save(path)
    own = spark.createDataFrame(
        list(zip(expected, trees.trees_of(model).featureImportances.toArray().tolist())),
        "feature string, own double")
    table = importance.importance_table(trees.feature_gains(spark, path, expected), ORDERS.cat_cols)
    return table.join(own, "feature").select(
        "feature", (F.abs(F.col("gain_pct") / 100 - F.col("own")) < 1e-9).alias("agrees"))


def _split_run(spark, sf_dir, **changes):
    from dossier.plans.workflow import split_job
    spec = replace(ORDERS, target_col="target", **changes)
    out = scratch_path(spark, "split-job")
    return split_job(spark, st.statements(spark, sf_dir), st.customer_labels(spark, sf_dir), out, spec), out, spec


@query
def split_lineage(spark, sf_dir):
    """What the split job records of each file it writes."""
    cut, out, _ = _split_run(spark, sf_dir)
    log = lineage.current(lineage.load(spark, f"{out}/lineage"))
    place = lambda i: F.regexp_extract("artifact", r"(statements|labels)/split=(\w+)$", i)      # noqa: E731
    return log.select(
        place(1).alias("kind"), place(2).alias("split"), "rows", "customers", "positives", "seed",
        (F.col("split_id") == cut.split_id).alias("same_split"))


@query
def trained_run(spark, sf_dir):
    """The shipped settings but for the number of rounds: split, train, register, predict, guard."""
    from pyspark.ml import PipelineModel

    from dossier.plans.workflow import folder, predict_job, train_job
    cut, out, spec = _split_run(spark, sf_dir)
    root = scratch_path(spark, "runs")
    run = train_job(spark, out, root, spec, {"maxIter": 5})
    path = registry.resolve_model(spark, root)
    meta = registry.load_meta(spark, path)
    predictions, scored, audit = predict_job(
        spark, folder(cut.statements, "test"), out, root, scratch_path(spark, "predicted"), spec,
        labels=folder(cut.labels, "test"))
    other, elsewhere, _ = _split_run(spark, sf_dir, seed=7)
    refused = False
    try:
        predict_job(spark, folder(other.statements, "test"), elsewhere, root, scratch_path(spark, "refused"), spec)
    except ValueError:
        refused = True
    kept = trees.trees_of(PipelineModel.load(path)).getNumTrees
    logged = registry.best_run(registry.list_runs(spark, root)).first()
    return spark.createDataFrame(
        [(predictions.count(), scored.first().n_rows, audit.first().n_unlabelled,
          logged.run_id == run == meta["run_id"], kept == meta["best_iteration"] <= 5,
          meta["split_id"] == cut.split_id, logged.score == meta["valid_metric"]["score"], refused)],
        "n_scored long, n_evaluated long, n_unlabelled long, logged boolean, cut_to_best boolean, "
        "same_split boolean, same_score boolean, refused boolean")


@query
def stopped_run(spark, sf_dir):
    """A run that patience ends long before ``maxIter``, held against ranking every round of its saved trees."""
    from pyspark.ml import PipelineModel

    from dossier.plans.workflow import folder, train_job
    cut, out, spec = _split_run(spark, sf_dir)
    root, patience, block = scratch_path(spark, "runs"), 3, 4
    train_job(spark, out, root, spec, {
        "maxIter": 200, "maxDepth": 3, "minInstancesPerNode": 5, "stepSize": 0.5}, patience, block)
    path = registry.resolve_model(spark, root)
    meta = registry.load_meta(spark, path)
    model = PipelineModel.load(path)
    features = collapse(spark.read.parquet(folder(cut.statements, "validation")), spec, meta["categories"])
    labelled = joins.join_labels(features, spark.read.parquet(folder(cut.labels, "validation")), spec)
    staged = spark.read.parquet(writers.write_table(trees.staged_scores(
        labelled, model, spec, code_levels(meta["categories"]), 1, ["target"]), scratch_path(spark, "staged")))
    by_round = trees.staged_metric(staged, spec)
    picked = best_iteration(by_round, patience=patience).first()
    kept, fitted = meta["best_iteration"], meta["rounds_fitted"]
    return spark.createDataFrame(
        [(staged.where("iteration = 1").count(), trees.trees_of(model).getNumTrees == kept == picked.best_iteration,
          kept + patience <= fitted < kept + patience + block, fitted < 200,
          abs(picked.best_score - meta["valid_metric"]["score"]) < 1e-12)],
        "n_validation long, keeps_best boolean, stops_in_time boolean, stops_early boolean, same_score boolean")


@query
def round_histograms(spark, sf_dir):
    """Orders scored in three rounds: the metric of each, and whether the histogram's bounds hold it."""
    x = F.col("prediction") / 250_000 - 1
    tied = (F.col("o_orderkey") * 7919 % 1000).cast("double") / 1000
    rows = st.order_scores(spark, sf_dir).select("o_orderkey", "target", F.array(x, -x, tied).alias("margins"))
    bounds = rounds.round_bounds(rounds.round_histogram(rows, "target")).select("place", "low", "high")
    exact = rounds.exact_rounds(rows, "o_orderkey", "target", [0, 1, 2])
    return metric.rounded_metric(exact.join(bounds, "place").withColumn(
        "inside", F.col("score").between(F.col("low"), F.col("high"))).drop("low", "high"))


@query
def importance_report(spark, sf_dir):
    """The report as a job: a loose model, its rankings as CSV files, read back."""
    from dossier.plans.workflow import importance_job
    model, levels, _, _, expected = _fitted(spark, sf_dir)
    path, out = scratch_path(spark, "loose-model"), scratch_path(spark, "report")
    model.write().save(path)
    registry.save_meta(spark, f"{path}.meta", {
        "feature_name": expected, "cat_cols": list(ORDERS.cat_cols), "categories": levels})
    importance_job(spark, scratch_path(spark, "no-runs"), out, model_path=path)
    merged = readers.read_statements(spark, f"{out}/gain_merged", kind="csv")
    return merged.select("feature", F.col("parts").cast("bigint").alias("parts"),
                         F.col("gain_pct").between(0, 100).alias("in_share"))


@query
def gbt_importance(spark, sf_dir):
    model, _, _, _, expected = _fitted(spark, sf_dir)
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    table = importance.importance_table(
        trees.feature_gains(spark, path, expected), ORDERS.cat_cols)
    return importance.ranked(importance.merge_by_base(table))


# --- streaming -------------------------------------------------------------

@query
def stream_route(spark, sf_dir):
    assigned = st.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    spec = replace(EVENTS, target_col="target")
    labels = assigned.withColumn("target", F.lit(0))
    assigned = splits.assign_splits(labels, spec)
    schema = st.table(spark, sf_dir, "events").schema
    stream = jobs.read_stream(spark, sf_dir, schema, glob="events.parquet")
    out, checkpoint = scratch_path(spark, "routed"), scratch_path(spark, "checkpoint")
    jobs.route_stream(stream, assigned, spec, out, checkpoint).awaitTermination()
    return spark.read.parquet(out).select("event_id", "user_id", "split")


@query
def stream_snapshot(spark, sf_dir):
    """The change table compacted half way through the stream and again at its end."""
    rows = st.event_statements(spark, sf_dir)
    fitted = vocabulary.fit_vocabulary(rows, EVENTS)
    feed, out = scratch_path(spark, "feed"), scratch_path(spark, "changes")
    checkpoint, snapshot = scratch_path(spark, "checkpoint"), scratch_path(spark, "snapshot")
    parts = rows.withColumn("part", F.col("event_id") % 2)
    for part in (0, 1):
        parts.where(F.col("part") == part).drop("part").write.mode("append").parquet(feed)
        stream = jobs.read_stream(spark, feed, rows.schema)
        jobs.collapse_stream(stream, EVENTS, fitted, out, checkpoint, value_type="double").awaitTermination()
        current = jobs.compact_features(spark, out, snapshot, "user_id")
    return current


@query
def stream_collapse(spark, sf_dir):
    rows = st.event_statements(spark, sf_dir)
    fitted = vocabulary.fit_vocabulary(rows, EVENTS)
    feed = scratch_path(spark, "feed")
    rows.repartition(3, "event_id").write.parquet(feed)
    stream = jobs.read_stream(spark, feed, rows.schema, files_per_batch=1)
    out, checkpoint = scratch_path(spark, "changes"), scratch_path(spark, "checkpoint")
    jobs.collapse_stream(stream, EVENTS, fitted, out, checkpoint,
                         value_type="double").awaitTermination()
    return jobs.latest_features(spark.read.parquet(out), "user_id")
