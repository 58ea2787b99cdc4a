"""Statements, labels, scores and logs, read out of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dossier.spec import EntitySpec

ORDERS = EntitySpec(id_col="o_custkey", date_col="o_orderdate", seq_col="o_orderkey",
                    cat_cols=("o_orderstatus", "o_orderpriority"))
CUSTOMERS = EntitySpec(id_col="o_custkey", target_col="target", cat_cols=())
EVENTS = EntitySpec(id_col="user_id", date_col="ts", seq_col="event_id",
                    cat_cols=("event_type",), date_unit="micro")
EVENT_LEVELS = EntitySpec(id_col="user_id", date_col="ts", seq_col="event_id",
                          cat_cols=("event_type", "props"), date_unit="micro")
PARTS = EntitySpec(id_col="p_partkey", date_col=None, cat_cols=("p_size", "p_type"))
DOCUMENTS = EntitySpec(id_col="doc_id", target_col="quality", cat_cols=())
FEATURE_CATEGORIES = ("B_30", "B_38", "D_63")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(col: str):
    return F.round(F.col(col) * 100).cast("bigint")


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as statements of their customer, with missing numbers, NaN and empty levels."""
    amount = F.when(F.col("o_orderpriority") != "5-LOW", cents("o_totalprice"))
    half = F.when(F.col("o_orderstatus") == "P", F.lit(float("nan"))).otherwise(
        cents("o_totalprice") / 2)
    return table(spark, sf_dir, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderkey",
        amount.alias("amount"), half.alias("half"), "o_orderstatus",
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "")
        .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))


def event_statements(spark: SparkSession, sf_dir: str, spec: EntitySpec = EVENTS) -> DataFrame:
    """Events as statements of their user; errors have no value."""
    return table(spark, sf_dir, "events").select(
        "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id",
        F.when(F.col("event_type") != "error", cents("value")).alias("amount"), *spec.cat_cols)


def customer_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        (F.col("c_acctbal") < 0).cast("int").alias("target"))


def document_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents, scored by their length: tied scores, few negatives."""
    return table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels"), "doc_id").select(
        "doc_id", "lang", F.col("quality").alias("target"), F.col("n_chars").alias("prediction"))


def order_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority",
        (F.col("o_orderstatus") == "F").cast("int").alias("target"),
        F.col("o_totalprice").alias("prediction"))


def part_gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feature importance table: parts are splits, their price is the gain."""
    p = table(spark, sf_dir, "part")
    i = F.col("p_partkey") % 8
    feature = (
        F.when(i == 0, F.concat(F.lit("B_30_"), F.col("p_size").cast("string")))
        .when(i == 1, F.concat(F.lit("D_63_"), F.lower("p_type")))
        .when(i == 2, F.concat(F.lit("P_"), F.col("p_size").cast("string"), F.lit("_mean")))
        .when(i == 3, F.concat(F.lit("P_"), F.col("p_size").cast("string"), F.lit("_max")))
        .when(i == 4, F.concat(F.lit("P_"), F.col("p_size").cast("string"), F.lit("_last")))
        .when(i == 5, F.concat(F.lit("P_"), F.col("p_size").cast("string"), F.lit("_diff")))
        .when(i == 6, F.lit("B_38_last"))
        .otherwise(F.concat(F.lit("S_"), F.col("p_size").cast("string"))))
    gain = F.when(F.col("p_size") == 7, 0).otherwise(cents("p_retailprice"))
    return p.groupBy(feature.alias("feature")).agg(
        F.sum(gain).alias("gain"), F.count("*").alias("splits"))


def order_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lineage log: customers are artifacts, each order a later record of one."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("artifact"), F.col("o_orderdate").alias("written"),
        F.col("o_orderkey").alias("record_no"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("split_id"))


def event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run log: every event is a run of its user; failed ones have no score."""
    return table(spark, sf_dir, "events").select(
        "user_id", F.col("event_id").alias("run_id"), F.col("ts").alias("written"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("score"))
