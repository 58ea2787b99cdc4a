"""Connected components of a link table, in rounds of joins and written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dossier.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node it is linked to by any path; ``links`` holds a, b (long).

    Each round every node takes the smallest label among its own and its neighbours', then the label of
    that label, so that chains shrink by halves. Labels stand in a table of the shared folder.
    """
    edges = written(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b").distinct(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    while True:
        near = (
            edges.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near")))
        hooked = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.least("root", "near").alias("root"), F.col("root").alias("before"))
        hooked = written(hooked, "hooked")
        up = hooked.select(F.col("node").alias("over"), F.col("root").alias("up"))
        after = written(hooked.join(up, F.col("root") == F.col("over"), "left").select(
            "node", F.coalesce(F.least("root", "up"), "root").alias("root"), "before"), "labels")
        labels = after.select("node", "root")
        if not after.where("root <> before").limit(1).count():
            return labels
