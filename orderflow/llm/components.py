"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderflow.session import materialize


#: Links that one task takes; few links run in one task, without any exchange.
LINKS_PER_TASK = 200_000


def _star(links: DataFrame, larger: bool, tasks: int) -> DataFrame:
    """Every node's neighbours (the larger ones, or itself and the smaller ones) joined to the least of all of them."""
    if larger:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).coalesce(tasks)
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("_near")).select("a", F.least("a", "_near").alias("_least"))
    joined = both.join(least, "a")
    if larger:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("_least").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("_least").alias("b")).unionByName(
            least.select("a", F.col("_least").alias("b"))
        )
    return out.where("a <> b").coalesce(tasks).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the least node of its component.

    The rounds end when a whole round changes no link; then every link goes straight to its root.
    """
    links = materialize(links.where("a <> b").select("a", "b").distinct(), "links")
    mark = None
    while True:
        count, checksum = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (count, checksum) == mark:
            break
        mark, tasks = (count, checksum), max(1, -(-count // LINKS_PER_TASK))
        links = links.coalesce(tasks)
        links = materialize(_star(_star(links, True, tasks), False, tasks), "links")
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
