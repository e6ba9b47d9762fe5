"""Connected components by alternating stars, in a number of rounds logarithmic in the size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.session import stored

LINKS = 1 << 17  # of a task: rounds over few links run in few tasks, whatever the partitions of a shuffle


def _star(edges: DataFrame, large: bool, tasks: int) -> DataFrame:
    """Hang each node's larger (or its smaller) neighbours on its smallest neighbour.

    ``edges`` are rows (u, v) with v < u, and so is what comes out.
    """
    seen = edges
    if large:  # a generator and no union, which would read the links twice
        ends = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
        seen = edges.select(F.explode(ends).alias("end")).select("end.*")
    least = seen.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    hung = seen.join(least, "u").coalesce(tasks)
    if large:
        moved = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # the smallest neighbour gets the node itself
        moved = hung.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").distinct().coalesce(tasks)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (u, v); the root is the smallest node.  Rounds
    go on until no link moves; each is written, so that lost executors cost one round."""
    edges = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(state) == before or state[0] == 0:
            break
        before = tuple(state)
        tasks = -(-state[0] // LINKS)
        edges = stored(_star(_star(edges.coalesce(tasks), True, tasks), False, tasks), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
