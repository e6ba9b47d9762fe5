"""Hierarchical categories such as ``/electronics/audio``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def facet_path(text: Column, strict: bool = True) -> Column:
    """Path text with its leading slash; an empty or broken path is an error, or null."""
    path = F.when(text.startswith("/"), text).otherwise(F.concat(F.lit("/"), text))
    broken = (path == "/") | path.contains("//") | path.endswith("/")
    bad = F.lit(None).cast("string")
    if strict:
        bad = F.raise_error(F.concat(F.lit("invalid facet path: "), text)).cast("string")
    return F.when(text.isNull(), F.lit(None)).when(broken, bad).otherwise(path)


def ancestors(path: Column) -> Column:
    """The path and every path above it, shortest first."""
    parts = F.split(F.substring(path, 2, 1 << 30), "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda n: F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, n), "/")),
    )


def parent(path: Column) -> Column:
    """Path one level up; the root of a top-level path is ``/``."""
    up = F.regexp_replace(path, "/[^/]*$", "")
    return F.when(up == "", F.lit("/")).otherwise(up)


def under_path(paths: Column, path: str) -> Column:
    """Does any of the paths equal ``path`` or lie below it."""
    path = "/" + path.strip("/")
    return F.coalesce(
        F.exists(paths, lambda p: (p == path) | p.startswith(path + "/")), F.lit(False)
    )


def facet_counts(docs: DataFrame, key: str, paths: str, roots: list[str] | None = None) -> DataFrame:
    """(parent, path, count) of documents per path.

    A document counts once per path however many of its facets lie below it, which
    ``array_distinct`` settles inside the row; counting then combines before the shuffle.
    With ``roots``, only the level right below each root is kept.
    """
    every = F.array_distinct(F.flatten(F.transform(F.col(paths), ancestors)))
    rows = docs.select(F.explode(every).alias("path")).withColumn("parent", parent(F.col("path")))
    if roots is not None:
        rows = rows.where(F.col("parent").isin(*roots))
    return rows.groupBy("parent", "path").agg(F.count(F.lit(1)).alias("count"))


def children(counts: DataFrame, path: str) -> DataFrame:
    return counts.where(F.col("parent") == path)


def top_children(counts: DataFrame, k: int) -> DataFrame:
    """Best k children of every parent by count, ties by path."""
    order = Window.partitionBy("parent").orderBy(F.desc("count"), "path")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def count_paths(counts: DataFrame, paths: DataFrame) -> DataFrame:
    """Count of each path of a path table, 0 for a path no document has."""
    return paths.join(counts.select("path", "count"), "path", "left").select(
        "path", F.coalesce("count", F.lit(0)).alias("count")
    )
