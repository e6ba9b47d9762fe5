"""Exact percentiles whose work is spread however the values fall."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.session import stored

ACCURACY = 10_000
INNER = 256


def with_group_row(rows: DataFrame, per_group: DataFrame, groups: list[str], name: str) -> DataFrame:
    """Each row with the column ``name`` of its group's one row; null keys are a group too."""
    if not groups:
        return rows.withColumn(name, per_group.select(name).scalar())
    there = per_group.select(*[F.col(g).alias(f"{name}_{i}") for i, g in enumerate(groups)], name)
    same = [F.col(g).eqNullSafe(F.col(f"{name}_{i}")) for i, g in enumerate(groups)]
    return rows.join(there, same).select(*rows.columns, name)


def any_of(tests: list[Column]) -> Column:
    return functools.reduce(operator.or_, tests)


def wanted_zones(rows: DataFrame, groups: list[str], percents: list[float], accuracy: int) -> DataFrame:
    """(groups, i, total, before, least, lo, hi, low, high): where the ranks of percentile i lie.

    The two ranks at and round a percentile are in the values from ``lo`` to ``hi``; ``least``
    begins the zone of the lower one and ``before`` counts the rows below that.  ``low`` and
    ``high`` are the values of the ranks as far as they are known already.
    """
    steps = ", ".join(f"{i / INNER}D" for i in range(INNER + 1))
    margin = 2.0 / accuracy
    cuts = [min(max(p / 100 + side, 0.0), 1.0) for side in (-margin, margin) for p in percents]
    each, k = range(len(cuts)), len(percents)
    sketch = rows.groupBy(*groups).agg(F.percentile_approx("v", cuts, accuracy).alias("cuts"))
    edges = sketch.select(*groups, F.struct(*[F.get("cuts", F.lit(i)).alias(f"at{i}") for i in each]).alias("edges"))
    if groups:  # written, so that their size is known and few groups do not shuffle all rows into few tasks
        edges = stored(edges, "edges")
    v, edge = F.col("v"), [F.col(f"edges.at{i}") for i in each]
    zone = functools.reduce(operator.add, [(v > e).cast("int") + (v >= e).cast("int") for e in edge])
    near = any_of([(v > edge[i]) & (v < edge[k + i]) for i in range(k)])
    zones = (
        with_group_row(rows, edges, groups, "edges")
        .select(*groups, "v", zone.alias("zone"), F.when(near, v).alias("near"))
        .groupBy(*groups, "zone")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("v").alias("least"),
            F.max("v").alias("most"),
            F.expr(f"percentile_approx(near, array({steps}), {max(accuracy, 16 * INNER)})").alias("inner"),
        )
    )
    group = Window.partitionBy(*groups)
    placed = zones.withColumn("total", F.sum("n").over(group)).withColumn(
        "before", F.sum("n").over(group.orderBy("zone")) - F.col("n")
    )
    at = [F.lit(p / 100.0) * (F.col("total") - 1) for p in percents]
    ranks = [
        F.struct(F.lit(i).alias("i"), F.lit(side == 1).alias("upper"), f(at[i]).alias("rank"))
        for i in range(k) for side, f in enumerate((F.floor, F.ceil))
    ]
    found = placed.select("*", F.inline(F.array(*ranks))).where(
        (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n"))
    )
    step = F.floor((F.col("rank") - F.col("before")) * INNER / F.col("n")).cast("int")
    inside = F.col("inner").isNotNull()
    parts = found.select(
        *groups, "i", "upper", "total", "before", "least",
        F.when(inside & (step >= 1), F.get("inner", step - 1)).otherwise(F.col("least")).alias("lo"),
        F.when(inside & (step + 2 < INNER), F.get("inner", step + 2)).otherwise(F.col("most")).alias("hi"),
    )
    known = F.when(F.col("lo") == F.col("hi"), F.col("lo"))
    return parts.groupBy(*groups, "i").agg(
        F.max("total").alias("total"), F.min("before").alias("before"),
        F.min("least").alias("least"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.max(F.when(~F.col("upper"), known)).alias("low"), F.max(F.when(F.col("upper"), known)).alias("high"),
    )


def exact_percentiles(
    df: DataFrame, groups: list[str], value: Column, percents: list[float], accuracy: int = ACCURACY
) -> DataFrame:
    """(groups, p) with ``p`` an array of (percent, value), linear between neighbours.

    A bracket round each wanted rank is narrowed by sketches, in three scans at every size:

    1. A sketch of each group gives values just below and above each percentile.  They cut the
       value range into zones.
    2. Rows are counted per zone, so the zone of each wanted rank and the rank inside it are
       exact, whatever the sketch missed.  A zone between the two values of a percentile is
       about 4/accuracy of the rows and gets a sketch of its own; any other zone holds a
       wanted rank only in a group of fewer than ``accuracy`` rows.
    3. The wanted rank lies within two of the inner sketch's ``INNER`` steps, which are wider
       than its error.  Values there, a few millionths of the rows, are counted one by one,
       those of the zone below them together.

    All three fold before the shuffle, so repeated values cost no more.  A zone or part of one
    value is done without the third scan.  Null values are left out; NaN is the largest value.
    """
    rows = df.select(*groups, value.cast("double").alias("v")).where(F.col("v").isNotNull())
    ranks = stored(wanted_zones(rows, groups, percents, accuracy), "ranks")
    done = F.col("low").isNotNull() & F.col("high").isNotNull()
    each, v = range(len(percents)), F.col("v")
    bounds = [F.max(F.when(F.col("i") == i, F.col(c))).alias(f"{c}{i}") for i in each for c in ("least", "lo", "hi")]
    names = [f"{c}{i}" for i in each for c in ("least", "lo", "hi")]
    parts = ranks.where(~done).groupBy(*groups).agg(*bounds).select(*groups, F.struct(*names).alias("parts"))
    hits = [
        F.when(
            (v >= F.col(f"parts.least{i}")) & (v <= F.col(f"parts.hi{i}")),
            F.struct(F.lit(i).alias("i"), F.when(v >= F.col(f"parts.lo{i}"), v).alias("v")),
        )
        for i in each
    ]
    counts = (
        with_group_row(rows, parts, groups, "parts")
        .select(*groups, F.explode(F.array(*hits)).alias("hit"))
        .where(F.col("hit").isNotNull())
        .groupBy(*groups, "hit.i", "hit.v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = F.sum("n").over(Window.partitionBy(*groups, "i").orderBy(F.col("v").asc_nulls_first()))
    places = ranks.where(~done).select(*groups, "i", F.struct("before", "total").alias("place"))
    counted = with_group_row(counts.withColumn("upto", upto), places, [*groups, "i"], "place")
    total, last = F.col("place.total"), F.col("place.before") + F.col("upto")
    wanted = functools.reduce(
        lambda so_far, i: so_far.when(F.col("i") == i, F.lit(percents[i] / 100.0) * (total - 1)),
        each[1:],
        F.when(F.col("i") == 0, F.lit(percents[0] / 100.0) * (total - 1)),
    )
    value_at = lambda rank: F.max(F.when((rank < last) & (rank >= last - F.col("n")), v))
    found = counted.groupBy(*groups, "i").agg(
        F.max(total).alias("total"), value_at(F.floor(wanted)).alias("low"), value_at(F.ceil(wanted)).alias("high")
    )
    every = found.unionByName(ranks.where(done).select(*groups, "i", "total", "low", "high"))

    values = []
    for i, percent in enumerate(percents):
        at = F.lit(percent / 100.0) * (F.col("total") - 1)
        low, high = (F.max(F.when(F.col("i") == i, F.col(c))) for c in ("low", "high"))
        at = F.max(at)
        exact = low + (high - low) * (at - F.floor(at))
        values.append(F.struct(F.lit(float(percent)).alias("percent"), exact.alias("value")))
    per_group = every.groupBy(*groups).agg(F.array(*values).alias("p"), F.count(F.lit(1)).alias("found"))
    return per_group.where(F.col("found") > 0).select(*groups, "p")


def rank_errors(df: DataFrame, value: Column, percents: list[float], accuracy: int = ACCURACY) -> DataFrame:
    """(percent, value, total, error): sketched percentiles and how far their ranks are off.

    ``error`` is the share of the rows between the wanted rank and the nearest rank of the
    value, 0 where the value holds the rank.  No rows, no percentiles.
    """
    rows = df.select(value.cast("double").alias("v")).where(F.col("v").isNotNull())
    # partial sketches add their errors when they are merged, so each is finer than the promise
    sketch = rows.agg(F.percentile_approx("v", [p / 100 for p in percents], 4 * accuracy).alias("edges"))
    v, edge, each = F.col("v"), F.col("edges"), range(len(percents))
    counts = with_group_row(rows, sketch, [], "edges").agg(
        F.first("edges").alias("edges"),
        F.count(F.lit(1)).alias("total"),
        F.array(*[F.count_if(v < edge[i]) for i in each]).alias("below"),
        F.array(*[F.count_if(v <= edge[i]) for i in each]).alias("upto"),
    )
    found = []
    for i, percent in enumerate(percents):
        rank = F.greatest(F.ceil(F.lit(percent / 100.0) * F.col("total")), F.lit(1))
        off = F.greatest(F.col("below")[i] + 1 - rank, rank - F.col("upto")[i], F.lit(0))
        found.append(F.struct(F.lit(float(percent)).alias("percent"), edge[i].alias("value"), "total", (off / F.col("total")).alias("error")))
    return counts.where(F.col("total") > 0).select(F.inline(F.array(*found)))
