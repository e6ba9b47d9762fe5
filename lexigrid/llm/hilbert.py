"""Sharding along a Hilbert curve: neighbours in several metadata dimensions share files.

Only DataFrame functions run here.  Rows are quantised in each dimension, ordered by their
index on the Hilbert curve, and the order is cut into runs of equal row counts.  A run is a
shard, so its files cover a small box of the metadata space and footers prune well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexigrid.llm.registry import query, table
from lexigrid.session import stored

BITS = 5


def category(column: str, bits: int = BITS) -> Column:
    """A cell of a text dimension: 1 and up by hash, 0 for null."""
    cells = (1 << bits) - 1
    return F.when(F.col(column).isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(F.col(column)), F.lit(cells)).cast("int") + 1
    )


def magnitude(value: Column, bits: int = BITS) -> Column:
    """A cell of a non-negative number, by its logarithm: each doubling is a step."""
    step = F.floor(F.log2(F.greatest(value, F.lit(0)).cast("double") + 1))
    return F.least(F.coalesce(step, F.lit(0)), F.lit((1 << bits) - 1)).cast("int")


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Index of a cell on the Hilbert curve (Skilling's transposed form, bits interleaved)."""
    d = len(cells)
    steps = F.array(
        *[
            F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i"))
            for b in range(bits - 1, 0, -1)
            for i in range(d)
        ]
    )

    def undo(x: Column, step: Column) -> Column:
        q, i = step["q"], step["i"]
        here = F.get(x, i)
        is_set = here.bitwiseAND(q) != 0
        swap = x[0].bitwiseXOR(here).bitwiseAND(q - 1)
        return F.transform(
            x,
            lambda v, j: F.when(j == 0, F.when(is_set, v.bitwiseXOR(q - 1)).otherwise(v.bitwiseXOR(swap)))
            .when((j == i) & ~is_set, v.bitwiseXOR(swap))
            .otherwise(v),
        )

    def gray(x: Column) -> Column:
        prefix, parts = x[0], [x[0]]
        for i in range(1, d):
            prefix = prefix.bitwiseXOR(x[i])
            parts.append(prefix)
        flip = F.lit(0)
        for b in range(bits - 1, 0, -1):
            flip = flip.bitwiseXOR(F.when(prefix.bitwiseAND(F.lit(1 << b)) != 0, (1 << b) - 1).otherwise(0))
        return F.transform(F.array(*parts), lambda v: v.bitwiseXOR(flip))

    places = F.array(
        *[F.struct(F.lit(b).alias("b"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(d)]
    )
    cell = F.array(*[c.cast("int") for c in cells])
    turned = F.aggregate(steps, cell, undo, gray) if bits > 1 else gray(cell)
    # one step of a fold hands the array on as a variable, so it is worked out once
    return F.aggregate(
        F.array(F.struct(turned.alias("x"))),
        F.lit(0).cast("long"),
        lambda _, one: F.aggregate(
            places,
            F.lit(0).cast("long"),
            lambda h, p: h * 2 + F.call_function(
                "shiftright", F.get(one["x"], p["i"]), p["b"]
            ).bitwiseAND(F.lit(1)).cast("long"),
        ),
    )


def ordered(rows: DataFrame, by: list[str], purpose: str = "ordered") -> DataFrame:
    """The rows with ``rank``, their place from 0 in the order of ``by``, and ``total``.

    Range partitions hold consecutive pieces of the order, and are written so that a second
    reading sees the same pieces.  Only a count per piece passes through one task.
    """
    place = F.monotonically_increasing_id()
    pieces = stored(
        rows.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("piece_", F.shiftright(place, 33))
        .withColumn("place_", place.bitwiseAND(F.lit((1 << 33) - 1))),
        purpose,
    )
    before = Window.orderBy("piece_").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        pieces.groupBy("piece_")
        .agg(F.count("*").alias("n_"))
        .select(
            "piece_",
            F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("start_"),
            F.sum("n_").over(Window.partitionBy()).alias("total"),
        )
    )
    return (
        pieces.join(starts, "piece_")
        .withColumn("rank", F.col("start_") + F.col("place_"))
        .drop("piece_", "place_", "start_")
    )


def hilbert_shards(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    categories: tuple[str, ...] = ("source", "lang"),
    n_shards: int = 24,
) -> DataFrame:
    """(key, size, text_crc32, hilbert, shard, slot) of every row; law: counts at most one apart.

    Size is the bytes of the text plus 8.  A null text counts no bytes and has the checksum of
    an empty text; null categories are cell 0; rows equal in curve index, key and checksum are
    interchangeable.  An empty table gives no rows; other columns are ignored.
    """
    content = F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))
    size = F.octet_length(content).cast("long") + 8
    rows = docs.select(
        F.col(key),
        size.alias("size"),
        F.crc32(content).cast("long").alias("text_crc32"),
        hilbert_index([*(category(c) for c in categories), magnitude(size)]).alias("hilbert"),
    )
    shard = F.expr(f"rank * {n_shards} div total").cast("int")
    first = F.expr(f"(shard * total + {n_shards - 1}) div {n_shards}")
    return (
        ordered(rows, ["hilbert", key, "text_crc32"], "hilbert")
        .withColumn("shard", shard)
        .withColumn("slot", (F.col("rank") - first).cast("long"))
        .drop("rank", "total")
    )


def write_shards(docs: DataFrame, shards: DataFrame, path: str, key: str = "doc_id") -> None:
    """Write the documents as one folder per shard, in curve order.  Keys must be unique."""
    placed = docs.join(shards.select(key, "hilbert", "shard", "slot"), key)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)


@query("op3_hilbert_sharding")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "hilbert",
    )
