"""Hard negatives by Kronecker-packed products.

Vectors are whole numbers.  For each component, the values of a run of candidates are biased to
be positive and stand in separated fields of one wide integer.  An anchor multiplies each wide
integer once by its own biased component and adds up: every field then holds one candidate's
product sum, and taking the biases off again gives exact scores.

All candidates meet the anchors in blocks: anchors and candidates are dealt to groups of
bounded size, and a task works on one group of either, anchors first, candidates streaming by.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexigrid.llm.registry import query, table
from lexigrid.session import stored

ANCHORS, CANDIDATES = 2048, 4096  # rows of a group, on average
RUN = 1024  # candidates in one wide integer


class Packed:
    """A run of candidates: one wide integer a component.

    ``vectors`` are rows of whole numbers.  ``reach`` bounds the size of an anchor's component;
    the fields are wide enough for the sum of all biased products, so none spills over.
    """

    def __init__(self, vectors: np.ndarray, reach: int):
        self.rows, self.width = vectors.shape
        self.bias = max((abs(int(x)) for x in (vectors.min(initial=0), vectors.max(initial=0))), default=0)
        self.reach = reach
        most = 2 * self.bias * max(1, 2 * self.width * reach)
        self.bytes = max(4, -(-(most.bit_length() + 1) // 8))
        if 4 < self.bytes <= 8:
            self.bytes = 8
        biased = vectors + self.bias
        self.wide = [self.pack(biased[:, d]) for d in range(self.width)]
        # the sum of each candidate's components
        self.taken = (vectors if self.bytes <= 8 else vectors.astype(object)).sum(axis=1)

    def pack(self, fields: np.ndarray) -> int:
        if self.bytes <= 8:
            return int.from_bytes(fields.astype("<u4" if self.bytes == 4 else "<u8").tobytes(), "little")
        return int.from_bytes(b"".join(int(x).to_bytes(self.bytes, "little") for x in fields), "little")

    def unpack(self, wide: int) -> np.ndarray:
        raw = wide.to_bytes(self.rows * self.bytes, "little")
        if self.bytes <= 8:
            return np.frombuffer(raw, "<u4" if self.bytes == 4 else "<u8").astype(np.int64)
        fields = [int.from_bytes(raw[k : k + self.bytes], "little") for k in range(0, len(raw), self.bytes)]
        return np.array(fields, object)

    def scores(self, anchor: list[int]) -> np.ndarray:
        """The exact inner products of the candidates with ``anchor``, which is as long as they are."""
        total, reach = 0, self.reach
        for a, wide in zip(anchor, self.wide):
            total += (a + reach) * wide
        # sum (a + reach) (c + bias) = score + reach sum c + bias (sum a + width reach)
        return self.unpack(total) - reach * self.taken - self.bias * (sum(anchor) + self.width * reach)


def whole_numbers(vectors: list, width: int) -> np.ndarray:
    """Vectors of whole doubles as integers, filled up with zeros: 64-bit, or of any size."""
    flat = np.zeros((len(vectors), width))
    for k, v in enumerate(vectors):
        flat[k, : len(v)] = v
    if len(vectors) and np.abs(flat).max(initial=0) >= 2.0**24:
        return np.array([[int(x) for x in row] for row in flat], object).reshape(flat.shape)
    return flat.astype(np.int64)


ROWS = "group long, side int, vec_id long, label int, row long, vector array<double>, wanted array<long>"


def usable(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(vec_id, label, vector, row) of the rows that take part; components are floor(256 x)."""
    scaled = F.transform(F.col(vector), lambda x: F.lit(256.0) * x.cast("double"))
    # from 2**53 on every double is whole
    floor = F.transform(scaled, lambda s: F.when(F.abs(s) < 2.0**53, F.floor(s).cast("double")).otherwise(s))
    moved = F.when(F.col(key) % 7 == 0, (F.col(label).cast("long") + 1) % 10).otherwise(F.col(label))
    finite = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite)
    return rows.select(
        F.col(key).cast("long").alias("vec_id"), moved.cast("int").alias("label"), floor.alias("vector"),
        F.monotonically_increasing_id().alias("row"),
    )


def in_blocks(anchors: DataFrame, rows: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on every group of anchors with every group of candidates.

    Both are dealt by their row numbers, so repeated keys spread.  An anchor goes to all
    groups of candidates and a candidate to all groups of anchors; nothing is paired.
    """
    n_anchors, n_rows = anchors.count(), rows.count()
    high, wide = max(1, -(-n_anchors // ANCHORS)), max(1, -(-n_rows // CANDIDATES))

    def dealt(groups: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(groups))

    def all_of(groups: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))

    first = anchors.withColumn("at", dealt(high) * wide).withColumn("to", all_of(wide)).select(
        (F.col("at") + F.col("to")).alias("group"), F.lit(0).alias("side"), "vec_id", "label", "row", "vector", "wanted"
    )
    then = rows.withColumn("at", dealt(wide)).withColumn("to", all_of(high)).select(
        (F.col("at") + F.col("to") * wide).alias("group"), F.lit(1).alias("side"), "vec_id", "label", "row", "vector",
        F.lit(None).cast("array<long>").alias("wanted"),
    )
    return (
        first.unionByName(then).repartition("group").sortWithinPartitions("group", "side", "label", "vec_id")
        .select(*[c.split()[0] for c in ROWS.split(", ")]).mapInArrow(work, schema)
    )


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple], list[tuple]]]:
    """(anchors, run of candidates) of each group; a group's anchors stay while its rows pass."""
    now, anchors, run = None, [], []
    for batch in batches:
        for group, side, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if group != now:
                if anchors and run:
                    yield anchors, run
                now, anchors, run = group, [], []
            if side == 0:
                anchors.append(tuple(row))
                continue
            run.append(tuple(row))
            if len(run) == RUN:
                if anchors:
                    yield anchors, run
                run = []
    if anchors and run:
        yield anchors, run


def scored_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(anchor, its scores, ids, labels, row numbers) for each anchor and run of candidates."""
    last, whole, reach = None, None, 0
    for anchors, run in blocks(batches):
        width = max(len(r[3]) for r in run)
        if anchors is not last:
            last, most = anchors, max(len(a[3]) for a in anchors)
            whole = whole_numbers([a[3] for a in anchors], most)
            reach = max((abs(int(x)) for x in (whole.min(initial=0), whole.max(initial=0))), default=0)
            whole = whole.tolist()
        packed = Packed(whole_numbers([r[3] for r in run], width), reach)
        ids, labels, rows = (np.array([r[k] for r in run], np.int64) for k in (0, 1, 2))
        for anchor, vector in zip(anchors, whole):
            # components that one side lacks are zeros
            short = vector[:width] + [0] * (width - len(vector))
            yield anchor, packed.scores(short), ids, labels, rows


def best_of(scores: np.ndarray, ids: np.ndarray, at: np.ndarray, most: int) -> np.ndarray:
    """Those of ``at`` with the ``most`` highest scores, smaller ids first among equal ones."""
    if len(at) > most:
        s = scores[at]
        at = at[s >= (np.sort(s) if s.dtype == object else np.partition(s, len(s) - most))[len(s) - most]]
    if scores.dtype == object:
        return np.array(sorted(at.tolist(), key=lambda k: (-scores[k], ids[k])), np.int64)[:most]
    return at[np.lexsort((ids[at], -scores[at]))][:most]


class Found:
    """Result rows, handed on in batches."""

    def __init__(self, schema: str):
        self.names, self.rows = [c.split()[0] for c in schema.split(", ")], []

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            columns = [pa.array(list(c), pa.int64()) for c in zip(*self.rows)]
            self.rows = []
            yield pa.RecordBatch.from_arrays(columns, names=self.names)


POSITIVES = "anchor long, positive_id long, positive_score long"
NEGATIVES = "anchor long, positive_score long, negative_id long, negative_score long"


def hard_negatives(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are rows whose key is divisible by ``every``.  Rows without a key, label or vector,
    with a null or non-finite component, or with one that 256 times is not finite, take no part.
    An anchor's positives are its best other rows of its label, by score, then key; a positive's
    negatives are the best rows of other labels with
    ``low`` positive_score <= 100 negative_score <= ``high`` positive_score.
    A vector shorter than another counts as filled up with zeros, an empty one scores 0.  Rows
    are told apart by row, not by key: a repeated row is another row, and a repeated anchor
    gives its rows again.  Among rows of equal score and key any may stand for the others.  A
    score past 64 bits is an error.  Other columns are ignored; an empty table gives no rows.
    """
    rows = stored(usable(vectors, key, vector, label), "vectors")
    anchors = rows.where(F.col("vec_id") % every == 0)

    def find_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Found(POSITIVES)
        for anchor, scores, ids, labels, numbers in scored_runs(batches):
            at = np.flatnonzero((labels == anchor[1]) & (numbers != anchor[2]))
            for k in best_of(scores, ids, at, positives).tolist():
                out.rows.append((anchor[2], int(ids[k]), int(scores[k])))
            yield from out.batches(10_000)
        yield from out.batches(1)

    def find_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Found(NEGATIVES)
        for anchor, scores, ids, labels, _ in scored_runs(batches):
            other = labels != anchor[1]
            for wanted in anchor[4]:
                near = (scores >= -(-low * wanted // 100)) & (scores <= high * wanted // 100)
                for k in best_of(scores, ids, np.flatnonzero(other & near), negatives).tolist():
                    out.rows.append((anchor[2], wanted, int(ids[k]), int(scores[k])))
            yield from out.batches(10_000)
        yield from out.batches(1)

    def best(df: DataFrame, by: list[str], score: str, id_: str, most: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(id_))
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

    none = F.lit(None).cast("array<long>").alias("wanted")
    close = in_blocks(anchors.select("*", none), rows, find_positives, POSITIVES)
    pairs = stored(best(close, ["anchor"], "positive_score", "positive_id", positives).drop("rank"), "positives")
    wanted = pairs.groupBy("anchor").agg(F.collect_set("positive_score").alias("wanted"))
    asking = anchors.join(wanted, F.col("row") == F.col("anchor")).drop("anchor")
    hard = best(
        in_blocks(asking, rows, find_negatives, NEGATIVES), ["anchor", "positive_score"],
        "negative_score", "negative_id", negatives,
    )
    ids = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return pairs.join(hard, ["anchor", "positive_score"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE) FOR x IN embedding] AS c
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, a.label = v.label AS same, v.vec_id, list_dot_product(a.c, v.c)::BIGINT AS score
    FROM v AS a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
    AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


@query("op13_hard_negatives", SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))
