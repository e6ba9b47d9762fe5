"""Packing by lexical retrieval: a window is a seed text and its nearest unused neighbours.

Texts are cut at the window size; whole windows are sequences already.  The remainders are
ordered by content and cut into shards of a bounded number of texts.  Each shard holds a BM25 inverted index over
subword ids, with document frequencies of all remainders; the neighbours that it returns for
a seed fill the seed's window, and the last one is cut where the window ends.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.llm.registry import query, table
from lexigrid.llm.subwords import subword_ids
from lexigrid.llm.textbatch import batch_words
from lexigrid.session import stored

WINDOW = 2048
VOCABULARY = 49408
END = 1
K1, B = 1.2, 0.75
SKETCH, CODE_BITS = 32, 16


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


TOKENIZED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, unit long, ids binary"
)
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
KINDS = {"long": pa.int64(), "binary": pa.binary()}


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(c.split()[0], KINDS[c.split()[1]]) for c in ddl.split(", ")])


def tokenize(docs: DataFrame, key: str, text: str, tokenizer: str, with_ids: bool) -> DataFrame:
    """Whole windows with their sequence_id, and remainders with a ``unit`` number and ids."""
    schema = arrow_schema(TOKENIZED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = subword_ids(tokenizer)
        base, whole, unit = TaskContext.get().partitionId() << 36, 0, 0
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for a, b, words in batch_words(batch.column(1)):
                rows = []
                for k, ids in zip(range(a, b), known.encode_words(words)):
                    ids = np.append(ids, np.uint16(END))
                    n = len(ids)
                    for at in range(0, n, WINDOW):
                        piece = ids[at : at + WINDOW]
                        if len(piece) == WINDOW:
                            kept = piece.astype("<u2").tobytes() if with_ids else None
                            rows.append((keys[k], at, WINDOW, crc(piece), n, (1 << 62) + base + whole, None, kept))
                            whole += 1
                        else:
                            packed = piece.astype("<u2").tobytes()
                            rows.append((keys[k], at, len(piece), None, n, None, base + unit, packed))
                            unit += 1
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                    )

    return docs.selectExpr(f"cast(`{key}` as long) as doc_id", f"`{text}` as text").mapInArrow(run, TOKENIZED)


def term_counts(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct ids of each text, ascending, how often each stands there, and where each text begins.

    One sort serves up to 65,536 texts.
    """
    terms, times, first = [], [], [np.zeros(1, np.int64)]
    for a in range(0, len(texts), 1 << 16):
        some = texts[a : a + (1 << 16)]
        keys = np.repeat(np.arange(len(some), dtype=np.uint32) << np.uint32(16), [len(t) for t in some])
        keys |= np.concatenate(some)
        keys.sort()
        begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        times.append(np.diff(np.append(begins, len(keys))))
        terms.append((keys[begins] & np.uint32(0xFFFF)).astype(np.int64))
        held = np.bincount(keys[begins] >> np.uint32(16), minlength=len(some))
        first.append(first[-1][-1] + np.cumsum(held))
    return np.concatenate([*terms, np.zeros(0, np.int64)]), np.concatenate([*times, np.zeros(0, np.int64)]), np.concatenate(first)


def document_frequencies(units: DataFrame) -> np.ndarray:
    """How many remainders hold each id: one vector of the vocabulary's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(VOCABULARY, np.int64)
        for batch in batches:
            terms, _, _ = term_counts([np.frombuffer(i.as_buffer(), "<u2") for i in batch.column(0)])
            found += np.bincount(terms, minlength=VOCABULARY)
        held = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"id": held, "df": found[held]})

    counts = units.select("ids").mapInArrow(run, "id long, df long").groupBy("id").agg(F.sum("df").alias("df"))
    out = np.zeros(VOCABULARY, np.int64)
    for row in counts.collect():  # at most VOCABULARY rows
        out[row.id] = row.df
    return out


@cache
def directions_of_ids() -> np.ndarray:
    return np.random.default_rng(SKETCH).standard_normal((VOCABULARY, SKETCH), np.float32)


def sketches(texts: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """Each text's BM25-weighted ids, projected on ``SKETCH`` fixed random directions, length 1."""
    directions = directions_of_ids()
    out = np.zeros((len(texts), SKETCH))
    terms, tf, first = term_counts(texts)
    weights = (idf[terms] * tf / (tf + K1)).astype(np.float32)
    for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        out[k] = weights[a:b] @ directions[terms[a:b]]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def principal_directions(units: DataFrame, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The mean of all sketches and the ``CODE_BITS`` directions in which they vary most.

    Moments are sums of whole numbers, so they do not depend on the order of the rows.
    """
    size = SKETCH + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments = np.zeros((size, size), np.int64)
        for batch in batches:
            rows = np.rint(sketches([np.frombuffer(i.as_buffer(), "<u2") for i in batch.column(0)], idf) * 1024)
            rows = np.column_stack([np.ones(len(rows)), rows]).astype(np.int64)
            moments += rows.T @ rows
        yield pa.RecordBatch.from_pydict({"cell": np.arange(size * size), "part": moments.ravel()})

    sums = units.select("ids").mapInArrow(run, "cell long, part long").groupBy("cell").agg(F.sum("part").alias("part"))
    moments = np.zeros(size * size)
    for row in sums.collect():  # (SKETCH + 1) ** 2 rows
        moments[row.cell] = row.part
    moments = moments.reshape(size, size) / max(1.0, moments[0])
    mean = moments[0, 1:]
    _, vectors = np.linalg.eigh(moments[1:, 1:] - np.outer(mean, mean))
    return mean / 1024, vectors[:, ::-1][:, :CODE_BITS]


def by_content(units: DataFrame, idf: np.ndarray) -> DataFrame:
    """The remainders with ``code``, which is near for texts of like ids: one bit for each
    principal direction, the strongest first."""
    mean, axes = principal_directions(units, idf)
    kept = ["unit", "doc_id", "start", "length", "doc_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [np.frombuffer(i.as_buffer(), "<u2") for i in batch.column("ids")]
            bits = (sketches(texts, idf) - mean) @ axes > 0
            code = bits @ (1 << np.arange(CODE_BITS)[::-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code, pa.int64())], names=[*kept, "code"])

    schema = "unit long, doc_id long, start long, length long, doc_tokens long, ids binary, code long"
    return units.select(*kept).mapInArrow(run, schema)


class Shard:
    """An inverted index over the texts of a shard, and which of them are still unused."""

    def __init__(self, texts: list[np.ndarray], idf: np.ndarray, mean: float):
        self.texts = texts
        self.used = np.zeros(len(texts), np.int64)
        self.alive = np.ones(len(texts), bool)
        terms, tf, self.first = term_counts(texts)
        held = np.diff(self.first)
        docs, size = np.repeat(np.arange(len(texts)), held), np.repeat([len(t) for t in texts], held)
        weights = idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean))
        self.by_text = terms
        order = np.argsort(terms, kind="stable")
        self.index(terms[order], docs[order], weights[order], len(texts))

    def index(self, terms: np.ndarray, docs: np.ndarray, weights: np.ndarray, held: int) -> None:
        """Postings in the order of their terms; ``held`` texts have some."""
        self.terms, self.docs, self.weights, self.held = terms, docs, weights, held
        self.begins = np.append(0, np.cumsum(np.bincount(terms, minlength=VOCABULARY)))

    def forget_used(self) -> None:
        """Postings of used texts go: they score for nothing."""
        kept = self.alive[self.docs]
        self.index(self.terms[kept], self.docs[kept], self.weights[kept], int(self.alive.sum()))

    def neighbours(self, seed: int) -> np.ndarray:
        """Unused texts, best BM25 score first; the query is all ids of the seed.  Equal scores,
        none included, keep the order of the shard."""
        left = np.flatnonzero(self.alive)
        if 4 * len(left) < 3 * self.held:
            self.forget_used()
        chosen = self.by_text[self.first[seed] : self.first[seed + 1]]
        starts = self.begins[chosen]
        sizes = self.begins[chosen + 1] - starts
        at = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        scores = np.bincount(self.docs[at], self.weights[at], len(self.texts))
        return left[np.argsort(-scores[left], kind="stable")]

    def take(self, text: int, room: int) -> tuple[int, np.ndarray]:
        """Up to ``room`` of the text's unused ids, and where they begin in it."""
        start = int(self.used[text])
        ids = self.texts[text][start : start + room]
        self.used[text] += len(ids)
        self.alive[text] = self.used[text] < len(self.texts[text])
        return start, ids

    def windows(self) -> Iterator[list[tuple[int, int, np.ndarray]]]:
        """Lists of (text, start in it, ids): each list is a sequence, full but for the last."""
        for seed in range(len(self.texts)):
            while self.alive[seed]:
                start, ids = self.take(seed, WINDOW)
                window, room = [(seed, start, ids)], WINDOW - len(ids)
                if room:
                    for other in self.neighbours(seed):
                        start, ids = self.take(int(other), room)
                        window.append((int(other), start, ids))
                        room -= len(ids)
                        if not room:
                            break
                yield window


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    shard_units: int = 1024,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents: where each begins in its document and in its sequence.

    A document is its ids and an end id, so a null or empty text is one id.  Every id is in
    exactly one piece; sequences hold up to 2048 ids, and only the last of a shard is not
    full.  Repeated rows are packed as documents of their own.  Other columns are ignored; an
    empty table gives no pieces.  ``with_ids`` returns the ids too (16-bit, little-endian).
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    pieces = stored(tokenize(docs, key, text, path, with_ids), "tokens")
    units = pieces.where(F.col("unit").isNotNull())
    n_units, n_ids = units.agg(F.count("*"), F.sum("length")).first()
    held = document_frequencies(units)
    idf = np.log1p((n_units - held + 0.5) / (held + 0.5))
    mean = (n_ids or 0) / max(1, n_units)
    n_shards = max(1, -(-n_units // shard_units))
    schema = arrow_schema(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fill(shard: int, rows: list[tuple]) -> pa.RecordBatch:
            index = Shard([np.frombuffer(r[4], "<u2") for r in rows], idf, mean)
            out = []
            for number, window in enumerate(index.windows()):
                offset = 0
                for text, start, ids in window:
                    doc, base, _, tokens, _ = rows[text]
                    kept = ids.tobytes() if with_ids else None
                    out.append((doc, base + start, len(ids), crc(ids), tokens, (shard << 20) + number, offset, kept))
                    offset += len(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema
            )

        shard, rows = TaskContext.get().partitionId() << 20, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                rows.append(row)
                if len(rows) == 2 * shard_units:
                    yield fill(shard, rows)
                    shard, rows = shard + 1, []
        if rows:
            yield fill(shard, rows)

    packed = (
        by_content(units, idf)
        .repartitionByRange(n_shards, "code", "unit")
        .sortWithinPartitions("code", "unit")
        .select("doc_id", "start", "length", "doc_tokens", "ids")
        .mapInArrow(run, PIECES)
    )
    whole = pieces.where(F.col("unit").isNull()).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset"), "ids"
    )
    return whole.unionByName(packed) if with_ids else whole.unionByName(packed).drop("ids")


@query("op8_bm25_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
