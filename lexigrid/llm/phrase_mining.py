"""Phrase collocations by SON partitioning.

Texts are dealt to a few shards.  Each shard is mined completely, level by level, at a support
lowered to its share of the words: what is frequent in the corpus is frequent in some shard.
The union of the locally frequent phrases is then counted exactly over the whole corpus.

A shard is as large as the corpus over ``SHARDS``, so it is mined by many tasks: each counts
runs of its texts, and sorted counts of a range of keys meet in one task.  The support is an absolute number, so more
than nine shards would lower it to one, where every phrase is frequent.  Frequent phrases of a
level go on to the next one as a bitmap of fixed size.  Shared bits, like the short keys of a
shard's phrases, only let more through.  The last count is by 64-bit keys: two phrases share
one with a chance of 2**-64 a pair.  A phrase is spelled by one of the tasks that hold it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexigrid.llm.registry import query, table
from lexigrid.llm.textbatch import BYTE_CODES, LOWER, ODD, mix, powers, slices, text_bytes
from lexigrid.session import stored

SHARDS = 3
BITS = 28  # of a bitmap: 32 MB, whatever the input
CHUNK = 1 << 16  # bytes of a bitmap that travel as one row
SLICE = (1 << 20) - 1  # bytes of text worked on at once
RUN = 1 << 21  # keys that a task counts before it hands them on
BUCKET = 1 << 24  # bytes of text for each range of keys
LANG_BITS, SHARD_BITS = 6, 2
LOCAL, FULL = 6, 8  # bytes of a key within its shard, and in the last count

BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
GAP = BREAK.copy()
GAP[[ord(" "), ord("\t")]] = True


def cuts(data: np.ndarray, offsets: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int, int, int]]:
    """(first row, end row, first byte, end byte) of slices; a longer text is cut at breaks."""
    for a, b in slices(offsets, most):
        low, high = int(offsets[a]), int(offsets[b])
        while high - low > most:
            found = np.flatnonzero(BREAK[data[low : low + most]])
            if len(found):
                at = low + int(found[-1]) + 1
            else:
                later = np.flatnonzero(BREAK[data[low + most : high]])
                if not len(later):
                    break
                at = low + most + int(later[0]) + 1
            yield a, b, low, at
            low = at
        yield a, b, low, high


class PieceWords:
    """Words of a slice of texts: hashes, byte spans, the row of each, and ``joined``: whether
    the next word is of the same piece."""

    __slots__ = ("data", "hashes", "starts", "ends", "row", "joined")

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = data = LOWER[data]
        n = len(data)
        solid, edge = ~GAP[data], np.zeros(n + 1, bool)
        edge[offsets] = True
        after, before = np.empty(n, bool), np.empty(n, bool)
        if n:
            after[0], after[1:] = True, ~solid[:-1]
            before[-1], before[:-1] = True, ~solid[1:]
        self.starts = np.flatnonzero(solid & (after | edge[:n]))
        self.ends = np.flatnonzero(solid & (before | edge[1:])) + 1
        up, down = powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_CODES[data] * up[:n], out=sums[1:])
        size = (self.ends - self.starts).astype(np.uint64)
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * down[self.starts] + size)
        self.row = np.searchsorted(offsets, self.starts, side="right") - 1
        piece = np.cumsum(BREAK[data] | edge[:n], dtype=np.int64)[self.starts]
        self.joined = np.zeros(len(self.starts), bool)
        self.joined[:-1] = piece[1:] == piece[:-1]

    def phrases(self, first: np.ndarray, size: int) -> pa.Array:
        """The phrases of ``size`` words that begin at the words ``first``, one space between words."""
        spans = first[:, None] + np.arange(size)
        length = self.ends[spans] - self.starts[spans]
        length[:, :-1] += 1  # the byte behind a word is a gap; it is overwritten by a space
        ends = np.cumsum(length.ravel())
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.starts[spans].ravel() - (ends - length.ravel()), length.ravel())
        out = self.data[at]
        if size > 1:
            out[(ends.reshape(-1, size)[:, :-1] - 1).ravel()] = 32
        offsets = np.append(0, ends.reshape(-1, size)[:, -1]).astype(np.int64)
        column = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(first), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes())]
        )
        return column.cast(pa.large_string()).cast(pa.string())


def longer(phrases: np.ndarray, at: np.ndarray, words: PieceWords, size: int) -> np.ndarray:
    """Hashes of the phrases of ``size`` words that begin at ``at``, from those of one word less."""
    return mix(phrases * ODD + words.hashes[at + size - 1] + np.uint64(size))


def phrase_keys(phrases: np.ndarray, langs: np.ndarray) -> np.ndarray:
    """64-bit keys of (language, phrase)."""
    return mix(phrases + langs * ODD)


def local_keys(keys: np.ndarray, langs: np.ndarray, shards: np.ndarray) -> np.ndarray:
    """Keys of 8 ``LOCAL`` bits that hold their language's bucket and their shard in the lowest."""
    keys = keys >> np.uint64(64 - 8 * LOCAL + LANG_BITS + SHARD_BITS) << np.uint64(LANG_BITS + SHARD_BITS)
    return keys | (langs & np.uint64((1 << LANG_BITS) - 1)) << np.uint64(SHARD_BITS) | shards


def shardless(keys: np.ndarray, langs: np.ndarray) -> np.ndarray:
    return local_keys(keys, langs, np.zeros(1, np.uint64)) >> np.uint64(SHARD_BITS)


def to_planes(keys: np.ndarray, width: int) -> bytes:
    """Sorted keys as planes of bytes, the highest first, which compress well."""
    return keys.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :].T.tobytes()


def from_planes(raw, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, 8 - width :] = np.frombuffer(raw, np.uint8).reshape(width, -1).T
    return out.view(">u8").ravel().astype(np.uint64)


def places(keys: np.ndarray) -> np.ndarray:
    return mix(keys) >> np.uint64(64 - BITS)


class SharedBitmap:
    """A bitmap that travels to the workers compressed, and is unpacked once a worker."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def unpack(raw: bytes) -> "SharedBitmap":
        return SharedBitmap(np.frombuffer(zlib.decompress(raw), np.uint8))

    def __reduce__(self):
        return SharedBitmap.unpack, (zlib.compress(self.bits.tobytes(), 1),)


def held(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = places(keys)
    return bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1) == 1


def set_bits(bitmap: np.ndarray, keys: np.ndarray) -> None:
    at = np.unique(places(keys))
    if len(at):
        byte = (at >> np.uint64(3)).astype(np.int64)
        first = np.flatnonzero(np.append(True, byte[1:] != byte[:-1]))
        bits = np.left_shift(np.uint8(1), (at & np.uint64(7)).astype(np.uint8))
        bitmap[byte[first]] |= np.bitwise_or.reduceat(bits, first)


def prepared(docs: DataFrame, text: str, lang: str) -> DataFrame:
    language = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(
        language.alias("lang"), F.xxhash64(language).alias("lang_hash"),
        F.pmod(F.xxhash64(content), F.lit(SHARDS)).alias("shard"), content.alias("text"),
    )


def text_slices(batch: pa.RecordBatch) -> Iterator[tuple[PieceWords, np.ndarray, np.ndarray, int]]:
    """(words, language and shard of each word, first row) of a batch of ``prepared`` rows."""
    lang_hash = batch.column(1).to_numpy().view(np.uint64)
    shard = batch.column(2).to_numpy().astype(np.uint64)
    data, offsets = text_bytes(batch.column(3))
    for a, b, low, high in cuts(data, offsets):
        words = PieceWords(data[low:high], np.clip(offsets[a : b + 1], low, high) - low)
        yield words, lang_hash[a + words.row], shard[a + words.row], a


COUNTED = "bucket int, task int, keys binary, counts binary"
COUNTED_ARROW = pa.schema(
    [("bucket", pa.int32()), ("task", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]
)


class Tally:
    """Counts keys of several slices; a row holds the sorted keys of a bucket and their counts."""

    def __init__(self, buckets: int, width: int = LOCAL):
        self.buckets, self.width, self.parts, self.size = buckets, width, [], 0

    def add(self, keys: np.ndarray, least: int = RUN) -> Iterator[pa.RecordBatch]:
        self.parts.append(keys)
        self.size += len(keys)
        if self.size >= least:
            key, n = np.unique(np.concatenate(self.parts), return_counts=True)
            self.parts, self.size = [], 0
            # keys of equal high bits share a bucket, and buckets ascend with the keys
            high = key >> np.uint64(8 * self.width - 32)
            bucket = high * np.uint64(self.buckets) >> np.uint64(32)
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(key) else []
            task = TaskContext.get().partitionId()
            rows = [
                (int(bucket[a]), task, to_planes(key[a:b], self.width), to_planes(n[a:b].astype(np.uint64), 4))
                for a, b in zip(first, [*first[1:], len(key)])
            ]
            for k in range(0, len(rows), 1000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), f.type) for c, f in zip(zip(*rows[k : k + 1000]), COUNTED_ARROW)],
                    schema=COUNTED_ARROW,
                )


def tallied(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, counts, a task that holds each) of each bucket of rows that are sorted by it."""

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        key = np.concatenate([from_planes(k, width) for k, _, _ in rows])
        n = np.concatenate([from_planes(c, 4) for _, c, _ in rows]).astype(np.int64)
        task = np.repeat(np.array([t for _, _, t in rows]), [len(k) // width for k, _, _ in rows])
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        return key[first], np.add.reduceat(n[order], first), np.minimum.reduceat(task[order], first)

    now, rows = None, []
    for batch in batches:
        for bucket, task, key, n in zip(*(c.to_pylist() for c in batch.columns)):
            if bucket != now and rows:
                yield merged()
                rows = []
            now = bucket
            rows.append((key, n, task))
    if rows:
        yield merged()


def by_bucket(counts: DataFrame) -> DataFrame:
    return counts.repartition("bucket").sortWithinPartitions("bucket")


def word_totals(rows: DataFrame) -> DataFrame:
    """(lang, shard, n): words of each language and shard, and the bytes of its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, size = np.zeros(len(batch), np.int64), 0
            for words, _, _, a in text_slices(batch):
                size += len(words.data)
                np.add.at(n, words.row + a, 1)
            sums: dict[tuple[str, int], int] = {}
            for lang, shard, k in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), n.tolist()):
                sums[lang, shard] = sums.get((lang, shard), 0) + k
            if sums:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.int32()),
                     pa.array(sums.values(), pa.int64()), pa.array([size] + [0] * (len(sums) - 1), pa.int64())],
                    names=["lang", "shard", "n", "size"],
                )

    parts = rows.mapInArrow(run, "lang string, shard int, n long, size long")
    return parts.groupBy("lang", "shard").agg(F.sum("n").alias("n"), F.sum("size").alias("size"))


def word_counts(rows: DataFrame, buckets: int) -> DataFrame:
    """Occurrences of words by local key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(buckets)
        for batch in batches:
            for words, langs, shard, _ in text_slices(batch):
                yield from tally.add(local_keys(phrase_keys(words.hashes, langs), langs, shard))
        yield from tally.add(np.zeros(0, np.uint64), 0)

    return rows.mapInArrow(run, COUNTED)


def grown_counts(rows: DataFrame, size: int, below, buckets: int) -> DataFrame:
    """Occurrences, by local key, of phrases of ``size`` words whose parts of one word less are
    frequent in their shard; ``below`` are the broadcast bitmaps of sizes 1 to ``size`` - 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(buckets)
        for batch in batches:
            for words, langs, shard, _ in text_slices(batch):
                phrases, at = words.hashes, np.arange(len(words.hashes))
                for k in range(2, size + 1):
                    good = np.zeros(len(words.hashes) + 1, bool)
                    good[at] = held(
                        below[k - 2].value.bits, local_keys(phrase_keys(phrases, langs[at]), langs[at], shard[at])
                    )
                    on = good[at] & good[at + 1] & words.joined[at + k - 2]
                    phrases, at = longer(phrases[on], at[on], words, k), at[on]
                yield from tally.add(local_keys(phrase_keys(phrases, langs[at]), langs[at], shard[at]))
        yield from tally.add(np.zeros(0, np.uint64), 0)

    return rows.mapInArrow(run, COUNTED)


def supports(totals: DataFrame, support: int) -> np.ndarray:
    """The lowered support by (language bucket, shard); languages of a bucket share the lowest."""
    whole = totals.groupBy("lang").agg(F.sum("n").alias("all")).where("all > 0")
    share = F.ceil(F.lit(support) * F.col("n").cast("decimal(20,0)") / F.col("all"))
    bucket = F.xxhash64("lang").bitwiseAND(F.lit((1 << LANG_BITS) - 1))
    rows = (
        totals.join(whole, "lang")
        .groupBy((bucket * (1 << SHARD_BITS) + F.col("shard")).alias("group"))
        .agg(F.min(F.greatest(share.cast("long"), F.lit(1))).alias("least")).collect()
    )
    out = np.full(1 << (LANG_BITS + SHARD_BITS), support, np.int64)
    for r in rows:  # at most 16,384
        out[r.group] = r.least
    return out


def bitmaps(rows: DataFrame, mark, number: int) -> list[np.ndarray]:
    """Bitmaps of fixed size that ``mark`` sets for the batches of each partition, put together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = np.zeros((number, 1 << (BITS - 3)), np.uint8)
        mark(batches, maps)
        for which, bitmap in enumerate(maps):
            for k, part in enumerate(bitmap.reshape(-1, min(CHUNK, len(bitmap)))):
                if part.any():
                    yield chunk_row(which, k, part)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for which, k, bits in zip(*(c.to_pylist() for c in batch.columns)):
                part = np.frombuffer(zlib.decompress(bits), np.uint8)
                merged[which, k] = merged[which, k] | part if (which, k) in merged else part
        for (which, k), part in merged.items():
            yield chunk_row(which, k, part)

    def chunk_row(which: int, k: int, part: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([which], pa.int32()), pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)])],
            names=["which", "chunk", "bits"],
        )

    schema = "which int, chunk int, bits binary"
    out = np.zeros((number, 1 << (BITS - 3)), np.uint8)
    for r in rows.mapInArrow(run, schema).repartition("which", "chunk").mapInArrow(merge, schema).collect():
        part = np.frombuffer(zlib.decompress(r.bits), np.uint8)
        out[r.which, r.chunk * len(part) : (r.chunk + 1) * len(part)] = part
    return list(out)


def frequent_bitmaps(counts: DataFrame, least: np.ndarray) -> list[np.ndarray]:
    """Bitmaps of the keys that reach their group's support: with and without the shard."""

    def mark(batches: Iterator[pa.RecordBatch], maps: np.ndarray) -> None:
        for key, n, _ in tallied(batches, LOCAL):
            group = (key & np.uint64((1 << (LANG_BITS + SHARD_BITS)) - 1)).astype(np.int64)
            key = key[n >= least[group]]
            set_bits(maps[0], key)
            set_bits(maps[1], key >> np.uint64(SHARD_BITS))

    return bitmaps(by_bucket(counts), mark, 2)


def held_phrases(bitmap: np.ndarray, words: PieceWords, langs: np.ndarray, most: int):
    """(size, first words, keys) of the phrases in the candidates' bitmap."""
    phrases, at = words.hashes, np.arange(len(words.hashes))
    for size in range(1, most + 1):
        if size > 1:
            on = words.joined[at + size - 2]
            phrases, at = longer(phrases[on], at[on], words, size), at[on]
        keys = phrase_keys(phrases, langs[at])
        good = held(bitmap, shardless(keys, langs[at]))
        phrases, at, keys = phrases[good], at[good], keys[good]
        yield size, at, keys


def exact_counts(rows: DataFrame, candidates, most: int, support: int, buckets: int) -> DataFrame:
    """(key, f, task) of the candidates with f >= ``support``; a task that holds the phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(buckets, FULL)
        for batch in batches:
            for words, langs, _, _ in text_slices(batch):
                for _, _, keys in held_phrases(candidates.value.bits, words, langs, most):
                    yield from tally.add(keys)
        yield from tally.add(np.zeros(0, np.uint64), 0)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, n, task in tallied(batches, FULL):
            on = n >= support
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[on].view(np.int64)), pa.array(n[on]), pa.array(task[on].astype(np.int32))],
                names=["key", "f", "task"],
            )

    return by_bucket(rows.mapInArrow(run, COUNTED)).mapInArrow(add, "key long, f long, task int")


def spelled(rows: DataFrame, counts: DataFrame, candidates, most: int, by_task: bool) -> DataFrame:
    """(key, lang, size, phrase) of the keys of ``counts``, from their tasks alone if ``by_task``.

    A bitmap tells the tasks what to spell, so a few other phrases and repeats are among them.
    """

    def mark(batches: Iterator[pa.RecordBatch], maps: np.ndarray) -> None:
        for batch in batches:
            task = batch.column(1).to_numpy().astype(np.uint64) if by_task else np.uint64(0)
            set_bits(maps[0], batch.column(0).to_numpy().view(np.uint64) + task * ODD)

    asked = rows.sparkSession.sparkContext.broadcast(SharedBitmap(bitmaps(counts.select("key", "task"), mark, 1)[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = np.uint64(TaskContext.get().partitionId() if by_task else 0) * ODD
        for batch in batches:
            for words, langs, _, a in text_slices(batch):
                for size, at, keys in held_phrases(candidates.value.bits, words, langs, most):
                    on = held(asked.value.bits, keys + task)
                    key, first = np.unique(keys[on], return_index=True)
                    first = at[on][first]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), batch.column(0).take(pa.array(words.row[first] + a)),
                         pa.array(np.full(len(key), size, np.int32)), words.phrases(first, size)],
                        names=["key", "lang", "size", "phrase"],
                    )

    return rows.mapInArrow(run, "key long, lang string, size int, phrase string").distinct()


def frequent_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", most: int = 3, support: int = 10
) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, f) of all phrases of up to ``most`` words with f >= ``support``,
    and (lang, n) of all languages with words; stored.  A phrase lies within a piece."""
    context, rows = docs.sparkSession.sparkContext, prepared(docs, text, lang)
    totals = stored(word_totals(rows), "word-totals")
    least = supports(totals, support)
    buckets = 1 + (totals.agg(F.sum("size")).first()[0] or 0) // BUCKET
    shared: list = []
    anywhere = np.zeros(1 << (BITS - 3), np.uint8)
    for size in range(1, most + 1):
        counts = word_counts(rows, buckets) if size == 1 else grown_counts(rows, size, shared, buckets)
        here, also = frequent_bitmaps(counts, least)
        anywhere |= also
        shared.append(context.broadcast(SharedBitmap(here)))
    candidates = context.broadcast(SharedBitmap(anywhere))
    counts = stored(exact_counts(rows, candidates, most, support, buckets), "key-counts")
    found = stored(counts.drop("task").join(spelled(rows, counts, candidates, most, True), "key"), "phrase-counts")
    # a table whose rows come in other tasks the second time leaves phrases unspelled
    missing = counts.join(found, "key", "left_anti")
    if not missing.isEmpty():
        again = spelled(rows, missing, candidates, most, False)
        found = found.unionByName(stored(missing.drop("task").join(again, "key"), "phrase-counts"))
    return found.drop("key"), totals.groupBy("lang").agg(F.sum("n").alias("n"))


def part_of(words, first, count):
    return F.array_join(F.slice(words, first, count), " ")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", most: int = 3, support: int = 10,
    top: int = 2000, covered: int = 50,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language.

    A-Z count as a-z; a null or empty text has no words, a null language is ``und`` and one
    with it.  A phrase of two to ``most`` words is cut where its score is lowest, the first
    such place; the score is floor(1000000 a a / (l r)) by 38-digit integers, exact for counts
    up to 10**16.  A phrase goes if a longer frequent one that holds it has ``covered`` percent
    or more of its occurrences.  Ties go to the greater a, then to the smaller phrase by bytes.
    Repeated rows count each; texts are read whole, very long ones piece by piece; other columns
    are ignored; an empty table gives no rows.
    """
    counts, totals = frequent_phrases(docs, text, lang, most, support)
    words = F.split("phrase", " ")
    several = counts.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("words"))
    cut = several.select("lang", "phrase", "a", "words", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    sides = cut.select(
        "lang", "phrase", "a", "k",
        F.explode(F.array(
            F.struct(F.lit(True).alias("left"), part_of("words", F.lit(1), F.col("k")).alias("part")),
            F.struct(F.lit(False).alias("left"), part_of("words", F.col("k") + 1, F.col("size") - F.col("k")).alias("part")),
        )).alias("side"),
    ).select("lang", "phrase", "a", "k", "side.left", "side.part")
    of_part = counts.select("lang", F.col("phrase").alias("part"), "f")
    both = (
        sides.join(of_part, ["lang", "part"])
        .groupBy("lang", "phrase", "a", "k")
        .agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
        .withColumn("score", F.expr("(1000000BD * cast(a as decimal(16,0)) * a) div (cast(l as decimal(19,0)) * r)"))
    )
    scored = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    if most > 2:
        inner = several.where("size > 2").select(
            "lang", "a",
            F.explode(F.flatten(F.transform(
                F.sequence(F.lit(2), F.col("size") - 1),
                lambda m: F.transform(
                    F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: part_of("words", i, m)
                ),
            ))).alias("phrase"),
        )
        around = inner.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
        scored = scored.join(around, ["lang", "phrase"], "left").where(
            F.coalesce(100 * F.col("around") < covered * F.col("a"), F.lit(True))
        )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n",
        F.col("cut.score").cast("long").alias("score"),
    )


LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
SQL = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), {LETTERS}), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
lists AS (SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\x20\x09]+') IF x <> ''] AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang),
grams AS (
    SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM lists, (VALUES (1), (2), (3)) AS s (m) WHERE len(w) >= m)),
f AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
cut AS (
    SELECT lang, m, phrase, a, k, array_to_string(w[1 : k], ' ') AS x, array_to_string(w[k + 1 :], ' ') AS y
    FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
scored AS (
    SELECT cut.lang, cut.m, cut.phrase, a, k, p.f AS l, q.f AS r,
           (1000000::HUGEINT * a * a) // (p.f::HUGEINT * q.f) AS score
    FROM cut JOIN f AS p ON p.lang = cut.lang AND p.phrase = x JOIN f AS q ON q.lang = cut.lang AND q.phrase = y),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (
    SELECT lang, phrase, max(a) AS a FROM (
        SELECT lang, a, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) AS phrase FROM c WHERE m = 3)
    GROUP BY ALL)
SELECT lowest.lang, row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, lowest.a DESC, lowest.phrase) AS rank,
       lowest.phrase, lowest.a, l, r, n, score::BIGINT AS score
FROM lowest JOIN totals ON totals.lang = lowest.lang
LEFT JOIN around ON around.lang = lowest.lang AND around.phrase = lowest.phrase AND m = 2
WHERE coalesce(100 * around.a < 50 * lowest.a, true)
QUALIFY rank <= 2000
"""


@query("op11_phrase_mining", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
