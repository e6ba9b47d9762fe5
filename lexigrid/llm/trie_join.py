"""N-gram Jaccard self-join by prefix trees.

A document is its set of five-word shingles, put in one global order: rare shingles first.
Linked sets share a shingle among their first ones, so each such shingle is a branch of the
tree.  Sets that share a branch, and may link as far as sizes and places tell, form a trie,
once for all branches of the same sets: a walk with one set carries the overlap of each shared path on,
and leaves a subtree as soon as the overlap so far and the greatest remaining length below
cannot reach the threshold.  The overlap at the end of a path is exact.

Groups of near copies would link by the square.  So neighbours by length in each branch are
compared first, and sets that links already join are not paired again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.llm.components import components
from lexigrid.llm.decontaminate import marked
from lexigrid.llm.registry import query, set_aside, table
from lexigrid.llm.textbatch import batch_words, windows
from lexigrid.session import stored

WIDTH = 5
SHARE = 75  # percent of the union
SKETCH_BITS = 20
CHUNK = 4096
TOKEN_BITS = 48
TOKEN_MASK = np.int64((1 << TOKEN_BITS) - 1)
BLOCK = 1024  # sets of a part of a branch
LOAD = 1 << 20  # shingles of a part
LONG = LOAD // 16  # a set of more shingles is in no part: its pairs are streamed
PATH = 128  # tokens of a node of a trie, 255 at most
ROWS = 256  # rows of a batch that are Python objects at a time


def need(a, b):
    """The fewest common shingles of linked sets of sizes a and b: 100 o >= 75 (a + b - o)."""
    return -(-SHARE * (a + b) // (100 + SHARE))


def prefix_size(n: int) -> int:
    """So many first shingles of a set hold one of any set that it is linked with."""
    return n - -(-SHARE * n // 100) + 1


def shingle_sets(column) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for _, _, words in batch_words(column):
        for k in range(len(words.first) - 1):
            yield np.unique(windows(words.hashes[words.first[k] : words.first[k + 1]], WIDTH))


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def frequency_sketch(docs: DataFrame, text: str) -> np.ndarray:
    """How many shingles of all documents fall in each of 2**20 buckets.

    The count of its bucket is at least a shingle's frequency; it only sets the global order,
    so that what many documents share comes last.  Any order gives the same links.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for _, _, words in batch_words(batch.column(0)):
                w = windows(words.hashes, WIDTH)  # a few runs cross texts: the order may be rough
                np.add.at(counts, bucket(w), 1)
        held = [k for k in range(len(counts) // CHUNK) if counts[k * CHUNK : (k + 1) * CHUNK].any()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(held, pa.int32()),
                pa.array([counts[k * CHUNK : (k + 1) * CHUNK].astype("<u4").tobytes() for k in held], pa.binary()),
            ],
            names=["chunk", "counts"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(counts.as_buffer(), "<u4").astype(np.int64)
                totals[chunk] = totals[chunk] + part if chunk in totals else part
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()), pa.array([t.astype("<i8").tobytes() for t in totals.values()], pa.binary())],
            names=["chunk", "counts"],
        )

    schema = "chunk int, counts binary"
    rows = docs.select(text).mapInArrow(count, schema).repartition("chunk").mapInArrow(add, schema).collect()
    out = np.zeros(1 << SKETCH_BITS, np.int64)
    for row in rows:  # the sketch: 8 MB whatever the input
        out[row.chunk * CHUNK : (row.chunk + 1) * CHUNK] = np.frombuffer(row.counts, "<i8")
    return out


SETS = "key long, text_hash long, n long, set_id long, slots array<long>"
SETS_ARROW = pa.schema(
    [(c, pa.int64()) for c in "key text_hash n set_id".split()]
    + [("slots", pa.list_(pa.int64()))]
)


def ordered_sets(docs: DataFrame, key: str, text: str, shared) -> DataFrame:
    """Per row: size, set_id (equal for equal sets) and the first shingles in global order.

    A slot is a shingle's 48-bit token.  One whose bucket is far above the mean is split: a
    number from 1 on above the token deals the sets of that branch to several tasks.  Slots
    are null where the task has given those of an equal set already.
    """
    hot = max(1 << 14, 16 * int(shared.value.mean()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, given = shared.value, set()
        for batch in batches:
            rows = []
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for key_, text_hash, s in zip(keys, texts, shingle_sets(batch.column(2))):
                n = len(s)
                if n == 0:
                    rows.append((key_, text_hash, 0, None, None))
                    continue
                set_id = int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)
                if set_id in given:
                    rows.append((key_, text_hash, n, set_id, None))
                    continue
                if len(given) < 1_000_000:
                    given.add(set_id)
                c = counts[bucket(s)]
                first = np.argsort(c, kind="stable")[: prefix_size(n)]
                c, tokens = c[first], (s[first] >> np.uint64(64 - TOKEN_BITS)).astype(np.int64)
                salts = np.where(c > hot, 1 + abs(set_id) % np.minimum(1 + c // hot, (1 << 14) - 1), 0)
                rows.append((key_, text_hash, n, set_id, tokens | salts << TOKEN_BITS))
                if len(rows) >= 500:
                    yield to_batch(rows)
                    rows = []
            if rows:
                yield to_batch(rows)

    def to_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(zip(*rows), SETS_ARROW)], schema=SETS_ARROW
        )

    return (
        docs.select(F.col(key).cast("long"), F.xxhash64(F.col(text)), F.col(text)).toDF("key", "text_hash", "text")
        .mapInArrow(run, SETS)
    )


ENTRIES = "slot long, set_id long, n long, pos long, before long"
ENTRY_NAMES = [c.split()[0] for c in ENTRIES.split(", ")]


def branches(sets: DataFrame) -> DataFrame:
    """The (slot, set) entries of branches with more than one set.

    ``before`` is the previous set of the branch by length, if the two may be linked as far
    as their sizes and places tell.
    """

    def judged(rows: np.ndarray, start: int, stop: int) -> pa.RecordBatch:
        slot, set_id, n, pos = rows.T
        same = slot[1:] == slot[:-1]
        back, forth = np.append(False, same), np.append(same, False)
        room = 1 + np.minimum(n[:-1] - pos[:-1], n[1:] - pos[1:]) - 1
        near = np.append(False, same & (room >= need(n[:-1], n[1:])))
        keep = np.zeros(len(slot), bool)
        keep[start:stop] = (back | forth | (slot >> TOKEN_BITS > 0))[start:stop]
        before = np.append(np.int64(0), set_id[:-1])
        columns = [pa.array(c[keep]) for c in rows.T] + [pa.array(before[keep], mask=~near[keep])]
        return pa.RecordBatch.from_arrays(columns, names=ENTRY_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the last row waits for its successor, and the row before it stays as its neighbour
        rows, start = np.zeros((0, 4), np.int64), 0
        for batch in batches:
            more = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            rows = np.concatenate([rows, more])
            again = np.append(False, (rows[1:, 0] == rows[:-1, 0]) & (rows[1:, 1] == rows[:-1, 1]))
            rows = rows[~again]
            stop = len(rows) - 1
            if stop > start:
                yield judged(rows, start, stop)
                rows, start = rows[stop - 1 :], 1
        if len(rows) > start:
            yield judged(rows, start, len(rows))

    entries = sets.where(F.col("slots").isNotNull()).select(
        F.posexplode("slots").alias("pos", "slot"), "set_id", "n"
    )
    return (
        entries.select("slot", "set_id", "n", F.col("pos").cast("long"))
        .repartition("slot").sortWithinPartitions("slot", "n", "set_id")
        .mapInArrow(run, ENTRIES)
    )


def compare(pairs: DataFrame, sets: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """The linked ones of (u, v) pairs of set ids, by their whole texts.

    A text is fetched once for a set and sent to each of its pairs' first sets; the rows of a
    first set pass one by one behind it, so a set with very many partners takes no memory.
    """
    ids = pairs.select(F.col("u").alias("set_id")).unionByName(pairs.select(F.col("v").alias("set_id"))).distinct()
    texts = texts_of(ids, sets, docs, key, text)
    firsts = pairs.select("u").distinct().join(texts, F.col("u") == F.col("set_id")).select(
        "u", F.lit(None).cast("long").alias("v"), "text"
    )
    others = pairs.join(texts, F.col("v") == F.col("set_id")).select("u", "v", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = None
        for batch in batches:
            u, v = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found = []
            for a, b, s in zip(u, v, shingle_sets(batch.column(2))):
                if b is None:
                    first = s
                    continue
                common = len(np.intersect1d(first, s, assume_unique=True))
                if (100 + SHARE) * common >= SHARE * (len(first) + len(s)):
                    found.append((a, b))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["u", "v"])

    return (
        firsts.unionByName(others).repartition("u").sortWithinPartitions("u", F.col("v").asc_nulls_first())
        .mapInArrow(run, "u long, v long")
    )


class Trie:
    """Ordered sets as a trie, level by level.  A path without branches or ends is one node of
    up to ``PATH`` tokens, so a level is a step over many places of the order.

    ``levels`` has, for each node of a level, its parent, its tokens (a span of ``flat``) and,
    over the sets below it, the most tokens still to come, the smallest size and the highest
    number; ``leaf`` says which sets end at which nodes.  Sets are numbered by size, the
    smallest first.
    """

    def __init__(self, lists: list[np.ndarray], sizes: np.ndarray):
        self.flat = np.concatenate(lists)
        first = np.cumsum(sizes) - sizes
        # nodes, the root first: where in the order each ends, the node above, one set below and,
        # over all sets below, their greatest and smallest size and highest number
        end, parent, some, most, least, last = nodes = [0], [0], [0], [0], [1 << 62], [-1]
        at, path, before = np.zeros(len(lists), np.int64), [0], lists[0][:0]  # path: of the set added last

        def add(depth: int, k: int) -> None:
            for column, value in zip(nodes, (depth, path[-1], k, 0, 1 << 62, -1)):
                column.append(value)
            path.append(len(end) - 1)

        def leave(depth: int) -> None:
            """Nodes of the path below ``depth`` are complete; one that reaches past it is split."""
            while end[path[-1]] > depth:
                child = path.pop()
                if end[path[-1]] < depth:
                    add(depth, some[child])
                top = parent[child] = path[-1]
                most[top], least[top] = max(most[top], most[child]), min(least[top], least[child])
                last[top] = max(last[top], last[child])

        for k in sorted(range(len(lists)), key=lambda k: lists[k].astype(">u4").tobytes()):
            here, n = lists[k], int(sizes[k])
            size = min(len(before), n)
            differ = np.flatnonzero(before[:size] != here[:size])
            shared = int(differ[0]) if len(differ) else size
            leave(shared)
            if n > shared:
                add(n, k)
            at[k] = top = path[-1]
            most[top], least[top], last[top] = max(most[top], n), min(least[top], n), max(last[top], k)
            before = here
        leave(0)
        end, parent = np.array(end), np.array(parent)
        begin = end[parent]
        pieces = -(-(end - begin) // PATH)
        # nodes cut into pieces: each node is its last one, and the first hangs on the parent's last
        stop = np.cumsum(pieces + (end == 0)) - 1
        owner = np.repeat(np.arange(len(end)), pieces + (end == 0))
        number = np.arange(len(owner)) - (stop - pieces + 1)[owner]
        number[0] = 0
        low = begin[owner] + PATH * number
        high = np.minimum(low + PATH, end[owner])
        up = np.where(number > 0, np.arange(len(owner)) - 1, stop[parent][owner])
        depth = np.zeros(len(end), np.int64)
        for k in np.argsort(end, kind="stable")[1:].tolist():
            depth[k] = depth[parent[k]] + pieces[k]
        level = depth[owner] - (pieces[owner] - 1 - number)
        level[0] = 0
        most, least, last = (np.array(c)[owner] for c in (most, least, last))
        start = first[np.array(some)][owner] + low
        self.levels, self.leaf = [], []
        by_level = np.argsort(level, kind="stable")
        bounds = np.searchsorted(level[by_level], np.arange(level.max() + 2))
        ends_at = stop[at]
        by_leaf = np.argsort(level[ends_at], kind="stable")
        leaf_bounds = np.searchsorted(level[ends_at][by_leaf], np.arange(level.max() + 2))
        place = np.zeros(len(owner), np.int64)
        for d in range(len(bounds) - 1):
            nodes = by_level[bounds[d] : bounds[d + 1]]
            nodes = nodes[np.argsort(place[up[nodes]], kind="stable")]
            above = place[up[nodes]]
            place[nodes] = np.arange(len(nodes))
            if d:
                self.levels.append(
                    (above, start[nodes], (high - low)[nodes], (most - high)[nodes], least[nodes], last[nodes])
                )
            sets = by_leaf[leaf_bounds[d] : leaf_bounds[d + 1]]
            sets = sets[np.argsort(place[ends_at[sets]], kind="stable")]
            self.leaf.append((sets, place[ends_at[sets]]))

    def walk(
        self, has: np.ndarray, sizes: np.ndarray, numbers: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(probe, set, overlap) of the later sets that no bound rules out.

        ``has``: tokens by probes, 1 where held.  The overlap of a path is worked out once for
        all sets below it.  A node goes, with its subtree, if the overlap and the most tokens
        still to come below miss the least overlap that any set below needs, or if all sets
        below stand before the probe.
        """
        probe = np.arange(has.shape[1])
        node, overlap = np.zeros(len(probe), np.int64), np.zeros(len(probe), np.int64)
        for depth, (ends, at) in enumerate(self.leaf):
            if len(ends):
                which, child = below(at, node)
                later = ends[child] > numbers[probe[which]]
                if later.any():
                    yield probe[which][later], ends[child][later], overlap[which][later]
            if depth == len(self.levels):
                return
            parent, start, length, most, least, last = self.levels[depth]
            which, child = below(parent, node)
            probe, overlap = probe[which], overlap[which]
            # what a node's tokens could add at best rules out most nodes before they are read
            live = (overlap + most[child] + length[child] >= need(sizes[probe], least[child])) & (last[child] > numbers[probe])
            probe, child, overlap = probe[live], child[live], overlap[live]
            if not len(probe):
                return
            wanted = np.zeros(len(parent), bool)
            wanted[child] = True
            wanted = np.flatnonzero(wanted)
            size = length[wanted]
            stop = np.cumsum(size)
            tokens = self.flat[np.arange(stop[-1]) + np.repeat(start[wanted] - (stop - size), size)]
            held = np.add.reduceat(has[tokens], stop - size, axis=0, dtype=np.uint8)  # at most PATH
            overlap = overlap + held[np.searchsorted(wanted, child), probe]
            live = overlap + most[child] >= need(sizes[probe], least[child])
            probe, node, overlap = probe[live], child[live], overlap[live]
            if not len(probe):
                return


def below(parents: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``nodes``, place in ``parents``) of every child of every node; sorted parents."""
    low, high = np.searchsorted(parents, nodes), np.searchsorted(parents, nodes, side="right")
    times = high - low
    which = np.repeat(np.arange(len(nodes)), times)
    return which, low[which] + np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)


def block_links(members: list[tuple], local: bool, sketch: np.ndarray) -> list[tuple[int, int]]:
    """Links between the sets of a block, enough of them to join all that any links join.

    A member is (set_id, root, side, sorted shingle hashes).  Members of equal root are joined
    already.  Two sides of a split block are paired with each other, or all if ``local``.  The
    sets are compared by a walk through their trie, where whole sets stand in the global order
    and the overlap at a set's end is exact.
    """
    joined: dict[int, int] = {}

    def find(x: int) -> int:
        while joined.setdefault(x, x) != x:
            joined[x] = joined[joined[x]]
            x = joined[x]
        return x

    out = []
    members = sorted(members, key=lambda m: (len(m[3]), m[0]))
    sizes = np.array([len(m[3]) for m in members])

    def link(x: tuple, y: tuple) -> None:
        a, b = find(x[1]), find(y[1])
        if a != b:
            joined[a] = b
            out.append((x[0], y[0]))

    if len(members) < 2:
        return out
    every = np.unique(np.concatenate([m[3] for m in members]))
    number = np.empty(len(every), np.int64)
    number[np.lexsort((every, sketch[bucket(every)]))] = np.arange(len(every))
    lists = [np.sort(number[np.searchsorted(every, m[3])]) for m in members]
    trie = Trie(lists, sizes)
    step = max(1, min(64, 16_000_000 // max(1, len(every))))
    for a in range(0, len(members), step):
        b = min(len(members), a + step)
        has = np.zeros((len(every), b - a), np.uint8)
        for k in range(a, b):
            has[lists[k], k - a] = 1
        for probe, other, common in trie.walk(has, sizes[a:b], np.arange(a, b)):
            linked = common >= need(sizes[probe + a], sizes[other])
            for i, j in zip((probe[linked] + a).tolist(), other[linked].tolist()):
                if local or members[i][2] != members[j][2]:
                    link(members[i], members[j])
    return out


def groups_of(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows that are equal in their first ``width`` columns; a run is of bounded size."""
    now, rows = None, []
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            for row in zip(*(c.to_pylist() for c in batch.slice(at, ROWS).columns)):
                if row[:width] != now:
                    if rows:
                        yield now, rows
                    now, rows = row[:width], []
                rows.append(row[width:])
    if rows:
        yield now, rows


MEMBERS = "token long, low long, high long, side long, set_id long, root long, members long"


def possible_members(members: DataFrame) -> DataFrame:
    """Members of a branch that have a partner by size, place in the order and root.

    ``members`` is a hash of the list of them: branches of equal lists do the same work.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (token, low, high), rows in groups_of(batches, 3):
            side, set_id, root, n, pos = map(np.array, zip(*rows))
            held = np.zeros(len(n), bool)
            for k in range(len(n)):
                # sizes ascend, so partners of k stand behind it within the length ratio
                end = np.searchsorted(n, 100 * n[k] // SHARE, side="right")
                o = slice(k + 1, end)
                ok = (root[o] != root[k]) & (np.minimum(n[k] - pos[k], n[o] - pos[o]) >= need(n[k], n[o]))
                if low != high:
                    ok &= side[o] != side[k]
                if ok.any():
                    held[k] = True
                    held[o] |= ok
            chosen = np.flatnonzero(held)
            if not len(chosen):
                continue
            listed = np.sort(set_id[chosen]).tobytes() + bytes([low != high])
            same = int.from_bytes(hashlib.blake2b(listed, digest_size=8).digest(), "little", signed=True)
            for k in chosen:
                out.append((token, low, high, int(side[k]), int(set_id[k]), int(root[k]), same))
            if len(out) >= 10_000:
                yield long_batch(out, MEMBERS)
                out = []
        if out:
            yield long_batch(out, MEMBERS)

    return (
        members.repartition("token", "low", "high").sortWithinPartitions("token", "low", "high", "n")
        .select("token", "low", "high", "side", "set_id", "root", "n", "pos").mapInArrow(run, MEMBERS)
    )


def long_batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    names = [c.split()[0] for c in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*rows)], names=names)


def texts_of(ids: DataFrame, sets: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """(set_id, text) of one row of each of the sets, stored."""
    one = (
        sets.where(F.col("slots").isNotNull()).join(ids, "set_id").groupBy("set_id")
        .agg(F.min(F.struct("key", "text_hash")).alias("row"))
        .select("set_id", F.col("row.key").alias("key_"), F.col("row.text_hash").alias("hash_"))
    )
    on = F.col("key").eqNullSafe(F.col("key_")) & (F.col("hash_") == F.xxhash64("text"))
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).join(one, on)
    return stored(rows.select("set_id", "text").dropDuplicates(["set_id"]), "join-texts")


def remaining_links(
    entries: DataFrame, sets: DataFrame, roots: DataFrame, docs: DataFrame, key: str, text: str, shared
) -> DataFrame:
    """Links between sets of different roots.

    Sets that possibly link share a branch.  Of branches with the same possible members one is
    compared, with whole texts; a large branch is split, and its parts are paired.
    """
    rooted = (
        entries.select(F.col("slot").bitwiseAND(F.lit(int(TOKEN_MASK))).alias("token"), "set_id", "n", "pos")
        .join(roots, F.col("set_id") == F.col("node"), "left")
        .withColumn("root", F.coalesce("root", "set_id")).drop("node")
    )
    long = stored(long_pairs(rooted), "long-pairs")
    rooted = rooted.where(F.col("n") <= LONG)
    possible = stored(possible_members(split(rooted.join(open_branches(rooted), "token"))), "branch-members")
    block = ["token", "low", "high"]
    once = possible.groupBy("members").agg(F.min(F.struct(*block)).alias("at")).select("at.*")
    texts = texts_of(possible.select("set_id").distinct(), sets, docs, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value

        def linked(now: tuple, rows: list[tuple]) -> list[tuple[int, int]]:
            found = shingle_sets(pa.array([r[3] for r in rows], pa.string()))
            return block_links([(r[1], r[2], r[0], s) for r, s in zip(rows, found)], now[1] == now[2], sketch)

        out = []
        for now, rows in groups_of(batches, 3):
            out += linked(now, rows)
            if len(out) >= 10_000:
                yield long_batch(out, "u long, v long")
                out = []
        if out:
            yield long_batch(out, "u long, v long")

    blocks = (
        possible.join(once, block).join(texts, "set_id").repartition(*block).sortWithinPartitions(*block)
        .select(*block, "side", "set_id", "root", "text").mapInArrow(run, "u long, v long")
    )
    return blocks if long.isEmpty() else blocks.unionByName(compare(long, sets, docs, key, text))


def open_branches(rooted: DataFrame) -> DataFrame:
    """(token, parts) of the branches that hold several roots.  A part has about ``BLOCK`` sets
    or ``LOAD`` shingles, whichever is less."""
    return (
        rooted.groupBy("token").agg(
            F.count("*").alias("size"), F.sum("n").alias("load"), F.min("root").alias("a"), F.max("root").alias("b")
        )
        .where("a < b")
        .select("token", F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("load") / LOAD)).alias("parts"))
    )


def long_pairs(rooted: DataFrame) -> DataFrame:
    """(u, v) of the sets of different roots, one of them over ``LONG``, that possibly link."""
    most = rooted.where(F.col("n") > LONG)
    others = rooted.where(100 * F.col("n") > SHARE * LONG).select(
        "token", *(F.col(c).alias(f"{c}_") for c in ("set_id", "n", "pos", "root"))
    )
    total = F.col("n") + F.col("n_")
    room = F.least(F.col("n") - F.col("pos"), F.col("n_") - F.col("pos_"))
    return (
        most.join(others, "token").where((F.col("root") != F.col("root_")) & ((100 + SHARE) * room >= SHARE * total))
        .select(F.least("set_id", "set_id_").alias("u"), F.greatest("set_id", "set_id_").alias("v")).distinct()
    )


def split(members: DataFrame) -> DataFrame:
    """Each row once for every pair of parts that its part is in: (side, low, high)."""
    side = F.pmod(F.xxhash64("set_id"), F.col("parts"))
    return (
        members.withColumn("side", side)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .withColumn("low", F.least("side", "other")).withColumn("high", F.greatest("side", "other"))
    )


def ngram_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, text_hash) of every row.

    Rows link when their sets of five-word shingles have a Jaccard similarity of 0.75 or more;
    A-Z count as a-z.  With fewer words the whole sequence is the one shingle.  A null text or
    one without words has an empty set, is linked with nothing and keeps its own key.  Rows of
    equal sets are linked; ``component_id`` is the smallest key reachable, nulls aside.  Other
    columns are ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequency_sketch(docs, text))
    sets = stored(ordered_sets(docs, key, text, shared), "shingle-sets")
    entries = stored(branches(sets), "branches")
    near = entries.where(F.col("before").isNotNull()).select(
        F.least("before", "set_id").alias("u"), F.greatest("before", "set_id").alias("v")
    ).distinct()
    links = stored(compare(near, sets, docs, key, text), "links-near")
    roots = components(links)
    more = stored(remaining_links(entries, sets, roots, docs, key, text, shared), "links-left")
    roots = components(links.unionByName(more))
    smallest = sets.where("n > 0").groupBy("set_id").agg(F.min("key").alias("least"))
    rooted = smallest.join(roots, F.col("set_id") == F.col("node"), "left").withColumn(
        "root", F.coalesce("root", "set_id")
    )
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.select("set_id", "root").join(of_root, "root").select("set_id", "component_id")
    return sets.join(classes, "set_id", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"),
        "text_hash",
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each class of near copies: the one with the smallest key.

    Texts without words are in no class, and their rows stay.  A key stands for a document:
    rows with the key that stays and a text of its class all stay, and so do null keys.
    Columns pass through, whatever their names (``set_aside``); an empty table stays empty.
    """
    return set_aside(docs, (key, text), lambda d: _keep_one(d, key, text))


def _keep_one(docs: DataFrame, key: str, text: str) -> DataFrame:
    classes = ngram_classes(docs, key, text)
    copies = stored(
        classes.where(F.col(key) != F.col("component_id"))
        .select(F.col(key).alias("key_"), F.col("text_hash").alias("hash_")).distinct(),
        "copies",
    )
    # only rows that may be copies are shuffled
    rows = marked(
        docs.withColumn("text_hash_", F.xxhash64(F.col(text))), copies.select(F.col("hash_").alias("text_hash_")),
        "text_hash_", "left",
    )
    on = (F.col(key) == F.col("key_")) & (F.col("text_hash_") == F.col("hash_"))
    kept = rows.where("maybe_").join(copies, on, "left_anti")
    return rows.where(~F.col("maybe_")).unionByName(kept).select(*docs.columns)


@query("op2_trie_jaccard_join")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_classes(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text_hash")
