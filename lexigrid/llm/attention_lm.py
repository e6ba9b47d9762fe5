"""Language-model scores: a causal self-attention model in numpy, and a smoothed unigram base.

``gradients`` states the model and its slopes in numpy; ``fast_gradients`` and ``Model`` work the
same out in graphs that onnxruntime runs where it is installed.

Words and subword ids of all training documents are counted.  The model predicts the class
of the next subword id from up to 31 ids before it, and the counts of all training ids give
an id's share of its class; the product is a probability of the id.  Windows overlap by half:
a window's first half is context, each id of its second half is scored, so that every id of
a text is scored once.  Training is data-parallel: trainers run the same steps over their own
windows and their parameters are averaged.  All training texts are learned from; a trainer
reads its runs as a stream.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.llm.bm25_packing import VOCABULARY
from lexigrid.llm.graphs import FLOAT, INT64, compiled, node, product
from lexigrid.llm.registry import query, table
from lexigrid.llm.subwords import SubwordIds, subword_ids
from lexigrid.llm.textbatch import Words, batch_words, mix
from lexigrid.session import stored

POOL = 16  # minibatches whose windows a trainer holds and mixes
STEP = 16  # ids that a window scores; as many before them are context
PAD, END = 49406, 49407
WORD, SUBWORD, TEXT_END, RUN = 0, 1, 2, 3
INPUTS, OUTPUTS, DIM = 512, 64, 16
ALPHA = 0.1


@dataclass(frozen=True)
class Settings:
    """``share``: one of so many runs of ``run_words`` words is a training example; 1, all are.
    ``runs``: examples of one trainer.  ``copies``: equal runs that one
    example may stand for.  ``table``: words whose counts are sent to every task; the others
    are joined.
    """

    share: int = 1
    run_words: int = 64
    runs: int = 4000
    copies: int = 64
    rounds: int = 2
    batch: int = 256
    rate: float = 0.004
    table: int = 1 << 18


def held_out(key: str):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 10 == 0, F.lit(False))


# ---- counting ----------------------------------------------------------------------------


READ = "kind int, key long, n long, ids binary"


def read_texts(docs: DataFrame, tokenizer: str, settings: Settings) -> DataFrame:
    """(kind, key, n, ids): counts of words by hash, subword ids, and ends, over ``text`` of all
    rows, and the runs of words that are training examples; a text's last run has its end.

    A text is taken apart once for both.
    """

    def emit(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.view(np.int64)),
                pa.array(n.astype(np.int64)), pa.nulls(len(keys), pa.binary()),
            ],
            names=["kind", "key", "n", "ids"],
        )

    def fold(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        return distinct, np.bincount(inverse, np.concatenate(counts), len(distinct)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = subword_ids(tokenizer)
        ids, ends, keys, counts, held = np.zeros(VOCABULARY, np.int64), 0, [], [], 0
        for batch in batches:
            ends += batch.num_rows
            for _, _, words in batch_words(batch.column(0)):
                distinct, n = np.unique(words.hashes, return_counts=True)
                keys.append(distinct)
                counts.append(n)
                held += len(distinct)
                found, chosen = text_runs(words, known, settings)
                ids += np.bincount(np.concatenate(found), minlength=VOCABULARY)
                some = [f.astype("<u2").tobytes() for f, c in zip(found, chosen) if c]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(some), RUN, np.int32)), pa.nulls(len(some), pa.int64()),
                        pa.array(np.ones(len(some), np.int64)), pa.array(some, pa.binary()),
                    ],
                    names=["kind", "key", "n", "ids"],
                )
            if held > 4_000_000:
                yield emit(WORD, *fold(keys, counts))
                keys, counts, held = [], [], 0
        if keys:
            yield emit(WORD, *fold(keys, counts))
        some = np.flatnonzero(ids)
        yield emit(SUBWORD, some, ids[some])
        yield emit(TEXT_END, np.zeros(1, np.int64), np.array([ends]))

    return docs.select("text").mapInArrow(run, READ)


def text_runs(words: Words, known: SubwordIds, settings: Settings) -> tuple[list[np.ndarray], np.ndarray]:
    """Ids of the runs of ``run_words`` words of some texts, the last one of each with its end,
    and which are training examples."""
    size = np.diff(words.first)
    n = np.maximum(1, -(-size // settings.run_words))
    stop = np.cumsum(n)
    number = np.arange(n.sum()) - np.repeat(stop - n, n)
    last = np.zeros(len(number), bool)
    last[stop - 1] = True
    seeds = mix(np.array([words.hashes[a:b].sum() + np.uint64(b - a) for a, b in zip(words.first, words.first[1:])], np.uint64))
    chosen = mix(np.repeat(seeds, n) + number.astype(np.uint64)) % np.uint64(settings.share) == 0
    words.first = np.append(np.repeat(words.first[:-1], n) + number * settings.run_words, words.first[-1])
    return [np.append(ids, np.uint16(END)) if end else ids for ids, end in zip(known.encode_words(words), last)], chosen


@dataclass
class Classes:
    """Input and output classes of each subword id, and the log share of an id in its class."""

    inputs: np.ndarray
    outputs: np.ndarray
    log_share: np.ndarray
    log_mass: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Classes:
        """Frequent ids are classes of their own; the others share classes of like frequency."""
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(VOCABULARY, np.int64)
        rank[order] = np.arange(VOCABULARY)
        own = INPUTS - 64
        inputs = np.where(rank < own, rank, own + np.arange(VOCABULARY) % 63)
        inputs[PAD] = INPUTS - 1
        smooth = counts[order] + ALPHA
        own = OUTPUTS // 2
        mass = np.cumsum(smooth[own:])
        outputs = np.empty(VOCABULARY, np.int64)
        outputs[order[:own]] = np.arange(own)
        binned = np.minimum((mass - smooth[own:] / 2) / mass[-1] * (OUTPUTS - own), OUTPUTS - own - 1)
        outputs[order[own:]] = own + binned.astype(np.int64)
        total = np.bincount(outputs, counts + ALPHA, OUTPUTS)
        return cls(inputs, outputs, np.log((counts + ALPHA) / total[outputs]), np.log(total / total.sum()))


# ---- the model ---------------------------------------------------------------------------

SHAPES = {
    "embed": (INPUTS, DIM), "query": (DIM, DIM), "key": (DIM, DIM), "value": (DIM, DIM),
    "near": (2 * STEP - 1,), "out": (DIM, OUTPUTS), "bias": (OUTPUTS,),
}
SIZES = {k: int(np.prod(s)) for k, s in SHAPES.items()}
PLACES = np.arange(STEP)[:, None] + STEP - 1 - np.arange(2 * STEP - 1)[None, :]  # how far back a key lies
MASK = np.where(PLACES >= 0, 0, -1e9).astype(np.float32)


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        out[name] = flat[at : at + SIZES[name]].reshape(shape)
        at += SIZES[name]
    return out


def fresh(classes: Classes, seed: int = 7) -> np.ndarray:
    """Small random numbers; without context the classes have their shares of the corpus."""
    rng = np.random.default_rng(seed)
    flat = rng.standard_normal(sum(SIZES.values())).astype(np.float32) * 0.1
    p = unpack(flat)
    p["near"][:] = 0
    p["bias"][:] = classes.log_mass
    return flat


def windows_of(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of 2 * STEP ids, which of their last STEP ids are to score, and whose they are.

    Windows begin every STEP ids, the first with nothing but padding as context.
    """
    n = np.array([len(t) for t in texts], np.int64)
    rows = -(-n // STEP)
    first = np.cumsum(rows + 1) - (rows + 1)
    grid = np.full((int((rows + 1).sum()), STEP), PAD, "<u2")
    stream = grid.reshape(-1)
    for t, at in zip(texts, ((first + 1) * STEP).tolist()):
        stream[at : at + len(t)] = t
    last = np.ones(len(grid), bool)
    last[first] = False
    last = np.flatnonzero(last)
    owner = np.repeat(np.arange(len(n)), rows)
    scored = n[owner] - STEP * (last - first[owner] - 1)  # ids from the window's on
    return np.concatenate([grid[last - 1], grid[last]], axis=1), np.arange(STEP) < scored[:, None], owner


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(-1, keepdims=True))
    return x / x.sum(-1, keepdims=True)


def gradients(flat: np.ndarray, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, float]:
    """Gradient and mean loss of windows; x: input classes (n, 31), y: output classes (n, 16)."""
    p, scale = unpack(flat), np.float32(DIM**-0.5)
    e = p["embed"][x]
    here = e[:, STEP - 1 :]
    q, k, v = here @ p["query"], e @ p["key"], e @ p["value"]
    back = np.maximum(PLACES, 0)
    a = softmax(q @ k.transpose(0, 2, 1) * scale + p["near"][back] + MASK)
    h = a @ v + here
    prob = softmax(h @ p["out"] + p["bias"])
    picked = np.take_along_axis(prob, y[..., None], 2)[..., 0]
    total = max(1, int(mask.sum()))
    d = prob
    np.put_along_axis(d, y[..., None], picked[..., None] - 1, 2)
    d *= mask[..., None] / np.float32(total)
    grad = np.zeros_like(flat)
    g = unpack(grad)
    g["out"] += h.reshape(-1, DIM).T @ d.reshape(-1, OUTPUTS)
    g["bias"] += d.sum((0, 1))
    dh = d @ p["out"].T
    da = dh @ v.transpose(0, 2, 1)
    ds = a * (da - (da * a).sum(-1, keepdims=True))
    np.add.at(g["near"], back, ds.sum(0) * (PLACES >= 0))
    ds = ds * scale
    dq, dk, dv = ds @ k, ds.transpose(0, 2, 1) @ q, a.transpose(0, 2, 1) @ dh
    g["query"] += here.reshape(-1, DIM).T @ dq.reshape(-1, DIM)
    g["key"] += e.reshape(-1, DIM).T @ dk.reshape(-1, DIM)
    g["value"] += e.reshape(-1, DIM).T @ dv.reshape(-1, DIM)
    de = dk @ p["key"].T + dv @ p["value"].T
    de[:, STEP - 1 :] += dh + dq @ p["query"].T
    np.add.at(g["embed"], x, de)
    return grad, float(-(np.log(np.maximum(picked, 1e-12)) * mask).sum() / total)


# A window's last id is no key; graphs take it along, hidden, so that rows have 2 * STEP keys.
AWAY = np.arange(STEP)[:, None] + STEP - 1 - np.arange(2 * STEP)[None, :]
BACK = np.maximum(AWAY, 0)
HIDDEN = np.where(AWAY >= 0, 0, -1e9).astype(np.float32)
CALL = 128  # windows of one call, whose arrays fit a core's cache
HALF = DIM // 2  # a class' parameters are summed two by two, as complex numbers
CELLS = np.arange(INPUTS)[:, None] * HALF + np.arange(HALF)

# asked: embed @ query @ key.T * DIM**-0.5.  What keys and values do to the embeddings of all ids
# of a window is done to the few vectors that meet them instead.  Behind a position's own
# embedding stands a 1, which the last row of ``out``, the bias, meets.
FORWARD = [
    node("Gather", "embed x", "e"), node("Gather", "asked here", "a"), node("Gather", "embed_1 here", "own"),
    product("a e", "s", transB=1), node("Add", "s near", "s_near"), node("Softmax", "s_near", "weights", axis=-1),
    node("MatMul", "weights e", "mixed"), node("Reshape", "mixed flat", "w"), node("Reshape", "own flat_1", "own_flat"),
    node("Gemm", "w value_0 own_flat", "h"), node("MatMul", "h out_1", "z"),
]
BACKWARD = [
    node("Softmax", "z", "p", axis=-1), node("Sub", "p right", "d"),
    node("Mul", "h masks_1", "h_m"), node("Gemm", "h_m d", "g_out", transA=1),
    node("Gemm", "d out", "dh_all", transB=1), node("Mul", "dh_all masks", "dh"), node("Gemm", "w dh", "g_value", transA=1),
    node("Gemm", "dh value", "b_flat", transB=1), node("Reshape", "b_flat deep", "b"),
    product("b e", "da", transB=1), node("Mul", "b mixed", "b_w"), node("ReduceSum", "b_w last", "c", keepdims=1),
    node("Sub", "da c", "da_c"), node("Mul", "da_c weights", "ds"), node("ReduceSum", "ds zero", "g_near", keepdims=0),
    node("MatMul", "ds e", "d_asked"), node("Reshape", "d_asked flat", "d_asked_flat"),
    node("Gemm", "own_flat d_asked_flat", "g_asked", transA=1), node("Gemm", "d_asked_flat turned dh", "d_own", transB=1),
    product("ds a", "de_s", transA=1), product("weights b", "de_v", transA=1), node("Add", "de_s de_v", "de"),
]
SCORES = [node("LogSoftmax", "z", "log_p", axis=-1), node("GatherElements", "log_p y", "picked", axis=1)]
FORWARD_NUMBERS = {"flat": [-1, DIM], "flat_1": [-1, DIM + 1]}
BACKWARD_NUMBERS = {"deep": [-1, STEP, DIM], "last": [-1], "zero": [0]}
GIVEN = {
    "embed": (FLOAT, (INPUTS, DIM)), "embed_1": (FLOAT, (INPUTS, DIM + 1)), "asked": (FLOAT, (INPUTS, DIM)),
    "near": (FLOAT, (STEP, 2 * STEP)), "value_0": (FLOAT, (DIM, DIM + 1)), "out_1": (FLOAT, (DIM + 1, OUTPUTS)),
    "x": (INT64, ("n", 2 * STEP)), "here": (INT64, ("n", STEP)),
}
FOR_SLOPES = {
    "value": (FLOAT, (DIM, DIM)), "out": (FLOAT, (DIM, OUTPUTS)), "turned": (FLOAT, (DIM, DIM)),
    "right": (FLOAT, ("ids", OUTPUTS)), "masks": (FLOAT, ("ids", DIM)), "masks_1": (FLOAT, ("ids", DIM + 1)),
}
SLOPES = ["de", "d_own", "g_out", "g_value", "g_asked", "g_near"]


@cache
def graph(name: str) -> Callable[[dict[str, np.ndarray]], list[np.ndarray]] | None:
    """The graph of a process, None where onnxruntime is not installed."""
    try:
        if name == "slopes":
            return compiled(FORWARD + BACKWARD, FORWARD_NUMBERS | BACKWARD_NUMBERS, GIVEN | FOR_SLOPES, SLOPES)
        return compiled(FORWARD + SCORES, FORWARD_NUMBERS, GIVEN | {"y": (INT64, ("ids", 1))}, ["picked"])
    except ModuleNotFoundError as missing:
        if missing.name != "onnxruntime":
            raise
        return None


def parameters(p: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """What the forward graph takes of some parameters."""
    turned = (p["query"] @ p["key"].T) * np.float32(DIM**-0.5)
    return {
        "embed": p["embed"], "embed_1": np.concatenate([p["embed"], np.ones((INPUTS, 1), np.float32)], axis=1),
        "asked": p["embed"] @ turned, "near": p["near"][BACK] + HIDDEN,
        "value_0": np.concatenate([p["value"], np.zeros((DIM, 1), np.float32)], axis=1),
        "out_1": np.concatenate([p["out"], p["bias"][None]]),
    }


@cache
def none_right() -> np.ndarray:
    """Zeros for the classes of a call's ids, which it sets to zero again."""
    return np.zeros((CALL * STEP, OUTPUTS), np.float32)


def fast_gradients(flat: np.ndarray, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The gradient of ``gradients``; x: input classes of whole windows (n, 32)."""
    slopes = graph("slopes")
    if slopes is None:
        return gradients(flat, x[:, :-1], y, mask)[0]
    p = unpack(flat)
    share = mask / np.float32(max(1, int(mask.sum())))
    turned = (p["query"] @ p["key"].T) * np.float32(DIM**-0.5)
    given = parameters(p) | {"turned": turned, "value": p["value"], "out": p["out"]}
    sums, added = np.zeros(INPUTS * HALF, np.complex64), []
    for at in range(0, len(x), CALL):
        some, ids = x[at : at + CALL], share[at : at + CALL].reshape(-1, 1)
        right, cells = none_right()[: len(ids)], np.arange(0, len(ids) * OUTPUTS, OUTPUTS) + y[at : at + CALL].ravel()
        right.reshape(-1)[cells] = 1
        de, d_own, *parts = slopes(
            given | {"x": some, "here": np.ascontiguousarray(some[:, STEP - 1 : -1]), "right": right}
            | {"masks": np.repeat(ids, DIM, axis=1), "masks_1": np.repeat(ids, DIM + 1, axis=1)}
        )
        right.reshape(-1)[cells] = 0
        de[:, STEP - 1 : -1] += d_own.reshape(-1, STEP, DIM)
        np.add.at(sums, np.take(CELLS, some, axis=0).ravel(), de.reshape(-1).view(np.complex64))
        added.append(parts)
    g_out, g_value, g_asked, g_near = (sum(part) for part in zip(*added))
    g_asked = g_asked[:-1] * np.float32(DIM**-0.5)
    parts = {
        "embed": sums.view(np.float32), "query": g_asked @ p["key"], "key": g_asked.T @ p["query"], "value": g_value,
        "near": np.bincount(BACK[AWAY >= 0], g_near[AWAY >= 0], 2 * STEP - 1), "out": g_out[:-1], "bias": g_out[-1],
    }
    return np.concatenate([parts[name].ravel() for name in SHAPES]).astype(np.float32)


class Descent:
    """One pass of Adam over a stream of runs, each counted ``weight`` times.

    Windows wait in a pool of ``POOL`` minibatches, are mixed there and learned from.
    """

    def __init__(self, flat: np.ndarray, classes: Classes, settings: Settings, seed: int):
        self.flat, self.classes, self.settings = flat.copy(), classes, settings
        self.rng, self.step, self.weight = np.random.default_rng(seed), 0, 0.0
        self.m, self.v = np.zeros_like(flat), np.zeros_like(flat)
        self.texts, self.weights, self.held = [], [], 0
        self.left = np.zeros((0, 2 * STEP), "<u2"), np.zeros((0, STEP), np.float32)

    def add(self, text: np.ndarray, weight: float = 1.0) -> None:
        self.texts.append(text)
        self.weights.append(weight)
        self.weight += len(text) * weight
        self.held += -(-len(text) // STEP)
        if self.held >= POOL * self.settings.batch:
            self.learn(last=False)

    def learn(self, last: bool) -> None:
        """Steps over the pool; windows that fill no minibatch wait, unless these are the last."""
        windows, mask, owner = windows_of(self.texts)
        mask = mask * np.array(self.weights, np.float32)[owner][:, None]
        windows, mask = np.concatenate([self.left[0], windows]), np.concatenate([self.left[1], mask])
        order = self.rng.permutation(len(windows))
        stop = len(order) if last else len(order) - len(order) % self.settings.batch
        for at in range(0, stop, self.settings.batch):
            w = order[at : min(stop, at + self.settings.batch)]
            some = windows[w]
            grad = fast_gradients(self.flat, self.classes.inputs[some], self.classes.outputs[some[:, STEP:]], mask[w])
            self.step += 1
            self.m = 0.9 * self.m + 0.1 * grad
            self.v = 0.99 * self.v + 0.01 * grad**2
            slope = self.m / (1 - 0.9**self.step)
            self.flat -= self.settings.rate * slope / (np.sqrt(self.v / (1 - 0.99**self.step)) + 1e-8)
        self.left = windows[order[stop:]], mask[order[stop:]]
        self.texts, self.weights, self.held = [], [], 0

    def end(self) -> np.ndarray:
        self.learn(last=True)
        return self.flat.astype(np.float32)


def descend(flat: np.ndarray, texts: list[np.ndarray], classes: Classes, settings: Settings, seed: int) -> np.ndarray:
    """One pass of Adam over the windows of some runs."""
    descent = Descent(flat, classes, settings, seed)
    for text in texts:
        descent.add(text)
    return descent.end()


class Model:
    """Log probabilities of ids by some parameters."""

    def __init__(self, flat: np.ndarray, classes: Classes):
        self.classes, self.flat = classes, flat.astype(np.float32)
        self.parameters = parameters(unpack(self.flat))

    def picked(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Log probabilities of the output classes y (n, 16) behind the input classes x (n, 32)."""
        here, scores = np.ascontiguousarray(x[:, STEP - 1 : -1]), graph("scores")
        if scores is not None:
            return scores(self.parameters | {"x": x, "here": here, "y": y.reshape(-1, 1)})[0].reshape(y.shape)
        p = self.parameters
        e = p["embed"][x]
        a = softmax(np.matmul(p["asked"][here], e.transpose(0, 2, 1)) + p["near"])
        z = (np.matmul(a, e) @ p["value_0"] + p["embed_1"][here]) @ p["out_1"]
        z -= z.max(2, keepdims=True)
        return np.take_along_axis(z, y[..., None], 2)[..., 0] - np.log(np.exp(z).sum(2))

    def log_probabilities(self, texts: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of each text's ids."""
        windows, mask, owner = windows_of(texts)
        out = np.zeros(len(texts))
        for a in range(0, len(windows), CALL):
            w = windows[a : a + CALL]
            y = w[:, STEP:]
            log_p = self.picked(self.classes.inputs[w], self.classes.outputs[y]) + self.classes.log_share[y]
            out += np.bincount(owner[a : a + CALL], (log_p * mask[a : a + CALL]).sum(1), len(texts))
        return out


# ---- training and scoring on Spark -------------------------------------------------------


def training_runs(docs: DataFrame, tokenizer: str, settings: Settings) -> DataFrame:
    """(ids) of the runs of words of all texts; a text's last run has its end."""
    return read_texts(docs, tokenizer, settings).where(F.col("kind") == RUN).select("ids")


def deal(runs: DataFrame, settings: Settings) -> tuple[DataFrame, int]:
    """(trainer, ids, weight) of the runs, and how many trainers there are.  Runs may be counted
    (ids, n).

    Equal runs fold into rows that each stand for up to ``copies`` of them and go to different
    trainers, so neither a frequent run nor the choice of runs fills one trainer.
    """
    folded = runs if "n" in runs.columns else stored(runs.groupBy("ids").agg(F.count("*").alias("n")), "folded-runs")
    rows = F.ceil(F.col("n") / settings.copies)
    n_rows = folded.agg(F.sum(rows)).first()[0] or 0
    trainers = max(1, -(-n_rows // settings.runs))
    dealt = folded.withColumn("rows", F.least(rows, F.lit(trainers))).select(
        "ids", (F.col("n") / F.col("rows")).alias("weight"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("row"),
    )
    trainer = F.pmod(F.pmod(F.xxhash64("ids"), F.lit(trainers)) + F.col("row"), F.lit(trainers))
    return dealt.select(trainer.alias("trainer"), "ids", "weight"), trainers if n_rows else 0


def binary_rows(column: pa.BinaryArray) -> Iterator[np.ndarray]:
    """Each row's ids, without a copy."""
    bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    ids = np.frombuffer(column.buffers()[2], "<u2", int(bounds[-1]) // 2)
    return (ids[a:b] for a, b in itertools.pairwise((bounds // 2).tolist()))


def train(runs: DataFrame, classes: Classes, settings: Settings) -> np.ndarray:
    """Rounds of local descent and averaging; each trainer weighs as much as its ids."""
    flat = fresh(classes)
    dealt, trainers = deal(runs, settings)
    for turn in range(settings.rounds if trainers else 0):
        start = flat

        def run(batches: Iterator[pa.RecordBatch], start=start, turn=turn) -> Iterator[pa.RecordBatch]:
            def trainers() -> Iterator[tuple[float, np.ndarray]]:
                now, descent = None, None
                for batch in batches:
                    trainer, weight = batch.column(0).to_pylist(), batch.column(2).to_pylist()
                    for t, ids, w in zip(trainer, binary_rows(batch.column(1)), weight):
                        if t != now:
                            if descent:
                                yield descent.weight, descent.end()
                            now, descent = t, Descent(start, classes, settings, 1000 * turn + t % 1000)
                        descent.add(ids, w)
                if descent:
                    yield descent.weight, descent.end()

            total, added = 0.0, np.zeros(len(start))
            for weight, moved in trainers():  # one row a task, however many trainers it has
                total += weight
                added += weight * moved
            if total:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([total]), pa.array([(added / total).tolist()], pa.list_(pa.float64()))], names=["weight", "flat"]
                )

        moved = (
            dealt.repartition("trainer").withColumn("turn", F.xxhash64("ids", F.lit(turn)))
            .sortWithinPartitions("trainer", "turn", "ids")
            .select("trainer", "ids", "weight").mapInArrow(run, "weight double, flat array<double>")
            .select("weight", F.posexplode("flat").alias("place", "value"))
            .groupBy("place").agg((F.sum(F.col("weight") * F.col("value")) / F.sum("weight")).alias("value"))
        )
        rows = moved.toPandas().sort_values("place")  # one row a parameter
        flat = rows["value"].to_numpy(np.float32)
    return flat


SCORED = (
    "row_id long, key long, held_out boolean, n_tokens long, known long, base double, score double,"
    " rare array<long>, times array<long>"
)
SCORED_ARROW = pa.schema(
    [("row_id", pa.int64()), ("key", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
     ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()),
     ("rare", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))]
)


def frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes and counts of the words counted at least so often that no more than ``most`` are,
    and that count."""
    words = counts.where(F.col("kind") == WORD)
    level = F.floor(F.log2("n") * 16).cast("int")
    levels = words.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()  # under 1024 rows
    least, left = 0, sum(r.words for r in levels)
    for row in sorted(levels, key=lambda r: r.level):
        if left <= most:
            break
        left -= row.words
        least = row.level + 1
    found = words.where(level >= least).select("key", "n").toPandas()
    order = np.argsort(found["key"].to_numpy(np.int64).view(np.uint64))
    return found["key"].to_numpy(np.int64).view(np.uint64)[order], found["n"].to_numpy(np.int64)[order], least


class Places:
    """Where hashes lie in a sorted array of them: most by one look at a slot."""

    def __init__(self, hashes: np.ndarray):
        self.hashes, self.bits = hashes, np.uint64((4 << len(hashes).bit_length()) - 1)
        slots = (hashes & self.bits).astype(np.int64)
        self.slots = np.full(int(self.bits) + 1, -1, np.int32)
        self.slots[slots] = np.arange(len(hashes))
        self.others = np.flatnonzero(self.slots[slots] != np.arange(len(hashes)))  # slots hold one each

    def of(self, some: np.ndarray) -> np.ndarray:
        """Each one's place, -1 for those that are not there."""
        place = self.slots[(some & self.bits).astype(np.int64)].astype(np.int64)
        wrong = np.flatnonzero(place >= 0)
        wrong = wrong[self.hashes[place[wrong]] != some[wrong]]
        place[wrong] = -1
        if len(self.others):
            found = self.others[np.minimum(np.searchsorted(self.hashes[self.others], some[wrong]), len(self.others) - 1)]
            place[wrong] = np.where(self.hashes[found] == some[wrong], found, -1)
        return place


def score_texts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, settings: Settings = Settings()
) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Rows whose crc32(key as text) mod 10 is 0 are held out, all others train; a null key
    trains.  A null or empty text is its end alone.  Repeated rows are scored each for itself
    and counted each; other columns are ignored; an empty table gives no rows.  Word counts
    beyond the table of frequent words are joined, so no count is lost.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    rows = docs.select(
        F.col(key).cast("long").alias("key"), held_out(key).alias("held_out"), F.col(text).alias("text")
    )
    training = rows.where(~F.col("held_out"))
    read = read_texts(training, path, settings).groupBy("kind", "key", "ids").agg(F.sum("n").alias("n"))
    read = stored(read, "read-texts")
    counts, runs = read.where(F.col("kind") != RUN).select("kind", "key", "n"), read.where(F.col("kind") == RUN).select("ids", "n")
    totals = {r.kind: (r.n or 0, r.distinct) for r in counts.where("n > 0").groupBy("kind").agg(
        F.sum("n").alias("n"), F.count("*").alias("distinct")).collect()}
    ends = totals.get(TEXT_END, (0, 0))[0]
    n_all = totals.get(WORD, (0, 0))[0] + ends
    distinct = totals.get(WORD, (0, 0))[1] + (ends > 0)
    below = n_all + ALPHA * (distinct + 1)
    by_id = np.zeros(VOCABULARY, np.int64)
    for row in counts.where(F.col("kind") == SUBWORD).collect():  # at most VOCABULARY rows
        by_id[row.key] = row.n
    classes = Classes.of(by_id)
    flat = train(runs, classes, settings)
    hashes, often, _ = frequent(counts, settings.table)
    shared = docs.sparkSession.sparkContext.broadcast((hashes, np.log10((often + ALPHA) / below), flat, classes))
    end_score = float(np.log10((ends + ALPHA) / below))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, logs, flat, classes = shared.value
        model, known, places = Model(flat, classes), subword_ids(path), Places(hashes)
        row_id = TaskContext.get().partitionId() << 36
        for batch in batches:
            for a, b, words in batch_words(batch.column(2)):
                n, owner = np.diff(words.first), words.owners()
                place = places.of(words.hashes)
                hit = place >= 0
                base = np.bincount(owner[hit], logs[place[hit]], b - a) + end_score
                known_words = np.bincount(owner[hit], minlength=b - a) + (ends > 0)
                rare, times = [], []
                missed, its = words.hashes[~hit], owner[~hit]
                bounds = np.searchsorted(its, np.arange(b - a + 1))
                texts = [np.append(ids, np.uint16(END)) for ids in known.encode_words(words)]
                for k in range(b - a):
                    some, count = np.unique(missed[bounds[k] : bounds[k + 1]], return_counts=True)
                    rare.append(some.view(np.int64))
                    times.append(count)
                score = model.log_probabilities(texts) / np.log(10)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row_id + np.arange(b - a)), batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a), pa.array(n + 1), pa.array(known_words), pa.array(base),
                        pa.array(score), pa.array(rare, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64())),
                    ],
                    schema=SCORED_ARROW,
                )
                row_id += b - a

    scored = stored(rows.mapInArrow(run, SCORED), "scored")
    pairs = scored.select("row_id", F.explode(F.arrays_zip("rare", "times")).alias("w")).select(
        "row_id", F.col("w.rare").alias("key"), F.col("w.times").alias("times")
    )
    words = counts.where(F.col("kind") == WORD).select("key", "n")
    rest = (
        pairs.join(words, "key", "left").groupBy("row_id").agg(
            F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more"),
            F.sum(F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + ALPHA) / F.lit(below))).alias("rest"),
        )
    )
    return scored.join(rest, "row_id", "left").select(
        F.col("key").alias(key), "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"),
        F.lit(int(n_all)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), "score",
    )


@query("op9_attention_lm")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
