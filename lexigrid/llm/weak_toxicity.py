"""Toxicity by weak supervision.

Many voters (mined lexicons, prefixes, a seed list, patterns, absences and the human label)
vote on a bounded set of labelled texts.  A generative label model estimates by expectation
maximisation how often each voter fires under either class, and how far voters that move
together repeat one another; its posterior labels train a linear classifier over words and
word beginnings.  Scoring reads every whole text once, with a model of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.llm.registry import query, set_aside, table
from lexigrid.session import stored

WORD = re.compile(r"[^\W_]+")
# A seed list of insults.
SEEDS = frozenset(
    "idiot idiots moron morons stupid scum loser losers trash pathetic worthless disgusting clown dumb "
    "imbecile filth vermin degenerate dummkopf abschaum idiota estúpido basura escoria connard crétin".split()
)
PATTERNS = (
    re.compile(r"\b(?:shut up|go to hell|i hate you|you people|kill yourself|drop dead)\b"),
    re.compile(r"\b\w*[a-z][@$*!]+[a-z]\w*\b"),
)


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled texts that are learned from (those with the smallest
    hashes), ``features`` the size of the model.  A mined word is in ``support`` texts or more,
    has log odds of at least ``odds``, and of ``evidence`` times their standard error.
    """

    sample_rows: int = 20_000
    features: int = 3000
    support: int = 4
    evidence: float = 2.8
    odds: float = 3.0
    groups: int = 12
    threshold: float = 0.3


def keys_of(text: str) -> set[str]:
    """Distinct words, and the first four and five letters of longer ones (marked)."""
    words = set(WORD.findall(text.lower()))
    return words | {"^" + w[:4] for w in words if len(w) > 5} | {"^" + w[:5] for w in words if len(w) > 6}


def pattern_hits(text: str) -> int:
    low = text.lower()
    return sum(1 << k for k, p in enumerate(PATTERNS) if p.search(low))


def opening(text: str) -> int:
    """The smallest hash of five-word runs: near copies mostly share it and count once."""
    from lexigrid.llm.textbatch import Words, windows

    data = np.frombuffer(text.encode(), np.uint8)
    w = windows(Words(data, np.array([0, len(data)])).hashes, 5)
    return int(w.min().view(np.int64)) if len(w) else 0


def may_learn(key: str):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 != 2, F.lit(True))


def labelled_texts(docs: DataFrame, labels: DataFrame, key: str, text: str, settings: Settings) -> DataFrame:
    """(toxic, text) of a bounded set of labelled rows outside the held-out quarter, stored."""
    usable = labels.where(F.col(key).isNotNull() & F.col("toxic").isNotNull() & may_learn(key))
    n_labels = max(1, usable.count())
    # about twice the bound come by hash, so that no task hands the driver more than its share
    drawn = F.pmod(F.xxhash64(key), F.lit(n_labels)) < 2 * settings.sample_rows
    chosen = (
        usable.where(drawn)
        .groupBy(key).agg(F.max(F.col("toxic").cast("int")).alias("toxic_"))
        .orderBy(F.xxhash64(key), key).limit(settings.sample_rows)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts), pa.array([opening(t) for t in texts], pa.int64())],
                names=["toxic", "text", "opening"],
            )

    joined = docs.select(key, F.col(text).alias("text_")).join(F.broadcast(chosen), key).select("toxic_", "text_")
    found = joined.mapInArrow(run, "toxic int, text string, opening long")
    return stored(found.dropDuplicates(["opening", "toxic"]).drop("opening"), "toxicity-sample")


def mine(sample: DataFrame, settings: Settings) -> tuple[list[tuple[str, float]], int, int]:
    """Words and beginnings that are much likelier in toxic texts, with their log odds."""
    n_toxic, n_clean = sample.agg(
        F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))
    ).first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys = sorted(keys_of(text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), pa.array([toxic] * len(keys), pa.int32())], names=["term", "toxic"]
                )

    odds = F.log((F.col("a") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("b") + 0.5) / (n_clean + 1.0))
    error = F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    rows = (
        sample.select("toxic", "text").mapInArrow(run, "term string, toxic int")
        .groupBy("term").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
        .where(F.col("a") + F.col("b") >= settings.support)
        .select("term", odds.alias("odds"), (F.abs(odds) / error).alias("z"))
        .where((F.col("z") >= settings.evidence) & (F.col("odds") >= settings.odds))
        .orderBy(F.desc("z"), "term").limit(settings.features).collect()
    )
    return [(r.term, r.odds) for r in rows], n_toxic, n_clean


def hit_lists(sample: DataFrame, terms: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Per labelled text the numbers of its terms, its pattern bits and its label."""
    number = {t: k for k, t in enumerate(terms)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            hits = [sorted(number[k] for k in keys_of(t) if k in number) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hits, pa.list_(pa.int32())),
                    pa.array([pattern_hits(t) for t in texts], pa.int32()),
                    batch.column(0),
                    pa.array([bool(SEEDS & set(WORD.findall(t.lower()))) for t in texts], pa.bool_()),
                ],
                names=["hits", "patterns", "toxic", "seed"],
            )

    rows = sample.select("toxic", "text").mapInArrow(run, "hits array<int>, patterns int, toxic int, seed boolean")
    rows = sorted(rows.collect(), key=lambda r: (r.toxic, r.patterns, r.hits))  # at most sample_rows
    return (
        [np.array(r.hits, np.int64) for r in rows],
        np.array([(r.patterns << 1) + r.seed for r in rows], np.int64),
        np.array([r.toxic for r in rows], np.int64),
    )


def vote(hits: list[np.ndarray], bits: np.ndarray, labels: np.ndarray, odds: np.ndarray, groups: int) -> np.ndarray:
    """Votes (rows x voters): 1 toxic, 0 clean, -1 none.

    Toxic terms are dealt to lexicon voters and beginnings' voters by rank; for each lexicon
    there is also a voter of its absence.  Then come the seed list, the patterns and the label.
    """
    n = len(hits)
    toxic_rank = np.full(len(odds), -1)
    order = np.flatnonzero(odds > 0)
    toxic_rank[order] = np.arange(len(order)) % groups
    fired = np.zeros((n, groups), bool)
    for row, h in enumerate(hits):
        g = toxic_rank[h]
        fired[row, g[g >= 0]] = True
    lexicons = np.where(fired, 1, -1)
    halves = [np.where(fired[:, k::3].any(axis=1), -1, 0) for k in range(3)]
    more = [np.where(bits & 1, 1, -1)] + [np.where(bits >> (k + 1) & 1, 1, -1) for k in range(len(PATTERNS))]
    return np.column_stack([lexicons, *halves, *more, labels])


def label_model(votes: np.ndarray, rounds: int = 50, apart: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of the toxic class for each row, and each voter's rates and weight.

    Rates are P(vote | class), with abstaining as a vote, estimated by expectation
    maximisation from the votes' majority.  A voter's evidence is divided by one plus its
    correlations, within the classes, with the others that agree with it: voters that repeat
    one another count as little more than one.  The last ``apart`` voters do not read the text
    and are taken as independent of the others.
    """
    n, m = votes.shape
    shown = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    posterior = np.clip((votes == 1).sum(1) - (votes == 0).sum(1), -2, 2) / 8 + 0.5
    signed = np.where(votes == 1, 1.0, np.where(votes == 0, -1.0, 0.0))
    for _ in range(rounds):
        both = np.stack([1 - posterior, posterior], axis=1)
        prior = (both.sum(0) + 1) / (n + 2)
        rates = (np.einsum("nc,nmv->cmv", both, shown) + 0.1) / (both.sum(0)[:, None, None] + 0.3)
        evidence = np.einsum("nmv,mv->nm", shown, np.log(rates[1] / rates[0]))
        spread = np.zeros((m, m))
        for c in range(2):
            mean = signed.T @ both[:, c] / both[:, c].sum()
            centred = (signed - mean) * np.sqrt(both[:, c])[:, None]
            spread += centred.T @ centred
        scale = np.sqrt(np.maximum(np.diag(spread), 1e-9))
        related = np.abs(spread / np.outer(scale, scale))
        np.fill_diagonal(related, 0)
        related[m - apart :] = related[:, m - apart :] = 0
        weight = 1 / (1 + np.where(related > 0.2, related, 0).sum(1))
        logit = np.log(prior[1] / prior[0]) + evidence @ weight
        posterior = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return posterior, rates, weight


def fit_linear(hits: list[np.ndarray], posterior: np.ndarray, n_terms: int, steps: int = 400) -> np.ndarray:
    """Weights of a logistic regression on soft labels; the last one is the constant."""
    flat = np.concatenate([*hits, np.zeros(0, np.int64)]).astype(np.int64)
    rows = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    w, m, v = np.zeros(n_terms + 1), np.zeros(n_terms + 1), np.zeros(n_terms + 1)
    w[-1] = -2.0
    for step in range(1, steps + 1):
        z = w[-1] + np.bincount(rows, w[flat], minlength=len(hits))
        gap = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - posterior
        grad = np.append(np.bincount(flat, gap[rows], minlength=n_terms), gap.sum()) / len(hits)
        grad[:-1] += 1e-5 * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, settings: Settings) -> tuple[dict[str, float], float]:
    """Weights by term and the constant.  With no labels of both classes, the seed list alone."""
    sample = labelled_texts(docs, labels, key, text, settings)
    mined, n_toxic, n_clean = mine(sample, settings)
    if not n_toxic or not n_clean:
        return dict.fromkeys(sorted(SEEDS), 4.0), -3.0
    terms, odds = [t for t, _ in mined], np.array([o for _, o in mined])
    hits, bits, gold = hit_lists(sample, terms)
    posterior, _, _ = label_model(vote(hits, bits, gold, odds, settings.groups), apart=1)
    weights = fit_linear(hits, posterior, len(terms))
    return dict(zip(terms, weights[:-1].tolist())), float(weights[-1])


def score_toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``; labels only ever train.

    A null or empty text has the score of a text without any known term.  Several labels of a
    document count as the highest.  Repeated rows get equal scores; other columns pass
    through, whatever their names (``set_aside``); an empty table stays empty.
    """
    return set_aside(docs, (key, text), lambda d: _score_toxicity(d, labels, key, text, settings))


def _score_toxicity(
    docs: DataFrame, labels: DataFrame, key: str, text: str, settings: Settings
) -> DataFrame:
    weights, constant = train(docs, labels, key, text, settings)
    known = frozenset(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for value in batch.column(batch.schema.get_field_index("text_")):
                keys = keys_of(value.as_py() or "") & known
                z = constant + sum(weights[k] for k in sorted(keys))
                scores.append(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))
            at = batch.schema.get_field_index("text_")
            columns = [c for k, c in enumerate(batch.columns) if k != at]
            names = [n for k, n in enumerate(batch.schema.names) if k != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], names=[*names, "score"])

    kept = [c for c in docs.columns if c not in ("score", "predicted", "text_")]
    frame = docs.select(*kept, F.col(text).alias("text_"))
    schema = docs.select(*kept).schema.add("score", "double")
    return frame.mapInArrow(run, schema).withColumn(
        "predicted", (F.col("score") >= settings.threshold).cast("int")
    )


@query("op10_weak_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")
