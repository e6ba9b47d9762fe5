"""The language model's graphs against its numpy statement, and texts taken apart once."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lexigrid.llm import attention_lm, subwords
from lexigrid.llm.textbatch import Words

PATH = public_tokenizers.path("word_bpe_49k.json")


def some_classes(seed):
    return attention_lm.Classes.of(np.random.default_rng(seed).integers(0, 50, attention_lm.VOCABULARY))


@pytest.mark.parametrize("n", [1, 7, 256])
def test_graph_gives_the_gradient(n):
    rng = np.random.default_rng(n)
    flat = attention_lm.fresh(some_classes(1)) * 4
    x = rng.integers(0, attention_lm.INPUTS, (n, 2 * attention_lm.STEP))
    y = rng.integers(0, attention_lm.OUTPUTS, (n, attention_lm.STEP))
    mask = (rng.random(y.shape) * (rng.random(y.shape) < 0.8) * 3).astype(np.float32)
    want, _ = attention_lm.gradients(flat.astype(np.float64), x[:, :-1], y, mask.astype(np.float64))
    for _ in range(2):  # the second call finds its buffers as the first one left them
        got = attention_lm.fast_gradients(flat, x, y, mask)
        for name, part in attention_lm.unpack(got).items():
            right = attention_lm.unpack(want)[name]
            assert np.abs(part - right).max() < 1e-5 * np.abs(right).max(), name


def test_scores_are_the_same_without_the_runtime(monkeypatch):
    rng = np.random.default_rng(3)
    classes = some_classes(2)
    flat = attention_lm.fresh(classes) * 5
    texts = [rng.integers(0, attention_lm.VOCABULARY, n).astype("<u2") for n in (0, 1, 16, 33, 9000)]
    model = attention_lm.Model(flat, classes)
    fast, end = model.log_probabilities(texts), attention_lm.descend(flat, texts, classes, attention_lm.Settings(), 1)
    monkeypatch.setattr(attention_lm, "graph", lambda name: None)
    assert model.log_probabilities(texts) == pytest.approx(fast, rel=1e-6)
    slow = attention_lm.descend(flat, texts, classes, attention_lm.Settings(), 1)
    assert slow == pytest.approx(end, rel=1e-3, abs=1e-3) and not np.allclose(flat, end, atol=1e-3)


def test_counts_and_runs_come_from_one_reading(spark):
    texts = ["one two two", None, "", " ".join(f"w{k % 70}" for k in range(200)), "one two two"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    read = attention_lm.read_texts(rows, PATH, attention_lm.Settings()).collect()
    known = subwords.subword_ids(PATH)
    want = Counter()
    for t in texts:
        want.update(known.encode(t or "").tolist() + [attention_lm.END])
    ids, runs = Counter(), Counter()
    for r in read:
        if r.kind == attention_lm.SUBWORD:
            ids[r.key] += r.n
        if r.kind == attention_lm.RUN:
            runs.update(np.frombuffer(r.ids, "<u2").tolist() * r.n)
    assert ids == want == runs
    assert sum(r.n for r in read if r.kind == attention_lm.WORD) == 206
    assert sum(r.n for r in read if r.kind == attention_lm.TEXT_END) == 5
    counted = spark.createDataFrame([(r.ids, r.n) for r in read if r.kind == attention_lm.RUN], "ids binary, n long")
    plain = attention_lm.training_runs(rows, PATH, attention_lm.Settings())
    dealt = [attention_lm.deal(r.groupBy("ids").agg(F.count("*").alias("n")) if r is plain else r, attention_lm.Settings()) for r in (plain, counted)]
    weights = [sum(r.weight for r in d.collect()) for d, _ in dealt]
    assert weights[0] == weights[1] == 8


def test_places_of_hashes_that_share_a_slot():
    rng = np.random.default_rng(5)
    hashes = np.unique(np.append(rng.integers(0, 1 << 62, 500), np.arange(300) << 40)).astype(np.uint64)
    some = np.concatenate([hashes, rng.integers(0, 1 << 62, 900).astype(np.uint64), (np.arange(300, 400) << 40).astype(np.uint64)])
    got = attention_lm.Places(hashes).of(some)
    assert got.tolist() == [*range(len(hashes)), *[-1] * 1000]
    assert attention_lm.Places(hashes[:0]).of(some).max() == -1


def test_words_of_one_slot_keep_their_ids(monkeypatch):
    monkeypatch.setattr(subwords, "SLOTS", 4)
    text = " ".join(f"word{k % 37} of{k % 5}" for k in range(400))
    whole = subwords.SubwordIds(PATH).whole(text)
    for most in (3_000_000, 10):  # few words are remembered: all are forgotten time and again
        known = subwords.SubwordIds(PATH, most)
        for _ in range(3):
            assert known.encode(text).tolist() == whole.tolist()
        parts = text.encode().split(b" ")
        for k in range(0, 800, 80):
            part = b" ".join(parts[k : k + 80])
            found = known.encode_words(Words(np.frombuffer(part, np.uint8), np.array([0, len(part)])))
            assert found[0].tolist() == known.whole(part.decode()).tolist()
