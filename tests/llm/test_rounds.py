"""Rounds over few links take few tasks; windows of words are hashed without interpreted functions."""

import random

import pytest
from pyspark.sql import functions as F

from lexigrid.llm import components as stars
from lexigrid.llm.decontaminate import with_windows


def roots_of(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in links:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("most", [1 << 17, 7])
def test_few_links_take_few_tasks(spark, monkeypatch, most):
    seen = []

    def stored(df, purpose, store=stars.stored):
        seen.append(df.rdd.getNumPartitions())
        return store(df, purpose)

    monkeypatch.setattr(stars, "LINKS", most)
    monkeypatch.setattr(stars, "stored", stored)
    draw = random.Random(5)
    links = [(draw.randrange(-20, 20), draw.randrange(-20, 20)) for _ in range(18)] + [(100 + k, 101 + k) for k in range(9)]
    links = [x for x in links if x[0] != x[1]]
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(held, ("40", "false")):
            spark.conf.set(k, v)
        found = stars.components(spark.createDataFrame(links + links[:3], "u long, v long")).collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert dict(map(tuple, found)) == roots_of(links) and len(found) == len(roots_of(links))
    assert max(seen[1:]) <= -(-len(links) // most)


@pytest.mark.parametrize("widths", [[8], [2, 3, 5]])
def test_windows_are_hashed_in_compiled_code(spark, widths):
    draw = random.Random(3)
    texts = [[draw.choice("ab") for _ in range(n)] for n in (0, 1, 4, 8, 40)]
    rows = [(k, named, words) for k, words in enumerate(texts) for named in (True, False)]
    df = spark.createDataFrame(rows, "k long, named boolean, words array<string>")
    got = with_windows(df, ["k", "named"], "at", widths)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
    hashes = {}
    for k, named, at, width, window in got.select("k", "named", "at", "width", F.col("window")).collect():
        hashes.setdefault((named, tuple(texts[k][at : at + width])), []).append((k, at, width, window))
    want = {}
    for k, named, words in rows:
        for width in widths:
            for at in range(len(words) - width + 1):
                want.setdefault((named, tuple(words[at : at + width])), set()).add((k, at, width))
    assert {x: {y[:3] for y in rows} for x, rows in hashes.items()} == want
    assert len({y[3] for rows in hashes.values() for y in rows}) == len(want)
