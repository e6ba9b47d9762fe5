"""Stored queries against arriving documents."""

import random

import pytest
from pyspark.sql import functions as F

from lexigrid.session import shared_folder
from lexigrid.streaming import jobs


@pytest.fixture(scope="module")
def parts(spark):
    """Documents of which all hold ``the`` and a third ``common``, rules, and frequencies."""
    draw = random.Random(2)
    words = [f"w{k}" for k in range(30)]
    texts = [
        " ".join(["the"] + ["common"] * (k % 3 == 0) + draw.choices(words, k=8)) for k in range(600)
    ] + ["", None, "the the the", "W1 w2, The common!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    queries = [(100 + k, " ".join(draw.sample(words, draw.randint(1, 3)))) for k in range(40)]
    queries += [(0, "the"), (1, "common the"), (2, "common w1"), (3, "nowhere the"), (4, ""), (5, None), (6, "the"), (7, "The w3 THE")]
    rules = jobs.alert_rules(spark.createDataFrame(queries, "query_id long, text string"))
    df = jobs.document_terms(docs, "id", "text").groupBy("term").agg(F.count("*").alias("df"))
    expected = {
        (q, k)
        for q, query in queries
        for k, text in enumerate(texts)
        if query and set(query.lower().split()) <= set((text or "").lower().replace(",", "").replace("!", "").split())
    }
    return docs, rules, df, expected


def test_rarest_terms_lead_and_hot_leads_are_salted(parts):
    _, rules, df, _ = parts
    found = {r.query_id: (r.term, r.salts) for r in jobs.leads(rules, df, rows_per_task=100).collect()}
    held = {r.term: r.df for r in df.collect()}
    for query, terms in ((1, ["common", "the"]), (2, ["common", "w1"]), (3, ["nowhere", "the"]), (7, ["the", "w3"])):
        assert found[query][0] == min(terms, key=lambda t: held.get(t, 0))
    # two rules on a word of every document: the pairs of both over the rows of a task
    assert found[0] == found[6] == ("the", -(-2 * held["the"] // 100))
    assert found[3] == ("nowhere", 1) and 4 not in found and 5 not in found


@pytest.mark.parametrize("rows_per_task", [50, 20_000])
def test_alerts_against_brute_force(parts, rows_per_task):
    docs, rules, df, expected = parts
    terms = jobs.document_terms(docs, "id", "text")
    found = jobs.match_alerts(terms, rules, jobs.leads(rules, df, rows_per_task))
    rows = [(r.query_id, r.key) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == expected


def test_no_row_carries_the_words_of_a_document(parts):
    docs, rules, df, _ = parts
    found = jobs.match_alerts(jobs.document_terms(docs, "id", "text"), rules, jobs.leads(rules, df))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "array_except" not in plan and "collect" not in plan


def test_streamed_alerts(parts, spark):
    docs, rules, df, expected = parts
    source, root = shared_folder(spark, "alert-docs"), shared_folder(spark, "alerts")
    docs.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(source)
    jobs.stream_alerts(stream, rules, jobs.leads(rules, df), "id", "text", root).awaitTermination()
    found = spark.read.parquet(f"{root}/alerts")
    assert found.select("batch").distinct().count() > 1
    assert {(r.query_id, r.key) for r in found.collect()} == expected
