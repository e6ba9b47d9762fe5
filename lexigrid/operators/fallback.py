"""Fallback search for a table of queries: phrase, all words, any word, near spellings.

Queries are rows, and strategies are rounds that only unanswered queries go on to.  The plan
of a round does not depend on how many queries there are, and a round is not run when none is
left.  A hit is scored when its query's strategy is known.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.operators import vocabulary as vc
from lexigrid.operators.postings import Corpus
from lexigrid.operators.ranking import bm25_weight, idf
from lexigrid.session import stored

SCHEMA = "query_id string, strategy string, key {key}, score double"


def query_words(queries: DataFrame, corpus: Corpus) -> DataFrame:
    """(query_id, term, at): the distinct words of each query and where they stand in it."""
    slots = queries.select("query_id", F.posexplode(corpus.analyzer.slots(F.col("text"))).alias("at", "term"))
    return slots.where(F.col("term").isNotNull()).groupBy("query_id", "term").agg(F.sort_array(F.collect_list("at")).alias("at"))


def phrase_frequency(words: Column) -> Column:
    """How often words (at, positions) stand in a text as they stand in the query."""
    starts = F.flatten(
        F.transform(
            words,
            lambda w: F.transform(w["at"], lambda a: F.transform(w["positions"], lambda p: p - a)),
        )
    )
    return F.size(F.aggregate(F.slice(starts, 2, F.size(starts)), starts[0], F.array_intersect))


def all_words(words: DataFrame, postings: DataFrame) -> DataFrame:
    """(query_id, key, words) of the documents that hold all words of a query.

    The rarest word of a query proposes documents, and its other words are looked up in them.
    """
    rarest = words.groupBy("query_id").agg(
        F.min(F.struct("df", "term")).alias("rarest"), F.count(F.lit(1)).alias("n"),
        F.collect_list(F.struct("term", "idf", "at")).alias("words"),
    )
    proposed = rarest.where("rarest.df > 0").select("query_id", "n", "words", F.col("rarest.term").alias("term")).join(
        postings.select("term", "key"), "term"
    )
    looked_up = proposed.select("query_id", "n", "key", F.inline("words")).join(postings, ["key", "term"])
    held = looked_up.groupBy("query_id", "key", "n").agg(
        F.collect_list(F.struct("at", "positions", "tf", "idf")).alias("words"), F.max("dl").alias("dl")
    )
    return held.where(F.size("words") == F.col("n")).select("query_id", "key", "words", "dl")


def fallback_search(corpus: Corpus, queries: DataFrame, field: str, distance: int = 2) -> DataFrame:
    """(query_id, strategy, key, score): hits of the first strategy that finds anything.

    ``queries`` is (query_id, text); a query without words finds nothing.  Strategies are
    ``phrase``, ``and``, ``or`` and ``fuzzy``, up to ``distance`` edits a word.  The corpus is a
    saved index.  Phrases score by the phrase's frequency, words add up, near spellings score 1
    for each word of the query.
    """
    spark = queries.sparkSession
    total, mean = corpus.stats(field)
    here = F.col("field") == field
    terms = corpus.terms.where(here).select("term", "df", "bucket")
    words = query_words(queries.select(F.col("query_id").cast("string").alias("query_id"), "text"), corpus)
    words = words.join(terms, "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    words = words.withColumn("idf", idf(total, F.col("df")))
    words = stored(words, "query-words")
    wanted = words.where("df > 0").select("bucket", "term").distinct()
    postings = corpus.occurrences.where(here).join(wanted, ["bucket", "term"], "left_semi")
    postings = postings.select("key", "term", "tf", "positions", "dl")

    full = all_words(words, postings).withColumn("phrase", phrase_frequency(F.col("words")))
    full = stored(full, "all-words")
    first = full.groupBy("query_id").agg(F.max(F.col("phrase") > 0).alias("as_phrase"))
    rarity = F.aggregate("words", F.lit(0.0), lambda s, w: s + F.size(w["at"]) * w["idf"])
    added = F.aggregate(
        "words", F.lit(0.0), lambda s, w: s + w["idf"] * bm25_weight(w["tf"], F.col("dl"), F.col("mean"))
    )
    rounds = [
        full.withColumn("mean", mean).join(first, "query_id").where(~F.col("as_phrase") | (F.col("phrase") > 0)).select(
            "query_id", F.when(F.col("as_phrase"), "phrase").otherwise("and").alias("strategy"), "key",
            F.when(F.col("as_phrase"), rarity * bm25_weight(F.col("phrase"), F.col("dl"), F.col("mean"))).otherwise(added).alias("score"),
        )
    ]
    left = stored(words.join(first, "query_id", "left_anti"), "unanswered")

    if not left.isEmpty():
        weight = F.col("idf") * bm25_weight(F.col("tf"), F.col("dl"), mean)
        some = left.join(postings, "term").groupBy("query_id", "key").agg(F.sum(weight).alias("score"))
        some = stored(some.select("query_id", F.lit("or").alias("strategy"), "key", "score"), "any-word")
        rounds.append(some)
        left = stored(left.join(some.select("query_id").distinct(), "query_id", "left_anti"), "unanswered")

    if not left.isEmpty():
        rounds.append(near_spellings(corpus, left.select("query_id", "term"), field, distance))
    found = functools.reduce(DataFrame.unionByName, rounds)
    key = dict(found.dtypes)["key"]
    return spark.createDataFrame([], SCHEMA.format(key=key)).unionByName(found)


def near_spellings(corpus: Corpus, words: DataFrame, field: str, distance: int) -> DataFrame:
    """Hits by words of the dictionary within some edits of a query's words.

    Words meet terms by a deletion key of both, and the pairs are tested once a word.
    """
    if distance > vc.DELETIONS:
        raise ValueError(f"spellings are kept for up to {vc.DELETIONS} edits")
    here = F.col("field") == field
    asked = words.select(F.col("term").alias("word")).distinct()
    asked = asked.select("word", F.explode(vc.deletion_keys(F.col("word"))).alias("key"))
    keys = corpus.keys.where(here & (F.col("kind") == "d")).select("key", F.col("term").alias("head"))
    heads = asked.join(keys, "key").select("word", "head").distinct()
    terms = corpus.terms.where(here).select("term", "bucket", vc.first_letters(F.col("term")).alias("head"))
    near = heads.join(terms, "head").select("word", "term", "bucket")
    near = stored(near.where(F.levenshtein("word", "term", distance) >= 0), "near-terms")
    postings = corpus.occurrences.where(here).select("bucket", "term", "key")
    hits = words.withColumnRenamed("term", "word").join(near, "word").join(postings, ["bucket", "term"])
    return hits.groupBy("query_id", "key").agg(F.count_distinct("word").cast("double").alias("score")).select(
        "query_id", F.lit("fuzzy").alias("strategy"), "key", "score"
    )
