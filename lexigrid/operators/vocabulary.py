"""The term dictionary of a saved index, and the terms that prefixes, patterns and spellings mean.

The dictionary has one row a distinct term, with its document frequency and its bucket of the
postings.  Beside it stands a table of candidate keys.  A spelling within two edits shares a
deletion key with the term: what is left of the first letters when at most two are taken
away.  These stand once for all terms of the same first letters.  A pattern shares with its terms all character trigrams of its fixed parts.  The
dictionary is sorted by term, deletion keys stand in folders by their hash, and trigrams in
sorted files, so a look-up reads little of them.
"""

from __future__ import annotations

import functools
import itertools
import operator
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DELETIONS = 2
FIRST_LETTERS = 6
GRAM = 3
EDGE = "\x02"  # marks the beginning and the end of a term in its trigrams
ROWS_PER_FILE = 1_000_000
TERMS_PER_TASK = 200_000


def sorted_files(rows: DataFrame, by: list[str], count: int, path: str) -> None:
    files = max(1, -(-count // ROWS_PER_FILE))
    rows.repartitionByRange(files, *by).sortWithinPartitions(*by).write.mode("errorifexists").parquet(path)


def write_terms(postings: DataFrame, path: str) -> None:
    """(field, term, df, cf, bucket) of every distinct term, in the order of terms."""
    terms = postings.groupBy("field", "term", "bucket").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf")
    )
    sorted_files(terms, ["field", "term"], postings.agg(F.approx_count_distinct("term")).first()[0], path)


def first_letters(term: Column) -> Column:
    return F.substring(term, 1, FIRST_LETTERS)


def deletion_keys(term: Column) -> Column:
    """What is left of the first letters when up to ``DELETIONS`` of them are taken away.

    A fold takes away one letter more of each key; within two edits, swaps of neighbours
    included, two words have a key in common.
    """
    head = first_letters(term)

    def shorter(keys: Column, _: Column) -> Column:
        def without(key: Column) -> Column:
            places = F.when(F.length(key) > 0, F.sequence(F.lit(1), F.length(key))).otherwise(F.array().cast("array<int>"))
            return F.transform(places, lambda i: F.concat(F.substr(key, F.lit(1), i - 1), F.substr(key, i + 1)))

        return F.array_union(keys, F.flatten(F.transform(keys, without)))

    return F.aggregate(F.sequence(F.lit(1), F.lit(DELETIONS)), F.array(head), shorter)


def deletions(word: str) -> list[str]:
    """The deletion keys of one word."""
    head = word[:FIRST_LETTERS]
    kept = (
        "".join(head[i] for i in places)
        for gone in range(min(DELETIONS, len(head)) + 1)
        for places in itertools.combinations(range(len(head)), len(head) - gone)
    )
    return sorted(set(kept))


def gram_keys(term: Column) -> Column:
    marked = F.concat(F.lit(EDGE), term, F.lit(EDGE))
    return F.array_distinct(
        F.transform(
            F.sequence(F.lit(1), F.length(term)), lambda i: F.substr(marked, i, F.lit(GRAM))
        )
    )


def write_keys(terms: DataFrame, path: str) -> None:
    """(kind, key, field, term): trigrams (``g``) of all terms, and deletion keys (``d``) of the
    first letters of all terms, which then stand in the place of the term."""
    n_terms = terms.count()
    grams = terms.repartition(-(-n_terms // TERMS_PER_TASK) or 1, "term").select(
        F.explode_outer(gram_keys(F.col("term"))).alias("key"), "field", "term", "bucket", "df"
    )
    # a gram's rows stay where its terms are: each file is sorted, so a look-up skips most of it
    grams.sortWithinPartitions("key").withColumn("slots", F.lit(1)).withColumn("slot", F.lit(0)).write.mode(
        "errorifexists"
    ).partitionBy("slots", "slot").parquet(f"{path}/kind=g")
    heads = terms.select("field", first_letters(F.col("term")).alias("term")).distinct()
    n_heads = terms.agg(F.approx_count_distinct(F.struct("field", first_letters(F.col("term"))))).first()[0]
    slots = 1 + 20 * n_heads // ROWS_PER_FILE  # about twenty keys a head
    slot = F.pmod(F.xxhash64("key"), F.lit(slots)).cast("int")
    none = F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("bigint").alias("df")
    (
        heads.select(F.explode_outer(deletion_keys(F.col("term"))).alias("key"), "field", "term")
        .repartitionById(slots, slot).sortWithinPartitions("key")
        .select("*", *none, F.lit(slots).alias("slots"), slot.alias("slot"))
        .write.mode("errorifexists").partitionBy("slots", "slot").parquet(f"{path}/kind=d")
    )


def with_keys(keys: DataFrame, kind: str, values: list[str]) -> DataFrame:
    """The rows of some keys, from their folders; equalities reach the scan one by one."""
    keys = keys.where(F.col("kind") == kind)
    one = keys.select("slots").first()
    slots = [F.pmod(F.xxhash64(F.lit(v)), F.lit(one.slots if one else 1)).cast("int") for v in values]
    equal = functools.reduce(operator.or_, [F.col("key") == v for v in values])
    return keys.where(F.col("slot").isin(*slots) & equal)


def near_terms(keys: DataFrame, terms: DataFrame, word: str) -> DataFrame:
    """(field, term, bucket, df) of all terms that may be within ``DELETIONS`` edits of a word."""
    heads = with_keys(keys, "d", deletions(word)).select("field", F.col("term").alias("head")).distinct()
    lettered = terms.withColumn("head", first_letters(F.col("term")))
    return lettered.join(heads, ["field", "head"], "left_semi").select("field", "term", "bucket", "df")


def fixed_grams(parts: list[str]) -> list[str]:
    """Trigrams that every term of a pattern has; the parts stand between its wildcards."""
    grams = set()
    for number, part in enumerate(parts):
        text = (EDGE if number == 0 else "") + part + (EDGE if number == len(parts) - 1 else "")
        grams |= {text[i : i + GRAM] for i in range(len(text) - GRAM + 1)}
    return sorted(grams)


def holding_grams(keys: DataFrame, grams: list[str]) -> DataFrame:
    """(field, term, bucket, df) of all terms that hold all of the trigrams."""
    found = with_keys(keys, "g", grams)
    return (
        found.groupBy("field", "term", "bucket", "df").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") == len(grams)).drop("n")
    )


def wildcard_parts(pattern: str) -> list[str]:
    return re.split(r"[*?]+", pattern.lower())


def completions(terms: DataFrame, prefixes: DataFrame, k: int) -> DataFrame:
    """(prefix, term, df, rank): the k most frequent terms of each asked prefix, ties by term.

    Terms meet prefixes by equality: a term gives its beginnings of the lengths that are asked.
    """
    asked = prefixes.select("prefix").where(F.length("prefix") > 0).distinct()
    # as many as the longest prefix has letters at most
    lengths = sorted(r.n for r in asked.select(F.length("prefix").alias("n")).distinct().collect())
    starts = F.array_compact(
        F.array(*[F.when(F.length("term") >= n, F.substring("term", 1, n)) for n in lengths])
    ).cast("array<string>")
    distinct = terms.groupBy("term").agg(F.sum("df").alias("df"))
    fitting = distinct.select("term", "df", F.explode(starts).alias("prefix")).join(asked, "prefix")
    order = Window.partitionBy("prefix").orderBy(F.desc("df"), F.asc("term"))
    return fitting.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
