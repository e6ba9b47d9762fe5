"""Highlights and snippets."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Blanks at either end of a text.
EDGE_BLANKS = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


def squeeze(text: Column) -> Column:
    """Text without blanks of any kind at its ends."""
    return F.regexp_replace(text, EDGE_BLANKS, "")


def first_position(text: Column, terms: list[str], start: Column | int = 1) -> Column:
    """Earliest 1-based position of any term from ``start`` on; null if there is none."""
    begin = start if isinstance(start, Column) else F.lit(start)
    found = [F.nullif(F.position(F.lit(t.lower()), text, begin), F.lit(0)) for t in terms]
    return F.least(*found) if len(found) > 1 else found[0]


def tag(passage: Column, terms: list[str], before: str = "<mark>", after: str = "</mark>") -> Column:
    """Every term wrapped in tags, in any case.  One alternation, so tags never nest."""
    longest_first = sorted({t.lower() for t in terms}, key=lambda t: (-len(t), t))
    pattern = "(?iu)(" + "|".join(re.escape(t) for t in longest_first) + ")"
    return F.regexp_replace(passage, pattern, f"{before}$1{after}")


def highlight(
    docs: DataFrame,
    text: str,
    terms: list[str],
    max_highlights: int = 5,
    context: int = 50,
    tags: tuple[str, str] = ("<mark>", "</mark>"),
) -> DataFrame:
    """Adds ``highlights``: distinct tagged passages around the earliest term positions.

    Each position is a column of its own step, so a step is worked out once.
    """
    rows = docs.withColumn("_low", F.lower(text))
    names = [f"_at{i}" for i in range(max_highlights)]
    for i, name in enumerate(names):
        start = F.lit(1) if i == 0 else F.col(names[i - 1]) + 1
        rows = rows.withColumn(name, first_position(F.col("_low"), terms, start))
    passages = []
    for name in names:
        begin = F.greatest(F.col(name) - 1 - context, F.lit(0))
        end = F.least(F.col(name) - 1 + context, F.length(text))
        passage = F.substring(F.col(text), begin + 1, end - begin)
        passages.append(F.when(F.col(name).isNotNull(), tag(passage, terms, *tags)))
    return rows.withColumn(
        "highlights", F.array_distinct(F.array_compact(F.array(*passages)))
    ).drop("_low", *names)


def snippet(text: Column, terms: list[str], length: int = 200) -> Column:
    """The whole text if short, else a window around the first term without cut words."""
    best = F.coalesce(first_position(F.lower(text), terms) - 1, F.lit(0))
    start = F.greatest(best - length // 2, F.lit(0))
    window = squeeze(F.substring(text, start + 1, F.lit(length)))
    whole_words = F.regexp_replace(F.regexp_replace(window, r"^\S*\s+", ""), r"\s+\S*$", "")
    cut = F.concat(
        F.when(start > 0, "...").otherwise(""),
        whole_words,
        F.when(start + length < F.length(text), "...").otherwise(""),
    )
    return F.when(F.length(text) <= length, text).otherwise(cut)


def term_positions(docs: DataFrame, key: str, text: str, terms: list[str]) -> DataFrame:
    """(key, term, start, end) of every occurrence, 0-based, end exclusive.

    Splitting at the term leaves the gaps; running lengths of the gaps are the positions.
    The window holds one document's gaps.
    """
    gaps = docs.select(
        F.col(key).alias("key"),
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(t.lower()).alias("term"),
                        F.split(F.lower(text), "\\Q" + t.lower() + "\\E", -1).alias("gaps"),
                    )
                    for t in dict.fromkeys(terms)
                ]
            )
        ).alias("s"),
    )
    pieces = gaps.where(F.size("s.gaps") > 1).select(
        "key", "s.term", F.size("s.gaps").alias("n"), F.posexplode("s.gaps").alias("i", "gap")
    )
    upto = Window.partitionBy("key", "term").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("term")
    start = F.sum(F.length("gap")).over(upto) + F.col("i") * size
    return (
        pieces.withColumn("start", start)
        .where(F.col("i") < F.col("n") - 1)
        .select("key", "term", "start", (F.col("start") + size).alias("end"))
    )


def clustered_snippets(
    docs: DataFrame,
    key: str,
    text: str,
    terms: list[str],
    max_snippets: int = 3,
    length: int = 150,
    padding: int = 30,
) -> DataFrame:
    """(key, rank, start, end, score, snippet): best clusters of nearby term positions.

    A cluster ends where the next occurrence lies more than ``length`` characters on; longer
    terms weigh more; ties go to the earlier cluster.
    """
    positions = term_positions(docs, key, text, terms)
    in_text = Window.partitionBy("key").orderBy("start", "end")
    before = in_text.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.col("end") - F.max("end").over(before) > length
    marked = positions.withColumn("opens", F.coalesce(opens, F.lit(True)).cast("int"))
    numbered = marked.withColumn("cluster", F.sum("opens").over(in_text))
    clusters = numbered.groupBy("key", "cluster").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.sum(F.length("term")).alias("score"),
    )
    order = Window.partitionBy("key").orderBy(F.desc("score"), "start")
    best = clusters.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= max_snippets)
    with_text = best.join(docs.select(F.col(key).alias("key"), F.col(text).alias("_text")), "key")
    left = F.greatest(F.col("start") - padding, F.lit(0))
    right = F.least(F.col("end") + padding, F.length("_text"))
    middle = F.floor((F.col("start") + F.col("end")) / 2)
    wide = right - left > length
    begin = F.when(wide, F.greatest(middle - length // 2, F.lit(0))).otherwise(left)
    end = F.when(wide, F.least(begin + length, F.length("_text"))).otherwise(right)
    cut = F.substring(F.col("_text"), (begin + 1).cast("int"), (end - begin).cast("int"))
    return with_text.select("key", "rank", "start", "end", "score", squeeze(cut).alias("snippet"))
