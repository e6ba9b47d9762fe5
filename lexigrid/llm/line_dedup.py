"""Cross-site boilerplate: lines that appear on many distinct sites.

Only DataFrame functions run here.  A HyperLogLog sketch of the sites of each line hash is
built on the map side and merged by the aggregation, so a line on every page of the corpus
costs one small sketch a task.  Lines whose estimate is near the threshold get an exact
distinct count; the decision is therefore exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.llm.registry import query, set_aside, table
from lexigrid.session import stored

SPACES = "[\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class Spread:
    """A line of ``long_words`` words or more is boilerplate on ``long_sites`` distinct sites,
    a shorter one on ``sites``.  ``lg_k`` sets the sketch (2**lg_k cells, a standard error of
    about 1.04 / sqrt(2**lg_k)); estimates within ``margin`` of the threshold, or one site of
    it, are counted exactly.  Five standard errors are well inside the default margin.
    """

    sites: int = 8
    long_words: int = 50
    long_sites: int = 3
    lg_k: int = 12
    margin: float = 0.15

    def threshold(self) -> Column:
        return F.when(F.col("words") >= self.long_words, self.long_sites).otherwise(self.sites)


def plain_line(line: Column) -> Column:
    """A line with runs of white space as one space and none at its ends."""
    return F.trim(F.regexp_replace(line, SPACES, " "))


def line_table(docs: DataFrame, key: str, text: str, site: str) -> DataFrame:
    """(key, text_hash, pos, h1, h2, words, site) of every line with words."""
    exploded = docs.select(
        F.col(key),
        F.xxhash64(F.col(text)).alias("text_hash"),
        F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.posexplode(F.split(F.col(text), "\n", -1)).alias("pos", "line"),
    ).withColumn("line", plain_line(F.col("line")))
    return exploded.where(F.col("line") != "").select(
        key,
        "text_hash",
        "pos",
        F.xxhash64("line").alias("h1"),
        F.hash("line", F.lit(1)).alias("h2"),
        (F.length("line") - F.length(F.replace(F.col("line"), F.lit(" "), F.lit(""))) + 1).alias("words"),
        "site",
    )


def boilerplate(lines: DataFrame, key: str, rule: Spread = Spread()) -> DataFrame:
    """(h1, h2, first) of lines spread over enough sites; ``first`` is the occurrence to keep."""
    line = ["h1", "h2"]
    sketched = lines.groupBy(*line).agg(
        F.hll_sketch_agg("site", rule.lg_k).alias("sketch"),
        F.max("words").alias("words"),
        F.min(F.struct(key, "text_hash", "pos")).alias("first"),
    )
    t, about = rule.threshold(), F.hll_sketch_estimate("sketch")
    judged = stored(
        sketched.withColumn("about", about).where(about >= t * (1 - rule.margin) - 1)
        .select(*line, "first", "words", ((F.col("about") >= t * (1 + rule.margin) + 1)).alias("sure")),
        "line-spread",
    )
    near = judged.where(~F.col("sure"))
    exact = (
        lines.join(near.select(*line), line, "left_semi")
        .select(*line, "site").distinct()
        .groupBy(*line).agg(F.count("*").alias("n_sites"))
    )
    counted = near.join(exact, line).where(F.col("n_sites") >= rule.threshold())
    return judged.where("sure").select(*line, "first").unionByName(counted.select(*line, "first"))


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source", rule: Spread = Spread()
) -> DataFrame:
    """``docs`` with cross-site lines removed but for their first occurrence.

    Adds n_lines, n_removed, words_removed and words_before; a line's first occurrence is the
    one with the smallest (key, text hash, position), so that no text is lost altogether.
    Lines are compared with white space folded; lines without words always stay.  A null
    text stays null with no lines; a null site is a site of its own; rows equal in key and
    text get the same result; other columns pass through, whatever their names
    (``set_aside``); an empty table stays empty.
    """
    return set_aside(docs, (key, text, site), lambda d: _dedup_lines(d, key, text, site, rule))


def _dedup_lines(
    docs: DataFrame, key: str, text: str, site: str, rule: Spread
) -> DataFrame:
    lines = stored(line_table(docs, key, text, site), "lines")
    found = boilerplate(lines, key, rule)
    place = F.struct(key, "text_hash", "pos")
    removed = (
        lines.join(found, ["h1", "h2"])
        .where(~place.eqNullSafe(F.col("first")))
        .select(F.col(key).alias("key_"), F.col("text_hash").alias("hash_"), "pos", "words")
        .distinct()
        .groupBy("key_", "hash_")
        .agg(F.collect_list("pos").alias("gone_"), F.sum("words").alias("cut_"))
    )
    parts = F.split(F.col(text), "\n", -1)
    kept = F.filter(parts, lambda _, i: ~F.array_contains(F.col("gone_"), i))
    words = F.size(F.filter(F.split(F.col(text), SPACES), lambda w: w != ""))
    joined = docs.withColumn("text_hash_", F.xxhash64(F.col(text))).join(
        removed, F.col(key).eqNullSafe(F.col("key_")) & (F.col("text_hash_") == F.col("hash_")), "left"
    )
    return joined.select(
        *[
            F.when(F.col("gone_").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")).alias(c)
            if c == text
            else F.col(c)
            for c in docs.columns
        ],
        F.when(F.col(text).isNull(), 0).otherwise(F.size(parts)).alias("n_lines"),
        F.when(F.col("gone_").isNull(), 0).otherwise(F.size("gone_")).alias("n_removed"),
        F.coalesce("cut_", F.lit(0)).cast("long").alias("words_removed"),
        F.when(F.col(text).isNull(), 0).otherwise(words).cast("long").alias("words_before"),
    )


@query(
    "op6_line_spread",
    """
    WITH split AS (
        SELECT doc_id, text, coalesce(source, '') AS site, unnest(string_split(text, chr(10))) AS raw,
               generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
        FROM documents),
    lines AS (
        SELECT *, length(line) - length(replace(line, ' ', '')) + 1 AS words
        FROM (SELECT *, trim(regexp_replace(raw, '[\\x09-\\x0D\\x20]+', ' ', 'g'), ' ') AS line FROM split)
        WHERE line <> ''),
    spread AS (
        SELECT line, min(doc_id * 1000000 + pos) AS first
        FROM lines GROUP BY line
        HAVING count(DISTINCT site) >= CASE WHEN max(words) >= 50 THEN 3 ELSE 8 END),
    gone AS (
        SELECT doc_id, pos, words FROM lines JOIN spread USING (line) WHERE doc_id * 1000000 + pos <> first),
    left_over AS (
        SELECT s.doc_id, string_agg(raw, chr(10) ORDER BY s.pos) AS text
        FROM split s ANTI JOIN gone g ON s.doc_id = g.doc_id AND s.pos = g.pos GROUP BY s.doc_id)
    SELECT d.doc_id, len(string_split(d.text, chr(10)))::INTEGER AS n_lines,
           (SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id)::INTEGER AS n_removed,
           coalesce((SELECT sum(words) FROM gone g WHERE g.doc_id = d.doc_id), 0)::BIGINT AS words_removed,
           md5(coalesce(l.text, '')) AS text_md5
    FROM documents d LEFT JOIN left_over l USING (doc_id)
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "n_lines", "n_removed", "words_removed", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5")
    )
