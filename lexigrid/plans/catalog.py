"""Registry of runnable queries with the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.operators.postings import Corpus, load_index, save_index
from lexigrid.session import shared_folder


@dataclass(frozen=True)
class Plan:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


PLANS: dict[str, Plan] = {}


def plan(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        if name in PLANS:
            raise ValueError(f"registered twice: {name}")
        PLANS[name] = Plan(build, sql)
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


_indexes: dict[tuple, str] = {}


def version(df: DataFrame) -> tuple:
    """Tells one state of a table's files from another; no column is read."""
    file = F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    files = df.select(file.alias("file")).distinct()
    return tuple(files.agg(F.count(F.lit(1)), F.sum(F.col("file").cast("decimal(20,0)"))).first())


def index_path(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], Corpus]) -> str:
    """Where the index ``name`` is, which a session writes once for each state of the documents."""
    place = spark.sparkContext.applicationId, sf_dir, name, version(documents(spark, sf_dir))
    if place not in _indexes:
        path = shared_folder(spark, name)
        save_index(build(), path)
        _indexes[place] = path
    return _indexes[place]


def corpus(spark: SparkSession, sf_dir: str) -> Corpus:
    """The documents with their saved index."""
    docs = documents(spark, sf_dir)
    path = index_path(spark, sf_dir, "index", lambda: Corpus.analyze(docs, "doc_id", {"text": "text"}))
    return load_index(docs, "doc_id", path)


def stored_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, field, term, tf, dl) of all documents from the saved index."""
    return corpus(spark, sf_dir).occurrences.select("key", "field", "term", "tf", "dl")


# SQL the plans share.  Words are split by the same rule but everything after that -
# matching, counting, scoring - is stated in plain SQL.
WORDS = r"string_split_regex(lower(text), '[^\p{L}\p{N}]+')"
SQL_TOKENS = rf"""
    arrays AS (
        SELECT doc_id, lang, source,
               list_filter({WORDS}, lambda w: w <> '') AS words
        FROM documents),
    numbered AS (
        SELECT doc_id, lang, source, unnest(words) AS term,
               generate_subscripts(words, 1) - 1 AS pos
        FROM arrays),
    toks AS (
        SELECT doc_id, lang, source, pos, term FROM numbered
        WHERE octet_length(encode(term)) < 40)"""
SQL_STATS = f"""{SQL_TOKENS},
    lens AS (
        SELECT d.doc_id, coalesce(x.dl, 0) AS dl
        FROM documents d
        LEFT JOIN (SELECT doc_id, count(*) AS dl FROM toks GROUP BY doc_id) x USING (doc_id)),
    coll AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM lens)"""


def sql_bm25(tf: str, df: str, dl: str = "dl") -> str:
    """BM25 weight of one term as SQL text, with N and avgdl from ``coll``."""
    return (
        f"ln(1 + (coll.n - {df} + 0.5) / ({df} + 0.5)) * {tf} * 2.2 "
        f"/ ({tf} + 1.2 * (0.25 + 0.75 * {dl} / coll.avgdl))"
    )
