"""A corpus pipeline: toxicity, line dedup, near duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's documents.  All but the last keep the documents' columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.llm.bm25_packing import pack
from lexigrid.llm.decontaminate import decontaminate
from lexigrid.llm.line_dedup import dedup_lines
from lexigrid.llm.registry import set_aside, ship, table
from lexigrid.llm.trie_join import keep_one
from lexigrid.llm.weak_toxicity import score_toxicity
from lexigrid.session import stored

#: A document whose words are, by this share or more, lines kept in other documents has no
#: text of its own left and goes with them.
HOLLOW = 0.75


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go.

    A null or empty text is scored as one without known terms; repeated rows go or stay
    together; very long texts are scored whole; null keys stay with their rows.
    """
    ship(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")

    def clean(d: DataFrame) -> DataFrame:
        return score_toxicity(d, labels).where("predicted = 0").select(*d.columns)

    return set_aside(docs, (), clean)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines spread over many sites stay in one document only; hollow documents go.

    A null text stays null and an empty one empty; a null source is a site of its own; rows
    equal in key and text keep the same lines; very long texts are cleaned whole.
    """
    ship(spark)

    def clean(d: DataFrame) -> DataFrame:
        hollow = (F.col("words_removed") > 0) & (F.col("words_removed") >= HOLLOW * F.col("words_before"))
        return dedup_lines(d).where(~hollow).select(*d.columns)

    return set_aside(docs, (), clean)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, the one with the smallest key.

    Texts without words are in no class and stay; rows with the key that stays and a text of
    its class all stay, and so do null keys; very long texts are compared whole.
    """
    ship(spark)
    return keep_one(docs).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, re-parameterised or not, go.

    A null or empty text holds none; rows equal in key and text go or stay together; very long
    texts are searched whole.
    """
    ship(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents, packed into windows.

    A null or empty text is the end mark alone; repeated rows are packed each; a very long text
    is cut into pieces; other columns are left behind.
    """
    ship(spark)
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: A trained classifier, approximate retrieval and a tokenizer are not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
