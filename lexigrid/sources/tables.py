"""Document sets as Parquet: loading, ingest, routing, versions, upkeep."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrid.operators.postings import Corpus
from lexigrid.operators.queries import Query, Term, TypedTerm, all_terms, match, phrase
from lexigrid.sources.schema import SearchSchema, validate

# When a space profile gives advice.
LARGE_SHARE = 0.5
MANY_DELETED = 0.1
MANY_SEGMENTS = 10


def load_documents(spark: SparkSession, path: str, kind: str, schema: T.StructType) -> DataFrame:
    """Documents from Parquet, JSON lines or CSV under an explicit schema."""
    reader = spark.read.schema(schema)
    if kind == "parquet":
        return reader.parquet(path)
    if kind == "json":
        return reader.json(path)
    if kind == "csv":
        return reader.csv(path, header=True, multiLine=True, quote='"', escape='"')
    raise ValueError(f"unknown format: {kind}")


def save_documents(df: DataFrame, path: str, kind: str) -> None:
    writer = df.write.mode("errorifexists")
    if kind == "parquet":
        writer.parquet(path)
    elif kind == "json":
        writer.json(path)
    elif kind == "csv":
        writer.csv(path, header=True, quote='"', escape='"', quoteAll=True, emptyValue="")
    else:
        raise ValueError(f"unknown format: {kind}")


class RejectedDocuments(ValueError):
    """Ingest stopped because of invalid documents."""


def ingest(
    df: DataFrame,
    schema: SearchSchema,
    path: str,
    check: bool = True,
    continue_on_error: bool = False,
    strict: bool = False,
) -> dict[str, int]:
    """Write valid documents to ``path/accepted`` and, when allowed, others to ``path/rejected``.

    One write does both: the verdict is a partition column.  Counts come from the same pass.
    """
    if not check:
        checked = df.withColumn("errors", F.array().cast("array<struct<field:string,reason:string>>"))
    else:
        checked = validate(df, schema, strict)
    bad = F.size("errors") > 0
    if not continue_on_error:
        first = F.col("errors")[0]
        message = F.concat(F.lit("invalid document: "), first["field"], F.lit(" "), first["reason"])
        checked = checked.withColumn(
            "errors", F.when(bad, F.raise_error(message).cast(checked.schema["errors"].dataType)).otherwise(F.col("errors"))
        )
    counts = Observation()
    marked = checked.withColumn("verdict", F.when(bad, "rejected").otherwise("accepted"))
    observed = marked.observe(
        counts,
        F.count_if(F.col("verdict") == "accepted").alias("accepted"),
        F.count_if(F.col("verdict") == "rejected").alias("rejected"),
    )
    try:
        observed.write.mode("errorifexists").partitionBy("verdict").parquet(path)
    except Exception as problem:
        if "invalid document: " in str(problem):
            start = str(problem).index("invalid document: ")
            raise RejectedDocuments(str(problem)[start:].split("\n")[0]) from problem
        raise
    return counts.get


def delete_by_query(docs: DataFrame, key: str, corpus: Corpus, query: Query) -> DataFrame:
    """Documents a query does not match."""
    gone = match(corpus, query, scored=False).select(F.col("key").alias(key))
    return docs.join(gone, key, "left_anti")


def delete_by_term(
    docs: DataFrame, key: str, corpus: Corpus, field: str, text: str, positions: bool = True
) -> DataFrame:
    """One word deletes by term; several by phrase, or by all words without positions.

    On a number, bool or date column the text is a value of the column's type.
    """
    words = text.split()
    if field in docs.columns and not isinstance(docs.schema[field].dataType, T.StringType):
        query: Query = TypedTerm(field, text)
    elif len(words) == 1:
        query = Term(field, words[0])
    else:
        query = phrase(field, words) if positions else all_terms(field, text)
    return delete_by_query(docs, key, corpus, query)


def update_by_term(
    docs: DataFrame, key: str, corpus: Corpus, field: str, text: str, replacement: DataFrame
) -> DataFrame:
    """Documents that a term of any field finds go, and the replacement comes."""
    return delete_by_term(docs, key, corpus, field, text).unionByName(replacement.select(*docs.columns))


def upsert(docs: DataFrame, changes: DataFrame, key: str, sequence: str) -> DataFrame:
    """Changed and new documents over the old ones; the highest sequence of a key wins.

    The winner is a ``max_by`` that combines before the shuffle, so a key with very many
    changes is never gathered.
    """
    columns = [c for c in docs.columns if c != key]
    latest = (
        changes.groupBy(key)
        .agg(F.max_by(F.struct(*columns), sequence).alias("row"))
        .select(key, "row.*")
    )
    kept = docs.join(latest.select(key), key, "left_anti")
    return kept.unionByName(latest.select(*docs.columns))


def write_version(
    docs: DataFrame,
    root: str,
    version: int,
    checks: dict[str, Column],
    queries: dict[str, Query],
    key: str = "doc_id",
    fields: dict[str, str] = {"text": "text"},
) -> dict[str, bool]:
    """Write a version beside the live one and publish it only if all checks hold.

    ``checks`` are boolean aggregates over the written rows; ``queries`` must find something
    in the index of the written rows.
    Without its marker a version is invisible, which is also how a rollback works.
    """
    spark = docs.sparkSession
    docs.write.mode("errorifexists").parquet(f"{root}/data/v={version}")
    written = spark.read.parquet(f"{root}/data/v={version}")
    row = written.agg(F.lit(True).alias("_"), *[c.alias(n) for n, c in checks.items()]).first()
    verdict = {name: bool(row[name]) for name in checks}
    corpus = Corpus.analyze(written, key, fields) if queries else None
    for name, query in queries.items():
        verdict[name] = not match(corpus, query, scored=False).isEmpty()
    if all(verdict.values()):
        marker = spark.range(1).select(F.lit(version).alias("version"))
        marker.write.mode("overwrite").parquet(f"{root}/complete/{version}")
    return verdict


def current_version(spark: SparkSession, root: str) -> int:
    """Highest published version."""
    markers = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/complete")
    return markers.agg(F.max("version")).first()[0]


def read_current(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/data/v={current_version(spark, root)}")


def route(df: DataFrame, by: str, column: str, shards: int = 8) -> DataFrame:
    """Adds ``route``: hash of the column, its value, or its year and month."""
    targets = {
        "hash": F.pmod(F.xxhash64(column), F.lit(shards)).cast("string"),
        "type": F.col(column).cast("string"),
        "year_month": F.date_format(column, "yyyy-MM"),
    }
    if by not in targets:
        raise ValueError(f"unknown routing: {by}")
    return df.withColumn("route", targets[by])


def write_routed(df: DataFrame, path: str, key: str, salts: int = 8) -> None:
    """Routed rows as partition folders; a salt splits a large route over several tasks."""
    salt = F.pmod(F.xxhash64(key), F.lit(salts))
    df.repartition(F.col("route"), salt).write.mode("errorifexists").partitionBy("route").parquet(path)


def migrate(
    df: DataFrame, rename: dict[str, str] = {}, derive: dict[str, Column] = {}, drop: list[str] = []
) -> DataFrame:
    return df.withColumnsRenamed(rename).withColumns(derive).drop(*drop)


def compact(docs: DataFrame, deleted: DataFrame | None, key: str, path: str, target_bytes: int = 128 << 20) -> int:
    """Rewrite a set of many files into files of about ``target_bytes``, without deleted rows."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    files = max(1, math.ceil(size / target_bytes))
    live = docs if deleted is None else docs.join(deleted.select(key), key, "left_anti")
    live.repartition(files).write.mode("errorifexists").parquet(path)
    return files


def column_bytes(name: str, kind: T.DataType) -> Column:
    """Bytes of a column's values: text and binary by length, others by their width."""
    column = F.col(name)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.sum(F.octet_length(column)), F.lit(0))
    widths = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}
    width = widths.get(type(kind))
    if width is None and isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.coalesce(F.sum(F.octet_length(F.to_json(column))), F.lit(0))
    return F.count(column) * (width or 8)


def space_profile(docs: DataFrame, n_deleted: Column | None = None, n_segments: Column | None = None) -> DataFrame:
    """(field, bytes, share, n_docs, bytes_per_doc, deleted_share, advice) from one pass."""
    sizes = {f.name: column_bytes(f.name, f.dataType) for f in docs.schema.fields}
    one = docs.agg(F.count(F.lit(1)).alias("n_docs"), *[c.alias(n) for n, c in sizes.items()])
    rows = one.withColumns(
        {
            "total": sum((F.col(n) for n in list(sizes)[1:]), F.col(list(sizes)[0])),
            "n_deleted": F.lit(0) if n_deleted is None else n_deleted,
            "n_segments": F.lit(1) if n_segments is None else n_segments,
        }
    ).select(
        "n_docs", "total", "n_deleted", "n_segments",
        F.inline(
            F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).cast("bigint").alias("bytes")) for n in sizes])
        ),
    )
    share = F.col("bytes") / F.nullif("total", F.lit(0))
    gone = F.col("n_deleted") / F.nullif(F.col("n_docs") + F.col("n_deleted"), F.lit(0))
    advice = F.array_compact(
        F.array(
            F.when(share > LARGE_SHARE, "large field"),
            F.when(gone > MANY_DELETED, "compact deletes"),
            F.when(F.col("n_segments") > MANY_SEGMENTS, "merge segments"),
        )
    )
    return rows.select(
        "field", "bytes", share.alias("share"), "n_docs",
        (F.col("bytes") / F.nullif("n_docs", F.lit(0))).alias("bytes_per_doc"),
        gone.alias("deleted_share"), advice.alias("advice"),
    )


def compare_profiles(before: DataFrame, after: DataFrame) -> DataFrame:
    """Differences in bytes and documents per field between two profiles."""
    left = before.select("field", F.col("bytes").alias("b0"), F.col("n_docs").alias("d0"))
    right = after.select("field", F.col("bytes").alias("b1"), F.col("n_docs").alias("d1"))
    both = left.join(right, "field", "full").fillna(0)
    change = F.when(F.col("b0") > 0, (F.col("b1") - F.col("b0")) * 100.0 / F.col("b0")).otherwise(0.0)
    return both.select(
        "field",
        (F.col("b1") - F.col("b0")).alias("bytes_delta"),
        (F.col("d1") - F.col("d0")).alias("docs_delta"),
        change.alias("bytes_percent"),
    )


def product_documents(products: DataFrame) -> DataFrame:
    """Nested products flattened: searchable text, category path, price in cents.

    Input columns: id, name, categories (array), price, maker struct<name, country>.
    """
    text = F.lower(F.concat_ws(" ", "name", F.array_join("categories", " "), "maker.name"))
    return products.select(
        "id",
        text.alias("search_text"),
        F.concat(F.lit("/"), F.array_join("categories", "/")).alias("category_path"),
        F.round(F.col("price") * 100).cast("bigint").alias("price_cents"),
        F.col("maker.name").alias("maker_name"),
        F.col("maker.country").alias("maker_country"),
    )
