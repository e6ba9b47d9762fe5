"""Structured Streaming jobs over growing document and event folders.

Every job writes Parquet under a folder all executors share and keeps its progress in a
checkpoint there.  Batch folders carry the batch number and are overwritten on a retry, so
a batch that runs twice counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lexigrid.functions.tokens import SEARCH, Analyzer
from lexigrid.operators.postings import build_postings, token_streams
from lexigrid.sources.schema import SearchSchema, validate


def read_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int = 100
) -> DataFrame:
    """New Parquet files of a folder as a stream.

    What ``pattern`` names may be files or folders of files, as a table written by several
    tasks is.  Braces make a plain name a pattern too: a stream's path is a folder otherwise.
    """
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(f"{folder.rstrip('/')}/{{{pattern}}}")
    )


def stream_ingest(
    stream: DataFrame,
    schema: SearchSchema,
    key: str,
    text: str,
    root: str,
    analyzer: Analyzer = SEARCH,
    sequence: str | None = None,
) -> StreamingQuery:
    """Validate arriving documents, keep good and bad rows apart and index the good ones.

    Of a key's good rows in one batch the one with the highest ``sequence`` counts, or without
    that column the greatest row, so that document and postings are of the same row.
    """

    def write(batch: DataFrame, number: int) -> None:
        checked = validate(batch, schema)
        bad = F.size("errors") > 0
        marked = checked.withColumn("verdict", F.when(bad, "rejected").otherwise("accepted"))
        others = [c for c in marked.columns if c not in (key, "verdict", "errors")]
        order = F.struct(*([F.col(sequence)] if sequence else []), *others)
        good = marked.where("verdict = 'accepted'").groupBy(key).agg(
            F.max_by(F.struct(*[c for c in marked.columns if c != key]), order).alias("row")
        )
        marked = marked.where("verdict <> 'accepted'").unionByName(
            good.select(key, "row.*").select(*marked.columns)
        )
        marked.write.mode("overwrite").partitionBy("verdict").parquet(f"{root}/docs/batch={number}")
        # Index what was written: a replayed source can then not differ between the two.
        stored = batch.sparkSession.read.parquet(f"{root}/docs/batch={number}")
        good = stored.where(F.col("verdict") == "accepted")
        index = build_postings(token_streams(good, key, {text: text}, analyzer))
        index.write.mode("overwrite").parquet(f"{root}/postings/batch={number}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
    )


def ingested(spark: SparkSession, root: str, key: str) -> DataFrame:
    """Current documents: the latest batch of a key wins, by a max that combines early."""
    docs = spark.read.parquet(f"{root}/docs").where(F.col("verdict") == "accepted")
    columns = [c for c in docs.columns if c != key]
    latest = docs.groupBy(key).agg(F.max_by(F.struct(*columns), "batch").alias("row"))
    return latest.select(key, "row.*")


def ingested_postings(spark: SparkSession, root: str, key: str) -> DataFrame:
    """Postings of current documents only: those of each document's latest batch."""
    postings = spark.read.parquet(f"{root}/postings")
    latest = ingested(spark, root, key).select(F.col(key).alias("key"), "batch")
    return postings.join(latest, ["key", "batch"], "left_semi")


def windowed_stats(
    events: DataFrame, time: str, width: str, slide: str | None = None, late: str = "1 hour"
) -> DataFrame:
    """Searches, clicks, zero-result searches and result sums per event-time window.

    Input columns: the time, is_search, is_click, result_count.  Rows later than ``late``
    behind the newest are dropped and their window state is let go.
    """
    frame = F.window(time, width, slide) if slide else F.window(time, width)
    return (
        events.withWatermark(time, late)
        .groupBy(frame.alias("w"))
        .agg(
            F.count_if("is_search").alias("searches"),
            F.count_if("is_click").alias("clicks"),
            F.count_if(F.col("is_search") & (F.col("result_count") == 0)).alias("zero_result"),
            F.coalesce(F.sum(F.when(F.col("is_search"), F.col("result_count"))), F.lit(0)).alias("results"),
        )
        .select("w.start", "w.end", "searches", "clicks", "zero_result", "results")
    )


def stream_stats(stats: DataFrame, root: str) -> StreamingQuery:
    """Changed windows of every batch, one folder per batch."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/windows/batch={number}")

    return (
        stats.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
    )


def latest_windows(spark: SparkSession, root: str) -> DataFrame:
    """Last state of every window."""
    rows = spark.read.parquet(f"{root}/windows")
    columns = [c for c in rows.columns if c not in ("start", "end", "batch")]
    latest = rows.groupBy("start", "end").agg(F.max_by(F.struct(*columns), "batch").alias("row"))
    return latest.select("start", "end", "row.*")


def alert_rules(queries: DataFrame, analyzer: Analyzer = SEARCH) -> DataFrame:
    """Stored AND queries (query_id, text) as an inverted index: (query_id, term, n), one row a
    distinct term, with the number of the query's terms.  Queries without terms match nothing."""
    terms = F.array_distinct(analyzer.tokens(F.col("text")))
    rules = queries.select("query_id", terms.alias("terms"))
    return rules.select("query_id", F.explode("terms").alias("term"), F.size("terms").alias("n"))


def leads(rules: DataFrame, frequencies: DataFrame, rows_per_task: int = 20_000) -> DataFrame:
    """(query_id, n, term, salts): each rule's rarest term, by ``frequencies`` (term, df).

    A term without a frequency is the rarest; ties go to the longer term, then by name.  A
    lead is dealt to so many salts that one has about ``rows_per_task`` of its pairs of rules
    and documents; most have one.
    """
    known = rules.join(frequencies.select("term", "df"), "term", "left")
    place = F.struct(F.coalesce("df", F.lit(0)).alias("df"), (-F.length("term")).alias("shortness"), "term")
    lead = known.groupBy("query_id", "n").agg(F.min(place).alias("lead"))
    lead = lead.select("query_id", "n", "lead.term", "lead.df")
    pairs = lead.groupBy("term").agg((F.count(F.lit(1)) * F.greatest(F.max("df"), F.lit(1))).alias("pairs"))
    salts = F.ceil(F.col("pairs") / rows_per_task).cast("int")
    return lead.drop("df").join(pairs.select("term", salts.alias("salts")), "term")


def document_terms(docs: DataFrame, key: str, text: str, analyzer: Analyzer = SEARCH) -> DataFrame:
    """(key, term) of the distinct terms of each document; a narrow step."""
    return docs.select(F.col(key).alias("key"), F.explode(F.array_distinct(analyzer.tokens(F.col(text)))).alias("term"))


def match_alerts(terms: DataFrame, rules: DataFrame, lead: DataFrame) -> DataFrame:
    """(query_id, key) of stored queries all of whose terms a document holds.

    ``terms`` is (key, term) with each pair once.  Only documents with a rule's lead are looked
    at.  A hot lead's documents are dealt to its salts, of which each has the rule; the other
    terms are joined by (key, term) and counted.  No row carries a document's words.
    """
    hot = lead.select("term", "salts").distinct()
    held = terms.join(hot, "term").withColumn("salt", F.pmod(F.xxhash64("key"), F.col("salts")))
    dealt = lead.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - F.lit(1).cast("bigint"))))
    proposed = held.select("key", "term", "salt").join(dealt, ["term", "salt"]).select("key", "query_id", "n")
    several = proposed.where("n > 1").join(rules.select("query_id", "term"), "query_id")
    counted = several.join(terms, ["key", "term"]).groupBy("query_id", "key").agg(F.count(F.lit(1)).alias("found"), F.max("n").alias("n"))
    return proposed.where("n = 1").select("query_id", "key").unionByName(
        counted.where("found = n").select("query_id", "key")
    )


def stream_alerts(
    docs: DataFrame, rules: DataFrame, lead: DataFrame, key: str, text: str, root: str, analyzer: Analyzer = SEARCH
) -> StreamingQuery:
    """Alerts of every batch of arriving documents, one folder a batch.

    A batch's terms are written once for the joins; a batch that is run again overwrites its
    own folders.  Keys are unique within a batch, or equal keys count as one document.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark, place = batch.sparkSession, f"{root}/terms/batch={number}"
        document_terms(batch, key, text, analyzer).distinct().write.mode("overwrite").parquet(place)
        found = match_alerts(spark.read.parquet(place), rules, lead)
        found.write.mode("overwrite").parquet(f"{root}/alerts/batch={number}")

    return (
        docs.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
    )
