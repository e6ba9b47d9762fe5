"""Streaming jobs run over the given tables until they have read everything."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexigrid.plans.catalog import SQL_TOKENS, corpus, plan, table
from lexigrid.plans.log_plans import SQL_SEARCHES
from lexigrid.session import shared_folder, stored
from lexigrid.sources import schema as sc
from lexigrid.streaming import jobs


@plan(
    "stream_ingest",
    rf"""
    WITH {SQL_TOKENS}
    SELECT (SELECT count(*) FROM documents) AS n_docs, (SELECT sum(n_chars) FROM documents)::BIGINT AS chars,
           count(*) AS n_postings, sum(tf)::BIGINT AS n_tokens
    FROM (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term)""",
)
def stream_ingest(spark, d):
    """Documents streamed in, validated, stored and indexed."""
    docs = table(spark, d, "documents")
    stream = jobs.read_stream(spark, d, docs.schema, "documents.parquet")
    declared = sc.SearchSchema((sc.Field("doc_id", "u64"), sc.Field("text", "text"), sc.Field("n_chars", "u64")))
    root = shared_folder(spark, "stream-ingest")
    jobs.stream_ingest(stream, declared, "doc_id", "text", root).awaitTermination()
    stored = jobs.ingested(spark, root, "doc_id").agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("c"))
    ).scalar()
    index = jobs.ingested_postings(spark, root, "doc_id")
    return index.agg(F.count(F.lit(1)).alias("n_postings"), F.sum("tf").alias("n_tokens")).withColumns(
        {"n_docs": stored["n"], "chars": stored["c"]}
    )


@plan(
    "stream_search_stats",
    f"""
    WITH {SQL_SEARCHES}
    SELECT strftime(time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M') AS start,
           count(*) FILTER (event_type = 'view') AS searches, count(*) FILTER (event_type = 'click') AS clicks,
           count(*) FILTER (event_type = 'view' AND result_count = 0) AS zero_result,
           coalesce(sum(result_count) FILTER (event_type = 'view'), 0)::BIGINT AS results
    FROM k GROUP BY 1""",
)
def stream_search_stats(spark, d):
    """Six-hour search statistics of the event stream."""
    events = table(spark, d, "events")
    stream = jobs.read_stream(spark, d, events.schema, "events.parquet")
    rows = stream.select(
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("event_type") == "view").alias("is_search"),
        (F.col("event_type") == "click").alias("is_click"),
        F.floor(F.col("value") / 10).alias("result_count"),
    )
    root = shared_folder(spark, "stream-stats")
    jobs.stream_stats(jobs.windowed_stats(rows, "ts", "6 hours"), root).awaitTermination()
    found = jobs.latest_windows(spark, root)
    start = F.date_format("start", "yyyy-MM-dd HH:mm").alias("start")
    return found.select(start, "searches", "clicks", "zero_result", "results")


@plan(
    "stream_alert_match",
    rf"""
    WITH {SQL_TOKENS},
    words AS (
        SELECT DISTINCT item_id, term FROM (
            SELECT item_id, unnest(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+')) AS term FROM benchmark)
        WHERE term <> '' AND octet_length(encode(term)) < 40),
    need AS (SELECT item_id, count(*) AS n FROM words GROUP BY item_id),
    held AS (SELECT item_id, doc_id, count(*) AS n FROM words JOIN (SELECT DISTINCT doc_id, term FROM toks) USING (term) GROUP BY 1, 2)
    SELECT item_id, doc_id FROM held JOIN need USING (item_id, n)""",
)
def stream_alert_match(spark, d):
    """Benchmark passages as stored queries against arriving documents."""
    docs = table(spark, d, "documents")
    stream = jobs.read_stream(spark, d, docs.schema, "documents.parquet")
    queries = table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    root = shared_folder(spark, "stream-alerts")
    rules = stored(jobs.alert_rules(queries), "alert-rules")
    lead = stored(jobs.leads(rules, corpus(spark, d).terms.where("field = 'text'")), "alert-leads")
    jobs.stream_alerts(stream, rules, lead, "doc_id", "text", root).awaitTermination()
    found = spark.read.schema("query_id bigint, key bigint, batch int").parquet(f"{root}/alerts")
    return found.select(F.col("query_id").alias("item_id"), F.col("key").alias("doc_id"))
