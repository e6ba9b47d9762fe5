"""Search log and application log queries over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.operators import queries as q
from lexigrid.operators import search_log as sl
from lexigrid.operators.postings import Corpus
from lexigrid.plans.catalog import SQL_STATS, corpus, plan, table
from lexigrid.plans.query_plans import term_cte

NOW = "2024-01-31 00:00:00"

# Events read as a search log: views are searches, clicks are clicks, the property is the query.
SQL_SEARCHES = r"""
    k AS (SELECT *, 'q' || regexp_extract(props, ': ([0-9]+)', 1) AS query, floor(value / 10)::BIGINT AS result_count FROM events),
    searches AS (SELECT * FROM k WHERE event_type = 'view'), clicks AS (SELECT * FROM k WHERE event_type = 'click')"""


def search_log(spark, d) -> tuple[DataFrame, DataFrame]:
    events = table(spark, d, "events").select(
        F.concat(F.lit("q"), F.get_json_object("props", "$.k")).alias("query"),
        "ts",
        F.floor(F.col("value") / 10).alias("result_count"),
        "value",
        "event_type",
    )
    return events.where("event_type = 'view'"), events.where("event_type = 'click'")


@plan(
    "search_stats",
    f"""
    WITH {SQL_SEARCHES}, w AS (SELECT * FROM (VALUES ('today', 24), ('week', 168), ('month', 720)) t(timeframe, hours)),
    s AS (SELECT timeframe, query, result_count FROM searches, w WHERE ts >= TIMESTAMP '{NOW}' - hours * INTERVAL '1 hour'),
    c AS (SELECT timeframe, query FROM clicks, w WHERE ts >= TIMESTAMP '{NOW}' - hours * INTERVAL '1 hour')
    SELECT timeframe, (SELECT count(*) FROM s WHERE s.timeframe = w.timeframe) AS total_searches,
        (SELECT count(*) FROM c WHERE c.timeframe = w.timeframe) AS total_clicks,
        (SELECT count(*) FROM s WHERE s.timeframe = w.timeframe AND result_count = 0) AS zero_result_searches,
        round((SELECT avg(result_count) FROM s WHERE s.timeframe = w.timeframe), 6) AS average_results,
        round((SELECT count(*) FROM c WHERE c.timeframe = w.timeframe AND EXISTS (SELECT 1 FROM s WHERE s.timeframe = c.timeframe AND s.query = c.query))
              / (SELECT count(*) FROM s WHERE s.timeframe = w.timeframe), 6) AS click_through_rate
    FROM w""",
)
def search_stats(spark, d):
    stats = sl.search_stats(*search_log(spark, d), now=NOW)
    return stats.withColumns({c: F.round(c, 6) for c in ("average_results", "click_through_rate")})


@plan(
    "hourly_response",
    f"""
    WITH {SQL_SEARCHES}
    SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour, count(*) AS total_searches,
           round(avg(value), 6) AS avg_response_time, count(*) FILTER (value > 200) AS slow_queries FROM searches GROUP BY 1""",
)
def hourly_response(spark, d):
    searches, _ = search_log(spark, d)
    hours = sl.hourly_response(searches, "ts", "value", 200.0)
    return hours.withColumn("avg_response_time", F.round("avg_response_time", 6))


@plan(
    "popular_queries",
    f"""
    WITH {SQL_SEARCHES} SELECT query, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, query)::INT AS rank
    FROM searches GROUP BY query QUALIFY rank <= 10""",
)
def popular_queries(spark, d):
    return sl.popular_queries(search_log(spark, d)[0])


@plan(
    "zero_result_queries",
    f"""
    WITH {SQL_SEARCHES} SELECT query, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, query)::INT AS rank
    FROM searches WHERE result_count = 0 GROUP BY query QUALIFY rank <= 10""",
)
def zero_result_queries(spark, d):
    return sl.zero_result_queries(search_log(spark, d)[0])


# Events read as an application log with level, message, service and address.
SQL_LOGS = r"""
    k AS (SELECT *, regexp_extract(props, ': ([0-9]+)', 1)::BIGINT AS k FROM events),
    logs AS (
        SELECT event_id, ts, user_id, event_type AS service, '10.0.' || (user_id % 4) || '.' || user_id AS client_ip,
               CASE event_type WHEN 'error' THEN CASE WHEN k % 5 = 0 THEN 'Warn' ELSE 'ERROR' END WHEN 'view' THEN 'info'
                    WHEN 'click' THEN 'debug' WHEN 'signup' THEN 'INFO' ELSE 'trace' END AS level,
               CASE event_type
                    WHEN 'error' THEN CASE k % 6 WHEN 0 THEN 'Upload failed: timeout' WHEN 1 THEN 'Exception: connection lost'
                        WHEN 2 THEN 'Failed: permission denied' WHEN 3 THEN 'Page not found error' ELSE 'Job failed' END
                    WHEN 'view' THEN 'HTTP request for page ' || k WHEN 'signup' THEN 'User login opened'
                    WHEN 'purchase' THEN 'Slow SQL after ' || k || ' ms' ELSE 'Pointer moved' END AS message
        FROM k)"""


def logs(spark, d) -> DataFrame:
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k").cast("bigint")
    failure = (
        F.when(k % 6 == 0, "Upload failed: timeout")
        .when(k % 6 == 1, "Exception: connection lost")
        .when(k % 6 == 2, "Failed: permission denied")
        .when(k % 6 == 3, "Page not found error")
        .otherwise("Job failed")
    )
    return table(spark, d, "events").select(
        "event_id",
        "ts",
        "user_id",
        kind.alias("service"),
        F.concat(F.lit("10.0."), F.col("user_id") % 4, F.lit("."), "user_id").alias("client_ip"),
        F.when(kind == "error", F.when(k % 5 == 0, "Warn").otherwise("ERROR"))
        .when(kind == "view", "info")
        .when(kind == "click", "debug")
        .when(kind == "signup", "INFO")
        .otherwise("trace")
        .alias("level"),
        F.when(kind == "error", failure)
        .when(kind == "view", F.concat(F.lit("HTTP request for page "), k))
        .when(kind == "signup", "User login opened")
        .when(kind == "purchase", F.concat(F.lit("Slow SQL after "), k, F.lit(" ms")))
        .otherwise("Pointer moved")
        .alias("message"),
    )


@plan(
    "classify_logs",
    rf"""
    WITH {SQL_LOGS}
    SELECT event_id, CASE upper(level) WHEN 'ERROR' THEN 'high' WHEN 'WARN' THEN 'medium' WHEN 'INFO' THEN 'low' WHEN 'DEBUG' THEN 'low' ELSE 'unknown' END AS severity,
           CASE WHEN regexp_matches(lower(message), 'error|exception|failed') THEN 'error'
                WHEN regexp_matches(lower(message), 'login|auth|session') THEN 'authentication'
                WHEN regexp_matches(lower(message), 'request|response|http') THEN 'http'
                WHEN regexp_matches(lower(message), 'database|query|sql') THEN 'database' ELSE 'general' END AS category
    FROM logs""",
)
def classify_logs(spark, d):
    return sl.classify(logs(spark, d), "level", "message").select("event_id", "severity", "category")


@plan(
    "related_logs",
    """
    SELECT event_id, user_id, nullif(count(*) OVER (PARTITION BY user_id) - 1, 0) AS related_count FROM events""",
)
def related_logs(spark, d):
    return sl.related(logs(spark, d), "user_id").select("event_id", "user_id", "related_count")


@plan(
    "log_patterns",
    rf"""
    WITH {SQL_LOGS}
    SELECT 'error' AS type, CASE WHEN contains(message, 'timeout') THEN 'timeout_error' WHEN contains(message, 'connection') THEN 'connection_error'
        WHEN contains(message, 'permission') THEN 'permission_error' WHEN contains(message, 'not found') THEN 'not_found_error' ELSE 'generic_error' END AS pattern,
        count(*) AS count FROM logs WHERE upper(level) = 'ERROR' GROUP BY 2
    UNION ALL SELECT 'ip_activity', client_ip, count(*) FROM logs GROUP BY 2
    UNION ALL SELECT 'service_activity', service, count(*) FROM logs GROUP BY 2""",
)
def log_patterns(spark, d):
    rows = logs(spark, d)
    errors = rows.where(F.upper("level") == "ERROR")
    return (
        sl.log_patterns(errors, "error", "message")
        .unionByName(sl.log_patterns(rows, "ip", "client_ip"))
        .unionByName(sl.log_patterns(rows, "service", "service"))
    )


@plan(
    "query_profile",
    r"""
    WITH t AS (SELECT *, len(list_filter(string_split_regex(text, '[\s\p{Z}]+'), lambda w: w <> '')) AS words FROM conversations)
    SELECT conv_id, turn, length(text)::INT AS query_length, words::INT AS word_count, regexp_matches(text, '[^a-zA-Z0-9\s]') AS has_special_chars,
           CASE WHEN regexp_matches(text, '["'']') THEN 'phrase_query' WHEN regexp_matches(text, 'AND|OR|NOT') THEN 'boolean_query'
                WHEN contains(text, '*') THEN 'wildcard_query' WHEN words = 1 THEN 'single_term' ELSE 'multi_term' END AS query_type,
           (words + CASE WHEN regexp_matches(text, '["'']') THEN 2 ELSE 0 END + CASE WHEN regexp_matches(text, '(?i)AND|OR|NOT') THEN 3 ELSE 0 END
                + CASE WHEN contains(text, '*') THEN 1 ELSE 0 END + CASE WHEN regexp_matches(text, '[0-9]') THEN 1 ELSE 0 END)::INT AS complexity
    FROM t""",
)
def query_profile(spark, d):
    turns = table(spark, d, "conversations")
    profile = sl.query_profile(F.col("text"))
    return turns.select("conv_id", "turn", *[c.alias(n) for n, c in profile.items()])


WORDS = ["thing", "und", "the", "thonwh", "disgusting"]
SQL_HITS = ", ".join(term_cte(f"w{i}", w) for i, w in enumerate(WORDS))
SQL_UNION = " UNION ALL ".join(f"SELECT '{w}' AS query_id, * FROM w{i}" for i, w in enumerate(WORDS))


@plan(
    "result_quality",
    f"""
    WITH {SQL_STATS}, {SQL_HITS}, hits AS ({SQL_UNION}),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC) AS place FROM hits),
    q AS (SELECT query_id, count(*) AS total_results, max(score) AS best, min(score) AS worst, avg(score) AS mean, var_pop(score) AS variance,
                 max(score) FILTER (place = 2) AS second FROM r GROUP BY query_id)
    SELECT query_id, total_results, round(best - worst, 6) AS score_spread, round(coalesce(best / second, 1.0), 6) AS top_result_dominance,
           round(CASE WHEN total_results < 2 THEN 1.0 ELSE 1 / (1 + variance) END, 6) AS uniformity,
           CASE WHEN second IS NULL THEN 'single' WHEN best > second * 1.5 THEN 'dominant_leader' ELSE 'competitive' END AS distribution_type,
           CASE WHEN best > 2.0 AND mean > 0.8 THEN 'excellent' WHEN best > 1.5 AND mean > 0.5 THEN 'good'
                WHEN best > 1.0 AND mean > 0.3 THEN 'fair' ELSE 'poor' END AS relevance_quality
    FROM q""",
)
def result_quality(spark, d):
    hits = q.match_many(corpus(spark, d), {w: q.Term("text", w) for w in WORDS})
    rows = sl.result_quality(hits)
    return rows.withColumns(
        {c: F.round(c, 6) for c in ("score_spread", "top_result_dominance", "uniformity")}
    )


@plan(
    "date_distribution",
    """
    WITH a AS (SELECT floor((epoch(TIMESTAMP '2001-06-01') - epoch(o_orderdate)) / 86400) AS days FROM orders)
    SELECT count(*) FILTER (days <= 30) AS recent, count(*) FILTER (days > 30 AND days <= 365) AS medium,
           count(*) FILTER (days > 365) AS old FROM a""",
)
def date_distribution(spark, d):
    return sl.date_distribution(table(spark, d, "orders"), "o_orderdate", "2001-06-01")


@plan(
    "log_search",
    rf"""
    WITH {SQL_LOGS}
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, message, row_number() OVER (ORDER BY ts DESC, event_id)::INT AS rank
    FROM logs WHERE regexp_matches(lower(message), '\bfailed\b') AND ts >= TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-25'
      AND upper(level) = 'ERROR' AND service = 'error' AND starts_with(client_ip, '10.0.1.')
    QUALIFY rank <= 100""",
)
def log_search(spark, d):
    """Failures of one network within a time range, newest first."""
    rows = logs(spark, d).withColumns(
        {"severe": F.upper("level") == "ERROR", "network": F.substring_index("client_ip", ".", 3)}
    )
    log = Corpus.analyze(rows, "event_id", {"message": "message"})
    from datetime import datetime

    query = q.Bool(
        must=(
            q.Term("message", "failed"),
            q.Range("ts", datetime(2024, 1, 10), datetime(2024, 1, 25)),
            q.TypedTerm("severe", "true"),
            q.TypedTerm("service", "error"),
            q.TypedTerm("network", "10.0.1"),
        )
    )
    found = q.match(log, query, scored=False).select(F.col("key").alias("event_id"))
    hits = rows.join(found, "event_id", "left_semi").select("event_id", "ts", "message")
    newest = sl.newest_first(hits, "ts", "event_id", 100)
    return newest.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "message", "rank"
    )
