"""Reports over search logs and application logs."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.functions.tokens import whitespace_tokens
from lexigrid.operators.ranking import best_first

# Report windows in hours, log levels, keyword rules in order.
WINDOWS = {"today": 24, "week": 7 * 24, "month": 30 * 24}
SEVERITY = {"ERROR": "high", "WARN": "medium", "INFO": "low", "DEBUG": "low"}
CATEGORIES = {
    "error": ["error", "exception", "failed"],
    "authentication": ["login", "auth", "session"],
    "http": ["request", "response", "http"],
    "database": ["database", "query", "sql"],
}
SIGNATURES = {
    "timeout_error": "timeout",
    "connection_error": "connection",
    "permission_error": "permission",
    "not_found_error": "not found",
}


def since(now: str, hours: int) -> Column:
    """Start of a window that ends at a given moment."""
    return F.timestamp_add("HOUR", F.lit(-hours), F.lit(now).cast("timestamp_ntz"))


def search_stats(searches: DataFrame, clicks: DataFrame, now: str) -> DataFrame:
    """(timeframe, searches, clicks, zero-result searches, mean results, click-through).

    ``searches`` is (query, ts, result_count) and ``clicks`` (query, ts).  Only clicks on a
    query searched in the same window count for click-through, so both logs are first counted
    per query, which folds a query with a third of all rows on the map side.
    """
    rows = searches.select("query", "ts", "result_count", F.lit(1).alias("is_search")).unionByName(
        clicks.select("query", "ts", F.lit(None).cast("bigint").alias("result_count"), F.lit(0).alias("is_search"))
    )
    per_query, totals = [], []
    for name, hours in WINDOWS.items():
        recent = F.col("ts") >= since(now, hours)
        search, click = recent & (F.col("is_search") == 1), recent & (F.col("is_search") == 0)
        per_query += [
            F.count_if(search).alias(f"{name}_s"),
            F.count_if(click).alias(f"{name}_c"),
            F.count_if(search & (F.col("result_count") == 0)).alias(f"{name}_z"),
            F.coalesce(F.sum(F.when(search, F.col("result_count"))), F.lit(0)).alias(f"{name}_r"),
        ]
        s, c = F.col(f"{name}_s"), F.col(f"{name}_c")
        totals += [
            F.sum(s).alias(f"{name}_s"),
            F.sum(c).alias(f"{name}_c"),
            F.sum(f"{name}_z").alias(f"{name}_z"),
            F.sum(f"{name}_r").alias(f"{name}_r"),
            F.sum(F.when(s > 0, c).otherwise(0)).alias(f"{name}_k"),
        ]
    one = rows.groupBy("query").agg(*per_query).agg(*totals)

    def ratio(above: Column, below: Column) -> Column:
        return F.when(below > 0, above / below).otherwise(0.0)

    lines = [
        F.struct(
            F.lit(name).alias("timeframe"),
            F.col(f"{name}_s").alias("total_searches"),
            F.col(f"{name}_c").alias("total_clicks"),
            F.col(f"{name}_z").alias("zero_result_searches"),
            ratio(F.col(f"{name}_r"), F.col(f"{name}_s")).alias("average_results"),
            ratio(F.col(f"{name}_k"), F.col(f"{name}_s")).alias("click_through_rate"),
        )
        for name in WINDOWS
    ]
    return one.select(F.inline(F.array(*lines)))


def hourly_response(searches: DataFrame, time: str, duration: str, slow_above: float) -> DataFrame:
    """(hour, searches, mean response time, slow queries)."""
    hour = F.date_format(F.date_trunc("hour", F.col(time)), "yyyy-MM-dd HH:mm")
    return searches.groupBy(hour.alias("hour")).agg(
        F.count(F.lit(1)).alias("total_searches"),
        F.avg(duration).alias("avg_response_time"),
        F.count_if(F.col(duration) > slow_above).alias("slow_queries"),
    )


def popular_queries(searches: DataFrame, limit: int = 10) -> DataFrame:
    """Most frequent queries, ties by text."""
    counts = searches.groupBy("query").agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc("query")]
    best = counts.orderBy(*order).limit(limit)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def zero_result_queries(searches: DataFrame, limit: int = 10) -> DataFrame:
    return popular_queries(searches.where(F.col("result_count") == 0), limit)


def severity(level: Column) -> Column:
    upper = F.upper(F.coalesce(level, F.lit("")))
    result = None
    for name, value in SEVERITY.items():
        result = F.when(upper == name, value) if result is None else result.when(upper == name, value)
    return result.otherwise("unknown")


def has_any(text: Column, words: list[str]) -> Column:
    return functools.reduce(operator.or_, [text.contains(w) for w in words])


def log_category(message: Column) -> Column:
    """First keyword rule that fits."""
    low = F.lower(F.coalesce(message, F.lit("")))
    result = None
    for name, words in CATEGORIES.items():
        test = has_any(low, words)
        result = F.when(test, name) if result is None else result.when(test, name)
    return result.otherwise("general")


def error_signature(message: Column) -> Column:
    text = F.coalesce(message, F.lit(""))
    result = None
    for name, word in SIGNATURES.items():
        test = text.contains(word)
        result = F.when(test, name) if result is None else result.when(test, name)
    return result.otherwise("generic_error")


def classify(logs: DataFrame, level: str, message: str) -> DataFrame:
    return logs.withColumns(
        {"severity": severity(F.col(level)), "category": log_category(F.col(message))}
    )


def related(logs: DataFrame, group: str) -> DataFrame:
    """Adds ``related_count``: other logs of the same request, null when there are none.

    Groups are counted with map-side combining and joined back; adaptive execution splits
    the join partition of a group that holds a large part of the log.
    """
    counts = logs.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    others = F.when(F.col("_n") > 1, F.col("_n") - 1)
    return logs.join(counts, group, "left").withColumn("related_count", others).drop("_n")


def log_patterns(logs: DataFrame, kind: str, column: str) -> DataFrame:
    """(type, pattern, count, rank): error signatures, or activity per address or service."""
    if kind == "error":
        name, pattern = "error", error_signature(F.col(column))
    elif kind in ("ip", "service"):
        name, pattern = f"{kind}_activity", F.col(column).cast("string")
    else:
        raise ValueError(f"unknown pattern: {kind}")
    counts = (
        logs.select(pattern.alias("pattern"))
        .where(F.col("pattern").isNotNull())
        .groupBy("pattern")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return counts.select(F.lit(name).alias("type"), "pattern", "count")


def query_profile(text: Column) -> dict[str, Column]:
    """Length, words, special characters, type and complexity of a query text."""
    words = F.size(whitespace_tokens(text))
    kind = (
        F.when(text.rlike("[\"']"), "phrase_query")
        .when(text.rlike("AND|OR|NOT"), "boolean_query")
        .when(text.contains("*"), "wildcard_query")
        .when(words == 1, "single_term")
        .otherwise("multi_term")
    )

    def point(pattern: str, points: int) -> Column:
        return F.when(text.rlike(pattern), points).otherwise(0)

    return {
        "query_length": F.length(text),
        "word_count": words,
        "has_special_chars": text.rlike(r"[^a-zA-Z0-9\s]"),
        "query_type": kind,
        "complexity": words + point("[\"']", 2) + point("(?i)AND|OR|NOT", 3) + point(r"\*", 1) + point("[0-9]", 1),
    }


def result_quality(hits: DataFrame) -> DataFrame:
    """Spread, dominance, shape and label of each query's scores.

    Best and second best come from a ranking that keeps two rows per query and task before
    the shuffle; everything else folds on the map side.
    """
    base = hits.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("total_results"),
        F.max("score").alias("best"),
        F.min("score").alias("worst"),
        F.avg("score").alias("mean"),
        F.var_pop("score").alias("variance"),
    )
    order = Window.partitionBy("query_id").orderBy(*best_first())
    two = hits.withColumn("place", F.row_number().over(order)).where(F.col("place") <= 2)
    second = two.groupBy("query_id").agg(
        F.max(F.when(F.col("place") == 2, F.col("score"))).alias("second")
    )
    best, mean = F.col("best"), F.col("mean")
    label = (
        F.when((best > 2.0) & (mean > 0.8), "excellent")
        .when((best > 1.5) & (mean > 0.5), "good")
        .when((best > 1.0) & (mean > 0.3), "fair")
        .otherwise("poor")
    )
    shape = (
        F.when(F.col("second").isNull(), "single")
        .when(best > F.col("second") * 1.5, "dominant_leader")
        .otherwise("competitive")
    )
    return base.join(second, "query_id").select(
        "query_id",
        "total_results",
        (best - F.col("worst")).alias("score_spread"),
        F.coalesce(best / F.col("second"), F.lit(1.0)).alias("top_result_dominance"),
        F.when(F.col("total_results") < 2, 1.0).otherwise(1 / (1 + F.col("variance"))).alias("uniformity"),
        shape.alias("distribution_type"),
        label.alias("relevance_quality"),
    )


def date_distribution(hits: DataFrame, date: str, now: str) -> DataFrame:
    """Hits by age: up to 30 days, up to a year, older; hits without a date are left out."""
    seconds = F.timestamp_diff("SECOND", F.col(date), F.lit(now).cast("timestamp_ntz"))
    days = F.floor(seconds / 86400)
    return hits.agg(
        F.count_if(days <= 30).alias("recent"),
        F.count_if((days > 30) & (days <= 365)).alias("medium"),
        F.count_if(days > 365).alias("old"),
    )


def newest_first(logs: DataFrame, time: str, key: str, limit: int) -> DataFrame:
    order = [F.desc(time), F.asc(key)]
    return logs.orderBy(*order).limit(limit).withColumn(
        "rank", F.row_number().over(Window.orderBy(*order))
    )
