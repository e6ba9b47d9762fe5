"""Result processing queries: conversion, marks, pages, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.functions import marks as mk
from lexigrid.operators import queries as q
from lexigrid.operators import ranking as rk
from lexigrid.operators import results as rs
from lexigrid.plans.catalog import SQL_STATS, corpus, documents, plan, table
from lexigrid.plans.query_plans import term_cte
from lexigrid.plans.ranking_plans import SQL_ANY, found_by_any

MARKED = ["thing", "with"]


@plan(
    "convert_result_types",
    """
    SELECT event_id, coalesce(try_cast(regexp_extract(props, ': ([0-9]+)', 1) AS BIGINT), 0) AS k,
           coalesce(value, 0.0) AS value, event_type = 'purchase' AS bought, 0::BIGINT AS kind,
           strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts
    FROM events""",
)
def convert_result_types(spark, d):
    """Event values read as text and converted back by a declared schema."""
    raw = table(spark, d, "events").select(
        F.col("event_id"),
        F.get_json_object("props", "$.k").alias("k"),
        F.col("value").cast("string").alias("value"),
        F.when(F.col("event_type") == "purchase", "Yes").otherwise("no").alias("bought"),
        F.col("event_type").alias("kind"),
        F.col("ts").cast("string").alias("ts"),
    )
    schema = {"k": "u64", "value": "f64", "bought": "bool", "kind": "i64", "ts": "date"}
    return rs.convert_types(raw, schema)


@plan(
    "normalize_scores",
    f"""
    WITH {SQL_STATS}, {term_cte('a', 'thing')}, {term_cte('b', 'und')}, {term_cte('c', 'the')},
    hits AS (SELECT 'thing' AS query_id, * FROM a UNION ALL SELECT 'und', * FROM b UNION ALL SELECT 'the', * FROM c)
    SELECT query_id, doc_id, round(score / max(score) OVER (PARTITION BY query_id), 4) AS normalized_score FROM hits""",
)
def normalize_scores(spark, d):
    queries = {word: q.Term("text", word) for word in ("thing", "und", "the")}
    hits = q.match_many(corpus(spark, d), queries)
    return rs.normalize_scores(hits, "query_id").select(
        "query_id", F.col("key").alias("doc_id"), "normalized_score"
    )


@plan(
    "highlight",
    r"""
    WITH pieces AS (
        SELECT doc_id, term, unnest(p) AS piece, generate_subscripts(p, 1) AS i, len(p) AS n
        FROM (SELECT doc_id, term, string_split(lower(text), term) AS p
              FROM documents, (VALUES ('thing'), ('with')) t(term))),
    spots AS (
        SELECT doc_id, term, i, n, sum(length(piece)) OVER (PARTITION BY doc_id, term ORDER BY i)
               + (i - 1) * length(term) AS pos FROM pieces),
    five AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS r FROM spots WHERE i < n QUALIFY r <= 5),
    cut AS (
        SELECT doc_id, r, regexp_replace(substring(text, (greatest(pos - 50, 0) + 1)::BIGINT,
                   (least(pos + 50, length(text)) - greatest(pos - 50, 0))::BIGINT),
                   '(thing|with)', '<mark>\1</mark>', 'gi') AS passage
        FROM five JOIN documents USING (doc_id)),
    firsts AS (SELECT doc_id, passage, min(r) AS r FROM cut GROUP BY doc_id, passage)
    SELECT d.doc_id, coalesce(string_agg(passage, ' | ' ORDER BY r), '') AS highlights
    FROM documents d LEFT JOIN firsts f ON f.doc_id = d.doc_id GROUP BY d.doc_id""",
)
def highlight(spark, d):
    marked = mk.highlight(documents(spark, d), "text", MARKED)
    return marked.select("doc_id", F.array_join("highlights", " | ").alias("highlights"))


@plan(
    "snippet",
    r"""
    WITH f AS (
        SELECT *, least(nullif(strpos(lower(text), 'thing'), 0), nullif(strpos(lower(text), 'with'), 0)) AS spot FROM documents),
    s AS (SELECT *, greatest(coalesce(spot, 1) - 1 - 100, 0) AS start FROM f),
    w AS (SELECT *, regexp_replace(substring(text, start + 1, 200), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS win FROM s)
    SELECT doc_id, CASE WHEN length(text) <= 200 THEN text ELSE
        CASE WHEN start > 0 THEN '...' ELSE '' END
        || regexp_replace(regexp_replace(win, '^\S*\s+', ''), '\s+\S*$', '')
        || CASE WHEN start + 200 < length(text) THEN '...' ELSE '' END END AS snippet
    FROM w""",
)
def snippet(spark, d):
    return documents(spark, d).select("doc_id", mk.snippet(F.col("text"), MARKED).alias("snippet"))


@plan(
    "hit_metadata",
    f"""
    {SQL_ANY}, best AS (SELECT doc_id, score, row_number() OVER (ORDER BY round(score, 9) DESC, doc_id) AS position
                        FROM found QUALIFY position <= 200)
    SELECT doc_id, position::INT AS position,
           CASE WHEN score >= 0.8 THEN 'high' WHEN score >= 0.5 THEN 'medium' ELSE 'low' END AS relevance_tier,
           2::INT AS field_count
    FROM best""",
)
def hit_metadata(spark, d):
    best = rk.top_k(found_by_any(spark, d), 200)
    full = rk.with_documents(best, table(spark, d, "documents"), "doc_id", ["lang", "source"])
    return rs.hit_metadata(full).select(
        F.col("key").alias("doc_id"), "position", "relevance_tier", "field_count"
    )


SQL_RANKED = f"""
    {SQL_ANY}, ranked AS (SELECT doc_id, score, row_number() OVER (ORDER BY round(score, 9) DESC, doc_id) AS rank FROM found)"""


@plan(
    "paginate",
    f"{SQL_RANKED} SELECT doc_id, rank::INT AS position, round(score, 6) AS score FROM ranked WHERE rank BETWEEN 41 AND 60",
)
def paginate(spark, d):
    return rs.paginate(found_by_any(spark, d), page=3, per_page=20).select(
        F.col("key").alias("doc_id"), "position", F.round("score", 6).alias("score")
    )


@plan(
    "page_info",
    f"""
    {SQL_ANY}, n AS (SELECT count(*) AS total_count FROM found)
    SELECT total_count, 3::INT AS current_page, 20::INT AS per_page, ceil(total_count / 20)::BIGINT AS total_pages,
           3 < ceil(total_count / 20) AS has_next, true AS has_prev, 41::INT AS start_index,
           least(60, total_count)::BIGINT AS end_index FROM n""",
)
def page_info(spark, d):
    return rs.page_info(found_by_any(spark, d), page=3, per_page=20)


@plan(
    "paginate_cursor",
    f"""
    {SQL_RANKED}
    SELECT doc_id, rank::INT AS position, round(score, 6) AS score, true AS has_more FROM ranked
    WHERE rank > (SELECT count(*) FROM ranked WHERE round(score, 9) > 2.0)
      AND rank <= (SELECT count(*) FROM ranked WHERE round(score, 9) > 2.0) + 20""",
)
def paginate_cursor(spark, d):
    """The page that follows score 2.0; positions are counted in the whole result."""
    found = found_by_any(spark, d)
    page = rs.after_cursor(found, (2.0, -1), per_page=20)
    earlier = found.where(F.round("score", 9) > 2.0).agg(F.count(F.lit(1))).scalar()
    return page.select(
        F.col("key").alias("doc_id"),
        (F.col("position") + earlier).cast("int").alias("position"),
        F.round("score", 6).alias("score"),
        "has_more",
    )


@plan(
    "result_summary",
    f"""
    {SQL_ANY} SELECT 'thing with from' AS query, count(*) AS total, round(coalesce(max(score), 0), 6) AS max_score,
              round(coalesce(min(score), 0), 6) AS min_score, round(coalesce(avg(score), 0), 6) AS avg_score FROM found""",
)
def result_summary(spark, d):
    row = rs.result_summary(found_by_any(spark, d), query="thing with from")
    scores = {c: F.round(c, 6) for c in ("max_score", "min_score", "avg_score")}
    return row.withColumns(scores)


@plan(
    "score_distribution",
    f"""
    {SQL_ANY} SELECT count(*) FILTER (score >= 0.8) AS high, count(*) FILTER (score >= 0.5 AND score < 0.8) AS medium,
              count(*) FILTER (score < 0.5) AS low, round(coalesce(avg(score), 0), 3) AS avg_score FROM found""",
)
def score_distribution(spark, d):
    return rs.score_distribution(found_by_any(spark, d))


@plan(
    "enrich_hits",
    r"""
    WITH w AS (SELECT *, len(list_filter(string_split_regex(text, '[\s\p{Z}]+'), lambda x: x <> '')) AS words FROM documents)
    SELECT doc_id, greatest(1, words // 200)::INT AS reading_minutes,
           regexp_replace(substring(text, 1, 200), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') || '...' AS excerpt,
           CASE WHEN length(text) < 500 THEN 'snippet' WHEN length(text) > 2000 THEN 'article' ELSE 'general' END AS content_type,
           (len(string_split(lower(text), 'thing')) - 1)::INT AS n_thing, (len(string_split(lower(text), 'with')) - 1)::INT AS n_with
    FROM w""",
)
def enrich_hits(spark, d):
    rich = rs.enrich(documents(spark, d), "text", MARKED)
    return rich.select("doc_id", "reading_minutes", "excerpt", "content_type", "n_thing", "n_with")


@plan(
    "freshness_tiers",
    """
    WITH a AS (SELECT o_orderkey, floor((epoch(TIMESTAMP '2001-06-01') - epoch(o_orderdate)) / 86400)::BIGINT AS days FROM orders)
    SELECT o_orderkey, days, CASE WHEN days IS NULL THEN 0.5 WHEN days <= 7 THEN 1.0 WHEN days <= 30 THEN 0.8
        WHEN days <= 90 THEN 0.6 WHEN days <= 365 THEN 0.4 ELSE 0.2 END::DOUBLE AS freshness FROM a""",
)
def freshness_tiers(spark, d):
    """Age and freshness tier of every order as of 2001-06-01."""
    now = F.lit("2001-06-01").cast("timestamp_ntz")
    days = F.floor(F.timestamp_diff("SECOND", F.col("o_orderdate"), now) / 86400)
    aged = table(spark, d, "orders").select("o_orderkey", days.alias("days"))
    return aged.withColumn("freshness", rs.freshness(F.col("days")).cast("double"))


@plan(
    "clustered_snippets",
    r"""
    WITH pieces AS (
        SELECT doc_id, term, unnest(p) AS piece, generate_subscripts(p, 1) AS i, len(p) AS n
        FROM (SELECT doc_id, term, string_split(lower(text), term) AS p
              FROM documents, (VALUES ('thing'), ('with')) t(term))),
    spots AS (
        SELECT doc_id, term, i, n, sum(length(piece)) OVER (PARTITION BY doc_id, term ORDER BY i)
               + (i - 1) * length(term) AS start FROM pieces),
    occ AS (SELECT doc_id, length(term) AS w, start, start + length(term) AS stop FROM spots WHERE i < n),
    gaps AS (SELECT *, CASE WHEN stop - lag(stop) OVER (PARTITION BY doc_id ORDER BY start) <= 150 THEN 0 ELSE 1 END AS opens FROM occ),
    num AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY start) AS cluster FROM gaps),
    clus AS (SELECT doc_id, cluster, min(start)::BIGINT AS start, max(stop)::BIGINT AS stop, sum(w)::BIGINT AS score FROM num GROUP BY 1, 2),
    best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, start) AS rank FROM clus QUALIFY rank <= 3),
    edge AS (SELECT b.*, text, greatest(start - 30, 0) AS l, least(stop + 30, length(text)) AS r,
                    greatest((start + stop) // 2 - 75, 0) AS ml FROM best b JOIN documents USING (doc_id))
    SELECT doc_id, rank::INT AS rank, score, regexp_replace(CASE WHEN r - l > 150
               THEN substring(text, ml + 1, least(ml + 150, length(text)) - ml) ELSE substring(text, l + 1, r - l) END,
               '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS snippet
    FROM edge""",
)
def clustered_snippets(spark, d):
    found = mk.clustered_snippets(documents(spark, d), "doc_id", "text", MARKED)
    return found.select(F.col("key").alias("doc_id"), "rank", "score", "snippet")


@plan(
    "relevance_categories",
    f"""
    {SQL_ANY}, p AS (SELECT 100 * score / max(score) OVER () AS percent FROM found)
    SELECT CASE WHEN percent >= 80 THEN 'highly_relevant' WHEN percent >= 50 THEN 'moderately_relevant'
                WHEN percent >= 20 THEN 'somewhat_relevant' ELSE 'low_relevance' END AS category,
           count(*) AS n, round(avg(percent), 4) AS avg_percent
    FROM p GROUP BY 1""",
)
def relevance_categories(spark, d):
    found = found_by_any(spark, d)
    best = found.agg(F.max("score")).scalar()
    percent = found.select((100 * F.col("score") / best).alias("percent"))
    banded = percent.withColumn("category", rs.relevance_band(F.col("percent")))
    return banded.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("percent"), 4).alias("avg_percent")
    )


@plan(
    "result_facets",
    """
    SELECT 'p_type' AS field, p_type AS value, count(*) AS count FROM part GROUP BY 2
    UNION ALL SELECT 'p_size', CASE WHEN p_size < 25 THEN '0-25' WHEN p_size < 50 THEN '25-50' WHEN p_size < 100 THEN '50-100' ELSE '100+' END,
        count(*) FROM part WHERE p_size IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'price', CASE WHEN p_retailprice - 900 < 25 THEN '0-25' WHEN p_retailprice - 900 < 50 THEN '25-50'
        WHEN p_retailprice - 900 < 100 THEN '50-100' ELSE '100+' END, count(*) FROM part GROUP BY 2""",
)
def result_facets(spark, d):
    part = table(spark, d, "part").withColumn("price", F.col("p_retailprice") - 900)
    return rs.result_facets(part, ["p_type", "p_size", "price"])


@plan(
    "storefront_facets",
    """
    WITH p AS (SELECT p_type, (p_retailprice - 900) * 2.5 AS price, p_size / 10.0 AS rating, p_size - 5 AS stock FROM part)
    SELECT 'categories' AS facet, p_type AS value, count(*) AS count FROM p GROUP BY 2
    UNION ALL SELECT 'price_ranges', 'Under $25', count(*) FILTER (price < 25) FROM p
    UNION ALL SELECT 'price_ranges', '$25 - $50', count(*) FILTER (price >= 25 AND price < 50) FROM p
    UNION ALL SELECT 'price_ranges', '$50 - $100', count(*) FILTER (price >= 50 AND price < 100) FROM p
    UNION ALL SELECT 'price_ranges', '$100 - $200', count(*) FILTER (price >= 100 AND price < 200) FROM p
    UNION ALL SELECT 'price_ranges', 'Over $200', count(*) FILTER (price >= 200) FROM p
    UNION ALL SELECT 'ratings', s || ' stars & up', count(*) FILTER (rating >= s AND rating < s + 1) FROM p, range(1, 6) t(s) GROUP BY s
    UNION ALL SELECT 'availability', 'In Stock', count(*) FILTER (stock > 0) FROM p
    UNION ALL SELECT 'availability', 'Out of Stock', count(*) FILTER (stock <= 0) FROM p""",
)
def storefront_facets(spark, d):
    """Price, rating and stock derive from part columns."""
    part = table(spark, d, "part").select(
        "p_type",
        ((F.col("p_retailprice") - 900) * 2.5).alias("price"),
        (F.col("p_size") / 10).alias("rating"),
        (F.col("p_size") - 5).alias("stock"),
    )
    return rs.storefront_facets(part, "p_type", "price", "rating", "stock")


@plan(
    "field_summary",
    """
    WITH v AS (SELECT 'o_orderstatus' AS field, o_orderstatus AS value FROM orders
               UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders
               UNION ALL SELECT 'o_custkey', o_custkey::VARCHAR FROM orders),
    c AS (SELECT field, value, count(*) AS count FROM v WHERE value IS NOT NULL GROUP BY 1, 2)
    SELECT field, value, count, sum(count) OVER (PARTITION BY field)::BIGINT AS total_values,
           count(*) OVER (PARTITION BY field) AS unique_values,
           row_number() OVER (PARTITION BY field ORDER BY count DESC, value)::INT AS rank
    FROM c QUALIFY rank <= 10""",
)
def field_summary(spark, d):
    return rs.field_summary(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority", "o_custkey"])


@plan(
    "score_statistics",
    """
    SELECT count(*) AS total_results, min(o_totalprice) AS min_score, max(o_totalprice) AS max_score,
           round(avg(o_totalprice), 4) AS avg_score, round(median(o_totalprice), 4) AS median_score FROM orders""",
)
def score_statistics(spark, d):
    row = rs.score_statistics(table(spark, d, "orders"), "o_totalprice")
    return row.withColumns({c: F.round(c, 4) for c in ("avg_score", "median_score")})
