"""Scoring, top-k, batch search and storefront ranking queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.functions import tokens as tk
from lexigrid.operators import postings as ps
from lexigrid.operators import queries as q
from lexigrid.operators import ranking as rk
from lexigrid.plans.catalog import (
    SQL_STATS,
    SQL_TOKENS,
    corpus,
    documents,
    plan,
    sql_bm25,
    stored_postings,
    table,
)
from lexigrid.plans.query_plans import hits, term_cte
from lexigrid.session import shared_folder

TERMS = "thing with from"
SQL_ANY = f"""
    WITH {SQL_STATS}, {term_cte('a', 'thing')}, {term_cte('b', 'with')}, {term_cte('c', 'from')},
    found AS (SELECT doc_id, sum(score) AS score
              FROM (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c) GROUP BY doc_id)"""


def found_by_any(spark, d) -> DataFrame:
    """(key, score) of documents holding any of three terms."""
    return q.match(corpus(spark, d), q.any_terms("text", TERMS))


@plan("bm25", f"{SQL_ANY} SELECT doc_id, round(score, 6) AS score FROM found")
def bm25(spark, d):
    return hits(found_by_any(spark, d))


@plan(
    "tfidf",
    f"""
    WITH {SQL_TOKENS},
    post AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term),
    freq AS (SELECT term, count(*) AS df FROM post GROUP BY term),
    weights AS (SELECT doc_id, term, tf * ln((SELECT count(*) FROM documents) / df) AS w FROM post JOIN freq USING (term)),
    normed AS (SELECT *, sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS norm FROM weights)
    SELECT doc_id, round(sum(w), 6) AS raw, round(sum(w) / max(norm), 6) AS score FROM normed
    WHERE term IN ('thing', 'with', 'from', 'tion') GROUP BY doc_id""",
)
def tfidf(spark, d):
    """Raw sums, and sums over the documents' stored norms."""
    docs = corpus(spark, d)
    n_docs, _ = docs.stats("text")
    terms = ["thing", "with", "from", "tion"]
    index = ps.postings_of(docs, terms)
    raw = rk.tfidf(index, docs.terms, n_docs, terms, normalize=False).withColumnRenamed("score", "raw")
    normal = rk.tfidf(index, docs.terms, n_docs, terms, norms=docs.norms)
    return raw.join(normal, "key").select(
        F.col("key").alias("doc_id"), F.round("raw", 6).alias("raw"), F.round("score", 6).alias("score")
    )


@plan(
    "formula_score",
    f"""
    {SQL_ANY} SELECT doc_id, round(score * (1 + coalesce(quality, 0)) / (1 + coalesce(toxic, 0)), 6) AS score
    FROM found LEFT JOIN labels USING (doc_id)""",
)
def formula_score(spark, d):
    """A score formula over document columns: quality doubles, toxicity halves."""
    labels = table(spark, d, "labels").withColumnRenamed("doc_id", "key")
    joined = found_by_any(spark, d).join(labels, "key", "left")
    boost = (1 + F.coalesce("quality", F.lit(0))) / (1 + F.coalesce("toxic", F.lit(0)))
    return hits(joined.withColumn("score", F.col("score") * boost))


@plan(
    "field_boost",
    f"""
    WITH {SQL_STATS}, {term_cte('a', 'thing')},
    s AS (SELECT count(*) AS n, 1.0 AS avgdl FROM documents),
    b AS (SELECT doc_id, ln(1 + (s.n - df + 0.5) / (df + 0.5)) AS score
          FROM documents, s, (SELECT count(*) AS df FROM documents WHERE source = 'src3') WHERE source = 'src3')
    SELECT doc_id, round(coalesce(a.score, 0) + 3 * coalesce(b.score, 0), 6) AS score
    FROM a FULL JOIN b USING (doc_id)""",
)
def field_boost(spark, d):
    """Two fields, the source weighted three times."""
    docs = ps.Corpus.analyze(documents(spark, d), "doc_id", {"text": "text", "source": "source"})
    query = q.Bool(should=(q.Term("text", "thing"), q.Boost(q.Term("source", "src3"), 3.0)))
    return hits(q.match(docs, query))


@plan(
    "combined_score",
    f"""
    {SQL_ANY},
    freq AS (SELECT doc_id, count(*) AS tf FROM toks WHERE term = 'thing' GROUP BY doc_id),
    parts AS (SELECT doc_id, 0.7 * score AS s FROM found
              UNION ALL SELECT doc_id, 0.2 * tf FROM freq
              UNION ALL SELECT doc_id, 0.1 * quality FROM labels)
    SELECT doc_id, round(sum(s), 6) AS score FROM parts GROUP BY doc_id""",
)
def combined_score(spark, d):
    """Weighted sum of BM25, a term count and a quality label."""
    docs = corpus(spark, d)
    counted = docs.occurrences.where(F.col("term") == "thing").groupBy("key").agg(
        F.sum("tf").cast("double").alias("score")
    )
    quality = table(spark, d, "labels").select(
        F.col("doc_id").alias("key"), F.col("quality").cast("double").alias("score")
    )
    bm = q.match(docs, q.any_terms("text", TERMS))
    return hits(rk.combine_scores([(bm, 0.7), (counted, 0.2), (quality, 0.1)]))


SQL_TOP = f"""
    {SQL_ANY}, best AS (SELECT doc_id, score, row_number() OVER (ORDER BY round(score, 9) DESC, doc_id) AS rank
                        FROM found QUALIFY rank <= 10)"""


@plan("top_k", f"{SQL_TOP} SELECT doc_id, round(score, 6) AS score, rank::INT AS rank FROM best")
def top_k(spark, d):
    best = rk.top_k(found_by_any(spark, d), 10)
    return best.select(F.col("key").alias("doc_id"), F.round("score", 6).alias("score"), "rank")


@plan("search_ids", f"{SQL_TOP} SELECT doc_id FROM best")
def search_ids(spark, d):
    return rk.top_k(found_by_any(spark, d), 10).select(F.col("key").alias("doc_id"))


@plan(
    "search_documents",
    f"""
    {SQL_TOP} SELECT doc_id, rank::INT AS rank, round(score, 6) AS score, d.lang, d.source, d.n_chars, d.text
    FROM best JOIN documents d USING (doc_id)""",
)
def search_documents(spark, d):
    columns = ["lang", "source", "n_chars", "text"]
    full = rk.fetch_top(found_by_any(spark, d), table(spark, d, "documents"), "doc_id", columns, 10)
    return full.select(
        F.col("key").alias("doc_id"), "rank", F.round("score", 6).alias("score"), *columns
    )


@plan("indexed_search", f"{SQL_TOP} SELECT doc_id, round(score, 6) AS score, rank::INT AS rank FROM best")
def indexed_search(spark, d):
    """The same top ten from an index on disk, reading only the buckets of the three terms."""
    path = shared_folder(spark, "index")
    texts = table(spark, d, "documents")
    ps.save_index(ps.Corpus.analyze(texts, "doc_id", {"text": "text"}), path, tokens_per_bucket=100_000)
    docs = ps.load_index(texts, "doc_id", path)
    best = rk.top_k(q.match(docs, q.any_terms("text", TERMS)), 10)
    return best.select(F.col("key").alias("doc_id"), F.round("score", 6).alias("score"), "rank")


def query_table(spark, d) -> DataFrame:
    """(query_id, term): every benchmark passage and every user turn as a query."""
    items = table(spark, d, "benchmark").select(
        F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("query_id"), "text"
    )
    turns = table(spark, d, "conversations").where(F.col("role") == "user").select(
        F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("query_id"), "text"
    )
    both = items.unionByName(turns)
    return both.select("query_id", F.explode(tk.SEARCH.tokens(F.col("text"))).alias("term")).distinct()


@plan(
    "batch_search",
    rf"""
    WITH {SQL_STATS},
    texts AS (
        SELECT 'b' || item_id AS query_id, text FROM benchmark
        UNION ALL SELECT 'c-' || conv_id || '-' || turn, text FROM conversations WHERE role = 'user'),
    words AS (
        SELECT DISTINCT query_id, term FROM (
            SELECT query_id, unnest(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+')) AS term FROM texts)
        WHERE term <> '' AND octet_length(encode(term)) < 40),
    size AS (SELECT query_id, count(*) AS n_terms FROM words GROUP BY query_id),
    post AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term),
    freq AS (SELECT term, count(*) AS df FROM post GROUP BY term),
    scored AS (
        SELECT query_id, p.doc_id, sum({sql_bm25('p.tf', 'df')}) AS score
        FROM words JOIN post p USING (term) JOIN freq USING (term) JOIN lens USING (doc_id) JOIN size USING (query_id), coll
        GROUP BY query_id, p.doc_id, n_terms HAVING count(*) = n_terms),
    best AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM scored)
    SELECT query_id, doc_id, rank::INT AS rank, round(score, 6) AS score FROM best WHERE rank <= 10""",
)
def batch_search(spark, d):
    """All passages and user turns as AND queries over all documents in one job."""
    docs = corpus(spark, d)
    index = stored_postings(spark, d)
    found = rk.batch_search(query_table(spark, d), index, *docs.stats("text"), k=10, stats=docs.terms)
    return found.select(
        "query_id", F.col("key").alias("doc_id"), "rank", F.round("score", 6).alias("score")
    )


@plan(
    "term_frequency_rank",
    """
    SELECT doc_id, (len(string_split(lower(text), 'thing')) - 1 + len(string_split(lower(text), 'with')) - 1)::DOUBLE
           + 2.0 * (len(string_split(lower(source), 'src1')) - 1) AS score
    FROM documents""",
)
def term_frequency_rank(spark, d):
    docs = documents(spark, d)
    score = rk.term_frequency_score({"text": 1.0}, ["thing", "with"]) + rk.term_frequency_score(
        {"source": 2.0}, ["src1"]
    )
    return docs.select("doc_id", score.alias("score"))


@plan(
    "custom_sort",
    """
    SELECT o_orderkey, row_number() OVER (ORDER BY coalesce(o_orderdate, TIMESTAMP '1970-01-01') DESC, o_orderkey)::INT AS rank
    FROM orders QUALIFY rank <= 50""",
)
def custom_sort(spark, d):
    """Newest orders first, ties by key."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    newest = rk.sort_hits(orders, "o_orderdate", key="o_orderkey").limit(50)
    order = Window.orderBy(F.desc(F.coalesce("o_orderdate", F.lit("1970-01-01").cast("timestamp_ntz"))), "o_orderkey")
    return newest.select("o_orderkey", F.row_number().over(order).alias("rank"))


def sharded(spark, d) -> DataFrame:
    docs = corpus(spark, d)
    found = q.match(docs, q.any_terms("text", TERMS))
    shards = table(spark, d, "documents").select(
        F.col("doc_id").alias("key"),
        F.col("source").alias("shard"),
        F.regexp_replace("source", "[^0-9]", "").cast("int").alias("shard_no"),
    )
    return found.join(shards, "key")


SQL_SHARDS = f"""
    {SQL_ANY}, hits AS (
        SELECT f.doc_id, score, d.source AS shard, regexp_replace(d.source, '[^0-9]', '', 'g')::INT AS shard_no,
               row_number() OVER (PARTITION BY d.source ORDER BY round(score, 9) DESC, f.doc_id) AS down,
               row_number() OVER (PARTITION BY d.source ORDER BY round(score, 9), f.doc_id) AS up
        FROM found f JOIN documents d USING (doc_id)),
    merged AS (
        SELECT 'score_desc' AS strategy, *, row_number() OVER (ORDER BY round(score, 9) DESC, doc_id) AS rank FROM hits
        UNION ALL SELECT 'score_asc', *, row_number() OVER (ORDER BY round(score, 9), doc_id) FROM hits
        UNION ALL SELECT 'node_order', *, row_number() OVER (ORDER BY shard_no, down) FROM hits
        UNION ALL SELECT 'round_robin', *, row_number() OVER (ORDER BY down, shard_no) FROM hits)"""


@plan(
    "merge_shards",
    f"{SQL_SHARDS} SELECT strategy, rank::INT AS rank, doc_id, shard FROM merged WHERE rank > 5 AND rank <= 30",
)
def merge_shards(spark, d):
    """Hits of all sources as shards, merged in each of the four orders."""
    found = sharded(spark, d)
    merged = [
        rk.merge_sharded(found, s, limit=25, offset=5).select(
            F.lit(s).alias("strategy"), "rank", F.col("key").alias("doc_id"), "shard"
        )
        for s in ("score_desc", "score_asc", "node_order", "round_robin")
    ]
    result = merged[0]
    for part in merged[1:]:
        result = result.unionByName(part)
    return result


@plan(
    "shard_summary",
    f"{SQL_SHARDS} SELECT shard, count(*) AS total_hits, round(max(score), 6) AS max_score FROM hits GROUP BY shard",
)
def shard_summary(spark, d):
    return rk.shard_summary(sharded(spark, d)).withColumn("max_score", F.round("max_score", 6))


@plan(
    "freshness_engagement_rank",
    """
    WITH u AS (
        SELECT user_id, max(ts) AS last_ts, count(*) FILTER (event_type = 'view') AS views,
               count(*) FILTER (event_type = 'click') AS comments, count(*) FILTER (event_type = 'purchase') AS shares
        FROM events GROUP BY user_id),
    s AS (SELECT user_id, greatest(0, 100 - floor((epoch(TIMESTAMP '2024-04-01') - epoch(last_ts)) / 86400)::BIGINT) AS freshness,
                 views + 5 * comments + 10 * shares AS engagement FROM u)
    SELECT user_id, freshness, engagement, row_number() OVER (ORDER BY freshness + engagement DESC, user_id)::INT AS rank
    FROM s QUALIFY rank <= 100""",
)
def freshness_engagement_rank(spark, d):
    """Users by freshness of their last event plus weighted engagement, as of 2024-04-01."""
    kind = F.col("event_type")
    users = table(spark, d, "events").groupBy("user_id").agg(
        F.max("ts").alias("last_ts"),
        F.count_if(kind == "view").alias("views"),
        F.count_if(kind == "click").alias("comments"),
        F.count_if(kind == "purchase").alias("shares"),
    )
    scored = users.select(
        "user_id",
        rk.freshness_points("last_ts", "2024-04-01").alias("freshness"),
        rk.engagement_points("views", "comments", "shares").alias("engagement"),
    ).withColumn("score", F.col("freshness") + F.col("engagement"))
    best = rk.top_k(scored.withColumnRenamed("user_id", "key"), 100)
    return best.select(F.col("key").alias("user_id"), "freshness", "engagement", "rank")


@plan(
    "storefront_rank",
    """
    WITH p AS (
        SELECT *, p_size - 10 AS stock, (p_partkey % 50) / 10.0 AS rating, p_type = 'PROMO' AS featured FROM part),
    s AS (SELECT *, CASE WHEN stock > 10 THEN 'in_stock' WHEN stock > 0 THEN 'low_stock' ELSE 'out_of_stock' END AS status FROM p),
    r AS (SELECT *, CASE status WHEN 'in_stock' THEN 1000 WHEN 'low_stock' THEN 500 ELSE 0 END + rating * 100 AS points FROM s)
    SELECT p_partkey, status,
           CASE status WHEN 'in_stock' THEN '1-2 days' WHEN 'low_stock' THEN '3-5 days' ELSE 'Not available' END AS shipping,
           concat_ws(',', CASE WHEN p_retailprice - 900 < 25 THEN 'budget_friendly' END,
                     CASE WHEN status = 'in_stock' THEN 'available' END, CASE WHEN rating > 4.5 THEN 'top_rated' END) AS tags,
           row_number() OVER (ORDER BY featured DESC, points DESC, p_partkey)::INT AS rank
    FROM r QUALIFY rank <= 200""",
)
def storefront_rank(spark, d):
    """Featured first, then stock status plus rating; stock and rating derive from part columns."""
    part = table(spark, d, "part").select(
        F.col("p_partkey").alias("key"),
        (F.col("p_size") - 10).alias("stock"),
        ((F.col("p_partkey") % 50) / 10).alias("rating"),
        (F.col("p_retailprice") - 900).alias("price"),
        (F.col("p_type") == "PROMO").alias("featured"),
    )
    return rk.storefront_rank(part, limit=200).select(
        F.col("key").alias("p_partkey"), "status", "shipping", F.array_join("tags", ",").alias("tags"), "rank"
    )
