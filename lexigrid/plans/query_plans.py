"""Query type queries: who matches, with which score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.functions import tokens as tk
from lexigrid.operators import facets as fc
from lexigrid.operators import fallback as fb
from lexigrid.operators import postings as ps
from lexigrid.operators import queries as q
from lexigrid.operators import ranking as rk
from lexigrid.operators import vocabulary as vc
from lexigrid.plans.catalog import (
    SQL_STATS,
    SQL_TOKENS,
    WORDS,
    corpus,
    documents,
    plan,
    sql_bm25,
    stored_postings,
    table,
)


def hits(matches: DataFrame, key: str = "doc_id") -> DataFrame:
    return matches.select(F.col("key").alias(key), F.round("score", 6).alias("score"))


def term_cte(name: str, word: str) -> str:
    """Scores of one term as a SQL common table expression."""
    return f"""
    {name} AS (
        SELECT doc_id, {sql_bm25("tf", "df")} AS score
        FROM (SELECT doc_id, count(*) AS tf FROM toks WHERE term = '{word}' GROUP BY doc_id)
        JOIN lens USING (doc_id), coll,
             (SELECT count(DISTINCT doc_id) AS df FROM toks WHERE term = '{word}'))"""


def phrase_sql(words: list[str], last: str | None = None) -> str:
    """Scores of a phrase by joining neighbouring positions."""
    tests = [f"t{i}.term = '{w}'" for i, w in enumerate(words)]
    names = [f"= '{w}'" for w in words]
    if last is not None:
        tests.append(f"t{len(words)}.term IN (SELECT term FROM expanded)")
        names.append("IN (SELECT term FROM expanded)")
    n = len(tests)
    joins = " ".join(
        f"JOIN toks t{i} ON t{i}.doc_id = t0.doc_id AND t{i}.pos = t0.pos + {i}" for i in range(1, n)
    )
    idf = " + ".join(
        f"ln(1 + (coll.n - f{i}.df + 0.5) / (f{i}.df + 0.5))" for i in range(n)
    )
    frequencies = ", ".join(
        f"(SELECT count(DISTINCT doc_id) AS df FROM toks WHERE term {name}) f{i}"
        for i, name in enumerate(names)
    )
    expanded = ""
    if last is not None:
        expanded = f""", expanded AS (
            SELECT DISTINCT term FROM toks WHERE starts_with(term, '{last}') ORDER BY term LIMIT 50)"""
    return f"""
    WITH {SQL_STATS}{expanded},
    found AS (SELECT t0.doc_id, count(*) AS tf FROM toks t0 {joins}
              WHERE {" AND ".join(tests)} GROUP BY t0.doc_id)
    SELECT doc_id, round(({idf}) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / coll.avgdl)), 6) AS score
    FROM found JOIN lens USING (doc_id), coll, {frequencies}"""


@plan("match_all", "SELECT doc_id, 1.0::DOUBLE AS score FROM documents")
def match_all(spark, d):
    return hits(q.match(corpus(spark, d), q.All()))


@plan(
    "match_none",
    """
    SELECT * FROM (VALUES ('none', 0::BIGINT), ('empty boolean', 0), ('only must_not', 0)) t(query, n)
    UNION ALL SELECT 'all', count(*) FROM documents""",
)
def match_none(spark, d):
    """Queries that match nothing, counted beside the one that matches everything."""
    queries = {
        "none": q.Nothing(),
        "empty boolean": q.Bool(),
        "only must_not": q.Bool(must_not=(q.Nothing(),)),
        "all": q.All(),
    }
    found = q.match_many(corpus(spark, d), queries).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    names = spark.createDataFrame([(name,) for name in queries], "query string")
    return names.join(found, names.query == found.query_id, "left").select(
        "query", F.coalesce("n", F.lit(0)).alias("n")
    )


@plan(
    "term_text",
    f"WITH {SQL_STATS}, {term_cte('c', 'thing')} SELECT doc_id, round(score, 6) AS score FROM c",
)
def term_text(spark, d):
    return hits(q.match(corpus(spark, d), q.Term("text", "Thing")))


@plan(
    "term_text_all",
    f"""
    WITH {SQL_STATS}, {term_cte('a', 'the')}, {term_cte('b', 'thing')}, {term_cte('c', 'of')}
    SELECT doc_id, round(a.score + b.score + c.score, 6) AS score
    FROM a JOIN b USING (doc_id) JOIN c USING (doc_id)""",
)
def term_text_all(spark, d):
    return hits(q.match(corpus(spark, d), q.all_terms("text", "the THING of")))


@plan(
    "term_typed",
    """
    SELECT 'int' AS kind, p_partkey AS key FROM part WHERE p_size = 11
    UNION ALL SELECT 'double', p_partkey FROM part WHERE p_retailprice = 900.1
    UNION ALL SELECT 'date', o_orderkey FROM orders WHERE epoch(o_orderdate) = 907372800
    UNION ALL SELECT 'bool', p_partkey FROM part WHERE (p_size > 25) = true
    UNION ALL SELECT 'string', p_partkey FROM part WHERE p_type = 'PROMO'""",
)
def term_typed(spark, d):
    part = table(spark, d, "part").withColumn("large", F.col("p_size") > 25)
    orders = table(spark, d, "orders")
    tests = [
        ("int", part, "p_partkey", q.TypedTerm("p_size", "11")),
        ("double", part, "p_partkey", q.TypedTerm("p_retailprice", "900.1")),
        ("date", orders, "o_orderkey", q.TypedTerm("o_orderdate", "907372800")),
        ("bool", part, "p_partkey", q.TypedTerm("large", "Yes")),
        ("string", part, "p_partkey", q.TypedTerm("p_type", "PROMO")),
    ]
    found = [
        df.where(q.column_filter(df, query)).select(F.lit(kind).alias("kind"), F.col(key).alias("key"))
        for kind, df, key, query in tests
    ]
    result = found[0]
    for part_found in found[1:]:
        result = result.unionByName(part_found)
    return result


@plan("phrase", phrase_sql(["in", "the"]))
def phrase(spark, d):
    return hits(q.match(corpus(spark, d), q.phrase("text", ["In", "the"])))


@plan("phrase_prefix", phrase_sql(["of"], "thi"))
def phrase_prefix(spark, d):
    return hits(q.match(corpus(spark, d), q.PhrasePrefix("text", ("of", "thi"), max_expansions=50)))


@plan(
    "range",
    """
    SELECT l_returnflag, count(*) FILTER (l_quantity BETWEEN 10 AND 20) AS closed,
           count(*) FILTER (l_quantity >= 40) AS low_only, count(*) FILTER (l_quantity <= 5) AS high_only,
           count(l_quantity) AS open, 0::BIGINT AS upside_down
    FROM lineitem GROUP BY 1""",
)
def range_(spark, d):
    lines = table(spark, d, "lineitem")
    ranges = {
        "closed": q.Range("l_quantity", 10.0, 20.0),
        "low_only": q.Range("l_quantity", low=40.0),
        "high_only": q.Range("l_quantity", high=5.0),
        "open": q.Range("l_quantity"),
        "upside_down": q.Range("l_quantity", 30.0, 20.0),
    }
    return lines.groupBy("l_returnflag").agg(
        *[F.count_if(q.column_filter(lines, r)).alias(name) for name, r in ranges.items()]
    )


@plan(
    "range_exclusive",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_totalprice < 120000",
)
def range_exclusive(spark, d):
    orders = table(spark, d, "orders")
    query = q.Range("o_totalprice", 100000.0, 120000.0, include_low=False, include_high=False)
    return orders.where(q.column_filter(orders, query)).select("o_orderkey", "o_totalprice")


@plan(
    "range_date",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-05-01'""",
)
def range_date(spark, d):
    import datetime

    orders = table(spark, d, "orders")
    query = q.Range(
        "o_orderdate", datetime.date(1997, 3, 1), datetime.date(1997, 5, 1), include_high=False
    )
    return orders.where(q.column_filter(orders, query)).select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    )


@plan(
    "boolean",
    f"""
    WITH {SQL_STATS}, {term_cte('a', 'thing')}, {term_cte('b', 'with')}, {term_cte('c', 'from')},
    {term_cte('e', 'tion')}, {term_cte('x', 'thonwh')}
    SELECT a.doc_id, round(a.score + coalesce(b.score, 0) + coalesce(c.score, 0) + coalesce(e.score, 0) + 1, 6) AS score
    FROM a JOIN documents d ON d.doc_id = a.doc_id AND d.n_chars BETWEEN 200 AND 3000
    LEFT JOIN b ON b.doc_id = a.doc_id LEFT JOIN c ON c.doc_id = a.doc_id
    LEFT JOIN e ON e.doc_id = a.doc_id LEFT JOIN x ON x.doc_id = a.doc_id
    WHERE (b.doc_id IS NOT NULL OR c.doc_id IS NOT NULL) AND x.doc_id IS NULL AND d.lang <> 'fr'""",
)
def boolean(spark, d):
    """Nested must, should and must_not over terms and document columns."""
    either = q.Bool(should=(q.Term("text", "with"), q.Term("text", "from")))
    query = q.Bool(
        must=(q.Term("text", "thing"), either, q.Range("n_chars", 200, 3000)),
        should=(q.Term("text", "tion"),),
        must_not=(q.Term("text", "thonwh"), q.TypedTerm("lang", "fr")),
    )
    return hits(q.match(corpus(spark, d), query))


def vocabulary_sql(test: str) -> str:
    return f"WITH {SQL_TOKENS} SELECT DISTINCT doc_id, 1.0::DOUBLE AS score FROM toks WHERE {test}"


# Non-ASCII letters become one foreign byte each, since DuckDB's distances count bytes.
ASCII_TERM = r"regexp_replace(term, '[^\x00-\x7F]', '#', 'g')"


@plan("fuzzy", vocabulary_sql(f"levenshtein({ASCII_TERM}, 'thether') <= 2"))
def fuzzy(spark, d):
    return hits(q.match(corpus(spark, d), q.Fuzzy("text", "Thether", 2, transpositions=False)))


@plan("fuzzy_transpositions", vocabulary_sql(f"damerau_levenshtein({ASCII_TERM}, 'htinging') <= 2"))
def fuzzy_transpositions(spark, d):
    return hits(q.match(corpus(spark, d), q.Fuzzy("text", "htinging", 2, transpositions=True)))


@plan("wildcard", vocabulary_sql("regexp_full_match(term, 'th.ng.*er')"))
def wildcard(spark, d):
    return hits(q.match(corpus(spark, d), q.Wildcard("text", "th?ng*er")))


@plan("regex", vocabulary_sql("regexp_full_match(term, '(un|ver)[a-z]{2,4}keit')"))
def regex(spark, d):
    return hits(q.match(corpus(spark, d), q.Regex("text", "(un|ver)[a-z]{2,4}keit")))


@plan(
    "exists",
    "SELECT doc_id, 1.0::DOUBLE AS score FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL",
)
def exists(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return hits(q.match(ps.Corpus(docs, "doc_id", docs, docs), q.Exists("quality")))


@plan(
    "more_like_this",
    rf"""
    WITH {SQL_STATS},
    post AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term),
    freq AS (SELECT term, count(*) AS df FROM post GROUP BY term),
    seed_toks AS (
        SELECT item_id, unnest(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+')) AS term FROM benchmark),
    seed_tf AS (SELECT item_id, term, count(*) AS stf FROM seed_toks
                WHERE term <> '' AND length(term) >= 3 GROUP BY item_id, term),
    cand AS (SELECT item_id, term, df, ln(1 + (coll.n - df + 0.5) / (df + 0.5)) AS idf, stf
             FROM seed_tf JOIN freq USING (term), coll WHERE df >= 5),
    picked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(stf * idf, 9) DESC, term) AS place FROM cand),
    scored AS (SELECT item_id, p.doc_id, sum(idf * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * dl / coll.avgdl))) AS score
               FROM picked JOIN post p USING (term) JOIN lens USING (doc_id), coll
               WHERE place <= 25 GROUP BY item_id, p.doc_id),
    best AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM scored)
    SELECT item_id, doc_id, rank::INT AS rank, round(score, 6) AS score FROM best WHERE rank <= 5""",
)
def more_like_this(spark, d):
    """Documents like each benchmark passage, all passages at once."""
    docs = corpus(spark, d)
    index = stored_postings(spark, d)
    seeds = ps.build_postings(ps.token_table(table(spark, d, "benchmark"), "item_id", {"text": "text"}))
    seeds = seeds.select(F.col("key").alias("seed"), "field", "term", "tf")
    similar = rk.more_like_this(
        seeds, index, docs.terms.select("field", "term", "df", "cf"), *docs.stats("text"), k=5, min_tf=1, min_length=3
    )
    return similar.select(
        F.col("seed").alias("item_id"),
        F.col("key").alias("doc_id"),
        "rank",
        F.round("score", 6).alias("score"),
    )


def part_facets(spark, d) -> DataFrame:
    part = table(spark, d, "part")
    path = F.concat_ws("/", F.lit(""), "p_brand", "p_type")
    return part.withColumn("facet", F.array(fc.facet_path(path)))


@plan(
    "facet_term",
    """
    SELECT 'brand' AS query, p_partkey FROM part WHERE p_brand = 'Brand#4'
    UNION ALL SELECT 'leaf', p_partkey FROM part WHERE p_brand = 'Brand#2' AND p_type = 'PROMO'""",
)
def facet_term(spark, d):
    part = part_facets(spark, d)
    queries = {"brand": q.FacetTerm("facet", "/Brand#4"), "leaf": q.FacetTerm("facet", "Brand#2/PROMO")}
    found = q.match_many(ps.Corpus(part, "p_partkey", part, part), queries)
    return found.select(F.col("query_id").alias("query"), F.col("key").alias("p_partkey"))


@plan(
    "facet_any_all_none",
    """
    SELECT p_partkey FROM part
    WHERE (p_brand IN ('Brand#1', 'Brand#2') OR (p_brand = 'Brand#3' AND p_type = 'SMALL')) AND p_type <> 'PROMO'""",
)
def facet_any_all_none(spark, d):
    part = part_facets(spark, d)
    unwanted = [f"/Brand#{b}/PROMO" for b in (1, 2)]
    query = q.facets("facet", should=["/Brand#1", "/Brand#2", "/Brand#3/SMALL"], must_not=unwanted)
    return part.where(q.column_filter(part, query)).select("p_partkey")


@plan(
    "query_terms",
    r"""
    WITH w AS (
        SELECT conv_id, turn, unnest(string_split_regex(
                   regexp_replace(lower(text), '[^\p{L}\p{N}_\s]', ' ', 'g'), '[\s\p{Z}]+')) AS w
        FROM conversations WHERE role = 'user'),
    kept AS (SELECT DISTINCT * FROM w WHERE w <> ''
             AND w NOT IN ('and', 'or', 'not', 'the', 'a', 'an', 'in', 'on', 'at'))
    SELECT c.conv_id, c.turn, coalesce(string_agg(w, ' ' ORDER BY w), '') AS terms
    FROM conversations c LEFT JOIN kept k ON k.conv_id = c.conv_id AND k.turn = c.turn
    WHERE role = 'user' GROUP BY c.conv_id, c.turn""",
)
def query_terms(spark, d):
    turns = table(spark, d, "conversations").where(F.col("role") == "user")
    return turns.select(
        "conv_id", "turn", F.array_join(tk.query_terms(F.col("text")), " ").alias("terms")
    )


@plan(
    "filtered_search",
    """
    WITH toks AS (SELECT p_partkey AS doc_id, unnest(string_split(p_name, ' ')) AS term FROM part),
    lens AS (SELECT doc_id, count(*) AS dl FROM toks GROUP BY doc_id),
    coll AS (SELECT (SELECT count(*) FROM part) AS n, (SELECT avg(dl) FROM lens) AS avgdl),
    f AS (SELECT count(DISTINCT doc_id) AS df FROM toks WHERE term = 'ring')
    SELECT p_partkey, p_name, p_type, p_retailprice,
           round(ln(1 + (n - df + 0.5) / (df + 0.5)) * 2.2 / (1 + 1.2 * (0.25 + 0.75 * dl / avgdl)), 6) AS score
    FROM part JOIN lens ON p_partkey = doc_id, coll, f
    WHERE p_name LIKE '%ring%' AND p_retailprice BETWEEN 910 AND 960 AND p_type IN ('SMALL', 'PROMO', 'LARGE')
      AND p_size >= 10
      AND EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey
                  AND l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate <= TIMESTAMP '1998-12-31')""",
)
def filtered_search(spark, d):
    """A term of the name with price range, categories, a floor and a date range of sales."""
    part = table(spark, d, "part")
    lines = table(spark, d, "lineitem")
    shipped = lines.where(
        F.col("l_shipdate").between(F.lit("1997-01-01").cast("timestamp_ntz"), F.lit("1998-12-31").cast("timestamp_ntz"))
    ).select(F.col("l_partkey").alias("key"))
    names = ps.Corpus.analyze(part, "p_partkey", {"name": "p_name"})
    query = q.Bool(
        must=(
            q.Term("name", "ring"),
            q.Boost(q.Range("p_retailprice", 910.0, 960.0), 0.0),
            q.Boost(q.Bool(should=tuple(q.TypedTerm("p_type", t) for t in ("SMALL", "PROMO", "LARGE"))), 0.0),
            q.Boost(q.Range("p_size", low=10), 0.0),
        )
    )
    found = q.match(names, query).join(shipped, "key", "left_semi")
    return rk.with_documents(found, part, "p_partkey", ["p_name", "p_type", "p_retailprice"]).select(
        F.col("key").alias("p_partkey"), "p_name", "p_type", "p_retailprice", F.round("score", 6).alias("score")
    )


FALLBACK_TEXTS = {
    "found as phrase": "of thing",
    "found by all words": "thing with of from",
    "found by any word": "thing qqqqqqqqqq",
    "found by spelling": "thethher qqqqqqqqqq",
    "found nowhere": "qqqqqqqqqqqq",
    "no words": " ,",
}
FALLBACK_ROWS = ", ".join(f"('{name}', '{text}')" for name, text in FALLBACK_TEXTS.items())


@plan(
    "fallback_search",
    rf"""
    WITH {SQL_TOKENS},
    lines AS (SELECT doc_id, ' ' || string_agg(term, ' ' ORDER BY pos) || ' ' AS line FROM toks GROUP BY doc_id),
    asked AS (
        SELECT * FROM (VALUES {FALLBACK_ROWS}) q(query_id, text)
        UNION ALL SELECT 'passage ' || item_id, text FROM benchmark),
    split AS (SELECT query_id, list_filter({WORDS}, lambda w: w <> '' AND octet_length(encode(w)) < 40) AS words FROM asked),
    need AS (SELECT query_id, words, array_to_string(words, ' ') AS phrase, len(list_distinct(words)) AS n FROM split WHERE len(words) > 0),
    single AS (SELECT DISTINCT query_id, unnest(words) AS term FROM need),
    held AS (SELECT query_id, doc_id, count(*) AS n FROM single JOIN (SELECT DISTINCT doc_id, term FROM toks) USING (term) GROUP BY 1, 2),
    whole AS (SELECT query_id, doc_id FROM held JOIN need USING (query_id, n)),
    lost AS (SELECT query_id, term FROM single WHERE query_id NOT IN (SELECT query_id FROM held)),
    near AS (SELECT DISTINCT w.term AS word, v.term FROM (SELECT DISTINCT term FROM lost) w,
             (SELECT DISTINCT term FROM toks) v WHERE levenshtein({ASCII_TERM.replace('term', 'v.term')}, {ASCII_TERM.replace('term', 'w.term')}) <= 2),
    tried AS (
        SELECT query_id, 0 AS tier, 'phrase' AS strategy, doc_id FROM whole JOIN need USING (query_id) JOIN lines USING (doc_id)
        WHERE contains(line, ' ' || phrase || ' ')
        UNION ALL SELECT query_id, 1, 'and', doc_id FROM whole
        UNION ALL SELECT query_id, 2, 'or', doc_id FROM held
        UNION ALL SELECT DISTINCT query_id, 3, 'fuzzy', doc_id FROM lost JOIN near ON lost.term = near.word JOIN toks ON toks.term = near.term),
    first AS (SELECT query_id, min(tier) AS tier FROM tried GROUP BY query_id)
    SELECT query_id, strategy, count(*) AS n_hits, sum(doc_id)::BIGINT AS id_sum
    FROM tried JOIN first USING (query_id, tier) GROUP BY 1, 2""",
)
def fallback_search(spark, d):
    """First strategy with hits for all passages, and for texts that reach each strategy."""
    passages = table(spark, d, "benchmark")
    asked = passages.select(F.concat(F.lit("passage "), "item_id").alias("query_id"), "text").unionByName(
        spark.createDataFrame(list(FALLBACK_TEXTS.items()), "query_id string, text string")
    )
    found = fb.fallback_search(corpus(spark, d), asked, "text")
    return found.groupBy("query_id", "strategy").agg(
        F.count(F.lit(1)).alias("n_hits"), F.sum("key").alias("id_sum")
    )


@plan(
    "suggest_prefix",
    f"""
    WITH {SQL_TOKENS}, freq AS (SELECT term, count(DISTINCT doc_id) AS df FROM toks GROUP BY term),
    named AS (SELECT prefix, term, df, row_number() OVER (PARTITION BY prefix ORDER BY df DESC, term) AS rank
              FROM freq, (VALUES ('th'), ('ein'), ('ver'), ('éa')) p(prefix) WHERE starts_with(term, prefix))
    SELECT prefix, term, df, rank::INT AS rank FROM named WHERE rank <= 5""",
)
def suggest_prefix(spark, d):
    """Best five completions of each prefix of at least two bytes."""
    asked = spark.createDataFrame([("th",), ("ein",), ("ver",), ("éa",), ("x",)], "prefix string")
    asked = asked.where(F.octet_length("prefix") >= 2)
    return vc.completions(corpus(spark, d).terms, asked, 5).select("prefix", "term", "df", "rank")


@plan(
    "collector_filter",
    """
    SELECT p_partkey FROM part
    WHERE p_size > 20 AND p_retailprice < 950.5 AND contains(p_name, 'ring') AND regexp_matches(p_brand, '#1[0-9]$')
      AND p_type = 'PROMO'""",
)
def collector_filter(spark, d):
    part = table(spark, d, "part")
    wanted = [
        ("p_size", "gt", "20"),
        ("p_retailprice", "lt", "950.5"),
        ("p_name", "contains", "ring"),
        ("p_brand", "regex", "#1[0-9]$"),
        ("p_type", "equals", "PROMO"),
    ]
    return part.where(q.criteria(part, wanted)).select("p_partkey")


@plan(
    "result_filter",
    """
    SELECT o_orderkey FROM orders
    WHERE o_orderstatus = 'F' AND contains(lower(o_orderpriority), 'high') AND o_totalprice > 50000
      AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1997-12-31'""",
)
def result_filter(spark, d):
    from lexigrid.operators.results import keep

    orders = table(spark, d, "orders")
    return orders.where(
        keep(
            equals={"o_orderstatus": "F"},
            contains={"o_orderpriority": "High"},
            above={"o_totalprice": 50000},
            between={"o_orderdate": ("1996-01-01", "1997-12-31")},
        )
    ).select("o_orderkey")


@plan(
    "permission_filter",
    """
    SELECT c_custkey AS user_id, count(o_orderkey) AS n_visible
    FROM customer LEFT JOIN orders ON (c_mktsegment = 'MACHINERY' AND c_acctbal > 9000)
        OR o_custkey = c_custkey OR o_orderpriority = '1-URGENT' OR o_orderstatus = 'F'
    GROUP BY c_custkey""",
)
def permission_filter(spark, d):
    """Orders each customer may see: rich machinery customers all, others open or own ones."""
    from lexigrid.operators.results import visible_counts

    users = table(spark, d, "customer").select(
        F.col("c_custkey").alias("user_id"),
        ((F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") > 9000)).alias("admin"),
    )
    anybody = (F.col("o_orderpriority") == "1-URGENT") | (F.col("o_orderstatus") == "F")
    return visible_counts(table(spark, d, "orders"), "o_custkey", anybody, users)
