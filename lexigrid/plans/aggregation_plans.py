"""Aggregation and facet queries in long form (agg, bucket, metric, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.operators import aggregations as ag
from lexigrid.operators import facets as fc
from lexigrid.operators import percentiles as pc
from lexigrid.operators import queries as q
from lexigrid.plans.catalog import corpus, plan, table
from lexigrid.plans.query_plans import part_facets
from lexigrid.plans.ranking_plans import SQL_ANY, TERMS


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("value", F.round("value", 4))


def long_sql(agg: str, bucket: str, source: str, metrics: dict[str, str], group: str = "") -> str:
    """Rows of one level: each metric as a row of (agg, bucket, metric, value)."""
    parts = [
        f"SELECT '{agg}' AS agg, {bucket} AS bucket, '{name}' AS metric, round(({expr})::DOUBLE, 4) AS value FROM {source} {group}"
        for name, expr in metrics.items()
    ]
    return " UNION ALL ".join(f"({p})" for p in parts)


def terms_sql(agg: str, key: str, source: str, size: int, metrics: dict[str, str] = {}, order: str = "n DESC, k") -> str:
    extra = "".join(f", {expr} AS \"{name}\"" for name, expr in metrics.items())
    table = f"(SELECT ({key})::VARCHAR AS k, count(*) AS n{extra} FROM {source} WHERE {key} IS NOT NULL GROUP BY 1)"
    top = f"(SELECT * FROM {table} ORDER BY {order} LIMIT {size})"
    rows = long_sql(agg, "k", top, {"doc_count": "n", **{m: f'"{m}"' for m in metrics}})
    other = long_sql(
        agg, "''", "(SELECT 1)",
        {"sum_other_doc_count": f"(SELECT sum(n) FROM {table}) - (SELECT sum(n) FROM {top})"},
    )
    return f"{rows} UNION ALL {other}"


def histogram_sql(agg: str, field: str, source: str, interval: float) -> str:
    key = f"(floor(({field}) / {interval}) * {interval})::DOUBLE"
    table = f"(SELECT {key} AS k, count(*) AS n FROM {source} WHERE {field} IS NOT NULL GROUP BY 1)"
    return long_sql(agg, "k::VARCHAR", table, {"doc_count": "n"})


def range_sql(agg: str, field: str, source: str, ranges: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        long_sql(agg, f"'{key}'", source, {"doc_count": f"count(*) FILTER ({test.format(field)})"})
        for key, test in ranges
    )


@plan(
    "agg_terms",
    f"""
    {terms_sql('types', 'p_type', 'part', 3)}
    UNION ALL {terms_sql('sizes', "coalesce(nullif(p_size, 7), -1)", 'part', 5, order='k')}""",
)
def agg_terms(spark, d):
    """Default order with a remainder; order by key with nulls counted as missing."""
    part = table(spark, d, "part").withColumn("size", F.nullif("p_size", F.lit(7)))
    request = {
        "types": {"terms": {"field": "p_type", "size": 3}},
        "sizes": {"terms": {"field": "size", "size": 5, "order": {"_key": "asc"}, "missing": -1}},
    }
    return rounded(ag.aggregate(part, request))


@plan(
    "agg_histogram",
    f"""
    {histogram_sql('price', 'l_extendedprice', 'lineitem', 2500.0)}
    UNION ALL
    (SELECT 'gaps' AS agg, (g * 0.25)::DOUBLE::VARCHAR AS bucket, 'doc_count' AS metric, coalesce(n, 0)::DOUBLE AS value
     FROM range((SELECT floor(min(l_discount * 100) / 0.25)::BIGINT FROM lineitem), (SELECT floor(max(l_discount * 100) / 0.25)::BIGINT + 1 FROM lineitem)) r(g)
     LEFT JOIN (SELECT floor(l_discount * 100 / 0.25)::BIGINT AS g, count(*) AS n FROM lineitem GROUP BY 1) USING (g))""",
)
def agg_histogram(spark, d):
    """Without empty buckets, and with them when min_doc_count is 0."""
    lines = table(spark, d, "lineitem").withColumn("percent_off", F.col("l_discount") * 100)
    request = {
        "price": {"histogram": {"field": "l_extendedprice", "interval": 2500.0}},
        "gaps": {"histogram": {"field": "percent_off", "interval": 0.25, "min_doc_count": 0}},
    }
    return rounded(ag.aggregate(lines, request))


def date_sql(agg: str, label: str, source: str) -> str:
    return long_sql(agg, "k", f"(SELECT {label} AS k, count(*) AS n FROM {source} GROUP BY 1)", {"doc_count": "n"})


@plan(
    "agg_date_histogram",
    f"""
    {date_sql('weeks', "strftime(time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01'), '%Y-%m-%dT%H:%M:%S')", 'events')}
    UNION ALL {date_sql('half days', "strftime(time_bucket(INTERVAL '12 hours', ts, TIMESTAMP '1970-01-01'), '%Y-%m-%dT%H:%M:%S')", 'events')}
    UNION ALL {date_sql('months', "strftime(date_trunc('month', o_orderdate), '%Y-%m')", 'orders')}
    UNION ALL {date_sql('tokyo', "strftime(date_trunc('day', ts + INTERVAL '9 hours'), '%Y-%m-%d')", 'events')}""",
)
def agg_date_histogram(spark, d):
    """Fixed and calendar steps, a label format and a time zone."""
    day = {"field": "ts", "calendar_interval": "day", "format": "yyyy-MM-dd", "time_zone": "Asia/Tokyo"}
    request = {
        "weeks": {"date_histogram": {"field": "ts", "fixed_interval": "7d"}},
        "half days": {"date_histogram": {"field": "ts", "fixed_interval": "12h"}},
        "tokyo": {"date_histogram": day},
    }
    month = {"field": "o_orderdate", "calendar_interval": "month", "format": "yyyy-MM"}
    events = ag.aggregate(table(spark, d, "events"), request)
    months = ag.aggregate(table(spark, d, "orders"), {"months": {"date_histogram": month}})
    return events.unionByName(months)


@plan(
    "agg_range",
    range_sql(
        "price",
        "p_retailprice",
        "part",
        [
            ("*-920.0", "{0} < 920"),
            ("mid", "{0} >= 920 AND {0} < 960"),
            ("overlap", "{0} >= 910 AND {0} < 940"),
            ("960.0-*", "{0} >= 960"),
            ("empty", "{0} >= 5000 AND {0} < 6000"),
        ],
    ),
)
def agg_range(spark, d):
    """Open, keyed, overlapping and empty ranges; list and tuple forms."""
    ranges = [
        {"to": 920},
        {"from": 920, "to": 960, "key": "mid"},
        (910, 940, "overlap"),
        (960, None),
        {"from": 5000, "to": 6000, "key": "empty"},
    ]
    request = {"price": {"range": {"field": "p_retailprice", "ranges": ranges}}}
    return ag.aggregate(table(spark, d, "part"), request)


@plan(
    "agg_metrics",
    long_sql(
        "", "''", "lineitem",
        {
            "avg_price": "avg(l_extendedprice)", "min_price": "min(l_extendedprice)",
            "max_price": "max(l_extendedprice)", "sum_qty": "sum(l_quantity)", "n": "count(l_quantity)",
            "filled": "avg(coalesce(CASE WHEN l_discount > 0 THEN l_discount END, 1.0))",
        },
    ),
)
def agg_metrics(spark, d):
    """avg, min, max, sum, count and a value for missing, in one pass."""
    lines = table(spark, d, "lineitem").withColumn("off", F.when(F.col("l_discount") > 0, F.col("l_discount")))
    request = {
        "avg_price": {"avg": {"field": "l_extendedprice"}},
        "min_price": {"min": {"field": "l_extendedprice"}},
        "max_price": {"max": {"field": "l_extendedprice"}},
        "sum_qty": {"sum": {"field": "l_quantity"}},
        "n": {"count": {"field": "l_quantity"}},
        "filled": {"avg": {"field": "off", "missing": 1.0}},
    }
    return rounded(ag.aggregate(lines, request))


@plan("agg_count", long_sql("", "''", "lineitem", {"n": "count(CASE WHEN l_discount > 0 THEN 1 END)"}))
def agg_count(spark, d):
    """Values only; nulls are not counted."""
    lines = table(spark, d, "lineitem").withColumn("off", F.when(F.col("l_discount") > 0, F.col("l_discount")))
    return ag.aggregate(lines, {"n": {"count": {"field": "off"}}})


@plan(
    "agg_stats",
    long_sql(
        "", "''", "orders",
        {
            "s.count": "count(o_totalprice)", "s.min": "min(o_totalprice)", "s.max": "max(o_totalprice)",
            "s.avg": "avg(o_totalprice)", "s.sum": "sum(o_totalprice)",
        },
    ),
)
def agg_stats(spark, d):
    return rounded(ag.aggregate(table(spark, d, "orders"), {"s": {"stats": {"field": "o_totalprice"}}}))


@plan(
    "agg_percentiles",
    f"""
    {long_sql("", "''", "lineitem", {f"p.{p}": f"quantile_cont(l_extendedprice, {p / 100})" for p in ag.PERCENTS})}
    UNION ALL {long_sql("", "''", "lineitem", {f"q.{p}": f"quantile_cont(l_quantity, {p / 100})" for p in (10.0, 99.9)})}
    UNION ALL {terms_sql('by_flag', 'l_returnflag', 'lineitem', 10)}
    UNION ALL {long_sql("by_flag", "l_returnflag", "lineitem", {f"p.{p}": f"quantile_cont(l_extendedprice, {p / 100})" for p in ag.PERCENTS}, "GROUP BY l_returnflag")}""",
)
def agg_percentiles(spark, d):
    """Exact, over everything and inside buckets."""
    inner = {"p": {"percentiles": {"field": "l_extendedprice"}}}
    request = {
        **inner,
        "q": {"percentiles": {"field": "l_quantity", "percents": [10.0, 99.9]}},
        "by_flag": {"terms": {"field": "l_returnflag"}, "aggs": inner},
    }
    return rounded(ag.aggregate(table(spark, d, "lineitem"), request))


@plan(
    "agg_percentiles_approx",
    f"""
    SELECT unnest([{", ".join(f"{p}::DOUBLE" for p in ag.PERCENTS)}]) AS percent,
           count(l_extendedprice) AS total, TRUE AS within
    FROM lineitem HAVING count(l_extendedprice) > 0""",
)
def agg_percentiles_approx(spark, d):
    """The one-pass approximation, held to its promise: ranks are off by 1/accuracy at most."""
    found = pc.rank_errors(table(spark, d, "lineitem"), F.col("l_extendedprice"), ag.PERCENTS)
    return found.select("percent", "total", (F.col("error") <= 1 / pc.ACCURACY).alias("within"))


SOLD = "(SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey)"


@plan(
    "agg_nested",
    f"""
    {terms_sql('types', 'p_type', SOLD, 3, {'avg_price': 'avg(l_extendedprice)', 'qty.count': 'count(l_quantity)',
      'qty.min': 'min(l_quantity)', 'qty.max': 'max(l_quantity)', 'qty.avg': 'avg(l_quantity)', 'qty.sum': 'sum(l_quantity)'})}
    UNION ALL
    SELECT 'types>brands' AS agg, p_type || '|' || p_brand AS bucket, u.metric, round(u.value, 4) AS value FROM (
        SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY n DESC, p_brand) AS place FROM (
            SELECT p_type, p_brand, count(*) AS n, max(l_extendedprice) AS m FROM {SOLD}
            WHERE p_type IN (SELECT p_type FROM {SOLD} GROUP BY 1 ORDER BY count(*) DESC, p_type LIMIT 3) GROUP BY 1, 2)),
        LATERAL (SELECT 'doc_count' AS metric, n::DOUBLE AS value UNION ALL SELECT 'top', m) u
    WHERE place <= 2
    UNION ALL
    SELECT 'types>brands', p_type, 'sum_other_doc_count', sum(n) FILTER (place > 2)::DOUBLE FROM (
        SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY n DESC, p_brand) AS place FROM (
            SELECT p_type, p_brand, count(*) AS n FROM {SOLD}
            WHERE p_type IN (SELECT p_type FROM {SOLD} GROUP BY 1 ORDER BY count(*) DESC, p_type LIMIT 3) GROUP BY 1, 2))
    GROUP BY p_type
    UNION ALL
    SELECT 'types>brands>flags', t.p_type || '|' || t.p_brand || '|' || s.l_returnflag, 'doc_count', count(*)::DOUBLE
    FROM (SELECT p_type, p_brand FROM (
        SELECT p_type, p_brand, row_number() OVER (PARTITION BY p_type ORDER BY count(*) DESC, p_brand) AS place FROM {SOLD}
        WHERE p_type IN (SELECT p_type FROM {SOLD} GROUP BY 1 ORDER BY count(*) DESC, p_type LIMIT 3) GROUP BY 1, 2) WHERE place <= 2) t
    JOIN {SOLD} s ON s.p_type = t.p_type AND s.p_brand = t.p_brand GROUP BY t.p_type, t.p_brand, s.l_returnflag
    UNION ALL
    SELECT 'types>brands>flags', t.p_type || '|' || t.p_brand, 'sum_other_doc_count', 0.0
    FROM (SELECT p_type, p_brand FROM (
        SELECT p_type, p_brand, row_number() OVER (PARTITION BY p_type ORDER BY count(*) DESC, p_brand) AS place FROM {SOLD}
        WHERE p_type IN (SELECT p_type FROM {SOLD} GROUP BY 1 ORDER BY count(*) DESC, p_type LIMIT 3) GROUP BY 1, 2) WHERE place <= 2) t""",
)
def agg_nested(spark, d):
    """Three levels of terms with metrics; only surviving parents have children."""
    part = table(spark, d, "part")
    sold = table(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    request = {
        "types": {
            "terms": {"field": "p_type", "size": 3},
            "aggs": {
                "avg_price": {"avg": {"field": "l_extendedprice"}},
                "qty": {"stats": {"field": "l_quantity"}},
                "brands": {
                    "terms": {"field": "p_brand", "size": 2},
                    "aggs": {
                        "top": {"max": {"field": "l_extendedprice"}},
                        "flags": {"terms": {"field": "l_returnflag"}},
                    },
                },
            },
        }
    }
    return rounded(ag.aggregate(sold, request))


@plan(
    "agg_multi",
    f"""
    {long_sql("", "''", "orders", {"total": "sum(o_totalprice)", "dearest": "max(o_totalprice)"})}
    UNION ALL {terms_sql('status', 'o_orderstatus', 'orders', 10, {'mean': 'avg(o_totalprice)'})}
    UNION ALL {date_sql('years', "strftime(date_trunc('year', o_orderdate), '%Y-%m-%dT%H:%M:%S')", 'orders')}
    UNION ALL {histogram_sql('price', 'o_totalprice', 'orders', 50000.0)}""",
)
def agg_multi(spark, d):
    request = {
        "total": {"sum": {"field": "o_totalprice"}},
        "dearest": {"max": {"field": "o_totalprice"}},
        "status": {"terms": {"field": "o_orderstatus"}, "aggs": {"mean": {"avg": {"field": "o_totalprice"}}}},
        "years": {"date_histogram": {"field": "o_orderdate", "calendar_interval": "year"}},
        "price": {"histogram": {"field": "o_totalprice", "interval": 50000.0}},
    }
    return rounded(ag.aggregate(table(spark, d, "orders"), request))


@plan(
    "search_with_aggs",
    f"""
    {SQL_ANY}, matched AS (SELECT d.* FROM documents d JOIN found USING (doc_id)),
    best AS (SELECT doc_id, score FROM found ORDER BY round(score, 9) DESC, doc_id LIMIT 10)
    SELECT 'hits' AS agg, doc_id::VARCHAR AS bucket, 'score' AS metric, round(score, 4) AS value FROM best
    UNION ALL SELECT 'hits', '', 'total', count(*)::DOUBLE FROM found
    UNION ALL {terms_sql('langs', 'lang', 'matched', 10, {'mean_chars': 'avg(n_chars)'})}
    UNION ALL {histogram_sql('chars', 'n_chars', 'matched', 1000.0)}""",
)
def search_with_aggs(spark, d):
    """Top hits, the real total and aggregations of the same matches."""
    request = {
        "langs": {"terms": {"field": "lang"}, "aggs": {"mean_chars": {"avg": {"field": "n_chars"}}}},
        "chars": {"histogram": {"field": "n_chars", "interval": 1000.0}},
    }
    best, found, total = ag.search_with_aggregations(
        corpus(spark, d), q.any_terms("text", TERMS), request, k=10
    )
    hit_rows = best.select(
        F.lit("hits").alias("agg"), F.col("key").cast("string").alias("bucket"),
        F.lit("score").alias("metric"), F.col("score").alias("value"),
    )
    total_rows = total.select(
        F.lit("hits").alias("agg"), F.lit("").alias("bucket"), F.lit("total").alias("metric"),
        F.col("total").cast("double").alias("value"),
    )
    return rounded(hit_rows.unionByName(total_rows).unionByName(found))


@plan(
    "collector_aggregate",
    """
    SELECT count(*) AS n, count(l_discount) AS discounts, sum(l_quantity) AS quantity,
           round(avg(l_extendedprice), 4) AS price, min(l_tax) AS low_tax, max(l_tax) AS high_tax FROM lineitem""",
)
def collector_aggregate(spark, d):
    wanted = {
        "n": ("count", None),
        "discounts": ("count", "l_discount"),
        "quantity": ("sum", "l_quantity"),
        "price": ("average", "l_extendedprice"),
        "low_tax": ("min", "l_tax"),
        "high_tax": ("max", "l_tax"),
    }
    return ag.collect_metrics(table(spark, d, "lineitem"), wanted).withColumn("price", F.round("price", 4))


@plan(
    "activity_report",
    f"""
    {date_sql('by_hour', "strftime(ts, '%H')", 'events')}
    UNION ALL {date_sql('by_weekday', "dayname(ts)", 'events')}
    UNION ALL {terms_sql('top_event_type', 'event_type', 'events', 4)}
    UNION ALL {terms_sql('top_user_id', 'user_id', 'events', 12)}
    UNION ALL {histogram_sql('by_duration', 'value * 10', 'events', 120.0)}""",
)
def activity_report(spark, d):
    events = table(spark, d, "events").withColumn("seconds", F.col("value") * 10)
    return ag.aggregate(events, ag.activity_request("ts", "seconds", 120.0, {"event_type": 4, "user_id": 12}))


PRODUCTS = "(SELECT p_type, p_retailprice AS price, p_size AS size FROM part)"


@plan(
    "product_analytics",
    f"""
    {terms_sql('groups', 'p_type', PRODUCTS, 3, {'mean_price': 'avg(price)', 'mean_size': 'avg(size)'})}
    UNION ALL {histogram_sql('price_steps', 'price', PRODUCTS, 12.5)}
    UNION ALL {range_sql('size_bands', 'size', PRODUCTS, [('*-5.0', '{0} < 5'), ('5.0-20.0', '{0} >= 5 AND {0} < 20'),
                         ('20.0-45.0', '{0} >= 20 AND {0} < 45'), ('45.0-*', '{0} >= 45')])}
    UNION ALL {long_sql("", "''", PRODUCTS, {f"{m}_summary.{p}": f"{f}({m})" for m in ("price", "size")
               for p, f in (("count", "count"), ("min", "min"), ("max", "max"), ("avg", "avg"), ("sum", "sum"))})}""",
)
def product_analytics(spark, d):
    part = table(spark, d, "part").select(
        "p_type", F.col("p_retailprice").alias("price"), F.col("p_size").alias("size")
    )
    request = ag.band_request("p_type", ["price", "size"], {"size": [5, 20, 45]}, {"price": 12.5}, 3)
    return rounded(ag.aggregate(part, request))


@plan(
    "facet_ancestors",
    """
    SELECT '/' || p_brand AS path, '/' AS parent, count(*) AS n FROM part GROUP BY 1
    UNION ALL SELECT '/' || p_brand || '/' || p_type, '/' || p_brand, count(*) FROM part GROUP BY 1, 2""",
)
def facet_ancestors(spark, d):
    paths = part_facets(spark, d).select(F.explode(fc.ancestors(F.col("facet")[0])).alias("path"))
    return paths.groupBy("path", fc.parent(F.col("path")).alias("parent")).agg(F.count(F.lit(1)).alias("n"))


@plan(
    "facet_counts",
    """
    SELECT '/' AS parent, '/' || p_brand AS path, count(*) AS count FROM part GROUP BY 2
    UNION ALL SELECT '/Brand#4', '/Brand#4/' || p_type, count(*) FROM part WHERE p_brand = 'Brand#4' GROUP BY 2""",
)
def facet_counts(spark, d):
    return fc.facet_counts(part_facets(spark, d), "p_partkey", "facet", roots=["/", "/Brand#4"])


def customer_facets(spark, d) -> DataFrame:
    """Customers with the path /region/nation/customer."""
    nation = table(spark, d, "nation").join(
        table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customer = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    path = F.concat_ws("/", F.lit(""), "r_name", "n_name", "c_name")
    return customer.select("c_custkey", F.array(fc.facet_path(path)).alias("facet"))


NATIONS = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@plan(
    "facet_children",
    f"SELECT '/ASIA' AS parent, '/ASIA/' || n_name AS path, count(*) AS count FROM {NATIONS} WHERE r_name = 'ASIA' GROUP BY 2",
)
def facet_children(spark, d):
    return fc.children(fc.facet_counts(customer_facets(spark, d), "c_custkey", "facet", ["/ASIA"]), "/ASIA")


@plan(
    "facet_top_k",
    f"""
    SELECT parent, path, count, row_number() OVER (PARTITION BY parent ORDER BY count DESC, path)::INT AS rank FROM (
        SELECT '/' AS parent, '/' || r_name AS path, count(*) AS count FROM {NATIONS} GROUP BY 2
        UNION ALL SELECT '/' || r_name, '/' || r_name || '/' || n_name, count(*) FROM {NATIONS} GROUP BY 1, 2
        UNION ALL SELECT '/' || r_name || '/' || n_name, '/' || r_name || '/' || n_name || '/' || c_name, count(*) FROM {NATIONS} GROUP BY 1, 2)
    QUALIFY rank <= 3""",
)
def facet_top_k(spark, d):
    return fc.top_children(fc.facet_counts(customer_facets(spark, d), "c_custkey", "facet"), 3)


@plan(
    "facet_count_path",
    """
    WITH asked AS (
        SELECT DISTINCT '/' || p_brand || '/' || p_type AS path FROM part
        UNION SELECT DISTINCT '/' || p_brand || '/NONE' FROM part)
    SELECT path, (SELECT count(*) FROM part WHERE '/' || p_brand || '/' || p_type = path) AS count FROM asked""",
)
def facet_count_path(spark, d):
    """Counts of asked paths: those of the parts, and one of each brand that no part has."""
    part = table(spark, d, "part")
    kinds = part.select("p_brand", F.explode(F.array(F.col("p_type"), F.lit("NONE"))).alias("kind"))
    paths = kinds.select(F.concat(F.lit("/"), "p_brand", F.lit("/"), "kind").alias("path"))
    counts = fc.facet_counts(part_facets(spark, d), "p_partkey", "facet")
    return fc.count_paths(counts, paths.where("path IS NOT NULL").distinct())
