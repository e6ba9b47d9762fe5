"""What happens to hits after a search."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.functions.marks import squeeze
from lexigrid.functions.tokens import whitespace_tokens
from lexigrid.operators.percentiles import exact_percentiles
from lexigrid.operators.ranking import best_first, count_text

# Words that read as true when results are converted.
TRUE_WORDS = ["true", "1", "yes", "on"]


def convert_types(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Text columns to their declared types, with 0, 0.0 or false where that fails.

    A date that cannot be read keeps its text, so dates stay text in ISO form.
    """

    def convert(name: str, kind: str) -> Column:
        text = F.trim(F.col(name).cast("string"))
        if kind in ("u64", "i64"):
            number = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))
            if kind == "u64":
                number = F.when(number >= 0, number)
            return F.coalesce(number, F.lit(0).cast("bigint"))
        if kind == "f64":
            digits = text.rlike(r"^[+-]?\d+(\.\d+)?([eE][+-]?\d+)?$")
            return F.coalesce(F.when(digits, text.try_cast("double")), F.lit(0.0))
        if kind == "bool":
            return F.coalesce(F.lower(text).isin(*TRUE_WORDS), F.lit(False))
        if kind == "date":
            moment = F.col(name).cast("string").try_cast("timestamp_ntz")
            iso = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
            return F.coalesce(iso, F.col(name).cast("string"))
        return F.col(name).cast("string")

    return df.select(
        *[convert(c, schema[c]).alias(c) if c in schema else F.col(c) for c in df.columns]
    )


def normalize_scores(hits: DataFrame, by: str) -> DataFrame:
    """Adds ``normalized_score``: score over the group's best, 4 decimals.

    The best score combines before the shuffle and joins back, so a query with a third of
    all hits is not gathered in one task.
    """
    best = hits.groupBy(by).agg(F.max("score").alias("_best"))
    scaled = F.when(F.col("_best") > 0, F.round(F.col("score") / F.col("_best"), 4))
    return hits.join(best, by).withColumn("normalized_score", scaled.otherwise(F.col("score"))).drop("_best")


def relevance_tier(score: Column) -> Column:
    return F.when(score >= 0.8, "high").when(score >= 0.5, "medium").otherwise("low")


def hit_metadata(ranked: DataFrame) -> DataFrame:
    """Adds position, tier and the number of stored fields to ranked hits."""
    own = {"key", "score", "rank", "query_id"}
    count = len([c for c in ranked.columns if c not in own])
    return ranked.withColumns(
        {
            "position": F.col("rank"),
            "relevance_tier": relevance_tier(F.col("score")),
            "field_count": F.lit(count),
        }
    )


def paginate(hits: DataFrame, page: int = 1, per_page: int = 20) -> DataFrame:
    """Items of one page with their position; a bounded heap of page * per_page rows."""
    if page < 1 or per_page < 1:
        raise ValueError("page and per_page must be positive integers")
    best = hits.orderBy(*best_first()).limit(page * per_page)
    return best.withColumn("position", F.row_number().over(Window.orderBy(*best_first()))).where(
        F.col("position") > (page - 1) * per_page
    )


def page_info(hits: DataFrame, page: int = 1, per_page: int = 20) -> DataFrame:
    """One row about a page: totals, neighbours, first and last index."""
    if page < 1 or per_page < 1:
        raise ValueError("page and per_page must be positive integers")
    total = F.col("total_count")
    skipped = (page - 1) * per_page
    items = F.greatest(F.least(total - skipped, F.lit(per_page)), F.lit(0))
    return hits.agg(F.count(F.lit(1)).alias("total_count")).select(
        "total_count",
        F.lit(page).alias("current_page"),
        F.lit(per_page).alias("per_page"),
        F.ceil(total / per_page).alias("total_pages"),
        (F.lit(page) < F.ceil(total / per_page)).alias("has_next"),
        F.lit(page > 1).alias("has_prev"),
        F.lit(skipped + 1).alias("start_index"),
        F.least(F.lit(skipped) + items, total).alias("end_index"),
    )


def after_cursor(hits: DataFrame, cursor: tuple[float, int] | None, per_page: int = 20) -> DataFrame:
    """The page after a (score, key) cursor, with ``has_more`` on every row.

    A keyset predicate: no page costs more than the first, however deep.
    """
    near = F.round("score", 9)
    if cursor is not None:
        score, key = round(cursor[0], 9), cursor[1]
        hits = hits.where((near < score) | ((near == score) & (F.col("key") > key)))
    order = Window.orderBy(*best_first())
    ahead = hits.orderBy(*best_first()).limit(per_page + 1)
    ranked = ahead.withColumn("position", F.row_number().over(order))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    more = F.max("position").over(whole) > per_page
    return ranked.withColumn("has_more", more).where(F.col("position") <= per_page)


def result_summary(hits: DataFrame, **metadata: str) -> DataFrame:
    """Total, max, min and mean score in one row; 0.0 when there are no hits."""
    def zero(c: Column) -> Column:
        return F.coalesce(c, F.lit(0.0))

    row = hits.agg(
        F.count(F.lit(1)).alias("total"),
        zero(F.max("score")).alias("max_score"),
        zero(F.min("score")).alias("min_score"),
        zero(F.avg("score")).alias("avg_score"),
    )
    return row.withColumns({k: F.lit(v) for k, v in metadata.items()}) if metadata else row


def score_distribution(hits: DataFrame) -> DataFrame:
    score = F.col("score")
    return hits.agg(
        F.count_if(score >= 0.8).alias("high"),
        F.count_if((score >= 0.5) & (score < 0.8)).alias("medium"),
        F.count_if(score < 0.5).alias("low"),
        F.round(F.coalesce(F.avg("score"), F.lit(0.0)), 3).alias("avg_score"),
    )


def relevance_band(percent: Column) -> Column:
    """Band of a score in percent of the best; bands touch, so no score falls between."""
    return (
        F.when(percent >= 80, "highly_relevant")
        .when(percent >= 50, "moderately_relevant")
        .when(percent >= 20, "somewhat_relevant")
        .otherwise("low_relevance")
    )


def reading_minutes(text: Column, per_minute: int = 200) -> Column:
    words = F.size(whitespace_tokens(text))
    return F.greatest(F.lit(1), F.floor(words / per_minute).cast("int"))


def excerpt(text: Column, length: int = 200) -> Column:
    return F.concat(squeeze(F.substring(text, 1, length)), F.lit("..."))


def content_type(text: Column) -> Column:
    return (
        F.when(F.length(text) < 500, "snippet").when(F.length(text) > 2000, "article").otherwise("general")
    )


def freshness(days: Column) -> Column:
    """Freshness tier of an age in days; unknown ages get the middle."""
    return (
        F.when(days.isNull(), 0.5)
        .when(days <= 7, 1.0)
        .when(days <= 30, 0.8)
        .when(days <= 90, 0.6)
        .when(days <= 365, 0.4)
        .otherwise(0.2)
    )


def enrich(docs: DataFrame, text: str, terms: list[str]) -> DataFrame:
    """Reading time, excerpt, kind of content and occurrences per term."""
    column = F.col(text)
    return docs.withColumns(
        {
            "reading_minutes": reading_minutes(column),
            "excerpt": excerpt(column),
            "content_type": content_type(column),
            **{f"n_{t}": count_text(F.lower(column), t.lower()) for t in terms},
        }
    )


def keep(
    equals: dict | None = None,
    contains: dict | None = None,
    above: dict | None = None,
    between: dict | None = None,
) -> Column:
    """Result filters combined; a missing value fails its filter."""
    tests = [F.col(c) == F.lit(v) for c, v in (equals or {}).items()]
    tests += [F.lower(c).contains(v.lower()) for c, v in (contains or {}).items()]
    tests += [F.col(c) > F.lit(v) for c, v in (above or {}).items()]
    for column, (first, last) in (between or {}).items():
        moment = F.col(column).cast("timestamp_ntz")
        tests.append(
            moment.between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz"))
        )
    return functools.reduce(
        operator.and_, [F.coalesce(t, F.lit(False)) for t in tests], F.lit(True)
    )


def is_open(visibility: Column, status: Column) -> Column:
    """Content anybody may see."""
    return F.coalesce(visibility == "public", F.lit(False)) | F.coalesce(
        status == "published", F.lit(False)
    )


def visible_to(user_id, admin: bool, owner: Column, open_to_all: Column) -> Column:
    """May one user see the row."""
    if admin:
        return F.lit(True)
    return open_to_all | F.coalesce(owner == F.lit(user_id), F.lit(False))


def visible_counts(content: DataFrame, owner: str, open_to_all: Column, users: DataFrame) -> DataFrame:
    """Rows each of many users may see, for (user_id, admin).

    Open rows are the same for everybody and are counted once; only rows that are not open
    meet their owner, by equality.  No user is paired with rows not their own.
    """
    marked = content.select(F.col(owner).alias("user_id"), open_to_all.alias("open"))
    totals = marked.agg(
        F.struct(F.count(F.lit(1)).alias("every"), F.count_if("open").alias("open")).alias("t")
    ).scalar()
    private = marked.where(~F.col("open")).groupBy("user_id").agg(F.count(F.lit(1)).alias("own"))
    seen = F.when(F.col("admin"), totals["every"]).otherwise(
        totals["open"] + F.coalesce("own", F.lit(0))
    )
    return users.join(private, "user_id", "left").select("user_id", seen.alias("n_visible"))


def value_bucket(df: DataFrame, name: str) -> Column:
    """Facet value of a column: text as it is, numbers in four bands."""
    kind = dict(df.dtypes)[name]
    column = F.col(name)
    if kind in ("double", "float", "int", "bigint", "smallint", "tinyint") or kind.startswith("decimal"):
        return (
            F.when(column.isNull(), None)
            .when(column < 25, "0-25")
            .when(column < 50, "25-50")
            .when(column < 100, "50-100")
            .otherwise("100+")
        )
    return column.cast("string")


def result_facets(hits: DataFrame, fields: list[str]) -> DataFrame:
    """(field, value, count) over hits, nulls left out; one pass for all fields."""
    pairs = F.array(
        *[F.struct(F.lit(f).alias("field"), value_bucket(hits, f).alias("value")) for f in fields]
    )
    return (
        hits.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("field", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def bands(value: Column, limits: list[tuple[str, float | None, float | None]]) -> dict[str, Column]:
    """Conditional counts of labelled [from, to) bands."""
    counts = {}
    for label, low, high in limits:
        test = value.isNotNull()
        test = test if low is None else test & (value >= low)
        test = test if high is None else test & (value < high)
        counts[label] = F.count_if(test)
    return counts


def storefront_facets(hits: DataFrame, category: str, price: str, rating: str, stock: str) -> DataFrame:
    """(facet, value, count): categories, price bands, star bands and availability."""
    # The storefront's price bands.
    prices = [
        ("Under $25", None, 25.0), ("$25 - $50", 25.0, 50.0), ("$50 - $100", 50.0, 100.0),
        ("$100 - $200", 100.0, 200.0), ("Over $200", 200.0, None),
    ]
    stars = [(f"{n} stars & up", float(n), n + 1.0) for n in (5, 4, 3, 2, 1)]
    groups = {
        "price_ranges": bands(F.col(price), prices),
        "ratings": bands(F.col(rating), stars),
        "availability": {
            "In Stock": F.count_if(F.coalesce(F.col(stock) > 0, F.lit(False))),
            "Out of Stock": F.count_if(~F.coalesce(F.col(stock) > 0, F.lit(False))),
        },
    }
    labels = [(facet, value) for facet, counts in groups.items() for value in counts]
    columns = [count for counts in groups.values() for count in counts.values()]
    totals = hits.agg(*[c.alias(f"n{i}") for i, c in enumerate(columns)])
    fixed = totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(f).alias("facet"), F.lit(v).alias("value"), F.col(f"n{i}").alias("count"))
                    for i, (f, v) in enumerate(labels)
                ]
            )
        )
    )
    categories = (
        hits.where(F.col(category).isNotNull())
        .groupBy(F.col(category).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(F.lit("categories").alias("facet"), "value", "count")
    )
    return fixed.unionByName(categories)


def field_summary(hits: DataFrame, fields: list[str], top: int = 10) -> DataFrame:
    """(field, total_values, unique_values, value, count, rank): best values per field."""
    pairs = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]
    )
    counts = (
        hits.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("field", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    totals = counts.groupBy("field").agg(
        F.sum("count").alias("total_values"), F.count(F.lit(1)).alias("unique_values")
    )
    order = Window.partitionBy("field").orderBy(F.desc("count"), "value")
    best = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "field")


def score_statistics(hits: DataFrame, score: str = "score") -> DataFrame:
    """Count, min, max, mean and exact median in one row."""
    column = F.col(score)
    base = hits.agg(
        F.count(F.lit(1)).alias("total_results"),
        F.coalesce(F.min(column), F.lit(0.0)).alias("min_score"),
        F.coalesce(F.max(column), F.lit(0.0)).alias("max_score"),
        F.coalesce(F.avg(column), F.lit(0.0)).alias("avg_score"),
    )
    median = exact_percentiles(hits, [], column, [50.0]).select(F.col("p")[0]["value"])
    return base.withColumn("median_score", F.coalesce(median.scalar(), F.lit(0.0)))
