"""Scores, top-k and the search calls built on them."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.session import stored

# BM25 constants.
K1 = 1.2
B = 0.75


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def length_norm(dl: Column, avgdl: Column, k1: float = K1, b: float = B) -> Column:
    return k1 * (1 - b + b * dl / avgdl)


def bm25_weight(tf: Column, dl: Column, avgdl: Column, k1: float = K1, b: float = B) -> Column:
    """Term weight without the rarity factor."""
    return tf * (k1 + 1) / (tf + length_norm(dl, avgdl, k1, b))


def tfidf(
    postings: DataFrame,
    stats: DataFrame,
    n_docs: Column,
    terms: list[str],
    normalize: bool = True,
    norms: DataFrame | None = None,
) -> DataFrame:
    """(key, score): sum of tf * ln(N / df) over the terms, of documents that hold one.

    Normalised scores are divided by the length of the document's weight vector.  A saved index
    has these as ``norms`` (key, norm), so only the postings of the terms are read; without
    them they take the postings of all terms.
    """
    wanted = F.col("term").isin(*terms)
    if not normalize or norms is not None:
        weighted = postings.where(wanted).join(stats.where(wanted), ["field", "term"])
        found = weighted.groupBy("key").agg(F.sum(F.col("tf") * F.log(n_docs / F.col("df"))).alias("score"))
        if not normalize:
            return found
        score = F.when(F.col("norm") > 0, F.col("score") / F.col("norm")).otherwise(0.0)
        return found.join(norms.groupBy("key").agg(F.sqrt(F.sum(F.col("norm") * F.col("norm"))).alias("norm")), "key").select(
            "key", score.alias("score")
        )
    weighted = postings.join(stats, ["field", "term"]).withColumn(
        "w", F.col("tf") * F.log(n_docs / F.col("df"))
    )
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")))
    total = F.when(norm > 0, F.sum(F.when(wanted, F.col("w"))) / norm).otherwise(0.0)
    found = weighted.groupBy("key").agg(total.alias("score"), F.bool_or(wanted).alias("found"))
    return found.where("found").select("key", "score")


def combine_scores(parts: list[tuple[DataFrame, float]]) -> DataFrame:
    """Weighted sum of several (key, score) tables; a missing score counts 0."""
    weighted = [
        part.select("key", (F.col("score") * F.lit(float(weight))).alias("score"))
        for part, weight in parts
    ]
    return (
        functools.reduce(DataFrame.unionByName, weighted)
        .groupBy("key")
        .agg(F.sum("score").alias("score"))
    )


def best_first() -> list[Column]:
    """Best score first, ties by key.

    Sums of doubles depend on the order rows arrive in; scores equal to 9 decimals tie, so
    that ranks do not depend on it.
    """
    return [F.desc(F.round("score", 9)), F.asc("key")]


def worst_first() -> list[Column]:
    return [F.asc(F.round("score", 9)), F.asc("key")]


def top_k(matches: DataFrame, k: int = 10, by: str | None = None) -> DataFrame:
    """Best k by score, ties by key, with a rank from 1.

    Without ``by`` this is a bounded heap per task; with it Spark keeps k rows per group
    and task before the shuffle, so a hot group never moves whole.
    """
    if by is None:
        best = matches.orderBy(*best_first()).limit(k)
        return best.withColumn("rank", F.row_number().over(Window.orderBy(*best_first())))
    order = Window.partitionBy(by).orderBy(*best_first())
    return matches.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def with_documents(
    hits: DataFrame, docs: DataFrame, key: str, columns: list[str], known: list | None = None
) -> DataFrame:
    """Stored columns joined after the top-k, so only hits ask for them.

    ``known`` keys, at most a page of them, reach the scan as a filter: row groups whose key
    range holds none of them are skipped before any text is read.
    """
    rows = docs.select(F.col(key).alias("key"), *columns)
    if known is not None:
        rows = rows.where(F.col("key").isin(*known))
    return hits.join(rows, "key")


def fetch_top(matches: DataFrame, docs: DataFrame, key: str, columns: list[str], k: int = 10) -> DataFrame:
    """Best k hits with stored columns, for tables too large to scan for them.

    The k hits are written first; their keys, no more than k, prune the document scan.
    """
    best = stored(top_k(matches, k), "top-hits")
    known = [row["key"] for row in best.select("key").limit(k).collect()]
    return with_documents(best, docs, key, columns, known)


def merge_shards(shards: dict[str, DataFrame], strategy: str, limit: int, offset: int = 0) -> DataFrame:
    """Hits of several shards in one order: score_desc, score_asc, node_order, round_robin.

    Every shard gives its own best ``limit + offset`` hits, which is all the merge can use.
    """
    want = limit + offset
    parts = []
    for number, (name, hits) in enumerate(shards.items()):
        order = worst_first() if strategy == "score_asc" else best_first()
        best = hits.orderBy(*order).limit(want)
        parts.append(
            best.select("key", "score", F.lit(name).alias("shard"), F.lit(number).alias("shard_no"))
        )
    return merge_sharded(functools.reduce(DataFrame.unionByName, parts), strategy, limit, offset)


def merge_sharded(hits: DataFrame, strategy: str, limit: int, offset: int = 0) -> DataFrame:
    """The same for hits already in one table with ``shard`` and ``shard_no`` columns."""
    want = limit + offset
    inner = worst_first() if strategy == "score_asc" else best_first()
    per_shard = Window.partitionBy("shard").orderBy(*inner)
    best = hits.withColumn("shard_rank", F.row_number().over(per_shard)).where(
        F.col("shard_rank") <= want
    )
    orders = {
        "score_desc": best_first(),
        "score_asc": worst_first(),
        "node_order": ["shard_no", "shard_rank"],
        "round_robin": ["shard_rank", "shard_no"],
    }
    if strategy not in orders:
        raise ValueError(f"unknown merge strategy: {strategy}")
    merged = best.orderBy(*orders[strategy]).limit(want)
    ranked = merged.withColumn("rank", F.row_number().over(Window.orderBy(*orders[strategy])))
    return ranked.where(F.col("rank") > offset)


def shard_summary(hits: DataFrame) -> DataFrame:
    """Hits and best score per shard."""
    return hits.groupBy("shard").agg(
        F.count(F.lit(1)).alias("total_hits"), F.max("score").alias("max_score")
    )


def salt_counts(pairs: DataFrame, by: list[str], pairs_per_task: int) -> DataFrame:
    """(by, salts): over how many tasks a key's pairs are spread, from (by, df) rows, one for
    each query that asks for the key.  A key whose pairs fit one task has one salt."""
    total = F.count(F.lit(1)) * F.max("df")
    salts = F.greatest(F.ceil(total / pairs_per_task), F.lit(1)).cast("bigint")
    return pairs.groupBy(*by).agg(salts.alias("salts"))


def salted(rows: DataFrame, salts: DataFrame, by: list[str]) -> DataFrame:
    """The rows of the keys in ``salts``, each dealt to one of its key's salts."""
    return rows.join(salts, by).withColumn("salt", F.pmod(F.xxhash64("key"), F.col("salts"))).drop("salts")


def spread(rows: DataFrame, salts: DataFrame, by: list[str]) -> DataFrame:
    """The rows once for each salt of their key."""
    every = F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)
    return rows.join(salts, by).withColumn("salt", F.explode(every)).drop("salts")


def batch_search(
    queries: DataFrame,
    postings: DataFrame,
    n_docs: Column,
    avgdl: Column,
    k: int = 10,
    stats: DataFrame | None = None,
    pairs_per_task: int = 1_000_000,
) -> DataFrame:
    """(query_id, key, score, rank) for a table of (query_id, term) AND queries.

    Only the rarest term of a query proposes documents, and only those that hold the next
    rarest term too are checked for the others.  Proposals are thus bounded by the shortest
    postings list of each query, are one narrow row each, and no term needs its whole list
    paired with every query that holds it.  The wanted postings are moved once, to one row a
    document, where a proposal finds all its terms: it never becomes a row for each of them, and
    a task keeps its best k of a query.  Equal term sets are searched once.
    Even a rarest term can be a frequent one; its join is spread over as many salts as its
    pairs need.  ``stats`` (term, df) of a saved index spares the count.
    """
    sets = (
        queries.groupBy("query_id")
        .agg(F.array_join(F.array_sort(F.collect_set("term")), " ").alias("words"))
    )
    distinct = sets.select("words").distinct().select(
        "words", F.explode(F.split("words", " ")).alias("term")
    )
    asked = distinct.select("term").distinct()
    if stats is None:
        df = postings.join(asked, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    else:
        df = stats.select("term", "df")
    # numbers stand for terms and for the words of a set, which would be moved with each proposal
    terms = asked.join(df, "term", "left").select("term", F.coalesce("df", F.lit(0)).alias("df"))
    # out of one task, so that numbers have no gaps and fit 32 bits
    terms = stored(terms.repartition(1).withColumn("number", F.monotonically_increasing_id().cast("int")), "batch-terms")
    rarity = F.struct("df", "term", "number")
    known = distinct.join(terms, "term").groupBy("words").agg(F.array_sort(F.collect_list(rarity)).alias("terms"))
    known = known.where(F.get("terms", F.lit(0))["df"] > 0)
    known = stored(known.withColumn("set", F.monotonically_increasing_id()), "batch-queries")
    rarest = F.get("terms", F.lit(0))
    drivers = known.select(
        "set", rarest["number"].alias("number"), rarest["df"].alias("df"),
        F.coalesce(F.get("terms", F.lit(1))["number"], rarest["number"]).alias("next"),
    )
    salts = salt_counts(drivers, ["number"], pairs_per_task)
    wanted = known.select(F.explode("terms").alias("t")).select("t.term", "t.number").distinct()
    postings = postings.where(F.col("key").isNotNull()).select("key", "term", "tf", "dl")

    def postings_of(numbers: DataFrame) -> DataFrame:
        return postings.join(wanted.join(numbers, "number", "left_semi"), "term")

    proposals = (
        spread(drivers.drop("df"), salts, ["number"])
        .join(salted(postings_of(salts).select("number", "key"), salts, ["number"]), ["number", "salt"])
        .select("set", "key", "next")
    )
    nexts = drivers.select(F.col("next").alias("number"))
    held = proposals.join(postings_of(nexts).select("key", F.col("number").alias("next")), ["key", "next"], "left_semi")
    whole = (
        postings.join(wanted, "term")
        .groupBy("key")
        .agg(F.collect_list(F.struct("number", "tf")).alias("found"), F.max("dl").alias("dl"))
        .select(
            "key", F.col("found.number").alias("numbers"), F.col("found.tf").alias("tfs"),
            length_norm(F.col("dl"), avgdl).alias("norm"), n_docs.alias("n_docs"),
        )
    )
    need = known.select("set", F.col("terms.number").alias("need"), F.col("terms.df").alias("dfs"))
    checked = (
        held.select("set", "key").join(need, "set").join(whole, "key")
        .where(F.forall("need", lambda number: F.array_contains("numbers", number)))
    )

    def weight(number: Column, df: Column) -> Column:
        tf = F.get("tfs", F.array_position("numbers", number).cast("int") - 1)
        return idf(F.col("n_docs"), df) * tf * (K1 + 1) / (tf + F.col("norm"))

    score = F.aggregate(F.zip_with("need", "dfs", weight), F.lit(0.0), lambda total, w: total + w)
    scored = checked.select("set", "key", score.alias("score"))
    best = top_k(scored, k, by="set").join(known.select("set", "words"), "set")
    return sets.join(best, "words").select("query_id", "key", "score", "rank")


def more_like_this(
    seeds: DataFrame,
    postings: DataFrame,
    stats: DataFrame,
    n_docs: Column,
    avgdl: Column,
    k: int = 10,
    min_df: int = 5,
    max_df: int | None = None,
    min_tf: int = 2,
    max_terms: int = 25,
    min_length: int = 0,
    max_length: int | None = None,
    boost: float = 1.0,
    hot_share: float = 0.1,
    pairs_per_task: int = 1_000_000,
) -> DataFrame:
    """(seed, key, score, rank) for a table of seed postings (seed, field, term, tf).

    The best ``max_terms`` terms of a seed by tf * idf make an OR query.  Terms held by more
    than ``hot_share`` of the documents are not paired with every seed that holds them:

    * the other terms propose documents; those that hot terms could still lift to the k-th
      best proposal look up the seed's hot terms;
    * a document holding hot terms alone scores at most 2.2 * idf for each of them, so a seed
      whose k-th proposal beats that sum is finished;
    * remaining seeds share one ranking per set of hot terms.  Its best k are enough: every
      document behind them has k documents ahead of it whose full scores are no lower.

    The result is the exact top k, whatever the share.  Joins on a term are spread over as many
    salts as its pairs need.
    """
    picked = seeds.join(stats, ["field", "term"]).where(
        (F.col("tf") >= min_tf)
        & (F.col("df") >= min_df)
        & (F.length("term") >= min_length)
        & (F.lit(True) if max_df is None else F.col("df") <= max_df)
        & (F.lit(True) if max_length is None else F.length("term") <= max_length)
    )
    weighted = picked.select(
        "seed",
        "field",
        "term",
        "tf",
        (idf(n_docs, F.col("df")) * F.lit(float(boost))).alias("idf"),
        (F.col("df") > n_docs * hot_share).alias("hot"),
        "df",
    )
    order = Window.partitionBy("seed").orderBy(
        F.desc(F.round(F.col("tf") * F.col("idf"), 9)), "field", "term"
    )
    chosen = (
        weighted.withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= max_terms)
        .select("seed", "field", "term", "idf", "hot", "df")
    )
    chosen = stored(chosen, "seed-terms")
    weight = F.col("idf") * bm25_weight(F.col("tf"), F.col("dl"), avgdl)
    term = ["field", "term"]
    salts = stored(salt_counts(chosen, term, pairs_per_task), "seed-salts")
    postings = postings.join(salts.select(*term), term, "left_semi").select("key", *term, "tf", "dl")

    def pair_up(terms: DataFrame) -> DataFrame:
        return spread(terms, salts, term).join(salted(postings, salts, term), [*term, "salt"]).withColumn("w", weight)

    cold = chosen.where(~F.col("hot"))
    hot = (
        chosen.where("hot")
        .groupBy("seed")
        .agg(F.array_sort(F.collect_list(F.struct("field", "term", "idf"))).alias("hot_terms"))
    )
    proposed = pair_up(cold).groupBy("seed", "key").agg(F.sum("w").alias("w"))
    ceiling = F.aggregate("hot_terms", F.lit(0.0), lambda total, t: total + t["idf"] * (K1 + 1))
    lowest = (
        top_k(proposed.withColumnRenamed("w", "score"), k, by="seed")
        .groupBy("seed")
        .agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(0.0).alias("floor"))
    )
    looked_up = (
        proposed.join(hot.join(lowest, "seed"), "seed")
        .where(F.col("w") + ceiling >= F.col("floor") - 1e-9)
        .select("seed", "key", F.inline("hot_terms"))
        .join(postings.select("key", "field", "term", "tf", "dl"), ["key", "field", "term"])
        .select("seed", "key", weight.alias("w"))
    )
    full = (
        proposed.unionByName(looked_up).groupBy("seed", "key").agg(F.sum("w").alias("score"))
    )
    best = stored(top_k(full, k, by="seed").drop("rank"), "proposals")

    reached = best.groupBy("seed").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n"))
    open_seeds = hot.join(reached, "seed", "left").where(
        F.col("n").isNull() | (F.col("n") < k) | (ceiling >= F.col("kth") - 1e-9)
    )
    shared = open_seeds.select("hot_terms").distinct().select("hot_terms", F.inline("hot_terms"))
    by_set = pair_up(shared).groupBy("hot_terms", "key").agg(F.sum("w").alias("score"))
    hot_best = (
        open_seeds.select("seed", "hot_terms")
        .join(top_k(by_set, k, by="hot_terms"), "hot_terms")
        .select("seed", "key", "score")
    )
    merged = best.unionByName(hot_best).groupBy("seed", "key").agg(F.max("score").alias("score"))
    return top_k(merged, k, by="seed")


def term_frequency_score(fields: dict[str, float], terms: list[str]) -> Column:
    """Occurrences of the terms in each column, times the column's weight.

    Terms are plain text, so an occurrence is a literal one.
    """
    parts = [
        F.coalesce(count_text(F.lower(F.col(name)), term.lower()), F.lit(0)) * F.lit(float(weight))
        for name, weight in fields.items()
        for term in terms
    ]
    return functools.reduce(operator.add, parts)


def count_text(text: Column, term: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    return F.size(F.split(text, F.lit("\\Q" + term + "\\E"), -1)) - 1


def sort_hits(hits: DataFrame, by: str, descending: bool = True, key: str = "key") -> DataFrame:
    """Order by score, by a date (missing is 1970-01-01) or by any column, ties by key."""
    column = F.col(by)
    if dict(hits.dtypes)[by].startswith("timestamp"):
        column = F.coalesce(column, F.lit("1970-01-01").cast(dict(hits.dtypes)[by]))
    return hits.orderBy(F.desc(column) if descending else F.asc(column), key)


def freshness_points(published: str, now: str) -> Column:
    """100 minus the age in days, never below 0; 0 without a date.  ``now`` is given."""
    age = F.timestamp_diff("SECOND", F.col(published), F.lit(now).cast("timestamp_ntz"))
    days = F.floor(age / 86400)
    return F.coalesce(F.greatest(F.lit(0).cast("bigint"), 100 - days), F.lit(0).cast("bigint"))


def engagement_points(views: str, comments: str, shares: str) -> Column:
    def count(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    return count(views) + 5 * count(comments) + 10 * count(shares)


def storefront_rank(products: DataFrame, limit: int) -> DataFrame:
    """Products (key, stock, rating, price, featured) with status, shipping, tags and rank."""
    stock = F.coalesce("stock", F.lit(0))
    status = F.when(stock > 10, "in_stock").when(stock > 0, "low_stock").otherwise("out_of_stock")
    points = F.when(stock > 10, 1000).when(stock > 0, 500).otherwise(0)
    shipping = (
        F.when(stock > 10, "1-2 days").when(stock > 0, "3-5 days").otherwise("Not available")
    )
    tags = F.array_compact(
        F.array(
            F.when(F.col("price") < 25, "budget_friendly"),
            F.when(stock > 10, "available"),
            F.when(F.col("rating") > 4.5, "top_rated"),
        )
    )
    rows = products.withColumns(
        {
            "status": status,
            "shipping": shipping,
            "tags": tags,
            "points": points + F.coalesce("rating", F.lit(0)) * 100,
            "first": F.coalesce("featured", F.lit(False)),
        }
    )
    order = [F.desc("first"), F.desc("points"), F.asc("key")]
    best = rows.orderBy(*order).limit(limit)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
