import pytest
from pyspark.sql import functions as F

from lexigrid.functions import marks as mk
from lexigrid.operators import results as rs
from lexigrid.operators import search_log as sl


@pytest.fixture(scope="module")
def hits(spark):
    return spark.createDataFrame([(i, s) for i, s in enumerate([0.9, 0.85, 0.6, 0.5, 0.1])], "key long, score double")


def test_pages(hits):
    assert [r.key for r in rs.paginate(hits, 2, 2).orderBy("position").collect()] == [2, 3]
    info = rs.page_info(hits, 2, 2).first()
    assert (info.total_count, info.total_pages, info.has_next, info.has_prev) == (5, 3, True, True)
    assert (info.start_index, info.end_index) == (3, 4)
    assert rs.paginate(hits, 9, 2).count() == 0
    with pytest.raises(ValueError):
        rs.paginate(hits, 0, 2)


def test_cursor(hits):
    page = rs.after_cursor(hits, (0.85, 1), 2).orderBy("position").collect()
    assert [(r.key, r.has_more) for r in page] == [(2, True), (3, True)]
    last = rs.after_cursor(hits, (0.5, 3), 2).collect()
    assert [(r.key, r.has_more) for r in last] == [(4, False)]


def test_summaries(hits):
    row = rs.score_distribution(hits).first()
    assert (row.high, row.medium, row.low, row.avg_score) == (2, 2, 1, 0.59)
    empty = rs.result_summary(hits.where("false"), query="x").first()
    assert (empty.total, empty.max_score, empty.query) == (0, 0.0, "x")
    assert rs.score_statistics(hits).first().median_score == 0.6


def test_normalized(hits):
    rows = rs.normalize_scores(hits.withColumn("q", F.lit("a")), "q").orderBy("key").collect()
    assert [r.normalized_score for r in rows][:2] == [1.0, 0.9444]


def test_highlight_does_not_nest(spark):
    df = spark.createDataFrame([(1, "The Mark of mark")], "id long, t string")
    row = mk.highlight(df, "t", ["mark", "of"]).first()
    assert row.highlights == ["The <mark>Mark</mark> <mark>of</mark> <mark>mark</mark>"]


def test_snippet(spark):
    text = "alpha " * 50 + "needle " + "omega " * 50
    df = spark.createDataFrame([(1, text), (2, "short needle")], "id long, t string")
    rows = {r.id: r.s for r in df.select("id", mk.snippet(F.col("t"), ["needle"], 60).alias("s")).collect()}
    assert rows[2] == "short needle"
    assert rows[1].startswith("...alpha") and rows[1].endswith("omega...") and "needle" in rows[1]


def test_clusters(spark):
    text = "x" * 10 + "key" + "x" * 20 + "key" + "x" * 400 + "key"
    df = spark.createDataFrame([(1, text)], "id long, t string")
    rows = mk.clustered_snippets(df, "id", "t", ["key"]).orderBy("rank").collect()
    assert [(r.start, r.end, r.score) for r in rows] == [(10, 36, 6), (436, 439, 3)]


def test_result_facets(spark):
    rows = [(29.99, "programming", True), (49.99, "programming", True), (39.99, "web development", False), (None, "programming", True)]
    df = spark.createDataFrame(rows, "price double, category string, available boolean")
    found = {(r.field, r.value): r["count"] for r in rs.result_facets(df, ["price", "category", "available"]).collect()}
    assert found[("price", "25-50")] == 3 and found[("category", "programming")] == 3
    assert found[("available", "true")] == 3 and found[("available", "false")] == 1


def test_types(spark):
    df = spark.createDataFrame([("42", "x", "on", "2024-01-01"), ("-1", "2.5", "maybe", "soon")], "u string, f string, b string, d string")
    rows = rs.convert_types(df, {"u": "u64", "f": "f64", "b": "bool", "d": "date"}).collect()
    assert [tuple(r) for r in rows] == [(42, 0.0, True, "2024-01-01T00:00:00"), (0, 2.5, False, "soon")]


def test_quality(spark):
    rows = [("a", 1, 3.0), ("a", 2, 1.0), ("b", 1, 0.2)]
    df = spark.createDataFrame(rows, "query_id string, key long, score double")
    found = {r.query_id: r for r in sl.result_quality(df).collect()}
    assert found["a"].distribution_type == "dominant_leader" and found["a"].relevance_quality == "excellent"
    assert found["a"].top_result_dominance == 3.0 and found["a"].uniformity == 0.5
    assert found["b"].distribution_type == "single" and found["b"].relevance_quality == "poor"


def test_log_classes(spark):
    df = spark.createDataFrame(
        [("INFO", "User login successful"), ("error", "Request failed"), (None, "hello")], "level string, message string"
    )
    rows = sl.classify(df, "level", "message").collect()
    assert [(r.severity, r.category) for r in rows] == [("low", "authentication"), ("high", "error"), ("unknown", "general")]


def test_visibility(spark):
    users = spark.createDataFrame([(1, False), (2, True), (3, False)], "user_id long, admin boolean")
    content = spark.createDataFrame(
        [(1, "private", "draft"), (1, "public", "draft"), (3, None, "published"), (9, "private", None)],
        "owner long, visibility string, status string",
    )
    open_rows = rs.is_open(F.col("visibility"), F.col("status"))
    found = {r.user_id: r.n_visible for r in rs.visible_counts(content, "owner", open_rows, users).collect()}
    assert found == {1: 3, 2: 4, 3: 2}
    for user in users.collect():
        seen = content.where(rs.visible_to(user.user_id, user.admin, F.col("owner"), open_rows)).count()
        assert seen == found[user.user_id]
