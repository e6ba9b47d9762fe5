import pytest
from pyspark.sql import functions as F

from lexigrid.operators import aggregations as ag
from lexigrid.operators.percentiles import exact_percentiles


def run(df, request):
    return {(r.agg, r.bucket, r.metric): r.value for r in ag.aggregate(df, request).collect()}


def buckets(df, request, agg, metric="doc_count"):
    return {b: v for (a, b, m), v in run(df, request).items() if a == agg and m == metric}


def test_terms(products):
    request = {"c": {"terms": {"field": "category"}}}
    assert buckets(products, request, "c") == {"seeds": 3, "tools": 3}
    one = run(products, {"c": {"terms": {"field": "category", "size": 1}}})
    assert one == {("c", "seeds", "doc_count"): 3, ("c", "", "sum_other_doc_count"): 3}


def test_terms_order_and_missing(products):
    with_gap = products.withColumn("category", F.when(F.col("id") != 6, F.col("category")))
    request = {"c": {"terms": {"field": "category", "missing": "unsorted", "order": {"_key": "desc"}, "size": 2}}}
    assert buckets(with_gap, request, "c") == {"unsorted": 1, "tools": 3}
    by_metric = {
        "c": {"terms": {"field": "category", "size": 1, "order": {"m": "desc"}}, "aggs": {"m": {"avg": {"field": "price"}}}}
    }
    assert buckets(products, by_metric, "c", "m") == {"tools": 121 / 3}


def test_metrics(products):
    request = {
        "a": {"avg": {"field": "price"}}, "lo": {"min": {"field": "price"}}, "hi": {"max": {"field": "price"}},
        "s": {"sum": {"field": "price"}}, "n": {"count": {"field": "price"}}, "st": {"stats": {"field": "price"}},
    }
    found = {m: v for (_, _, m), v in run(products, request).items()}
    assert found["a"] == 133 / 6 and found["lo"] == 3 and found["hi"] == 62 and found["s"] == 133 and found["n"] == 6
    assert [found[f"st.{p}"] for p in ("count", "min", "max", "avg", "sum")] == [6, 3, 62, 133 / 6, 133]


def test_ranges(products):
    ranges = [{"to": 5}, {"from": 5, "to": 40, "key": "middle"}, {"from": 40}, {"from": 400}]
    request = {"p": {"range": {"field": "price", "ranges": ranges}}}
    assert buckets(products, request, "p") == {"*-5.0": 2, "middle": 2, "40.0-*": 2, "400.0-*": 0}


def test_histograms(products):
    plain = {"h": {"histogram": {"field": "price", "interval": 10}}}
    assert buckets(products, plain, "h") == {"0.0": 3, "10.0": 1, "40.0": 1, "60.0": 1}
    two = {"h": {"histogram": {"field": "price", "interval": 5, "min_doc_count": 2}}}
    assert buckets(products, two, "h") == {"0.0": 2}
    gaps = {"h": {"histogram": {"field": "price", "interval": 20, "min_doc_count": 0}}}
    assert buckets(products, gaps, "h") == {"0.0": 4, "20.0": 0, "40.0": 1, "60.0": 1}
    with pytest.raises(Exception, match="more than"):
        run(products, {"h": {"histogram": {"field": "price", "interval": 0.0001, "min_doc_count": 0}}})


def test_date_histograms(products):
    month = {"d": {"date_histogram": {"field": "published_date", "calendar_interval": "month", "format": "yyyy-MM"}}}
    assert buckets(products, month, "d") == {"2023-05": 3, "2023-06": 2, "2023-07": 1}
    fixed = {"d": {"date_histogram": {"field": "published_date", "fixed_interval": "30d"}}}
    assert sum(buckets(products, fixed, "d").values()) == 6
    gaps = {"d": {"date_histogram": {"field": "published_date", "calendar_interval": "month", "format": "yyyy-MM", "min_doc_count": 0}}}
    assert buckets(products.where("id in (1, 4)"), gaps, "d") == {"2023-05": 1, "2023-06": 0, "2023-07": 1}


def test_percentiles(products, spark):
    request = {"p": {"percentiles": {"field": "price", "percents": [50.0, 95.0]}}}
    found = {m: v for (_, _, m), v in run(products, request).items()}
    assert found == {"p.50.0": 11.5, "p.95.0": 56.75}
    assert run(products.where("false"), request) == {}


def test_percentiles_of_skewed_values(spark):
    import numpy

    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7.0).otherwise((F.col("id") * 7919 % 100_003).cast("double")).alias("v"),
        (F.col("id") % 2).alias("g"),
    )
    values = df.toPandas()
    percents = [0.0, 1.0, 33.0, 50.0, 99.9, 100.0]
    for accuracy in (10_000, 200):
        rows = exact_percentiles(df, ["g"], F.col("v"), percents, accuracy).collect()
        for row in rows:
            expected = numpy.percentile(values[values.g == row.g].v, percents)
            assert [p.value for p in row.p] == pytest.approx(list(expected))
        (row,) = exact_percentiles(df, [], F.col("v"), percents, accuracy).collect()
        assert [p.value for p in row.p] == pytest.approx(list(numpy.percentile(values.v, percents)))


def test_percentiles_of_odd_groups(spark):
    import numpy

    nan = float("nan")
    given = {
        "one": [4.0], "two": [1.0, 2.0], "same": [3.0] * 500, None: [float(i * i % 97) for i in range(300)],
        "wide": [10.0 ** (i % 600 - 300) for i in range(4000)], "signs": [-0.0, 0.0, -1.0, 1.0, -5e-324],
        "few_nan": [1.0, 2.0, nan], "nulls": [None, None],
    }
    df = spark.createDataFrame([(g, v) for g, values in given.items() for v in values], "g string, v double")
    percents = [0.0, 2.5, 50.0, 97.5, 100.0]
    for accuracy in (10_000, 50):
        found = {r.g: [p.value for p in r.p] for r in exact_percentiles(df, ["g"], F.col("v"), percents, accuracy).collect()}
        assert set(found) == set(given) - {"nulls"}
        assert numpy.isnan(found.pop("few_nan")[-1])
        for g, values in found.items():
            assert values == pytest.approx(list(numpy.percentile(given[g], percents)), rel=1e-9), g
    assert exact_percentiles(df.where("false"), [], F.col("v"), percents).count() == 0


def test_third_scan_reads_a_small_part(spark):
    from lexigrid.operators.percentiles import wanted_zones

    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("v"))
    wide = F.sum(F.col("hi") - F.col("lo")).alias("wide")
    (row,) = wanted_zones(df, [], [1.0, 50.0, 99.0], 1000).agg(wide, F.count("*").alias("n")).collect()
    assert row.n == 3 and row.wide < 3 * 200_003 * (5 / 1000) * (4 / 256)


def test_rank_errors(spark):
    from lexigrid.operators.percentiles import rank_errors

    df = spark.range(50_000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 1009).cast("double").alias("v"))
    rows = rank_errors(df, F.col("v"), [0.0, 10.0, 50.0, 100.0], 100).collect()
    assert [r.total for r in rows] == [33_333] * 4 and max(r.error for r in rows) <= 0.01
    assert rank_errors(df.where("false"), F.col("v"), [50.0]).count() == 0


def test_nested(products):
    request = {
        "c": {
            "terms": {"field": "category"},
            "aggs": {
                "m": {"avg": {"field": "price"}},
                "r": {"range": {"field": "rating", "ranges": [{"to": 4.5, "key": "low"}, {"from": 4.5, "key": "high"}]}},
            },
        }
    }
    found = run(products, request)
    assert found[("c", "tools", "m")] == 121 / 3 and found[("c", "seeds", "m")] == 4.0
    inner = {b: v for (a, b, m), v in found.items() if a == "c>r"}
    assert inner == {"seeds|low": 1, "seeds|high": 2, "tools|low": 2, "tools|high": 1}


@pytest.mark.parametrize(
    "request_",
    [
        {}, {"": {"avg": {"field": "price"}}}, {"a": {}}, {"a": {"avg": {"field": "price"}, "sum": {"field": "price"}}},
        {"a": {"avg": {}}}, {"a": {"cardinality": {"field": "price"}}}, {"a": {"avg": {"field": "nothing"}}},
        {"a": {"histogram": {"field": "price"}}}, {"a": {"histogram": {"field": "price", "interval": 0}}},
        {"a": {"date_histogram": {"field": "published_date"}}}, {"a": {"range": {"field": "price"}}},
        {"a": {"terms": {"field": "category"}, "aggs": {"b": {"oops": {"field": "price"}}}}},
        {"a": {"avg": {"field": "price"}, "aggs": {"b": {"avg": {"field": "price"}}}}},
    ],
)
def test_bad_requests(products, request_):
    with pytest.raises(ag.RequestError):
        ag.aggregate(products, request_)


def test_facet_paths_are_not_gathered_in_one_row(spark):
    from lexigrid.plans import PLANS

    paths = PLANS["facet_count_path"].build(spark, "/root/testdata/sf0.001")
    assert "collect_set" not in paths._jdf.queryExecution().toString()
    assert paths.where("count = 0").count() > 0


def counted_reads(df, spark):
    """The rows, and how many of them were read so far."""
    read = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), read


DEEP = {
    "total": {"sum": {"field": "v"}},
    "far": {"max": {"field": "w", "missing": 99.0}},
    "bands": {
        "range": {"field": "v", "ranges": [(None, 40), (20, 70, "middle"), (90, None)]},
        "aggs": {
            "kinds": {
                "terms": {"field": "k", "size": 2, "order": {"mean": "desc"}},
                "aggs": {"mean": {"avg": {"field": "w"}}, "steps": {"histogram": {"field": "w", "interval": 5}}},
            },
            "n": {"value_count": {"field": "w"}},
        },
    },
    "kinds": {
        "terms": {"field": "k", "size": 3},
        "aggs": {
            "bands": {"range": {"field": "v", "ranges": [(None, 50), (30, None)]}, "aggs": {"s": {"stats": {"field": "w"}}}},
            "steps": {
                "histogram": {"field": "v", "interval": 25, "min_doc_count": 0},
                "aggs": {"groups": {"terms": {"field": "g", "missing": "none", "size": 2}}},
            },
        },
    },
}


def brute_buckets(rows, request, path=(), bucket=()):
    """The same answer by loops over rows."""
    import math

    out = {}
    agg, label = ">".join(path), "|".join(bucket)
    for name, node in request.items():
        kind = ag.kind_of(node)
        settings = node[kind]
        values = [r[settings["field"]] for r in rows]
        values = [settings.get("missing") if x is None else x for x in values]
        nested = node.get("aggs", {})
        if kind in ag.METRICS:
            held = [x for x in values if x is not None]
            many = {"count": len(held), "sum": sum(held) if held else None, "min": min(held, default=None), "max": max(held, default=None)}
            many["avg"] = many["sum"] / len(held) if held else None
            if kind == "stats":
                out.update({(agg, label, f"{name}.{p}"): many[p] for p in many})
            else:
                out[agg, label, name] = many["count" if kind == "value_count" else kind]
            continue
        groups = {}
        for row, value in zip(rows, values):
            if value is None:
                continue
            if kind == "range":
                keys = [ag.range_bounds(x)[0] for x in settings["ranges"] if (ag.range_bounds(x)[1] is None or value >= ag.range_bounds(x)[1]) and (ag.range_bounds(x)[2] is None or value < ag.range_bounds(x)[2])]
            else:
                keys = [str(value)] if kind == "terms" else [math.floor(value / settings["interval"])]
            for key in keys:
                groups.setdefault(key, []).append(row)
        here = (*path, name)
        if kind == "range":
            groups = {ag.range_bounds(x)[0]: groups.get(ag.range_bounds(x)[0], []) for x in settings["ranges"]}
        if kind == "histogram" and settings.get("min_doc_count", 1) == 0 and groups:
            groups = {k: groups.get(k, []) for k in range(min(groups), max(groups) + 1)}
        if kind == "terms":
            (by, _), = settings.get("order", {"_count": "desc"}).items()
            def place(key):
                if by == "_count":
                    return -len(groups[key]), key
                held = [r[nested[by]["avg"]["field"]] for r in groups[key]]
                held = [x for x in held if x is not None]
                return -(sum(held) / len(held)), key
            kept = sorted(groups, key=place)[: settings["size"]]
            if len(rows) or not path:
                other = sum(len(v) for k, v in groups.items() if k not in kept)
                if groups:
                    out[">".join(here), label, "sum_other_doc_count"] = other
            groups = {k: groups[k] for k in kept}
        for key, inside in groups.items():
            text = str(float(key * settings["interval"])) if kind == "histogram" else key
            out[">".join(here), "|".join((*bucket, text)), "doc_count"] = len(inside)
            metrics = {n: x for n, x in nested.items() if ag.kind_of(x) in ag.METRICS}
            deeper = {n: x for n, x in nested.items() if ag.kind_of(x) not in ag.METRICS}
            out.update(brute_buckets(inside, metrics, here, (*bucket, text)))
            out.update(brute_buckets(inside, deeper, here, (*bucket, text)))
    return out


def test_any_request_reads_the_rows_once(spark):
    import random

    draw = random.Random(1)
    rows = [
        {"k": draw.choice(["x", "y", "z", "u", None]), "v": draw.choice([None, draw.randint(0, 99)]), "w": draw.uniform(0, 20), "g": draw.choice(["a", "b", None])}
        for _ in range(400)
    ]
    df = spark.createDataFrame(rows, "k string, v long, w double, g string").repartition(3)
    counted, read = counted_reads(df, spark)
    found = run(counted, DEEP)
    assert read.value == 400
    expected = brute_buckets(rows, DEEP)
    numbers = lambda d: {k: None if v is None else round(v, 6) for k, v in d.items()}
    # a metric of an empty range bucket has no row to fold
    assert {k: v for k, v in numbers(found).items() if v is not None} == {
        k: v for k, v in numbers(expected).items() if v is not None
    }


def test_a_request_over_no_rows(spark):
    df = spark.createDataFrame([], "k string, v long, w double, g string")
    found = run(df, DEEP)
    assert found["", "", "total"] is None and found["bands", "middle", "doc_count"] == 0
    assert not any(a == "kinds" and b for a, b, _ in found)


def test_date_buckets_are_counted_before_they_are_made(products):
    def asked(**interval):
        return {"d": {"date_histogram": {"field": "published_date", "min_doc_count": 0, **interval}}}

    with pytest.raises(Exception, match="more than"):
        run(products, asked(fixed_interval="1s"))
    ten_years = products.selectExpr("timestampadd(YEAR, int(id * 2), published_date) as published_date")
    found = buckets(ten_years, asked(calendar_interval="month", format="yyyy-MM"), "d")
    assert len(found) > 110 and sum(found.values()) == 6
    quarters = buckets(ten_years, asked(calendar_interval="quarter"), "d")
    assert all(k[5:7] in ("01", "04", "07", "10") for k in quarters) and sum(quarters.values()) == 6
    days = buckets(products, asked(fixed_interval="36h"), "d")
    assert sum(days.values()) == 6 and 0 in days.values()


def test_requests_by_arguments():
    request = ag.band_request("c", ["p"], {"p": [1, 2]}, {"p": 5.0}, 7)
    assert [ag.range_bounds(r)[0] for r in request["p_bands"]["range"]["ranges"]] == ["*-1.0", "1.0-2.0", "2.0-*"]
    ag.validate(request, ["c", "p"])
    ag.validate(ag.activity_request("t", "d", 60, {"u": 3}), ["t", "d", "u"])


def test_few_groups_do_not_shuffle_all_rows(spark):
    """The sketches of the groups are joined by broadcast, so a group is not one task's rows."""
    from lexigrid.operators import percentiles as pc

    rows = spark.range(2000).selectExpr("id % 3 as g", "cast(id as double) as v")
    plan = pc.wanted_zones(rows, ["g"], [50.0], 1000)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
