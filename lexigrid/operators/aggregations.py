"""Nested bucket and metric aggregations.

A request is a dictionary: name -> {type: settings, "aggs": {...}}.  The answer is one long
table (agg, bucket, metric, value): ``agg`` is the path of names joined by ``>``, ``bucket``
the path of bucket keys joined by ``|`` and ``metric`` is ``doc_count`` or a metric name.

The rows are read once, whatever the number of names and levels.  Each row expands to the keys
of every chain of bucket aggregations, from the top to a deepest one, and folds on the map
side into counts, sums and extremes at these keys.  The partial results are written; parents
add their children's up, and buckets that do not survive take theirs along by a join of
buckets.  Percentiles alone read the rows again, as they rank values.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.operators.percentiles import exact_percentiles
from lexigrid.operators.postings import Corpus
from lexigrid.operators.queries import Query, match
from lexigrid.operators.ranking import top_k
from lexigrid.session import stored

# Request vocabulary, default percentiles and the bucket ceiling.
BUCKETS = {"terms": ["field"], "histogram": ["field", "interval"], "date_histogram": ["field"], "range": ["field", "ranges"]}
METRICS = ["avg", "min", "max", "sum", "count", "value_count", "stats", "percentiles"]
PERCENTS = [1.0, 5.0, 25.0, 50.0, 75.0, 95.0, 99.0]
CALENDAR = ["minute", "hour", "day", "week", "month", "quarter", "year"]
MILLIS = {"ms": 1, "s": 1000, "m": 60_000, "h": 3_600_000, "d": 86_400_000}
CALENDAR_MILLIS = {"minute": 60_000, "hour": 3_600_000, "day": 86_400_000, "week": 604_800_000}
MAX_BUCKETS = 65_535
DATE_KEY = "yyyy-MM-dd'T'HH:mm:ss"


class RequestError(ValueError):
    """An aggregation request that cannot be run."""


def validate(request: dict, columns: list[str]) -> None:
    """Raise on a malformed request before anything runs."""
    if not isinstance(request, dict) or not request:
        raise RequestError("an aggregation request is a non-empty dictionary")
    for name, node in request.items():
        if not isinstance(name, str) or not name:
            raise RequestError("aggregation names are non-empty strings")
        if not isinstance(node, dict):
            raise RequestError(f"{name}: settings must be a dictionary")
        kinds = [k for k in node if k not in ("aggs", "aggregations")]
        if len(kinds) != 1:
            raise RequestError(f"{name}: exactly one aggregation type is needed, got {kinds}")
        kind, settings = kinds[0], node[kinds[0]]
        if kind not in BUCKETS and kind not in METRICS:
            raise RequestError(f"{name}: unknown aggregation type {kind}")
        for needed in BUCKETS.get(kind, ["field"]):
            if needed not in settings:
                raise RequestError(f"{name}: {kind} needs {needed}")
        if settings["field"] not in columns:
            raise RequestError(f"{name}: unknown field {settings['field']}")
        if kind == "histogram" and not settings["interval"] > 0:
            raise RequestError(f"{name}: interval must be positive")
        if kind == "date_histogram":
            given = [k for k in ("fixed_interval", "calendar_interval", "interval") if k in settings]
            if len(given) != 1:
                raise RequestError(f"{name}: date_histogram needs exactly one interval")
        nested = node.get("aggs") or node.get("aggregations")
        if nested:
            if kind in METRICS:
                raise RequestError(f"{name}: a metric has no sub-aggregations")
            validate(nested, columns)


@dataclass
class BucketStep:
    """How one bucket aggregation assigns keys: a column, then its text form."""

    key: Column
    explode: bool = False
    label: Column | None = None

    def apply(self, df: DataFrame, name: str) -> DataFrame:
        key = F.explode(self.key) if self.explode else self.key
        return df.withColumn(name, key).where(F.col(name).isNotNull())


def bucket_step(kind: str, settings: dict, name: str) -> BucketStep:
    column = F.col(settings["field"])
    if kind == "terms":
        key = column.cast("string")
        if settings.get("missing") is not None:
            key = F.coalesce(key, F.lit(str(settings["missing"])))
        return BucketStep(key)
    if kind == "histogram":
        interval, offset = float(settings["interval"]), float(settings.get("offset", 0.0))
        return BucketStep(
            F.floor((column - offset) / interval).cast("bigint"),
            label=(F.col(name) * interval + offset).cast("string"),
        )
    if kind == "date_histogram":
        return BucketStep(date_key(column, settings))
    ranges = [range_bounds(r) for r in settings["ranges"]]
    tests = []
    for label, low, high in ranges:
        test = column.isNotNull()
        test = test if low is None else test & (column >= F.lit(low))
        test = test if high is None else test & (column < F.lit(high))
        tests.append(F.when(test, F.lit(label)))
    return BucketStep(F.array_compact(F.array(*tests)), explode=True)


def range_bounds(item) -> tuple[str, float | None, float | None]:
    """(key, from, to) of a range given as dictionary or (from, to[, key])."""
    if isinstance(item, dict):
        low, high, key = item.get("from"), item.get("to"), item.get("key")
    else:
        low, high, key = (*item, None)[:3]
    if low is None and high is None:
        raise RequestError("a range needs from or to")

    def text(bound) -> str:
        return "*" if bound is None else str(float(bound))

    return key or f"{text(low)}-{text(high)}", low, high


def date_key(column: Column, settings: dict) -> Column:
    """Bucket label of a moment: calendar units, or fixed steps counted from 1970.

    A time zone shifts moments first.  With a format, moments of one label share a bucket,
    so ``HH`` gives hours of the day.
    """
    moment = column.cast("timestamp_ntz")
    if settings.get("time_zone"):
        moment = F.convert_timezone(F.lit("UTC"), F.lit(settings["time_zone"]), moment)
    interval = (
        settings.get("calendar_interval") or settings.get("fixed_interval") or settings.get("interval")
    )
    if interval in CALENDAR:
        start = F.date_trunc(interval, moment)
    else:
        found = re.fullmatch(r"(\d+)(ms|s|m|h|d)", interval)
        if not found:
            raise RequestError(f"unknown interval {interval}")
        size = 1000 * int(found[1]) * MILLIS[found[2]]
        zero = F.lit("1970-01-01").cast("timestamp_ntz")
        since = F.timestamp_diff("MICROSECOND", zero, moment)
        start = F.timestamp_add("MICROSECOND", since - F.pmod(since, F.lit(size)), zero)
    return F.date_format(start, settings.get("format", DATE_KEY))


def fill_dates(table: DataFrame, parents: list[str], key: str, settings: dict) -> DataFrame:
    """Empty date buckets between the first and the last, a step of the interval apart.

    Labels are read back as moments, so a format must tell the whole bucket; with one that
    does not, such as hours of the day, there is no first and last bucket to fill between.
    """
    form = settings.get("format", DATE_KEY)
    moment = F.try_to_timestamp(F.col(key), F.lit(form)).cast("timestamp_ntz")
    ends = table.groupBy(*parents).agg(F.min(moment).alias("_lo"), F.max(moment).alias("_hi"))
    interval = (
        settings.get("calendar_interval") or settings.get("fixed_interval") or settings.get("interval")
    )
    found = re.fullmatch(r"(\d+)(ms|s|m|h|d)", interval)
    months = {"month": 1, "quarter": 3, "year": 12}
    if interval in months:
        apart = 12 * (F.year("_hi") - F.year("_lo")) + F.month("_hi") - F.month("_lo")
        steps, unit, size = F.floor(apart / months[interval]), "MONTH", months[interval]
    else:
        unit, size = "MILLISECOND", int(found[1]) * MILLIS[found[2]] if found else CALENDAR_MILLIS[interval]
        steps = F.floor(F.timestamp_diff("MILLISECOND", F.col("_lo"), F.col("_hi")) / size)
    # the number of buckets is known before one is made
    error = F.raise_error(F.lit(f"more than {MAX_BUCKETS} buckets")).cast("array<bigint>")
    counted = F.when(steps >= MAX_BUCKETS, error).otherwise(F.sequence(F.lit(0).cast("bigint"), steps.cast("bigint")))
    grid = ends.where("_lo IS NOT NULL").select(*parents, "_lo", F.explode(counted).alias("_step"))
    at = F.timestamp_add(unit, F.col("_step") * size, F.col("_lo"))
    grid = grid.select(*parents, F.date_format(at, form).alias(key)).distinct()
    return grid.join(table, [*parents, key], "full").fillna(0, ["doc_count"])


def keep_size(table: DataFrame, parents: list[str], key: str, settings: dict, metrics: list[str]) -> DataFrame:
    """Terms buckets that survive size and min_doc_count under the wanted order."""
    (by, direction), = settings.get("order", {"_count": "desc"}).items()
    names = {"_count": "doc_count", "_key": key}
    if by not in names and by not in metrics:
        raise RequestError(f"cannot order by {by}")
    column = F.col(names.get(by, f"`{by}`"))
    order = [column.desc() if direction == "desc" else column.asc(), F.col(key).asc()]
    table = table.where(F.col("doc_count") >= settings.get("min_doc_count", 1))
    size = settings.get("size", 10)
    if not parents:
        return table.orderBy(*order).limit(size)
    place = F.row_number().over(Window.partitionBy(*parents).orderBy(*order))
    return table.withColumn("_place", place).where(F.col("_place") <= size).drop("_place")


def fill_gaps(table: DataFrame, parents: list[str], key: str) -> DataFrame:
    """Empty histogram buckets between the first and the last; too many are an error."""
    ends = table.groupBy(*parents).agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"))
    error = F.raise_error(F.lit(f"more than {MAX_BUCKETS} buckets")).cast("array<bigint>")
    steps = F.when(F.col("_hi") - F.col("_lo") >= MAX_BUCKETS, error).otherwise(F.sequence("_lo", "_hi"))
    grid = ends.where(F.col("_lo").isNotNull()).select(*parents, F.explode(steps).alias(key))
    return grid.join(table, [*parents, key], "left").fillna(0, ["doc_count"])


def all_ranges(table: DataFrame, parent_rows: DataFrame | None, parents: list[str], key: str, settings: dict) -> DataFrame:
    """Every range of every parent, so that empty ranges show 0."""
    labels = F.array(*[F.lit(range_bounds(r)[0]) for r in settings["ranges"]])
    if parent_rows is None:
        parent_rows = table.sparkSession.range(1)
    grid = parent_rows.select(*parents, F.explode(labels).alias(key))
    return grid.join(table, [*parents, key], "left").fillna(0, ["doc_count"])


@dataclass(eq=False)
class Level:
    """One bucket aggregation of a request: its place in the tree and how it makes keys."""

    path: list[str]
    node: dict
    parent: "Level | None"
    step: BucketStep
    chain: int = -1

    @property
    def kind(self) -> str:
        return kind_of(self.node)

    @property
    def settings(self) -> dict:
        return self.node[self.kind]

    @property
    def nested(self) -> dict:
        return self.node.get("aggs") or self.node.get("aggregations") or {}

    @property
    def keys(self) -> list[str]:
        return [f"k{i}" for i in range(len(self.path))]

    def line(self) -> list["Level"]:
        """This level and those above it, the top one first."""
        return [*(self.parent.line() if self.parent else []), self]


def levels_of(request: dict, parent: Level | None = None) -> list[Level]:
    found = []
    for name, node in request.items():
        if kind_of(node) in BUCKETS:
            path = [*(parent.path if parent else []), name]
            level = Level(path, node, parent, bucket_step(kind_of(node), node[kind_of(node)], f"k{len(path) - 1}"))
            found += [level, *levels_of(level.nested, level)]
    return found


def metric_parts(kind: str) -> list[str]:
    """The folds that a metric is made of."""
    return {"avg": ["sum", "count"], "stats": ["count", "min", "max", "sum"], "value_count": ["count"]}.get(kind, [kind])


def metric_values(name: str, kind: str, held: dict[str, Column]) -> dict[str, Column]:
    """Named results of a metric from its folds."""
    mean = F.when(held["count"] > 0, held["sum"] / held["count"]) if {"sum", "count"} <= set(held) else None
    if kind == "stats":
        return {f"{name}.{part}": mean if part == "avg" else held[part] for part in ("count", "min", "max", "avg", "sum")}
    return {name: mean if kind == "avg" else held["count" if kind == "value_count" else kind]}


class Partials:
    """Counts and metric folds at the deepest keys of every chain of a request, in one pass."""

    def __init__(self, df: DataFrame, request: dict):
        self.levels = levels_of(request)
        self.request = request
        chains: list[list[Level]] = []
        parents = {id(x.parent) for x in self.levels}
        for level in self.levels:
            if id(level) not in parents:
                chains.append(level.line())
        # a level adds up a chain that passes it, unless ranges below it may repeat or lose rows
        for level in self.levels:
            depth = len(level.path)
            fit = [n for n, c in enumerate(chains) if c[depth - 1 : depth] == [level] and not any(x.step.explode for x in c[depth:])]
            if not fit:
                chains.append(level.line())
                fit = [len(chains) - 1]
            level.chain = fit[0]
        top = [n for n, c in enumerate(chains) if not any(x.step.explode for x in c)]
        if not top:
            chains.append([])
            top = [len(chains) - 1]
        self.top, self.depth = top[0], max((len(c) for c in chains), default=0)
        keys = [f"k{i}" for i in range(self.depth)]
        self.folds: dict[tuple[int, str], dict[str, str]] = {}
        folds = [F.count(F.lit(1)).alias("n")]
        wanted = [(-1, self.top, request)] + [(k, x.chain, x.nested) for k, x in enumerate(self.levels)]
        inputs: dict[str, Column] = {}
        for place, chain, nested in wanted:
            for name, node in nested.items():
                kind = kind_of(node)
                if kind not in METRICS or kind == "percentiles":
                    continue
                column = F.col(node[kind]["field"])
                if node[kind].get("missing") is not None:
                    column = F.coalesce(column, F.lit(node[kind]["missing"]))
                source = f"m{len(inputs)}"
                inputs[source] = column
                value = F.when(F.col("chain") == chain, F.col(source))
                held = self.folds[place, name] = {}
                for part in metric_parts(kind):
                    held[part] = f"{source}_{part}"
                    folds.append(getattr(F, part)(value).alias(held[part]))
        places = F.concat(*[self.expanded(n, c) for n, c in enumerate(chains)])
        rows = df.select(*[c.alias(n) for n, c in inputs.items()], places.alias("places_"))
        rows = rows.select(*inputs, F.inline("places_"))
        self.rows = stored(rows.groupBy("chain", *keys).agg(*folds), "aggregation-partials")

    def expanded(self, number: int, chain: list[Level]) -> Column:
        """The keys of a row in a chain, as an array; a key is null where the row has none."""

        def build(at: int, keys: list[Column]) -> Column:
            if at == len(chain):
                padded = keys + [F.lit(None).cast("string")] * (self.depth - len(keys))
                return F.array(F.struct(F.lit(number).alias("chain"), *[k.alias(f"k{i}") for i, k in enumerate(padded)]))
            step = chain[at].step
            if not step.explode:
                return build(at + 1, [*keys, step.key.cast("string")])
            some = F.when(F.size(step.key) > 0, step.key).otherwise(F.array(F.lit(None).cast("string")))
            return F.flatten(F.transform(some, lambda key: build(at + 1, [*keys, key])))

        return build(0, [])

    def results(self, place: int, request: dict) -> dict[str, Column]:
        """Named metric results of a level, over its folds."""
        columns: dict[str, Column] = {}
        for name, node in request.items():
            if (place, name) in self.folds:
                again = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
                held = {part: again[part](column) for part, column in self.folds[place, name].items()}
                held = {part: (F.coalesce(c, F.lit(0)) if part == "count" else c).cast("double") for part, c in held.items()}
                columns.update(metric_values(name, kind_of(node), held))
        return columns

    def whole(self) -> tuple[DataFrame | None, list[str]]:
        """The metrics of the request's top, if any, in one row."""
        metrics = self.results(-1, self.request)
        if not metrics:
            return None, []
        rows = self.rows.where(F.col("chain") == self.top)
        return rows.agg(*[c.alias(n) for n, c in metrics.items()]), list(metrics)

    def table(self, level: Level) -> tuple[DataFrame, list[str]]:
        """Buckets of a level over all its parents' buckets: keys, doc_count and metrics."""
        metrics = self.results(self.levels.index(level), level.nested)
        rows = self.rows.where(F.col("chain") == level.chain)
        for i, above in enumerate(level.line()):
            rows = rows.where(F.col(f"k{i}").isNotNull())
            if above.kind == "histogram":
                rows = rows.withColumn(f"k{i}", F.col(f"k{i}").cast("bigint"))
        found = rows.groupBy(*level.keys).agg(
            F.sum("n").alias("doc_count"), *[c.alias(n) for n, c in metrics.items()]
        )
        return found, list(metrics)


class Runner:
    """Walks a request and collects one long DataFrame per level."""

    def __init__(self, df: DataFrame, request: dict):
        self.parts: list[DataFrame] = []
        self.df, self.request = df, request
        self.partials = Partials(df, request)

    def long(self, table: DataFrame, agg: str, labels: list[Column], metrics: list[str]) -> None:
        bucket = F.concat_ws("|", *labels) if labels else F.lit("")
        pairs = F.array(
            *[F.struct(F.lit(m).alias("metric"), F.col(f"`{m}`").cast("double").alias("value")) for m in metrics]
        )
        self.parts.append(
            table.select(F.lit(agg).alias("agg"), bucket.alias("bucket"), F.inline(pairs))
        )

    def percentiles(self, name, settings, level: Level | None, labels, survivors) -> None:
        rows, keys = self.df, level.keys if level else []
        if level:
            for key, above in zip(keys, level.line()):
                rows = above.step.apply(rows, key)
            rows = rows.join(survivors, keys, "left_semi")
        column = F.col(settings["field"])
        if settings.get("missing") is not None:
            column = F.coalesce(column, F.lit(settings["missing"]))
        found = exact_percentiles(rows, keys, column, settings.get("percents", PERCENTS))
        bucket = F.concat_ws("|", *labels) if labels else F.lit("")
        metric = F.concat(F.lit(f"{name}."), F.col("percent").cast("string"))
        agg = ">".join(level.path) if level else ""
        self.parts.append(
            found.select(*keys, F.inline("p")).select(
                F.lit(agg).alias("agg"), bucket.alias("bucket"), metric.alias("metric"), "value"
            )
        )

    def run(self) -> list[DataFrame]:
        row, metrics = self.partials.whole()
        if metrics:
            self.long(row, "", [], metrics)
        self.children(self.request, None, [], None)
        return self.parts

    def children(self, request: dict, parent: Level | None, labels: list[Column], survivors: DataFrame | None) -> None:
        for name, node in request.items():
            kind = kind_of(node)
            if kind == "percentiles":
                self.percentiles(name, node[kind], parent, labels, survivors)
            elif kind in BUCKETS:
                (level,) = [x for x in self.partials.levels if x.node is node and x.parent is parent]
                self.bucket(level, labels, survivors)

    def bucket(self, level: Level, labels: list[Column], survivors: DataFrame | None) -> None:
        *parents, key = level.keys
        kind, settings = level.kind, level.settings
        every, metrics = self.partials.table(level)
        if survivors is not None:
            every = every.join(survivors, parents, "left_semi")
        table = every
        if kind == "terms":
            table = keep_size(every, parents, key, settings, metrics)
        elif kind == "range":
            table = all_ranges(every, survivors, parents, key, settings)
        elif settings.get("min_doc_count", 1) == 0 and kind == "histogram":
            table = fill_gaps(every, parents, key)
        elif settings.get("min_doc_count", 1) == 0 and kind == "date_histogram":
            table = fill_dates(every, parents, key, settings)
        else:
            table = every.where(F.col("doc_count") >= settings.get("min_doc_count", 1))
        label = level.step.label if level.step.label is not None else F.col(key)
        here = ">".join(level.path)
        self.long(table, here, [*labels, label], ["doc_count", *metrics])
        if kind == "terms":
            signed = every.select(*parents, "doc_count").unionByName(
                table.select(*parents, (-F.col("doc_count")).alias("doc_count"))
            )
            others = signed.groupBy(*parents).agg(
                F.coalesce(F.sum("doc_count"), F.lit(0)).alias("sum_other_doc_count")
            )
            self.long(others, here, labels, ["sum_other_doc_count"])
        if any(kind_of(n) in BUCKETS or kind_of(n) == "percentiles" for n in level.nested.values()):
            self.children(level.nested, level, [*labels, label], table.select(*level.keys))


def kind_of(node: dict) -> str:
    return next(k for k in node if k not in ("aggs", "aggregations"))


def aggregate(df: DataFrame, request: dict) -> DataFrame:
    """(agg, bucket, metric, value) of a request over all rows of ``df``."""
    validate(request, df.columns)
    return functools.reduce(DataFrame.unionByName, Runner(df, request).run())


def search_with_aggregations(
    corpus: Corpus, query: Query, request: dict, k: int = 10
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(hits, aggregations, total) of one match set; the total counts all matches.

    The matches are written once, so the texts are searched once however many aggregations
    read the result.
    """
    found = stored(match(corpus, query), "matches")
    matched = corpus.docs.join(found.select(F.col("key").alias(corpus.key)), corpus.key, "left_semi")
    total = found.agg(F.count(F.lit(1)).alias("total"))
    return top_k(found, k), aggregate(matched, request), total


def collect_metrics(df: DataFrame, wanted: dict[str, tuple[str, str | None]]) -> DataFrame:
    """Named count, sum, average, min and max in one row."""
    table = {"sum": F.sum, "average": F.avg, "min": F.min, "max": F.max}
    columns = []
    for name, (operation, field) in wanted.items():
        if operation == "count":
            columns.append(F.count(F.lit(1) if field is None else F.col(field)).alias(name))
        elif operation in table:
            columns.append(table[operation](field).alias(name))
        else:
            raise RequestError(f"unknown aggregation: {operation}")
    return df.agg(*columns)


def activity_request(time: str, duration: str, step: float, sizes: dict[str, int]) -> dict:
    """When things happen and how long they take, with the commonest values of some columns.

    ``sizes`` names the columns and how many of their values to show; ``step`` is the width of
    a duration's bucket.
    """
    by_time = {"by_hour": ("hour", "HH"), "by_weekday": ("day", "EEEE")}
    request: dict = {
        name: {"date_histogram": {"field": time, "calendar_interval": unit, "format": form}}
        for name, (unit, form) in by_time.items()
    }
    request["by_duration"] = {"histogram": {"field": duration, "interval": step}}
    return request | {f"top_{c}": {"terms": {"field": c, "size": n}} for c, n in sizes.items()}


def band_request(group: str, measures: list[str], bands: dict[str, list[float]], steps: dict[str, float], size: int) -> dict:
    """Groups with the means of their measures, and how each measure spreads.

    ``bands`` has the inner bounds of a measure's bands, which are open at both ends; ``steps``
    the width of its histogram buckets.
    """
    request: dict = {
        "groups": {
            "terms": {"field": group, "size": size},
            "aggs": {f"mean_{m}": {"avg": {"field": m}} for m in measures},
        }
    }
    for measure, bounds in bands.items():
        pairs = zip([None, *bounds], [*bounds, None])
        request[f"{measure}_bands"] = {"range": {"field": measure, "ranges": list(pairs)}}
    for measure, width in steps.items():
        request[f"{measure}_steps"] = {"histogram": {"field": measure, "interval": width}}
    return request | {f"{m}_summary": {"stats": {"field": m}} for m in measures}
