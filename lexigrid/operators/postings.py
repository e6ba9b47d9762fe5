"""Token tables, postings and their statistics."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field as dataclass_field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.functions.tokens import SEARCH, Analyzer
from lexigrid.operators.vocabulary import write_keys, write_terms
from lexigrid.session import stored

BUCKETS = 64
ROWS_PER_TASK = 4_000_000
FEW_TASKS = 256


@dataclass(frozen=True)
class Streams:
    """Documents and how to analyse them: ``analyse(docs)`` is (key, field, slots, dl), one row
    a document and field, ``slots`` its terms by position with nulls for dropped ones."""

    docs: DataFrame
    key: str
    analyse: Callable[[DataFrame], DataFrame]

    def spread(self, tasks: int) -> "Streams":
        """The same documents in at least so many partitions."""
        if self.docs.rdd.getNumPartitions() >= tasks:
            return self
        columns = [c for c, kind in self.docs.dtypes if kind in ("string", "bigint", "int")]
        return Streams(self.docs.repartition(tasks, *(columns or [self.key])), self.key, self.analyse)


def token_streams(
    docs: DataFrame,
    key: str,
    fields: dict[str, str],
    analyzer: Analyzer = SEARCH,
    lang: str | None = None,
) -> Streams:
    read = list(dict.fromkeys([key, *fields.values(), *([lang] if lang else [])]))
    return Streams(docs.select(*read), key, lambda rows: slot_table(rows, key, fields, analyzer, lang))


def slot_table(
    docs: DataFrame, key: str, fields: dict[str, str], analyzer: Analyzer, lang: str | None
) -> DataFrame:
    language = F.col(lang) if lang else None
    streams = F.array(
        *[
            F.struct(
                F.lit(name).alias("field"),
                analyzer.slots(F.col(column), language).alias("slots"),
            )
            for name, column in fields.items()
        ]
    )
    return docs.select(F.col(key).alias("key"), F.explode(streams).alias("s")).select(
        "key", "s.field", "s.slots", F.size(F.array_compact("s.slots")).alias("dl")
    )


def exploded(slots: DataFrame) -> DataFrame:
    rows = slots.select("key", "field", "dl", F.posexplode("slots").alias("pos", "term"))
    return rows.where(F.col("term").isNotNull())


def token_table(
    docs: DataFrame,
    key: str,
    fields: dict[str, str],
    analyzer: Analyzer = SEARCH,
    lang: str | None = None,
) -> DataFrame:
    """(key, field, pos, term, dl), one row per token; a narrow step."""
    return exploded(slot_table(docs, key, fields, analyzer, lang))


def with_running_sums(rows: DataFrame, numbers: str, out: str, width: int = 16, levels: int = 4) -> DataFrame:
    """``rows`` with the sums up to and with each of ``numbers``, an array, as ``out``.

    Sums are folded inside the row, no row meets another.  A fold copies the sums it has with
    each new one, so it runs over chunks of ``width`` numbers, over the chunks' sums in the
    same way, and ``levels`` deep: the work stays in proportion to the numbers.
    """
    if levels == 1:
        return rows.withColumn(out, folded_sums(F.col(numbers)))
    chunks, totals, before = f"{out}_{levels}_chunks", f"{out}_{levels}_totals", f"{out}_{levels}_before"
    starts = F.sequence(F.lit(1), F.greatest(F.size(numbers), F.lit(1)), F.lit(width))
    rows = rows.withColumn(chunks, F.transform(starts, lambda at: folded_sums(F.slice(numbers, at, width))))
    rows = rows.withColumn(totals, F.transform(chunks, lambda c: F.coalesce(F.get(c, F.size(c) - 1), F.lit(0).cast("long"))))
    rows = with_running_sums(rows, totals, before, width, levels - 1)
    later = F.zip_with(
        chunks,
        F.concat(F.array(F.lit(0).cast("long")), F.slice(before, 1, F.size(before) - 1)),
        lambda chunk, sum_before: F.transform(chunk, lambda n: n + sum_before),
    )
    return rows.withColumn(out, F.flatten(later)).drop(chunks, totals, before)


def folded_sums(numbers: Column) -> Column:
    last = lambda sums: F.coalesce(F.get(sums, F.size(sums) - 1), F.lit(0).cast("long"))
    return F.aggregate(
        numbers, F.array().cast("array<bigint>"), lambda sums, n: F.concat(sums, F.array(last(sums) + n))
    )


def offset_spans(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, spans): the tokens of each text as (term, start, end), in order.

    Offsets are in characters, the end exclusive; a null text or one without words has no
    spans.  Each match carries the gap before its word, so ends are running lengths.
    """
    none = F.array().cast("array<string>")
    matches = lambda pattern: F.coalesce(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)), none)
    # out of a generator, so that the text is matched once, however often the pieces are read
    found = docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"),
        F.explode(F.array(F.struct(
            matches(r"[\p{L}\p{N}]+").alias("terms"), matches(r"[^\p{L}\p{N}]*[\p{L}\p{N}]+").alias("pieces")
        ))).alias("f"),
    )
    sized = found.select("key", "text", "f.terms", F.transform("f.pieces", lambda p: F.length(p).cast("long")).alias("sizes"))

    def span(term: Column, end: Column) -> Column:
        return F.struct(term.alias("term"), (end - F.length(term)).alias("start"), end.alias("end"))

    # out of a generator again: conditions on the spans would work the sums out anew below it
    spans = F.array(F.struct(F.zip_with("terms", "ends", span).alias("spans")))
    ends = with_running_sums(sized, "sizes", "ends").select("key", "text", F.explode(spans).alias("s"))
    return ends.select("key", "text", "s.spans")


def token_offsets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, term, start, end), one row per token of ``offset_spans``; a narrow step."""
    rows = offset_spans(docs, key, text).select("key", F.posexplode_outer("spans").alias("pos", "span"))
    return rows.where(F.col("pos").isNotNull()).select("key", "pos", "span.*")


def pretokenized(docs: DataFrame, key: Column, tokens: Column) -> DataFrame:
    """Ready token arrays as a token table; position is the array index."""
    return docs.select(key.alias("key"), F.posexplode(tokens).alias("pos", "term"))


def row_postings(slots: DataFrame) -> DataFrame:
    """(key, field, term, tf, positions, dl) of each row of (key, field, slots, dl).

    A row's terms are sorted with their places and cut into runs of one term, all inside the
    row: no token becomes a row and nothing is shuffled.  Each step comes out of a generator,
    so that it is worked out once, however often the next one reads it.
    """
    once = lambda column: F.explode(F.array(column))
    placed = F.transform("slots", lambda term, pos: F.struct(term.alias("term"), pos.alias("pos")))
    ordered = slots.where(F.col("dl") > 0).select(
        "key", "field", "dl", once(F.sort_array(F.filter(placed, lambda s: s["term"].isNotNull()))).alias("s")
    )
    both = F.struct(F.col("s.term").alias("terms"), F.col("s.pos").alias("places"))
    parts = ordered.select("key", "field", "dl", once(both).alias("p")).select("key", "field", "dl", "p.*")
    first = lambda i: (i == 0) | (F.get("terms", i) != F.get("terms", i - 1))
    starts = F.filter(F.sequence(F.lit(0), F.size("terms") - 1), first)
    cut = parts.select("key", "field", "dl", "terms", "places", once(starts).alias("starts"))

    def run(at: Column, number: Column) -> Column:
        size = F.coalesce(F.get("starts", number + 1), F.size("terms")) - at
        return F.struct(F.get("terms", at).alias("term"), F.slice("places", at + 1, size).alias("positions"))

    # outer, as a plain one has Spark work out its input twice to leave out empty ones
    runs = cut.select("key", "field", "dl", F.inline_outer(F.transform("starts", run)))
    return runs.select("key", "field", "term", F.size("positions").cast("bigint").alias("tf"), "positions", "dl")


def build_postings(tokens: DataFrame | Streams) -> DataFrame:
    """(key, field, term, tf, positions, dl); a list holds one document's positions only.

    Of ``Streams`` each document's postings are built inside its row.  Keys of several
    documents, null ones too, are one document: those alone are grouped.
    """
    if isinstance(tokens, Streams):
        docs, key = tokens.docs, tokens.key
        several = docs.groupBy(F.col(key).alias("key_")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key_")
        several = stored(several, "repeated-keys")
        if several.isEmpty():
            return row_postings(tokens.analyse(docs))
        same = F.col(key).eqNullSafe(F.col("key_"))
        single = row_postings(tokens.analyse(docs.join(several, same, "left_anti")))
        return single.unionByName(merged(row_postings(tokens.analyse(docs.join(several, same, "left_semi")))))
    return tokens.groupBy("key", "field", "term").agg(
        F.count(F.lit(1)).alias("tf"),
        F.sort_array(F.collect_list("pos")).alias("positions"),
        F.max("dl").alias("dl"),
    )


def merged(postings: DataFrame) -> DataFrame:
    """Postings with one row a document, field and term."""
    return postings.groupBy("key", "field", "term").agg(
        F.sum("tf").alias("tf"),
        F.sort_array(F.flatten(F.collect_list("positions"))).alias("positions"),
        F.max("dl").alias("dl"),
    )


def term_stats(postings: DataFrame) -> DataFrame:
    """(field, term, df, cf)."""
    return postings.groupBy("field", "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf")
    )


def write_postings(
    postings: DataFrame, path: str, buckets: int = BUCKETS, salts: int = 8, tasks: int | None = None
) -> None:
    """Postings as Parquet split by term bucket, so a term reads one folder.

    The salt spreads the rows of a hot term over several tasks and files; a task writes one
    file of each of its buckets, of one bucket unless there are fewer ``tasks`` than buckets
    and salts.  The number of buckets is part of the path, so that a reader cannot assume
    another.
    """
    bucket = F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")
    salt = F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int")
    places = buckets * salts
    tasks = min(tasks or places, places)
    place = (bucket * salts + salt).cast("bigint")
    # the bucket is worked out behind the shuffle, so that it is not moved with each row
    (
        postings.repartitionById(tasks, F.floor(place * tasks / places).cast("int"))
        .withColumn("bucket", bucket).withColumn("buckets", F.lit(buckets))
        .sortWithinPartitions("bucket", "term")
        .write.mode("errorifexists")
        .partitionBy("buckets", "bucket")
        .parquet(path)
    )


def read_postings(spark: SparkSession, path: str, terms: list[str] | None = None) -> DataFrame:
    """Postings written by ``write_postings``; naming terms prunes the scan to their buckets."""
    postings = spark.read.parquet(path)
    if terms is not None:
        one = postings.select("buckets").first()
        buckets = one.buckets if one else 1
        wanted = [F.pmod(F.xxhash64(F.lit(t)), F.lit(buckets)).cast("int") for t in terms]
        postings = postings.where(F.col("bucket").isin(*wanted) & F.col("term").isin(*terms))
    return postings.drop("buckets", "bucket")


@dataclass(frozen=True)
class Corpus:
    """What a query runs over.

    ``occurrences`` is (key, field, term, tf, positions, dl) and may hold several rows per
    document and term: freshly exploded tokens and stored postings answer the same queries.
    """

    docs: DataFrame
    key: str
    occurrences: DataFrame
    lengths: DataFrame
    analyzer: Analyzer = dataclass_field(default=SEARCH)
    written_stats: DataFrame | None = None
    buckets: int | None = None
    terms: DataFrame | None = None
    keys: DataFrame | None = None
    norms: DataFrame | None = None
    streams: Streams | None = None

    @classmethod
    def analyze(
        cls,
        docs: DataFrame,
        key: str,
        fields: dict[str, str],
        analyzer: Analyzer = SEARCH,
        lang: str | None = None,
    ) -> "Corpus":
        streams = token_streams(docs, key, fields, analyzer, lang)
        occurrences = exploded(streams.analyse(docs)).select(
            "key", "field", "term", F.lit(1).alias("tf"), F.array("pos").alias("positions"), "dl"
        )
        language = F.col(lang) if lang else None
        lengths = docs.select(
            F.col(key).alias("key"),
            *[
                F.size(analyzer.tokens(F.col(column), language)).alias(name)
                for name, column in fields.items()
            ],
        )
        return cls(docs, key, occurrences, lengths, analyzer, streams=streams)

    def stats_row(self, name: str) -> Column:
        """struct(n, avgdl) of a field: number of documents and mean length, as one scalar subquery.

        A saved index has them in a file of one row a field.
        """
        if self.written_stats is not None:
            row = self.written_stats.where(F.col("field") == name)
            return row.select(F.struct("n", "avgdl").alias("s")).scalar()
        return self.lengths.agg(
            F.struct(F.count(F.lit(1)).alias("n"), F.avg(F.col(name)).alias("avgdl")).alias("s")
        ).scalar()

    def stats(self, name: str) -> tuple[Column, Column]:
        row = self.stats_row(name)
        return row["n"], row["avgdl"]


def save_index(corpus: Corpus, path: str, tokens_per_bucket: int = 4_000_000, tokens_per_task: int = 20_000_000) -> None:
    """Postings by term bucket, document lengths and their statistics, written once for many
    searches.  Large files are dealt over tasks before they are analysed, so that a task's part
    of the shuffle fits its memory.  Small buckets share tasks.  The number of buckets follows from the tokens, and that of salts from the
    documents, which bound the rows of a term."""
    spark = corpus.docs.sparkSession
    corpus.lengths.write.mode("errorifexists").parquet(f"{path}/lengths")
    lengths = spark.read.parquet(f"{path}/lengths")
    fields = [c for c in lengths.columns if c != "key"]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("field"),
                F.count(F.lit(1)).alias("n"),
                F.avg(c).alias("avgdl"),
                F.sum(F.col(c).cast("bigint")).alias("tokens"),
            )
            for c in fields
        ]
    )
    lengths.agg(rows.alias("rows")).select(F.inline("rows")).write.parquet(f"{path}/stats")
    total, n = spark.read.parquet(f"{path}/stats").agg(F.sum("tokens"), F.max("n")).first()
    if corpus.streams is None:
        postings = merged(corpus.occurrences)
    else:
        postings = build_postings(corpus.streams.spread(max(8, -(-(total or 0) // tokens_per_task))))
    buckets = max(8, -(-(total or 0) // tokens_per_bucket))
    # a task has a term's rows of one salt at least; beyond that, salts are for small indexes
    needed = 1 + (n or 0) // max(tokens_per_bucket, ROWS_PER_TASK)
    salts = max(needed, min(1 + (n or 0) // tokens_per_bucket, FEW_TASKS // buckets))
    tasks = max(FEW_TASKS, -(-(total or 0) // ROWS_PER_TASK) * salts)
    write_postings(postings, f"{path}/postings", buckets, salts, tasks)
    written = spark.read.parquet(f"{path}/postings")
    write_terms(written, f"{path}/terms")
    terms = spark.read.parquet(f"{path}/terms")
    write_keys(terms, f"{path}/keys")
    write_norms(written, terms, spark.read.parquet(f"{path}/stats"), f"{path}/norms")


def postings_of(corpus: Corpus, terms: list[str]) -> DataFrame:
    """The postings of named terms; of a saved index only their buckets are read."""
    rows = corpus.occurrences.where(F.col("term").isin(*terms))
    if corpus.buckets:
        wanted = [F.pmod(F.xxhash64(F.lit(t)), F.lit(corpus.buckets)).cast("int") for t in terms]
        rows = rows.where(F.col("bucket").isin(*wanted))
    return rows.select("key", "field", "term", "tf", "dl")


def write_norms(postings: DataFrame, terms: DataFrame, stats: DataFrame, path: str) -> None:
    """(key, field, norm): the length of each document's vector of tf * ln(N / df).

    A term of a third of all documents is one row of ``terms`` and many rows of postings, a
    skewed join that adaptive execution splits.
    """
    rarity = terms.join(stats, "field").select(
        "bucket", "field", "term", F.log(F.col("n") / F.col("df")).alias("rarity")
    )
    weights = postings.select("bucket", "field", "term", "key", "tf").join(rarity, ["bucket", "field", "term"])
    weight = F.col("tf") * F.col("rarity")
    weights.groupBy("key", "field").agg(F.sqrt(F.sum(weight * weight)).alias("norm")).write.parquet(path)


def load_index(docs: DataFrame, key: str, path: str, analyzer: Analyzer = SEARCH) -> Corpus:
    """A corpus over a saved index: no text is analysed.  Queries read the buckets of their
    terms; the dictionary tells the terms of prefixes, patterns and spellings."""
    spark = docs.sparkSession
    postings = spark.read.parquet(f"{path}/postings")
    one = postings.select("buckets").first()
    return Corpus(
        docs,
        key,
        postings.drop("buckets"),
        spark.read.parquet(f"{path}/lengths"),
        analyzer,
        spark.read.parquet(f"{path}/stats"),
        one.buckets if one else 1,
        spark.read.parquet(f"{path}/terms"),
        spark.read.parquet(f"{path}/keys"),
        spark.read.parquet(f"{path}/norms"),
    )
