"""Loading, schema, maintenance and upkeep queries."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrid.operators import queries as q
from lexigrid.operators.postings import Corpus
from lexigrid.plans.catalog import SQL_TOKENS, corpus, documents, plan, table
from lexigrid.session import shared_folder
from lexigrid.sources import schema as sc
from lexigrid.sources import tables as tb

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@plan(
    "load_documents",
    """
    SELECT k AS format, lang, count(*) AS n, sum(length(text))::BIGINT AS chars, sum(doc_id)::BIGINT AS ids, bit_xor(hash_part) AS digest
    FROM (SELECT *, ('0x' || substring(md5(text), 1, 12))::BIGINT AS hash_part FROM documents),
         (VALUES ('parquet'), ('json'), ('csv')) f(k) GROUP BY 1, 2""",
)
def load_documents(spark, d):
    """Documents written and read back in each format give the same texts."""
    docs = table(spark, d, "documents")
    parts = []
    for kind in ("parquet", "json", "csv"):
        path = f"{d}/documents.parquet" if kind == "parquet" else shared_folder(spark, f"documents-{kind}")
        if kind != "parquet":
            tb.save_documents(docs, path, kind)
        parts.append(tb.load_documents(spark, path, kind, DOCUMENT).withColumn("format", F.lit(kind)))
    loaded = functools.reduce(DataFrame.unionByName, parts)
    piece = F.conv(F.substring(F.md5("text"), 1, 12), 16, 10).cast("bigint")
    return loaded.groupBy("format", "lang").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("text")).alias("chars"),
        F.sum("doc_id").alias("ids"),
        F.bit_xor(piece).alias("digest"),
    )


PART = sc.SearchSchema(
    (
        sc.Field("p_partkey", "u64", fast=True),
        sc.Field("p_name", "text"),
        sc.Field("p_type", "facet"),
        sc.Field("p_size", "i64", fast=True),
        sc.Field("p_retailprice", "f64", fast=True),
        sc.Field("p_brand", "text", stored=False, analyzer="raw"),
    )
)


@plan(
    "apply_schema",
    "SELECT p_partkey, p_name, '/' || p_type AS p_type, p_size::BIGINT AS p_size, p_retailprice FROM part",
)
def apply_schema(spark, d):
    """Part columns as raw text, typed again by a declared schema; only stored fields return."""
    part = table(spark, d, "part")
    raw = part.select(*[F.col(c).cast("string").alias(c) for c in part.columns])
    return sc.apply_schema(raw, PART, only_stored=True)


EVENT = sc.SearchSchema(
    (
        sc.Field("event_id", "u64"),
        sc.Field("ts", "date"),
        sc.Field("user_id", "u64"),
        sc.Field("value", "f64"),
        sc.Field("bought", "bool"),
        sc.Field("props", "json"),
        sc.Field("ip", "ip_addr"),
    )
)


def raw_events(spark, d) -> DataFrame:
    """Events as raw text, with values of some event types made invalid."""
    kind = F.col("event_type")
    return table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(kind == "view", F.lit("soon")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("ts"),
        F.when(kind == "signup", F.concat(F.lit("-"), "user_id")).otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(kind == "error", F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
        F.when(kind == "purchase", "1").when(kind == "click", "maybe").otherwise("False").alias("bought"),
        F.when(kind == "error", F.concat("props", F.lit("}"))).otherwise(F.col("props")).alias("props"),
        F.when(kind == "signup", F.lit("300.1.2.3")).otherwise(F.concat(F.lit("10.0.0."), F.col("user_id") % 256)).alias("ip"),
        kind.alias("event_type"),
    )


SQL_EVENT_ERRORS = """
    CASE event_type WHEN 'view' THEN 'ts' WHEN 'signup' THEN {signup} WHEN 'error' THEN 'value,props'
         WHEN 'click' THEN 'bought' ELSE '' END"""


@plan(
    "validate_documents",
    f"""
    SELECT event_id, CASE WHEN event_type <> 'view' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts,
           CASE WHEN event_type <> 'signup' OR user_id = 0 THEN user_id END AS user_id,
           CASE WHEN event_type <> 'error' THEN value END AS value,
           CASE WHEN event_type = 'purchase' THEN true WHEN event_type <> 'click' THEN false END AS bought,
           {SQL_EVENT_ERRORS.format(signup="CASE WHEN user_id = 0 THEN 'ip' ELSE 'user_id,ip' END")} AS bad_fields, event_type FROM events""",
)
def validate_documents(spark, d):
    checked = sc.validate(raw_events(spark, d), EVENT)
    return checked.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
        "user_id",
        "value",
        "bought",
        F.array_join("errors.field", ",").alias("bad_fields"),
        "event_type",
    )


@plan(
    "lenient_cast",
    """
    SELECT event_type, count(*) AS n, count(*) FILTER (event_type <> 'view') AS n_ts,
           count(*) FILTER (event_type <> 'signup' OR user_id = 0) AS n_user,
           count(*) FILTER (event_type <> 'error') AS n_value, count(*) FILTER (event_type <> 'click') AS n_bought
    FROM events GROUP BY event_type""",
)
def lenient_cast(spark, d):
    """Non-null values left per event type after casting what can be cast."""
    cast = sc.lenient_cast(raw_events(spark, d), EVENT)
    return cast.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("ts").alias("n_ts"),
        F.count("user_id").alias("n_user"),
        F.count("value").alias("n_value"),
        F.count("bought").alias("n_bought"),
    )


@plan(
    "ingest_batch",
    """
    SELECT CASE WHEN source = 'src7' THEN 'rejected' ELSE 'accepted' END AS verdict, count(*) AS n, count(*) AS counted,
           sum(doc_id)::BIGINT AS ids FROM documents GROUP BY 1""",
)
def ingest_batch(spark, d):
    """Documents with a broken number go beside the accepted ones; counts come from the write."""
    raw = table(spark, d, "documents").withColumn(
        "n_chars", F.when(F.col("source") == "src7", "n/a").otherwise(F.col("n_chars").cast("string"))
    )
    declared = sc.SearchSchema(
        (sc.Field("doc_id", "u64"), sc.Field("text", "text"), sc.Field("n_chars", "u64"))
    )
    path = shared_folder(spark, "ingest")
    counts = tb.ingest(raw, declared, path, continue_on_error=True)
    stored = spark.read.parquet(path)
    counted = F.when(F.col("verdict") == "accepted", counts["accepted"]).otherwise(counts["rejected"])
    return (
        stored.groupBy("verdict")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"))
        .withColumn("counted", counted.cast("bigint"))
    )


@plan(
    "flatten_json",
    """
    SELECT event_id, user_id AS user_id, event_type AS what_kind, value AS what_amount_value,
           regexp_extract(props, ': ([0-9]+)', 1)::BIGINT AS what_amount_k, event_type || ',' || user_id AS tags FROM events""",
)
def flatten_json(spark, d):
    """Nested JSON text built from event columns, flattened by its declared schema."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    nested = table(spark, d, "events").select(
        "event_id",
        F.to_json(
            F.struct(
                F.struct(F.col("user_id").alias("id")).alias("user"),
                F.struct(
                    F.col("event_type").alias("kind"),
                    F.struct("value", k.alias("k")).alias("amount"),
                ).alias("what"),
                F.array("event_type", F.col("user_id").cast("string")).alias("tags"),
            )
        ).alias("json"),
    )
    declared = T.StructType.fromDDL(
        "user struct<id:bigint>, what struct<kind:string, amount:struct<value:double,k:bigint>>, tags array<string>"
    )
    flat = sc.flatten_json(nested, "json", declared, separator="_")
    return flat.withColumn("tags", F.array_join("tags", ","))


@plan(
    "map_json_paths",
    """
    SELECT regexp_extract(props, ': ([0-9]+)', 1) AS k, NULL::VARCHAR AS missing, count(*) AS n FROM events GROUP BY 1""",
)
def map_json_paths(spark, d):
    mapped = sc.map_json_paths(table(spark, d, "events"), "props", {"k": "k", "a.b": "missing"})
    return mapped.groupBy("k", "missing").agg(F.count(F.lit(1)).alias("n"))


@plan(
    "delete_by_term",
    rf"""
    WITH {SQL_TOKENS},
    lines AS (SELECT doc_id, ' ' || string_agg(term, ' ' ORDER BY pos) || ' ' AS line FROM toks GROUP BY doc_id)
    SELECT 'word' AS deleted, d.doc_id FROM documents d LEFT JOIN lines l USING (doc_id) WHERE coalesce(line, '') NOT LIKE '% thing %'
    UNION ALL SELECT 'phrase', d.doc_id FROM documents d LEFT JOIN lines l USING (doc_id) WHERE coalesce(line, '') NOT LIKE '% in the %'""",
)
def delete_by_term(spark, d):
    """Documents left after deleting by a word and by a phrase."""
    docs = corpus(spark, d)
    by_word = tb.delete_by_term(docs.docs, "doc_id", docs, "text", "Thing")
    by_phrase = tb.delete_by_term(docs.docs, "doc_id", docs, "text", "in the")
    return by_word.select(F.lit("word").alias("deleted"), "doc_id").unionByName(
        by_phrase.select(F.lit("phrase").alias("deleted"), "doc_id")
    )


@plan(
    "delete_by_query",
    """
    SELECT 'range or language' AS deleted, count(*) AS n_left FROM documents WHERE NOT (n_chars > 2000 OR lang = 'fr')
    UNION ALL SELECT 'all', 0""",
)
def delete_by_query(spark, d):
    docs = table(spark, d, "documents")
    source = Corpus(docs, "doc_id", docs, docs)
    either = q.Bool(should=(q.Range("n_chars", low=2000, include_low=False), q.TypedTerm("lang", "fr")))
    some = tb.delete_by_query(docs, "doc_id", source, either).agg(F.count(F.lit(1)).alias("n_left"))
    none = tb.delete_by_query(docs, "doc_id", source, q.All()).agg(F.count(F.lit(1)).alias("n_left"))
    return some.select(F.lit("range or language").alias("deleted"), "n_left").unionByName(
        none.select(F.lit("all").alias("deleted"), "n_left")
    )


@plan(
    "upsert_documents",
    """
    WITH changes AS (
        SELECT doc_id, 'quality ' || quality AS text, 'xx' AS lang, 1 AS seq FROM labels
        UNION ALL SELECT doc_id, 'toxic ' || toxic, 'yy', 2 FROM labels WHERE toxic = 1
        UNION ALL SELECT item_id + 1000000, text, 'new', 1 FROM benchmark),
    latest AS (SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY seq DESC) = 1),
    final AS (SELECT doc_id, text, lang FROM latest
              UNION ALL SELECT doc_id, text, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM latest))
    SELECT doc_id, lang, md5(text) AS digest FROM final""",
)
def upsert_documents(spark, d):
    """Changed twice, changed once, new and untouched documents; the later change wins."""
    labels = table(spark, d, "labels")
    first = labels.select(
        "doc_id", F.concat(F.lit("quality "), "quality").alias("text"), F.lit("xx").alias("lang"), F.lit(1).alias("seq")
    )
    second = labels.where("toxic = 1").select(
        "doc_id", F.concat(F.lit("toxic "), "toxic").alias("text"), F.lit("yy").alias("lang"), F.lit(2).alias("seq")
    )
    added = table(spark, d, "benchmark").select(
        (F.col("item_id") + 1000000).alias("doc_id"), "text", F.lit("new").alias("lang"), F.lit(1).alias("seq")
    )
    changes = first.unionByName(second).unionByName(added)
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    merged = tb.upsert(docs, changes, "doc_id", "seq")
    return merged.select("doc_id", "lang", F.md5("text").alias("digest"))


@plan(
    "verified_rebuild",
    """
    SELECT 1::INT AS version, count(*) AS n, true AS enough, true AS no_nulls, true AS finds_thing,
           false AS second_published, false AS third_published
    FROM documents""",
)
def verified_rebuild(spark, d):
    """A version that passes its checks becomes current; one that fails stays invisible."""
    docs = table(spark, d, "documents")
    root = shared_folder(spark, "versions")
    checks = {"enough": F.count(F.lit(1)) > 10, "no_nulls": F.count_if(F.col("text").isNull()) == 0}
    good = tb.write_version(
        docs, root, 1, checks,
        {"finds_thing": q.Term("text", "thing")},
    )
    empty = docs.where(F.lit(False))
    bad = tb.write_version(empty, root, 2, checks, {})
    # rows enough, but the searched word was lost on the way: only a search tells
    broken = docs.withColumn("text", F.regexp_replace("text", "(?i)thing", "q"))
    worse = tb.write_version(broken, root, 3, checks, {"finds_thing": q.Term("text", "thing")})
    current = tb.read_current(spark, root)
    return current.agg(F.count(F.lit(1)).alias("n")).withColumns(
        {
            "version": F.lit(tb.current_version(spark, root)),
            **{name: F.lit(value) for name, value in good.items()},
            "second_published": F.lit(all(bad.values())),
            "third_published": F.lit(all(worse.values())),
        }
    )


@plan(
    "route_partitions",
    """
    SELECT 'type' AS routing, event_type AS route, count(*) AS n FROM events GROUP BY 2
    UNION ALL SELECT 'year_month', strftime(ts, '%Y-%m'), count(*) FROM events GROUP BY 2
    UNION ALL SELECT 'hash', '8 shards', count(*) FROM events""",
)
def route_partitions(spark, d):
    """Events written to partition folders by each rule and counted from there."""
    events = table(spark, d, "events")
    parts = []
    for by, column in (("type", "event_type"), ("year_month", "ts"), ("hash", "event_id")):
        path = shared_folder(spark, f"routed-{by}")
        tb.write_routed(tb.route(events, by, column), path, "event_id")
        stored = spark.read.parquet(path).withColumn("route", F.col("route").cast("string"))
        counts = stored.groupBy("route").agg(F.count(F.lit(1)).alias("n"))
        if by == "hash":
            counts = counts.agg(
                F.concat(F.count(F.lit(1)).cast("string"), F.lit(" shards")).alias("route"), F.sum("n").alias("n")
            )
        parts.append(counts.select(F.lit(by).alias("routing"), "route", "n"))
    return functools.reduce(DataFrame.unionByName, parts)


@plan(
    "migrate_schema",
    """
    SELECT p_partkey AS id, p_name AS title, round(p_retailprice * 100)::BIGINT AS price_cents, p_brand || '/' || p_type AS category
    FROM part""",
)
def migrate_schema(spark, d):
    return tb.migrate(
        table(spark, d, "part"),
        rename={"p_partkey": "id", "p_name": "title"},
        derive={
            "price_cents": F.round(F.col("p_retailprice") * 100).cast("bigint"),
            "category": F.concat_ws("/", "p_brand", "p_type"),
        },
        drop=["p_brand", "p_type", "p_size", "p_retailprice"],
    )


@plan(
    "compact_table",
    """
    SELECT 16::BIGINT AS files_before, 1::BIGINT AS files_after, count(*) AS n, sum(doc_id)::BIGINT AS ids
    FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
)
def compact_table(spark, d):
    """Many small files into few, without the documents labelled toxic."""
    scattered, path = shared_folder(spark, "scattered"), shared_folder(spark, "compact")
    table(spark, d, "documents").repartition(16).write.parquet(scattered)
    many = spark.read.parquet(scattered)
    tb.compact(many, table(spark, d, "labels").where("toxic = 1"), "doc_id", path)
    few = spark.read.parquet(path)
    before = many.select(F.input_file_name().alias("f")).distinct().agg(F.count(F.lit(1)))
    after = few.select(F.input_file_name().alias("f")).distinct().agg(F.count(F.lit(1)))
    return few.agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids")).withColumns(
        {"files_before": before.scalar(), "files_after": after.scalar()}
    )


SQL_PROFILE = """
    p AS (SELECT count(*) AS n, sum(octet_length(encode(text))) AS t, sum(octet_length(encode(lang))) AS l,
                 sum(octet_length(encode(source))) AS s FROM documents),
    f AS (SELECT 'doc_id' AS field, n * 8 AS bytes, n FROM p UNION ALL SELECT 'text', t, n FROM p
          UNION ALL SELECT 'lang', l, n FROM p UNION ALL SELECT 'source', s, n FROM p UNION ALL SELECT 'n_chars', n * 8, n FROM p)"""


@plan(
    "field_space_profile",
    f"""
    WITH {SQL_PROFILE}, gone AS (SELECT count(*) AS g FROM labels WHERE toxic = 1)
    SELECT field, bytes::BIGINT AS bytes, n AS n_docs, round(bytes / sum(bytes) OVER (), 6) AS share, round(bytes / n, 4) AS bytes_per_doc,
           round(g / (n + g), 6) AS deleted_share,
           concat_ws(',', CASE WHEN bytes / sum(bytes) OVER () > 0.5 THEN 'large field' END,
                          CASE WHEN g / (n + g) > 0.1 THEN 'compact deletes' END, 'merge segments') AS advice
    FROM f, gone""",
)
def field_space_profile(spark, d):
    """Bytes per field of documents; toxic labels stand for deletes, 12 segments are given."""
    gone = table(spark, d, "labels").where("toxic = 1").agg(F.count(F.lit(1))).scalar()
    profile = tb.space_profile(table(spark, d, "documents"), gone, F.lit(12))
    return profile.select(
        "field", "bytes", "n_docs", F.round("share", 6).alias("share"),
        F.round("bytes_per_doc", 4).alias("bytes_per_doc"),
        F.round("deleted_share", 6).alias("deleted_share"), F.array_join("advice", ",").alias("advice"),
    )


@plan(
    "compare_profiles",
    f"""
    WITH {SQL_PROFILE},
    e AS (SELECT count(*) AS n, sum(octet_length(encode(text))) AS t, sum(octet_length(encode(source))) AS s FROM documents WHERE lang = 'en'),
    g AS (SELECT 'doc_id' AS field, n * 8 AS bytes, n FROM e UNION ALL SELECT 'text', t, n FROM e UNION ALL SELECT 'source', s, n FROM e)
    SELECT f.field, (coalesce(g.bytes, 0) - f.bytes)::BIGINT AS bytes_delta, (coalesce(g.n, 0) - f.n)::BIGINT AS docs_delta,
           round((coalesce(g.bytes, 0) - f.bytes) * 100.0 / f.bytes, 4) AS bytes_percent
    FROM f LEFT JOIN g USING (field)""",
)
def compare_profiles(spark, d):
    """All documents against the English ones with two fields dropped."""
    docs = table(spark, d, "documents")
    smaller = docs.where("lang = 'en'").drop("lang", "n_chars")
    compared = tb.compare_profiles(tb.space_profile(docs), tb.space_profile(smaller))
    return compared.withColumn("bytes_percent", F.round("bytes_percent", 4))


@plan(
    "complex_document",
    """
    WITH s AS (SELECT l_partkey, min(l_suppkey) AS suppkey FROM lineitem GROUP BY 1)
    SELECT p_partkey AS id, lower(p_name || ' ' || p_brand || ' ' || p_type || ' ' || s_name) AS search_text,
           '/' || p_brand || '/' || p_type AS category_path, round(p_retailprice * 100)::BIGINT AS price_cents,
           s_name AS maker_name, n_name AS maker_country
    FROM part JOIN s ON p_partkey = l_partkey JOIN supplier ON suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
)
def complex_document(spark, d):
    """Products with their first supplier as nested maker, flattened for search."""
    first = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.min("l_suppkey").alias("s_suppkey"))
    makers = table(spark, d, "supplier").join(
        table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    nested = (
        table(spark, d, "part")
        .join(first, F.col("p_partkey") == F.col("l_partkey"))
        .join(makers, "s_suppkey")
        .select(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("name"),
            F.array("p_brand", "p_type").alias("categories"),
            F.col("p_retailprice").alias("price"),
            F.struct(F.col("s_name").alias("name"), F.col("n_name").alias("country")).alias("maker"),
        )
    )
    return tb.product_documents(nested)
