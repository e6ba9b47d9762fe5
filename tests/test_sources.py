import os
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrid.operators import queries as q
from lexigrid.operators.postings import Corpus
from lexigrid.session import shared_folder
from lexigrid.sources import schema as sc
from lexigrid.sources import tables as tb
from lexigrid.streaming import jobs

DECLARED = sc.SearchSchema(
    (
        sc.Field("title", "text"), sc.Field("id", "u64"), sc.Field("score", "f64"),
        sc.Field("published", "bool"), sc.Field("created_at", "date"),
    )
)


def check(spark, schema=DECLARED, strict=False, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return sc.validate(df, schema, strict).first()


@pytest.mark.parametrize(
    "field, text, expected",
    [
        ("id", "42", 42), ("id", "-1", None), ("id", "not_a_number", None), ("published", "false", False),
        ("published", "1", True), ("published", "maybe", None), ("score", "85.5", 85.5), ("score", "x", None),
    ],
)
def test_coercion(spark, field, text, expected):
    row = check(spark, **{field: text})
    assert row[field] == expected
    assert [e.field for e in row.errors] == ([] if expected is not None else [field])


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1672531200", "2023-01-01 00:00:00"), ("2023-01-01T00:00:00Z", "2023-01-01 00:00:00"),
        ("2023-01-01T02:00:00+02:00", "2023-01-01 00:00:00"), ("2023-01-01", "2023-01-01 00:00:00"), ("soon", None),
    ],
)
def test_dates(spark, text, expected):
    row = check(spark, created_at=text)
    assert (str(row.created_at) if row.created_at else None) == expected


@pytest.mark.parametrize(
    "kind, good, bad",
    [
        ("ip_addr", ["192.168.1.100", "::1", "2001:db8::ff00:42:8329", "1:2:3:4:5:6:7:8"], ["256.1.1.1", "1.2.3", "1::2::3", "12345::"]),
        ("json", ['{"a": 1}', "[1, 2]", '"x"'], ['{"a": 1}}', "{", "1, 2"]),
        ("bytes", ["aGVsbG8=", ""], ["a", "****"]),
        ("facet", ["/a/b", "a"], ["/", "/a//b", "/a/"]),
    ],
)
def test_kinds(spark, kind, good, bad):
    declared = sc.SearchSchema((sc.Field("x", kind),))
    for text in good:
        assert not check(spark, declared, x=text).errors, text
    for text in bad:
        assert check(spark, declared, x=text).errors, text


def test_unknown_fields(spark):
    assert not check(spark, id="1", extra="x").errors
    assert [e.field for e in check(spark, strict=True, id="1", extra="x").errors] == ["extra"]


def test_schema_declaration():
    for fields in ((), (sc.Field("a", "text"), sc.Field("a", "u64")), (sc.Field("a", "decimal"),)):
        with pytest.raises(ValueError):
            sc.SearchSchema(fields)
    assert DECLARED.kind("id") == "u64"
    assert DECLARED.struct()["title"].metadata["stored"]


def test_ingest(spark):
    df = spark.createDataFrame([("1", "a"), ("x", "b"), ("3", "c")], "id string, title string")
    path = shared_folder(spark, "ingest")
    assert tb.ingest(df, DECLARED, path, continue_on_error=True) == {"accepted": 2, "rejected": 1}
    assert spark.read.parquet(path).where("verdict = 'rejected'").first().title == "b"
    with pytest.raises(tb.RejectedDocuments):
        tb.ingest(df, DECLARED, shared_folder(spark, "ingest"))


def test_flatten(spark):
    declared = T.StructType.fromDDL("a struct<b:int, c:struct<d:string>>, l array<int>")
    df = spark.createDataFrame([(1, '{"a": {"b": 2, "c": {"d": "x"}}, "l": [1]}')], "id long, j string")
    row = sc.flatten_json(df, "j", declared).first()
    assert row.asDict() == {"id": 1, "a.b": 2, "a.c.d": "x", "l": [1]}
    mapped = sc.map_json_paths(df, "j", {"a.c.d": "deep", "a.z": "gone"}).first()
    assert (mapped.deep, mapped.gone) == ("x", None)


def test_upsert_last_write_wins(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "id long, t string")
    changes = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "new", 1)], "id long, t string, seq int")
    found = {r.id: r.t for r in tb.upsert(docs, changes, "id", "seq").collect()}
    assert found == {1: "a", 2: "y", 3: "new"}


def test_deletes(spark, guides):
    corpus = Corpus.analyze(guides, "id", {"title": "title", "content": "content"})

    def left(df):
        return sorted(r.id for r in df.collect())

    assert left(tb.delete_by_query(guides, "id", corpus, q.All())) == []
    assert left(tb.delete_by_term(guides, "id", corpus, "title", "SOURDOUGH")) == [2, 3, 4]
    assert left(tb.delete_by_term(guides, "id", corpus, "content", "bread crumbs")) == [1, 3, 4]
    assert left(tb.delete_by_term(guides, "id", corpus, "content", "crumbs bread")) == [1, 2, 3, 4]
    assert left(tb.delete_by_term(guides, "id", corpus, "content", "crumbs bread", positions=False)) == [1, 3, 4]


def test_typed_deletes_and_updates(spark, guides):
    corpus = Corpus.analyze(guides, "id", {"title": "title", "content": "content"})
    assert sorted(r.id for r in tb.delete_by_term(guides, "id", corpus, "price", "12").collect()) == [1, 3, 4]
    assert sorted(r.id for r in tb.delete_by_term(guides, "id", corpus, "active", "false").collect()) == [1, 3, 4]
    new = guides.where("id = 3").withColumn("id", F.lit(9).cast("long"))
    assert sorted(r.id for r in tb.update_by_term(guides, "id", corpus, "title", "sourdough", new).collect()) == [2, 3, 4, 9]


def test_a_version_is_searched_before_it_counts(spark, guides):
    root = shared_folder(spark, "versions")
    lost = guides.where("id <> 1")
    found = tb.write_version(lost, root, 1, {}, {"loaf": q.Term("title", "sourdough")}, "id", {"title": "title"})
    assert found == {"loaf": False}


def test_versions(spark, guides):
    root = shared_folder(spark, "versions")
    checks = {"some": F.count(F.lit(1)) > 0}
    assert tb.write_version(guides, root, 1, checks, {}) == {"some": True}
    assert tb.write_version(guides.where("false"), root, 2, checks, {}) == {"some": False}
    assert tb.current_version(spark, root) == 1 and tb.read_current(spark, root).count() == 4


def test_stream_ingest_keeps_the_latest_document(spark):
    folder, root = shared_folder(spark, "in"), shared_folder(spark, "out")
    declared = sc.SearchSchema((sc.Field("id", "u64"), sc.Field("t", "text")))
    first = spark.createDataFrame([("1", "old words"), ("2", "stay"), ("bad", "x")], "id string, t string")
    first.write.parquet(folder)
    for _ in range(2):
        stream = jobs.read_stream(spark, folder, first.schema)
        jobs.stream_ingest(stream, declared, "id", "t", root).awaitTermination()
        spark.createDataFrame([("1", "new text")], first.schema).write.mode("append").parquet(folder)
    assert {r.id: r.t for r in jobs.ingested(spark, root, "id").collect()} == {1: "new text", 2: "stay"}
    terms = {r.term for r in jobs.ingested_postings(spark, root, "id").collect()}
    assert terms == {"new", "text", "stay"}


def test_stream_of_a_table_that_is_a_file_or_a_folder(spark):
    """A table's name may be one file or a folder of part files; other tables stay out."""
    root = shared_folder(spark, "tables")
    rows = spark.range(10).repartition(3)
    rows.write.parquet(f"{root}/folder.parquet")
    rows.coalesce(1).write.parquet(f"{root}/parts")
    part = next(p for p in os.listdir(f"{root}/parts") if p.endswith(".parquet"))
    shutil.copy(f"{root}/parts/{part}", f"{root}/file.parquet")
    for name in ("folder.parquet", "file.parquet"):
        seen, to = jobs.read_stream(spark, root, rows.schema, name), shared_folder(spark, "seen")
        seen.writeStream.option("checkpointLocation", f"{to}/p").trigger(availableNow=True).start(f"{to}/rows").awaitTermination()
        assert sorted(r.id for r in spark.read.parquet(f"{to}/rows").collect()) == list(range(10))


def test_a_key_twice_in_a_batch(spark):
    folder, root = shared_folder(spark, "in"), shared_folder(spark, "out")
    declared = sc.SearchSchema((sc.Field("id", "u64"), sc.Field("t", "text"), sc.Field("at", "u64")))
    rows = [("1", "new text", "2"), ("1", "old words", "1"), ("1", "old words", "1")]
    first = spark.createDataFrame(rows, "id string, t string, at string")
    first.write.parquet(folder)
    stream = jobs.read_stream(spark, folder, first.schema)
    jobs.stream_ingest(stream, declared, "id", "t", root, sequence="at").awaitTermination()
    assert [(r.id, r.t) for r in jobs.ingested(spark, root, "id").collect()] == [(1, "new text")]
    assert {r.term: r.tf for r in jobs.ingested_postings(spark, root, "id").collect()} == {"new": 1, "text": 1}


def test_sliding_windows(spark):
    folder, root = shared_folder(spark, "in"), shared_folder(spark, "out")
    rows = [("2024-01-01 00:10:00", True, False, 0), ("2024-01-01 00:50:00", True, False, 4), ("2024-01-01 01:10:00", False, True, None)]
    df = spark.createDataFrame(rows, "ts string, is_search boolean, is_click boolean, result_count long")
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(folder)
    stats = jobs.windowed_stats(jobs.read_stream(spark, folder, df.schema), "ts", "1 hour", "30 minutes")
    jobs.stream_stats(stats, root).awaitTermination()
    found = {str(r.start)[11:16]: (r.searches, r.clicks, r.zero_result, r.results) for r in jobs.latest_windows(spark, root).collect()}
    assert found == {"23:30": (1, 0, 1, 0), "00:00": (2, 0, 1, 4), "00:30": (1, 1, 0, 4), "01:00": (0, 1, 0, 0)}
