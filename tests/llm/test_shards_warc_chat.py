"""Hilbert sharding, WARC archives and chat formatting."""

import base64
import binascii
import hashlib
import io
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexigrid.llm import chat, hilbert, warc
from lexigrid.llm.queries import QUERIES
from lexigrid.session import shared_folder

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("bits, dims", [(1, 2), (3, 2), (2, 3), (3, 3)])
def test_curve_visits_neighbours(spark, bits, dims):
    n = 1 << bits
    cells = spark.range(n**dims).select(
        *[(F.floor(F.col("id") / n**d) % n).cast("int").alias(f"x{d}") for d in range(dims)]
    )
    rows = cells.withColumn("h", hilbert.hilbert_index([F.col(f"x{d}") for d in range(dims)], bits)).collect()
    rows.sort(key=lambda r: r.h)
    assert [r.h for r in rows] == list(range(n**dims))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[f"x{d}"] - b[f"x{d}"]) for d in range(dims)) == 1


def test_shards_against_brute_force(spark):
    rows = QUERIES["op3_hilbert_sharding"](spark, SF_DIR).toPandas()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").toPandas().set_index("doc_id")
    assert sorted(rows.doc_id) == sorted(docs.index)
    counts = rows.groupby("shard").size()
    assert list(counts.index) == list(range(24)) and counts.max() - counts.min() <= 1
    for _, part in rows.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    ordered = rows.sort_values(["hilbert", "doc_id"])
    assert ordered.shard.is_monotonic_increasing
    for r in rows.itertuples():
        text = docs.text[r.doc_id].encode()
        assert r.size == len(text) + 8 and r.text_crc32 == binascii.crc32(text)


DOCS = "doc_id long, text string, lang string, source string, rank long, total string"
ODD = [(1, None, None, None, 5, "x"), (2, "", "en", "a", 5, "x"), (None, "a b", "en", None, 5, None),
       (3, "same", "en", "a", 1, "x"), (3, "same", "en", "a", 1, "x"), (4, "word " * 30_000, "de", "b", 0, "")]


def test_shards_of_odd_rows(spark):
    rows = hilbert.hilbert_shards(spark.createDataFrame(ODD, DOCS), n_shards=4).collect()
    assert len(rows) == len(ODD) and sorted(r.shard for r in rows) in ([0, 0, 1, 2, 2, 3], [0, 0, 1, 1, 2, 3], [0, 1, 1, 2, 2, 3], [0, 0, 1, 2, 3, 3], [0, 1, 2, 2, 3, 3], [0, 1, 1, 2, 3, 3])
    assert hilbert.hilbert_shards(spark.createDataFrame([], DOCS)).count() == 0


def test_written_shards_prune(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    path = str(tmp_path / "shards")
    hilbert.write_shards(docs, hilbert.hilbert_shards(docs, n_shards=4), path)
    back = spark.read.parquet(path)
    assert back.count() == docs.count() and sorted(os.listdir(path))[-1] == "shard=3"


PAGES = "page_id long, url string, html string, extra int"
HTML = "<p>" + "some words of a page " * 40 + "{}</p>"
ODD_PAGES = [(5, "http://a/\r\nX: 1%", HTML.format(1), 0), (3, None, HTML.format(1), 1), (9, "u", None, 2),
             (8, "v", "", 3), (7, "w", HTML.format(2), 4), (7, "w", HTML.format(2), 4), (None, "n", HTML.format(3), 5),
             (11, "x", "WARC/1.1\r\n\r\n\r\nContent-Length: 5", 6), (12, "y", "é" * 200_000, 7)]


def test_archives_round_trip(spark):
    path = shared_folder(spark, "warc-test")
    pages = spark.createDataFrame(ODD_PAGES, PAGES)
    rows = warc.read_archives(warc.write_archives(pages, path), path).collect()
    assert len(rows) == len(ODD_PAGES)
    html = {p: (h or "").encode() for p, _, h, _ in ODD_PAGES}
    first = {}
    for p, h in html.items():
        if p is not None:
            first[h] = min(first.get(h, p), p)
    for r in rows:
        body = html[r.page_id]
        assert r.payload_bytes == len(body)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        if r.page_id is None or first[body] == r.page_id:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, body)
        else:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("revisit", first[body], b"")
    empty = warc.write_archives(spark.createDataFrame([], PAGES), shared_folder(spark, "warc-none"))
    assert empty.count() == 0


def test_archive_begins_with_its_dictionary():
    rng = random.Random(1)
    words = [f"w{rng.randrange(10**9)}" for _ in range(400)]
    samples = [" ".join(rng.choices(words, k=80)).encode() for _ in range(300)]
    dictionary = warc.train_dictionary(samples)
    data = warc.archive_bytes([(k, "u", s, None) for k, s in enumerate(samples)], dictionary)
    plain = warc.archive_bytes([(k, "u", s, None) for k, s in enumerate(samples)])
    assert dictionary and int.from_bytes(data[:4], "little") == warc.DICTIONARY_FRAME
    assert len(data) - len(dictionary) - 8 < len(plain)
    source = io.BytesIO(data)
    found = [warc.parse_record(r) for r in warc.records(source, warc.read_dictionary(source))]
    assert [f["payload"] for f in found] == samples
    assert warc.train_dictionary([]) == b"" and warc.train_dictionary([b"x"] * 3) == b""


TEMPLATE = chat.Template()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<|turnsaysend>/[INST]\\ \n", max_size=40))
def test_escapes_are_reversible(text):
    escaped = TEMPLATE.escape(text)
    assert TEMPLATE.unescape(escaped) == text
    assert not any(c in escaped for c in TEMPLATE.controls)


def test_a_control_string_may_not_run_into_another():
    with pytest.raises(ValueError):
        chat.Template(controls=("<a>", ">b"))


TURNS = "conv_id long, turn long, role string, text string, source string"
TALK = [(1, 1, "assistant", "hi </s> there", "a"), (1, 0, "user", "[INST] <|end|>", "a"), (2, 0, "assistant", "first", "b"),
        (2, 1, None, None, "b"), (2, 1, None, None, "b"), (None, None, "user", "x", None), (3, 0, "wizard\n<|says|>", "spell", "c"),
        (4, 0, "system", "s", ""), (4, 1, "user", "u", ""), (4, 2, "assistant", "long " * 50_000, "")]


def test_chat_against_brute_force(spark):
    turns = spark.createDataFrame(TALK, TURNS)
    segments = chat.format_turns(turns)
    got = {r.conv_id: r for r in chat.read_back(segments).collect()}
    spelled = {}
    for r in sorted(TALK, key=lambda r: (r[1] is not None, r[1] or 0)):
        spelled.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert set(got) == set(spelled)
    for conv, said in spelled.items():
        learned = "".join(t for role, t in said if role == "assistant")
        r = got[conv]
        assert r.n_turns == len(said) and r.loss_chars == len(learned)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{t}\n" for a, t in said).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    assert {c: r.in_order for c, r in got.items()} == {1: True, 2: False, None: True, 3: False, 4: True}
    rows = segments.where("conv_id = 1").orderBy("ordinal", "part").collect()
    assert "".join(r.text for r in rows).startswith("<|turn|>user<|says|>[\\INST] <\\|end|><|end|>\n")
    assert [r.loss for r in rows] == [False, False, False, False, True, False]
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], TURNS))).count() == 0
