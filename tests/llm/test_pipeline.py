"""The pipeline's stages, each on what its predecessor kept."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexigrid.llm.line_dedup import dedup_lines
from lexigrid.llm.weak_toxicity import score_toxicity
from lexigrid.session import stored

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = {"input": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = stored(stage(spark, docs, SF_DIR), f"test-{name}")
    return out


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def alike(a, b):
    return bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "near_duplicates", "decontamination", "packing",
    ]
    for name in list(stages)[:-1]:
        assert stages[name].columns == COLUMNS


def test_clean_documents_pass_toxicity(spark, stages):
    """With eleven toxic labels here little can be learned; what is held out elsewhere tells
    the recall.  Clean documents stay, and those that go are what the operator rejects."""
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "toxic")
    clean = labels.where("toxic = 0")
    assert stages["toxicity"].join(clean, "doc_id", "left_semi").count() >= 0.97 * clean.count()
    scored = score_toxicity(stages["input"], labels)
    want = {r.doc_id for r in scored.where("predicted = 0").collect()}
    assert {r.doc_id for r in stages["toxicity"].collect()} == want


def test_lines_stay_somewhere(stages):
    def lines(docs):
        return {" ".join(x.split()) for r in docs.collect() for x in (r.text or "").split("\n")} - {""}

    assert lines(stages["toxicity"]) == lines(stages["line_dedup"])


def test_one_document_of_each_group(stages):
    docs = [(r.doc_id, shingles(r.text)) for r in stages["line_dedup"].collect()]
    kept = {r.doc_id for r in stages["near_duplicates"].collect()}
    for k, (key, s) in enumerate(docs):
        others = [other for j, (other, t) in enumerate(docs) if j != k and alike(s, t)]
        if not others:
            assert key in kept
        elif key not in kept:
            assert min(others) < key or others
    left = [s for key, s in docs if key in kept]
    assert not any(alike(left[i], left[j]) for j in range(len(left)) for i in range(j))


def test_no_leak_is_left(spark, stages):
    def plain(text):
        return re.sub(r"[^\w\s]", "", text.lower()).split()

    items = [plain(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    asked = [{tuple(q[k : k + 8]) for k in range(len(q) - 7)} for q in items]
    kept = {r.doc_id for r in stages["decontamination"].collect()}
    for r in stages["near_duplicates"].collect():
        w = plain(r.text)
        have = {tuple(w[k : k + 8]) for k in range(len(w) - 7)}
        assert (r.doc_id in kept) == (not any(a and 2 * len(a & have) >= len(a) for a in asked))


def test_all_that_is_left_is_packed(stages):
    pieces = stages["packing"]
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in stages["decontamination"].collect()}
    per_doc = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    assert per_doc.where("n <> all").count() == 0


def test_odd_documents(spark):
    rows = [(1, None, "en", None, 0, "x"), (2, "", None, "a", 0, "y"), (3, "same words here", "en", "a", 0, "y"),
            (4, "same words here", "en", "b", 0, "y"), (None, "no key", "en", "a", None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    for docs, most in ((spark.createDataFrame(rows, schema), 5), (spark.createDataFrame([], schema), 0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stored(stage(spark, docs, SF_DIR), "test-odd")
            if name != "packing":
                assert out.columns == docs.columns and out.count() <= most
            docs = out
        assert {r.doc_id for r in docs.collect()} == ({1, 2, 3, None} if most else set())


#: Names that the stages use for themselves.
OWN = [
    "score", "predicted", "text_", "toxic_", "n_lines", "n_removed", "words_removed", "words_before", "gone_", "key_",
    "hash_", "cut_", "first", "pos", "text_hash", "text_hash_", "site", "h1", "h2", "key", "n", "set_id", "slots", "root",
    "component_id", "n_shingles", "item_id", "others",
]


@pytest.mark.parametrize("number", range(4))
def test_clashing_columns_keep_their_values(spark, number):
    own = OWN
    rows = [
        (1, "some plain text that stays as it is in every stage", "en", "a", 1, *[f"{c} 1" for c in own]),
        (2, "word " * 30_000 + "end", "de", "b", 2, *[f"{c} 2" for c in own]),
        (3, None, None, None, None, *[None for c in own]),
        (3, None, None, None, None, *[None for c in own]),
    ]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in own)
    )
    out = corpus_pipeline.STAGES[number][1](spark, docs, SF_DIR)
    assert out.columns == docs.columns
    assert sorted(map(repr, out.collect())) == sorted(map(repr, docs.collect()))


def test_results_beside_columns_of_their_names(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    docs = spark.createDataFrame([(1, "plain words", 7, "x")], "doc_id long, text string, predicted long, n_lines string")
    (scored,) = score_toxicity(docs, labels).collect()
    assert scored.predicted_ == 7 and scored.predicted == 0 and 0 <= scored.score <= 1
    (cleaned,) = dedup_lines(docs.withColumn("source", F.lit("s"))).collect()
    assert cleaned.n_lines_ == "x" and cleaned.n_lines == 1
