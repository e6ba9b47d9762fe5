import math

import pytest
from pyspark.sql import functions as F

from lexigrid.operators import facets as fc
from lexigrid.operators import queries as q
from lexigrid.operators import ranking as rk
from lexigrid.operators.postings import (
    Corpus,
    build_postings,
    load_index,
    save_index,
    term_stats,
    token_streams,
    token_table,
)
from lexigrid.session import shared_folder


@pytest.fixture(scope="module")
def index(guides):
    return Corpus.analyze(guides, "id", {"title": "title", "content": "content"})


def keys(corpus, query):
    return sorted(r.key for r in q.match(corpus, query).collect())


def term(field, text):
    return q.Term(field, text)


CASES = [
    (q.All(), [1, 2, 3, 4]),
    (q.Nothing(), []),
    (q.Bool(), []),
    (q.Bool(must_not=(q.Term("title", "sourdough"),)), []),
    (q.Term("title", "Sourdough"), [1]),
    (q.all_terms("content", "Bake bread"), [1]),
    (q.any_terms("title", "herbs pasta"), [2, 4]),
    (q.phrase("content", ["bake", "bread"]), [1]),
    (q.phrase("content", ["bread", "bake"]), []),
    (q.phrase("content", ["Bread"]), [1, 2, 3]),
    (q.PhrasePrefix("content", ("bread", "crumb")), [2]),
    (q.PhrasePrefix("content", ("and", "p"), max_expansions=1), [2]),
    (q.Prefix("title", "bre"), [1, 3]),
    (q.Range("price", 15, 30), [1, 4]),
    (q.Range("price", 30, 15), []),
    (q.Range("price", 12, 24, include_low=False, include_high=False), [4]),
    (q.Range("score", 60, 80), [1, 3]),
    (q.Range("rating", 3.6, 5.0), [1, 2, 3]),
    (q.Range("rating"), [1, 2, 3, 4]),
    (q.TypedTerm("active", "no"), [2]),
    (q.TypedTerm("price", "12"), [2]),
    (q.TypedTerm("created_at", "1577934245"), [1]),
    (q.Bool(must=(q.Term("title", "bread"), q.Term("content", "stone"))), [3]),
    (q.Bool(must=(q.Term("content", "bread"),), must_not=(q.Term("title", "pasta"),)), [1, 3]),
    (
        q.Bool(
            must=(q.Term("content", "and"),),
            should=(q.Term("title", "handbook"), q.Term("title", "garden")),
            must_not=(q.Term("title", "notes"),),
        ),
        [1, 4],
    ),
    (q.Bool(must=(q.Bool(should=(q.Term("title", "herbs"), q.Range("price", low=38))), q.TypedTerm("active", "t"))), [3, 4]),
    (q.Bool(must=(q.All(),), must_not=(q.Term("title", "ovens"),)), [1, 2, 4]),
    (q.Fuzzy("title", "bred", 1), [1, 3]),
    (q.Fuzzy("title", "psata", 1, transpositions=False), []),
    (q.Fuzzy("title", "psata", 1), [2]),
    (q.Fuzzy("title", "oveens", 1), [3]),
    (q.Wildcard("title", "h*"), [1, 4]),
    (q.Wildcard("title", "p?sta"), [2]),
    (q.Wildcard("title", "p.sta"), []),
    (q.Regex("title", ".*read.*"), [1, 3]),
    (q.Regex("title", "brea"), []),
    (q.Exists("title"), [1, 2, 3, 4]),
]


@pytest.mark.parametrize("number", range(len(CASES)))
def test_matches(index, number):
    query, expected = CASES[number]
    assert keys(index, query) == expected


def test_many_queries_in_one_pass(index):
    named = {str(i): query for i, (query, _) in enumerate(CASES) if not isinstance(query, q.PhrasePrefix)}
    found = {}
    for row in q.match_many(index, named, scored=False).collect():
        found.setdefault(row.query_id, []).append(row.key)
    for name in named:
        assert sorted(found.get(name, [])) == CASES[int(name)][1], CASES[int(name)][0]


def test_bad_queries(index):
    with pytest.raises(ValueError):
        q.phrase("title", [])
    for query in (q.Range("nothing", 1, 2), q.Exists("nothing"), q.TypedTerm("active", "perhaps"), q.Regex("title", "(")):
        with pytest.raises(ValueError):
            q.match(index, query)


def test_bm25_by_hand(index):
    (row,) = q.match(index, q.Term("title", "sourdough")).collect()
    idf = math.log(1 + (4 - 1 + 0.5) / (1 + 0.5))
    expected = idf * 2.2 / (1 + 1.2 * (0.25 + 0.75 * 3 / (9 / 4)))
    assert row.score == pytest.approx(expected)


def test_boost_and_sum(index):
    plain = q.match(index, q.Term("title", "sourdough")).first().score
    query = q.Bool(should=(q.Boost(q.Term("title", "sourdough"), 3.0), q.Range("price", 24, 24)))
    assert q.match(index, query).first().score == pytest.approx(3 * plain + 1)


def test_stored_postings_answer_like_tokens(index, guides):
    built = build_postings(token_table(guides, "id", {"title": "title", "content": "content"}))
    stored = Corpus(guides, "id", built, index.lengths)
    for query in (q.Term("content", "bread"), q.phrase("content", ["stone", "ovens"])):
        left = {r.key: round(r.score, 9) for r in q.match(index, query).collect()}
        assert left == {r.key: round(r.score, 9) for r in q.match(stored, query).collect()}


def test_saved_index(index, guides, spark):
    path = shared_folder(spark, "index")
    save_index(index, path, tokens_per_bucket=5)
    query = q.Bool(must=(q.Term("content", "bread"),), should=(q.phrase("title", ["bread", "ovens"]),))
    left = {r.key: round(r.score, 9) for r in q.match(index, query).collect()}
    saved = load_index(guides, "id", path)
    assert left == {r.key: round(r.score, 9) for r in q.match(saved, query).collect()}
    plan = q.match(saved, query)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan or "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r.key for r in q.match(saved, q.Prefix("content", "s")).collect()} == {
        r.key for r in q.match(index, q.Prefix("content", "s")).collect()
    }


def test_fetch_top_prunes_the_scan(spark, guides, index):
    path = shared_folder(spark, "docs")
    guides.write.parquet(path)
    found = rk.fetch_top(q.match(index, q.Term("title", "sourdough")), spark.read.parquet(path), "id", ["title"], 5)
    assert [(r.key, r.title) for r in found.collect()] == [(1, "Sourdough Bread Handbook")]
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,1)]" in found._jdf.queryExecution().executedPlan().toString()


def test_top_k_ties_by_key(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, 2.0)], "key long, score double")
    assert [(r.key, r["rank"]) for r in rk.top_k(df, 2).orderBy("rank").collect()] == [(2, 1), (1, 2)]


def test_merge_orders(spark):
    rows = [(1, 0.9, "a", 0), (2, 0.5, "a", 0), (3, 0.8, "b", 1), (4, 0.7, "b", 1)]
    df = spark.createDataFrame(rows, "key long, score double, shard string, shard_no int")
    expected = {
        "score_desc": [1, 3, 4, 2], "score_asc": [2, 4, 3, 1], "node_order": [1, 2, 3, 4], "round_robin": [1, 3, 2, 4],
    }
    for strategy, order in expected.items():
        found = rk.merge_sharded(df, strategy, 10).orderBy("rank").collect()
        assert [r.key for r in found] == order
    with pytest.raises(ValueError):
        rk.merge_sharded(df, "random", 10)


def brute_force(docs, query_terms, k, need_all):
    """BM25 over small word lists in plain Python."""
    n = len(docs)
    mean = sum(map(len, docs.values())) / n
    df = {t: sum(t in words for words in docs.values()) for t in query_terms}
    scored = []
    for key, words in docs.items():
        present = [t for t in query_terms if t in words]
        if not present or (need_all and len(present) < len(query_terms)):
            continue
        score = sum(
            math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * words.count(t) * 2.2
            / (words.count(t) + 1.2 * (0.25 + 0.75 * len(words) / mean))
            for t in present
        )
        scored.append((-round(score, 9), key))
    return [key for _, key in sorted(scored)[:k]]


def random_docs(seed, n=60):
    import random

    rng = random.Random(seed)
    vocabulary = ["the"] * 12 + ["of"] * 8 + [f"w{i}" for i in range(25)]
    return {i: [rng.choice(vocabulary) for _ in range(rng.randint(2, 14))] for i in range(n)}


def test_batch_search_against_brute_force(spark):
    docs = random_docs(1)
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in docs.items()], "id long, text string")
    corpus = Corpus.analyze(df, "id", {"text": "text"})
    queries = {"a": ["the"], "b": ["the", "of"], "c": ["w1", "the"], "d": ["w2", "w3"], "e": ["the", "nowhere"], "f": ["of", "the"]}
    table = spark.createDataFrame([(i, t) for i, ts in queries.items() for t in ts], "query_id string, term string")
    postings = build_postings(token_table(df, "id", {"text": "text"}))
    found = {}
    for options in ({}, {"pairs_per_task": 9}, {"stats": term_stats(postings)}):
        found.clear()
        for r in rk.batch_search(table, postings, *corpus.stats("text"), k=5, **options).orderBy("rank").collect():
            found.setdefault(r.query_id, []).append(r.key)
        for name, terms in queries.items():
            assert found.get(name, []) == brute_force(docs, terms, 5, need_all=True), name


def test_only_hot_terms_are_salted(spark):
    rows = spark.createDataFrame([("hot", 5000)] * 3 + [("cold", 10)], "term string, df long")
    salts = rk.salt_counts(rows, ["term"], 1000)
    assert {r.term: r.salts for r in salts.collect()} == {"hot": 15, "cold": 1}
    postings = spark.range(900).selectExpr("id as key", "if(id % 3 = 0, 'hot', 'cold') as term")
    dealt = rk.salted(postings, salts, ["term"]).groupBy("term", "salt").count().collect()
    hot = [r["count"] for r in dealt if r.term == "hot"]
    assert len(hot) == 15 and sum(hot) == 300 and max(hot) < 60
    assert [r["count"] for r in dealt if r.term == "cold"] == [600]


def test_more_like_this(spark):
    docs = random_docs(2)
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in docs.items()], "id long, text string")
    corpus = Corpus.analyze(df, "id", {"text": "text"})
    seeds = {1: ["the", "w1"], 2: ["the", "of"], 3: ["w2", "w3", "of"], 4: ["the"], 5: ["nowhere"]}
    table = spark.createDataFrame([(i, "text", t, 1) for i, ts in seeds.items() for t in ts], "seed long, field string, term string, tf long")
    postings = build_postings(token_table(df, "id", {"text": "text"}))
    for hot_share, pairs in ((0.0, 10), (0.2, 1_000_000), (1.0, 7), (0.1, 1000)):
        found = {}
        similar = rk.more_like_this(
            table, postings, term_stats(postings), *corpus.stats("text"), k=4, min_df=1, min_tf=1, hot_share=hot_share,
            pairs_per_task=pairs,
        )
        for r in similar.orderBy("rank").collect():
            found.setdefault(r.seed, []).append(r.key)
        for seed, terms in seeds.items():
            assert found.get(seed, []) == brute_force(docs, terms, 4, need_all=False), (hot_share, seed)


def test_facets(spark):
    rows = [
        (1, ["/crop/tomato", "/crop/basil"]), (2, ["/crop/maize", "/crop/squash"]),
        (3, ["/crop/tomato", "/crop/maize", "/crop/beans"]),
    ]
    docs = spark.createDataFrame(rows, "id long, tags array<string>")
    corpus = Corpus(docs, "id", docs, docs)
    assert keys(corpus, q.FacetTerm("tags", "/crop/tomato")) == [1, 3]
    assert keys(corpus, q.FacetTerm("tags", "/crop")) == [1, 2, 3]
    assert keys(corpus, q.facets("tags", must=["/crop/tomato"], must_not=["/crop/maize"])) == [1]
    counts = fc.facet_counts(docs, "id", "tags", roots=["/crop"])
    found = {r.path: r["count"] for r in counts.collect()}
    assert found == {"/crop/tomato": 2, "/crop/maize": 2, "/crop/beans": 1, "/crop/basil": 1, "/crop/squash": 1}
    assert [r.path for r in fc.top_children(counts, 2).orderBy("rank").collect()] == ["/crop/maize", "/crop/tomato"]


def test_facet_paths(spark):
    df = spark.createDataFrame([("a/b",), ("/a//b",), ("/",), (None,)], "t string")
    paths = [r[0] for r in df.select(fc.facet_path(F.col("t"), strict=False)).collect()]
    assert paths == ["/a/b", None, None, None]
    with pytest.raises(Exception, match="invalid facet path"):
        df.select(fc.facet_path(F.col("t"))).collect()


def test_fallback(index):
    tiers = {
        "a": [("phrase", q.phrase("content", ["bake", "bread"])), ("or", q.any_terms("content", "bake bread"))],
        "b": [("phrase", q.phrase("content", ["bread", "bake"])), ("or", q.any_terms("content", "stone thyme"))],
        "c": [("phrase", q.phrase("content", ["no", "where"]))],
    }
    found = {(r.query_id, r.strategy, r.key) for r in q.first_non_empty(index, tiers).collect()}
    assert found == {("a", "phrase", 1), ("b", "or", 3), ("b", "or", 4)}


def test_alignment_distance(spark):
    """A swap is one edit, and no letter is edited twice: the distance is symmetric."""

    def distance(a, b):
        d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    words = ["abc", "ca", "ac", "abdc", "bacd", "", "thing", "htign", "thnig", "xthnig", "a"]
    terms = spark.createDataFrame([(w,) for w in words], "term string")
    for word in words:
        rows = terms.select("term", q.alignment_distance(F.col("term"), word).alias("d")).collect()
        assert {r.term: r.d for r in rows} == {w: distance(w, word) for w in words}


def test_patterns_of_the_engine(index):
    assert {r.key for r in q.match(index, q.Regex("title", r"\p{L}+k")).collect()} == {1}
    with pytest.raises(ValueError):
        q.match(index, q.Regex("title", "(?P<a>b)ook"))


def words_of(n, seed=3):
    import random

    draw = random.Random(seed)
    return sorted({"".join(draw.choice("abcdé") for _ in range(draw.randint(1, 9))) for _ in range(n)})


def alignment(a, b):
    """Optimal string alignment distance, by the table."""
    rows = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            rows[i][j] = min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                rows[i][j] = min(rows[i][j], rows[i - 2][j - 2] + 1)
    return rows[-1][-1]


@pytest.fixture(scope="module")
def vocabulary(spark):
    """An index with one document a word, its words, and the folder."""
    words = words_of(900)
    docs = spark.createDataFrame([(k, w + " common") for k, w in enumerate(words)], "id long, title string")
    path = shared_folder(spark, "index")
    save_index(Corpus.analyze(docs, "id", {"title": "title"}), path, tokens_per_bucket=120)
    return load_index(docs, "id", path), words


@pytest.mark.parametrize("word", ["abcde", "a", "cab", "ébédabcde", "ddddddddd", "bacdcbeé"])
@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_spellings_by_deletion_keys(vocabulary, word, distance):
    saved, words = vocabulary
    found = {words[r.key] for r in q.match(saved, q.Fuzzy("title", word, distance), scored=False).collect()}
    assert found - {"common"} == {w for w in words if alignment(w, word) <= distance}


@pytest.mark.parametrize("pattern", ["a*", "*cd*", "ab?de", "*abc", "c*a*b", "?", "abc", "*", "d?*éa*", "b*bb?"])
def test_wildcards_by_trigrams(vocabulary, pattern):
    import fnmatch

    saved, words = vocabulary
    found = {words[r.key] for r in q.match(saved, q.Wildcard("title", pattern), scored=False).collect()}
    expected = {w for w in words if fnmatch.fnmatchcase(w, pattern) or fnmatch.fnmatchcase("common", pattern)}
    assert found == expected


def test_deletion_keys_of_the_engine(spark):
    from lexigrid.operators import vocabulary as vc

    words = [*words_of(50), "zz", "a", "abcdefghij"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for r in df.select("w", vc.deletion_keys(F.col("w")).alias("k"), vc.gram_keys(F.col("w")).alias("g")).collect():
        assert sorted(r.k) == vc.deletions(r.w)
        assert sorted(r.g) == vc.fixed_grams([r.w])


def test_patterns_read_the_buckets_of_found_terms(vocabulary):
    saved, words = vocabulary
    everything = saved.occurrences.select(F.input_file_name()).distinct().count()
    word = max(words, key=len)
    for query in (
        q.Fuzzy("title", word, 1), q.Wildcard("title", word[:4] + "*" + word[-1]), q.Prefix("title", word[:5]),
        q.Regex("title", word[:-1] + "."),
    ):
        plan = q.match(saved, query, scored=False)
        assert 0 < len({r.key for r in plan.collect()}) < 20
        text = plan._jdf.queryExecution().executedPlan().toString()
        read = text.split("PartitionFilters: [")
        assert any("bucket" in part.split("DataFilters")[0] for part in read[1:]), text
    assert everything > 20


def test_patterns_beside_words_and_phrases(vocabulary):
    saved, words = vocabulary
    plain = Corpus.analyze(saved.docs, "id", {"title": "title"})
    query = q.Bool(
        must=(q.Term("title", "common"), q.Bool(should=(q.Prefix("title", "ab"), q.Fuzzy("title", "dace", 1)))),
        should=(q.Phrase("title", (words[3], "common")), q.PhrasePrefix("title", (words[5], "com"), 3)),
        must_not=(q.Wildcard("title", "*e"),),
    )
    left, right = ({r.key: round(r.score, 9) for r in q.match(c, query).collect()} for c in (saved, plain))
    assert left == right and len(left) > 5


def test_stored_norms(vocabulary):
    saved, words = vocabulary
    n, _ = saved.stats("title")
    terms = [words[0], words[7], "common"]
    from lexigrid.operators.postings import postings_of

    rows = saved.occurrences.select("key", "field", "term", "tf", "dl")
    slow = {r.key: round(r.score, 9) for r in rk.tfidf(rows, term_stats(rows), n, terms).collect()}
    fast = rk.tfidf(postings_of(saved, terms), saved.terms, n, terms, norms=saved.norms)
    assert {r.key: round(r.score, 9) for r in fast.collect()} == slow and len(slow) == len(words)


def test_completions(vocabulary, spark):
    from lexigrid.operators import vocabulary as vc

    saved, words = vocabulary
    asked = ["a", "ab", "é", "common", "zz", "abcdabcdabcd", "", "a"]
    found = vc.completions(saved.terms, spark.createDataFrame([(p,) for p in asked], "prefix string"), 4).collect()
    every = [*words, "common"]
    expected = {(p, t) for p in asked if p for t in sorted(w for w in every if w.startswith(p))[:4]}
    assert {(r.prefix, r.term) for r in found} == expected and all(r.rank <= 4 for r in found)


def test_changed_tables_are_indexed_again(spark):
    from lexigrid.plans import catalog

    folder = shared_folder(spark, "tables")
    for text in ("one word", "other words here"):
        df = spark.createDataFrame([(1, text, "en", "s", 8)], "doc_id long, text string, lang string, source string, n_chars long")
        df.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
        found = q.match(catalog.corpus(spark, folder), q.Term("text", "word")).count()
        assert found == (text == "one word")


def test_fallback_of_a_table(vocabulary, spark):
    """The rounds give what the same strategies as query objects give."""
    from lexigrid.operators.fallback import fallback_search

    saved, words = vocabulary
    texts = {
        "phrase": f"{words[4]} Common", "twice": "common common", "and": f"common {words[9]}", "or": f"{words[11]} {words[12]} zzz",
        "fuzzy": max(words, key=len) + "xx qqqqqqq", "one": words[20], "none": "qqqqqqqq", "empty": " ", "null": None,
    }
    asked = spark.createDataFrame(list(texts.items()), "query_id string, text string")
    found = {}
    for r in fallback_search(saved, asked, "title").collect():
        found.setdefault(r.query_id, {})[r.strategy, r.key] = round(r.score, 9)
    for name, text in texts.items():
        split = (text or "").lower().split()
        tiers = [] if not split else [
            ("phrase", q.phrase("title", split)), ("and", q.all_terms("title", text.lower())), ("or", q.any_terms("title", text.lower())),
            ("fuzzy", q.Bool(should=tuple(q.Fuzzy("title", w, 2, transpositions=False) for w in split))),
        ]
        expected = {}
        for strategy, query in tiers:
            expected = {(strategy, r.key): round(r.score, 9) for r in q.match(saved, query).collect()}
            if expected:
                break
        assert found.get(name, {}) == expected, name
    assert {next(iter(v))[0] for v in found.values()} == {"phrase", "and", "or", "fuzzy"}


def test_fallback_plans_do_not_grow_with_the_queries(vocabulary, spark):
    from lexigrid.operators.fallback import fallback_search

    saved, words = vocabulary
    sizes = []
    for n in (3, 300):
        asked = spark.createDataFrame([(str(k), words[k]) for k in range(n)], "query_id string, text string")
        sizes.append(len(fallback_search(saved, asked, "title")._jdf.queryExecution().optimizedPlan().toString()))
    assert abs(sizes[0] - sizes[1]) < 200


REPEATED = [(1, "b a b", None), (2, "c", "x c"), (2, "a c a", "x"), (None, "n m", ""), (None, "n", None), (3, None, None), (4, "", "y y y")]


def test_postings_inside_the_row_are_those_of_the_tokens(spark):
    """Keys of several documents and null keys are one document, as when tokens are grouped."""
    docs = spark.createDataFrame(REPEATED, "id long, t string, u string")
    for rows in (docs, docs.where("id <> 2"), docs.limit(0)):
        fields = {"t": "t", "u": "u"}
        got = build_postings(token_streams(rows, "id", fields))
        want = build_postings(token_table(rows, "id", fields))
        assert got.dtypes == want.dtypes
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_no_token_is_shuffled_for_postings(spark):
    docs = spark.createDataFrame([(1, "b a b"), (2, "a")], "id long, t string")
    plan = build_postings(token_streams(docs, "id", {"t": "t"}))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan


def test_many_small_buckets_share_tasks_and_files(spark):
    docs = spark.createDataFrame([(k, " ".join(f"w{k}x{i}" for i in range(10))) for k in range(100)], "id long, t string")
    path = shared_folder(spark, "index")
    save_index(Corpus.analyze(docs, "id", {"t": "t"}), path, tokens_per_bucket=1)
    saved = load_index(docs, "id", path)
    assert saved.buckets == 1000
    assert saved.occurrences.count() == 1000
    assert len(saved.occurrences.inputFiles()) == saved.occurrences.select("bucket").distinct().count()
    assert [r.key for r in q.match(saved, q.Term("t", "w7x3")).collect()] == [7]


def test_deletion_keys_stand_once_for_the_same_first_letters(spark):
    docs = spark.createDataFrame([(k, f"letter{k}") for k in range(50)], "id long, t string")
    path = shared_folder(spark, "index")
    save_index(Corpus.analyze(docs, "id", {"t": "t"}), path)
    saved = load_index(docs, "id", path)
    keys = saved.keys.where("kind = 'd'")
    assert keys.count() == keys.select("key").distinct().count() < 30
    found = {r.key for r in q.match(saved, q.Fuzzy("t", "lettre7", 1), scored=False).collect()}
    assert found == {7}


def test_batch_proposals_are_checked_for_a_second_term_before_all_others(spark):
    """A set of terms is a number and a proposal one row; only documents with both of the rarest
    terms are looked up for the others."""
    long = " ".join(f"w{i}" for i in range(40))
    texts = [(k, f"rare{k % 2} common") for k in range(60)] + [(90, long + " rare0 next"), (91, long + " rare0"), (92, "solo"), (93, "next rare0")]
    docs = spark.createDataFrame(texts, "id long, text string")
    corpus = Corpus.analyze(docs, "id", {"text": "text"})
    postings = build_postings(token_table(docs, "id", {"text": "text"}))
    asked = {"a": (long + " rare0 next").split(), "b": ["solo"], "c": ["rare0", "next"], "d": ["rare0", "nowhere"], "e": ["next", "rare0"]}
    queries = spark.createDataFrame([(n, t) for n, terms in asked.items() for t in terms], "query_id string, term string")
    found = rk.batch_search(queries, postings, *corpus.stats("text"), k=10)
    want = {(n, k) for n, terms in asked.items() for k, text in texts if set(terms) <= set(text.split())}
    assert {(r.query_id, r.key) for r in found.collect()} == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    semi = [line for line in plan.splitlines() if "Join LeftSemi" in line]
    assert any("next" in line for line in semi)


def test_batch_search_has_one_row_a_document_for_all_terms(spark):
    """A proposal meets its document's terms in one row; none becomes a row for each term."""
    import random

    rng = random.Random(8)
    words = [f"v{i}" for i in range(12)] + ["of"] * 6
    docs = {k: [rng.choice(words) for _ in range(rng.randint(1, 40))] for k in range(150)}
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in docs.items()] + [(None, "of v1 v2 v3")], "id long, text string")
    path = shared_folder(spark, "index")
    save_index(Corpus.analyze(df, "id", {"text": "text"}), path)
    corpus = load_index(df, "id", path)
    asked = {f"q{n}": sorted({rng.choice(words) for _ in range(rng.randint(1, 7))}) for n in range(40)}
    queries = spark.createDataFrame([(n, t) for n, ts in asked.items() for t in ts], "query_id string, term string")
    found = rk.batch_search(queries, corpus.occurrences, *corpus.stats("text"), k=7, stats=corpus.terms)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [key" in plan and "n_found" not in plan and "inline(terms" not in plan
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.key, round(r.score, 6)))
    n = len(docs) + 1
    every = [set(w) for w in docs.values()] + [{"of", "v1", "v2", "v3"}]
    mean = (sum(map(len, docs.values())) + 4) / n
    for name, terms in asked.items():
        want = []
        for k, w in docs.items():
            if set(terms) <= set(w):
                score = 0.0
                for t in terms:
                    held, tf = sum(t in e for e in every), w.count(t)
                    score += math.log(1 + (n - held + 0.5) / (held + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
                want.append((-round(score, 9), k, round(score, 6)))
        assert got.get(name, []) == [(k, s) for _, k, s in sorted(want)[:7]], name
