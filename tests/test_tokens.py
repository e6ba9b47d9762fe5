import re

import pytest
from pyspark.sql import functions as F

from lexigrid.functions import tokens as tk
from lexigrid.functions.stemming import stem_word
from lexigrid.functions.stopwords import stop_words
from lexigrid.operators import postings as ps


def tokens_of(spark, text, make):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(make(F.col("t")).alias("x")).first()["x"]


SENTENCE = "The Quick-Brown Fox's Email: fox@example.com"


@pytest.mark.parametrize(
    "name, text, expected",
    [
        ("simple", SENTENCE, ["The", "Quick", "Brown", "Fox", "s", "Email", "fox", "example", "com"]),
        ("whitespace", SENTENCE, ["The", "Quick-Brown", "Fox's", "Email:", "fox@example.com"]),
        ("raw", SENTENCE, [SENTENCE]),
        ("simple", "", []),
        ("whitespace", "   ", []),
        ("raw", "  ", []),
        ("simple", None, []),
        ("english_stem", "  hello   worlds  ", ["hello", "world"]),
        ("english_text", "The running of the foxes", ["run", "fox"]),
        ("default", "The cats are running", ["cat", "run"]),
    ],
)
def test_presets(spark, name, text, expected):
    assert tokens_of(spark, text, tk.preset(name).tokens) == expected


def test_accents_stay_in_words(spark):
    assert tokens_of(spark, "Crème brûlée à Zürich", tk.simple_tokens) == ["Crème", "brûlée", "à", "Zürich"]


def test_long_tokens_are_dropped_by_bytes(spark):
    text = "short medium " + " ".join(["a" * 39, "b" * 40, "c" * 41])
    assert tokens_of(spark, text, tk.SEARCH.tokens) == ["short", "medium", "a" * 39]
    assert tokens_of(spark, "é" * 20 + " " + "é" * 19, tk.SEARCH.tokens) == ["é" * 19]


def test_regex(spark):
    text = "Orders: rosa.m@garden.example, complaints (ovens@bakery.example) by Friday"
    found = tokens_of(spark, text, lambda c: tk.regex_tokens(c, r"[\w.]+@[\w.]+\.\w+"))
    assert found == ["rosa.m@garden.example", "ovens@bakery.example"]
    with pytest.raises(ValueError):
        tk.regex_tokens(F.lit("x"), "[unclosed")


def test_ngrams(spark):
    assert tokens_of(spark, "hello", lambda c: tk.ngram_tokens(c, 2, 2)) == ["he", "el", "ll", "lo"]
    assert tokens_of(spark, "ab", lambda c: tk.ngram_tokens(c, 1, 3)) == ["a", "ab", "b"]
    assert tokens_of(spark, "hello", lambda c: tk.ngram_tokens(c, 2, 3, True)) == ["he", "hel"]
    assert tokens_of(spark, "a", lambda c: tk.ngram_tokens(c, 2, 3)) == []
    with pytest.raises(ValueError):
        tk.ngram_tokens(F.lit("x"), 3, 2)


def test_positions_survive_stop_words(spark):
    df = spark.createDataFrame([(1, "the quick and brown")], "id long, t string")
    rows = ps.token_table(df, "id", {"t": "t"}, tk.Analyzer(stop="en")).collect()
    assert [(r.pos, r.term, r.dl) for r in rows] == [(1, "quick", 2), (3, "brown", 2)]


def test_offsets(spark):
    df = spark.createDataFrame([(1, "Hé, llo  wörld!")], "id long, t string")
    rows = ps.token_offsets(df, "id", "t").orderBy("pos").collect()
    assert [(r.term, r.start, r.end) for r in rows] == [("Hé", 0, 2), ("llo", 4, 7), ("wörld", 9, 14)]


def test_offsets_of_long_texts_stay_in_the_row(spark):
    long = "".join(f"w{i}," + " " * (i % 3) for i in range(9000))  # more than three levels of 16 tokens
    df = spark.createDataFrame([(1, long), (2, None), (3, ""), (4, " ., "), (5, "a"), (5, "a")], "id long, t string")
    found = ps.token_offsets(df, "id", "t")
    rows = sorted((r.key, r.pos, r.term, r.start, r.end) for r in found.collect())
    words = [(1, i, m.group(), m.start(), m.end()) for i, m in enumerate(re.finditer(r"\w+", long))]
    assert rows == words + [(5, 0, "a", 0, 1)] * 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_query_terms(spark):
    assert tokens_of(spark, "Hello, the World and hello", tk.query_terms) == ["hello", "world"]


def test_stop_words():
    assert "the" in stop_words("en") and "und" in stop_words("de") and "les" in stop_words("french")
    with pytest.raises(ValueError):
        stop_words("klingon")


@pytest.mark.parametrize(
    "word, language, stem",
    [
        ("consignment", "en", "consign"), ("consistency", "en", "consist"), ("knightly", "en", "knight"),
        ("generally", "en", "general"), ("dying", "en", "die"), ("skies", "en", "sky"), ("happy", "en", "happi"),
        ("hopping", "en", "hop"), ("hoping", "en", "hope"), ("relational", "en", "relat"), ("ties", "en", "tie"),
        ("cries", "en", "cri"), ("by", "en", "by"), ("national", "en", "nation"), ("caresses", "en", "caress"),
        ("aufeinander", "de", "aufeinand"), ("häuser", "de", "haus"), ("kategorischen", "de", "kategor"),
        ("jährlich", "de", "jahrlich"), ("verheiratung", "de", "verheirat"), ("tages", "de", "tag"),
        ("continu", "fr", "continu"), ("continuait", "fr", "continu"), ("continuation", "fr", "continu"),
        ("majestueusement", "fr", "majestu"), ("majesté", "fr", "majest"), ("maintenant", "fr", "mainten"),
        ("chevaux", "fr", "cheval"), ("nationalité", "fr", "national"), ("quand", "fr", "quand"),
        ("chicas", "es", "chic"), ("chico", "es", "chic"), ("torneos", "es", "torne"), ("tormentas", "es", "torment"),
        ("cheques", "es", "chequ"), ("rápidamente", "es", "rapid"), ("toreado", "es", "tor"), ("logías", "es", "log"),
    ],
)
def test_stems(word, language, stem):
    assert stem_word(word, language) == stem


@pytest.mark.parametrize(
    "word, language, stem",
    [
        ("jaktkarlarne", "sv", "jaktkarl"), ("klokhet", "sv", "klok"), ("jämförelse", "sv", "jämför"), ("kloster", "sv", "klost"), ("händelser", "sv", "händ"), ("hjälplöst", "sv", "hjälplös"),
        ("havnemyndigheter", "no", "havnemynd"), ("havneinspektørene", "no", "havneinspektør"), ("opning", "no", "opning"), ("havnens", "no", "havn"),
        ("undersøgelse", "da", "undersøg"), ("indtage", "da", "indtag"), ("underste", "da", "underst"), ("indvendende", "da", "indvend"), ("kærligheden", "da", "kær"),
        ("lichaam", "nl", "licham"), ("lichamelijk", "nl", "licham"), ("lichamelijkheden", "nl", "licham"), ("opgingen", "nl", "opging"), ("opheffing", "nl", "opheff"), ("opgaven", "nl", "opgav"), ("brandbare", "nl", "brandbar"), ("yoghurt", "nl", "yoghurt"),
        ("abbandonata", "it", "abbandon"), ("abbandonerà", "it", "abbandon"), ("pronto", "it", "pront"), ("pronunciamento", "it", "pronunc"), ("pronunciarle", "it", "pronunc"), ("amichevole", "it", "amichevol"), ("quando", "it", "quand"),
        ("chilena", "pt", "chilen"), ("quilométricas", "pt", "quilométr"), ("boataria", "pt", "boat"), ("chocolates", "pt", "chocolat"), ("chegaram", "pt", "cheg"), ("nação", "pt", "naçã"), ("organizações", "pt", "organiz"),
        ("вавиловка", "ru", "вавиловк"), ("важничал", "ru", "важнича"), ("важный", "ru", "важн"), ("падающего", "ru", "пада"), ("красивейший", "ru", "красив"), ("возможность", "ru", "возможн"), ("ёлка", "ru", "елк"),
    ],
)
def test_stems_by_rules(word, language, stem):
    assert stem_word(word, language) == stem


def test_no_word_breaks_a_rule():
    from hypothesis import given, strategies
    from lexigrid.functions.stem_rules import RULES

    letters = strategies.text("abcdeghiklnorstuvyzàèéãõåäöøæавеийлмнстьюяё", max_size=14)

    @given(letters, strategies.sampled_from(sorted(RULES)))
    def check(word, language):
        stem = RULES[language].stem(word)
        assert len(stem) <= len(word) + 2 and (stem or not word)

    check()


def test_named_language_without_stemmer(spark):
    for make in (lambda: tk.preset("turkish_stem"), lambda: tk.Analyzer(stem="ta"), lambda: tk.Analyzer(stem="klingon")):
        with pytest.raises(ValueError):
            make()
    df = spark.createDataFrame([("kitaplar hundarna", "tr"), ("hundarna", "sv"), ("hunde", None)], "text string, lang string")
    found = df.select(tk.Analyzer(stem="row").tokens(F.col("text"), F.col("lang")).alias("t")).collect()
    assert [r.t for r in found] == [["kitaplar", "hundarna"], ["hund"], ["hunde"]]


def test_index_round_trip(spark, guides):
    from lexigrid.session import shared_folder

    built = ps.build_postings(ps.token_table(guides, "id", {"content": "content"}))
    path = shared_folder(spark, "postings")
    ps.write_postings(built, path, buckets=8, salts=2)
    found = ps.read_postings(spark, path, ["bread"])
    assert sorted((r.key, r.tf) for r in found.collect()) == [(1, 1), (2, 1), (3, 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*bucket#\d+ = ", plan)


def test_stems_of_rows_with_nulls_and_languages(spark):
    from lexigrid.functions.stemming import stem_word

    rows = [
        (1, ["running", None, "häuser", "running"], "en"), (2, ["häuser", "running"], "de"), (3, None, "en"),
        (4, [], None), (5, ["running", "a"], None), (6, [None], "xx"), (7, ["runs"], "en"),
    ]
    df = spark.createDataFrame(rows, "id long, t array<string>, lang string")
    stemmed = df.select("id", tk.stem_tokens(F.col("t"), F.col("lang")).alias("s"))
    got = {r.id: r.s for r in stemmed.collect()}
    assert got == {
        k: None if t is None else [None if w is None else stem_word(w, lang or "none") for w in t] for k, t, lang in rows
    }
    assert stemmed.where("false").collect() == []


def test_stemming_keeps_batches_in_arrow(spark):
    """Python holds the distinct words of a batch, not a string object a token."""
    import tracemalloc

    import pyarrow as pa

    from lexigrid.functions import stemming

    tokens = pa.array([["running", "houses", "walked"] * 200] * 1000, pa.list_(pa.string()))
    language = pa.array(["en"] * 1000)
    tracemalloc.start()
    stemmed = stemming._stem_arrays.func(tokens, language)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert stemmed[999].as_py()[:3] == [stemming.stem_word(w, "en") for w in ("running", "houses", "walked")]
    assert peak < 40 * 600_000  # numpy's few numbers a token; Python strings and lists took 60 bytes and more


def test_grams_of_odd_texts(spark):
    grams = lambda text, *sizes: tokens_of(spark, text, lambda c: tk.ngram_tokens(c, *sizes))
    assert grams("a\n😀漢", 2, 3) == ["a\n", "a\n😀", "\n😀", "\n😀漢", "😀漢"]
    assert grams("a\n😀漢", 3, 3) == ["a\n😀", "\n😀漢"]
    assert grams("", 2, 3) == [] and grams(None, 3, 3) == [] and grams("", 1, 2) == [""]


def test_grams_of_parts_are_counted_where_the_parts_are(spark):
    """One exchange of parts and one of counted grams; no row a gram is shuffled."""
    from lexigrid.plans import PLANS

    plan = PLANS["tokenize_ngram"].build(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "REPARTITION_BY_NUM" in plan
