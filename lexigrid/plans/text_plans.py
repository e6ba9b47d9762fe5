"""Text analysis queries.

Most return one row per document with the number of tokens and a digest of all of them in
order, which checks every token without returning each as a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.functions import tokens as tk
from lexigrid.functions.stopwords import stop_words
from lexigrid.operators import multilingual as ml
from lexigrid.operators import postings as ps
from lexigrid.plans.catalog import SQL_TOKENS, documents, index_path, plan, sql_bm25, table


def digest(df: DataFrame, tokens: Column) -> DataFrame:
    return df.select("doc_id", tokens.alias("t")).select(
        "doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("digest")
    )


def digest_sql(tokens: str) -> str:
    return f"""
        SELECT doc_id, len(t)::INT AS n_tokens, md5(array_to_string(t, ' ')) AS digest
        FROM (SELECT doc_id, {tokens} AS t FROM documents)"""


PARTS_PER_TASK = 20_000

SQL_SIMPLE = r"list_filter(string_split_regex({}, '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
SQL_EMAIL = r"[A-Za-z0-9._-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+"


@plan("tokenize_simple", digest_sql(SQL_SIMPLE.format("text")))
def tokenize_simple(spark, d):
    return digest(documents(spark, d), tk.simple_tokens(F.col("text")))


@plan(
    "tokenize_whitespace",
    digest_sql(r"list_filter(string_split_regex(text, '[\s\p{Z}]+'), lambda w: w <> '')"),
)
def tokenize_whitespace(spark, d):
    return digest(documents(spark, d), tk.whitespace_tokens(F.col("text")))


@plan("tokenize_regex", digest_sql(f"regexp_extract_all(text, '{SQL_EMAIL}')"))
def tokenize_regex(spark, d):
    return digest(documents(spark, d), tk.regex_tokens(F.col("text"), SQL_EMAIL))


@plan(
    "tokenize_ngram",
    """
    SELECT substring(p_name, s, n) AS gram, count(*) AS n_grams, count(DISTINCT p_partkey) AS n_parts
    FROM part, range(1, 200) a(s), range(2, 5) b(n)
    WHERE s + n - 1 <= length(p_name)
    GROUP BY 1""",
)
def tokenize_ngram(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_name")
    # a part's grams are counted in one task, and a task has a bounded share of the parts
    tasks = max(spark.sparkContext.defaultParallelism, -(-part.count() // PARTS_PER_TASK))
    part = part.repartition(tasks, "p_partkey")
    grams = part.select("p_partkey", F.explode(tk.ngram_tokens(F.col("p_name"), 2, 4)).alias("gram"))
    per_part = grams.groupBy("gram", "p_partkey").agg(F.count(F.lit(1)).alias("n"))
    return per_part.groupBy("gram").agg(
        F.sum("n").alias("n_grams"), F.count(F.lit(1)).alias("n_parts")
    )


@plan(
    "tokenize_raw",
    "SELECT p_type AS term, count(*) AS n FROM part WHERE trim(p_type) <> '' GROUP BY 1",
)
def tokenize_raw(spark, d):
    terms = table(spark, d, "part").select(F.explode(tk.raw_tokens(F.col("p_type"))).alias("term"))
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


@plan("filter_lowercase", digest_sql(SQL_SIMPLE.format("lower(text)")))
def filter_lowercase(spark, d):
    return digest(documents(spark, d), tk.simple_tokens(F.lower("text")))


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


SQL_IS_STOP = " OR ".join(
    f"(lang = '{code}' AND term IN ({_quoted(stop_words(code))}))" for code in ("en", "de", "fr", "es")
)


@plan(
    "filter_stopwords",
    f"""
    WITH {SQL_TOKENS}, kept AS (SELECT * FROM numbered WHERE NOT ({SQL_IS_STOP}))
    SELECT d.doc_id, coalesce(n, 0) AS n_tokens, coalesce(g, md5('')) AS digest
    FROM documents d LEFT JOIN (
        SELECT doc_id, count(*)::INT AS n, md5(string_agg(term, ' ' ORDER BY pos)) AS g
        FROM kept GROUP BY doc_id) USING (doc_id)""",
)
def filter_stopwords(spark, d):
    analyzer = tk.Analyzer(stop="row", max_bytes=None)
    return digest(documents(spark, d), analyzer.tokens(F.col("text"), F.col("lang")))


@plan("filter_stem")
def filter_stem(spark, d):
    """Most frequent stems per language with the number of word forms behind each."""
    docs = documents(spark, d)
    words = docs.select("lang", F.explode(tk.simple_tokens(F.lower("text"))).alias("term"))
    counted = words.groupBy("lang", "term").agg(F.count(F.lit(1)).alias("n"))
    stems = counted.withColumn("stem", tk.stem_tokens(F.array("term"), F.col("lang"))[0])
    return stems.groupBy("lang", "stem").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("forms")
    )


SWEDISH_MAIN = (
    "a|arna|erna|heterna|orna|ad|e|ade|ande|arne|are|aste|en|anden|aren|heten|ern|ar|er|heter|or|as|arnas|"
    "ernas|ornas|es|ades|andes|ens|arens|hetens|erns|at|andet|het|ast|s"
)


@plan(
    "filter_stem_swedish",
    f"""
    WITH {SQL_TOKENS},
    words AS (
        SELECT term, count(*) AS n, greatest(3, CASE WHEN regexp_matches(term, '[aeiouyäåö][^aeiouyäåö]')
            THEN length(regexp_extract(term, '^[^aeiouyäåö]*[aeiouyäåö]+[^aeiouyäåö]')) ELSE length(term) END) AS r1
        FROM numbered GROUP BY term),
    ended AS (SELECT *, regexp_extract(substr(term, r1 + 1), '({SWEDISH_MAIN})$') AS ending FROM words),
    cut AS (
        SELECT term, n, r1, CASE
            WHEN ending = 's' AND NOT regexp_matches(term, '[bcdfghjklmnoprtvy]s$') THEN term
            ELSE left(term, length(term) - length(ending)) END AS w FROM ended),
    single AS (
        SELECT term, n, r1, CASE WHEN regexp_matches(substr(w, r1 + 1), '(dd|gd|nn|dt|gt|kt|tt)$')
            THEN left(w, length(w) - 1) ELSE w END AS w FROM cut),
    last AS (SELECT *, regexp_extract(substr(w, r1 + 1), '(lig|ig|els|löst|fullt)$') AS ending FROM single)
    SELECT stem, sum(n)::BIGINT AS n, count(*) AS forms FROM (
        SELECT n, left(w, length(w) - CASE WHEN ending IN ('löst', 'fullt') THEN 1 ELSE length(ending) END) AS stem
        FROM last) GROUP BY stem""",
)
def filter_stem_swedish(spark, d):
    """Word forms behind each stem by one language's rules, over all distinct words."""
    words = documents(spark, d).select(F.explode(tk.simple_tokens(F.lower("text"))).alias("term"))
    counted = words.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    stems = counted.withColumn("stem", tk.stem_tokens(F.array("term"), F.lit("swedish"))[0])
    return stems.groupBy("stem").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("forms"))


@plan(
    "filter_long",
    f"""
    WITH {SQL_TOKENS}
    SELECT d.doc_id, coalesce(n, 0) AS n_tokens, coalesce(g, md5('')) AS digest
    FROM documents d LEFT JOIN (
        SELECT doc_id, count(*)::INT AS n, md5(string_agg(term, ' ' ORDER BY pos)) AS g
        FROM numbered WHERE strlen(term) < 12 GROUP BY doc_id) USING (doc_id)""",
)
def filter_long(spark, d):
    return digest(documents(spark, d), tk.drop_long(tk.simple_tokens(F.lower("text")), 12))


@plan(
    "analyze",
    f"""
    WITH {SQL_TOKENS}, kept AS (SELECT * FROM toks WHERE term NOT IN ({_quoted(stop_words("en"))}))
    SELECT term, count(*) AS cf, count(DISTINCT doc_id) AS df, sum(pos)::BIGINT AS pos_sum
    FROM kept GROUP BY term""",
)
def analyze(spark, d):
    """Lower, English stop words and the length limit; positions of kept tokens stay true."""
    rows = ps.token_table(documents(spark, d), "doc_id", {"text": "text"}, tk.Analyzer(stop="en"))
    per_doc = rows.groupBy("key", "term").agg(
        F.count(F.lit(1)).alias("tf"), F.sum("pos").alias("pos")
    )
    return per_doc.groupBy("term").agg(
        F.sum("tf").alias("cf"), F.count(F.lit(1)).alias("df"), F.sum("pos").alias("pos_sum")
    )


@plan("analyze_language")
def analyze_language(spark, d):
    """The stop word and stem preset of each document's own language."""
    analyzer = tk.Analyzer(stop="row", stem="row")
    return digest(documents(spark, d), analyzer.tokens(F.col("text"), F.col("lang")))


@plan(
    "tokens_with_offsets",
    r"""
    WITH RECURSIVE pieces AS (
        SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS i
        FROM (SELECT doc_id, regexp_extract_all(text, '[^\p{L}\p{N}]*[\p{L}\p{N}]+') AS p FROM documents)),
    spans AS (
        SELECT doc_id, i, regexp_replace(piece, '^[^\p{L}\p{N}]+', '') AS term,
               sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) AS stop
        FROM pieces)
    SELECT doc_id, count(*) AS n_tokens, sum(stop - length(term))::BIGINT AS start_sum,
           sum(stop)::BIGINT AS end_sum,
           sum(CASE WHEN substring(text, (stop - length(term) + 1)::BIGINT, length(term)) = term THEN 0 ELSE 1 END)::BIGINT AS wrong
    FROM spans JOIN documents USING (doc_id) GROUP BY doc_id""",
)
def tokens_with_offsets(spark, d):
    docs = documents(spark, d)
    spans = ps.offset_spans(docs, "doc_id", "text").where(F.size("spans") > 0)
    total = lambda of: F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + of(s))
    # characters are split out once a text: substring() would walk it from its start for each token
    said = lambda chars, s: F.array_join(F.slice(chars, s["start"].cast("int") + 1, F.length(s["term"])), "")
    wrong = F.transform(
        F.array(F.split("text", "")),
        lambda chars: total(lambda s: (said(chars, s) != s["term"]).cast("long")),
    )
    return spans.select(
        F.col("key").alias("doc_id"),
        F.size("spans").cast("long").alias("n_tokens"),
        total(lambda s: s["start"]).alias("start_sum"),
        total(lambda s: s["end"]).alias("end_sum"),
        F.get(wrong, F.lit(0)).alias("wrong"),
    )


@plan(
    "pretokenized",
    r"""
    WITH t AS (
        SELECT unnest(w) AS term, generate_subscripts(w, 1) - 1 AS pos
        FROM (SELECT list_filter(string_split_regex(text, '[\s\p{Z}]+'), lambda x: x <> '') AS w FROM conversations))
    SELECT term, count(*) AS n, min(pos)::INT AS first_pos, max(pos)::INT AS last_pos
    FROM t GROUP BY term""",
)
def pretokenized(spark, d):
    turns = table(spark, d, "conversations")
    rows = ps.pretokenized(
        turns, F.struct("conv_id", "turn"), tk.whitespace_tokens(F.col("text"))
    )
    return rows.groupBy("term").agg(
        F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos")
    )


@plan(
    "build_postings",
    f"""
    WITH {SQL_TOKENS}, dl AS (SELECT doc_id, count(*) AS dl FROM toks GROUP BY doc_id),
    post AS (SELECT doc_id, term, count(*) AS tf, sum(pos) AS p, min(pos) AS first
             FROM toks GROUP BY doc_id, term)
    SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf, max(tf) AS max_tf, sum(p)::BIGINT AS pos_sum,
           sum(first)::BIGINT AS first_sum, sum(dl)::BIGINT AS dl_sum
    FROM post JOIN dl USING (doc_id) GROUP BY term""",
)
def build_postings(spark, d):
    """Statistics over the full inverted index, positions and lengths included."""
    index = ps.build_postings(ps.token_streams(documents(spark, d), "doc_id", {"text": "text"}))
    return index.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"),
        F.sum("tf").alias("cf"),
        F.max("tf").alias("max_tf"),
        F.sum(F.aggregate("positions", F.lit(0).cast("bigint"), lambda a, p: a + p)).alias("pos_sum"),
        F.sum(F.col("positions")[0]).alias("first_sum"),
        F.sum("dl").alias("dl_sum"),
    )


@plan(
    "compare_analyzers",
    rf"""
    WITH c AS (
        SELECT len({SQL_SIMPLE.format("text")}) AS simple,
               len(list_filter(string_split_regex(text, '[\s\p{{Z}}]+'), lambda w: w <> '')) AS whitespace,
               (trim(text) <> '')::INT AS raw,
               len(regexp_extract_all(text, '{SQL_EMAIL}')) AS email,
               greatest(length(text) - 2, 0) AS trigram
        FROM documents)
    SELECT 'simple' AS analyzer, sum(simple)::BIGINT AS n_tokens FROM c
    UNION ALL SELECT 'whitespace', sum(whitespace)::BIGINT FROM c
    UNION ALL SELECT 'raw', sum(raw)::BIGINT FROM c
    UNION ALL SELECT 'email', sum(email)::BIGINT FROM c
    UNION ALL SELECT 'trigram', sum(trigram)::BIGINT FROM c""",
)
def compare_analyzers(spark, d):
    """Token totals of several analyzers over the same texts in one pass."""
    text = F.col("text")
    counts = {
        "simple": F.size(tk.simple_tokens(text)),
        "whitespace": F.size(tk.whitespace_tokens(text)),
        "raw": F.size(tk.raw_tokens(text)),
        "email": F.size(tk.regex_tokens(text, SQL_EMAIL)),
        "trigram": F.size(tk.ngram_tokens(text, 3, 3)),
    }
    totals = documents(spark, d).agg(*[F.sum(c).alias(n) for n, c in counts.items()])
    return totals.unpivot([], list(counts), "analyzer", "n_tokens")


@plan(
    "multilingual_fields",
    f"""
    WITH {SQL_TOKENS}, f AS (
        SELECT 'content_' || lang AS field, doc_id, term FROM toks WHERE NOT ({SQL_IS_STOP})
        UNION ALL SELECT 'content_raw', doc_id, term FROM numbered)
    SELECT field, term, count(DISTINCT doc_id) AS df, count(*) AS cf
    FROM f GROUP BY 1, 2""",
)
def multilingual_fields(spark, d):
    """One field per language under its own stop words, one raw field for all."""
    docs = documents(spark, d).select("doc_id", "text", "lang")

    def analyse(rows: DataFrame) -> DataFrame:
        own = tk.Analyzer(stop="row").tokens(F.col("text"), F.col("lang"))
        fields = F.array(
            F.struct(F.concat(F.lit("content_"), F.col("lang")).alias("field"), own.alias("slots")),
            F.struct(F.lit("content_raw").alias("field"), tk.simple_tokens(F.lower("text")).alias("slots")),
        )
        return rows.select(F.col("doc_id").alias("key"), F.inline(fields)).withColumn("dl", F.size("slots"))

    per_doc = ps.build_postings(ps.Streams(docs, "doc_id", analyse))
    return per_doc.groupBy("field", "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf")
    )


@plan(
    "search_multilingual",
    f"""
    WITH {SQL_TOKENS},
    f AS (
        SELECT CASE WHEN lang IN ('en', 'de', 'fr') THEN 'content_' || lang ELSE 'content_other' END AS field,
               doc_id, term
        FROM toks WHERE lang NOT IN ('en', 'de', 'fr') OR lang IS NULL OR NOT ({SQL_IS_STOP})),
    lens AS (SELECT field, doc_id, count(*) AS dl FROM f GROUP BY ALL),
    coll AS (
        SELECT field, sum(dl) / (SELECT count(*) FROM documents) AS avgdl,
               (SELECT count(*) FROM documents) AS n FROM lens GROUP BY field),
    asked(query, field, term) AS (VALUES
        ('german', 'content_de', 'ber'), ('german', 'content_de', 'keit'),
        ('french', 'content_fr', 'aux'), ('french', 'content_fr', 'tion'),
        ('spanish', 'content_other', 'que'), ('spanish', 'content_other', 'ciónes')),
    found AS (
        SELECT query, field, doc_id, term, count(*) AS tf FROM f JOIN asked USING (field, term) GROUP BY ALL),
    dfs AS (SELECT field, term, count(DISTINCT doc_id) AS df FROM f GROUP BY ALL)
    SELECT query, doc_id, round(sum({sql_bm25("tf", "df")}), 6) AS score
    FROM found JOIN dfs USING (field, term) JOIN lens USING (field, doc_id) JOIN coll USING (field)
    GROUP BY query, doc_id""",
)
def search_multilingual(spark, d):
    """Each query in the field of its language; Spanish has none here and goes to the others."""
    fields = ml.LanguageFields(["en", "de", "fr"], stem=False)
    docs = documents(spark, d)
    path = index_path(spark, d, "language-fields", lambda: fields.analyze(docs, "doc_id", "text", "lang"))
    asked = {"german": ("der Ber, Keit", "de"), "french": ("le aux TION", "fr"), "spanish": ("que ciónes", "es")}
    found = fields.search(fields.load(docs, "doc_id", path), asked)
    return found.select(F.col("query_id").alias("query"), F.col("key").alias("doc_id"), F.round("score", 6).alias("score"))


@plan(
    "normalize_cjk",
    r"""
    SELECT page_id, length(t) AS n_chars, md5(t) AS digest FROM (
        SELECT page_id, trim(regexp_replace(regexp_replace(html, '[\p{P}\p{S}]', ' ', 'g'),
                                            '[\s\p{Z}]+', ' ', 'g')) AS t FROM pages)""",
)
def normalize_cjk(spark, d):
    return table(spark, d, "pages").select("page_id", tk.normalize_cjk(F.col("html")).alias("t")).select(
        "page_id", F.length("t").cast("bigint").alias("n_chars"), F.md5("t").alias("digest")
    )
