"""Texts of several languages in one index: a field for each language, and a search that picks it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.functions.stemming import stemmer_name
from lexigrid.functions.stopwords import language_name
from lexigrid.functions.tokens import Analyzer
from lexigrid.operators.postings import Corpus, Streams, exploded, load_index
from lexigrid.operators.queries import Bool, Nothing, Query, Term, match_many

OTHER = "other"


class LanguageFields:
    """Which field a language's texts and queries go to, and how they are analysed.

    Each text goes to one field: that of its language, under the language's stop words and
    stemmer, or ``<prefix>_other`` as plain lower-case words where the language is null or not
    among ``languages``.  So the index is no larger than one of a single field.
    """

    def __init__(self, languages: list[str], prefix: str = "content", stem: bool = True):
        for language in languages:
            (stemmer_name if stem else language_name)(language)
        self.languages, self.prefix = list(languages), prefix
        self.analyzer = Analyzer(stop="row", stem="row" if stem else None)

    def names(self) -> list[str]:
        return [f"{self.prefix}_{language}" for language in [*self.languages, OTHER]]

    def served(self, lang: Column) -> Column:
        return F.when(lang.isin(*self.languages), lang)

    def field(self, lang: Column) -> Column:
        return F.concat(F.lit(f"{self.prefix}_"), F.coalesce(self.served(lang), F.lit(OTHER)))

    def slots(self, text: Column, lang: Column) -> Column:
        return self.analyzer.slots(text, self.served(lang))

    def analyze(self, docs: DataFrame, key: str, text: str, lang: str) -> Corpus:
        """A corpus to search or to save; a narrow step.  Lengths are 0 in the other fields."""
        # out of generators, so that a text is analysed once, however often its words are read
        def analyse(rows: DataFrame) -> DataFrame:
            return rows.select(
                F.col(key).alias("key"),
                self.field(F.col(lang)).alias("field"),
                F.explode(F.array(self.slots(F.col(text), F.col(lang)))).alias("slots"),
            ).select("*", F.explode(F.array(F.size(F.array_compact("slots")))).alias("dl"))

        sized = analyse(docs)
        occurrences = exploded(sized).select(
            "key", "field", "term", F.lit(1).alias("tf"), F.array("pos").alias("positions"), "dl"
        )
        lengths = sized.select(
            "key", *[F.when(F.col("field") == name, F.col("dl")).otherwise(0).alias(name) for name in self.names()]
        )
        streams = Streams(docs.select(*dict.fromkeys([key, text, lang])), key, analyse)
        return Corpus(docs, key, occurrences, lengths, self.analyzer, streams=streams)

    def load(self, docs: DataFrame, key: str, path: str) -> Corpus:
        return load_index(docs, key, path, self.analyzer)

    def queries(self, spark: SparkSession, asked: dict[str, tuple[str, str | None]]) -> dict[str, Query]:
        """Query objects of (text, language) pairs: any word, in the field of the language.

        Texts are analysed as documents are; one of stop words alone matches nothing.
        """
        rows = [(name, text, lang) for name, (text, lang) in asked.items()]
        text, lang = F.col("text"), F.col("lang")
        analysed = spark.createDataFrame(rows, "name string, text string, lang string").select(
            "name", self.field(lang).alias("field"),
            F.array_distinct(F.array_compact(self.slots(text, lang))).alias("terms"),
        )
        return {
            r.name: Bool(should=tuple(Term(r.field, t) for t in r.terms)) if r.terms else Nothing()
            for r in analysed.collect()
        }

    def search(self, corpus: Corpus, asked: dict[str, tuple[str, str | None]]) -> DataFrame:
        """(query_id, key, score) of (text, language) pairs, in one scan of their terms."""
        return match_many(corpus, self.queries(corpus.docs.sparkSession, asked))
