"""Tokenizers and token filters as column expressions.

Every function maps a text column to an array column inside one row, so analysis never
shuffles; ``operators.postings`` explodes the arrays into token tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lexigrid.functions.stemming import stem_tokens, stemmer_name
from lexigrid.functions.stopwords import LANGUAGES, language_name, stop_words

# What separates words, and what counts as blank.
WORD_BREAK = r"[^\p{L}\p{N}]+"
BLANK = r"[\s\p{Z}]+"


def no_tokens() -> Column:
    return F.array().cast("array<string>")


def simple_tokens(text: Column) -> Column:
    """Runs of letters and digits, case kept."""
    return F.coalesce(F.array_remove(F.split(text, WORD_BREAK), ""), no_tokens())


def whitespace_tokens(text: Column) -> Column:
    """Pieces between blanks, punctuation and case kept."""
    return F.coalesce(F.array_remove(F.split(text, BLANK), ""), no_tokens())


def check_pattern(pattern: str) -> None:
    """An error unless the engine that will run the pattern can compile it."""
    try:
        SparkSession.active().sql("SELECT '' RLIKE :pattern", {"pattern": pattern}).collect()
    except Exception as problem:
        raise ValueError(f"invalid pattern {pattern!r}: {str(problem).splitlines()[0]}") from problem


def regex_tokens(text: Column, pattern: str) -> Column:
    """Every match of ``pattern``; a pattern that cannot compile is an error right away."""
    check_pattern(pattern)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.coalesce(F.array_remove(found, ""), no_tokens())


def ngram_tokens(text: Column, min_gram: int, max_gram: int, prefix_only: bool = False) -> Column:
    """Character n-grams ordered by start then length."""
    if min_gram < 1 or min_gram > max_gram:
        raise ValueError("need 1 <= min_gram <= max_gram")
    # One pass of the pattern steps over each character and looks ahead for its longest gram; the
    # shorter grams are beginnings of that.
    longest = F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{min_gram},{max_gram}}}))."), F.lit(1))
    if prefix_only:
        longest = F.slice(longest, 1, 1)
    if min_gram == 1:
        longest = F.when(text == "", F.array(F.lit(""))).otherwise(longest)  # one empty gram
    if min_gram == max_gram:
        return F.coalesce(longest, no_tokens())
    lengths = lambda gram: F.sequence(F.least(F.lit(min_gram), F.length(gram)), F.length(gram))
    grams = F.transform(longest, lambda gram: F.transform(lengths(gram), lambda n: F.left(gram, n)))
    return F.coalesce(F.flatten(grams), no_tokens())


def raw_tokens(text: Column) -> Column:
    """The whole value as one token; nothing for a null or blank value."""
    return F.when(F.length(F.trim(text)) > 0, F.array(text)).otherwise(no_tokens())


def is_stop_word(term: Column, language: Column | str) -> Column:
    """Stop word test by a fixed language or by a column of ISO codes."""
    if isinstance(language, str):
        words = stop_words(language)
        return term.isin(*words) if words else F.lit(False)
    test = None
    for code in LANGUAGES:
        words = stop_words(code)
        if words:
            hit = term.isin(*words)
            test = F.when(language == code, hit) if test is None else test.when(language == code, hit)
    return test.otherwise(F.lit(False))


def is_short(term: Column, limit: int) -> Column:
    """True below ``limit`` bytes."""
    return F.octet_length(term) < limit


def drop_long(tokens: Column, limit: int = 40) -> Column:
    return F.filter(tokens, lambda term: is_short(term, limit))


def drop_stop_words(tokens: Column, language: Column | str) -> Column:
    return F.filter(tokens, lambda term: ~is_stop_word(term, language))


@dataclass(frozen=True)
class Analyzer:
    """A tokenizer plus filters applied in the fixed order lower, stop, stem, long.

    ``stop`` and ``stem`` name a language, or ``"row"`` to take it from the language
    column given at use.  A named language without a stemmer is an error; rows of one keep
    their words.
    """

    base: str = "simple"
    lower: bool = True
    stop: str | None = None
    stem: str | None = None
    max_bytes: int | None = 40
    pattern: str | None = None
    min_gram: int = 2
    max_gram: int = 3
    prefix_only: bool = False

    def __post_init__(self):
        if self.stem not in (None, "row"):
            stemmer_name(self.stem)

    def _base(self, text: Column) -> Column:
        if self.base == "simple":
            return simple_tokens(text)
        if self.base == "whitespace":
            return whitespace_tokens(text)
        if self.base == "raw":
            return raw_tokens(text)
        if self.base == "regex":
            return regex_tokens(text, self.pattern or "")
        if self.base == "ngram":
            return ngram_tokens(text, self.min_gram, self.max_gram, self.prefix_only)
        raise ValueError(f"unknown tokenizer: {self.base}")

    def slots(self, text: Column, lang: Column | None = None) -> Column:
        """Tokens by position; a dropped token leaves a null so positions stay true."""
        tokens = self._base(F.lower(text) if self.lower else text)
        if self.stop is not None:
            language = self._language(self.stop, lang)
            tokens = F.transform(tokens, lambda t: F.when(~is_stop_word(t, language), t))
        if self.stem is not None:
            language = self._language(self.stem, lang)
            name = F.lit(language_name(language)) if isinstance(language, str) else language
            tokens = stem_tokens(tokens, name)
        if self.max_bytes is not None and self.base != "ngram":
            tokens = F.transform(tokens, lambda t: F.when(is_short(t, self.max_bytes), t))
        return tokens

    def tokens(self, text: Column, lang: Column | None = None) -> Column:
        return F.array_compact(self.slots(text, lang))

    @staticmethod
    def _language(setting: str, lang: Column | None) -> Column | str:
        if setting != "row":
            return setting
        if lang is None:
            raise ValueError("this analyzer takes its language from a column")
        return lang


def preset(name: str) -> Analyzer:
    """Named analyzers: simple, whitespace, raw/keyword, default, <lang>_stem, <lang>_text."""
    fixed = {
        "simple": Analyzer(lower=False, max_bytes=None),
        "whitespace": Analyzer(base="whitespace", lower=False, max_bytes=None),
        "raw": Analyzer(base="raw", lower=False, max_bytes=None),
        "keyword": Analyzer(base="raw", lower=False, max_bytes=None),
        "default": Analyzer(stop="en", stem="en"),
    }
    if name in fixed:
        return fixed[name]
    language, _, kind = name.rpartition("_")
    if kind == "stem":
        return Analyzer(stem=language_name(language))
    if kind == "text":
        return Analyzer(stop=language_name(language), stem=language_name(language))
    raise ValueError(f"unknown analyzer: {name}")


SEARCH = Analyzer()


def normalize_cjk(text: Column) -> Column:
    """Punctuation and symbols to spaces, blanks collapsed."""
    spaced = F.regexp_replace(text, r"[\p{P}\p{S}]", " ")
    return F.trim(F.regexp_replace(spaced, BLANK, " "))


def query_terms(text: Column) -> Column:
    """Distinct sorted terms of query text without the query stop words."""
    # Words a query text drops.
    ignored = ["and", "or", "not", "the", "a", "an", "in", "on", "at"]
    cleaned = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_\s]", " ")
    words = whitespace_tokens(cleaned)
    return F.array_sort(F.array_distinct(F.filter(words, lambda t: ~t.isin(*ignored))))
