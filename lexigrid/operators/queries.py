"""Query objects and how they become DataFrame plans.

A whole query tree is one ``groupBy(key)`` of the occurrences: every text clause turns into
its conditional aggregates, and the tree above them is a boolean expression over that row.
Over a saved index only the buckets of the terms are read.  Prefixes, patterns and spellings
are tested on the distinct terms of its dictionary first, and document frequencies come from
there too.  Clauses on document columns are predicates, so Catalyst pushes them to the scan.
"""

from __future__ import annotations

import functools
import operator
import re
from dataclasses import dataclass, field as dataclass_field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrid.functions.tokens import check_pattern
from lexigrid.operators import vocabulary as vc
from lexigrid.operators.postings import Corpus
from lexigrid.operators.ranking import bm25_weight, idf
from lexigrid.session import stored

# Spellings of true and false in typed term text.
TRUE_WORDS = ["true", "t", "1", "yes", "y"]
FALSE_WORDS = ["false", "f", "0", "no", "n"]


class Query:
    """Base of all query objects."""


class ColumnQuery(Query):
    """A query that a document's own columns decide."""

    def predicate(self, docs: DataFrame) -> Column:
        raise NotImplementedError


class TextQuery(Query):
    """A query that a document's terms decide."""

    field: str

    def slots(self, corpus: Corpus) -> list[Column]:
        """One condition on (field, term) per slot."""
        raise NotImplementedError

    def words(self) -> list[str] | None:
        """The terms the query can match, or none if only a look at the terms tells."""
        return None

    def candidates(self, corpus: Corpus) -> DataFrame:
        """(field, term, bucket, df) of the dictionary's terms that the slots may accept."""
        return corpus.terms


@dataclass(frozen=True)
class All(ColumnQuery):
    def predicate(self, docs: DataFrame) -> Column:
        return F.lit(True)


@dataclass(frozen=True)
class Nothing(ColumnQuery):
    def predicate(self, docs: DataFrame) -> Column:
        return F.lit(False)


@dataclass(frozen=True)
class Range(ColumnQuery):
    """Range on a typed column; both ends open means any value."""

    field: str
    low: object = None
    high: object = None
    include_low: bool = True
    include_high: bool = True

    def predicate(self, docs: DataFrame) -> Column:
        column = known(docs, self.field)
        test = column.isNotNull()
        if self.low is not None:
            low = F.lit(self.low)
            test &= column >= low if self.include_low else column > low
        if self.high is not None:
            high = F.lit(self.high)
            test &= column <= high if self.include_high else column < high
        return test


@dataclass(frozen=True)
class TypedTerm(ColumnQuery):
    """Equality on a number, bool or date column; the value comes as text."""

    field: str
    value: str

    def predicate(self, docs: DataFrame) -> Column:
        column, kind = known(docs, self.field), docs.schema[self.field].dataType
        if isinstance(kind, T.BooleanType):
            word = self.value.strip().lower()
            if word not in TRUE_WORDS + FALSE_WORDS:
                raise ValueError(f"not a bool: {self.value}")
            return column == F.lit(word in TRUE_WORDS)
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            moment = F.timestamp_add("SECOND", F.lit(int(self.value)), F.lit("1970-01-01").cast("timestamp_ntz"))
            return column.cast("timestamp_ntz") == moment
        if isinstance(kind, T.IntegralType):
            return column == F.lit(int(self.value))
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return column == F.lit(float(self.value))
        return column == F.lit(self.value)


@dataclass(frozen=True)
class Exists(ColumnQuery):
    field: str

    def predicate(self, docs: DataFrame) -> Column:
        column = known(docs, self.field)
        if isinstance(docs.schema[self.field].dataType, T.ArrayType):
            return F.coalesce(F.size(column) > 0, F.lit(False))
        return column.isNotNull()


@dataclass(frozen=True)
class FacetTerm(ColumnQuery):
    """Documents under a facet path; ``field`` holds an array of facet paths."""

    field: str
    path: str

    def predicate(self, docs: DataFrame) -> Column:
        from lexigrid.operators.facets import under_path

        return under_path(known(docs, self.field), self.path)


@dataclass(frozen=True)
class Term(TextQuery):
    field: str
    text: str

    def slots(self, corpus: Corpus) -> list[Column]:
        return [on(self.field) & (F.col("term") == self.text.lower())]

    def words(self) -> list[str] | None:
        return [self.text.lower()]


@dataclass(frozen=True)
class Phrase(TextQuery):
    """Terms in order and adjacent."""

    field: str
    terms: tuple[str, ...]

    def slots(self, corpus: Corpus) -> list[Column]:
        if not self.terms:
            raise ValueError("a phrase needs a term")
        return [on(self.field) & (F.col("term") == t.lower()) for t in self.terms]

    def words(self) -> list[str] | None:
        return [t.lower() for t in self.terms]


@dataclass(frozen=True)
class PhrasePrefix(Phrase):
    """A phrase whose last term is a prefix; of any terms, or of the first ``max_expansions``."""

    max_expansions: int | None = None

    def words(self) -> list[str] | None:
        return None

    def slots(self, corpus: Corpus) -> list[Column]:
        *head, last = super().slots(corpus)
        prefix = self.terms[-1].lower()
        if self.max_expansions is None:
            return [*head, on(self.field) & F.col("term").startswith(prefix)]
        source = corpus.occurrences if corpus.terms is None else corpus.terms
        expansions = (
            source.where(on(self.field) & F.col("term").startswith(prefix))
            .select("term")
            .distinct()
            .orderBy("term")
            .limit(self.max_expansions)
            .agg(F.collect_list("term"))
        )
        return [*head, on(self.field) & F.array_contains(expansions.scalar(), F.col("term"))]


class TermSet(TextQuery):
    """Any term that a test accepts; every match scores 1."""


@dataclass(frozen=True)
class Prefix(TermSet):
    field: str
    prefix: str

    def slots(self, corpus: Corpus) -> list[Column]:
        return [on(self.field) & F.col("term").startswith(self.prefix.lower())]


@dataclass(frozen=True)
class Fuzzy(TermSet):
    """Terms within an edit distance; a swap of neighbours may count as one edit."""

    field: str
    text: str
    distance: int = 2
    transpositions: bool = True

    def slots(self, corpus: Corpus) -> list[Column]:
        return [on(self.field) & within(F.col("term"), self.text.lower(), self.distance, self.transpositions)]

    def candidates(self, corpus: Corpus) -> DataFrame:
        if corpus.keys is None or self.distance > vc.DELETIONS:
            return corpus.terms
        return vc.near_terms(corpus.keys, corpus.terms, self.text.lower())


@dataclass(frozen=True)
class Wildcard(TermSet):
    """``*`` is any run of characters and ``?`` any one character."""

    field: str
    pattern: str

    def slots(self, corpus: Corpus) -> list[Column]:
        parts = re.split(r"([*?])", self.pattern.lower())
        meaning = {"*": ".*", "?": "."}
        body = "".join(meaning.get(part) or re.escape(part) for part in parts if part)
        return [on(self.field) & F.col("term").rlike(f"^(?:{body})$")]

    def candidates(self, corpus: Corpus) -> DataFrame:
        grams = vc.fixed_grams(vc.wildcard_parts(self.pattern))
        if corpus.keys is None or not grams:
            return corpus.terms
        return vc.holding_grams(corpus.keys, grams)


@dataclass(frozen=True)
class Regex(TermSet):
    field: str
    pattern: str

    def slots(self, corpus: Corpus) -> list[Column]:
        check_pattern(self.pattern)
        return [on(self.field) & F.col("term").rlike(f"^(?:{self.pattern})$")]


@dataclass(frozen=True)
class Boost(Query):
    query: Query
    factor: float


@dataclass(frozen=True)
class Bool(Query):
    must: tuple[Query, ...] = ()
    should: tuple[Query, ...] = ()
    must_not: tuple[Query, ...] = ()


def all_terms(field: str, text: str) -> Query:
    """One word is a term; several words must all occur."""
    words = text.split()
    if len(words) == 1:
        return Term(field, words[0])
    return Bool(must=tuple(Term(field, w) for w in dict.fromkeys(words)))


def any_terms(field: str, text: str) -> Query:
    return Bool(should=tuple(Term(field, w) for w in dict.fromkeys(text.split())))


def phrase(field: str, terms: list[str]) -> Query:
    """A phrase of one term is that term; none is an error."""
    if not terms:
        raise ValueError("a phrase needs a term")
    return Term(field, terms[0]) if len(terms) == 1 else Phrase(field, tuple(terms))


def facets(
    field: str, must: list[str] = (), should: list[str] = (), must_not: list[str] = ()
) -> Query:
    """Several facet paths combined."""
    return Bool(
        tuple(FacetTerm(field, p) for p in must),
        tuple(FacetTerm(field, p) for p in should),
        tuple(FacetTerm(field, p) for p in must_not),
    )


def on(field: str) -> Column:
    return F.col("field") == field


def typed(value: str) -> object:
    """A criterion's text as number, bool or string, tried in this order."""
    for cast in (int, float):
        try:
            return cast(value)
        except ValueError:
            pass
    return {"true": True, "false": False}.get(value.lower(), value)


def criteria(docs: DataFrame, triples: list[tuple[str, str, str]]) -> Column:
    """All of (field, operation, value text); a missing value never passes.

    Operations: equals, gt, lt, contains, regex.
    """
    tests = []
    for name, operation, text in triples:
        column, value = known(docs, name), F.lit(typed(text))
        table = {
            "equals": lambda: column == value,
            "gt": lambda: column > value,
            "lt": lambda: column < value,
            "contains": lambda: column.cast("string").contains(text),
            "regex": lambda: column.cast("string").rlike(text),
        }
        if operation not in table:
            raise ValueError(f"unknown operation: {operation}")
        tests.append(F.coalesce(table[operation](), F.lit(False)))
    return functools.reduce(operator.and_, tests, F.lit(True))


def known(docs: DataFrame, name: str) -> Column:
    if name not in docs.columns:
        raise ValueError(f"unknown field: {name}")
    return F.col(name)


def within(term: Column, text: str, distance: int, transpositions: bool = False) -> Column:
    """Edit distance test.

    Lengths are compared first, which spares most terms the distance itself.  With
    transpositions a swap of neighbours is one edit and no letter is edited twice (optimal
    string alignment); it is at least half the plain distance, so few terms need it.
    """
    near = F.length(term).between(len(text) - distance, len(text) + distance)
    plain = F.levenshtein(term, F.lit(text), 2 * distance if transpositions else distance) >= 0
    return near & plain & (alignment_distance(term, text) <= distance) if transpositions else near & plain


def alignment_distance(term: Column, text: str) -> Column:
    """Optimal string alignment distance of a column's words to one word.

    A fold over the letters of the term keeps the last two rows of the distance table.
    """
    if not text:
        return F.length(term)
    letters = F.array(*[F.lit(c) for c in text])
    width = len(text)

    def next_row(state: Column, letter: Column) -> Column:
        def cell(row: Column, j: Column) -> Column:
            same = F.get(letters, j - 1) == letter
            swapped = (j > 1) & (F.get(letters, j - 2) == letter) & (F.get(letters, j - 1) == state["letter"])
            best = F.least(
                F.get(row, j - 1) + 1,
                F.get(state["row"], j) + 1,
                F.get(state["row"], j - 1) + F.when(same, 0).otherwise(1),
                F.when(swapped, F.get(state["before"], j - 2) + 1),
            )
            return F.concat(row, F.array(best))

        row = F.aggregate(F.sequence(F.lit(1), F.lit(width)), F.array(F.get(state["row"], F.lit(0)) + 1), cell)
        return F.struct(row.alias("row"), state["row"].alias("before"), letter.alias("letter"))

    first = F.sequence(F.lit(0), F.lit(width))
    start = F.struct(first.alias("row"), first.alias("before"), F.lit("").alias("letter"))
    return F.aggregate(F.split(term, ""), start, next_row, lambda state: F.get(state["row"], F.lit(width)))


@dataclass
class _Plan:
    """Aggregates and predicates gathered while walking a query tree."""

    corpus: Corpus
    conditions: list[Column] = dataclass_field(default_factory=list)
    words: list[list[str] | None] = dataclass_field(default_factory=list)
    sought: list[tuple[TextQuery, Column]] = dataclass_field(default_factory=list)
    counted: dict[str, tuple[str, str]] = dataclass_field(default_factory=dict)
    aggregates: dict[str, Column] = dataclass_field(default_factory=dict)
    frequencies: dict[str, Column] = dataclass_field(default_factory=dict)
    predicates: dict[str, Column] = dataclass_field(default_factory=dict)
    leaves: dict[Query, tuple[Column, Column]] = dataclass_field(default_factory=dict)
    scored_fields: set[str] = dataclass_field(default_factory=set)
    scored: bool = True

    def leaf(self, query: Query) -> tuple[Column, Column]:
        if query not in self.leaves:
            number = f"c{len(self.leaves)}"
            if isinstance(query, ColumnQuery):
                self.predicates[number] = query.predicate(self.corpus.docs)
                found = F.col(number)
                self.leaves[query] = found, F.when(found, 1.0).otherwise(0.0)
            elif isinstance(query, TermSet):
                (condition,) = self._slots(query)
                self.aggregates[number] = F.max(F.when(condition, True))
                found = F.coalesce(F.col(number), F.lit(False))
                self.leaves[query] = found, F.when(found, 1.0).otherwise(0.0)
            else:
                tf, names = self._frequency(number, query)
                found = tf > 0
                score = F.lit(0.0)
                if self.scored:
                    score = F.when(found, self._bm25(query.field, tf, names)).otherwise(0.0)
                self.leaves[query] = found, score
        return self.leaves[query]

    def _slots(self, query: TextQuery) -> list[Column]:
        conditions = query.slots(self.corpus)
        if self.corpus.terms is not None:
            # tested on the dictionary; a posting carries the numbers of the tests its term passed
            first = len(self.sought)
            self.sought += [(query, c) for c in conditions]
            numbers = range(first, len(self.sought))
            conditions = [F.array_contains(F.col("passed"), F.lit(i)) for i in numbers]
            if query.words() is not None:
                conditions = query.slots(self.corpus)
        self.conditions.extend(conditions)
        self.words.append(query.words())
        return conditions

    def _frequency(self, number: str, query: TextQuery) -> tuple[Column, list[str]]:
        conditions = self._slots(query)
        if isinstance(query, Term):
            self.aggregates[number] = F.sum(F.when(conditions[0], F.col("tf")).otherwise(0))
            self._count(number, query.field, query.words()[0], F.count_if(F.col(number) > 0))
            tf, names = F.coalesce(F.col(number), F.lit(0)), [number]
        else:
            names = [f"{number}_{i}" for i in range(len(conditions))]
            starts = []
            for i, (name, condition) in enumerate(zip(names, conditions)):
                self.aggregates[name] = F.flatten(F.collect_list(F.when(condition, F.col("positions"))))
                known_word = query.words()[i] if query.words() else None
                self._count(name, query.field, known_word, F.count_if(F.size(name) > 0))
                starts.append(F.transform(F.col(name), functools.partial(_back, i)) if i else F.col(name))
            tf = F.coalesce(F.size(functools.reduce(F.array_intersect, starts)), F.lit(0))
        self.aggregates[f"dl_{query.field}"] = F.max(F.when(on(query.field), F.col("dl")))
        return tf, names

    def _count(self, number: str, field: str, word: str | None, seen: Column) -> None:
        """Where the document frequency of a slot comes from: the dictionary, or the postings."""
        if word is not None and self.corpus.terms is not None:
            self.counted[number] = field, word
        else:
            self.frequencies[number] = seen

    def _bm25(self, field: str, tf: Column, names: list[str]) -> Column:
        self.scored_fields.add(field)
        total, mean = F.col(f"coll_{field}")["n"], F.col(f"coll_{field}")["avgdl"]
        rarity = functools.reduce(operator.add, [idf(total, F.col("found")[n]) for n in names])
        return rarity * bm25_weight(tf, F.col(f"dl_{field}"), mean)

    def walk(self, query: Query) -> tuple[Column, Column, bool]:
        """(matches, score, can match a document none of whose terms matched)."""
        if isinstance(query, Boost):
            found, score, alone = self.walk(query.query)
            return found, score * F.lit(float(query.factor)), alone
        if not isinstance(query, Bool):
            return *self.leaf(query), isinstance(query, ColumnQuery)
        must = [self.walk(q) for q in query.must]
        should = [self.walk(q) for q in query.should]
        banned = [self.walk(q) for q in query.must_not]
        if not must and not should:
            return F.lit(False), F.lit(0.0), False
        needed = [m[0] for m in must] or [functools.reduce(operator.or_, [s[0] for s in should])]
        tests = needed + [~b[0] for b in banned]
        score = functools.reduce(
            operator.add, [F.when(found, score).otherwise(0.0) for found, score, _ in must + should]
        )
        alone = all(m[2] for m in must) if must else any(s[2] for s in should)
        return functools.reduce(operator.and_, tests), score, alone


def _back(by: int, position: Column) -> Column:
    return position - by


def match(corpus: Corpus, query: Query, scored: bool = True) -> DataFrame:
    """(key, score) of every document a query matches."""
    plan = _Plan(corpus, scored=scored)
    found, score, alone = plan.walk(query)
    rows = _rows(plan, alone)
    return rows.where(found).select("key", score.alias("score"))


def match_many(corpus: Corpus, queries: dict[str, Query], scored: bool = True) -> DataFrame:
    """(query_id, key, score) of several query objects, still one scan and one shuffle."""
    plan = _Plan(corpus, scored=scored)
    walked = {name: plan.walk(query) for name, query in queries.items()}
    rows = _rows(plan, any(alone for _, _, alone in walked.values()))
    results = F.array_compact(
        F.array(
            *[
                F.when(found, F.struct(F.lit(name).alias("query_id"), score.alias("score")))
                for name, (found, score, _) in walked.items()
            ]
        )
    )
    return rows.select("key", F.inline(results)).select("query_id", "key", "score")


def _rows(plan: _Plan, alone: bool) -> DataFrame:
    """One row per candidate document with what the clauses of the plan need."""
    corpus = plan.corpus
    docs = corpus.docs.select(
        F.col(corpus.key).alias("key"), *[p.alias(n) for n, p in plan.predicates.items()]
    )
    if not plan.aggregates:
        return docs
    occurrences = corpus.occurrences
    if corpus.buckets and all(w is not None for w in plan.words):
        words = sorted({w for some in plan.words for w in some})
        wanted = [F.pmod(F.xxhash64(F.lit(w)), F.lit(corpus.buckets)).cast("int") for w in words]
        occurrences = occurrences.where(F.col("bucket").isin(*wanted))
    elif plan.sought:
        occurrences = _found_postings(plan)
    grouped = (
        occurrences.where(functools.reduce(operator.or_, plan.conditions))
        .groupBy("key")
        .agg(*[a.alias(n) for n, a in plan.aggregates.items()])
    )
    rows = docs.join(grouped, "key", "left") if plan.predicates or alone else grouped
    if plan.scored and (plan.frequencies or plan.counted):
        parts = []
        if plan.frequencies:
            seen = grouped.agg(F.struct(*[c.alias(n) for n, c in plan.frequencies.items()]).alias("f"))
            parts += [seen.scalar()[n].alias(n) for n in plan.frequencies]
        if plan.counted:
            held = corpus.terms.where(
                functools.reduce(operator.or_, [on(f) & (F.col("term") == w) for f, w in set(plan.counted.values())])
            ).agg(
                F.struct(
                    *[
                        F.coalesce(F.max(F.when(on(f) & (F.col("term") == w), F.col("df"))), F.lit(0)).alias(n)
                        for n, (f, w) in plan.counted.items()
                    ]
                ).alias("f")
            )
            parts += [held.scalar()[n].alias(n) for n in plan.counted]
        counts = F.struct(*parts)
        stats = {f"coll_{name}": corpus.stats_row(name) for name in sorted(plan.scored_fields)}
        rows = rows.withColumns({"found": counts, **stats})
    return rows


MOST_BUCKETS = 1000


def _found_postings(plan: _Plan) -> DataFrame:
    """The postings of the terms that pass a test, with the numbers of the tests they pass.

    Tests run on distinct terms.  The found terms are written, so that Spark knows their size,
    and joined to the postings; their buckets, up to ``MOST_BUCKETS`` of them, prune the scan.
    """
    corpus, parts = plan.corpus, []
    for number, (query, test) in enumerate(plan.sought):
        rows = query.candidates(corpus).where(test)
        parts.append(rows.select("bucket", "field", "term", F.lit(number).alias("number")))
    found = stored(
        functools.reduce(DataFrame.unionByName, parts)
        .groupBy("bucket", "field", "term").agg(F.collect_set("number").alias("passed")),
        "found-terms",
    )
    buckets = [r.bucket for r in found.select("bucket").distinct().limit(MOST_BUCKETS + 1).collect()]
    postings = corpus.occurrences
    if len(buckets) <= MOST_BUCKETS:
        postings = postings.where(F.col("bucket").isin(*buckets))
    return postings.join(found, ["bucket", "field", "term"])


def column_filter(docs: DataFrame, query: Query) -> Column:
    """A tree of column queries as one predicate, which the scan can take over."""
    plan = _Plan(Corpus(docs, "", docs, docs), scored=False)
    found, _, _ = plan.walk(query)
    if plan.aggregates:
        raise ValueError("text clauses need match()")

    def test(node: Query) -> Column:
        if isinstance(node, ColumnQuery):
            return node.predicate(docs)
        if isinstance(node, Boost):
            return test(node.query)
        needed = [test(q) for q in node.must]
        if not needed:
            if not node.should:
                return F.lit(False)
            needed = [functools.reduce(operator.or_, [test(q) for q in node.should])]
        return functools.reduce(operator.and_, needed + [~test(q) for q in node.must_not])

    return test(query)


def first_non_empty(corpus: Corpus, tiers: dict[str, list[tuple[str, Query]]]) -> DataFrame:
    """(query_id, strategy, key, score): hits of the first strategy that finds anything.

    All strategies of all queries are matched in the same pass.
    """
    flat = {
        f"{name}\t{rank}\t{strategy}": query
        for name, steps in tiers.items()
        for rank, (strategy, query) in enumerate(steps)
    }
    parts = F.split("query_id", "\t")
    hits = match_many(corpus, flat).select(
        parts[0].alias("query_id"),
        parts[1].cast("int").alias("tier"),
        parts[2].alias("strategy"),
        "key",
        "score",
    )
    best = hits.groupBy("query_id").agg(F.min("tier").alias("tier"))
    return hits.join(best, ["query_id", "tier"]).select("query_id", "strategy", "key", "score")
