"""URL filters by a sorted digest array.

Rules are a file of sorted 64-bit xxhash keys with their strings.  Every worker maps the file
into memory, looks up all host suffixes and path beginnings of a batch of URLs by one
vectorised binary search, and compares the stored strings of the keys that it finds, so that
equal keys of different strings do no harm.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.llm.registry import query, table

# The rules that a verdict names.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Host words of advertising, gambling, pill, adult and link-farm sites.
WORDS = ("ads", "adult", "bet", "bets", "casino", "farm", "pills", "poker", "porn", "spam", "viagra", "xxx")
SEGMENT = 1 << 28  # bytes of a file; more rules are several files
KINDS = {"allow": 0, "block": 1, "word": 2}
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty without ``://``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise("")
    host = F.regexp_substr(rest, F.lit("^[^/?#]+"))
    tail = F.substr(rest, F.length(F.coalesce(host, F.lit(""))) + 1)
    path = F.regexp_substr(tail, F.lit("^[^?#]+"))
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit("")), F.coalesce(path, F.lit(""))


def canonical(rule: str) -> str:
    """A rule with its host in lower case; the path begins at the first slash."""
    host, slash, path = rule.partition("/")
    return host.translate(LOWER) + slash + path


class DigestArray:
    """A file: counts, the distinct lengths of rule paths, keys, kinds, string ends, strings."""

    @staticmethod
    def write(path: str, rules: Iterable[tuple[str, str]], digest=xxhash.xxh64_intdigest) -> None:
        """Of repeated rules ``block`` stays.  A rule without a host fits nothing and is left out."""
        best: dict[bytes, int] = {}
        for text, verdict in rules:
            if text is None or verdict not in KINDS:
                continue
            if verdict != "word":
                text = canonical(text)
            if text.partition("/")[0]:
                name = ("\0" * (verdict == "word") + text).encode()
                best[name] = max(best.get(name, 0), KINDS[verdict])
        names = list(best)
        keys = np.array([digest(x) for x in names], "<u8")
        order = np.argsort(keys, kind="stable")
        names = [names[k] for k in order]
        lengths = {len(x.partition(b"/")[1] + x.partition(b"/")[2]) for x in names if x[:1] != b"\0"}
        with open(path, "wb") as out:
            out.write(np.array([len(names), len(lengths)], "<i8").tobytes())
            out.write(np.array(sorted(lengths), "<i8").tobytes())
            out.write(keys[order].tobytes())
            out.write(np.cumsum([len(x) for x in names], dtype="<i8").tobytes())
            out.write(np.array([best[x] for x in names], np.uint8).tobytes())
            out.write(b"".join(names))

    def __init__(self, path: str, digest=xxhash.xxh64_intdigest):
        self.digest, at = digest, 16
        self.file = np.memmap(path, np.uint8, "r")
        n, lengths = self.file[:16].view("<i8").tolist()

        def part(dtype: str, count: int) -> np.ndarray:
            nonlocal at
            out = self.file[at : at + count * np.dtype(dtype).itemsize].view(dtype)
            at += out.nbytes
            return out

        self.lengths = part("<i8", lengths).tolist()
        self.keys, self.ends, self.kinds = part("<u8", n), part("<i8", n), part("u1", n)
        self.names = self.file[at:]

    def name(self, k: int) -> bytes:
        return self.names[(self.ends[k - 1] if k else 0) : self.ends[k]].tobytes()

    def find(self, probes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(place of the probe, number of its rule) of the probes that are rules."""
        keys = np.fromiter(map(self.digest, probes), "<u8", len(probes))
        low = np.searchsorted(self.keys, keys)
        high = np.searchsorted(self.keys, keys, side="right")
        places, numbers = [], []
        for p in np.flatnonzero(high > low).tolist():
            for k in range(int(low[p]), int(high[p])):
                if self.name(k) == probes[p]:
                    places.append(p)
                    numbers.append(k)
        return np.array(places, np.int64), np.array(numbers, np.int64)

    def judge(self, hosts: list[str], paths: list[str]) -> tuple[list[str | None], list[str | None], list[bool]]:
        """The longest rule that fits each URL, its verdict, and whether a host word is listed.

        A rule fits its host and all subdomains if the path begins with the rule's path.  Of
        rules equally long the one with the longer host counts.
        """
        probes: list[bytes] = []
        numbers: dict[bytes, int] = {}
        of_host: dict[str, tuple[list[bytes], list[int]]] = {}

        def number(probe: bytes) -> int:
            k = numbers.setdefault(probe, len(probes))
            if k == len(probes):
                probes.append(probe)
            return k

        asked: list[tuple[list[int], list[int]]] = []
        for host, path in zip(hosts, paths):
            if host not in of_host:
                labels = host.split(".")
                suffixes = [".".join(labels[i:]).encode() for i in range(len(labels))] if host else []
                words = [number(b"\0" + w.encode()) for label in labels for w in label.split("-") if w]
                of_host[host] = [s for s in suffixes if s], words
            suffixes, words = of_host[host]
            raw = path.encode()
            starts = [raw[:m] for m in self.lengths if m <= len(raw)]
            asked.append(([number(s + p) for s in suffixes for p in starts], words))
        places, found = self.find(probes)
        rule_of = dict(zip(places.tolist(), found.tolist()))
        rules, verdicts, listed = [], [], []
        for tried, words in asked:
            hits = [p for p in tried if p in rule_of]
            best = max(hits, key=lambda p: (len(probes[p]), probes[p].find(b"/") % (1 << 32)), default=None)
            rules.append(None if best is None else probes[best].decode("utf-8", "replace"))
            verdicts.append(None if best is None else "block" if self.kinds[rule_of[best]] else "allow")
            listed.append(any(p in rule_of for p in words))
        return rules, verdicts, listed


def shared_arrays(spark: SparkSession, rules: DataFrame, segment: int = SEGMENT) -> list[str]:
    """Names of the files of all rules, sent to every executor.

    A file has about ``segment`` bytes at most, whatever the number of rules: rules are dealt
    by a hash of their strings, and the driver holds those of one file at a time.
    """
    rule = F.coalesce(F.col("rule"), F.lit(""))
    size = rules.agg(F.sum(F.octet_length(rule) + 32)).first()[0] or 0
    files, names = -(-size // segment) or 1, []
    for k in range(files):
        part = rules.where(F.pmod(F.xxhash64(rule), F.lit(files)) == k).select("rule", "verdict")
        name = f"url-rules-{uuid.uuid4().hex}.bin"
        path = os.path.join(tempfile.mkdtemp(prefix="lexigrid-rules-"), name)
        DigestArray.write(path, ((r.rule, r.verdict) for r in part.toLocalIterator()))
        spark.sparkContext.addFile(path)
        names.append(name)
    return names


_open: dict[str, DigestArray] = {}


def mapped(name: str) -> DigestArray:
    """The array of a file, mapped once a worker."""
    if name not in _open:
        _open[name] = DigestArray(SparkFiles.get(name))
    return _open[name]


def judge_urls(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", segment: int = SEGMENT
) -> DataFrame:
    """(key, host, path, rule, verdict, listed) of every row.

    ``rules`` (rule, verdict): verdict ``allow`` or ``block`` of a ``host/path`` rule, or
    ``word`` for a host word, a part of a host between dots or hyphens.  Without a rule a URL
    is blocked if its host has a listed word, else allowed.  A null URL or one without ``://``
    has an empty host and path and is allowed.  A rule may be null or repeated; ``block`` wins.
    Rows are judged each for itself, very long URLs whole; the key may be null; other columns
    are ignored; no rules allow all, and an empty table gives no rows.
    """
    names = shared_arrays(pages.sparkSession, rules, segment)
    kept = pa.schema([("key", pa.int64()), ("host", pa.string()), ("path", pa.string())]
                     + [("rule", pa.string()), ("verdict", pa.string()), ("listed", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            rule, verdict, listed = [None] * len(hosts), [None] * len(hosts), [False] * len(hosts)
            for name in names:
                for k, (r, v, w) in enumerate(zip(*mapped(name).judge(hosts, paths))):
                    longer = r is not None and (rule[k] is None or rank(r) > rank(rule[k]))
                    if longer:
                        rule[k], verdict[k] = r, v
                    listed[k] |= w
            verdict = [v or ("block" if w else "allow") for v, w in zip(verdict, listed)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(rule, pa.string()), pa.array(verdict), pa.array(listed)], schema=kept
            )

    def rank(r: str) -> tuple[int, int]:
        raw = r.encode()
        return len(raw), raw.find(b"/") % (1 << 32)

    host, path = url_parts(F.col(url).cast("string"))
    return (
        pages.select(F.col(key).cast("long").alias("key"), host.alias("host"), path.alias("path"))
        .mapInArrow(run, "key long, host string, path string, rule string, verdict string, listed boolean")
        .withColumnRenamed("key", key)
    )


SQL = rf"""
WITH rest AS (
    SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS s FROM pages),
parts AS (
    SELECT page_id, regexp_extract(s, '^[^/?#]+') AS raw, regexp_extract(s, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
hosts AS (SELECT page_id, translate(raw, '{UPPER}', '{UPPER.lower()}') AS host, path FROM parts),
ruled AS (
    SELECT page_id, host, path, (
        SELECT max_by(rule, length(rule)) FROM (VALUES
            ('net/', 'net', '/'), ('example.net/en/', 'example.net', '/en/'),
            ('example.com/de/', 'example.com', '/de/'), ('org/fr/', 'org', '/fr/')) AS r (rule, h, p)
        WHERE (host = h OR suffix(host, '.' || h)) AND prefix(path, p)) AS rule,
        len(list_intersect(regexp_split_to_array(host, '[.-]'), {list(WORDS)!r})) > 0 AS listed
    FROM hosts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') OR (rule IS NULL AND listed) THEN 'block' ELSE 'allow' END AS verdict,
       listed
FROM ruled
"""


@query("op12_url_rules", SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([*RULES, *((w, "word") for w in WORDS)], "rule string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)
