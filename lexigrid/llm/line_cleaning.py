"""Line-first cleaning: rules on each line, then on what is left of the document.

Punctuation, navigation and boilerplate rules judge lines.  Failing lines go; a document that
loses too much of its text, or whose words repeat too much, is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lexigrid.llm.registry import query, table
from lexigrid.llm.textbatch import Words, slices, text_bytes, windows

# Marks that end a sentence, marks that separate menu entries, and phrases of
# licences, notices and page furniture.
ENDINGS = tuple(".!?:;…。！？\"'”’»)]")
MENU_MARKS = ("|", "»", "›", " > ", "•", "·")
BOILERPLATE = (
    r"all rights reserved|licensed under|released under the|is licensed under|spdx-license-identifier|"
    r"creative commons|copyright \(c\)|copyright ©|©|privacy policy|terms of (?:use|service)|cookie policy|"
    r"we use cookies|accept (?:all )?cookies|javascript is (?:disabled|required)|enable javascript|lorem ipsum|"
    r"click here|read more|sign (?:in|up)|log ?in|subscribe|share this|powered by"
)


@dataclass(frozen=True)
class Rules:
    """``short_words``: a line of up to so many words needs an end mark unless it is the last.
    ``menu_share``: separators per word that make a line navigation.  ``symbol_share``: symbols
    per word that make it noise.  ``notice_words``: a notice is a line of up to so many words.
    ``most_lost``: percent of a document's word characters that its failing lines may hold.
    """

    short_words: int = 2
    menu_share: float = 0.34
    symbol_share: float = 0.5
    caps_share: float = 0.9
    notice_words: int = 25
    most_lost: int = 50


SYMBOLS = re.compile(r"[#*$%&|<>]")
NOTICE = re.compile(BOILERPLATE, re.IGNORECASE)
SPACES = re.compile("[\\x20\\x09-\\x0d]+")


def line_fault(line: str, last: bool, rules: Rules = Rules()) -> str | None:
    """The rule that a line with words fails, or none.  Lines without words never fail."""
    words = line.split()
    n = len(words)
    if n == 0:
        return None
    marks = sum(line.count(m) for m in MENU_MARKS)
    if marks and marks >= rules.menu_share * n:
        return "navigation"
    if n <= rules.notice_words and NOTICE.search(line):
        return "boilerplate"
    symbols = len(SYMBOLS.findall(line))
    if symbols and symbols >= rules.symbol_share * n:
        return "punctuation"
    if n >= 5 and 2 * line.count("!") >= n and line.upper() == line:
        return "punctuation"
    if n <= rules.short_words and not last and not line.rstrip().endswith(ENDINGS):
        return "navigation"
    return None


def repeat_words(words: np.ndarray, width: int = 8) -> int:
    """Words inside windows of ``width`` words that the text holds twice or more."""
    n = len(words)
    if n < width + 1:
        return 0
    w = windows(words, width)
    ordered = np.sort(w)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(w, twice))
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + width, -1)
    return int((np.cumsum(cover[:n]) > 0).sum())


def judge(text: str, words: np.ndarray, rules: Rules = Rules()) -> dict:
    """Counts, cleaned text and verdict of one document; ``words`` are hashes of its words."""
    n = len(words)
    lines = text.split("\n")
    seen, dup_lines, kept_lines, lost = set(), 0, [], 0
    faults = {"navigation": 0, "boilerplate": 0, "punctuation": 0}
    with_words = [k for k, line in enumerate(lines) if line.strip(" \t\n\r\x0b\x0c")]
    last = with_words[-1] if with_words else -1
    all_chars = 0
    for k, line in enumerate(lines):
        chars = len(SPACES.sub("", line))
        all_chars += chars
        if chars:
            if line in seen:
                dup_lines += 1
            seen.add(line)
        fault = line_fault(line, k == last, rules) if chars else None
        if fault:
            faults[fault] += 1
            lost += chars
        else:
            kept_lines.append(line)
    repeated = repeat_words(words)
    base_failed = n < 20 or 100 * repeated > 30 * n
    return {
        "n_words": n,
        "word_chars": all_chars,
        "n_symbols": len(SYMBOLS.findall(text)),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeated,
        "base_failed": base_failed,
        "kept": not base_failed and 100 * lost <= rules.most_lost * all_chars,
        "lost_chars": lost,
        "n_navigation": faults["navigation"],
        "n_boilerplate": faults["boilerplate"],
        "n_punctuation": faults["punctuation"],
        "text": "\n".join(kept_lines),
    }


COUNTS = "n_words word_chars n_symbols n_dup_lines n_repeat_words lost_chars n_navigation n_boilerplate n_punctuation"


def clean_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """Per row: key, counts, base_failed, kept and ``text`` without its failing lines.

    A null or empty text has no words and fails the base rules.  Repeated rows are judged each
    for itself; other columns are ignored; an empty table gives no rows.  The faults of a line
    are judged in the order navigation, boilerplate, punctuation, and the first one counts.
    """
    schema = pa.schema(
        [("key", pa.int64())]
        + [(c, pa.int64()) for c in COUNTS.split()]
        + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("text", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in slices(offsets):
                words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lower=False)
                texts = batch.column(1).slice(a, b - a).to_pylist()
                rows = [
                    judge(t or "", words.hashes[words.first[k] : words.first[k + 1]], rules)
                    for k, t in enumerate(texts)
                ]
                columns = [batch.column(0).slice(a, b - a)] + [
                    pa.array([r[f.name] for r in rows], f.type) for f in list(schema)[1:]
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    counts = ", ".join(f"{c} long" for c in COUNTS.split())
    return (
        docs.selectExpr(f"cast(`{key}` as long) as key", f"`{text}` as text")
        .mapInArrow(run, f"key long, {counts}, base_failed boolean, kept boolean, text string")
        .withColumnRenamed("key", key)
    )


@query("op7_line_cleaning")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "lost_chars", "n_navigation", "n_boilerplate", "n_punctuation",
    )
