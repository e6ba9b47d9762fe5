"""Benchmark decontamination by templates.

Only DataFrame functions run here.  Numbers, their units and names become typed placeholders,
so a benchmark question with other numbers or names has the same template.  Two views are
matched, each for itself: one with names as placeholders, and one in lower case without names,
which a copy in another case has too.  Windows of template words are hash-joined; items that a
document covers for the most part are candidates.  The slots decide: wherever the item repeats
a value, the document must repeat the value that stands in its place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.llm.registry import query, set_aside, table
from lexigrid.session import stored

NAME, NUMBER, UNIT = "", "", ""
JOIN = "\ue003"  # between the words of a name
# Units of measurement, as written after a number.
UNITS = (
    "mm|cm|dm|m|km|mi|ft|in|yd|inch|inches|feet|miles|metres|meters|kilometres|kilometers|centimetres|centimeters|"
    "mg|g|kg|t|lb|lbs|oz|grams|kilograms|pounds|ounces|tons|ml|cl|l|litres|liters|gallons|s|sec|min|h|hr|hrs|"
    "seconds|minutes|hours|days|weeks|months|years|mph|km/h|m/s|hz|khz|mhz|ghz|w|kw|mw|v|a|j|kj|kcal|cal|"
    "°c|°f|percent|dollars|euros|cents|kb|mb|gb|tb"
)
# What a figure or a capitalised word begins with is looked for first: it is rarer and cheaper
# to test than what may not stand before it.
AT_FIGURE = r"(?=[-+$€£\p{Nd}])(?<![\p{L}\p{N}])"
AT_NAME = r"(?=\p{Lu})(?<![\p{L}\p{N}'’-])"
FIGURE = r"[-+]?[$€£]?\p{Nd}[\p{Nd}.,:/]*%?"
CAPITALISED = r"\p{Lu}['’]?\p{L}?\p{Ll}[\p{L}'’-]*"
SPACES = r"[\x20\x09-\x0D]+"


MARKS = 26  # 2 ** MARKS bits tell texts apart that need not be fetched
DRIFT = 16  # words that a copy may have more or fewer than the item, to be judged as one


@dataclass(frozen=True)
class Settings:
    """``width``: words in a window.  ``coverage``: the share of an item's windows that a
    document must hold.  ``conflicts``: the share of its slots that may break consistency.
    An item of fewer than ``fewest`` words is too short to tell a leak and matches nothing.
    """

    width: int = 8
    fewest: int = 5
    coverage: float = 0.5
    conflicts: float = 0.2


def folded(text: Column, named: bool) -> Column:
    """The text; in the view with names, a run of capitalised words is one word."""
    if not named:
        return text
    return F.regexp_replace(text, rf"{AT_NAME}({CAPITALISED}){SPACES}(?={CAPITALISED})", f"$1{JOIN}")


def template(text: Column, named: bool) -> Column:
    """The words of a text as an array: lower case, no punctuation, values as placeholders.

    A name is a run of capitalised words, which may begin a sentence; words in capitals alone
    are not names.
    """
    figured = F.regexp_replace(folded(text, named), rf"{AT_FIGURE}{FIGURE}", NUMBER)
    # most texts have no figure, which is seen without a regular expression; a lambda's argument
    # is worked out once
    united = F.transform(
        F.array(figured),
        lambda t: F.when(
            F.contains(t, F.lit(NUMBER)),
            F.regexp_replace(t, rf"(?i){NUMBER}(\s?)(?:{UNITS})(?![\p{{L}}\p{{N}}])", f"{NUMBER}$1{UNIT}"),
        ).otherwise(t),
    )
    counted = F.get(united, F.lit(0))
    if named:
        counted = F.regexp_replace(
            # possessive: Java matches it in a loop, a greedy one takes a stack frame for each word
            counted, rf"{AT_NAME}{CAPITALISED}(?:{JOIN}{CAPITALISED})*+", NAME
        )
    plain = F.regexp_replace(F.lower(counted), rf"[^\p{{L}}\p{{N}}{NAME}-{UNIT}\s]+", "")
    return F.filter(F.split(plain, SPACES), lambda w: w != "")


def raw_words(text: Column, named: bool) -> Column:
    """Words of the text itself, at the places of their template words."""
    return F.filter(F.split(folded(text, named), SPACES), lambda w: w.rlike(rf"[\p{{L}}\p{{N}}{NAME}-{UNIT}]"))


def views(rows: DataFrame, columns: list[str], of) -> DataFrame:
    """``columns`` and the fields ``of(named)`` of each row, once for each view.

    Both views come out of one generator: conditions on them stay above it, so that no text
    is templated again for a condition, and the rows are read once.
    """
    both = F.array(*(F.struct(F.lit(named).alias("named"), *of(named)) for named in (True, False)))
    return rows.select(*columns, F.explode(both).alias("view_")).select(*columns, "view_.*")


def with_windows(worded: DataFrame, columns: list[str], pos: str, widths: list[int]) -> DataFrame:
    """(columns, ``pos``, width, window) of each run of ``width`` words of each row: its hash, for
    every one of the widths.

    A row of words is one row a word first, whose run is hashed from the array beside it, all in
    compiled code; a function of an array's elements is interpreted.  Fewer words than the width
    have no run.
    """
    placed = worded.select(*columns, "words", F.size("words").alias("n_words"), F.posexplode("words").alias(pos, "word_"))
    of = [
        F.struct(F.lit(w).alias("width"), F.xxhash64(
            *(F.get("words", F.col(pos) + k) for k in range(w)), F.col("named"), F.lit(w)).alias("window"))
        for w in widths
    ]
    if len(of) == 1:
        fitting = placed.where(F.col(pos) + widths[0] <= F.col("n_words")).withColumn("run_", of[0])
    else:
        fitting = placed.withColumn("run_", F.explode(F.array(*of))).where(F.col(pos) + F.col("run_.width") <= F.col("n_words"))
    return fitting.select(*columns, pos, "run_.*")


def item_windows(items: DataFrame, settings: Settings) -> DataFrame:
    """(item_id, named, width, n_windows, ipos, window) of every item that is long enough.  An
    item shorter than a window is one window of its own length; repeated item ids are one item.
    Windows that are placeholders for more than three quarters tell nothing of names."""
    worded = views(items, ["item_id"], lambda named: [template(F.col("text"), named).alias("words")]).where(
        F.size("words") >= settings.fewest
    )
    literal = worded.select("*", F.transform("words", lambda w: (~w.rlike(f"[{NAME}-{UNIT}]")).cast("int")).alias("literal"))
    widths = list(range(min(settings.fewest, settings.width), settings.width + 1))
    hashed = with_windows(literal, ["item_id", "named", "literal"], "ipos", widths).where(
        F.col("width") == F.least(F.size("literal"), F.lit(settings.width))
    )
    sliced = hashed.where(
        ~F.col("named")
        | (4 * F.aggregate(F.slice("literal", F.col("ipos") + 1, F.col("width")), F.lit(0), lambda a, x: a + x) >= F.col("width"))
    )
    distinct = sliced.groupBy("item_id", "named", "width", "window").agg(F.min("ipos").alias("ipos"))
    counts = distinct.groupBy("item_id", "named").agg(F.count("*").alias("n_windows"))
    return distinct.join(counts, ["item_id", "named"])


def alignments(shift: Column) -> Column:
    """Names of the ways to align a document and an item that a match of two windows is in.

    The places themselves, so that a copy word for word stands alone; places within ``DRIFT``
    words, for copies with words put in or left out, by two rows of bins that overlap by half;
    and all places of the document together.
    """
    half = DRIFT // 2
    near = [
        F.concat(F.lit(f"{k}:"), F.floor((shift + k * half) / DRIFT).cast("string")) for k in range(2)
    ]
    return F.array(F.lit("all"), F.concat(F.lit("at:"), shift.cast("string")), *near)


def marked(rows: DataFrame, hashes: DataFrame, name: str, how: str) -> DataFrame:
    """``rows`` with ``maybe_``, true where the hash ``name`` is in ``hashes`` and for few others;
    not true or, if ``how`` is inner, no row elsewhere.  A bitmap of 2**``MARKS`` bits (8 MB) is all
    that is broadcast."""
    bits = F.lit(1 << 15)  # of a piece: Spark's bitmaps have 4 KB
    mark = F.pmod(F.col(name), F.lit(1 << MARKS))
    pieces = hashes.select(F.floor(mark / bits).alias("piece_"), F.pmod(mark, bits).alias("bit_")).groupBy("piece_").agg(
        F.bitmap_construct_agg("bit_").alias("marks_")
    )
    bit = F.pmod(mark, bits).cast("int")
    byte = F.conv(F.hex(F.substring("marks_", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    kept = [F.col(c) for c in rows.columns]
    return rows.join(F.broadcast(pieces), F.floor(mark / bits) == F.col("piece_"), how).select(
        *kept, F.coalesce(F.getbit(byte, F.pmod(bit, F.lit(8))) == 1, F.lit(False)).alias("maybe_")
    )


def maybe_in(rows: DataFrame, hashes: DataFrame, name: str) -> DataFrame:
    """``rows`` whose hash ``name`` is in ``hashes``, and few others, so that a join behind it does
    not shuffle the rest."""
    return marked(rows, hashes, name, "inner").where("maybe_").drop("maybe_")


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """(key, text_hash, item_id, n_windows, n_hits, n_slots, n_changed) of each leaked item.

    ``n_changed`` counts slots whose value differs from the item's: over nought, the question
    was re-parameterised.  Null or empty texts and items match nothing; items with a null id
    count as one; documents equal in key and text give one row an item; other columns are
    ignored; no items or no documents give no rows.
    """
    windows = stored(item_windows(items, settings), "item-windows")
    widths = sorted(r.width for r in windows.select("width").distinct().collect())  # at most ``width`` values
    if not widths:
        widths = [settings.width]
    worded = views(
        docs.select(key, text, F.xxhash64(F.col(text)).alias("text_hash")), [key, "text_hash"],
        lambda named: [template(F.col(text), named).alias("words")],
    ).where(F.size("words") >= settings.fewest)
    spans = with_windows(worded, [key, "text_hash", "named"], "dpos", widths).select(
        key, "text_hash", "named", "dpos", "window"
    )
    group = [key, "text_hash", "item_id", "named", "line"]
    matched = (
        spans.join(windows, ["window", "named"])
        .withColumn("line", F.explode(alignments(F.col("dpos") - F.col("ipos"))))
        .groupBy(*group, "width", "n_windows", "ipos").agg(F.min("dpos").alias("dpos"))
    )
    candidates = stored(
        matched.groupBy(*group, "width", "n_windows")
        .agg(F.count("*").alias("n_hits"), F.collect_list(F.struct("ipos", "dpos")).alias("places"))
        .where(F.col("n_hits") >= F.col("n_windows") * settings.coverage),
        "leak-candidates",
    )
    # one row for each slot of an item that lies in a matched window, with both values
    questions = views(
        items.dropDuplicates(["item_id"]), ["item_id"],
        lambda named: [raw_words(F.col("text"), named).alias("asked"), template(F.col("text"), named).alias("pattern")],
    )
    slot = f"{NAME}|{NUMBER}|{UNIT}"
    place = F.transform(
        F.col("places"),
        lambda p: F.transform(
            F.sequence(F.lit(0), F.col("width") - 1),
            lambda k: F.struct((p["ipos"] + k).alias("i"), (p["dpos"] + k).alias("d")),
        ),
    )
    aligned = F.filter(
        F.array_distinct(F.flatten(place)), lambda p: F.get("pattern", p["i"]).rlike(slot)
    )
    slots = stored(
        candidates.withColumnRenamed("item_id", "item_").join(
            questions.where(F.exists("pattern", lambda w: w.rlike(slot))),
            F.col("item_").eqNullSafe(F.col("item_id")) & (candidates["named"] == questions["named"]),
        )
        .select(key, "text_hash", "item_id", candidates["named"], "line", "asked", F.explode(aligned).alias("slot"))
        .select(*group, F.col("slot.d").alias("d"), bare(F.get("asked", F.col("slot.i"))).alias("a"), F.col("slot.i").alias("i")),
        "leak-slots",
    )
    # each text is split once a view, however many slots it has
    wanted = slots.groupBy("text_hash", "named").agg(F.collect_set("d").alias("places"))
    hashes = slots.select("text_hash").distinct()
    texts = (
        maybe_in(docs.select(F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text_")), hashes, "text_hash")
        .join(hashes, "text_hash").dropDuplicates(["text_hash"])
    )
    said = (
        texts.join(wanted, "text_hash")
        .select("text_hash", "named", "places", F.when(F.col("named"), raw_words(F.col("text_"), True)).otherwise(
            raw_words(F.col("text_"), False)).alias("said"))
        .select("text_hash", "named", "said", F.explode("places").alias("d"))
        .select("text_hash", "named", "d", bare(F.get("said", F.col("d"))).alias("b"))
    )
    values = slots.join(said, ["text_hash", "named", "d"])
    by_value = values.groupBy(*group, "a").agg(
        F.count("*").alias("n"),
        F.count_distinct("b").alias("n_values"),
        F.sum((~F.col("a").eqNullSafe(F.col("b"))).cast("long")).alias("changed"),
    )
    judged = by_value.groupBy(*(F.col(c).alias(f"{c}_") for c in group)).agg(
        F.sum("n").alias("n_slots"), F.sum(F.col("n_values") - 1).alias("broken"), F.sum("changed").alias("n_changed")
    )
    on = F.lit(True)
    for c in group:
        on &= F.col(c).eqNullSafe(F.col(f"{c}_"))
    passed = candidates.join(judged, on, "left").where(
        F.coalesce(F.col("broken") <= F.col("n_slots") * settings.conflicts, F.lit(True))
    )
    # of several ways in which an item leaks, the one that covers most of it
    best = F.max(
        F.struct(
            (F.col("n_hits") / F.col("n_windows")).alias("share"), (-F.coalesce("n_changed", F.lit(0))).alias("kept"),
            "n_windows", "n_hits", F.coalesce("n_slots", F.lit(0)).alias("n_slots"),
            F.coalesce("n_changed", F.lit(0)).alias("n_changed"),
        )
    )
    return (
        passed.groupBy(key, "text_hash", "item_id").agg(best.alias("best"))
        .select(key, "text_hash", "item_id", "best.n_windows", "best.n_hits", "best.n_slots", "best.n_changed")
    )


def bare(word: Column) -> Column:
    """A value without case and punctuation, so that ``5,`` and ``5`` are one."""
    return F.regexp_replace(F.lower(word), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}%]+$", "")


def decontaminate(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """``docs`` without those that hold a leaked item; all columns stay, whatever their
    names (``set_aside``).  A null text holds no item and its rows stay, null keys too; rows equal
    in key and text go together; very long texts are read whole; an empty table stays empty."""
    return set_aside(docs, (key, text), lambda d: _decontaminate(d, items, key, text, settings))


def _decontaminate(
    docs: DataFrame, items: DataFrame, key: str, text: str, settings: Settings
) -> DataFrame:
    leaks = find_leaks(docs, items, key, text, settings).select(
        F.col(key).alias("key_"), F.col("text_hash").alias("hash_")
    ).distinct()
    on = F.col(key).eqNullSafe(F.col("key_")) & (F.xxhash64(F.col(text)) == F.col("hash_"))
    return docs.join(leaks, on, "left_anti")


@query("op1_template_decontamination")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_leaks(docs, table(spark, sf_dir, "benchmark")).drop("text_hash")
