"""Phrase mining, URL rules and hard negatives against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexigrid.llm import hard_negatives as hn
from lexigrid.llm import phrase_mining as pm
from lexigrid.llm import url_rules as ur

DOCS = "doc_id long, text string, lang string, phrase string, score long, n string"


def brute_phrases(rows, most=3, support=10, top=2000, covered=50):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, most + 1):
                for i in range(len(words) - m + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        chosen = {p: a for p, a in f.items() if a >= support and len(p) > 1}
        rows_ = []
        for p, a in chosen.items():
            if any(
                100 * b >= covered * a
                for q, b in chosen.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
            ):
                continue
            s, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows_.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -s))
    return sorted(out)


def mined(spark, rows, **options):
    docs = spark.createDataFrame([(k, t, g, "x", 7, None) for k, (t, g) in enumerate(rows)], DOCS)
    return sorted(tuple(r) for r in pm.collocations(docs, **options).collect())


def random_texts(seed, n, words=40):
    draw = random.Random(seed)
    names = [f"w{k}" for k in range(words)] + ["Eñe", "日本", "A", "a"]
    weights = [1 / (k + 1) for k in range(len(names))]
    marks = [" "] * 12 + ["\t", "  ", ". ", ",", "\n", "\r\n", "\x0b", "! ", "\u00a0", "\u2028"]
    return [
        ("".join(draw.choices(names, weights)[0] + draw.choice(marks) for _ in range(draw.randint(0, 60))), draw.choice(["en", "de", None, "und"]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("most, support, top", [(3, 10, 2000), (4, 6, 9), (2, 3, 50)])
def test_phrases_against_brute_force(spark, most, support, top):
    rows = random_texts(most, 200) + [(None, "en"), ("", None), (" \t.\n", "fr"), ("solo", "fr")]
    rows += [("the same text, of very many copies", "en")] * 40
    got = mined(spark, rows, most=most, support=support, top=top)
    assert got == brute_phrases(rows, most, support, top) and got


def test_very_long_texts_are_cut_at_breaks_only(spark, monkeypatch):
    rows = [(" ".join(t for t, _ in random_texts(9, 300)), "en"), ("a b c " * 500, "en"), ("x y. " * 400, None)]
    monkeypatch.setattr(pm, "SLICE", 700)
    monkeypatch.setattr(pm.cuts, "__defaults__", (700,))
    data = np.frombuffer(rows[0][0].encode(), np.uint8)
    parts = list(pm.cuts(data, np.array([0, len(data)]), 700))
    assert len(parts) > 10 and all(pm.BREAK[data[high - 1]] for *_, high in parts[:-1])
    joined = []
    for *_, low, high in parts:
        words = pm.PieceWords(data[low:high], np.array([0, high - low]))
        joined += words.phrases(np.arange(len(words.hashes)), 1).to_pylist()
    whole = pm.PieceWords(data, np.array([0, len(data)]))
    assert joined == whole.phrases(np.arange(len(whole.hashes)), 1).to_pylist()
    assert mined(spark, rows) == brute_phrases(rows)


def test_phrases_of_an_empty_table(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(None, None)] * 3) == []


def test_scores_pass_64_bits(spark):
    a, l, r = 3_000_000_019, 4_000_000_007, 5_000_000_029
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    score = df.selectExpr("(1000000BD * cast(a as decimal(16,0)) * a) div (cast(l as decimal(19,0)) * r) as s").first().s
    assert score == 1000000 * a * a // (l * r)


def test_phrases_of_rows_that_move_between_tasks(spark, monkeypatch):
    class Moving:
        """A task number that no two calls share."""

        def partitionId(self):
            return random.SystemRandom().randrange(1 << 20)

    class Context:
        get = staticmethod(Moving)

    monkeypatch.setattr(pm, "TaskContext", Context)
    rows = random_texts(5, 150)
    assert mined(spark, rows) == brute_phrases(rows)


def test_planes_round_trip():
    keys = np.sort(np.random.default_rng(0).integers(0, 2**48, 1000, dtype=np.uint64))
    assert (pm.from_planes(pm.to_planes(keys, 6), 6) == keys).all()
    assert len(pm.from_planes(pm.to_planes(keys[:0], 8), 8)) == 0


def test_lowered_supports_leave_no_gap(spark):
    rows = spark.createDataFrame([("en", 0, 70), ("en", 1, 25), ("en", 2, 5), ("de", 1, 9)], "lang string, shard int, n long")
    least = pm.supports(rows, 10)
    bucket = {r.lang: r.h for r in rows.selectExpr("lang", "xxhash64(lang) & 63 as h").distinct().collect()}
    assert [least[4 * bucket["en"] + s] for s in range(3)] == [7, 3, 1]
    assert least[4 * bucket["de"] + 1] == 10


PAGES = "page_id long, url string, rule string, host string, listed string"


def brute_rules(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url[url.index("://") + 3 :]
        raw = re.match("[^/?#]*", rest).group()
        path = re.match("[^?#]*", rest[len(raw) :]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
    fits = []
    for rule, verdict in rules:
        if rule is None or verdict == "word":
            continue
        h, slash, p = rule.partition("/")
        h = "".join(c.lower() if "A" <= c <= "Z" else c for c in h)
        if h and (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            fits.append((len((h + slash + p).encode()), len(h.encode()), h + slash + p, verdict == "block"))
    words = {r for r, v in rules if v == "word"}
    listed = any(w in words for label in host.split(".") for w in label.split("-"))
    if fits:
        best = max(fits)
        return host, path, best[2], "block" if best[3] else "allow", listed
    return host, path, None, "block" if listed else "allow", listed


URLS = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "https://NET/x", "http://a.net?q=/", "http://a.net#/",
    "http://example.net/en/1", "http://www.example.net/en/1", "http://badexample.net/en/1", "http://example.net/EN/1",
    "ftp://example.com/de/", "http://x.example.com/de", "http://x.org/fr/ü?x#y", "http://x.org/fr/#", "a://b://c.net/x",
    "http://casino-win.example.com/en/", "http://free-bets.net/", "http://ads.org/fr/x", "http://u@h.net:80/x", "http://.net/",
    "http://a..net/x", "http://ÄÖ.org/fr/", "http://deep.a.b.c.d.e.net/" + "p/" * 20_000, "http://x.net/a\nb?c", "://y.net/",
]
MORE = [("net", "allow"), ("a.net/x", "allow"), ("Example.NET/en/", "block"), (None, "block"), ("/only/path", "block"),
        ("b.c.d.e.net/p/p/", "allow"), ("net/a\nb", "allow"), ("", "block"), ("x.org/fr/ü", "block"), ("odd", "nothing")]


@pytest.mark.parametrize("extra, segment", [([], ur.SEGMENT), (MORE, ur.SEGMENT), (MORE, 200)])
def test_urls_against_brute_force(spark, extra, segment):
    rules = [*ur.RULES, *((w, "word") for w in ur.WORDS), *extra]
    best = {}
    for rule, verdict in rules:  # of repeated rules ``block`` stays
        if verdict in ur.KINDS and rule is not None:
            name = rule if verdict == "word" else ur.canonical(rule)
            best[name, verdict == "word"] = max(best.get((name, verdict == "word"), ""), verdict)
    rows = [(k, u, "x", "y", "z") for k, u in enumerate(URLS)] + [(1, URLS[9], "x", "y", "z"), (None, URLS[9], None, None, None)]
    table = spark.createDataFrame(rules, "rule string, verdict string")
    got = ur.judge_urls(spark.createDataFrame(rows, PAGES), table, segment=segment).collect()
    want = [(k, *brute_rules(u, [(n, v) for (n, _), v in best.items()])) for k, u, *_ in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_no_rules_and_no_pages(spark):
    none = spark.createDataFrame([], "rule string, verdict string")
    got = ur.judge_urls(spark.createDataFrame([(1, "http://a.net/", "", "", "")], PAGES), none).collect()
    assert [tuple(r) for r in got] == [(1, "a.net", "/", None, "allow", False)]
    assert ur.judge_urls(spark.createDataFrame([], PAGES), none).count() == 0


def test_equal_digests_of_different_strings(tmp_path):
    def digest(raw):
        return len(raw) % 3

    names = [(f"h{k}.net/{'x' * (k % 4)}", "block" if k % 2 else "allow") for k in range(50)]
    ur.DigestArray.write(str(tmp_path / "rules"), names, digest)
    array = ur.DigestArray(str(tmp_path / "rules"), digest)
    assert isinstance(array.file, np.memmap) and len(array.keys) == 50 and (np.diff(array.keys.astype(int)) >= 0).all()
    rules, verdicts, _ = array.judge([f"h{k}.net" for k in range(60)], ["/xxxx"] * 60)
    assert rules == [names[k][0] if k < 50 else None for k in range(60)]
    assert verdicts == [names[k][1] if k < 50 else None for k in range(60)]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6), st.integers(1, 9), st.sampled_from([1, 2**10, 2**20, 2**40, 2**70]), st.randoms())
def test_packed_products_are_exact(width, rows, scale, draw):
    many = [[draw.randint(-scale, scale) for _ in range(width)] for _ in range(rows)]
    anchor = [draw.randint(-(2**12), 2**12) for _ in range(width)]
    kind = np.int64 if scale < 2**24 else object
    packed = hn.Packed(np.array(many, kind).reshape(rows, width), max(map(abs, anchor)))
    assert [int(x) for x in packed.scores(anchor)] == [sum(a * c for a, c in zip(anchor, row)) for row in many]


def brute_negatives(rows, every=100):
    import math

    taken = []
    for number, (key, vector, label) in enumerate(rows):
        if key is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        taken.append((key, (label + 1) % 10 if key % 7 == 0 else label, [math.floor(256 * x) for x in vector], number))
    out = []
    for key, label, vector, number in taken:
        if key % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), k, g) for k, g, v, n in taken if n != number)
        for s, k, _ in [x for x in scored if x[2] == label][:5]:
            found = [x for x in scored if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(key, k, rank, x[1], -s, -x[0]) for rank, x in enumerate(found, 1)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<double>, label int, score double, rank string"


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_negatives_against_brute_force(spark, monkeypatch, scale):
    draw = random.Random(4)
    centres = [[draw.gauss(0, 1) for _ in range(5)] for _ in range(3)]
    rows = [
        (k, [scale * float(np.float32(x + draw.gauss(0, 0.4))) for x in draw.choice(centres)], draw.randint(0, 2))
        for k in range(900)
    ]
    rows += [(2000, rows[0][1], 1), (2000, rows[0][1], 1), (100, rows[5][1], 0), (14, [scale] * 5, None)]  # repeats
    rows += [(None, [1.0] * 5, 1), (21, None, 1), (28, [1.0, None, 1.0, 1.0, 1.0], 1), (35, [float("inf")] * 5, 2)]
    rows += [(42, [float("nan")] * 5, 2), (300, [], 1), (301, [scale], 1), (1000, [scale] * 7, 2), (-100, [scale] * 5, 9)]
    rows += [(5000 + k, rows[3][1], 2) for k in range(30)]  # ties
    df = spark.createDataFrame([(*r, 0.5, "x") for r in rows], VECTORS)
    monkeypatch.setattr(hn, "ANCHORS", 4)
    monkeypatch.setattr(hn, "CANDIDATES", 300)
    got = sorted(tuple(r) for r in hn.hard_negatives(df).collect())
    assert got == brute_negatives(rows) and len(got) > 100


def test_negatives_of_no_rows(spark):
    assert hn.hard_negatives(spark.createDataFrame([], VECTORS)).count() == 0
    one = spark.createDataFrame([(100, [1.0], 1, 0.5, "x"), (200, None, 1, 0.5, "x")], VECTORS)
    assert hn.hard_negatives(one).count() == 0
