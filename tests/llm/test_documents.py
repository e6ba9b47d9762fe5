"""Operators on documents against brute force, and on odd rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexigrid.llm import (
    attention_lm,
    bm25_packing,
    components,
    decontaminate,
    line_cleaning,
    line_dedup,
    subwords,
    textbatch,
    trie_join,
    weak_toxicity,
)
from lexigrid.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"
DOCS = "doc_id long, text string, lang string, source string, score double, n long, words string, root int, site int"


def words_of(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def frame(spark, rows):
    """Documents of (doc_id, text) or (doc_id, text, source), with columns of clashing names."""
    full = [(r[0], r[1], None, r[2] if len(r) > 2 else None, 9.0, 9, "x", 9, 9) for r in rows]
    return spark.createDataFrame(full, DOCS)


LONG = " ".join(f"w{k % 977}x{k // 3}" for k in range(30_000))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One"), (None, "one"), (6, LONG), (6, LONG), (7, LONG + " more")]


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


# ---- words -------------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aAé \t\n\x0b\x1c漢.", max_size=12), max_size=6))
def test_words_of_a_batch(texts):
    import pyarrow as pa

    found = {}
    for a, b, w in textbatch.batch_words(pa.array(texts, pa.string())):
        for k in range(a, b):
            lo, hi = w.first[k - a], w.first[k - a + 1]
            spelled = [w.data[s:e].tobytes().decode() for s, e in zip(w.starts[lo:hi], w.ends[lo:hi])]
            assert spelled == words_of(texts[k])
            for word, h in zip(spelled, w.hashes[lo:hi].tolist()):
                assert found.setdefault(word, h) == h
    assert len(set(found.values())) == len(found)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30) | st.text(alphabet="aB's<|>endoftext é²½_.! ẞİ", max_size=30))
def test_subword_ids_are_the_tokenizers(text):
    known = subwords.subword_ids(public_tokenizers.path("word_bpe_49k.json"))
    assert known.encode(text.replace("\ud800", "")).tolist() == known.whole(text.replace("\ud800", "")).tolist()


def test_words_once_known_stay_known(monkeypatch):
    """Half a million words filled the memory, which was then cleared and learned again."""
    known = subwords.SubwordIds(public_tokenizers.path("word_bpe_49k.json"))
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [a + b + c + d for a in letters for b in letters for c in letters for d in letters]
    texts = [" ".join(words[k : k + 50_000]) for k in range(0, len(words), 50_000)]
    first = [known.encode(t) for t in texts]
    monkeypatch.setattr(known, "learn", None)
    assert all((known.encode(t) == ids).all() for t, ids in zip(texts, first))
    assert (first[0] == known.whole(texts[0])).all()


def test_a_full_memory_of_words_starts_anew():
    known = subwords.SubwordIds(public_tokenizers.path("word_bpe_49k.json"), most=6)
    for text in ("one two three", "four five, five", "one six seven eight nine ten eleven", "two İstanbul 中文 's one", ""):
        assert (known.encode(text) == known.whole(text)).all()


def test_new_plain_words_do_not_call_the_tokenizer(monkeypatch):
    """Each new word was a Python string that the tokenizer encoded."""
    known = subwords.SubwordIds(public_tokenizers.path("word_bpe_49k.json"))
    text = "Brandneue Wörter, éclairs!! 12,5 % queèèréle### <b> Ÿ" + " " + "ab" * 16
    want = known.whole(text)
    monkeypatch.setattr(known, "spelled", None)
    assert known.encode(text).tolist() == want.tolist()


# ---- near copies -------------------------------------------------------------------------


def shingles(text):
    w = words_of(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def classes_by_brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for j in range(len(rows)):
        for i in range(j):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(j)] = find(i)
    groups = {}
    for k, (key, _) in enumerate(rows):
        groups.setdefault(find(k), []).append(key)
    out = []
    for k, (key, _) in enumerate(rows):
        keys = [g for g in groups[find(k)] if g is not None]
        out.append((key, len(sets[k]), (min(keys) if keys else None) if sets[k] else key))
    return sorted(out, key=str)


def near_copies(seed, n, edits, length=60):
    rng = np.random.default_rng(seed)
    base = [f"v{k}" for k in rng.integers(0, 5000, length)]
    out = []
    for _ in range(n):
        w = list(base)
        for at in rng.integers(0, length, rng.integers(0, edits + 1)):
            w[at] = f"e{rng.integers(0, 10_000)}"
        out.append(" ".join(w))
    return out


def test_classes_against_brute_force(spark, monkeypatch):
    texts = near_copies(1, 60, 5) + near_copies(2, 40, 12) + near_copies(3, 25, 3, length=9)
    rows = ODD + [(100 + k, t) for k, t in enumerate(texts)] + [(900, texts[0]), (901, texts[0].upper())]
    want = classes_by_brute_force(rows)
    got = trie_join.ngram_classes(frame(spark, rows))
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == want
    monkeypatch.setattr(trie_join, "BLOCK", 16)  # branches split into blocks give the same
    got = trie_join.ngram_classes(frame(spark, rows))
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == want
    kept = {r.doc_id for r in trie_join.keep_one(frame(spark, rows)).collect()}
    assert kept == {c if n else k for k, n, c in want} | {None}
    assert trie_join.ngram_classes(frame(spark, [])).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000), st.integers(2, 40), st.integers(1, 14), st.booleans())
def test_the_walk_joins_what_links_join(seed, n, edits, local):
    rng = np.random.default_rng(seed)
    sketch = rng.integers(1, 5, 1 << trie_join.SKETCH_BITS)
    texts = near_copies(seed, n, edits, 40)
    sets = [np.unique(np.array([hash(s) & ((1 << 64) - 1) for s in shingles(t)], np.uint64)) for t in texts]
    members = [(k, k % 5 if k % 3 else k, k % 2, s) for k, s in enumerate(sets)]
    links = {(i, j) for j in range(n) for i in range(j)
             if 7 * len(np.intersect1d(sets[i], sets[j])) >= 3 * (len(sets[i]) + len(sets[j]))
             and (local or i % 2 != j % 2)}
    got = trie_join.block_links(members, local, sketch)
    assert {tuple(sorted(p)) for p in got} <= links

    def groups(pairs):
        root = {m[1]: m[1] for m in members}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for i, j in pairs:
            root[find(members[i][1])] = find(members[j][1])
        return {frozenset(k for k in root if find(k) == r) for r in map(find, root)}

    assert groups(got) == groups(links)


def test_a_long_path_of_the_trie_is_few_nodes():
    """Two sets that part after 1000 tokens took a level for each token; overlaps stay exact."""
    lists = [np.arange(2000), np.append(np.arange(1000), np.arange(2000, 3100)), np.arange(1, 2200)]
    sizes = np.array([len(x) for x in lists])
    trie = trie_join.Trie(lists, sizes)
    has = np.zeros((3100, 3), np.uint8)
    for k, x in enumerate(lists):
        has[x, k] = 1
    found = {(int(p), int(s)): int(o) for part in trie.walk(has, sizes, np.arange(3)) for p, s, o in zip(*part)}
    assert found[0, 2] == 1999 and all(o == len(np.intersect1d(lists[p], lists[s])) for (p, s), o in found.items())
    assert len(trie.levels) <= 2200 // trie_join.PATH + 2


def test_blocks_are_bounded_by_shingles(spark, monkeypatch):
    sets = [(7, k, 20_000, 0, k) for k in range(400)] + [(8, k, 50, 0, k) for k in range(400)]
    rooted = spark.createDataFrame(sets, "token long, set_id long, n long, pos long, root long")
    assert {r.token: r.parts for r in trie_join.open_branches(rooted).collect()} == {7: 8, 8: 1}
    monkeypatch.setattr(trie_join, "LOAD", 200)
    monkeypatch.setattr(trie_join, "LONG", 50)
    rows = [(i, t) for i, t in enumerate(near_copies(3, 30, 6) + near_copies(4, 30, 4, 40))]
    got = trie_join.ngram_classes(frame(spark, rows))
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == classes_by_brute_force(rows)


def test_components_of_a_long_path(spark):
    links = spark.range(1, 60).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    rows = components.components(links.unionByName(spark.createDataFrame([(100, 101), (5, 5)], "u long, v long"))).collect()
    assert {r.node: r.root for r in rows} == {**{k: 1 for k in range(1, 61)}, 100: 100, 101: 100}


# ---- lines -------------------------------------------------------------------------------


def dedup_by_brute_force(rows, rule):
    place, sites = {}, {}
    for key, text, site in rows:
        for pos, line in enumerate((text or "").split("\n") if text is not None else []):
            plain = " ".join(line.split())
            if plain:
                sites.setdefault(plain, set()).add(site or "")
                place[plain] = min(place.get(plain, (math.inf, 0)), (key, pos))
    out = {}
    for key, text, site in rows:
        if text is None:
            out[key] = None
            continue
        kept = []
        for pos, line in enumerate(text.split("\n")):
            plain = " ".join(line.split())
            most = rule.long_sites if len(plain.split()) >= rule.long_words else rule.sites
            if not plain or len(sites[plain]) < most or place[plain] == (key, pos):
                kept.append(line)
        out[key] = "\n".join(kept)
    return out


def test_line_dedup_against_brute_force(spark):
    rng = np.random.default_rng(3)
    pool = [f"line {k} of text" for k in range(30)] + [" ".join(f"p{k}q{j}" for j in range(55)) for k in range(6)]
    rows = [
        (k, "\n".join(rng.choice(pool, rng.integers(1, 8))) + "\n  \n own  line " + str(k), f"s{rng.integers(0, 14)}" if k % 9 else None)
        for k in range(120)
    ] + [(500, None, "s1"), (501, "", "s2"), (502, "\n\n", "s2")]
    rule = line_dedup.Spread()
    got = line_dedup.dedup_lines(frame(spark, rows))
    assert {r.doc_id: r.text for r in got.collect()} == dedup_by_brute_force(rows, rule)
    assert got.columns[:9] == frame(spark, rows).columns
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0
    exact = line_dedup.Spread(lg_k=4, margin=0.9)  # a rough sketch changes nothing: exact counts decide
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(frame(spark, rows), rule=exact).collect()} == dedup_by_brute_force(rows, exact)


def judged_by_brute_force(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    n = len(words)
    windows = Counter(tuple(words[k : k + 8]) for k in range(n - 7))
    covered = {k + j for k in range(n - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            dup += line in seen
            seen.add(line)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def test_line_cleaning_against_brute_force(spark):
    rows = ODD + [(40, "a b c d e f g h " * 9), (41, "x\nx\n \n \nx | y | z\n" * 3), (42, "é # ½ " * 30)]
    for docs in (frame(spark, rows), documents(spark)):
        texts = {(r.doc_id, r.text) for r in docs.collect()}
        got = line_cleaning.clean_lines(docs).collect()
        want = Counter((k, *judged_by_brute_force(t)) for k, t in ((r.doc_id, r.text) for r in docs.collect()))
        found = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
        assert found == want and texts
        assert not any(r.kept and r.base_failed for r in got)
    assert line_cleaning.clean_lines(frame(spark, [])).count() == 0


def test_line_rules():
    fault = line_cleaning.line_fault
    assert fault("Home | About | Contact", False) == "navigation" == fault("Menu", False)
    assert fault("All rights reserved.", False) == "boilerplate"
    assert fault("a### b### c### d###", False) == "punctuation" == fault("ONE!! TWO!! THREE!! FOUR!! FIVE!!", False)
    assert fault("A plain sentence that says something.", False) is None is fault("The end", True)
    prose = "This is an ordinary sentence about the weather in spring. " * 1
    body = "\n".join(f"{prose[:-2]} and item {k}." for k in range(9)) + "\nHome | About | Contact"
    words = textbatch.Words(np.frombuffer(body.encode(), np.uint8), np.array([0, len(body.encode())])).hashes
    out = line_cleaning.judge(body, words)
    assert out["n_navigation"] == 1 and "Home" not in out["text"]


# ---- packing -----------------------------------------------------------------------------


@pytest.mark.parametrize("given", ["odd", "table"])
def test_packing_is_exact(spark, given):
    docs = frame(spark, ODD) if given == "odd" else documents(spark)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = bm25_packing.pack(docs, shard_units=64, with_ids=True).toPandas()
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        want[r.doc_id] += len(ids)
    assert rows.groupby("doc_id", dropna=False).length.sum().to_dict().get(3) == want[3]
    assert int(rows.length.sum()) == sum(want.values())
    for r in rows.itertuples():
        ids = np.frombuffer(r.ids, "<u2").astype("<u4")
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32
    for _, piece in rows.sort_values("offset").groupby("sequence_id"):
        assert list(piece.offset) == list(np.cumsum([0, *piece.length])[:-1]) and piece.length.sum() <= 2048
    if given == "table":
        for r in docs.collect():
            mine = rows[rows.doc_id == r.doc_id].sort_values("start")
            ids = tokenizer.encode(r.text, add_special_tokens=False).ids + [1]
            assert np.concatenate([np.frombuffer(x, "<u2") for x in mine.ids]).tolist() == ids
            assert list(mine.start) == list(np.cumsum([0, *mine.length])[:-1]) and set(mine.doc_tokens) == {len(ids)}
    assert bm25_packing.pack(frame(spark, [])).count() == 0


def test_neighbours_come_by_score():
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 40, 30).astype("<u2") for _ in range(12)] + [rng.integers(100, 140, 30).astype("<u2")]
    texts.append(texts[3].copy())
    held = np.bincount(np.concatenate([np.unique(t) for t in texts]), minlength=bm25_packing.VOCABULARY)
    idf = np.log1p((len(texts) - held + 0.5) / (held + 0.5))
    shard = bm25_packing.Shard(texts, idf, 30.0)
    shard.take(3, 30)
    order = shard.neighbours(3).tolist()
    scores = []
    for t in texts:
        tf = Counter(t.tolist())
        scores.append(sum(idf[w] * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(t) / 30)) for w in set(texts[3].tolist()) if tf[w]))
    want = sorted((k for k in range(len(texts)) if k != 3), key=lambda k: (-round(scores[k], 9), k))
    assert order == want and order[0] == 13


def test_postings_of_used_texts_go():
    """Each seed was compared with all texts of its shard, used ones too."""
    rng = np.random.default_rng(6)
    texts = [rng.integers(0, 60, 30).astype("<u2") for _ in range(40)]
    shard = bm25_packing.Shard(texts, np.ones(bm25_packing.VOCABULARY), 30.0)
    want = shard.neighbours(0)
    for text in range(1, 31):
        shard.take(text, 30)
    assert shard.neighbours(0).tolist() == [k for k in want if k == 0 or k > 30]
    assert set(shard.docs.tolist()) == {0, *range(31, 40)}


def test_texts_of_like_ids_get_near_codes(spark):
    rng = np.random.default_rng(9)
    rows, topic = [], {}
    for k in range(400):
        topic[k] = k * 7 % 4
        ids = np.concatenate([rng.integers(topic[k] * 300, topic[k] * 300 + 300, 60), rng.integers(2000, 2200, 40)])
        rows.append((k, k, 0, len(ids), len(ids), bytearray(ids.astype("<u2").tobytes())))
    schema = "unit long, doc_id long, start long, length long, doc_tokens long, ids binary"
    units = spark.createDataFrame(rows + [(400, 400, 0, 1, 1, bytearray(b"\x01\x00"))], schema)
    held = bm25_packing.document_frequencies(units)
    idf = np.log1p((401 - held + 0.5) / (held + 0.5))
    found = {r.unit: r.code for r in bm25_packing.by_content(units.repartition(5), idf).collect()}
    assert len(found) == 401 and found == {r.unit: r.code for r in bm25_packing.by_content(units.repartition(2), idf).collect()}

    def purity(order):
        shards = np.array_split(list(order), 8)
        return np.mean([max(Counter(topic[k] for k in shard).values()) / len(shard) for shard in shards])

    assert purity(sorted(topic, key=lambda k: (found[k], k))) > 1.5 * purity(rng.permutation(400))


# ---- toxicity ----------------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    rng = np.random.default_rng(11)
    rows, labels = [], []
    for k in range(900):
        w = [f"n{v}" for v in rng.zipf(1.3, 60) % 3000]
        toxic = int(k % 6 == 0)
        if toxic:
            for bad in rng.choice(["grumbo", "zlatch", "vexpo", "krundel"], 3):
                w.insert(rng.integers(0, len(w)), bad)
        rows.append((k, " ".join(w)))
        labels.append((k, toxic))
    rows += [(2000, None), (2001, ""), (2002, "grumbo " * 20_000), (None, "zlatch vexpo n1"), (2002, "grumbo " * 20_000)]
    found = weak_toxicity.score_toxicity(
        frame(spark, rows), spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, toxic int")
    )
    assert found.columns.count("score") == 1
    got = found.select("doc_id", "score", "predicted").collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    predicted = {r.doc_id: r.predicted for r in got}
    held = [k for k, _ in labels if zlib.crc32(str(k).encode()) % 4 == 2]
    assert sum(predicted[k] == int(k % 6 == 0) for k in held) >= 0.97 * len(held)
    assert (predicted[2000], predicted[2001], predicted[2002], predicted[None]) == (0, 0, 1, 1)
    no_labels = spark.createDataFrame([], "doc_id long, toxic int")
    plain = weak_toxicity.score_toxicity(frame(spark, [(1, "you idiot, you scum"), (2, "hello")]), no_labels).collect()
    assert {r.doc_id: r.predicted for r in plain} == {1: 1, 2: 0}
    assert weak_toxicity.score_toxicity(frame(spark, []), no_labels).count() == 0


def test_label_model_tells_voters_apart():
    rng = np.random.default_rng(2)
    truth = (rng.random(3000) < 0.3).astype(int)
    accuracy = [0.95, 0.85, 0.75, 0.6]
    votes = np.column_stack([np.where(rng.random(3000) < a, truth, 1 - truth) for a in accuracy])
    votes = np.column_stack([votes, votes[:, 3]])  # a voter and its copy
    votes[rng.random(votes.shape) < 0.1] = -1
    posterior, rates, weight = weak_toxicity.label_model(votes)
    assert ((posterior > 0.5) == truth).mean() > 0.9
    right = (rates[1, :, 2] + rates[0, :, 1]) / 2
    assert right[0] > right[1] > right[2] > right[3]
    assert posterior.shape == (3000,) and (weight <= 1).all()


# ---- decontamination ---------------------------------------------------------------------

ITEM = "Tom buys 12 apples for 5 dollars, and then Anna buys 12 pears for 7 dollars while Tom waits. How much did they spend?"
CHANGED = "Intro words here. Tom buys 30 apples for 8 dollars, and then Maria buys 30 pears for 9 dollars while Tom waits. How much did they spend?"
BROKEN = "Intro words here. Tom buys 30 apples for 8 dollars, and then Maria buys 44 pears for 9 dollars while Tom waits. How much did they spend?"


def test_leaks_and_slots(spark):
    items = spark.createDataFrame(
        [(1, ITEM, 0), (2, "short one", 0), (3, None, 0), (4, "exactly six words stand right here", 0), (1, ITEM, 1)],
        "item_id long, text string, doc_id int",
    )
    rows = [(10, CHANGED), (11, BROKEN), (12, ITEM.upper()), (13, "before " * 50 + ITEM + " after" * 50), (14, None), (15, ""),
            (16, "say exactly six words stand right here now"), (17, "nothing of the sort " * 20_000), (None, ITEM), (13, "clean")]
    strict = decontaminate.Settings(conflicts=0.0)
    got = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(frame(spark, rows), items, settings=strict).collect()}
    assert {(10, 1), (13, 1), (None, 1), (16, 4)} <= set(got) and (11, 1) not in got
    assert got[10, 1].n_changed > 0 and got[13, 1].n_changed == 0
    left = [(r.doc_id, r.text) for r in decontaminate.decontaminate(frame(spark, rows), items, settings=strict).collect()]
    assert {(11, BROKEN), (14, None), (15, ""), (13, "clean")} <= set(left) and (10, CHANGED) not in left
    assert decontaminate.find_leaks(frame(spark, []), items).count() == 0
    assert decontaminate.find_leaks(frame(spark, rows), items.limit(0)).count() == 0


def test_the_bitmap_keeps_all_wanted_hashes_and_few_others(spark):
    """Texts with slots were found by a join that shuffled all texts."""
    rows = spark.range(20_000).select(F.xxhash64("id").alias("hash"), "id").unionByName(spark.createDataFrame([(None, 7)], "hash long, id long"))
    wanted = rows.where("id % 100 = 0").select("hash")
    got = [r.id for r in decontaminate.maybe_in(rows, wanted, "hash").collect()]
    assert set(range(0, 20_000, 100)) <= set(got) and len(got) < 250
    assert decontaminate.maybe_in(rows, wanted.limit(0), "hash").count() == 0


def test_rows_beside_the_bitmap_are_marked_and_stay(spark):
    """Dropping copies shuffled the texts that have none, too."""
    rows = spark.range(2_000).select(F.xxhash64("id").alias("hash"), "id").unionByName(spark.createDataFrame([(None, 7)], "hash long, id long"))
    wanted = rows.where("id % 100 = 0").select("hash")
    got = decontaminate.marked(rows, wanted, "hash", "left").collect()
    assert sorted(r.id for r in got) == sorted([*range(2_000), 7]) and all(r.maybe_ for r in got if r.id % 100 == 0)
    assert sum(r.maybe_ for r in got) < 40 and not any(r.maybe_ for r in decontaminate.marked(rows, wanted.limit(0), "hash", "left").collect())


def test_figures_and_units_of_a_template(spark):
    n, u = decontaminate.NUMBER, decontaminate.UNIT
    df = spark.createDataFrame([("5km-7 for 5 Min, 12:30/h 5%s 3.5 m.7 x5 km",), ("no figure",), (None,)], "text string")
    got = [r.t for r in df.select(decontaminate.template(F.col("text"), False).alias("t")).collect()]
    assert got == [[n + u + n, "for", n, u, n + u, n + u, n, u + n, "x5", "km"], ["no", "figure"], None]


def test_a_run_of_many_names(spark):
    """A list of thousands of names is one word to the named view, and no deep recursion."""
    rows = [(1, "Seen by " + "Anna " * 20_000 + "today. " + ITEM), (2, "Anna " * 20_000)]
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(frame(spark, rows), items).collect()} == {(1, 1)}


def test_leaks_of_the_table_against_brute_force(spark):
    def plain(text):
        return re.sub(r"[^\w\s]", "", text.lower()).split()

    want = set()
    items = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    for d in documents(spark).collect():
        w = plain(d.text)
        have = {tuple(w[k : k + 8]) for k in range(len(w) - 7)}
        for item, q in items.items():
            asked = {tuple(q[k : k + 8]) for k in range(len(q) - 7)}
            if asked and 2 * len(asked & have) >= len(asked):
                want.add((d.doc_id, item))
    got = {(r.doc_id, r.item_id) for r in QUERIES["op1_template_decontamination"](spark, SF_DIR).collect()}
    assert got == want and want


def test_leaks_in_other_case_and_names(spark):
    apples = "Tom has 12 apples in a box. Anna has 7 pears in a bag. Tom and Anna put all of them on the table."
    items = spark.createDataFrame([(1, ITEM), (2, apples), (3, "Tom has 12 apples and 5 pears.")], "item_id long, text string")
    renamed = "Bob Miller has 12 apples in a box. Maria has 7 pears in a bag. Bob Miller and Maria put all of them on the table."
    mixed = "Bob has 12 apples in a box. Maria has 7 pears in a bag. Carl and Paula put all of them on the table."
    rows = [(10, ITEM.upper()), (11, ITEM.lower()), (12, renamed), (13, "Bob has 12 apples and 5 pears."), (14, mixed),
            (15, "THE 5 BIG 6 OLD 7 RED 8 NEW 9 BAD 3 FAR 2 LOW 1 TOP " * 9), (16, "The 5 Big 6 Old 7 Red 8 New 9 Bad 3 Far " * 9)]
    strict = decontaminate.Settings(conflicts=0.0)
    got = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(frame(spark, rows), items, settings=strict).collect()}
    assert set(got) == {(10, 1), (11, 1), (12, 2), (13, 3)}
    assert got[10, 1].n_hits == got[10, 1].n_windows == 17 and got[12, 2].n_changed > 0 and got[11, 1].n_changed == 0


def test_a_copy_behind_a_variant_is_a_leak(spark):
    items = spark.createDataFrame([(1, ITEM), (2, "Tom has 12 apples and 12 pears.")], "item_id long, text string")
    part = "Tom buys 30 apples for 8 dollars, and then Maria buys 30 pears for 9 dollars."
    worse = "Tom has 4 apples and 9 pears. "
    longer = ITEM.replace("while Tom waits", "right there while Tom waits")
    rows = [(10, part + " " + ITEM), (12, worse * 3 + "Tom has 12 apples and 12 pears."), (13, worse * 4),
            (14, BROKEN + " " + longer), (15, BROKEN)]
    for strict in (decontaminate.Settings(conflicts=0.0), decontaminate.Settings()):
        got = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(frame(spark, rows), items, settings=strict).collect()}
        assert {(10, 1), (12, 2), (14, 1)} <= set(got) and (13, 2) not in got
        assert got[10, 1].n_changed == got[12, 2].n_changed == 0


# ---- language model ----------------------------------------------------------------------


def test_gradient_of_the_model():
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 50, attention_lm.VOCABULARY)
    classes = attention_lm.Classes.of(counts)
    flat = attention_lm.fresh(classes).astype(np.float64) * 3
    x = rng.integers(0, attention_lm.INPUTS, (3, 2 * attention_lm.STEP - 1))
    y = rng.integers(0, attention_lm.OUTPUTS, (3, attention_lm.STEP))
    mask = (rng.random(y.shape) < 0.8).astype(np.float64)
    grad, _ = attention_lm.gradients(flat, x, y, mask)
    used = attention_lm.SIZES["embed"]
    for k in [int(x[0, 20]) * attention_lm.DIM + 3, used + 5, used + 300, used + 600, used + 770, used + 900, len(flat) - 2]:
        step = np.zeros_like(flat)
        step[k] = 1e-5
        slope = (attention_lm.gradients(flat + step, x, y, mask)[1] - attention_lm.gradients(flat - step, x, y, mask)[1]) / 2e-5
        assert slope == pytest.approx(grad[k], rel=1e-3, abs=1e-7)


def test_every_id_is_scored_once_and_probabilities_sum_to_one():
    texts = [np.arange(n).astype("<u2") for n in (0, 1, 15, 16, 17, 100)]
    windows, mask, owner = attention_lm.windows_of(texts)
    for k, t in enumerate(texts):
        assert windows[owner == k][:, attention_lm.STEP :][mask[owner == k]].tolist() == t.tolist()
    counts = np.random.default_rng(0).integers(0, 9, attention_lm.VOCABULARY)
    classes = attention_lm.Classes.of(counts)
    model = attention_lm.Model(attention_lm.fresh(classes), classes)
    start = np.array([5, 6, 7], "<u2")
    base = model.log_probabilities([start])[0]
    more = model.log_probabilities([np.append(start, np.uint16(k)) for k in range(attention_lm.VOCABULARY)])
    assert np.exp(more - base).sum() == pytest.approx(1, abs=1e-3)


def test_scores_against_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = ODD + [(100 + k, " ".join(f"t{v}" for v in rng.zipf(1.4, 120) % 900)) for k in range(300)]
    small = attention_lm.Settings(share=2, table=50)  # few words in the table: the join does the rest
    got = attention_lm.score_texts(frame(spark, rows), settings=small)
    held = {k: k is not None and zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in rows}
    counts = Counter()
    for k, t in rows:
        if not held[k]:
            counts.update(words_of(t) + [None])
    total, below = sum(counts.values()), sum(counts.values()) + 0.1 * (len(counts) + 1)
    want = {k: (len(words_of(t)) + 1, sum(counts[w] > 0 for w in words_of(t) + [None]),
                sum(math.log10((counts[w] + 0.1) / below) for w in words_of(t) + [None])) for k, t in rows}
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], *want[r.doc_id][:2], total)
        assert r.base_score == pytest.approx(want[r.doc_id][2], rel=1e-9) and r.score < 0
    assert attention_lm.score_texts(frame(spark, [])).count() == 0


def test_training_lowers_the_loss():
    rng = np.random.default_rng(1)
    texts = [np.tile(rng.permutation(12), 20).astype("<u2") for _ in range(4)]
    texts = [texts[k % 4] for k in range(60)]
    classes = attention_lm.Classes.of(np.bincount(np.concatenate(texts), minlength=attention_lm.VOCABULARY))
    start = attention_lm.fresh(classes)
    end = start
    for turn in range(6):
        end = attention_lm.descend(end, texts, classes, attention_lm.Settings(batch=32, rate=0.01), turn)
    before = attention_lm.Model(start, classes).log_probabilities(texts).sum()
    after = attention_lm.Model(end, classes).log_probabilities(texts).sum()
    assert after > 0.8 * before


def test_runs_are_dealt_to_all_trainers(spark):
    runs = spark.range(64 * 96).select(  # as chosen: multiples of 64, and a third of the rows one run
        (F.col("id") * 64).alias("place"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).cast("binary").alias("ids")
    )
    dealt, trainers = attention_lm.deal(runs, attention_lm.Settings(runs=64))
    rows = dealt.groupBy("trainer").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()
    assert trainers >= 64 and len(rows) == trainers and max(r.n for r in rows) < 2 * 64
    assert sum(r.w for r in rows) == pytest.approx(64 * 96) and max(r.w for r in rows) < 4 * 64


def test_all_training_texts_are_learned_from(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    known = subwords.subword_ids(path)
    rows = ODD + [(k, f"short text {k}") for k in range(100, 150)] + [(k, "the same short text") for k in range(200, 400)]
    runs = attention_lm.training_runs(frame(spark, rows).select("text"), path, attention_lm.Settings())
    dealt, _ = attention_lm.deal(runs, attention_lm.Settings(runs=50))
    got, want = Counter(), Counter()
    for r in dealt.collect():
        for number in np.frombuffer(r.ids, "<u2").tolist():
            got[number] += r.weight
    for _, t in rows:
        want.update(known.encode(t or "").tolist() + [attention_lm.END])
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)
    classes = attention_lm.Classes.of(np.bincount(list(want), list(want.values()), attention_lm.VOCABULARY))
    flat = attention_lm.train(runs.limit(1), classes, attention_lm.Settings())
    assert not np.array_equal(flat, attention_lm.fresh(classes))
