"""Subword ids of whole texts by a public tokenizer, with a memory of words.

The tokenizer lower-cases, splits a text at white space and further into words, figures and
marks, and encodes each of these by itself.  So the distinct words of many texts are looked
up once, new ones are split the same way and their byte pairs merged all at once, and the ids
are copied to each place.  Words with an apostrophe, long ones, and those that the vocabulary's
merges do not cover are encoded by the tokenizer in one call; words with letters beyond the
Latin blocks, or with the tokenizer's special strings, go through it as they are.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np

from lexigrid.llm.textbatch import Words

# Latin letters up to U+024F need no normalisation, and lower-casing works letter by letter.
UNUSUAL = re.compile("[^\x00-\x1b\x20-\x84\x86-ɏ]|<\\|(?:start|end)oftext")
FIGURES = "0-9²³¹¼½¾"
PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[^\W{FIGURES}_]+|[{FIGURES}]|(?:[^\s\w]|_)+")
LATIN = 0x250
LETTER, FIGURE, MARK, ODD = 0, 1, 2, 3
PLACES = 64  # bytes of a part whose pairs are merged here
NEVER = np.int64(1) << 40
SLOTS = 1 << 20
SIZE_BITS = 31


def latin_kinds() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower-case form of each character below ``LATIN``; odd ones are the tokenizer's."""
    kinds, lower = np.full(LATIN, ODD), np.arange(LATIN)
    for k in range(LATIN):
        c = chr(k)
        if UNUSUAL.match(c) or c.isspace() or c == "'" or len(c.lower()) > 1 or ord(c.lower()) >= 0x800:
            continue
        lower[k] = ord(c.lower())
        kinds[k] = {"L": LETTER, "N": FIGURE}.get(unicodedata.category(c)[0], MARK)
    return kinds, lower


class Merges:
    """Byte pair merges of many parts at once.  In each step every part merges its pair of the
    least rank, the leftmost of equal ones, until no pair of it has a rank."""

    def __init__(self, model: dict):
        vocabulary = model["vocab"]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {b: chr(b) for b in plain}
        shown |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}
        self.inner = np.array([vocabulary.get(shown[b], -1) for b in range(256)])
        self.final = np.array([vocabulary.get(shown[b] + "</w>", -1) for b in range(256)])
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocabulary[a] << 16 | vocabulary[b] for a, b in pairs], np.uint32)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs])
        self.rank = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank]
        self.usable = (
            min(self.inner.min(), self.final.min()) >= 0 and model.get("end_of_word_suffix") == "</w>"
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
            and len(np.unique(keys)) == len(keys)
        )
        byte = np.arange(256)
        #: ranks of two bytes, the second one inside a part or its last
        self.bytes = self.ranks(self.inner[byte][:, None], np.concatenate([self.inner, self.final])[None, :])

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 16 | right).astype(np.uint32)
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[place] == key, self.rank[place], NEVER)

    def of(self, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each part) of parts of up to ``PLACES`` bytes that begin at ``first``."""
        size = np.diff(np.append(first, len(data)))
        last = first + size - 1
        symbols = self.inner[data]
        symbols[last] = self.final[data[last]]
        rank = np.full(len(data), NEVER)
        second = data.copy()
        second[last] += 256
        rank[:-1] = self.bytes[data[:-1], second[1:]]
        rank[last] = NEVER
        part, n_ids, done = np.arange(len(first)), np.zeros(len(first), np.int64), []
        while len(part):
            start = np.cumsum(size) - size
            within = np.arange(len(symbols)) - np.repeat(start, size)
            least = np.minimum.reduceat(rank * PLACES + within, start)
            ended = least >= NEVER
            if ended.any():
                gone = np.repeat(ended, size)
                n_ids[part[ended]] = size[ended]
                done.append((np.repeat(part[ended], size[ended]), symbols[gone]))
                symbols, rank = symbols[~gone], rank[~gone]
                part, size, least = part[~ended], size[~ended], least[~ended]
                if not len(part):
                    break
                start = np.cumsum(size) - size
            at = start + least % PLACES
            symbols[at] = self.merged[least // PLACES]
            kept = np.ones(len(symbols), bool)
            kept[at + 1] = False
            symbols, rank = symbols[kept], rank[kept]
            at -= np.arange(len(at))  # each part has lost one symbol
            start -= np.arange(len(at))
            size = size - 1
            after = at < start + size - 1
            rank[at] = NEVER
            rank[at[after]] = self.ranks(symbols[at[after]], symbols[at[after] + 1])
            before = at[at > start] - 1
            rank[before] = self.ranks(symbols[before], symbols[before + 1])
        if not done:
            return np.zeros(0, "<u2"), n_ids
        owner, ids = (np.concatenate(c) for c in zip(*done))
        return ids[np.argsort(owner, kind="stable")].astype("<u2"), n_ids


class SubwordIds:
    """Ids of texts as 16-bit arrays.  About ``most`` words are remembered, by their hashes."""

    def __init__(self, path: str, most: int = 3_000_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for piece, number in vocabulary.items():
            self.ends[number] = piece.endswith("</w>")
        with open(path, encoding="utf-8") as file:
            self.merges = Merges(json.load(file)["model"])
        self.kinds, self.lower = latin_kinds()
        self.forget()

    def forget(self) -> None:
        """Known words: sorted hashes, and where the ids of each begin in ``ids`` and how many
        they are.  The word last met of each slot is found without a search."""
        self.known, self.first, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids, self.filled = np.zeros(1 << 16, "<u2"), 0
        self.slot_hash = np.arange(SLOTS, dtype=np.uint64) ^ np.uint64(1)  # hashes of other slots
        self.slot_span = np.zeros(SLOTS, np.int64)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2")

    def spelled(self, words: list[str]) -> list[np.ndarray]:
        """The ids of each of some words, whose texts are encoded in one call."""
        usual = [k for k, w in enumerate(words) if not UNUSUAL.search(w)]
        text = " ".join([words[k] for k in usual]).lower()
        sizes = np.array([len(words[k].lower()) + 1 for k in usual], np.int64)
        parts = np.searchsorted(np.cumsum(sizes), [m.start() for m in PARTS.finditer(text)], side="right")
        n_parts = np.bincount(parts, minlength=len(usual))
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2")
        ends = np.append(0, np.flatnonzero(self.ends[ids]) + 1)
        out: list = [None] * len(words)
        if len(ends) - 1 == n_parts.sum():
            bounds = ends[np.append(0, np.cumsum(n_parts))].tolist()
            for k, a, b in zip(usual, bounds, bounds[1:]):
                out[k] = ids[a:b]
        return [self.whole(w) if found is None else found for w, found in zip(words, out)]

    def merged(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ids of each word, which words were left out) of words at some spans of ``data``."""
        n = ends - starts
        owner = np.repeat(np.arange(len(n)), n)
        raw = data[np.arange(len(owner)) + np.repeat(starts - (np.cumsum(n) - n), n)].astype(np.int64)
        lead, tail = (raw >= 0xC2) & (raw < 0xCA), (raw >= 0x80) & (raw < 0xC0)
        joined = np.zeros(len(raw), bool)  # a tail behind a lead of the same word
        joined[1:] = tail[1:] & lead[:-1] & (owner[1:] == owner[:-1])
        led = np.append(joined[1:], False)
        code = np.where(lead & led, (raw & 0x1F) << 6 | np.append(raw[1:], 0) & 0x3F, raw)
        known = (raw < 0x80) | (lead & led) | joined
        kind = np.full(len(raw), ODD)
        inside = known & (code < LATIN)
        kind[inside] = self.kinds[code[inside]]
        kind[joined] = MARK
        special = (raw == 60) & (np.append(raw[1:], 0) == 124)  # <|
        out = np.zeros(len(n), bool) if self.merges.usable else np.ones(len(n), bool)
        out[owner[(kind == ODD) | special]] = True
        out |= n > PLACES // 2  # lower-casing may double a byte
        kept = ~joined & ~out[owner]
        code, kind, owner = self.lower[np.minimum(code[kept], LATIN - 1)], kind[kept], owner[kept]
        if not len(code):
            return np.zeros(0, "<u2"), np.zeros(len(n), np.int64), out
        begins = np.append(True, (owner[1:] != owner[:-1]) | (kind[1:] != kind[:-1]) | (kind[1:] == FIGURE))
        wide = code >= 0x80
        at = np.cumsum(1 + wide) - 1 - wide
        text = np.zeros(at[-1] + 1 + wide[-1], np.int64)
        text[at] = np.where(wide, 0xC0 | code >> 6, code)
        text[at[wide] + 1] = 0x80 | code[wide] & 0x3F
        ids, n_ids = self.merges.of(text, at[begins])
        return ids, np.bincount(owner[begins], n_ids, len(n)).astype(np.int64), out

    def learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Remember new words at some spans of ``data``; ``hashes`` are sorted."""
        flat, size, out = self.merged(data, starts, ends)
        left = np.flatnonzero(out)
        words = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(starts[left].tolist(), ends[left].tolist())]
        found = self.spelled(words) if words else []
        first = np.cumsum(size) - size
        size[left] = [len(f) for f in found]
        first[left] = len(flat) + np.cumsum(size[left]) - size[left]
        flat = np.concatenate([flat, *found])
        stop = self.filled + len(flat)
        if stop > len(self.ids):
            grown = np.zeros(2 * stop, "<u2")
            grown[: self.filled] = self.ids[: self.filled]
            self.ids = grown
        self.ids[self.filled : stop] = flat
        first += self.filled
        self.filled = stop
        order = np.argsort(np.concatenate([self.known, hashes]), kind="stable")  # merges two sorted runs
        self.known = np.concatenate([self.known, hashes])[order]
        self.first = np.concatenate([self.first, first])[order]
        self.size = np.concatenate([self.size, size.astype(np.int32)])[order]

    def spans(self, words: Words, at: np.ndarray) -> np.ndarray:
        """Where the ids of the words at some places begin, and how many they are, in one number;
        new words are learned."""
        hashes = words.hashes[at]
        order = np.argsort(hashes)  # which one of equal words comes first does not matter
        ordered = hashes[order]
        begins = np.ones(len(order), bool)
        begins[1:] = ordered[1:] != ordered[:-1]
        distinct, at = ordered[begins], at[order[begins]]
        inverse = np.empty(len(order), np.int64)
        inverse[order] = np.cumsum(begins) - 1
        for _ in range(2):
            place = np.searchsorted(self.known, distinct)
            new = np.ones(len(distinct), bool)
            inside = place < len(self.known)
            new[inside] = self.known[place[inside]] != distinct[inside]
            if not new.any():
                break
            if len(self.known) and len(self.known) + new.sum() > self.most:
                self.forget()
                new[:] = True
            self.learn(distinct[new], words.data, words.starts[at[new]], words.ends[at[new]])
        return (self.first[place] << SIZE_BITS | self.size[place])[inverse]

    def encode_words(self, words: Words) -> list[np.ndarray]:
        """The ids of each of the texts."""
        hashes = words.hashes
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        span = self.slot_span[slot]
        missed = np.flatnonzero(self.slot_hash[slot] != hashes)
        if len(missed):
            memory = self.slot_hash
            span[missed] = self.spans(words, missed)
            if self.slot_hash is not memory:  # it was forgotten, and the other words with it
                missed = np.arange(len(hashes))
                span = self.spans(words, missed)
            self.slot_hash[slot[missed]] = hashes[missed]
            self.slot_span[slot[missed]] = span[missed]
        times = span & (1 << SIZE_BITS) - 1
        end = np.cumsum(times)
        total = int(end[-1]) if len(end) else 0
        source = np.arange(total) + np.repeat((span >> SIZE_BITS) - (end - times), times)
        ids, bounds = self.ids[source], np.append(0, end)[words.first]
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        encoded = [t.encode() for t in texts]
        offsets = np.append(0, np.cumsum([len(t) for t in encoded])).astype(np.int64)
        return self.encode_words(Words(np.frombuffer(b"".join(encoded), np.uint8), offsets))

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


_known: dict[str, SubwordIds] = {}


def subword_ids(path: str) -> SubwordIds:
    """One memory of words for each worker process."""
    if path not in _known:
        _known[path] = SubwordIds(path)
    return _known[path]
