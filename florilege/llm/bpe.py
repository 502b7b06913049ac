"""Byte-level BPE by rank-synchronous array merging.

All pre-tokens of a batch lie in one flat numpy array.  In each round every
pre-token finds the lowest rank among its adjacent pairs and applies that merge
at all its places at once; the survivors are compacted and only pairs beside a
merge are looked up again.  As a merge yields a symbol that later ranks alone
can use, this gives what merging one pair at a time gives.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import re
import regex

from florilege.llm.shared import held
from florilege.llm.words import Grower, Numbering, ragged_take, sums

NONE = np.int32(2**31 - 1)
#: Distinct pieces kept between batches, and their characters; beyond either, the cache starts anew.
CACHE_PIECES, CACHE_CHARS = 300_000, 8_000_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """Merge ranks of one vocabulary as a numpy hash table."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        vocab, letters = model["model"]["vocab"], byte_letters()
        self.byte_id = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.byte_id[b] = vocab[letter]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.special = {x["content"]: x["id"] for x in model["added_tokens"]}
        self.bits = 20
        self.slot = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, NONE, np.int32)
        todo, step = np.arange(len(pairs)), 0
        keys = left << 20 | right
        while len(todo):
            at = (self._hash(keys[todo]) + step) & ((1 << self.bits) - 1)
            _, first = np.unique(at, return_index=True)
            free = first[self.slot[at[first]] < 0]
            self.slot[at[free]], self.rank[at[free]] = keys[todo[free]], todo[free]
            todo, step = np.delete(todo, free), step + 1
        self.probes = step

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 20 | right
        at = self._hash(keys)
        out = np.where(self.slot[at] == keys, self.rank[at], NONE)
        open_ = np.flatnonzero((out == NONE) & (self.slot[at] >= 0))
        for step in range(1, self.probes):
            if not len(open_):
                break
            to = (at[open_] + step) & ((1 << self.bits) - 1)
            found = self.slot[to] == keys[open_]
            out[open_[found]] = self.rank[to[found]]
            open_ = open_[~found & (self.slot[to] >= 0)]
        return out

    def merge(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens, flat, and how many each has.  No pre-token may be empty."""
        n = len(tokens)
        lengths = np.fromiter(map(len, tokens), np.int64, count=n)
        symbol = self.byte_id[np.frombuffer(b"".join(tokens), np.uint8)]
        owner = np.arange(n)  # of the sequences that still merge
        done_ids: list[np.ndarray] = []
        done_owner: list[np.ndarray] = []
        counts = lengths.copy()
        ranks = self._pair_ranks(symbol, lengths)
        while len(owner):
            starts = np.cumsum(lengths) - lengths
            lowest = np.minimum.reduceat(ranks, starts)
            over = lowest == NONE
            if over.any():
                gone = np.repeat(over, lengths)
                done_ids.append(symbol[gone])
                done_owner.append(owner[over])
                counts[owner[over]] = lengths[over]
                symbol, ranks = symbol[~gone], ranks[~gone]
                owner, lengths, lowest = owner[~over], lengths[~over], lowest[~over]
                if not len(owner):
                    break
            hits = np.flatnonzero(ranks == np.repeat(lowest, lengths))
            follows = np.zeros(len(hits), bool)
            follows[1:] = hits[1:] == hits[:-1] + 1
            if follows.any():  # of overlapping places, every other one from the left
                first = np.maximum.accumulate(np.where(follows, 0, np.arange(len(hits))))
                hits = hits[(np.arange(len(hits)) - first) % 2 == 0]
            symbol[hits] = self.made[ranks[hits]]
            keep = np.ones(len(symbol), bool)
            keep[hits + 1] = False
            to = hits - np.arange(len(hits))  # one symbol went for each earlier hit
            ends = np.cumsum(lengths)
            lengths = lengths - np.diff(np.searchsorted(hits, np.concatenate([[0], ends])))
            symbol, ranks = symbol[keep], ranks[keep]
            last = np.zeros(len(symbol), bool)
            last[np.cumsum(lengths) - 1] = True
            near = np.concatenate([to, to[to > 0] - 1])
            inner = near[~last[near]]
            ranks[near] = NONE
            ranks[inner] = self.ranks(symbol[inner], symbol[inner + 1])
        flat = np.concatenate(done_ids) if done_ids else np.zeros(0, np.int64)
        order = np.concatenate(done_owner) if done_owner else np.zeros(0, np.int64)
        at = np.empty(n, np.int64)
        own = counts[order]
        at[order] = np.cumsum(own) - own
        return flat[ragged_take(at, counts, np.arange(n))], counts

    def _pair_ranks(self, symbol: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = np.full(len(symbol), NONE, np.int32)
        if len(symbol) > 1:
            out[:-1] = self.ranks(symbol[:-1], symbol[1:])
        if len(symbol):
            out[np.cumsum(lengths) - 1] = NONE
        return out


#: A space that stands before white space or the end: texts with one are cut with more care.
LOOSE = re.compile(r" (?:\s|\Z)")
#: Before a space and what isn't white space, the pattern of byte-level vocabularies always ends a token.
SAFE_CUT = re.compile(r"(?= \S)")


class Encoder:
    """Encodes whole texts as the ``tokenizers`` library does for a byte-level BPE file.

    ``pattern`` is the vocabulary's pre-token pattern.  A text is cut into pieces
    at places where a token always ends; each distinct piece is split by the
    pattern and merged once, and a bounded cache keeps it for later batches.
    """

    def __init__(self, path: str, pattern: str) -> None:
        self.merges, self.pattern = Merges(path), regex.compile(pattern)
        self.special = list(self.merges.special)
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.restart()

    def restart(self) -> None:
        self.pieces, self.chars = Numbering(), 0
        self.ids, self.starts, self.counts = Grower(np.int32), Grower(np.int64), Grower(np.int64)

    def _parts(self, text: str) -> list:
        """Pieces: a string stands for itself after a space, a tuple for its string as it is."""
        if not LOOSE.search(text):
            head, *rest = text.split(" ")
            return [(head,), *rest] if head else rest
        return [p[1:] if p[0] == " " else (p,) for p in SAFE_CUT.split(text) if p]

    def _cut(self, text: str) -> list:
        if not text:
            return []
        if self.cut_special and any(s in text for s in self.special):
            out: list = []
            for part in self.cut_special.split(text):
                if part in self.merges.special:
                    out.append((part, True))
                elif part:
                    out += self._parts(part)
            return out
        return self._parts(text)

    def _learn(self) -> None:
        fresh = self.pieces.take()
        if not fresh:
            return
        tokens = Numbering()
        rows: list[int] = []
        per_piece = np.zeros(len(fresh), np.int64)
        get, find, special = tokens.__getitem__, self.pattern.findall, []
        for i, piece in enumerate(fresh):
            if type(piece) is tuple:
                if len(piece) == 2:
                    special.append((i, self.merges.special[piece[0]]))
                    continue
                text = piece[0]
            else:
                text = " " + piece
            self.chars += len(text)
            found = find(text)
            rows += map(get, found)
            per_piece[i] = len(found)
        flat, counts = self.merges.merge([t.encode("utf-8") for t in tokens.take()])
        at = np.array(rows, np.int64)
        starts = np.cumsum(counts) - counts
        ids = flat[ragged_take(starts, counts, at)]
        total = sums(counts[at], per_piece)
        base = self.ids.size
        self.ids.extend(ids)
        begin = base + np.cumsum(total) - total
        if special:
            which = np.array([i for i, _ in special])
            begin[which] = self.ids.size + np.arange(len(special))
            total[which] = 1
            self.ids.extend(np.array([x for _, x in special]))
        self.starts.extend(begin)
        self.counts.extend(total)

    def pieces_of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Piece numbers of all texts, flat, and how many each text has."""
        if len(self.pieces) > CACHE_PIECES or self.chars > CACHE_CHARS:
            self.restart()
        flat: list = []
        per_text = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            parts = self._cut(text or "")
            per_text[i] = len(parts)
            flat += parts
        numbers = self.pieces.numbers(flat)
        self._learn()
        return numbers, per_text

    def count(self, texts: list[str | None]) -> np.ndarray:
        """Number of tokens of each text."""
        numbers, per_text = self.pieces_of(texts)
        return sums(self.counts.view[numbers], per_text)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and how many each text has."""
        numbers, per_text = self.pieces_of(texts)
        counts = self.counts.view[numbers]
        return self.ids.view[ragged_take(self.starts.view, self.counts.view, numbers)], sums(counts, per_text)


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One per worker process and vocabulary; its cache lasts for a task."""
    own = Encoder(path, pattern)
    held(own.restart)
    return own
