"""Generalised suffix automaton over word sequences, and its use on a stream of texts.

The automaton of the given items accepts every run of words of any of them. Streaming a text through it gives matching
statistics: at each word the length of the longest run ending there that occurs in an item. Only stretches that can
hold a match are walked: words outside the items' vocabulary, and pairs of neighbours that no item holds, end a match
anyway, and numpy finds those for a whole group of texts at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from revtrellis.llm.wordhash import LOWER, PUNCTUATION, Words, words_of


class SuffixAutomaton:
    def __init__(self, items: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        #: per state and item: the place in the item (exclusive end) where a run of the state first ends
        self.ends: list[dict[int, int]] = [{}]
        for k, item in enumerate(items):
            last = 0
            for i, c in enumerate(item):
                last = self._extend(last, c)
                self.ends[last].setdefault(k, i + 1)
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            mine = self.ends[self.link[v]]
            if self.link[v]:
                for k, end in self.ends[v].items():
                    mine[k] = min(mine.get(k, end), end)

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        self.ends.append({})
        return len(self.link) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The state for runs of length[p] + 1 words that end in c, taken out of q."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        known = self.next[last].get(c)
        if known is not None:
            return self._split(last, c, known)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, c, self.next[p][c])
        return new

    def walk(self, ids: list[int]) -> Iterator[tuple[int, int]]:
        """(state, length of the longest match that ends here) after each word."""
        v, n = 0, 0
        following, link, length = self.next, self.link, self.length
        for c in ids:
            t = following[v].get(c)
            while t is None and v:
                v = link[v]
                n = length[v]
                t = following[v].get(c)
            if t is None:
                n = 0
            else:
                v, n = t, n + 1
            yield v, n

    def suffix_state(self, v: int, length: int) -> int:
        """The state of the last `length` words of a match that ended in v."""
        while self.length[self.link[v]] >= length:
            v = self.link[v]
        return v


class ItemIndex:
    """Items as word sequences, their automaton, and the filter for stretches that can hold a match of at least `least` words."""

    def __init__(self, texts: list[bytes], least: int | None = None, cap: int | None = None):
        self.words: list[list[bytes]] = []
        hashes: list[np.ndarray] = []
        for w in words_of(texts, PUNCTUATION, LOWER):
            raw = w.data.tobytes()
            for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
                self.words.append([raw[s:e] for s, e in zip(w.starts[a:b].tolist(), w.ends[a:b].tolist())])
                hashes.append(w.hashes[a:b])
        self.vocabulary = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)]))
        sequences = [np.searchsorted(self.vocabulary, h).tolist() for h in hashes]
        self.items = sequences
        self.automaton = SuffixAutomaton(sequences)
        shortest = min((len(s) for s in sequences if s), default=1)
        self.least = least if least is not None else min(shortest, cap or shortest)
        pairs = {(a, b) for s in sequences for a, b in zip(s, s[1:])}
        size = max(len(self.vocabulary), 1)
        self.pairs = np.array(sorted(a * size + b for a, b in pairs), np.int64)
        self.probable = np.zeros(1 << 16, bool)
        self.probable[(self.vocabulary >> np.uint64(48)).astype(np.int64)] = True

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each word in the vocabulary, -1 for others."""
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.probable[(hashes >> np.uint64(48)).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
            good = self.vocabulary[at] == hashes[maybe]
            out[maybe[good]] = at[good]
        return out

    def stretches(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids, and first and last (exclusive) word of the stretches that can hold a match, each within one text."""
        ids = self.ids(words.hashes)
        inner = np.unique(words.first[(words.first > 0) & (words.first < len(ids))])
        if self.least <= 1:
            known = ids >= 0
            starts = np.flatnonzero(known & ~np.append(False, known[:-1]))
            stops = np.flatnonzero(known & ~np.append(known[1:], False)) + 1
            cuts = inner[known[inner] & known[inner - 1]]
            return ids, np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([stops, cuts]))
        both = (ids[:-1] >= 0) & (ids[1:] >= 0) if len(ids) > 1 else np.zeros(0, bool)
        both[inner - 1] = False
        at = np.flatnonzero(both)
        key = ids[at] * max(len(self.vocabulary), 1) + ids[at + 1]
        if len(self.pairs):
            place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            both[at] = self.pairs[place] == key
        else:
            both[:] = False
        edges = np.diff(np.concatenate([[0], both.view(np.int8), [0]]))
        starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) + 1
        long = stops - starts >= self.least
        return ids, starts[long], stops[long]
