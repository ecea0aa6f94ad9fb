"""Removal of repeated passages by repeated-phrase automata.

A window is `length` consecutive words of one document. A word is removed if a window covers it whose words also start
earlier (in a document with a smaller id, or earlier in the same one), judged on the texts as they come.

1. Anchors. Each window has the smallest hash of its phrases of `phrase` words as its anchor, so equal windows have
   equal anchors, and only about every sixth phrase is one. Anchors that occur once rule their windows out.
2. Confirmation. The other windows are compared over all documents by 96 bits of two fingerprints; those that recur are
   confirmed, and the first document of each is found.
3. Automata. In each block of documents the confirmed windows that touch or overlap form passages. The block's passages
   are compiled into Aho-Corasick automata of at most `shard_words` words, words being letters of the automaton, and
   all its documents are streamed through them; leftmost-longest matches locate every occurrence word by word.
4. In each occurrence the windows that are not the first of their kind remove their words.

Steps 1 and 2 travel as packed questions (see blocks.py).

Defined results: null or blank texts have no words; documents shorter than a window lose nothing; rows with one id are
ordered by text, so of two equal rows the second loses what a copy would lose; a null id counts as the largest.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from revtrellis.llm import blocks
from revtrellis.llm.blocks import MANY, Block
from revtrellis.llm.wordhash import SPACE, Words, mix, run_hashes, sliding_max, sliding_min, words_of

LENGTH = 20
PHRASE = 10
SHARD_WORDS = 1_000_000
TOP = np.uint64(2**64 - 1)


def _anchors(w: Words, length: int, phrase: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each phrase; anchor of each window (0 for windows across texts); which windows lie in one text; which phrases are anchors."""
    hashes = np.maximum(run_hashes(w.hashes, phrase), np.uint64(1))
    inside = w.same_text(length)
    if not len(inside):
        return hashes, hashes[:0], inside, np.zeros(len(hashes), bool)
    hashes[~w.same_text(phrase)] = TOP
    width = length - phrase + 1
    anchor = sliding_min(hashes, width)
    anchor[~inside] = 0
    pad = np.zeros(width - 1, np.uint64)
    best = sliding_max(np.concatenate([pad, anchor, pad]), width)
    return hashes, anchor, inside, best == hashes


class AskAnchors:
    columns = {"hash": "hash", "count": "hash"}

    def __init__(self, length: int, phrase: int):
        self.length, self.phrase = length, phrase

    def __call__(self, block: Block) -> dict[str, np.ndarray]:
        found = [np.zeros(0, np.uint64)]
        for w in words_of(block.texts, SPACE):
            hashes, _, _, is_anchor = _anchors(w, self.length, self.phrase)
            found.append(hashes[is_anchor])
        # Anchors are small hashes; mixed once more they spread evenly over the shards.
        values, counts = np.unique(mix(np.concatenate(found)), return_counts=True)
        return {"hash": values, "count": np.minimum(counts, MANY).astype(np.uint8)}


class Candidates:
    """Windows whose anchor recurs, of the documents of a block, in order: document, word, fingerprints."""

    def __init__(self, block: Block, told: pa.Table, length: int, phrase: int, shards: int):
        asked = AskAnchors(length, phrase)(block)["hash"]
        again = asked[blocks.bits_told(told, "again", asked, shards)]
        docs, places, prints, checks = [], [], [], []
        for w in words_of(block.texts, SPACE):
            _, anchor, inside, _ = _anchors(w, length, phrase)
            if not len(anchor) or not len(again):
                continue
            # Neighbours mostly share their anchor, so each run of one value is looked up once.
            edge = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
            value = mix(anchor[edge])
            at = np.minimum(np.searchsorted(again, value), len(again) - 1)
            keep = np.flatnonzero(np.repeat(again[at] == value, np.diff(np.append(edge, len(anchor)))) & inside)
            if len(keep):
                docs.append(w.lo + np.searchsorted(w.first, keep, "right") - 1)
                places.append(keep - w.first[docs[-1] - w.lo])
                prints.append(run_hashes(w.hashes, length)[keep])
                checks.append((run_hashes(w.hashes, length, 1)[keep] >> np.uint64(32)).astype(np.uint32))
        join = lambda x, kind: np.concatenate([*x, np.zeros(0, kind)]).astype(kind)
        self.doc, self.place, self.hash, self.check = join(docs, np.int64), join(places, np.int64), join(prints, np.uint64), join(checks, np.uint32)
        # kind: the distinct windows of the block by (hash, check); first: where each stands first
        order = np.lexsort((self.check, self.hash))
        h, c = self.hash[order], self.check[order]
        new = np.append(True, (h[1:] != h[:-1]) | (c[1:] != c[:-1]))[: len(h)]
        self.kind = np.empty(len(h), np.int64)
        self.kind[order] = np.cumsum(new) - 1
        self.first = order[np.flatnonzero(new)]  # lexsort is stable
        self.count = np.bincount(self.kind, minlength=len(self.first))


class AskWindows:
    columns = {"hash": "hash", "check": "hash", "first": "hash", "more": "hash"}

    def __init__(self, length: int, phrase: int, shards: int):
        self.settings = (length, phrase, shards)

    def __call__(self, block: Block, told: pa.Table) -> dict[str, np.ndarray]:
        c = Candidates(block, told, *self.settings)
        return {
            "hash": c.hash[c.first],
            "check": c.check[c.first],
            "first": block.order[c.doc[c.first]],
            "more": (c.count > 1).astype(np.uint8),
        }


def _confirm(asked: DataFrame) -> DataFrame:
    """Answers: `again`, does the window recur; `mine`, does it stand first in the asking block. Carries nothing else."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        h, sizes = blocks.joined(rows, "hash", "<u8")
        check, _ = blocks.joined(rows, "check", "<u4")
        first, _ = blocks.joined(rows, "first", "<i8")
        more, _ = blocks.joined(rows, "more", "u1")
        order = np.lexsort((first, check, h))
        sh, sc = h[order], check[order]
        new = np.append(True, (sh[1:] != sh[:-1]) | (sc[1:] != sc[:-1]))
        group = np.cumsum(new) - 1
        totals = np.bincount(group, weights=1 + more[order])
        again, mine = np.empty(len(h), bool), np.empty(len(h), bool)
        again[order] = totals[group] > 1
        mine[order] = new  # one id is in one block, so no two rows of a group share their first document
        return pa.table(
            {
                "block": rows.column("block"),
                "shard": rows.column("shard"),
                "again": pa.array(blocks.bits_by_row(again, sizes), pa.binary()),
                "mine": pa.array(blocks.bits_by_row(mine, sizes), pa.binary()),
            }
        )

    return asked.groupBy("shard").applyInArrow(run, "block int, shard int, again binary, mine binary")


def _locate(texts: dict[int, str], passages: dict[str, int], shard_words: int):
    """(document, first word, passage) of every leftmost-longest occurrence, automaton by automaton."""
    todo = list(passages.items())
    while todo:
        automaton, size = ahocorasick.Automaton(), 0
        while todo and (not size or size + len(todo[-1][0]) <= shard_words):
            text, number = todo.pop()
            automaton.add_word(text, (number, len(text)))
            size += len(text)
        automaton.make_automaton()
        for doc, text in texts.items():
            for end, (number, n) in automaton.iter_long(text):
                yield doc, end + 1 - n, number


class Remove:
    def __init__(self, length: int, phrase: int, shards: int, shard_words: int, digest: bool):
        self.length, self.settings, self.shard_words, self.digest = length, (length, phrase, shards), shard_words, digest

    def passages(self, c: Candidates, again: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last (exclusive) entry in c of the confirmed windows that form one passage: of one document, touching or overlapping."""
        at = np.flatnonzero(again[c.kind])
        if not len(at):
            return at, at
        apart = np.flatnonzero((c.doc[at][1:] != c.doc[at][:-1]) | (c.place[at][1:] - c.place[at][:-1] > self.length)) + 1
        return np.append(0, apart), np.append(apart, len(at))

    def __call__(self, block: Block, told: pa.Table, windows_told: pa.Table) -> dict[str, list]:
        length = self.length
        c = Candidates(block, told, *self.settings)
        again = blocks.bits_told(windows_told, "again", c.hash[c.first], self.settings[2])
        mine = blocks.bits_told(windows_told, "mine", c.hash[c.first], self.settings[2])
        at = np.flatnonzero(again[c.kind])
        begins, stops = self.passages(c, again)
        letters: dict[bytes, int] = {}
        words: dict[int, list[bytes]] = {}
        for d in np.unique(c.doc[at]).tolist():
            words[d] = block.texts[d].split()
        known: dict[tuple, int] = {}
        content: list[tuple[np.ndarray, np.ndarray]] = []
        spelled: dict[str, int] = {}
        for a, b in zip(begins.tolist(), stops.tolist()):
            mine_at = at[a:b]
            d, s, e = int(c.doc[mine_at[0]]), int(c.place[mine_at[0]]), int(c.place[mine_at[-1]]) + length
            key = tuple(words[d][s:e])
            if key not in known:
                known[key] = len(content)
                content.append((c.place[mine_at] - s, c.kind[mine_at]))
                for word in key:
                    if word not in letters:
                        letters[word] = len(letters) + 1
        # A letter is a code point; surrogates are left out. A block has far fewer words than there are code points.
        code = lambda i: chr(i if i < 0xD800 else i + 0x800)
        if len(letters) > 1_000_000:
            raise ValueError("too many words in one block: raise spark.sql.shuffle.partitions")
        alphabet = {word: code(i) for word, i in letters.items()}
        for key, number in known.items():
            spelled["".join(map(alphabet.__getitem__, key))] = number
        texts = {d: "".join([alphabet.get(x, "\0") for x in w]) for d, w in words.items()}
        docs, places, kinds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for d, start, number in _locate(texts, spelled, self.shard_words):
            offsets, kind = content[number]
            docs.append(np.full(len(kind), d))
            places.append(start + offsets)
            kinds.append(kind)
        doc, place, kind = np.concatenate(docs), np.concatenate(places), np.concatenate(kinds)
        order = np.lexsort((place, doc, kind))
        doc, place, kind = doc[order], place[order], kind[order]
        fresh = np.append(True, (doc[1:] != doc[:-1]) | (place[1:] != place[:-1]) | (kind[1:] != kind[:-1]))[: len(kind)]
        doc, place, kind = doc[fresh], place[fresh], kind[fresh]
        first = np.append(True, kind[1:] != kind[:-1])[: len(kind)]
        gone = ~(first & mine[kind])
        by_doc: dict[int, np.ndarray] = {}
        doc, place = doc[gone], place[gone]
        order = np.argsort(doc, kind="stable")
        doc, place = doc[order], place[order]
        edges = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))[: len(doc)]
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(doc)]):
            by_doc[int(doc[a])] = place[a:b]
        out: dict[str, list] = {"n_words": [], "n_removed": [], "kept": []}
        for d, text in enumerate(block.texts):
            own = words.get(d) or text.split()
            removed = 0
            kept = own
            if d in by_doc:
                difference = np.zeros(len(own) + 1, np.int64)
                np.add.at(difference, by_doc[d], 1)
                np.add.at(difference, by_doc[d] + length, -1)
                stay = np.cumsum(difference[:-1]) == 0
                removed = len(own) - int(stay.sum())
                kept = [own[i] for i in np.flatnonzero(stay).tolist()]
            whole = b" ".join(kept)
            out["n_words"].append(len(own))
            out["n_removed"].append(removed)
            out["kept"].append(hashlib.sha256(whole).hexdigest() if self.digest else whole.decode())
        return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, phrase: int = PHRASE, shard_words: int = SHARD_WORDS, digest: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and `kept`, the words that stay joined by one space (or their SHA-256)."""
    if not 0 < phrase <= length:
        raise ValueError("a phrase is a part of a window")
    shards = blocks.shard_count(docs.sparkSession)
    dealt = blocks.dealt(docs, id_col, text_col)
    anchors = blocks.recurring(blocks.ask(dealt, AskAnchors(length, phrase), shards))
    windows = _confirm(blocks.ask(dealt, AskWindows(length, phrase, shards), shards, anchors))
    remove = Remove(length, phrase, shards, shard_words, digest)
    # Both answers reach the last step side by side, told apart by what they carry.
    both = anchors.select("block", "shard", "again", "often").unionByName(windows, allowMissingColumns=True)

    def result(block: Block, told: pa.Table) -> dict[str, list]:
        is_window = told.column("mine").is_valid()
        return remove(block, told.filter(pc.invert(is_window)), told.filter(is_window))

    return blocks.finish(dealt, both, result, [("n_words", "bigint"), ("n_removed", "bigint"), ("kept", "string")])
