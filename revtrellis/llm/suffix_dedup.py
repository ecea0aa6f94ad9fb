"""Removal of repeated byte strings by suffix sorting with bucket-pointer refinement.

A window is `length` consecutive bytes of one document. A byte is removed if a window covers it that also starts
earlier (in a document with a smaller id, or earlier in the same one), judged on the texts as they come.

1. Anchors. Each window has the smallest hash of its `gram`-byte strings as its anchor, so equal windows have equal
   anchors and only about every 35th string is one. Anchors that occur once rule their windows out.
2. Segments. Neighbouring windows with one anchor form a segment; the segments of an anchor meet in the anchor's shard.
3. Suffix sorting. A shard sorts the suffixes of its segments as deep as a window: first into buckets by 8 bytes,
   then each bucket by the bucket pointers of the suffixes 8, 16 and 32 bytes further on, each time with the pointers
   just updated, and last by those length - 64 bytes further on. Suffixes alone in their bucket are done. What ends in
   one bucket are equal windows; all but the first of them are to be removed. A shard is sorted in parts of whole
   anchors of about PART bytes, which bounds its memory.
4. Anchors that occur very often (in 255 places or more) could gather any number of segments in one shard. Their
   windows are compared one by one instead: as 96 bits of fingerprints, dealt by the fingerprint of the whole window, of
   which a block asks each only once. Equal windows have equal anchors, so the two ways never divide equal windows.

Anchors, segments and fingerprints travel as packed questions (see blocks.py).

Defined results: a null text counts as empty; documents shorter than a window lose nothing; rows with one id are ordered
by text; a null id counts as the largest. What stays need not be valid UTF-8, so it is returned as bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from revtrellis.llm import blocks
from revtrellis.llm.blocks import MANY, Block
from revtrellis.llm.wordhash import byte_values, mix, run_hashes, sliding_max, sliding_min

LENGTH = 100
GRAM = 32
PIECE = 1 << 19
PART = 1 << 19
TOP = np.uint64(2**64 - 1)


@dataclass
class Piece:
    """Whole texts one after another, or a part of a long one; windows start in `doc` at `place`."""

    data: np.ndarray
    doc: np.ndarray
    place: np.ndarray
    inside: np.ndarray


def pieces(texts: list[bytes], length: int) -> Iterator[Piece]:
    """Every window of every text, each in one piece."""

    def piece(parts: list[tuple[int, int, bytes]]) -> Piece:
        data = np.frombuffer(b"".join(t for _, _, t in parts), np.uint8)
        sizes = np.array([len(t) for _, _, t in parts])
        number = np.repeat(np.arange(len(parts)), sizes)
        n = max(len(data) - length + 1, 0)
        starts = np.cumsum(sizes) - sizes
        place = np.arange(n) - (starts - np.array([b for _, b, _ in parts]))[number[:n]]
        return Piece(data, np.array([d for d, _, _ in parts])[number[:n]], place, number[:n] == number[length - 1 :] if n else np.zeros(0, bool))

    held: list[tuple[int, int, bytes]] = []
    size = 0
    for d, text in enumerate(texts):
        if len(text) < length:
            continue
        if held and size + len(text) > PIECE:
            yield piece(held)
            held, size = [], 0
        if len(text) > 2 * PIECE:
            for at in range(0, len(text) - length + 1, PIECE):
                yield piece([(d, at, text[at : at + PIECE + length - 1])])
        else:
            held.append((d, 0, text))
            size += len(text)
    if held:
        yield piece(held)


def _anchors(p: Piece, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each string of `gram` bytes; anchor of each window, 0 where it does not lie in one text."""
    hashes = np.minimum(np.maximum(run_hashes(byte_values(p.data), gram), np.uint64(1)), TOP - np.uint64(1))
    anchor = sliding_min(hashes, length - gram + 1)
    anchor[~p.inside] = 0
    return hashes, anchor


class AskAnchors:
    columns = {"hash": "hash", "count": "hash"}

    def __init__(self, length: int, gram: int):
        self.length, self.gram = length, gram

    def __call__(self, block: Block) -> dict[str, np.ndarray]:
        found = [np.zeros(0, np.uint64)]
        width = self.length - self.gram + 1
        for p in pieces(block.texts, self.length):
            hashes, anchor = _anchors(p, self.length, self.gram)
            pad = np.zeros(width - 1, np.uint64)
            found.append(hashes[sliding_max(np.concatenate([pad, anchor, pad]), width) == hashes])
        # Anchors are small hashes; mixed once more they spread evenly over the shards.
        values, counts = np.unique(mix(np.concatenate(found)), return_counts=True)
        return {"hash": values, "count": np.minimum(counts, MANY).astype(np.uint8)}


class Segments:
    """The windows of a block whose anchor recurs: segments of neighbours, and single windows of anchors that occur very often."""

    def __init__(self, block: Block, told: pa.Table, length: int, gram: int, shards: int):
        asked = AskAnchors(length, gram)(block)["hash"]
        again, often = (blocks.bits_told(told, c, asked, shards) for c in ("again", "often"))
        known, known_often = asked[again], often[again]
        anchors, docs, places, sizes, texts = [], [], [], [], []
        singles: list[tuple[np.ndarray, ...]] = []
        for p in pieces(block.texts, length):
            if not len(known):
                break
            _, anchor = _anchors(p, length, gram)
            edge = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
            value = mix(anchor[edge])
            size = np.diff(np.append(edge, len(anchor)))
            at = np.minimum(np.searchsorted(known, value), len(known) - 1)
            good = known[at] == value
            light = good & ~known_often[at]
            raw = p.data.tobytes()
            for e, n in zip(edge[light].tolist(), size[light].tolist()):
                texts.append(raw[e : e + n + length - 1])
            anchors.append(value[light])
            docs.append(p.doc[edge[light]])
            places.append(p.place[edge[light]])
            sizes.append(size[light])
            heavy = np.flatnonzero(np.repeat(good & known_often[at], size))
            if len(heavy):
                values = byte_values(p.data)
                singles.append((p.doc[heavy], p.place[heavy], run_hashes(values, length)[heavy], (run_hashes(values, length, 1)[heavy] >> np.uint64(32)).astype(np.uint32)))
        join = lambda x, kind: np.concatenate([*x, np.zeros(0, kind)]).astype(kind)
        self.anchor, self.doc, self.place, self.size, self.text = join(anchors, np.uint64), join(docs, np.int64), join(places, np.int64), join(sizes, np.int64), texts
        first: dict[bytes, int] = {}
        self.same = np.array([first.setdefault(t, i) for i, t in enumerate(texts)], np.int64)
        own = np.flatnonzero(self.same == np.arange(len(texts)))
        #: segments asked about: of equal ones the first, by anchor
        self.asked = own[np.argsort(self.anchor[own], kind="stable")]
        columns = list(zip(*singles)) if singles else [[]] * 4
        self.w_doc, self.w_place, self.w_hash, self.w_check = (join(c, k) for c, k in zip(columns, (np.int64, np.int64, np.uint64, np.uint32)))
        order = np.lexsort((self.w_check, self.w_hash))
        h, c = self.w_hash[order], self.w_check[order]
        new = np.append(True, (h[1:] != h[:-1]) | (c[1:] != c[:-1]))[: len(h)]
        self.w_first = order[np.flatnonzero(new)]


class AskSegments:
    columns = {"anchor": "anchor", "size": "anchor", "first": "anchor", "text": "anchor", "window": "window", "check": "window", "window_first": "window"}

    def __init__(self, length: int, gram: int, shards: int):
        self.settings = (length, gram, shards)

    def __call__(self, block: Block, told: pa.Table) -> dict:
        s = Segments(block, told, *self.settings)
        return {
            "anchor": s.anchor[s.asked],
            "size": s.size[s.asked].astype(np.int32),
            "first": block.order[s.doc[s.asked]],
            "text": [s.text[i] for i in s.asked.tolist()],
            "window": s.w_hash[s.w_first],
            "check": s.w_check[s.w_first],
            "window_first": block.order[s.w_doc[s.w_first]],
        }


def bucket_pointers(text: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """Bucket pointer of each position's suffix, sorted as deep as `length` bytes where a window starts.

    last[p] is the last window start of the segment that holds p. A pointer is the place of the bucket's first suffix in
    the suffix array; suffixes that no window needs at a depth are not refined to it.
    """
    n = len(text) - 7
    key = text.astype(np.uint64)
    for step in (1, 2, 4):
        key = (key[: len(key) - step] << np.uint64(8 * step)) | key[step:]
    position = np.arange(n)

    def split(at: np.ndarray, slots: np.ndarray, keys: np.ndarray) -> None:
        """Sort the suffixes `at` by key into their slots and point them to the first slot of their key."""
        order = np.argsort(keys, kind="stable")
        sorted_keys = keys[order]
        new = np.append(True, sorted_keys[1:] != sorted_keys[:-1])
        pointer[at[order]] = slots[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]

    pointer = np.zeros(n, np.int64)
    split(position, position, key)
    depth = 8
    while depth < length:
        step = min(depth, length - depth)
        size = np.bincount(pointer, minlength=n)
        # A window that starts at or before last[p] needs p at depth + step if p is this near.
        at = np.flatnonzero((size[pointer] > 1) & (position <= last[:n] + length - depth - step) & (position + step < n))
        if not len(at):
            break
        # Refined and unrefined suffixes of a bucket may be mixed; the refined ones take its slots from the end.
        own = pointer[at]
        order = np.argsort(own, kind="stable")
        rank = np.arange(len(at)) - np.searchsorted(own[order], own[order], "left")
        count = np.bincount(own, minlength=n)
        slots = np.empty(len(at), np.int64)
        slots[order] = own[order] + (size - count)[own[order]] + rank
        by_bucket = at[order]
        split(by_bucket, slots[order], (pointer[by_bucket].astype(np.uint64) << np.uint64(32)) | pointer[by_bucket + step].astype(np.uint64))
        depth += step
    return pointer


def later_windows(texts: list[bytes], sizes: list[int], length: int) -> np.ndarray:
    """For each window of the segments, one after another: does an equal one stand before it?"""
    first: dict[bytes, int] = {}
    own = [i for i, t in enumerate(texts) if first.setdefault(t, i) == i]
    total = np.cumsum([0, *sizes])
    out = np.ones(int(total[-1]), bool)  # the windows of a segment met before stand before
    text = np.frombuffer(b"".join([texts[i] for i in own]), np.uint8)
    lengths = np.array([len(texts[i]) for i in own])
    starts = np.cumsum(lengths) - lengths
    counts = np.array([sizes[i] for i in own])
    pointer = bucket_pointers(text, np.repeat(starts + counts - 1, lengths), length)
    windows = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    _, index = np.unique(pointer[windows], return_index=True)
    later = np.ones(len(windows), bool)
    later[index] = False
    places = np.repeat(total[own] - (np.cumsum(counts) - counts), counts) + np.arange(len(windows))
    out[places] = later
    return out


def _judge(asked: DataFrame, length: int) -> DataFrame:
    """Answers: `later` per window of each segment; `mine` per single window: does it stand first in the asking block."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        anchor, counts = blocks.joined(rows, "anchor", "<u8")
        size, _ = blocks.joined(rows, "size", "<i4")
        first, _ = blocks.joined(rows, "first", "<i8")
        lengths = size.astype(np.int64) + length - 1
        ends = np.cumsum(lengths)
        text = b"".join(rows.column("text").to_pylist())
        windows_before = np.append(0, np.cumsum(size, dtype=np.int64))
        later = np.zeros(int(windows_before[-1]), bool)
        order = np.lexsort((first, anchor))  # stable: then in the order asked
        new = np.flatnonzero(np.append(True, anchor[order][1:] != anchor[order][:-1]))[: len(order)].tolist()
        volume = np.append(0, np.cumsum(lengths[order]))
        a = 0
        while a < len(order):
            stop = next((x for x in new[np.searchsorted(new, a, "right") :] if volume[x] - volume[a] >= PART), len(order))
            part = order[a:stop]
            found = later_windows([text[ends[i] - lengths[i] : ends[i]] for i in part.tolist()], size[part].tolist(), length)
            spots = np.repeat(windows_before[part] - (np.cumsum(size[part]) - size[part]), size[part]) + np.arange(len(found))
            later[spots] = found
            a = stop
        per_row = np.add.reduceat(np.append(size.astype(np.int64), 0), np.append(0, np.cumsum(counts))[:-1]) if len(size) else np.zeros(len(counts), np.int64)
        per_row[counts == 0] = 0

        h, sizes = blocks.joined(rows, "window", "<u8")
        check, _ = blocks.joined(rows, "check", "<u4")
        w_first, _ = blocks.joined(rows, "window_first", "<i8")
        order = np.lexsort((w_first, check, h))
        sh, sc = h[order], check[order]
        mine = np.empty(len(h), bool)
        mine[order] = np.append(True, (sh[1:] != sh[:-1]) | (sc[1:] != sc[:-1]))[: len(h)]
        return pa.table(
            {
                "block": rows.column("block"),
                "shard": rows.column("shard"),
                "later": pa.array(blocks.bits_by_row(later, per_row), pa.binary()),
                "mine": pa.array(blocks.bits_by_row(mine, sizes), pa.binary()),
            }
        )

    return asked.groupBy("shard").applyInArrow(run, "block int, shard int, later binary, mine binary")


class Remove:
    def __init__(self, length: int, gram: int, shards: int, digest: bool):
        self.length, self.settings, self.digest = length, (length, gram, shards), digest

    def __call__(self, block: Block, told: pa.Table, judged: pa.Table) -> dict[str, list]:
        s, shards = Segments(block, told, *self.settings), self.settings[2]
        bits = blocks.bits_told(judged, "later", s.anchor[s.asked], shards, s.size[s.asked])
        # of a segment met before in the block all windows are later ones
        ends = np.cumsum(s.size)
        gone = np.ones(int(ends[-1]) if len(ends) else 0, bool)
        asked_size = s.size[s.asked]
        gone[np.repeat(ends[s.asked] - asked_size - (np.cumsum(asked_size) - asked_size), asked_size) + np.arange(len(bits))] = bits
        within = np.arange(len(gone)) - np.repeat(ends - s.size, s.size)
        doc, place = np.repeat(s.doc, s.size)[gone], (np.repeat(s.place, s.size) + within)[gone]

        mine = blocks.bits_told(judged, "mine", s.w_hash[s.w_first], shards)
        stays = np.zeros(len(s.w_doc), bool)
        stays[s.w_first[mine]] = True
        doc, place = np.concatenate([doc, s.w_doc[~stays]]), np.concatenate([place, s.w_place[~stays]])
        order = np.argsort(doc, kind="stable")
        doc, place = doc[order], place[order]
        edges = np.searchsorted(doc, np.arange(len(block.texts) + 1))
        out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
        for d, text in enumerate(block.texts):
            kept, removed, spans = text, 0, 0
            if edges[d] < edges[d + 1]:
                at = place[edges[d] : edges[d + 1]]
                difference = np.bincount(at, minlength=len(text) + 1) - np.bincount(at + self.length, minlength=len(text) + 1)
                covered = np.cumsum(difference[:-1]) > 0
                removed = int(covered.sum())
                spans = int(covered[0]) + int((covered[1:] & ~covered[:-1]).sum())
                kept = np.frombuffer(text, np.uint8)[~covered].tobytes()
            out["n_bytes"].append(len(text))
            out["n_removed"].append(removed)
            out["n_spans"].append(spans)
            out["kept"].append(hashlib.sha256(kept).hexdigest() if self.digest else kept)
        return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, digest: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and `kept`, the bytes that stay (or their SHA-256)."""
    if not 8 <= gram <= length or length < 9:
        raise ValueError("windows have 9 bytes or more, strings for anchors 8 to the window's length")
    shards = blocks.shard_count(docs.sparkSession)
    dealt = blocks.dealt(docs, id_col, text_col)
    anchors = blocks.recurring(blocks.ask(dealt, AskAnchors(length, gram), shards))
    judged = _judge(blocks.ask(dealt, AskSegments(length, gram, shards), shards, anchors), length)
    remove = Remove(length, gram, shards, digest)
    both = anchors.unionByName(judged, allowMissingColumns=True)

    def result(block: Block, told: pa.Table) -> dict[str, list]:
        is_judged = told.column("mine").is_valid()
        return remove(block, told.filter(pc.invert(is_judged)), told.filter(is_judged))

    return blocks.finish(dealt, both, result, [("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept", "string" if digest else "binary")])
