"""BPE encoding and decoding as streaming transducers.

Encoding. A text passes three machines, none of which keeps more than a bounded piece of it:

1. special tokens cut the text;
2. the pre-tokeniser's pattern cuts what lies between into pieces, a slab at a time;
3. a piece becomes tokens. A short piece is merged at once. A long one is merged in windows: the merge list has a
   sufficient lookahead (`lookahead`), the number of bytes to the right of a token that can still change it, so a
   token is emitted as soon as that many bytes lie behind it, and the window goes on from the last emitted boundary.
   Tokens to the right of a final boundary do not depend on what is to its left, because no merge crosses it.

Decoding. Each id is mapped to its bytes and an incremental UTF-8 machine turns bytes into text, with U+FFFD for
what is not valid, keeping at most three bytes between tokens.

The vocabulary's path is a parameter. Defined results: a null text counts as empty, an empty text has no tokens.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from revtrellis.llm.common import ship, slices

#: Fixed value: the pattern by which byte-level BPE cuts texts.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts within Latin-1, whose letters, numbers and white space are told one by one.
_LETTERS, _NUMBERS, _BLANKS = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
LATIN_PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_BLANKS}{_LETTERS}{_NUMBERS}]+|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
SLAB = 1 << 18
SHORT = 48
WINDOW = 4096
KEPT_PIECES = 300_000


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for the 256 bytes in vocabularies: visible Latin-1 for itself, the rest from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Token bytes, merges and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_alphabet()
        self.ids = {bytes(letters[x] for x in token): i for token, i in spec["model"]["vocab"].items()}
        self.bytes = {i: token for token, i in self.ids.items()}
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.bytes |= {i: text.encode() for text, i in self.specials.items()}
        raw = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.merges = [tuple(bytes(letters[x] for x in half) for half in m) for m in raw]
        self.ranks = {pair: i for i, pair in enumerate(self.merges)}
        self.lookahead = lookahead(self.merges)


def lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes to the right of a token that can change it, at most, for this merge list.

    need[t]: bytes behind t's end that decide whether t forms. They decide whether its right half forms, and whether
    an earlier rule takes that half away from it: such a rule (right half, x) matters as far as x and the bytes that
    decide x reach. Rules only look at earlier ones, so one pass in rank order finds all. Afterwards a formed token
    can still be taken by any rule that has it as its left half.
    """
    need: dict[bytes, int] = {}
    rivals: dict[bytes, int] = {}  # of the rules so far with this left half: how far the farthest reaches
    for left, right in merges:
        reach = max(need.get(right, 0), rivals.get(right, 0))
        whole = left + right
        need[whole] = max(need.get(whole, 0), reach)
        rivals[left] = max(rivals.get(left, 0), len(right) + reach)
    return max((need.get(t, 0) if r == 0 else max(need.get(t, 0), r) for t, r in rivals.items()), default=0)


def merge_piece(piece: bytes, ranks: dict[tuple[bytes, bytes], int]) -> list[bytes]:
    """Tokens of a whole piece: always the lowest-ranked pair, the leftmost of equals."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    if len(parts) <= SHORT:
        rank, never = ranks.get, len(ranks)
        found = [rank(pair, never) for pair in zip(parts, parts[1:])]
        while found and (best := min(found)) < never:
            i = found.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del found[i]
            if i:
                found[i - 1] = rank((parts[i - 1], parts[i]), never)
            if i < len(found):
                found[i] = rank((parts[i], parts[i + 1]), never)
        return parts
    after, before = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
    heap = [(r, i, p) for i, p in enumerate(zip(parts, parts[1:])) if (r := ranks.get(p)) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i]
        if j < 0 or (parts[i], parts[j]) != pair:
            continue
        parts[i], parts[j], after[i] = parts[i] + parts[j], b"", after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for a in (before[i], i):
            if a >= 0 and after[a] >= 0 and (r := ranks.get(new := (parts[a], parts[after[a]]))) is not None:
                heapq.heappush(heap, (r, a, new))
    return [p for p in parts if p]


class Encoder(dict):
    """Piece -> its ids as little-endian unsigned 32-bit integers. Pieces seen often stay; their number is bounded."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.packed = {token: int(i).to_bytes(4, "little") for token, i in vocabulary.ids.items()}
        self.find, self.find_latin = regex.compile(PIECES).findall, re.compile(LATIN_PIECES).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary.specials, key=len, reverse=True))) + ")").split if vocabulary.specials else None

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode()
        out = self.packed.get(raw) if len(raw) < 2 else None
        if out is None:
            out = b"".join(map(self.packed.__getitem__, self.stable_tokens(raw)))
        if len(raw) <= SHORT and len(self) < KEPT_PIECES:
            self[piece] = out
        return out

    def stable_tokens(self, raw: bytes) -> Iterator[bytes]:
        """Tokens of a piece, each emitted once nothing to its right can change it."""
        ahead, at = self.vocabulary.lookahead, 0
        size = max(WINDOW, 4 * ahead)
        while at < len(raw):
            last = at + size >= len(raw)
            tokens = merge_piece(raw[at : at + size], self.vocabulary.ranks)
            stable = len(raw) if last else at + size - ahead
            for token in tokens:
                if at + len(token) > stable:
                    break
                at += len(token)
                yield token
            else:
                if last:
                    return

    def pieces(self, text: str) -> Iterator[list[str]]:
        """Pieces of a text without special tokens, a slab at a time. The last two of a slab may still grow."""
        at, size = 0, SLAB
        while at < len(text):
            slab = text[at : at + size]
            found = (self.find_latin if slab.isascii() or max(slab) <= "\xff" else self.find)(slab)
            if at + size < len(text):
                if len(found) <= 2:
                    size *= 2
                    continue
                found = found[:-2]
            yield found
            at += sum(map(len, found))
            size = SLAB

    def encode(self, text: str) -> Iterator[bytes]:
        """Packed ids of a text, slab by slab."""
        parts = self.cut(text) if self.cut else [text]
        for i, part in enumerate(parts):
            if i % 2:
                yield self.vocabulary.specials[part].to_bytes(4, "little")
            else:
                for found in self.pieces(part):
                    yield b"".join(map(self.__getitem__, found))


class Decoder:
    """Ids -> text, by an incremental byte-to-text machine."""

    def __init__(self, vocabulary: Vocabulary):
        self.bytes = [vocabulary.bytes.get(i, b"") for i in range(max(vocabulary.bytes) + 1)]

    def decode(self, packed: Iterable[bytes]) -> Iterator[str]:
        machine = codecs.getincrementaldecoder("utf-8")(errors="replace")
        for part in packed:
            yield machine.decode(b"".join(map(self.bytes.__getitem__, np.frombuffer(part, "<u4").tolist())))
        yield machine.decode(b"", final=True)


@functools.lru_cache(maxsize=2)
def _machines(path: str) -> tuple[Encoder, Decoder]:
    vocabulary = Vocabulary(path)
    return Encoder(vocabulary), Decoder(vocabulary)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, `ids` (packed unsigned 32-bit, little-endian) and `n_tokens`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = _machines(path)
        for batch in slices(batches):
            ids = [b"".join(encoder.encode(t)) if t else b"" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.large_binary()).cast(pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())], names=[id_col, "ids", "n_tokens"])

    ship(docs.sparkSession)
    picked = docs.select(id_col, text_col)
    return picked.mapInArrow(run, f"{id_col} {picked.schema[id_col].dataType.simpleString()}, ids binary, n_tokens bigint")


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per document: its id and the text that its packed ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _machines(path)
        for batch in slices(batches):
            texts = ["".join(decoder.decode([x or b""])) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    ship(tokens.sparkSession)
    picked = tokens.select(id_col, ids_col)
    return picked.mapInArrow(run, f"{id_col} {picked.schema[id_col].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Encode each text and decode its ids again, slab by slab: id, n_tokens, ids, decoded text, or SHA-256 digests of the last two.

    With digests nothing of a text's size is kept beside the text itself: both machines feed the digests as they go.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _machines(path)
        for batch in slices(batches):
            rows: list[tuple] = []
            for text in batch.column(1).to_pylist():
                n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
                kept: list[bytes] = []

                def fed() -> Iterator[bytes]:
                    nonlocal n
                    for part in encoder.encode(text or ""):
                        n += len(part) // 4
                        ids.update(part)
                        if not digest:
                            kept.append(part)
                        yield part

                if digest:
                    for out in decoder.decode(fed()):
                        decoded.update(out.encode())
                    rows.append((n, ids.hexdigest(), decoded.hexdigest()))
                else:
                    out = "".join(decoder.decode(fed()))
                    rows.append((n, b"".join(kept), out))
            n_tokens, ids_out, text_out = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_tokens, pa.int64()), pa.array(ids_out, pa.string() if digest else pa.binary()), pa.array(text_out, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256" if digest else "ids", "decoded_sha256" if digest else "decoded"],
            )

    ship(docs.sparkSession)
    picked = docs.select(id_col, text_col)
    kind = picked.schema[id_col].dataType.simpleString()
    return picked.mapInArrow(run, f"{id_col} {kind}, n_tokens bigint, " + ("ids_sha256 string, decoded_sha256 string" if digest else "ids binary, decoded string"))
