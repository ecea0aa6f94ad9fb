"""Packing tokenised documents into as few sequences as possible by a configuration linear program.

1. Documents are encoded and cut into pieces of at most `capacity` ids; the written table has a row per piece and its
   place among the pieces of its length in its partition.
2. The lengths' histogram (at most `capacity` numbers, whatever the corpus) goes to the driver. A configuration is a
   multiset of lengths that fit into one sequence. The linear program asks for the fewest sequences, each of some
   configuration, that hold all pieces. It is solved by multiplicative weights; a knapsack by dynamic programming finds
   the dearest configuration under the weights. First the prices of the lengths are learned; any prices prove a lower bound
   (`Plan.bound`). Then each round uses its configuration for a share of its scarcest length, and lengths that lag behind
   become dearer.
3. The solution is rounded down; what is left is packed by filling, around the longest length left, as exactly as a subset sum
   can. No configuration packs more pieces than there are, so sequences have no gaps.
4. The plan (at most a few numbers per configuration) is sent to the tasks. The pieces of one length are numbered by the
   counts per partition, and a number says which sequence and place in it a piece has. So a length that a third of all
   pieces have is spread like any other, and nothing of the corpus's size reaches the driver.

Defined results: a null text counts as empty, an empty document is the end id alone; rows with one id are pieces each, and so
are those with a null id. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revtrellis.llm.bpe_stream import PIECES, Encoder, Vocabulary, byte_alphabet
from revtrellis.llm.common import ship, slices, written

CAPACITY = 2048
ROUNDS = 500
SHARES = 4  # a round uses up at most one such share of a length
PRICED = 128  # lengths that a round prices
LAG = 0.5  # how strongly prices follow the share packed
DUAL_ROUNDS = 40
STEP = 0.4  # of the prices' weights in a round
LONG_RUN = 5000


# ---------------------------------------------------------------- tokens


class Tokens:
    """Ids of texts by a byte-level BPE file whose ids are the order of its merges, so that they can serve as ranks."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_alphabet()
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ranks = {bytes(letters[x] for x in token): i for token, i in spec["model"]["vocab"].items() if token not in self.specials}
        merged = [ranks[bytes(letters[x] for half in (m if isinstance(m, list) else m.split(" ")) for x in half)] for m in spec["model"]["merges"]]
        if merged != sorted(merged) or sum(len(t) == 1 for t in ranks) != 256:
            raise ValueError("the vocabulary's ids are not in the order of its merges")
        self.path, self.encoding = path, tiktoken.Encoding("byte-level", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=self.specials)

    @functools.cached_property
    def slow(self) -> Encoder:
        return Encoder(Vocabulary(self.path))

    def encode(self, text: str) -> np.ndarray:
        if len(text) >= LONG_RUN and any(s.isspace() or len(s.split(None, 1)) < 2 for s in (text[lo : lo + LONG_RUN] for lo in range(0, len(text) - LONG_RUN + 1, LONG_RUN))):
            # Very long pieces go to the machine whose memory and time do not depend on their length.
            return np.frombuffer(b"".join(self.slow.encode(text)), "<u4")
        return np.array(self.encoding.encode(text, allowed_special="all"), "<u4")


@functools.lru_cache(maxsize=2)
def _tokens(path: str) -> Tokens:
    return Tokens(path)


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids), part and nth: its partition and its place there among the pieces of that length.

    Of a document longer than `capacity` the first piece is the one that is shorter. part and nth are only good together
    with one run of this scan, so the rows have to be written before they are counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, seen = _tokens(path), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in slices(batches):
            rows: list[tuple] = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                raw = tokens.encode(text or "").tobytes() + int(end_id).to_bytes(4, "little")
                n, at, piece = len(raw) // 4, 0, 0
                while at < n:
                    length = (n - at - 1) % capacity + 1 if piece == 0 else capacity
                    own = raw[4 * at : 4 * (at + length)]
                    rows.append((i, piece, at, length, zlib.crc32(own), seen[length], own if with_ids else None))
                    seen[length] += 1
                    at, piece = at + length, piece + 1
            of, *columns, ids = zip(*rows) if rows else ((),) * 7
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "nth", "part"] + ["ids"] * with_ids
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [batch.column(0).take(pa.array(of, pa.int64())), *[pa.array(c, k) for c, k in zip(columns, kinds)], pa.array([part] * len(rows), pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(ids, pa.binary())] * with_ids, names=names)

    ship(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, nth bigint, part int" + ", ids binary" * with_ids)


# ---------------------------------------------------------------- plan


def knapsack(lengths: np.ndarray, most: np.ndarray, values: np.ndarray, capacity: int) -> dict[int, int]:
    """Place in `lengths` -> copies: the configuration of the highest value, with at most `most` copies of each length."""
    items = []  # copies in powers of two, so that any number up to the limit can be made
    for i, (length, limit) in enumerate(zip(lengths.tolist(), most.tolist())):
        left, k = min(limit, capacity // length), 1
        while left > 0:
            k = min(k, left)
            items.append((i, k, k * length))
            left, k = left - k, 2 * k
    best = np.zeros(capacity + 1)
    taken = np.zeros((len(items), capacity + 1), bool)
    for j, (i, k, weight) in enumerate(items):
        tried = best[: capacity + 1 - weight] + k * values[i]
        np.greater(tried, best[weight:] + 1e-12, out=taken[j, weight:])
        np.maximum(best[weight:], tried, out=best[weight:])
    out: dict[int, int] = {}
    room = capacity
    for j in range(len(items) - 1, -1, -1):
        if taken[j, room]:
            i, k, weight = items[j]
            out[i] = out.get(i, 0) + k
            room -= weight
    return out


@dataclass(frozen=True)
class Plan:
    """configurations: (copies by length, number of sequences); bound: no packing has fewer sequences."""

    configurations: tuple[tuple[tuple[tuple[int, int], ...], int], ...]
    bound: int

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.configurations)


def dual_prices(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = DUAL_ROUNDS) -> tuple[np.ndarray, float]:
    """Prices and the lower bound they prove: the worth of all pieces by that of the dearest configuration.

    Prices start in proportion to the lengths. A round raises those whose share of the worth of all pieces is larger than of
    the dearest configuration's, and lowers the others.
    """
    prices = lengths / capacity
    best, bound = prices, float(counts @ lengths) / capacity
    # No two of the lengths above half the capacity fit into one sequence, and no three of half of it.
    halves = float(counts[2 * lengths > capacity].sum()) + float(counts[2 * lengths == capacity].sum()) / 2
    for _ in range(rounds):
        chosen = knapsack(lengths, counts, prices, capacity)
        used = np.zeros(len(lengths))
        for i, k in chosen.items():
            used[i] = k
        worth, top = float(counts @ prices), float(used @ prices)
        if worth / top > bound:
            best, bound = prices, worth / top
        prices = prices * np.exp(STEP * (counts * prices / worth - used * prices / top))
    return best, max(bound, halves)


def solve(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> tuple[list[tuple[dict[int, int], float]], float]:
    """Solution of the configuration linear program by multiplicative weights: configurations and how often each is used, and a lower bound."""
    left = counts.astype(float)
    found: list[tuple[dict[int, int], float]] = []
    prices, bound = dual_prices(lengths, counts, capacity)
    for _ in range(rounds):
        open_ = np.flatnonzero(left > 1e-9 * counts)
        if not len(open_):
            break
        lagging = left[open_] / counts[open_]
        weighed = prices[open_] * np.exp(LAG * (lagging - lagging.mean()))
        if len(open_) > PRICED:
            # Half of the priced lengths lag behind most, the others are taken evenly, so that a sequence can be filled.
            order = np.argsort(-lagging, kind="stable")
            rest = order[PRICED // 2 :]
            some = np.sort(np.append(order[: PRICED // 2], rest[np.linspace(0, len(rest) - 1, PRICED // 2).astype(int)]))
            open_, weighed = open_[some], weighed[some]
        best = knapsack(lengths[open_], np.ceil(left[open_]).astype(np.int64), weighed, capacity)
        chosen = {int(open_[i]): k for i, k in best.items()}
        times = min(min(left[i], counts[i] / SHARES) / k for i, k in chosen.items())
        for i, k in chosen.items():
            left[i] = max(0.0, left[i] - times * k)
        found.append((chosen, times))
    return found, bound


def _filled(lengths: np.ndarray, left: np.ndarray, capacity: int) -> dict[int, int]:
    """The longest length left, and what fills the rest of its sequence best: of a part of the lengths, of all if those leave room."""
    there = np.flatnonzero(left)
    top = int(there[-1])
    room = capacity - int(lengths[top])
    limit = left.copy()
    limit[top] -= 1
    small = there[(lengths[there] <= room) & (limit[there] > 0)]
    best: dict[int, int] = {}
    for some in [small[np.linspace(0, len(small) - 1, PRICED).astype(int)], small] if len(small) > PRICED else [small]:
        # Longer lengths come first and are worth a little more, so that short ones stay for later.
        some = some[::-1]
        found = knapsack(lengths[some], limit[some], lengths[some] * (1 + 1e-7 * lengths[some] / capacity), room)
        best = {int(some[i]): k for i, k in found.items()}
        if sum(k * int(lengths[i]) for i, k in best.items()) == room:
            break
    return best | {top: best.get(top, 0) + 1}


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> Plan:
    """Configurations that pack exactly the pieces of a histogram of lengths (1 to capacity)."""
    used: list[tuple[dict[int, int], int]] = []
    whole = histogram.get(capacity, 0)
    lengths = np.array(sorted(x for x, n in histogram.items() if n > 0 and x < capacity), np.int64)
    counts = np.array([histogram[x] for x in lengths.tolist()], np.int64)
    bound = 0.0
    if len(lengths):
        fractional, bound = solve(lengths, counts, capacity, rounds)
        left = counts.copy()
        for chosen, times in fractional:
            n = min([int(times + 1e-9), *[int(left[i]) // k for i, k in chosen.items()]])
            if n:
                used.append((chosen, n))
                for i, k in chosen.items():
                    left[i] -= n * k
        while left.any():
            chosen = _filled(lengths, left, capacity)
            n = min(int(left[i]) // k for i, k in chosen.items())
            used.append((chosen, n))
            for i, k in chosen.items():
                left[i] -= n * k
    named = [(tuple(sorted((int(lengths[i]), k) for i, k in chosen.items())), n) for chosen, n in used]
    if whole:
        named.append((((capacity, 1),), whole))
    return Plan(tuple(named), whole + int(np.ceil(bound - 1e-6)))


def _slots(made: Plan) -> np.ndarray:
    """Rows length, first, sequence, copies, offset: pieces first.. of that length go `copies` at a time into the sequences from `sequence` on."""
    rows, seen, sequence = [], {}, 0
    for chosen, n in made.configurations:
        offset = 0
        for length, k in chosen:
            rows.append((length, seen.get(length, 0), sequence, k, offset))
            seen[length] = seen.get(length, 0) + n * k
            offset += length * k
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


# ---------------------------------------------------------------- packing


def assign(written_pieces: DataFrame, made: Plan) -> DataFrame:
    """The pieces with sequence_id and offset."""
    ahead = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = written_pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    numbered = written_pieces.join(bases, ["length", "part"]).withColumn("number", F.col("base") + F.col("nth"))
    columns = [c for c in written_pieces.columns if c not in ("nth", "part")]
    slots = _slots(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (np.asarray(batch.column(len(columns) + i), np.int64) for i in range(2))
            # Slots are in order of length and first number, so the last one not beyond both holds the piece.
            at = np.searchsorted((slots[:, 0] << 48) + slots[:, 1], (length << 48) + number, "right") - 1
            _, first, sequence, copies, offset = slots[at].T
            inside = number - first
            added = [pa.array(sequence + inside // copies), pa.array(offset + inside % copies * length)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(columns))], *added], names=[*columns, "sequence_id", "offset"])

    kinds = ", ".join(f"{c} {written_pieces.schema[c].dataType.simpleString()}" for c in columns)
    return numbered.select(*columns, F.col("length").alias("_length"), "number").mapInArrow(run, f"{kinds}, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False, rounds: int = ROUNDS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and packed ids), sequence_id, offset."""
    rows = written(pieces(docs, path, end_id, capacity, with_ids), "pieces")
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    return assign(rows, plan(histogram, capacity, rounds))
