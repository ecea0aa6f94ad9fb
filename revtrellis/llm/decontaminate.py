"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

The items' automaton is streamed with every text; where the longest match reaches the window length (or a whole shorter
item) the words of the window are hit. Items go into shards of at most SHARD_WORDS words each, which bounds what is
sent to the tasks and what an automaton holds; every text is streamed through every shard. A match is confirmed on the words.

Words: A-Z lower-cased, then runs of anything but ASCII characters other than letters and digits.

Defined results: a null or wordless text has no hits; null or wordless items match nothing; items with one id count once;
a null item id is never reported, but its words are hit.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrellis.llm.common import bucket, ship, slices
from revtrellis.llm.suffix_automaton import ItemIndex
from revtrellis.llm.wordhash import LOWER, PUNCTUATION, Words, words_of

WINDOW = 10
SHARD_WORDS = 500_000
MAX_COVERAGE = 0.5
#: automata a worker keeps between batches
KEPT = 4
#: text that is held for one walk through the shards where they are more than that
GROUP_BYTES = 16 << 20


class TestItems:
    """The items of one shard."""

    def __init__(self, rows: list[tuple], window: int):
        self.window = window
        self.names = [i for i, _ in rows]
        self.index = ItemIndex([t.encode() for _, t in rows], cap=window)
        automaton = self.index.automaton
        #: per state: the whole items shorter than a window that end here, as (words, items)
        self.short: list[tuple[tuple[int, int], ...]] = [()] * len(automaton.link)
        for k, item in enumerate(self.index.items):
            if 0 < len(item) < window:
                v = 0
                for c in item:
                    v = automaton.next[v][c]
                self.short[v] = (*self.short[v], (len(item), k))
        for v in sorted(range(1, len(automaton.link)), key=automaton.length.__getitem__):
            if automaton.link[v] > 0:
                self.short[v] = (*self.short[v], *self.short[automaton.link[v]])

    def hits(self, ids: list[int]) -> Iterator[tuple[int, int, int]]:
        """(first word, last word exclusive, item) of every window that occurs."""
        automaton, window = self.index.automaton, self.window
        for i, (v, n) in enumerate(automaton.walk(ids), 1):
            if n >= window:
                for k in automaton.ends[automaton.suffix_state(v, window)]:
                    yield i - window, i, k
            for length, k in self.short[v]:
                if n >= length:
                    yield i - length, i, k

    def confirmed(self, k: int, words: list[bytes]) -> bool:
        item = self.index.words[k]
        return any(item[j : j + len(words)] == words for j in range(len(item) - len(words) + 1))


@functools.lru_cache(maxsize=KEPT)
def _built(shard: Broadcast, window: int) -> TestItems:
    return TestItems(shard.value, window)


def item_shards(items: DataFrame, id_col: str = "item_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> list[Broadcast]:
    """The items in shards whose words are counted before anything is sent."""
    spark = items.sparkSession
    usable = items.filter(F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text")).distinct()
    # A word and its separator take two bytes at least.
    size = usable.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    n = max(1, -(-size // (2 * shard_words)))
    numbered = usable.withColumn("shard", bucket(F.struct("item", "text"), n))
    return [spark.sparkContext.broadcast([(r["item"], r["text"]) for r in numbered.filter(F.col("shard") == i).orderBy("item", "text").collect()]) for i in range(n)]


@dataclass
class Found:
    """Hits of one text: words, hit words, items, and the hit runs as [first byte, last byte)."""

    n_words: int
    n_hit: int
    items: list[str]
    spans: list[list[int]]


def _add_hits(w: Words, mine: TestItems, difference: np.ndarray, met: dict[int, set[str]]) -> None:
    """Add the hits of one shard to the words' differences and the documents' items."""
    ids, starts, stops = mine.index.stretches(w)
    checked: dict[tuple[int, ...], bool] = {}
    for a, b in zip(starts.tolist(), stops.tolist()):
        part = ids[a:b].tolist()
        for first, last, k in mine.hits(part):
            key = (k, *part[first:last])
            if key not in checked:
                checked[key] = mine.confirmed(k, [w.data[s:e].tobytes() for s, e in zip(w.starts[a + first : a + last], w.ends[a + first : a + last])])
            if checked[key]:
                difference[a + first] += 1
                difference[a + last] -= 1
                doc = int(np.searchsorted(w.first, a, "right")) - 1
                met.setdefault(doc, set()).add(mine.names[k])


def _find(texts: list[bytes], shards: list[Broadcast], window: int) -> Iterator[Found]:
    groups = list(words_of(texts, PUNCTUATION, LOWER))
    differences = [np.zeros(len(w.hashes) + 1, np.int64) for w in groups]
    items: list[dict[int, set[str]]] = [{} for _ in groups]
    # Shards outermost: each is built once for all the texts, however many there are.
    for shard in shards:
        mine = _built(shard, window)
        for w, difference, met in zip(groups, differences, items):
            _add_hits(w, mine, difference, met)
    for w, difference, met in zip(groups, differences, items):
        hit = np.cumsum(difference[:-1]) > 0
        sums = np.append(0, np.cumsum(hit))
        hits = np.diff(sums[w.first]).tolist()
        for i, n_words in enumerate(np.diff(w.first).tolist()):
            spans: list[list[int]] = []
            if hits[i]:
                a, b = w.first[i], w.first[i + 1]
                edges = np.diff(np.concatenate([[0], hit[a:b].view(np.int8), [0]]))
                spans = [[int(w.starts[a + s] - w.offsets[i]), int(w.ends[a + e - 1] - w.offsets[i])] for s, e in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1))]
            yield Found(n_words, hits[i], sorted(x for x in met.get(i, ()) if x is not None), spans)


def _groups(batches: Iterator[pa.RecordBatch], text: int, shards: int) -> Iterator[pa.RecordBatch]:
    """Small batches where a worker keeps the automata of all shards, else groups of about GROUP_BYTES of text, as each group builds them again."""
    if shards <= KEPT:
        yield from slices(batches)
        return
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in slices(batches):
        held.append(batch)
        size += pc.sum(pc.binary_length(batch.column(text))).as_py() or 0
        if size >= GROUP_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def scan(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: id, n_words, n_hit, `items` (ids of the items with occurring windows, sorted) and `spans` (maximal hit runs as [first byte, last byte) in UTF-8)."""
    ship(docs.sparkSession)
    shards = item_shards(items)
    picked = docs.select(F.col(id_col), F.col(text_col))
    kind = picked.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches, 1, len(shards)):
            found = list(_find([t.encode() if t else b"" for t in batch.column(1).to_pylist()], shards, window))
            columns = [pa.array([getattr(f, c) for f in found], t) for c, t in (("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.list_(pa.int64()))))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, "n_words", "n_hit", "items", "spans"])

    return picked.mapInArrow(run, f"{id_col} {kind}, n_words bigint, n_hit bigint, items array<string>, spans array<array<bigint>>")


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", window: int = WINDOW, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """The rows, with all their columns, without the hit spans in their texts; rows with more than max_coverage of their words hit are left out."""
    ship(docs.sparkSession)
    shards = item_shards(items)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches, at, len(shards)):
            raw = [None if t is None else t.encode() for t in batch.column(at).to_pylist()]
            texts, stay = [], []
            for text, found in zip(raw, _find([t or b"" for t in raw], shards, window)):
                stay.append(found.n_hit <= max_coverage * found.n_words)
                if found.spans:
                    edges = [0, *(x for span in found.spans for x in span), len(text)]
                    text = b" ".join(text[a:b].strip() for a, b in zip(edges[0::2], edges[1::2])).strip()
                texts.append(None if text is None else text.decode())
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(pa.array(stay, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def digests(docs: DataFrame, items: DataFrame) -> DataFrame:
    return scan(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
