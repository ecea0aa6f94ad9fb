"""Exact top-k inner products by a three-phase uniform threshold.

The score of a query and a candidate is a sum over slices of the dimensions. Candidates stay in the partitions they are
read in; each partition is, per slice, one list holder: it has the partial scores of its candidates for a query.

1. Every holder gives the k best partial scores of each query. The candidates met are scored in full, and the k-th best
   full score of a query over all partitions is a cutoff: at least k candidates reach it.
2. A candidate that reaches the cutoff in full has a slice with at least cutoff / slices, whatever the signs, as not
   all terms of a sum lie below its mean. The holders collect the entries of at least that much. Where a candidate has
   no entry its partial score is below the mean, so entries and means together bound its full score.
3. The candidates whose bound reaches the cutoff are scored in full, they alone, and the k best are the answer.

Queries grow with the table, so they go round in chunks of counted bytes, one at a time: a chunk and its cutoffs are
sent to all partitions, and k rows a query and partition come back through a shuffle. No candidate is copied or shuffled.
Scores are integers: they are computed in float64 where no sum can leave the 53 bits of exact integers, else in Python
integers.

Defined results: vectors that are null, or hold null or non-finite components, take no part, nor do null ids; missing
components of shorter vectors count as zero; a query without candidates has no row; ties go to the smaller id; a
repeated id is a candidate each time, and a repeated query has its candidates as often as it stands in the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtrellis.llm.common import bucket, ship, slices as small_batches, written

SLICES = 4
#: bytes of one chunk of queries, with their lists
CHUNK_BYTES = 16 << 20
#: queries, candidates and pairs that a task holds products or copies of at a time
QUERY_ROWS, CANDIDATE_ROWS, PAIRS = 256, 2048, 32768
KIND = "query_id bigint, vec_id bigint, score bigint, copies bigint, scored bigint"


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id, vec: floor(scale * component) of the vectors without null or non-finite components."""
    usable = F.col(vector_col).isNotNull() & F.col(id_col).isNotNull() & ~F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter(usable).select(F.col(id_col).alias("vec_id"), F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("vec"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), width)


def _exact(queries: np.ndarray, candidates: np.ndarray, terms: int) -> bool:
    """Is every sum of that many products an exact float64?"""
    return not queries.size or not candidates.size or float(np.abs(queries).max()) * float(np.abs(candidates).max()) * terms < 2**53


def _whole(matrix: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in matrix], object).reshape(matrix.shape)


def _slices(width: int, slices: int) -> list[slice]:
    edges = np.linspace(0, width, min(slices, max(width, 1)) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


@dataclass
class Queries:
    """A chunk of queries: ids, how often each stands in the table, vectors, and cutoffs where they are known."""

    ids: np.ndarray
    copies: np.ndarray
    matrix: np.ndarray
    cutoffs: np.ndarray | None = None

    def parts(self) -> Iterator[tuple[slice, Queries]]:
        for lo in range(0, len(self.ids), QUERY_ROWS):
            at = slice(lo, lo + QUERY_ROWS)
            yield at, Queries(self.ids[at], self.copies[at], self.matrix[at], None if self.cutoffs is None else self.cutoffs[at])


class Lists:
    """The k best candidates met so far, for each query of a chunk."""

    def __init__(self, k: int):
        self.k = k
        self.kept = [np.zeros(0, np.int64)] * 3
        self.new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        self.new.append((query, ids, scores))
        if sum(len(q) for q, _, _ in self.new) > max(len(self.kept[0]), 16 * PAIRS):
            self.reduce()

    def reduce(self) -> None:
        query, ids, scores = (np.concatenate([old, *more]) for old, more in zip(self.kept, zip(*self.new))) if self.new else self.kept
        order = np.lexsort((ids, ~scores, query))  # ~ turns the order of integers round without overflow
        query = query[order]
        place = np.arange(len(query)) - np.searchsorted(query, query, "left")
        order, query = order[place < self.k], query[place < self.k]
        self.kept, self.new = [query, ids[order], scores[order]], []


def _full(queries: np.ndarray, candidates: np.ndarray, q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Scores of the pairs (q, c), and of no others."""
    if _exact(queries, candidates, queries.shape[1]):
        return np.einsum("ij,ij->i", queries[q], candidates[c]).astype(np.int64)
    a, b = _whole(queries), _whole(candidates)
    return np.array([int((a[i] * b[j]).sum()) for i, j in zip(q.tolist(), c.tolist())], np.int64)


def _met(part: np.ndarray, k: int) -> np.ndarray:
    """Mask of the k largest of each row."""
    if part.shape[1] <= k:
        return np.ones(part.shape, bool)
    mask = np.zeros(part.shape, bool)
    mask[np.arange(len(part))[:, None], np.argpartition(-part, k - 1, axis=1)[:, :k]] = True
    return mask


def _chosen(queries: Queries, ids: np.ndarray, candidates: np.ndarray, k: int, slices: int) -> np.ndarray:
    """Mask of the pairs to score in full: the best of each list without cutoffs, else those that may reach them."""
    parts = _slices(candidates.shape[1], slices)
    a, b = queries.matrix, candidates
    if not _exact(a, b, a.shape[1] * len(parts)):
        a, b = _whole(a), _whole(b)
    own = queries.ids[:, None] == ids[None, :]
    if queries.cutoffs is None:
        mask = np.zeros(own.shape, bool)
        for s in parts:
            mask |= _met(np.where(own, -np.inf, (a[:, s] @ b[:, s].T).astype(np.float64)), k)
        return mask & ~own
    cut = queries.cutoffs[:, None]
    bound, entries = 0, np.zeros(own.shape, bool)
    for s in parts:
        part = (a[:, s] @ b[:, s].T) * len(parts)
        entry = np.asarray(part >= cut, bool)
        bound = bound + np.where(entry, part, cut)
        entries |= entry
    return entries & np.asarray(bound >= cut * len(parts), bool) & ~own


def _phase(vectors: DataFrame, sent: Broadcast, width: int, k: int, slices: int) -> DataFrame:
    """Per partition and query the k best of the candidates scored in full, and one row that counts those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = sent.value
        lists, scored = Lists(k), 0
        for batch in small_batches(batches, CANDIDATE_ROWS):
            ids, candidates = np.asarray(batch.column(0), np.int64), _matrix(batch.column(1), width)
            for at, some in queries.parts():
                q, c = np.nonzero(_chosen(some, ids, candidates, k, slices))
                scored += len(q)
                for lo in range(0, len(q), PAIRS):
                    i, j = q[lo : lo + PAIRS], c[lo : lo + PAIRS]
                    scores = _full(some.matrix, candidates, i, j)
                    reach = slice(None) if some.cutoffs is None else np.asarray(scores >= some.cutoffs[i], bool)
                    lists.add(at.start + i[reach], ids[j[reach]], scores[reach])
        lists.reduce()
        query, found, scores = lists.kept
        columns = [queries.ids[query], found, scores, queries.copies[query], np.zeros(len(query), np.int64)]
        names = ["query_id", "vec_id", "score", "copies", "scored"]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=names)
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (None, None, None, None, scored)], names=names)

    return vectors.mapInArrow(run, KIND)


def _best(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return rows.filter(F.col("query_id").isNotNull()).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int = 5, slices: int = SLICES, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, float]:
    """The answer of top_k, and the share of all pairs that the third phase scored in full."""
    spark = ship(vectors.sparkSession)
    sizes = vectors.agg(F.max(F.size("vec")).alias("width"), F.count(F.lit(1)).alias("rows")).first()
    width, rows = sizes["width"] or 0, sizes["rows"]

    def padded(df: DataFrame) -> DataFrame:
        return df.select("vec_id", F.concat("vec", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("vec"))).alias("vec"))

    candidates = padded(vectors)
    queries = written(padded(vectors.filter(is_query)).groupBy("vec_id", "vec").agg(F.count(F.lit(1)).alias("copies")), "queries")
    n = queries.count()
    chunks = max(1, -(-n * 8 * (width + 2 * k + 3) // chunk_bytes))
    of_chunk = queries.withColumn("chunk", bucket(F.struct("vec_id", "vec"), chunks))
    answers, scored = [], 0
    for i in range(chunks):
        table = of_chunk.filter(F.col("chunk") == i).toArrow()
        ids, copies = (np.asarray(table[c], np.int64) for c in ("vec_id", "copies"))
        chunk = Queries(ids, copies, _matrix(table["vec"].combine_chunks(), width))
        sent = spark.sparkContext.broadcast(chunk)
        met = _best(_phase(candidates, sent, width, k, slices), k).filter(F.col("rank") == k).select("query_id", "score").toArrow()
        cutoff = dict(zip(met["query_id"].to_pylist(), met["score"].to_pylist()))
        # Cutoffs beyond 53 bits stay Python integers; a query with fewer than k candidates takes all of them.
        values = [cutoff.get(q, -np.inf) for q in ids.tolist()]
        large = any(abs(x) * max(slices, 1) >= 2**53 for x in cutoff.values())
        told = spark.sparkContext.broadcast(Queries(ids, copies, chunk.matrix, np.array(values, object if large else np.float64)))
        found = written(_phase(candidates, told, width, k, slices), "top-k")
        scored += found.agg(F.sum("scored").alias("n")).first()["n"] or 0
        answers.append(found)
        sent.destroy()
        told.destroy()
    every = answers[0]
    for more in answers[1:]:
        every = every.unionByName(more)
    # A query that stands in the table several times has each candidate as often; more than k of one are never seen.
    repeated = every.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
    best = _best(repeated, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    return best, scored / max(1, n * rows)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, slices: int = SLICES) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every query row of integer vectors (see integer_vectors)."""
    return search(vectors, is_query, k, slices)[0]
