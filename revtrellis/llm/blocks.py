"""Questions about hashes that need all documents, asked by blocks of documents and answered by shards of the hash space.

Documents are dealt into blocks by their id. A block packs what it asks into one row per shard (arrays of fixed-width
values in a fixed order); a shard sees what all blocks asked about its hashes and answers each block with bits in the
order asked. A block computes its questions again when it reads the answers, so only bits travel back. A value that
stands in very many documents is asked once per block, whatever its count, and so is no hot key.

Blocks and shards follow spark.sql.shuffle.partitions: a block holds half a partition's documents, a shard the hashes of
two partitions' share. So there are as many packed rows as a shuffle has map outputs for its reducers, the square of
the number of partitions, however large the groups of copies are. Everything is lineage over the documents: a lost executor costs only its own work again.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtrellis.llm.common import bucket, partitions, ship

LAST = np.iinfo(np.int64).max
MANY = 255
ARROW = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def shard_count(spark: SparkSession) -> int:
    return max(1, partitions(spark) // 2)


def dealt(docs: DataFrame, id_col: str, text_col: str, per_partition: int = 2) -> DataFrame:
    """doc_id, text, block."""
    n = per_partition * partitions(ship(docs.sparkSession))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("block", bucket("doc_id", n))


def _renewed(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(c) for c in df.columns])


class Block:
    """The documents of one block in the order of their ids (null last), rows with one id in the order of their texts."""

    def __init__(self, table: pa.Table):
        ids = table.column("doc_id").to_pylist()
        texts = [t.encode() if t else b"" for t in table.column("text").to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0, texts[i]))
        self.ids = [ids[i] for i in order]
        self.texts = [texts[i] for i in order]
        self.order = np.array([LAST if i is None else i for i in self.ids], np.int64)
        self.number = table.column("block")[0].as_py() if len(ids) else None


def shards_of(values: np.ndarray, n: int) -> np.ndarray:
    """Shard of each hash: the hash space in n equal ranges of its upper half."""
    return ((values >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def ask(dealt_docs: DataFrame, question: Callable[..., dict], shards: int, answers: DataFrame | None = None) -> DataFrame:
    """Rows (shard, block, one binary column per array) with what each block asks.

    question.columns names each array and the array of hashes, sorted, that decides the shard of its entries; an array is
    of fixed-width values or a list of byte strings. With answers of an earlier question it is called with the block and
    the answers' rows.
    """
    columns: dict[str, str] = question.columns  # type: ignore[attr-defined]

    def pack(block: Block, asked: dict) -> pa.Table:
        out = {"shard": pa.array(np.arange(shards, dtype=np.int32)), "block": pa.array(np.full(shards, block.number, np.int32))}
        full = np.zeros(shards, bool)
        for c, by in columns.items():
            edges = np.searchsorted(shards_of(asked[by], shards), np.arange(shards + 1))
            full |= np.diff(edges) > 0
            raw, cuts = asked[c], list(zip(edges[:-1].tolist(), edges[1:].tolist()))
            out[c] = pa.array([b"".join(raw[a:b]) if isinstance(raw, list) else raw[a:b].tobytes() for a, b in cuts], pa.binary())
        return pa.table(out).filter(pa.array(full))

    schema = "shard int, block int, " + ", ".join(f"{c} binary" for c in columns)
    empty = pa.table({"shard": pa.array([], pa.int32()), "block": pa.array([], pa.int32()), **{c: pa.array([], pa.binary()) for c in columns}})
    if answers is None:

        def alone(table: pa.Table) -> pa.Table:
            block = Block(table)
            return pack(block, question(block))

        return _renewed(dealt_docs).groupBy("block").applyInArrow(alone, schema)

    def answered(table: pa.Table, told: pa.Table) -> pa.Table:
        if not len(table):
            return empty
        block = Block(table)
        return pack(block, question(block, told.sort_by("shard")))

    return _renewed(dealt_docs).groupBy("block").cogroup(_renewed(answers).groupBy("block")).applyInArrow(answered, schema)


def finish(dealt_docs: DataFrame, answers: DataFrame, result: Callable[[Block, pa.Table], dict[str, list]], columns: list[tuple[str, str]]) -> DataFrame:
    """One row per document from its block and the answers; result gives the columns after doc_id (of the kinds in ARROW), in the order of the block's documents."""
    ddl = ", ".join(f"{n} {t}" for n, t in [("doc_id", dealt_docs.schema["doc_id"].dataType.simpleString()), *columns])
    kinds = [(n, ARROW[t]) for n, t in columns]

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        arrow_id = table.schema.field("doc_id").type
        if not len(table):
            return pa.table({"doc_id": pa.array([], arrow_id), **{n: pa.array([], t) for n, t in kinds}})
        block = Block(table)
        out = result(block, told.sort_by("shard"))
        return pa.table({"doc_id": pa.array(block.ids, arrow_id), **{n: pa.array(out[n], t) for n, t in kinds}})

    return _renewed(dealt_docs).groupBy("block").cogroup(_renewed(answers).groupBy("block")).applyInArrow(run, ddl)


def joined(rows: pa.Table, column: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows of a packed column, one after another, and the number of values per row."""
    parts = rows.column(column).to_pylist()
    width = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(parts), kind), np.array([len(p) // width for p in parts], np.int64)


def bits_by_row(bits: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    ends = np.cumsum(sizes)
    return [np.packbits(bits[a:b], bitorder="little").tobytes() for a, b in zip((ends - sizes).tolist(), ends.tolist())]


def bits_told(told: pa.Table, column: str, asked_hashes: np.ndarray, shards: int, sizes: np.ndarray | None = None) -> np.ndarray:
    """The answered bits in the order of the (sorted) hashes asked: one per hash, or sizes[i] of them."""
    edges = np.searchsorted(shards_of(asked_hashes, shards), np.arange(shards + 1))
    if sizes is not None:
        edges = np.append(0, np.cumsum(sizes))[edges]
    out = np.zeros(int(edges[-1]), bool)
    for shard, raw in zip(told.column("shard").to_pylist(), told.column(column).to_pylist()):
        a, b = int(edges[shard]), int(edges[shard + 1])
        out[a:b] = np.unpackbits(np.frombuffer(raw, np.uint8), count=b - a, bitorder="little").astype(bool)
    return out


def recurring(asked: DataFrame) -> DataFrame:
    """Answers to questions (hash, count: one byte, at most MANY): `again`, does it occur more than once in all blocks; `often`, MANY times or more."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        hashes, sizes = joined(rows, "hash", "<u8")
        counts, _ = joined(rows, "count", "u1")
        order = np.argsort(hashes, kind="stable")
        sorted_hashes = hashes[order]
        new = np.append(True, sorted_hashes[1:] != sorted_hashes[:-1])
        group = np.cumsum(new) - 1
        totals = np.bincount(group, weights=counts[order]).astype(np.int64)
        of = np.empty(len(hashes), np.int64)
        of[order] = totals[group]
        return pa.table(
            {
                "block": rows.column("block"),
                "shard": rows.column("shard"),
                "again": pa.array(bits_by_row(of > 1, sizes), pa.binary()),
                "often": pa.array(bits_by_row(of >= MANY, sizes), pa.binary()),
            }
        )

    return asked.groupBy("shard").applyInArrow(run, "block int, shard int, again binary, often binary")
