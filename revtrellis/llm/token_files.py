"""Token ids as binary files of patched frame-of-reference blocks.

A file holds the ids of the documents of one range of ids, in ascending order. It is a table part whose rows are
segments of whole documents (about SEGMENT ids, a longer document has one of its own), so that a reader can start at
any of them and no task holds more than a segment. A segment's payload, little-endian:

    magic "PFR1", u32 documents, u32 ids, u32 blocks
    u32 ids per document
    u32 minimum per block, u8 width per block, u16 exceptions per block
    u32 start per block in the packed area, and its end        (the block index)
    packed area: the BLOCK differences to the minimum, the low `width` bits of each
    u8 place and u32 difference per exception, block by block

The width is the number of bits that PERCENTILE of the block's differences fit in; the others are exceptions and
keep their whole difference. The last block is padded with its minimum.

Defined results: a null text counts as empty, an empty document has the end id alone; rows with one id keep their order by text.
"""

from __future__ import annotations

import functools
import gc
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revtrellis.llm.common import partitions, ship, written

BLOCK = 256
SEGMENT = 1 << 16
PERCENTILE = 90
MAGIC = b"PFR1"
KEPT_PARTS = 500_000
KEPT_RUNS = 300_000
#: Fixed value: how the word vocabulary cuts lower-case Latin-1 text; superscripts and fractions are numbers.
RUNS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\\sa-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
#: Byte-level vocabularies write the bytes without a visible sign in Latin-1 as the characters from U+0100 on, in their order.
SIGNS = {byte: 256 + i for i, byte in enumerate([*range(33), *range(127, 161), 173])}
#: Every character of Latin-1 but white space alone, between letters, and in a row; common endings and numbers.
PROBES = [
    *[x for c in map(chr, range(256)) if not c.isspace() for x in (c, f"a{c}b")],
    "".join(c for c in map(chr, range(256)) if not c.isspace()),
    *["it's", "I'LL", "they're've", "12x34", "--(a)--", "déjà-vu"],
]


# ---------------------------------------------------------------- blocks


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.searchsorted(np.left_shift(np.uint64(1), np.arange(32, dtype=np.uint64)), values.astype(np.uint64), "right").astype(np.uint8)


def pack(ids: np.ndarray, counts: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """Payload of documents with `counts` ids each, their ids one after another."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint32)
    padded[:n] = ids
    if n % BLOCK:
        padded[n:] = padded[(blocks - 1) * BLOCK : n].min()
    rows = padded.reshape(blocks, BLOCK)
    low = rows.min(axis=1) if blocks else np.zeros(0, np.uint32)
    diff = rows - low[:, None]
    lengths = _bit_lengths(diff)
    place = max(0, -(-percentile * BLOCK // 100) - 1)
    widths = np.partition(lengths, place, axis=1)[:, place] if blocks else np.zeros(0, np.uint8)
    outlier = lengths > widths[:, None]
    starts = np.zeros(blocks + 1, np.uint32)
    np.cumsum(widths.astype(np.uint32) * (BLOCK // 8), out=starts[1:])
    area = np.zeros(int(starts[-1]), np.uint8)
    for w in np.unique(widths[widths > 0]).tolist():
        at = np.flatnonzero(widths == w)
        bits = (diff[at][:, :, None] >> np.arange(w, dtype=np.uint32)).astype(np.uint8) & 1
        area[starts[at][:, None] + np.arange(w * BLOCK // 8)] = np.packbits(bits.reshape(len(at), -1), axis=1, bitorder="little")
    block, spot = np.nonzero(outlier)
    return b"".join(
        (
            MAGIC,
            struct.pack("<III", len(counts), n, blocks),
            counts.astype("<u4").tobytes(),
            low.astype("<u4").tobytes(),
            widths.tobytes(),
            outlier.sum(axis=1).astype("<u2").tobytes(),
            starts.astype("<u4").tobytes(),
            area.tobytes(),
            spot.astype(np.uint8).tobytes(),
            diff[block, spot].astype("<u4").tobytes(),
        )
    )


def unpack(payload: bytes, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids per document, and the ids first..last-1 (all of them by default); only the blocks that hold them are unpacked."""
    if payload[:4] != MAGIC:
        raise ValueError("not a token segment")
    docs, n, blocks = struct.unpack_from("<III", payload, 4)
    at = 16

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(payload, kind, count, at)
        at += out.nbytes
        return out

    counts, low, widths, outliers, starts = take("<u4", docs), take("<u4", blocks), take("u1", blocks), take("<u2", blocks), take("<u4", blocks + 1)
    area = take("u1", int(starts[-1]))
    total = int(outliers.sum(dtype=np.int64))
    spots, diffs = take("u1", total), take("<u4", total)
    last = n if last is None else min(last, n)
    if first >= last:
        return counts, np.zeros(0, np.uint32)
    b0, b1 = first // BLOCK, -(-last // BLOCK)
    out = np.zeros((b1 - b0, BLOCK), np.uint32)
    for w in np.unique(widths[b0:b1]).tolist():
        if w:
            mine = np.flatnonzero(widths[b0:b1] == w)
            bits = np.unpackbits(area[starts[mine + b0][:, None] + np.arange(w * BLOCK // 8)], axis=1, bitorder="little").reshape(len(mine), BLOCK, w)
            room = 16 if w <= 16 else 32
            wide = np.zeros((len(mine), BLOCK, room), np.uint8)
            wide[:, :, :w] = bits
            out[mine] = np.packbits(wide.reshape(len(mine), -1), axis=1, bitorder="little").view(f"<u{room // 8}")
    ends = np.cumsum(outliers.astype(np.int64))
    e0, e1 = (int(ends[b0 - 1]) if b0 else 0), int(ends[b1 - 1])
    out[np.repeat(np.arange(b1 - b0), outliers[b0:b1]), spots[e0:e1]] = diffs[e0:e1]
    out += low[b0:b1, None]
    return counts, out.ravel()[first - b0 * BLOCK : last - b0 * BLOCK]


# ---------------------------------------------------------------- tokens


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordTokens(dict):
    """White-space-free part of a text -> its packed ids.

    The vocabulary drops white space and case and encodes each run of letters, of other characters, or one digit by
    itself, so a text's ids are those of its parts, and a part's those of its runs. Only runs not met before go to the
    library, straight to its model. Parts with characters beyond Latin-1, which may be composed or cut otherwise, are
    encoded whole; so are all parts if the vocabulary does not cut all of Latin-1 as RUNS does.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        specials = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        # Special tokens may hold or adjoin anything; U+001C to U+001F are white space to Python only.
        self.odd = ["\x1c", "\x1d", "\x1e", "\x1f", *specials]
        self.runs: dict[str, bytes] = {}
        self.cuts = True
        self.cuts = all(self._by_runs(x) == self.whole(x) for x in PROBES)

    def whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _run(self, run: str) -> bytes:
        packed = self.runs.get(run)
        if packed is None:
            signs = run if run.isascii() and run.isprintable() else run.encode().decode("latin-1").translate(SIGNS)
            packed = self.runs[run] = _packed([x.id for x in self.model.tokenize(signs)])
        return packed

    def _by_runs(self, part: str) -> bytes:
        runs = RUNS.findall(part.lower())
        return self._run(runs[0]) if len(runs) == 1 else b"".join(map(self._run, runs))

    def __missing__(self, part: str) -> bytes:
        packed = self[part] = self._by_runs(part) if self.cuts and (part.isascii() or max(part) <= "\xff") else self.whole(part)
        return packed

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of the texts. The collector of reference cycles rests meanwhile: there are none, and it would walk all kept parts again and again."""
        for kept, most in ((self, KEPT_PARTS), (self.runs, KEPT_RUNS)):
            if len(kept) > most:
                for x in list(kept)[most // 2 :]:
                    del kept[x]
        collecting = gc.isenabled()
        gc.disable()
        try:
            return [self.whole(t) if any(x in t for x in self.odd) else b"".join(map(self.__getitem__, t.split())) for t in texts]
        finally:
            if collecting:
                gc.enable()


@functools.lru_cache(maxsize=2)
def _tokens(path: str) -> WordTokens:
    return WordTokens(path)


# ---------------------------------------------------------------- files


def write_token_files(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", name: str = "tokens") -> DataFrame:
    """Encode all documents and write them; returns the written table: file, segment, ids before it in the file, documents, payload."""
    spark = ship(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ordered = picked.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    kind = picked.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, tail = _tokens(path), int(end_id).to_bytes(4, "little")
        file, segment, before = TaskContext.get().partitionId(), 0, 0
        ids: list = []
        kept: list[bytes] = []
        size = 0
        schema = None

        def flush() -> pa.RecordBatch:
            counts = np.array([len(x) // 4 for x in kept], np.uint32)
            payload = pack(np.frombuffer(b"".join(kept), "<u4"), counts)
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((file, segment, before, size, ids, payload), schema.types)], schema=schema)

        for batch in batches:
            schema = pa.schema([("file", pa.int32()), ("segment", pa.int32()), ("ids_before", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(batch.schema.field(0).type)), ("payload", pa.binary())])
            all_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for lo in range(0, len(all_ids), 512):
                for doc, packed in zip(all_ids[lo : lo + 512], tokens.encode([t or "" for t in texts[lo : lo + 512].to_pylist()])):
                    ids.append(doc)
                    kept.append(packed + tail)
                    size += len(packed) // 4 + 1
                    if size >= SEGMENT:
                        yield flush()
                        segment, before = segment + 1, before + size
                        ids, kept, size = [], [], 0
        if ids:
            yield flush()

    return written(ordered.mapInArrow(run, f"file int, segment int, ids_before bigint, n_ids bigint, doc_ids array<{kind.simpleString()}>, payload binary"), name)


def with_starts(files: DataFrame) -> DataFrame:
    """The segments with `start`: the ids of all segments before. The window runs over one row per file."""
    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.groupBy("file").agg(F.sum("n_ids").alias("file_ids")).select("file", F.coalesce(F.sum("file_ids").over(ahead), F.lit(0)).alias("base"))
    # One row of two numbers per file: as few as there are shuffle partitions.
    return files.join(F.broadcast(bases), "file").withColumn("start", F.col("base") + F.col("ids_before"))


def read_documents(files: DataFrame, digest: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, and `ids` (array) or `ids_crc32`."""
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                counts, ids = unpack(batch.column("payload")[i].as_py())
                ends = np.cumsum(counts, dtype=np.int64)
                begins = ends - counts
                if digest:
                    raw = ids.astype("<u4").tobytes()
                    value = pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())], pa.int64())
                else:
                    value = pa.ListArray.from_arrays(pa.array(np.append(begins, len(ids)).astype(np.int32)), pa.array(ids.astype(np.int64)))
                docs = batch.column("doc_ids").slice(i, 1).flatten()
                yield pa.RecordBatch.from_arrays(
                    [docs, pa.array(begins + batch.column("start")[i].as_py()), pa.array(counts.astype(np.int64)), value],
                    names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"],
                )

    ship(files.sparkSession)
    picked = with_starts(files).select("doc_ids", "start", "payload")
    return picked.mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, " + ("ids_crc32 bigint" if digest else "ids array<bigint>"))
