"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

Shingles are `words` consecutive lower-cased words; a document's set holds the distinct ones. Documents whose sets have
a similarity (intersection over union) of at least `similarity` are linked.

1. One pass over the texts gives each document the size and a fingerprint of its set, `bands` keys of `rows` minima
   each, and the signature: the low `BITS` bits of all minima, packed.
2. Documents with equal sets share a vertex. Only one row of each goes on, so copies cost nothing.
3. Documents with a band key in common are candidates. Each bucket ties its documents to its smallest one; the connected
   sets of these ties contain every candidate pair. With 48 bands of 5 minima a pair of similarity 0.75 shares no key
   once in 440,000 times.
4. The full sets of a connected set meet in one task, where pairs that are not connected yet are tried: first the
   signatures, by counting equal low bits and correcting for chance (pairs far below the limit are left, six standard
   deviations away), most similar first, then the full sets. A large connected set is dealt over many tasks. Each of
   them also gets its most central documents, so the parts join up; documents that join none are then tried against
   every part. No pair that could join two components is left out, and pairs within a component need no test.
5. Components of the confirmed links; copies follow their representative.

Defined results: null, empty and blank texts have an empty set, are linked with nothing and are their own component;
fewer words than a shingle make one shingle; rows with one id and different texts are linked with each other, so the id has
one component, that of all its texts; a null id has a null component and is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtrellis.llm.common import bucket, partitions, ship, slices, written
from revtrellis.llm.graph import components
from revtrellis.llm.wordhash import LOWER, SPACE, mix, run_hashes, words_of

WORDS = 5
PERCENT = 75
BANDS = 48
ROWS = 5
BITS = 4
PART = 128
CENTRAL = 8
DEVIATIONS = 6.0
FRESH = 1 << 62  # names of sets begin here that no id has alone; ids are smaller

_RANDOM = np.random.Generator(np.random.PCG64(77))
_XOR = _RANDOM.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)[:, None]
_FACTOR = _RANDOM.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)[:, None] | np.uint32(1)
_BAND = mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def shingle_sets(texts: list[bytes], words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for w in words_of(texts, SPACE, LOWER):
        runs = run_hashes(w.hashes, words)
        for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
            if b - a >= words:
                yield np.unique(runs[a : b - words + 1])
            elif b > a:
                yield run_hashes(w.hashes[a:b], b - a) ^ np.uint64(b - a)
            else:
                yield np.zeros(0, np.uint64)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each of the hash functions."""
    out = np.full(BANDS * ROWS, 2**32 - 1, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 2048):
        np.minimum(out, (((short[None, at : at + 2048] ^ _XOR) * _FACTOR)).min(axis=1), out=out)
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low.reshape(BANDS, ROWS).astype(np.uint64)
    key = _BAND.copy()
    for j in range(ROWS):
        key = mix(key ^ rows[:, j])
    return key


def signature(low: np.ndarray) -> bytes:
    """The low BITS bits of all minima, two to a byte."""
    nibbles = (low & np.uint32(15)).astype(np.uint8)
    return (nibbles[0::2] | (nibbles[1::2] << 4)).tobytes()


def estimates(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Similarity of a signature with others from the count of equal low bits, corrected for those equal by chance."""
    odd = one[None, :] ^ many
    odd = odd | (odd >> np.uint64(1))
    odd = (odd | (odd >> np.uint64(2))) & np.uint64(0x1111111111111111)
    equal = 1.0 - np.bitwise_count(odd).sum(axis=1) / (BANDS * ROWS)
    chance = 2.0**-BITS
    return (equal - chance) / (1.0 - chance)


def estimate_floor(percent: int = PERCENT) -> float:
    """Estimates below this do not come from a pair at the limit, by DEVIATIONS standard deviations."""
    chance = 2.0**-BITS
    p = percent / 100 * (1 - chance) + chance
    return percent / 100 - DEVIATIONS * (p * (1 - p) / (BANDS * ROWS)) ** 0.5 / (1 - chance)


_SECOND = np.uint64(0x9FB21C651E98DF25)


def fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    return int(mix(shingles).sum(dtype=np.uint64).view(np.int64)), int(mix(shingles ^ _SECOND).sum(dtype=np.uint64).view(np.int64))


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, print_a and print_b (fingerprint of the set, null if empty), keys, signature."""
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, a, b, keys, packed = [], [], [], [], []
            for s in shingle_sets([t.encode() if t else b"" for t in batch.column(1).to_pylist()], words):
                sizes.append(len(s))
                if len(s):
                    low = minima(s)
                    for x, half in zip((a, b), fingerprint(s)):
                        x.append(half)
                    keys.append(band_keys(low).view(np.int64))
                    packed.append(signature(low))
                else:
                    for x in (a, b, keys, packed):
                        x.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(packed, pa.binary())],
                names=["doc_id", "n_shingles", "print_a", "print_b", "keys", "signature"],
            )

    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, n_shingles bigint, print_a bigint, print_b bigint, keys array<bigint>, signature binary")


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirm(percent: int, floor: float):
    """Links of the parts in a task's table: (a, b) for every union, smaller id first. `guest` rows are tried with everything, others with each other unless the table says not to."""

    def part(ids: list[int], sets: list[np.ndarray], packed: np.ndarray, guest: np.ndarray, only_guests: bool) -> list[tuple[int, int]]:
        union, links = _Union(len(ids)), []
        order = np.flatnonzero(guest).tolist() + ([] if only_guests else np.flatnonzero(~guest).tolist())
        done = np.zeros(len(ids), bool)
        for i in order:
            done[i] = True
            others = np.flatnonzero(~done)
            if not len(others):
                break
            near = estimates(packed[i], packed[others])
            for j in others[np.flatnonzero(near >= floor)][np.argsort(-near[near >= floor], kind="stable")].tolist():
                a, b = union.top(i), union.top(j)
                if a != b and _linked(sets[i], sets[j], percent):
                    union.up[b] = a
                    links.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
        return links

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("component", "ascending"), ("part", "ascending"), ("round", "ascending"), ("guest", "descending"), ("doc_id", "ascending")])
        names = list(zip(*(table.column(c).to_pylist() for c in ("component", "part", "round"))))
        ids, guest = table.column("doc_id").to_pylist(), np.array(table.column("guest").to_pylist(), bool)
        sets = [np.frombuffer(x, "<u8") for x in table.column("shingles").to_pylist()]
        packed = np.stack([np.frombuffer(x, "<u8") for x in table.column("signature").to_pylist()])
        links: list[tuple[int, int]] = []
        at = 0
        while at < len(ids):
            end = at + 1
            while end < len(ids) and names[end] == names[at]:
                end += 1
            # a guest that is a member of the part too stands in it once
            own, seen = [], set()
            for i in range(at, end):
                if ids[i] not in seen:
                    seen.add(ids[i])
                    own.append(i)
            if len(own) > 1:
                links += part([ids[i] for i in own], [sets[i] for i in own], packed[own], guest[own], names[at][2] > 0)
            at = end
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return run


def _with_sets(docs: DataFrame, words: int) -> DataFrame:
    """The rows (doc_id, component, signature, print_a, print_b, text, ...) with their shingle sets instead of texts, if the set has that fingerprint."""
    keep = [c for c in docs.columns if c not in ("text", "print_a", "print_b")]
    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep) + ", shingles binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = list(zip(batch.column("print_a").to_pylist(), batch.column("print_b").to_pylist()))
            sets = [s if len(s) and fingerprint(s) == p else None for s, p in zip(shingle_sets([t.encode() if t else b"" for t in batch.column("text").to_pylist()], words), prints)]
            out = pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array([s if s is None else s.tobytes() for s in sets], pa.binary())], names=[*keep, "shingles"])
            yield out.filter(pa.array([s is not None for s in sets]))

    return docs.mapInArrow(run, schema)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, part: int = PART) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id that links reach) and kept (is it that one)."""
    spark = ship(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    signed = written(signatures(picked, "doc_id", "text", words), "signatures")
    full = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    # A set is a vertex, named by the smallest id that has no other set. Sets whose ids all have others get a name of their own
    # beyond the ids, and ids with several sets are tied to each of them.
    prints = ["print_a", "print_b"]
    own = F.struct(*prints)
    forked = written(full.groupBy("doc_id").agg(F.min(own).alias("low"), F.max(own).alias("high")).filter("low <> high").select("doc_id"), "forked")
    single = full.join(forked, "doc_id", "left_anti")
    several = full.join(forked, "doc_id", "left_semi").select("doc_id", "n_shingles", *prints, "keys", "signature")
    named = single.select("doc_id", *prints).unionByName(several.select(F.lit(None).cast("bigint").alias("doc_id"), *prints))
    fresh = F.lit(FRESH) + F.pmod(F.xxhash64(*prints), F.lit(FRESH - 1))
    representatives = written(named.groupBy(*prints).agg(F.min("doc_id").alias("doc_id")).select(*prints, F.coalesce("doc_id", fresh).alias("doc_id"), F.col("doc_id").isNull().alias("fresh")), "representatives")
    vertex = F.col("doc_id").alias("vertex")
    nameless = several.join(representatives.filter("fresh").select(*prints, vertex), prints)
    vertices = single.join(representatives, ["doc_id", *prints], "left_semi").select(vertex, F.col("doc_id").alias("source"), *prints, "keys", "signature").unionByName(
        nameless.select("vertex", F.col("doc_id").alias("source"), *prints, "keys", "signature")
    )
    tied = several.join(representatives.select(*prints, vertex), prints).select(F.col("doc_id").alias("a"), F.col("vertex").alias("b")).distinct()

    # Candidates: ties of the documents of a bucket to its smallest.
    chosen = vertices.select(F.col("vertex").alias("doc_id"), F.explode("keys").alias("key"))
    shared = written(chosen.groupBy("key").agg(F.min("doc_id").alias("smallest"), F.count("*").alias("n"), F.max("doc_id").alias("largest")).filter("smallest < largest"), "buckets")
    ties = written(chosen.join(shared, "key").groupBy("doc_id", "smallest").agg(F.sum("n").alias("weight")), "ties")
    # A document is tied to the lowest of its smallest ones and these to each other: the latter ties are few, as near
    # copies share them.
    low = ties.withColumn("low", F.min("smallest").over(Window.partitionBy("doc_id")))
    chain = low.filter("low < smallest").select(F.col("low").alias("a"), F.col("smallest").alias("b"))
    candidates = components(low.select(F.col("doc_id").alias("a"), F.col("low").alias("b")).unionByName(chain).distinct())

    # Parts of at most about `part` documents; the documents that share most with others are guests of all parts.
    sizes = candidates.groupBy("component").agg(F.count("*").alias("size")).withColumn("parts", F.ceil(F.col("size") / part).cast("int"))
    weights = ties.groupBy("doc_id").agg(F.sum("weight").alias("weight"))
    placed = candidates.withColumnRenamed("id", "doc_id").join(sizes, "component").join(weights, "doc_id", "left")
    # Rows of one set have one signature; any of their ids leads to a text with that set.
    signs = vertices.groupBy(F.col("vertex").alias("doc_id"), *prints).agg(F.min("signature").alias("signature"), F.min("source").alias("source"))
    described = placed.join(signs, "doc_id")
    texts = picked.filter(F.col("doc_id").isNotNull()).withColumnRenamed("doc_id", "source")
    sets = written(_with_sets(described.join(texts, "source").drop("source"), words).dropDuplicates(["doc_id"]), "sets")
    n = 4 * partitions(spark)
    of_part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("parts")).cast("int")

    def every_part() -> Column:
        return F.explode(F.sequence(F.lit(0), F.col("parts") - 1))

    columns = ("doc_id", "component", "part", "round", "guest", "signature", "shingles")
    members = sets.withColumn("part", of_part).withColumn("round", F.lit(0)).withColumn("guest", F.lit(False))
    order = Window.partitionBy("component").orderBy(F.col("weight").desc_nulls_last(), "doc_id")
    central = sets.filter("parts > 1").select("component", "doc_id", "weight").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= CENTRAL).select("doc_id")
    guests = sets.join(central, "doc_id", "left_semi").withColumn("part", every_part()).withColumn("round", F.lit(0)).withColumn("guest", F.lit(True))
    confirm = _confirm(percent, estimate_floor(percent))

    def confirmed(rows: DataFrame) -> DataFrame:
        dealt = rows.select(*columns).withColumn("task", bucket(F.struct("component", "part", "round"), n))
        return dealt.groupBy("task").applyInArrow(confirm, "a bigint, b bigint")

    links = written(confirmed(members.unionByName(guests)), "links")

    # Large candidate sets: what is not in their largest component is tried against all their parts.
    large = sets.filter("parts > 1")
    if large.limit(1).count():
        labels = components(links)
        joined = written(large.join(labels.withColumnRenamed("id", "doc_id").withColumnRenamed("component", "joined"), "doc_id", "left").withColumn("joined", F.coalesce("joined", "doc_id")), "joined")
        counts = joined.groupBy("component", "joined").agg(F.count("*").alias("members"))
        main = counts.groupBy("component").agg(F.max_by("joined", F.struct("members", "joined")).alias("main"))
        left_over = joined.join(main, "component").filter(F.col("joined") != F.col("main"))
        # About as many left-over documents in one round as a part holds.
        many = left_over.groupBy("component").agg(F.ceil(F.count("*") / part).alias("rounds"))
        numbered = left_over.join(many, "component").withColumn("round", 1 + F.pmod(F.xxhash64("doc_id", F.lit(2)), "rounds").cast("int"))
        numbered = written(numbered, "left-over")
        rounds = numbered.select("component", "round").distinct()
        visitors = numbered.withColumn("part", every_part()).withColumn("guest", F.lit(True))
        hosts = large.join(rounds, "component").withColumn("part", of_part).withColumn("guest", F.lit(False))
        links = links.unionByName(written(confirmed(hosts.select(*columns).unionByName(visitors.select(*columns))), "links"))

    labels = components(links.unionByName(tied))
    of_print = representatives.join(labels, representatives.doc_id == labels.id, "left").select("print_a", "print_b", F.coalesce("component", "doc_id").alias("component"))
    of_print = written(of_print, "components")
    with_set = full.select("doc_id", "n_shingles", "print_a", "print_b").join(of_print, ["print_a", "print_b"]).select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    without = signed.filter("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return with_set.unionByName(without).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
