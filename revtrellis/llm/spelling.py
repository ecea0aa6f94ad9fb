"""Spelling variants: words one letter apart, found by PartEnum signatures of their letter multisets.

1. Words are counted over all documents by built-in expressions, summed in every map task before the shuffle.
2. The letters of a word are a binary vector: the k-th occurrence of a letter is one dimension. One inserted, deleted or
   replaced letter changes at most two of them, so near words have Hamming distance two at most.
3. PartEnum: the dimensions are dealt into `first` parts, in one of which the distance is at most 2 // first; that part's
   dimensions are dealt into `second` smaller ones, all but that many of which agree. A signature is a part, the smaller
   parts left out, and the word's letters in the others. Near words share a signature: an equality join finds them.
4. The join confirms each pair by its edit distance, so a pair that is not near leaves no row.
5. Words whose letters are so common that more than `crowd` words share a signature are joined on the words that one
   deletion makes of them instead, themselves included. Near words share one of these too, and at most as many
   words as the letter can stand in places times the alphabet share one, so no join key is larger. Words over 64 letters
   are joined on their halves there, one of which near words share, as their deletions would be too many.
6. A word's form is its near word of largest count, if that is at least `ratio` times its own. Forms are followed to the
   last by doubling; counts grow by `ratio` with each, so there are few rounds: log2 of log_ratio of the largest count.

Defined results: a null text has no words, a null id counts as the empty string; repeated rows count each. Ties between
near words of one count go to the first in code-point order. An empty table, or one without words, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtrellis.llm.common import ship, slices, written

SHORTEST = 6
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DISTANCE = 2
LONG = 64
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64


def damaged(run: Column, doc_id: Column, every: int = 199) -> Column:
    """The run without one of its letters, where `every` divides the checksum of id and run; else the run."""
    h = F.crc32(F.concat(doc_id, F.lit(":"), run).cast("binary"))
    place = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))).otherwise(run)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 5, shortest: int = SHORTEST, every: int = 199) -> DataFrame:
    """word, n: the words of at least `shortest` letters that occur `least` times or more. Runs shorter than that can't become one."""
    doc_id = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = docs.select(doc_id.alias("id"), F.explode(F.expr(f"regexp_extract_all({text_col}, '[A-Za-z\\u00C0-\\u00FF]{{{shortest},}}+', 0)")).alias("run"))
    lowered = runs.withColumn("run", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", CAPITALS, CAPITALS.lower())).otherwise(F.col("run")))
    words = lowered.select(damaged(F.col("run"), F.col("id"), every).alias("word"))
    return words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def signatures(word: Column, first: int = 1, second: int = 6, distance: int = DISTANCE) -> Column:
    """PartEnum signatures of a word's letter multiset, exact: as many texts as there are ways to leave smaller parts out."""
    letters = F.array_sort(F.split(word, ""))
    own_letters = lambda p: F.filter(letters, lambda c: (c != "") & (F.pmod(F.ascii(c), F.lit(first * second)) == p))
    pieces = [F.array_join(own_letters(p), "") for p in range(first * second)]
    out = []
    for i in range(first):
        own = range(i * second, (i + 1) * second)
        for gone in combinations(own, distance // first):
            out.append(F.concat_ws("|", F.lit(f"{i}:{','.join(map(str, gone))}"), *[pieces[p] for p in own if p not in gone]))
    return F.array(*out)


def _deletions(words: DataFrame) -> DataFrame:
    """word, n, key: hashes of the word and of all words that one deletion makes of it."""
    base, inverse = np.uint64(BASE), np.uint64(pow(BASE, -1, 1 << 64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, ns, found = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for word in words:
                codes = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
                powers = np.cumprod(np.append(np.uint64(1), np.full(len(codes) - 1, base)), dtype=np.uint64)
                heads = np.append(np.uint64(0), np.cumsum(codes * powers, dtype=np.uint64))
                found.append(np.unique(np.append(heads[:-1] + (heads[-1] - heads[1:]) * inverse, heads[-1])).view(np.int64))
            counts = np.array([len(x) for x in found], np.int64)
            of = pa.array(np.repeat(np.arange(len(words)), counts))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(of), pa.array(ns, pa.int64()).take(of), pa.array(np.concatenate(found) if found else [], pa.int64())], names=["word", "n", "key"])

    ship(words.sparkSession)
    return words.select("word", "n").mapInArrow(run, "word string, n bigint, key bigint")


def _halves(words: DataFrame) -> DataFrame:
    """word, n, key: hashes of the halves, of which near words share one. A half is cut for the word's own length and for one less, that of a word shortened."""
    keys = []
    for size in (F.length("word"), F.length("word") - 1):
        half = (size / 2).cast("int")
        keys += [F.xxhash64(F.lit("head"), size, F.substring("word", F.lit(1), half)), F.xxhash64(F.lit("tail"), size, F.substring("word", F.length("word") - size + half + 1, size - half))]
    return words.select("word", "n", F.explode(F.array(*keys)).alias("key"))


def _near(keyed: DataFrame, key: str) -> DataFrame:
    """a, a_n, b, b_n: pairs of words with one key and edit distance one, a before b."""
    left = keyed.select(F.col(key).alias("key"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = keyed.select(F.col(key).alias("other"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    near = (F.col("key") == F.col("other")) & (F.col("a") < F.col("b")) & (F.abs(F.length("a") - F.length("b")) <= 1) & (F.levenshtein("a", "b", 1) == 1)
    return left.join(right, near).drop("key", "other")


def near_pairs(words: DataFrame, first: int = 1, second: int = 6, crowd: int = 256) -> DataFrame:
    """a, a_n, b, b_n: every pair of words that differ by one inserted, deleted or replaced letter, once."""
    signed = written(words.select("word", "n", F.explode(signatures(F.col("word"), first, second)).alias("signature")), "signatures")
    crowded = written(signed.groupBy("signature").agg(F.count("*").alias("members")).filter(F.col("members") > crowd), "crowded")
    quiet = signed.join(crowded, "signature", "left_anti")
    pairs = _near(quiet, "signature")
    if not crowded.isEmpty():
        busy = signed.join(crowded, "signature", "left_semi").select("word", "n").distinct()
        keyed = _deletions(busy.filter(F.length("word") <= LONG + 1)).unionByName(_halves(busy.filter(F.length("word") >= LONG)))
        pairs = pairs.unionByName(_near(written(keyed, "deletions"), "key"))
    return pairs.distinct()


def forms(words: DataFrame, pairs: DataFrame, ratio: int = 5) -> DataFrame:
    """word, n, n_near, form, form_n: forms are null for words without a near word of `ratio` times their count."""
    there = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
    back = pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    best = there.unionByName(back).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    joined = words.join(best, "word", "left")
    known = -F.col("best.less") >= ratio * F.col("n")
    return joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(known, F.col("best.near")).alias("form"), F.when(known, -F.col("best.less")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """word, root: where following forms ends. Each round doubles the steps followed."""
    hops = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        hops = written(hops, "roots")
        if hops.join(hops.select(F.col("word").alias("next")), F.col("root") == F.col("next"), "left_semi").isEmpty():
            return hops
        further = hops.select(F.col("word").alias("next"), F.col("root").alias("further"))
        hops = hops.join(further, F.col("root") == F.col("next"), "left").select("word", F.coalesce("further", "root").alias("root"))


def variants(docs: DataFrame, least: int = 5, ratio: int = 5, first: int = 1, second: int = 6, crowd: int = 256) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the documents."""
    words = written(word_counts(docs, least=least), "words")
    formed = written(forms(words, near_pairs(words, first, second, crowd), ratio), "forms")
    found = formed.join(roots(formed), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
