"""What each of several document filters removes, for every order in which they can be applied.

1. One scan gives each document a failure mask, one bit per filter, and the digest of its text. The filter for copies
   takes two slim joins: the smallest id of each digest, met by (id, digest), so a text that a third of all documents
   share is dealt out by their ids.
2. Documents are counted by part and mask: at most 32 cells a part, whatever the size of the table.
3. Per part, a Gray-code walk visits all subsets of the filters, toggling one filter at a time. Each mask cell has a
   counter of its active failures (filters of the subset that it fails); a cell leaves the running survivors when its
   counter leaves 0 and comes back when it is 0 again. The survivors of the 32 subsets are stored.
4. A step of an order goes from one subset to the next: what it removes is the difference of two stored states.

Defined results: a null text counts as empty and a null part as the empty string; a document with several labels is good
(toxic) if one of them says so, one without is neither; an id that is null has no smaller one and is none, and
has no labels; rows with one id and one text are no copies of each other, but each counts. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtrellis.llm.common import ship, written

SPACES = "[\\x20\\x09-\\x0D]+"
#: Names of the filters; filter i has bit i of a mask. The last one is that for copies.
FILTERS = "ABCDE"
COPIES = 4
MEASURES = ("n", "good", "toxic")


def text_failures(text: Column) -> Column:
    """Mask of the filters that look at one text: A few words, B repetitive, C capitals, D marks."""
    words = F.array_remove(F.split(text, SPACES), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    failures = (
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)).cast("long") < 50 * F.size(words).cast("long"),
        100 * capitals.cast("long") > 3 * F.length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    )
    mask = F.lit(0)
    for i, failed in enumerate(failures):
        mask = mask + F.when(failed, 1 << i).otherwise(0)
    return mask


def failure_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """doc_id, part, mask of every row: bit i is set if filter i fails it."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    slim = docs.select(F.col(id_col).alias("doc_id"), part.alias("part"), text_failures(text).alias("mask"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    slim = written(slim, "masks")
    first = slim.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    named = slim.filter("doc_id IS NOT NULL").join(first.filter("doc_id IS NOT NULL"), ["digest", "doc_id"], "left")
    named = named.select("doc_id", "part", (F.col("mask") + F.when(F.col("is_first"), 0).otherwise(1 << COPIES)).alias("mask"))
    return named.unionByName(slim.filter("doc_id IS NULL").select("doc_id", "part", "mask"))


def cells(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask and the documents of that cell: n, good, toxic. labels: doc_id, quality, toxic."""
    marks = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    marked = masks.filter("doc_id IS NOT NULL").join(marks, "doc_id", "left").select("part", "mask", "good", "toxic")
    nameless = masks.filter("doc_id IS NULL").select("part", "mask", F.lit(None).cast("long").alias("good"), F.lit(None).cast("long").alias("toxic"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return marked.unionByName(nameless).groupBy("part", "mask").agg(F.count("*").alias("n"), total("good"), total("toxic"))


def survivors(counts: np.ndarray) -> np.ndarray:
    """What passes all filters of a subset, for every subset: rows of `counts` are masks, its columns measures; the result's rows are subsets."""
    size = len(counts)
    bits = size.bit_length() - 1
    states = np.zeros_like(counts)
    active = np.zeros(size, np.int64)
    masks = np.arange(size)
    failing = [np.flatnonzero(masks >> i & 1) for i in range(bits)]
    alive, subset = counts.sum(axis=0), 0
    states[0] = alive
    for step in range(1, size):
        toggled = (step & -step).bit_length() - 1
        hit = failing[toggled]
        if subset >> toggled & 1:
            active[hit] -= 1
            alive = alive + counts[hit[active[hit] == 0]].sum(axis=0)
        else:
            alive = alive - counts[hit[active[hit] == 0]].sum(axis=0)
            active[hit] += 1
        subset ^= 1 << toggled
        states[subset] = alive
    return states


def steps(counts: np.ndarray, names: str) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of all orders; columns of counts: n, good, toxic."""
    states = survivors(counts)
    fails = [int(counts[np.arange(len(counts)) >> i & 1 == 1, 0].sum()) for i in range(len(names))]
    rows, shares = [], [0] * len(names)
    for order in permutations(range(len(names))):
        before = 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            removed, good, toxic = (states[before] - states[after]).tolist()
            shares[i] += removed
            rows.append(("".join(names[j] for j in order), step, int(states[after, 0]), removed, fails[i] - removed, int(counts[1 << i, 0]), good, toxic, i))
            before = after
    return [(*row[:-1], shares[row[-1]]) for row in rows]


def audit(counted: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row per part, order and step from the cells (see `cells`)."""
    kinds = [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())] + [(c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.zeros((1 << len(names), len(MEASURES)), np.int64)
                for cell in found:
                    counts[cell["mask"]] += [cell[m] for m in MEASURES]
                columns = zip(*[(part, *row) for row in steps(counts, names)])
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, kinds)], names=[n for n, _ in kinds])

    ship(counted.sparkSession)
    # A part has at most one row per mask here, so its list is as short.
    together = counted.groupBy("part").agg(F.collect_list(F.struct("mask", *MEASURES)).alias("cells"))
    return together.mapInArrow(run, "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint")


def filter_interactions(docs: DataFrame, labels: DataFrame, part_col: str = "lang") -> DataFrame:
    return audit(cells(failure_masks(docs, part_col=part_col), labels))


#: The same in DuckDB: masks, cells, then every order's subsets joined with the cells.
SQL = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
     w AS (SELECT doc_id, part, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM t),
     e AS (SELECT text, min(doc_id) AS first_id FROM t GROUP BY text),
     m AS (SELECT w.doc_id, w.part,
                  CASE WHEN len(w.words) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w.words)) < 50 * len(w.words) THEN 2 ELSE 0 END
                  + CASE WHEN 100 * length(regexp_replace(w.text, '[^A-Z]+', '', 'g')) > 3 * length(w.text) THEN 4 ELSE 0 END
                  + CASE WHEN regexp_matches(w.text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN w.doc_id > e.first_id THEN 16 ELSE 0 END AS mask
           FROM w JOIN e ON w.text = e.text),
     l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
     c AS (SELECT m.part, m.mask, count(*) AS n, sum(coalesce(l.good, 0)) AS good, sum(coalesce(l.toxic, 0)) AS toxic FROM m LEFT JOIN l ON m.doc_id = l.doc_id GROUP BY m.part, m.mask),
     f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
     o AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
           FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
     s AS (SELECT filter_order, CAST(i AS INTEGER) AS step, bits[i] AS bit, CAST(coalesce(list_sum(bits[1:i - 1]), 0) AS INTEGER) AS before FROM o, unnest([1, 2, 3, 4, 5]) AS u(i)),
     r AS (SELECT c.part, s.filter_order, s.step, s.bit,
                  coalesce(sum(n) FILTER (WHERE c.mask & (s.before | s.bit) = 0), 0) AS kept,
                  coalesce(sum(n) FILTER (WHERE c.mask & s.before = 0 AND c.mask & s.bit <> 0), 0) AS removed,
                  coalesce(sum(n) FILTER (WHERE c.mask & s.before <> 0 AND c.mask & s.bit <> 0), 0) AS redundant,
                  coalesce(sum(n) FILTER (WHERE c.mask = s.bit), 0) AS unique_fails,
                  coalesce(sum(good) FILTER (WHERE c.mask & s.before = 0 AND c.mask & s.bit <> 0), 0) AS good_lost,
                  coalesce(sum(toxic) FILTER (WHERE c.mask & s.before = 0 AND c.mask & s.bit <> 0), 0) AS toxic_lost
           FROM c, s GROUP BY c.part, s.filter_order, s.step, s.bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""
