"""Licence scans with a generalised suffix automaton of licence words.

The automaton holds the words of the phrases and templates. Every text is streamed through it; the matching statistics
give the places where a whole phrase stands, and the longest matches with the templates. Long matches that follow each
other both in the text and in a template, with small gaps, are chained; a chain covers a part of the template, and a
template covered far enough, or by enough words, gives its label.

Words: A-Z lower-cased, then runs of anything but ASCII characters other than letters and digits. Every match is confirmed on the words.

Defined results: a null or wordless text has no matches, labels or places and score 0; repeated rows are scanned each.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrellis.llm.common import ship, slices
from revtrellis.llm.suffix_automaton import ItemIndex
from revtrellis.llm.wordhash import LOWER, PUNCTUATION, words_of

#: Phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Notices of public licences and their labels.
TEMPLATES = (
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
        "and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
        "mit-notice",
    ),
    (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
        "you may obtain a copy of the license at http www apache org licenses license 2 0",
        "apache-notice",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
        "as published by the free software foundation either version 3 of the license or at your option any later version",
        "gpl-notice",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "bsd-notice",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
        "isc-notice",
    ),
    (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file",
        "mpl-notice",
    ),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-notice"),
)


@dataclass(frozen=True)
class ScanSpec:
    """Matches of at least min_words words are chained over gaps of at most max_gap; a label needs min_coverage of the template or min_covered words."""

    min_words: int = 5
    max_gap: int = 8
    min_coverage: float = 0.5
    min_covered: int = 20
    phrase_score: float = 0.5


class LicenceIndex:
    def __init__(self, phrases: tuple, templates: tuple):
        self.phrases = len(phrases)
        self.labels = [label for _, label in (*phrases, *templates)]
        self.index = ItemIndex([text.encode() for text, _ in (*phrases, *templates)])
        automaton = self.index.automaton
        self.whole: list[tuple[tuple[int, int], ...]] = [()] * len(automaton.link)
        for k in range(self.phrases):
            v = 0
            for c in self.index.items[k]:
                v = automaton.next[v][c]
            self.whole[v] = (*self.whole[v], (len(self.index.items[k]), k))
        for v in sorted(range(1, len(automaton.link)), key=automaton.length.__getitem__):
            if automaton.link[v] > 0:
                self.whole[v] = (*self.whole[v], *self.whole[automaton.link[v]])

    def stream(self, ids: list[int], min_words: int) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
        """Places of whole phrases as (first word, phrase); longest template matches as (first word, last word exclusive, state)."""
        places, matches = [], []
        before, seen = 0, 0
        for i, (v, n) in enumerate(self.index.automaton.walk(ids)):
            for length, k in self.whole[v]:
                if n >= length:
                    places.append((i + 1 - length, k))
            if seen >= min_words and n != seen + 1:
                matches.append((i - seen, i, before))
            before, seen = v, n
        if seen >= min_words:
            matches.append((len(ids) - seen, len(ids), before))
        return places, matches

    def chains(self, matches: list[tuple[int, int, int]], spec: ScanSpec) -> list[tuple[int, int, int, int]]:
        """(template, first word, last word exclusive, covered template words) of the chains, greedily in text order."""
        open_: dict[int, list[int]] = {}
        done = []
        for a, b, v in matches:
            for k, end in self.index.automaton.ends[v].items():
                if k < self.phrases:
                    continue
                chain = open_.get(k)
                if chain and a - chain[1] <= spec.max_gap and end - (b - a) >= chain[3] - (chain[1] - a if a < chain[1] else 0) and end > chain[3]:
                    chain[4] += min(b - a, end - chain[3])
                    chain[1], chain[3] = b, end
                else:
                    if chain:
                        done.append(chain)
                    open_[k] = [a, b, k, end, b - a]
        return [(k, a, b, covered) for a, b, k, _, covered in [*done, *open_.values()]]


@functools.lru_cache(maxsize=4)
def _index(phrases: tuple, templates: tuple) -> LicenceIndex:
    return LicenceIndex(phrases, templates)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: tuple = PHRASES, templates: tuple = TEMPLATES, spec: ScanSpec = ScanSpec()) -> DataFrame:
    """One row per document: id, n_words, phrase places (first_word, label) in order, covered template spans (label, first word, last word exclusive, coverage)."""
    ship(docs.sparkSession)
    picked = docs.select(F.col(id_col), F.col(text_col))
    kind = picked.schema[id_col].dataType.simpleString()
    place_type = pa.struct([("first_word", pa.int64()), ("label", pa.string())])
    span_type = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("coverage", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = _index(phrases, templates)
        items = mine.index.words
        for batch in slices(batches):
            texts = [t.encode() if t else b"" for t in batch.column(1).to_pylist()]
            n_words, places, spans = [], [], []
            for w in words_of(texts, PUNCTUATION, LOWER):
                ids, starts, stops = mine.index.stretches(w)
                size = len(w.first) - 1
                own_places: list[list] = [[] for _ in range(size)]
                own_matches: list[list] = [[] for _ in range(size)]
                homes = np.searchsorted(w.first, starts, "right") - 1
                for a, b, doc in zip(starts.tolist(), stops.tolist(), homes.tolist()):
                    base = int(w.first[doc])
                    part = ids[a:b].tolist()
                    word = lambda i: w.data[w.starts[i] : w.ends[i]].tobytes()
                    found, matches = mine.stream(part, spec.min_words)
                    for i, k in found:
                        if [word(a + i + j) for j in range(len(items[k]))] == items[k]:
                            own_places[doc].append({"first_word": a + i - base, "label": mine.labels[k]})
                    own_matches[doc] += [(a + i - base, a + j - base, v) for i, j, v in matches]
                for doc in range(size):
                    n_words.append(int(w.first[doc + 1] - w.first[doc]))
                    places.append(own_places[doc])
                    out = []
                    for k, a, b, covered in mine.chains(own_matches[doc], spec) if own_matches[doc] else ():
                        coverage = min(1.0, covered / len(items[k]))
                        if coverage >= spec.min_coverage or covered >= spec.min_covered:
                            out.append({"label": mine.labels[k], "first_word": a, "end_word": b, "coverage": coverage})
                    spans.append(sorted(out, key=lambda x: (x["first_word"], x["label"])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(places, pa.list_(place_type)), pa.array(spans, pa.list_(span_type))], names=[id_col, "n_words", "places", "spans"]
            )

    return picked.mapInArrow(
        run,
        f"{id_col} {kind}, n_words bigint, places array<struct<first_word:bigint,label:string>>, spans array<struct<label:string,first_word:bigint,end_word:bigint,coverage:double>>",
    )


def digests(docs: DataFrame, spec: ScanSpec = ScanSpec()) -> DataFrame:
    """Per document: counts and places of the phrases, labels, and a score: the best coverage of a template, and at least phrase_score where a phrase stands."""
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    more = F.transform("spans", lambda s: s["label"])
    return scan(docs, spec=spec).select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["first_word"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["first_word"])).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.greatest(F.when(F.size("places") > 0, spec.phrase_score).otherwise(0.0), F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0))).alias("score"),
    )
