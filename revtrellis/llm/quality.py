"""Quality classifier by co-training of a text view and a metadata view.

1. At most `most_labels` labelled ids, those of the smallest hashes, are sent to the scan of the documents. The scan
   writes the features of all documents with their labels: the text view has shares of character classes, lengths,
   repetition of words and lines, and hashed words; the metadata view has language, source and declared length. Only the rows of labelled
   documents hold their words. So no join is needed, and the plan has one shape at all sizes.
2. A logistic regression per view is fitted to the labelled documents but for the held-out ones. The fewer they are, the
   more strongly it is regularised.
3. In each round every view scores all unlabelled documents; those it is sure of (probability of either class at least
   `sure`) join the training rows of the other view with the class it gives them, and both views are fitted again.
4. On the held-out labelled documents each view's log-odds are calibrated (Platt); the combined score adds both
   calibrated log-odds and takes the prior off once. With fewer than `least_held` held-out documents of a
   class the views stay as fitted.
5. With labels of toxicity a second target is learned from the words. Each word (a bucket of its hash) of the labelled
   documents that are not held out has as evidence the log of how much more often it stands in toxic ones, less a standard
   error. A logistic regression turns the strongest words of a document, each without what the document itself adds
   to its evidence, and its number of words into log-odds, which are calibrated on the held-out documents; the score is the probability
   of good quality times that of not being toxic.
6. All documents are scored; those below `accept` are rejected. With fewer than `least` labelled documents of a class that are not held out
   there is too little to go by, and nothing is rejected for that target.

The fits are Spark ML jobs over the written features, so nothing of the corpus's size reaches the driver; of the words those
with evidence do, at most one for each bucket.

Defined results: a null text counts as empty, null metadata as a value of its own; labels without a document, or null
ones, are ignored; a document with contradicting labels counts once for each. Without enough labelled documents of both
classes there is nothing to learn from, and all documents are accepted with score 1; without enough toxic and other ones none
counts as toxic.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtrellis.llm.common import ship, written
from revtrellis.llm.wordhash import LOWER, PUNCTUATION, SPACE, words_of

HASHED_WORDS = 64
HASHED_SOURCES = 32
HASHED_LANGUAGES = 8
TOXIC_BUCKETS = 1 << 20
TOXIC_LEAST = 3  # toxic documents with a word
STRONGEST = 3
LINES = np.zeros(256, bool)
LINES[0x0A] = True

#: Character classes by byte: the share of each is a feature.
_CLASSES = [
    range(0x41, 0x5B),
    range(0x61, 0x7B),
    range(0x30, 0x3A),
    range(0x80, 0x100),
    (0x20,),
    (0x0A,),
    (0x2E, 0x2C),
    (0x21,),
    (0x3F,),
    (0x7C,),
    (0x23, 0x24, 0x25, 0x26, 0x2A, 0x40, 0x5E, 0x7E),
    (0x3C, 0x3E, 0x7B, 0x7D, 0x5B, 0x5D, 0x2F, 0x5C, 0x3D),
]
_CLASS_OF = np.zeros((256, len(_CLASSES)))
for _i, _members in enumerate(_CLASSES):
    _CLASS_OF[list(_members), _i] = 1
TEXT_FEATURES = len(_CLASSES) + 8 + HASHED_WORDS
META_FEATURES = HASHED_LANGUAGES + HASHED_SOURCES + 4


@dataclass(frozen=True)
class CoTraining:
    rounds: int = 2
    sure: float = 0.97
    accept: float = 0.5
    held_out: int = 5  # one labelled document in so many
    strength: float = 1e-3
    per_row: float = 0.5  # added to the strength, divided by the number of labelled rows
    iterations: int = 15
    least: int = 20  # labelled documents of a class without which a target is not learned
    least_held: int = 5  # held-out ones without which it is not calibrated
    most_labels: int = 20_000


def _distinct(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((values, owner))
    o, v = owner[order], values[order]
    new = np.append(True, (o[1:] != o[:-1]) | (v[1:] != v[:-1]))[: len(o)]
    return np.bincount(o[new], minlength=n)


def text_features(texts: list[bytes]) -> np.ndarray:
    out = np.zeros((len(texts), TEXT_FEATURES), np.float32)
    for w in words_of(texts, SPACE):
        n = len(w.first) - 1
        owner = np.repeat(np.arange(n), np.diff(w.offsets))
        counts = np.bincount(owner * 256 + w.data[w.offsets[0] : w.offsets[-1]], minlength=256 * n).reshape(n, 256).astype(float)
        counts[:, 0x0A] -= 1  # the mark between texts
        size = np.maximum(counts.sum(axis=1), 1)
        words = np.diff(w.first)
        word_owner = np.repeat(np.arange(n), words)
        many = np.maximum(words, 1)
        length = np.bincount(word_owner, weights=w.ends - w.starts, minlength=n)
        longest = np.zeros(n)
        np.maximum.at(longest, word_owner, (w.ends - w.starts).astype(float))
        hashed = np.bincount(word_owner * HASHED_WORDS + (w.hashes % np.uint64(HASHED_WORDS)).astype(np.int64), minlength=n * HASHED_WORDS).reshape(n, HASHED_WORDS)
        block = out[w.lo : w.lo + n]
        block[:, : len(_CLASSES)] = counts @ _CLASS_OF / size[:, None]
        at = len(_CLASSES)
        block[:, at] = np.log1p(words)
        block[:, at + 1] = length / many
        block[:, at + 2] = np.log1p(longest)
        block[:, at + 3] = _distinct(word_owner, w.hashes, n) / many
        letters = counts @ (_CLASS_OF[:, 0] + _CLASS_OF[:, 1])
        block[:, at + 4] = (counts @ _CLASS_OF[:, 0]) / np.maximum(letters, 1)
        block[:, at + 5] = words == 0
        block[:, at + 8 :] = hashed / many[:, None]
    at = len(_CLASSES) + 6
    for w in words_of(texts, LINES):
        n = len(w.first) - 1
        lines = np.diff(w.first)
        line_owner = np.repeat(np.arange(n), lines)
        out[w.lo : w.lo + n, at] = 1 - _distinct(line_owner, w.hashes, n) / np.maximum(lines, 1)
        out[w.lo : w.lo + n, at + 1] = np.log1p(lines)
    return out


def meta_features(languages: list, sources: list, sizes: list) -> np.ndarray:
    out = np.zeros((len(sizes), META_FEATURES), np.float32)
    for i, (language, source, size) in enumerate(zip(languages, sources, sizes)):
        out[i, zlib.crc32(repr(language).encode()) % HASHED_LANGUAGES] = 1
        out[i, HASHED_LANGUAGES + zlib.crc32(repr(source).encode()) % HASHED_SOURCES] = 1
        at = HASHED_LANGUAGES + HASHED_SOURCES
        if size is None or size < 0:
            out[i, at] = 1
        else:
            length = np.log1p(float(size))
            out[i, at + 1 :] = length, length * length / 10, size == 0
    return out


def word_buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of each text's lower-cased words, and where each text's begin."""
    found, counts = [], np.zeros(len(texts), np.int64)
    for w in words_of(texts, PUNCTUATION, LOWER):
        n = len(w.first) - 1
        owner = np.repeat(np.arange(n, dtype=np.int64), np.diff(w.first))
        both = np.unique(owner * TOXIC_BUCKETS + (w.hashes % np.uint64(TOXIC_BUCKETS)).astype(np.int64))
        counts[w.lo : w.lo + n] = np.bincount(both // TOXIC_BUCKETS, minlength=n)
        found.append((both % TOXIC_BUCKETS).astype(np.int32))
    return np.append(0, np.cumsum(counts)), np.concatenate(found) if found else np.zeros(0, np.int32)


@dataclass
class View:
    """Log-odds of one view, and their calibration."""

    weights: np.ndarray
    intercept: float
    slope: float = 1.0
    offset: float = 0.0

    def log_odds(self, features: np.ndarray) -> np.ndarray:
        return features @ self.weights + self.intercept


@dataclass
class Toxicity:
    """In how many toxic and other documents each word bucket (in order) stands, and what the strongest of a document say."""

    buckets: np.ndarray
    bad: np.ndarray
    fine: np.ndarray
    n_bad: int
    n_fine: int
    view: View | None = None

    def features(self, offsets: np.ndarray, buckets: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
        """own: the class (1 toxic, 0 not) of documents that are counted themselves and are left out of their own evidence."""
        n = len(offsets) - 1
        out = np.zeros((n, STRONGEST + 1), np.float32)
        out[:, STRONGEST] = np.log1p(np.diff(offsets))
        if not len(self.buckets) or not len(buckets):
            return out
        at = np.minimum(np.searchsorted(self.buckets, buckets), len(self.buckets) - 1)
        known = np.flatnonzero(self.buckets[at] == buckets)
        owner = np.searchsorted(offsets, known, "right") - 1
        mine_bad, mine_fine = (0, 0) if own is None else (own[owner] == 1, own[owner] == 0)
        bad, fine = self.bad[at[known]] - mine_bad + 0.5, self.fine[at[known]] - mine_fine + 0.5
        weight = np.log(bad / (self.n_bad - mine_bad + 1)) - np.log(fine / (self.n_fine - mine_fine + 1)) - np.sqrt(1 / bad + 1 / fine)
        strong = weight > 1
        owner, weight = owner[strong], weight[strong]
        order = np.lexsort((-weight, owner))
        owner, weight = owner[order], weight[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        top = place < STRONGEST
        out[owner[top], place[top]] = weight[top]
        return out

    def probability(self, offsets: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        odds = self.view.slope * self.view.log_odds(self.features(offsets, buckets)) + self.view.offset
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


@dataclass
class Model:
    text: View | None = None
    meta: View | None = None
    toxic: Toxicity | None = None
    prior: float = 0.0
    spec: CoTraining = field(default_factory=CoTraining)

    def scores(self, text: np.ndarray, meta: np.ndarray, offsets: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probability of good quality by the text view, by the metadata view, and of both, the latter times that of not being toxic."""
        clean = 1 - self.toxic.probability(offsets, buckets) if self.toxic else 1.0
        if self.text is None or self.meta is None:
            one = np.ones(len(text))
            return one, one, one * clean
        t = self.text.slope * self.text.log_odds(text) + self.text.offset
        m = self.meta.slope * self.meta.log_odds(meta) + self.meta.offset
        p = lambda x: 1 / (1 + np.exp(-np.clip(x, -50, 50)))
        return p(t), p(m), p(t + m - self.prior) * clean


def _columns(docs: DataFrame) -> DataFrame:
    """doc_id, text, lang, source, n_chars; what is missing is null."""
    have = set(docs.columns)
    kinds = {"text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
    return docs.select("doc_id", *[(F.col(c) if c in have else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()])


def _batch_features(batch: pa.RecordBatch, at: int, words: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    text, lang, source, size = (batch.column(at + i).to_pylist() for i in range(4))
    raw = [t.encode() if t else b"" for t in text]
    return text_features(raw), meta_features(lang, source, size), *(word_buckets(raw) if words else (np.zeros(len(raw) + 1, np.int64), np.zeros(0, np.int32)))


def _lists(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.ravel(), pa.float32()))


def _of_lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.asarray(column.value_lengths(), np.int64)
    return np.append(0, np.cumsum(counts)), np.asarray(column.flatten(), np.int32)


def marks(labels: DataFrame, spec: CoTraining, label_col: str, toxic_col: str | None) -> dict:
    """id -> (classes of quality, classes of toxicity) of at most most_labels labelled ids, those of the smallest hashes."""
    classes = lambda c: F.array_sort(F.collect_set(F.when(F.col(c).cast("int").isin(0, 1), F.col(c).cast("int"))))
    per_id = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(classes(label_col).alias("good"), (classes(toxic_col) if toxic_col else F.array().cast("array<int>")).alias("bad"))
    known = per_id.filter("size(good) + size(bad) > 0").orderBy(F.xxhash64("doc_id", F.lit(9)), "doc_id").limit(spec.most_labels)
    return {r["doc_id"]: (r["good"], r["bad"]) for r in known.collect()}


def features(docs: DataFrame, marked: dict) -> DataFrame:
    """doc_id, text and meta (arrays of the views' features), good and bad (classes of labelled documents, else empty), words (their distinct buckets)."""
    context = docs.sparkSession.sparkContext
    sent = context.broadcast(marked)  # at most most_labels entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, none = sent.value, ([], [])
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                text, meta, _, _ = _batch_features(part, 1, False)
                own = [known.get(i, none) for i in part.column(0).to_pylist()]
                offsets, buckets = word_buckets([t.encode() if t and m is not none else b"" for t, m in zip(part.column(1).to_pylist(), own)])
                listed = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(buckets, pa.int32()))
                classes = [pa.array([m[i] for m in own], pa.list_(pa.int32())) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(text), _lists(meta), *classes, listed], names=["doc_id", "text", "meta", "good", "bad", "words"])

    picked = _columns(docs)
    ship(docs.sparkSession)
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {kind}, text array<float>, meta array<float>, good array<int>, bad array<int>, words array<int>")


def _fit(rows: DataFrame, column: str, spec: CoTraining) -> View:
    """Logistic regression of `class` on an array column."""
    fitted = LogisticRegression(featuresCol="x", labelCol="y", maxIter=spec.iterations, regParam=spec.strength).fit(
        rows.select(array_to_vector(F.col(column)).alias("x"), F.col("class").cast("double").alias("y"))
    )
    return View(np.array(fitted.coefficients.toArray()), float(fitted.intercept))


def _log_odds(view: View, column: str) -> Column:
    return F.aggregate(F.zip_with(column, F.array(*[F.lit(float(x)) for x in view.weights]), lambda a, b: a * b), F.lit(view.intercept), lambda s, x: s + x)


def _held(spec: CoTraining) -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(spec.held_out)) == 0


def _seen(rows: DataFrame) -> dict[tuple[bool, int], int]:
    return {(r["held"], r["class"]): r["n"] for r in rows.groupBy("held", "class").agg(F.count("*").alias("n")).collect()}


def _calibrate(view: View, rows: DataFrame, column: str, spec: CoTraining) -> None:
    """Platt's slope and offset from held-out rows with a class."""
    platt = _fit(rows.select(F.array(_log_odds(view, column)).alias("odds"), "class"), "odds", CoTraining(strength=1e-2, iterations=spec.iterations))
    view.slope, view.offset = float(platt.weights[0]), platt.intercept


def _by_rows(spec: CoTraining, n: int) -> CoTraining:
    """The same, regularised by the number of labelled rows."""
    return replace(spec, strength=spec.strength + spec.per_row / max(n, 1))


def train_toxicity(table: DataFrame, spec: CoTraining) -> Toxicity | None:
    """Evidence of the words of labelled documents (class 1: toxic, 0: not), how it adds up, and its calibration."""
    rows = written(table.filter("size(bad) > 0").select("doc_id", "words", F.explode("bad").alias("class")).withColumn("held", _held(spec)), "marked")
    seen = _seen(rows)
    if not all(seen.get((False, c), 0) >= spec.least for c in (0, 1)):
        return None
    known = rows.select(F.explode("words").alias("word"), "class", (~F.col("held")).cast("int").alias("fit"))
    counts = known.groupBy("word").agg(F.sum("class").alias("bad"), F.count("*").alias("n"), F.sum(F.col("class") * F.col("fit")).alias("fit_bad"), F.sum("fit").alias("fit_n"))
    whole = lambda c: F.expr(c).cast("int").alias(c)
    told = counts.filter(F.col("bad") >= TOXIC_LEAST).select("word", whole("fit_bad"), whole("fit_n - fit_bad"), whole("bad"), whole("n - bad")).toArrow().sort_by("word")
    words, fit_bad, fit_fine, bad, fine = (np.asarray(c, np.int32) for c in told.columns)
    model = Toxicity(words, fit_bad, fit_fine, seen[False, 1], seen[False, 0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.where(np.asarray(batch.column(2).to_pylist(), bool), -1, np.asarray(batch.column(1).to_pylist(), int))
            yield pa.RecordBatch.from_arrays([_lists(model.features(*_of_lists(batch.column(0)), own)), batch.column(1), batch.column(2)], names=["strongest", "class", "held"])

    strongest = written(rows.select("words", "class", "held").mapInArrow(run, "strongest array<float>, class int, held boolean"), "strongest")
    model.view = _fit(strongest.filter(~F.col("held")), "strongest", CoTraining(strength=1e-4, iterations=spec.iterations))
    if all(seen.get((True, c), 0) >= spec.least_held for c in (0, 1)):
        _calibrate(model.view, strongest.filter("held"), "strongest", spec)
    # How evidence adds up is known now; the held-out documents add theirs.
    return Toxicity(words, bad, fine, seen[False, 1] + seen.get((True, 1), 0), seen[False, 0] + seen.get((True, 0), 0), model.view)


def train(table: DataFrame, spec: CoTraining = CoTraining()) -> Model:
    """Co-train on written features (see features)."""
    toxic = train_toxicity(table, spec)
    labelled = written(table.filter("size(good) > 0").select("doc_id", "text", "meta", F.explode("good").alias("class")).withColumn("held", _held(spec)), "labelled")
    free = table.filter("size(good) = 0").select("text", "meta")
    seen = _seen(labelled)
    if not all(seen.get((False, c), 0) >= spec.least for c in (0, 1)):
        return Model(toxic=toxic, spec=spec)
    known = labelled.filter(~F.col("held"))
    firm = _by_rows(spec, seen[False, 0] + seen[False, 1])
    views = {v: _fit(known, v, firm) for v in ("text", "meta")}
    limit = float(np.log(spec.sure / (1 - spec.sure)))
    for _ in range(spec.rounds):
        taught = {}
        for teacher, pupil in (("text", "meta"), ("meta", "text")):
            odds = _log_odds(views[teacher], teacher)
            sure = free.withColumn("odds", odds).filter(F.abs("odds") >= limit).select(pupil, (F.col("odds") > 0).cast("int").alias("class"))
            taught[pupil] = _fit(known.select(pupil, "class").unionByName(sure), pupil, firm)
        views = taught
    model = Model(views["text"], views["meta"], toxic, spec=spec)
    model.prior = float(np.log((seen[False, 1] + seen.get((True, 1), 0)) / (seen[False, 0] + seen.get((True, 0), 0))))
    if all(seen.get((True, c), 0) >= spec.least_held for c in (0, 1)):
        for name in ("text", "meta"):
            _calibrate(views[name], labelled.filter("held"), name, spec)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, text_score, meta_score, score, accepted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                t, m, s = model.scores(*_batch_features(part, 1, model.toxic is not None))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(t), pa.array(m), pa.array(s), pa.array(s >= model.spec.accept)], names=["doc_id", "text_score", "meta_score", "score", "accepted"])

    ship(docs.sparkSession)
    picked = _columns(docs)
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {kind}, text_score double, meta_score double, score double, accepted boolean")


def learn(docs: DataFrame, labels: DataFrame, spec: CoTraining = CoTraining(), label_col: str = "quality", toxic_col: str | None = None) -> Model:
    return train(written(features(docs, marks(labels, spec, label_col, toxic_col)), "features"), spec)


def classify(docs: DataFrame, labels: DataFrame, spec: CoTraining = CoTraining(), toxic_col: str | None = None) -> DataFrame:
    return score(docs, learn(docs, labels, spec, toxic_col=toxic_col))


def accepted(docs: DataFrame, labels: DataFrame, spec: CoTraining = CoTraining(), toxic_col: str | None = None) -> DataFrame:
    """The rows, with all their columns, that the classifier does not reject. Rows pass through in one scan, without a shuffle."""
    model = learn(docs, labels, spec, toxic_col=toxic_col)
    width = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                _, _, s = model.scores(*_batch_features(part, width, model.toxic is not None))
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(width)], schema=pa.schema([part.schema.field(i) for i in range(width)])).filter(pa.array(s >= model.spec.accept))

    picked = _columns(docs)
    viewed = docs.select("*", *[c.alias(f"_view_{i}") for i, c in enumerate([(F.col(c) if c in docs.columns else F.lit(None)).cast(picked.schema[c].dataType) for c in ("text", "lang", "source", "n_chars")])])
    return viewed.mapInArrow(run, docs.schema)
