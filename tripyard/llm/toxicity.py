"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier is trained from texts confirmed as toxic (P) and texts of
which nothing is known (U).  With the class prior p, the risk of the unseen
negatives is E_U[l(-g)] - p E_P[l(-g)]; the estimate is kept from turning
negative, as a flexible model would otherwise drive it below zero: while it is
negative, the step raises it instead of lowering the whole risk.

Features are the words of a text and the words' first four and five letters, each
present or not.  Those whose rates in P and U differ by more than chance would
are kept; their values are scaled by the log ratio of the rate in P to the
prior-corrected rate among negatives.

The fit reads a bounded sample of rows (:data:`MAX_POSITIVE`, :data:`MAX_UNLABELLED`):
those whose hash of id and text lies below a threshold that follows from the number of
rows, each different row once.  The sample's features are counted by Spark, and only those
that the fit keeps reach the driver.  The class prior is the share of toxic rows among all
labelled training rows.

Defined results: a null or empty text has no features and gets the score of the
bias alone; without a positive or an unlabelled training row every score is 0;
repeated rows are scored alike; null ids are scored and never learnt from; labels
with a null value are ignored; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripyard.llm.common import TEXT_ROWS, filter_texts, fold, hashed_below, stored, text_batches, text_steps, to_batch

#: Rows that the fit reads at most.
MAX_POSITIVE, MAX_UNLABELLED = 4_000, 12_000
#: How far, in standard errors, a feature's rates must differ to be kept.
MIN_Z = 5.0
#: Rows of P, and the share of P, that must have it: a word of one text and its copies says nothing.
MIN_POSITIVE, MIN_SHARE = 4, 0.01
STEPS, RATE, PENALTY = 300, 0.05, 1e-4
#: Bytes of sampled text that a task takes features of at once, and rows that it remembers.
SAMPLE_STEP, SEEN_ROWS = 1 << 20, 100_000
FOLDS = 5

_WORD = re.compile(r"[^\W\d_]+")


def features(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return words | {"4" + w[:4] for w in words if len(w) > 4} | {"5" + w[:5] for w in words if len(w) > 5}


def copy_key(text: str) -> int:
    """The smallest hash of a text's three-word runs: near copies mostly have the same one."""
    words = _WORD.findall(text.lower())
    runs = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
    return min(xxhash.xxh64_intdigest(r) for r in runs) - (1 << 63)


@dataclass
class Model:
    """score = sigmoid(bias + the weights of the features that a text has)."""

    bias: float = -40.0
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, text: str) -> float:
        own, weights = features(text), self.weights
        g = self.bias + sum(weights[f] for f in weights.keys() & own)
        return float(1 / (1 + np.exp(-np.clip(g, -40, 40))))


def _sigmoid(g: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(g, -40, 40)))


def nnpu_fit(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, positive: np.ndarray, prior: float, size: int) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk; the matrix is in (row, col, value) form.

    ``positive`` marks the rows of P; all others are U.  The loss is the sigmoid loss, which
    is bounded, so that a few rows with large scores cannot make the negatives' risk
    negative by themselves.  Adam on the whole sample.
    """
    n = len(positive)
    weight_p = positive / max(1, positive.sum())
    weight_u = ~positive / max(1, (~positive).sum())
    w, b = np.ones(size), float(np.log(max(prior, 1e-3)))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        s = _sigmoid(np.bincount(rows, weights=values * w[cols], minlength=n) + b)
        risk_negative = float((weight_u - prior * weight_p) @ s)  # l(-g) = s, l(g) = 1 - s
        slope = s * (1 - s)
        d_negative = (weight_u - prior * weight_p) * slope
        if risk_negative < 0:
            d = -d_negative
        else:
            d = d_negative - prior * weight_p * slope
        grad = np.append(np.bincount(cols, weights=values * d[rows], minlength=size) + PENALTY * (w - 1), d.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - float(move[-1])
    return w, b


def _coded(lists: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct strings, and the row and the string of every entry."""
    lengths = pc.list_value_length(lists).to_numpy().astype(np.int64)
    flat = pa.chunked_array([c.flatten() for c in lists.chunks], lists.type.value_type)
    coded = flat.dictionary_encode().unify_dictionaries()
    names = coded.chunk(0).dictionary if coded.num_chunks else pa.array([], pa.string())
    cols = np.concatenate([c.indices.to_numpy() for c in coded.chunks] or [np.zeros(0, np.int32)])
    return names, np.repeat(np.arange(len(lengths), dtype=np.int32), lengths), cols


def fit(lists: pa.Array | pa.ChunkedArray, positive: np.ndarray, copies: np.ndarray, prior: float) -> Model:
    """A model from each sample row's features (list of strings), whether it is in P, and its copy key.

    Of rows with one copy key one is learnt from, or the words of a much-copied text
    would look like evidence.
    """
    names, rows, cols = _coded(lists if isinstance(lists, pa.ChunkedArray) else pa.chunked_array([lists]))
    first = np.unique(np.stack([positive.astype(np.int64), copies]), axis=1, return_index=True)[1]
    learnt = np.full(len(positive), -1, np.int32)
    learnt[np.sort(first)] = np.arange(len(first))
    rows, cols, positive = learnt[rows][learnt[rows] >= 0], cols[learnt[rows] >= 0], positive[np.sort(first)]
    n_p, n_u = int(positive.sum()), int((~positive).sum())
    if not n_p or not n_u:
        return Model()
    in_p = np.bincount(cols[positive[rows]], minlength=len(names)).astype(float)
    in_u = np.bincount(cols, minlength=len(names)) - in_p
    rate_p, rate_u = in_p / n_p, in_u / n_u
    both = (in_p + in_u) / (n_p + n_u)
    z = np.abs(rate_p - rate_u) / np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / n_p + 1 / n_u))
    kept = np.nonzero((z >= MIN_Z) & (in_p >= max(MIN_POSITIVE, MIN_SHARE * n_p)))[0]
    if not len(kept):
        kept = np.argsort(-z, kind="stable")[:50]
    # what U has beyond the positives hidden in it comes from the negatives
    negative = np.maximum(0.0, in_u - prior * n_u / n_p * in_p)
    scale = np.log((in_p + 0.5) / (n_p + 1)) - np.log((negative + 0.5) / ((1 - prior) * n_u + 1))
    new = np.full(len(names), -1)
    new[kept] = np.arange(len(kept))
    use = new[cols] >= 0
    rows, cols = rows[use], new[cols[use]]
    w, b = nnpu_fit(rows, cols, scale[kept][cols], positive, prior, len(kept))
    return Model(b, dict(zip(names.take(pa.array(kept)).to_pylist(), (w * scale[kept]).tolist(), strict=True)))


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED,
) -> Model:
    """Fit on rows outside the held-out fold: labelled toxic ones and texts without regard to labels."""
    text_batches(docs)
    known = labels.where(F.col(label).isNotNull() & (fold(key, FOLDS) > 0)).groupBy(key).agg(F.max(label).alias("_y"))
    known = stored(known, "labels")
    share = known.agg(F.avg("_y").alias("p")).first()["p"]
    if not share:
        return Model()
    learnt = _sample(docs, known, key, text, max_positive, max_unlabelled)
    sizes = {r["p"]: r["n"] for r in learnt.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if not n_p or not n_u:
        return Model()
    kept = _telling(learnt, n_p, n_u)
    schema = pa.schema([("p", pa.bool_()), ("copy", pa.int64()), ("features", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [[f for f in row if f in kept] for row in batch.column(2).to_pylist()]
            yield to_batch(schema, batch.column(0), batch.column(1), own)

    got = learnt.select("p", "copy", "features").mapInArrow(run, "p boolean, copy long, features array<string>").toArrow()
    flags = got.column("p").combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
    return fit(got.column("features"), flags, got.column("copy").to_numpy().astype(np.int64), float(np.clip(share, 1e-3, 0.999)))


def _sample(docs: DataFrame, known: DataFrame, key: str, text: str, max_positive: int, max_unlabelled: int) -> DataFrame:
    """(p, copy, features) of the rows that the fit learns from: in P (p) or in U, one row of each copy key."""
    toxic = known.where("_y = 1").select(F.col(key).alias("id"))
    n_toxic = toxic.count()
    named = toxic.where(hashed_below(F.xxhash64("id", F.lit("sample")), max_positive, n_toxic)).withColumn("toxic", F.lit(True))
    source = docs.select(docs[key].alias("id"), docs[text].alias("text")).where(fold("id", FOLDS) > 0)
    rows = source.count()
    h = F.xxhash64("id", "text", F.lit("sample"))
    sides = F.array_compact(
        F.array(F.when(hashed_below(h, max_unlabelled, rows), F.lit(False)), F.when(F.col("toxic"), F.lit(True)))
    )
    # at most max_positive ids: a fixed bound
    marked = source.join(F.broadcast(named), "id", "left").select("text", h.alias("h"), F.explode(sides).alias("p"))
    schema = pa.schema([("h", pa.int64()), ("p", pa.bool_()), ("copy", pa.int64()), ("features", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, bool]] = set()  # a row that repeats is one row
        for batch, raw in text_steps(batches, "text", SAMPLE_STEP):
            sides = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            own = {x: t.decode("utf-8", "replace") for x, t in zip(sides, raw, strict=True) if x not in seen}
            if len(seen) > SEEN_ROWS:
                seen.clear()
            seen.update(own)
            read = list(own.values())
            yield to_batch(schema, [h for h, _ in own], [p for _, p in own], [copy_key(t) for t in read], [sorted(features(t)) for t in read])

    rows = stored(marked.mapInArrow(run, "h long, p boolean, copy long, features array<string>"), "sample", TEXT_ROWS)
    n_positive = rows.where("p").select("h").distinct().count()
    rows = rows.where(~F.col("p") | hashed_below(F.col("h"), max_positive, n_positive))  # ids with many texts
    return stored(rows.groupBy("p", "copy").agg(F.min_by("features", "h").alias("features")), "features")


def _telling(learnt: DataFrame, n_p: int, n_u: int) -> set[str]:
    """The features whose rates in P and U differ; many rows of P have each of them, so they are few."""
    each = learnt.select("p", F.explode("features").alias("f"))
    counts = each.groupBy("f").agg(F.count_if("p").alias("in_p"), F.count_if(~F.col("p")).alias("in_u"))
    rate_p, rate_u, both = F.col("in_p") / n_p, F.col("in_u") / n_u, (F.col("in_p") + F.col("in_u")) / (n_p + n_u)
    z = F.abs(rate_p - rate_u) / F.sqrt(F.greatest(both * (1 - both), F.lit(1e-12)) * (1 / n_p + 1 / n_u))
    counts = stored(counts.withColumn("z", z), "counts")
    kept = counts.where((F.col("z") >= MIN_Z) & (F.col("in_p") >= max(MIN_POSITIVE, MIN_SHARE * n_p)))
    names = {r["f"] for r in kept.select("f").collect()}
    return names or {r["f"] for r in counts.orderBy(F.desc("z"), "f").limit(50).collect()}


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """(key, held_out, score, predicted) for every row."""
    text_batches(docs)
    schema = pa.schema([(key, pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_steps(batches, text):
            s = [model.score(t.decode("utf-8", "replace")) for t in texts]
            yield to_batch(schema, batch.column(0).cast(pa.int64()), batch.column(2), s, [int(x >= threshold) for x in s])

    source = docs.select(docs[key], docs[text], (fold(key, FOLDS) == 0).alias("held_out"))
    return source.mapInArrow(run, f"{key} long, held_out boolean, score double, predicted int")


def clean(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are not called toxic, with all their columns."""
    return filter_texts(docs, text, lambda: lambda texts: [model.score(t.decode("utf-8", "replace")) < threshold for t in texts])
