"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j).  The pairwise sum is
half of sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2), so a text costs time in
proportion to its features.  Words are hashed raw (with their punctuation) and
together have length 1; each structure statistic, and the length that the table
states, is one of a few bins, whose interactions with words and other bins the
factors learn.  Trained in numpy with AdaGrad.

The fit reads at most :data:`MAX_LABELLED` labelled rows: those whose hash lies below a
threshold that follows from the number of labelled ids, each different row once.  What
travels to the driver is a row's feature indices, two bytes each.

Defined results: a null or empty text has no words and falls into the zero bins;
without labelled training rows every score is 0.5; a null in the metadata column
has a bin of its own; repeated rows are scored alike; null ids are scored and
never learnt from; several labels for one id: the smallest counts; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripyard.llm.common import TEXT_ROWS, WordHashes, fold, hashed_below, stored, text_batches, text_steps, to_batch

#: Rows that the fit reads at most.
MAX_LABELLED = 20_000
WORD_BITS, FACTORS = 14, 8
EPOCHS, BATCH, RATE, PENALTY = 8, 512, 0.1, 1e-5
FOLDS = 5
#: Rows that a task remembers.
SEEN_ROWS = 100_000

#: Upper ends of the bins of each statistic; a further bin holds what is above.
BINS = {
    "words": np.array([0, 5, 10, 20, 50, 100, 200, 500, 1000, 5000]),
    "symbols": np.array([0, 0.005, 0.02, 0.1, 0.3, 1, 2]),
    "marks": np.array([0, 0.01, 0.05, 0.2, 0.5, 1]),
    "pipes": np.array([0, 0.01, 0.05, 0.2, 0.4]),
    "upper": np.array([0, 0.01, 0.05, 0.1, 0.3, 0.6]),
    "digits": np.array([0, 0.005, 0.02, 0.05, 0.15, 0.4]),
    "distinct": np.array([0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]),
    "adjacent": np.array([0, 0.01, 0.03, 0.06, 0.1, 0.3, 0.6]),
    "lines": np.array([0, 0.05, 0.1, 0.2, 0.4, 0.7]),
    "windows": np.array([0, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.8]),
    "word_bytes": np.array([2, 3, 4, 5, 6, 7, 8, 10, 15]),
    "stated": np.array([-1, 0, 20, 50, 100, 200, 500, 1000, 2000, 5000, 20000]),
}
_START = dict(zip(BINS, np.cumsum([0, *[len(b) + 1 for b in BINS.values()]]).tolist(), strict=False))
N_BINS = sum(len(b) + 1 for b in BINS.values())
SIZE = (1 << WORD_BITS) + N_BINS


def statistics(text: bytes, hashes: np.ndarray, stated: int | None) -> dict[str, float]:
    n = len(hashes)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=128) if text else np.zeros(128, np.int64)
    letters = max(1, int(counts[65:91].sum() + counts[97:123].sum()))
    lines = [x for x in text.split(b"\n") if x.strip()]
    windows = 0.0
    if n > 8:
        # four-word windows that occur again, by combined hashes
        w = hashes[:-3] * np.uint64(3) + hashes[1:-2] * np.uint64(7) + hashes[2:-1] * np.uint64(31) + hashes[3:] * np.uint64(127)
        windows = 1 - len(np.unique(w)) / len(w)
    return {
        "words": n,
        "symbols": counts[[35, 42, 36, 37, 38, 60, 62]].sum() / max(1, n),
        "marks": counts[[33, 63]].sum() / max(1, n),
        "pipes": counts[124] / max(1, n),
        "upper": counts[65:91].sum() / letters,
        "digits": counts[48:58].sum() / max(1, len(text)),
        "distinct": len(np.unique(hashes)) / max(1, n),
        "adjacent": float((hashes[1:] == hashes[:-1]).sum()) / max(1, n - 1),
        "lines": 1 - len(set(lines)) / max(1, len(lines)) if lines else 0.0,
        "windows": windows,
        "word_bytes": len(text) / max(1, n) - 1,
        "stated": -1 if stated is None else stated,
    }


def features(text: bytes, words: WordHashes, stated: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's features."""
    h = words.array(text.lower().split())
    buckets = np.unique(h >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    own = [
        (1 << WORD_BITS) + _START[k] + int(np.searchsorted(BINS[k], v, side="left"))
        for k, v in statistics(text, h, stated).items()
    ]
    values = np.concatenate([np.full(len(buckets), 1 / np.sqrt(max(1, len(buckets)))), np.ones(len(own))])
    return np.concatenate([buckets, np.array(own, dtype=np.int64)]), values


@dataclass
class Machine:
    w0: float
    w: np.ndarray
    v: np.ndarray

    def logits(self, cols: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One logit for each row; row i has the entries from starts[i] on (no row is empty)."""
        vx = self.v[cols] * values[:, None]
        s = np.add.reduceat(vx, starts)
        q = np.add.reduceat((vx * vx).sum(axis=1), starts)
        return self.w0 + np.add.reduceat(self.w[cols] * values, starts) + 0.5 * ((s * s).sum(axis=1) - q)


def _sigmoid(g: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(g, -40, 40)))


def fit(cols: np.ndarray, values: np.ndarray, lengths: np.ndarray, y: np.ndarray) -> Machine:
    """AdaGrad on the logistic loss; rows are slices of ``cols`` and ``values``."""
    rng = np.random.default_rng(7)
    share = np.clip(y.mean(), 0.01, 0.99) if len(y) else 0.5
    model = Machine(float(np.log(share / (1 - share))), np.zeros(SIZE), rng.normal(0, 0.02, (SIZE, FACTORS)))
    if not len(y):
        return model
    ends = np.cumsum(lengths)
    begins = ends - lengths
    gw, gv, g0 = np.full(SIZE, 1e-6), np.full((SIZE, FACTORS), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            rows = order[at : at + BATCH]
            n = lengths[rows]
            starts = np.cumsum(n) - n
            entry = np.repeat(begins[rows] - starts, n) + np.arange(n.sum())
            c, x = cols[entry], values[entry]
            own = np.repeat(np.arange(len(rows)), n)
            vx = model.v[c] * x[:, None]
            s = np.add.reduceat(vx, starts)
            logit = model.w0 + np.add.reduceat(model.w[c] * x, starts) + 0.5 * ((s * s).sum(axis=1) - np.add.reduceat((vx * vx).sum(axis=1), starts))
            d = (_sigmoid(logit) - y[rows]) / len(rows)
            touched, place = np.unique(c, return_inverse=True)
            dx = d[own] * x
            grad_w = np.bincount(place, weights=dx, minlength=len(touched)) + PENALTY * model.w[touched]
            each = dx[:, None] * (s[own] - vx)
            grad_v = np.stack([np.bincount(place, weights=each[:, f], minlength=len(touched)) for f in range(FACTORS)], axis=1)
            grad_v += PENALTY * model.v[touched]
            gw[touched] += grad_w**2
            gv[touched] += grad_v**2
            g0 += d.sum() ** 2
            model.w[touched] -= RATE * grad_w / np.sqrt(gw[touched])
            model.v[touched] -= RATE * grad_v / np.sqrt(gv[touched])
            model.w0 -= RATE * d.sum() / np.sqrt(g0)
    return model


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    stated: str | None = "n_chars", max_labelled: int = MAX_LABELLED,
) -> Machine | None:
    """Fit on labelled rows outside the held-out fold; None without any."""
    text_batches(docs)
    known = labels.where(F.col(label).isNotNull() & (fold(key, FOLDS) > 0)).groupBy(key).agg(F.min(label).alias("_y"))
    known = stored(known, "labels")
    # at most max_labelled ids: a fixed bound
    chosen = known.where(hashed_below(F.xxhash64(F.col(key), F.lit("sample")), max_labelled, known.count()))
    source = docs.select(docs[key], docs[text].alias("_text"), (docs[stated].cast("long") if stated else F.lit(None).cast("long")).alias("_n"))
    h = F.xxhash64(F.col(key), "_text", "_n")
    joined = source.join(F.broadcast(chosen), key).select(key, "_text", "_n", F.col("_y").cast("double").alias("_y"), h.alias("_h"))
    schema = pa.schema([("h", pa.int64()), ("y", pa.float64()), ("cols", pa.list_(pa.int16()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = WordHashes(), set()  # a row that repeats is one row
        for batch, texts in text_steps(batches, "_text"):
            places = {h: i for i, h in enumerate(batch.column(4).to_pylist()) if h not in seen}
            if len(seen) > SEEN_ROWS:
                seen.clear()
            seen.update(places)
            stated = batch.column(2).to_pylist()
            cols = [features(texts[i], words, stated[i])[0].astype(np.int16) for i in places.values()]
            yield to_batch(schema, list(places), batch.column(3).take(pa.array(list(places.values()), pa.int64())), cols)

    rows = joined.mapInArrow(run, "h long, y double, cols array<smallint>").groupBy("h").agg(F.min("y").alias("y"), F.first("cols").alias("cols"))
    rows = stored(rows, "sample", TEXT_ROWS)
    got = rows.where(hashed_below(F.col("h"), max_labelled, rows.count())).orderBy("h").select("y", "cols").toArrow()  # ids with many texts
    if not got.num_rows:
        return None
    lists = got.column("cols").combine_chunks()
    lengths, cols = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy().astype(np.int32)
    y = got.column("y").to_numpy()
    del got, lists
    return fit(cols, _values(cols, lengths), lengths, y)


def _values(cols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The values that :func:`features` gives the indices: a text's words together have length 1, its bins have 1 each."""
    words = cols < 1 << WORD_BITS
    own = np.repeat(np.arange(len(lengths)), lengths)
    n = np.bincount(own, weights=words, minlength=len(lengths))
    return np.where(words, 1 / np.sqrt(np.maximum(1, n))[own], 1.0).astype(np.float32)


def score(
    docs: DataFrame, model: Machine | None, key: str = "doc_id", text: str = "text", stated: str | None = "n_chars", threshold: float = 0.3
) -> DataFrame:
    """(key, held_out, score, predicted) for every row."""
    text_batches(docs)
    schema = pa.schema([(key, pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SIZE x (FACTORS + 1) numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, model = WordHashes(), shared.value
        for batch, texts in text_steps(batches, text):
            s = np.full(len(texts), 0.5)
            if model is not None:
                rows = [features(t, words, n) for t, n in zip(texts, batch.column(2).to_pylist(), strict=True)]
                lengths = np.array([len(c) for c, _ in rows])
                s = _sigmoid(model.logits(np.concatenate([c for c, _ in rows]), np.concatenate([v for _, v in rows]), np.cumsum(lengths) - lengths))
            yield to_batch(schema, batch.column(0).cast(pa.int64()), batch.column(3), s, (s >= threshold).astype(np.int32))

    source = docs.select(
        docs[key], docs[text], (docs[stated].cast("long") if stated else F.lit(None).cast("long")).alias("_n"),
        (fold(key, FOLDS) == 0).alias("held_out"),
    )
    return source.mapInArrow(run, f"{key} long, held_out boolean, score double, predicted int")
