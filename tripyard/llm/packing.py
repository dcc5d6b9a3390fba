"""Packing: non-negative least squares over shallow combinations of piece lengths.

Every text is tokenised and cut into windows of ``window`` ids and one rest, so
only the rests need company.  All combinations of up to three lengths that fill a window
exactly are the columns of a sparse matrix; the number of times that each is
used is the non-negative least-squares fit to the histogram of rests.  The counts
are rounded down, and what the rounded plan leaves over in the histogram is packed
greedily, longest first, into the fullest sequence that still has room.

The plan is made from the histogram alone (at most ``window`` numbers), so its
size does not depend on the corpus.  It is applied to the rows by rank: the n-th
piece of a length takes that length's n-th slot.  Ranks come from counts for each
(length, bucket of ids), with small windows inside the buckets, so a length that
a third of the texts share is spread over many tasks.

Defined results: a null or empty text is one piece with the closing id alone;
texts of any length are tokenised whole; repeated rows are packed once for each
time they occur (repeated ids get ranks by their start and checksum); an empty
table gives no rows; extra columns are ignored; a null id is kept as null.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripyard.llm.common import TEXT_ROWS, stored, text_steps, to_batch

WINDOW = 1024
#: Pieces that one rank window holds on average.
BUCKET_ROWS = 20_000
#: Steps of the projected gradient that solves the least squares.
SOLVER_STEPS = 400


# ---------------------------------------------------------------------------------------- token ids
class TokenBytes:
    """Text -> its ids as little-endian unsigned 32-bit bytes.

    The tokenizer file decides.  With ``ranks_path`` (the same vocabulary as a rank
    file) the ids come from the rank library, which gives the same ids several times
    faster; a rank file holds no added tokens, so texts with one of the tokenizer
    file's go through the file's own library.
    """

    def __init__(self, tokenizer_path: str, ranks_path: str | None = None):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.whole = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        if ranks_path is None:
            self.encode = self.whole
        else:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as file:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            self.encode = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            ).encode_ordinary

    def __call__(self, text: str) -> bytes:
        encode = self.whole if any(t in text for t in self.added) else self.encode
        return array("I", encode(text)).tobytes()


def token_pieces(
    docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, key: str = "doc_id", text: str = "text",
    window: int = WINDOW, end_id: int = 0, with_ids: bool = False,
) -> DataFrame:
    """A row for each piece: key, start, length, ids_crc32, doc_tokens and, if asked for, its ids."""
    fields = [(key, pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    ddl = f"{key} long, start long, length long, ids_crc32 long, doc_tokens long"
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
        ddl += ", ids array<int>"
    schema = pa.schema(fields)
    closing = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = TokenBytes(tokenizer_path, ranks_path)
        for batch, texts in text_steps(batches, text):
            ids, start, length, crc, total, own = [], [], [], [], [], []
            for k, t in zip(batch.column(0).to_pylist(), texts, strict=True):
                b = encode(t.decode("utf-8", "replace")) + closing
                n = len(b) // 4
                for s in range(0, n, window):
                    piece = b[4 * s : 4 * min(n, s + window)]
                    ids.append(k)
                    start.append(s)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
                    if with_ids:
                        own.append(np.frombuffer(piece, dtype="<u4").astype(np.int32))
            yield to_batch(schema, ids, start, length, crc, total, *([own] if with_ids else []))

    return docs.select(docs[key], docs[text]).mapInArrow(run, ddl)


# --------------------------------------------------------------------------------------------- plan
def combinations(window: int) -> np.ndarray:
    """All (a, b, c), a >= b >= c >= 0, a < window, that add up to ``window``: two or three lengths."""
    a, b = np.meshgrid(np.arange(1, window), np.arange(1, window), indexing="ij")
    a, b = a.ravel(), b.ravel()
    c = window - a - b
    ok = (a >= b) & (c >= 0) & (b >= c)
    return np.stack([a[ok], b[ok], c[ok]], axis=1)


def solve_counts(columns: np.ndarray, histogram: np.ndarray, steps: int = SOLVER_STEPS) -> np.ndarray:
    """x >= 0 that minimises ||A x - histogram||, by accelerated projected gradient.

    Column j of A counts the lengths of ``columns[j]``; both products are a gather
    and a bin count.  The lengths are scaled by their frequency, so that rare and
    common lengths count alike.
    """
    size = len(histogram)
    weight = 1 / np.sqrt(np.maximum(histogram, 1.0))
    flat, n = columns.ravel(), len(columns)
    valid = np.where(np.arange(size) > 0, 1.0, 0.0)

    def forward(x: np.ndarray) -> np.ndarray:
        return np.bincount(flat, weights=np.repeat(x, columns.shape[1]), minlength=size) * valid

    def back(r: np.ndarray) -> np.ndarray:
        return (r * valid)[columns].sum(axis=1)

    # diagonal preconditioner: one step length for each column, from the row sums of A'WWA
    scale = back(weight**2 * forward(np.ones(n)))
    x = np.zeros(n)
    y, t = x, 1.0
    for _ in range(steps):
        nxt = np.maximum(0.0, y - back(weight**2 * (forward(y) - histogram)) / scale)
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = nxt + (t - 1) / s * (nxt - x)
        x, t = nxt, s
    return x


def greedy(rest: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Pack a histogram of lengths: longest first, into the fullest sequence that has room."""
    left = rest.astype(np.int64).copy()
    room: dict[int, list[list]] = {}  # free ids -> [parts, count] of open sequences
    for length in range(len(left) - 1, 0, -1):
        n = int(left[length])
        while n:
            fit = min((f for f in room if f >= length and room[f]), default=None)
            if fit is None:
                room.setdefault(window - length, []).append([(length,), n])
                break
            parts, count = room[fit].pop()
            if not room[fit]:
                del room[fit]
            take = min(n, count)
            if count > take:
                room.setdefault(fit, []).append([parts, count - take])
            room.setdefault(fit - length, []).append([(*parts, length), take])
            n -= take
    return [(parts, count) for group in room.values() for parts, count in group]


def packing_plan(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, how many such sequences) that use up the histogram (index: length < window)."""
    left = histogram.astype(np.int64).copy()
    plan: list[tuple[tuple[int, ...], int]] = []
    if left.sum():
        columns = combinations(window)
        columns = columns[((left[columns] > 0) | (columns == 0)).all(axis=1)]
        if len(columns):
            counts = np.floor(solve_counts(columns, histogram.astype(float)) + 1e-6).astype(np.int64)
            for j in np.argsort(-counts, kind="stable")[: int((counts > 0).sum())]:
                parts = [int(v) for v in columns[j] if v]
                need = np.bincount(parts, minlength=len(left))
                n = int(min(counts[j], (left[need > 0] // need[need > 0]).min()))
                if n:
                    plan.append((tuple(parts), n))
                    left -= n * need
    return plan + greedy(left, window)


def plan_slots(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """length -> rows (first rank, first sequence, offset), ascending by rank."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for parts, count in plan:
        offset = 0
        for length in parts:
            out.setdefault(length, []).append((used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + count
            offset += length
        sequence += count
    return {k: np.array(v, dtype=np.int64) for k, v in out.items()}


# ------------------------------------------------------------------------------------------ operator
def pack(pieces: DataFrame, key: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """``pieces`` (from :func:`token_pieces`, stored) with sequence_id and offset."""
    spark = pieces.sparkSession
    buckets = max(1, pieces.count() // BUCKET_ROWS + 1)
    salted = pieces.withColumn("_bucket", F.pmod(F.xxhash64(key, "start", "ids_crc32"), F.lit(buckets)))
    sizes = stored(salted.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("n")), "sizes")
    histogram = np.zeros(window + 1, dtype=np.int64)
    for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``window`` rows
        histogram[r["length"]] = r["n"]
    plan = packing_plan(histogram[:window], window)
    slots, first_full = plan_slots(plan), sum(count for _, count in plan)
    before = sizes.select(
        "length", "_bucket",
        (F.sum("n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("n")).alias("_before"),
    )
    ranked = (
        salted.join(before, ["length", "_bucket"])
        .withColumn(
            "_rank",
            F.col("_before") + F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(key, "start", "ids_crc32")) - 1,
        )
        .drop("_before", "_bucket")
    )
    names = [c for c in ranked.columns if c != "_rank"]
    schema = ranked.schema
    shared = spark.sparkContext.broadcast((slots, first_full))  # at most a few rows for each length

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, full = shared.value
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("_rank")).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for v in np.unique(length):
                own = length == v
                if v == window:
                    sequence[own] = full + rank[own]
                    continue
                s = slots[int(v)]
                at = np.searchsorted(s[:, 0], rank[own], side="right") - 1
                sequence[own] = s[at, 1] + rank[own] - s[at, 0]
                offset[own] = s[at, 2]
            cols = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != "_rank")
    return ranked.mapInArrow(place, f"{ddl}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, key: str = "doc_id", text: str = "text",
    window: int = WINDOW, with_ids: bool = False,
) -> DataFrame:
    """Packed pieces of every text: key, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    pieces = token_pieces(docs, tokenizer_path, ranks_path, key, text, window, with_ids=with_ids)
    return pack(stored(pieces, "pieces", TEXT_ROWS), key, window)
