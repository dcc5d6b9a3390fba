"""Quality rules: how much of a text lies inside repeated word n-grams and repeated lines.

Per text, 64-bit word hashes are folded into rolling n-gram hashes for several
lengths in numpy; the words covered by n-grams that occur twice or more are
marked and their characters counted.  The verdict compares the covered shares
with :data:`LIMITS`.

Defined results: a null or empty text (or one of white space) has no words, so
all counts are 0 and it is rejected; very long texts are worked on whole; rows
are independent, so ties, repeated rows and null ids change nothing; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripyard.llm.common import MIX, WordHashes, filter_texts, text_steps, to_batch

#: Largest share of the word characters that duplicated n-grams of each length may cover.
NGRAM_LIMITS = {5: 0.40, 6: 0.38, 8: 0.35, 10: 0.32}
#: Largest share of the text's characters in lines that repeat an earlier one.
LINE_LIMIT = 0.40
#: The base rule: fewer words than this, or more than this per cent of the words in repeated windows.
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30
SYMBOLS = b"#*$%&|<>"

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, dup_ngram_share array<double>, dup_line_share double"
)
_ARROW = [
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
    ("dup_ngram_share", pa.list_(pa.float64())), ("dup_line_share", pa.float64()),
]
_SPACES = b" \t\n\x0b\x0c\r"


def _covered(grams: np.ndarray, n: int) -> np.ndarray | None:
    """Words (by position) that lie in an n-gram occurring twice or more; None: no such n-gram."""
    values, inverse, counts = np.unique(grams, return_inverse=True, return_counts=True)
    if len(values) == len(grams):
        return None
    hit = counts[inverse] > 1
    edges = np.zeros(len(grams) + n, dtype=np.int64)
    edges[: len(grams)] += hit
    edges[n:] -= hit
    return np.cumsum(edges)[:-1] > 0


def measure(text: bytes, hashes: WordHashes) -> tuple:
    """The result row of one text (UTF-8)."""
    words = text.split()
    n = len(words)
    lines = [x for x in text.split(b"\n") if x.strip(_SPACES)]
    dup_lines = dup_chars = 0
    seen: set[bytes] = set()
    for x in lines:
        if x in seen:
            dup_lines += 1
            dup_chars += len(x)
        seen.add(x)
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    if text.isascii():
        word_chars = sum(map(len, words))
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    else:
        lengths = np.fromiter((len(w.decode("utf-8", "replace")) for w in words), dtype=np.int64, count=n)
        word_chars = int(lengths.sum())
    shares = [0.0] * len(NGRAM_LIMITS)
    repeat = 0
    if n > min(NGRAM_LIMITS):
        h = hashes.array(words)
        h = h * MIX ^ (h >> np.uint64(32))
        gram, at, out = h, 1, 0
        for size in sorted({*NGRAM_LIMITS, WINDOW}):
            if n <= size:
                break
            while at < size:
                gram = gram[:-1] * MIX + h[at:]
                at += 1
            cover = _covered(gram, size)
            if cover is None:  # then no longer n-gram repeats either
                break
            if size in NGRAM_LIMITS:
                shares[sorted(NGRAM_LIMITS).index(size)] = float(lengths[cover].sum() / max(1, word_chars))
            if size == WINDOW:
                repeat = int(cover.sum())
    line_share = dup_chars / max(1, sum(map(len, lines)))
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
    kept = not failed and line_share <= LINE_LIMIT and all(s <= NGRAM_LIMITS[k] for k, s in zip(sorted(NGRAM_LIMITS), shares, strict=True))
    return n, word_chars, symbols, dup_lines, repeat, failed, kept, shares, line_share


def repetition_rules(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its key and the columns of :data:`SCHEMA`."""
    source = docs.select(docs[key], docs[text])
    out = pa.schema([(key, pa.int64()), *_ARROW])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, texts in text_steps(batches, text):
            rows = [measure(t, hashes) for t in texts]
            yield to_batch(out, batch.column(0).cast(pa.int64()), *map(list, zip(*rows, strict=True)))

    return source.mapInArrow(run, f"{key} long, {SCHEMA}")


def passing(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""

    def make_test():
        hashes = WordHashes()
        return lambda texts: [measure(t, hashes)[6] for t in texts]

    return filter_texts(docs, text, make_test)
