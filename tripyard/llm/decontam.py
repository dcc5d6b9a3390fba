"""Benchmark decontamination by the q-gram lemma: texts that hold a benchmark passage up to an edit budget.

Texts and passages are compared in lower case, with ASCII punctuation and white space
as single spaces.  A passage (a benchmark item, or its overlapping windows where it is
long) of m characters may differ by k edits.  By the q-gram lemma such an occurrence
keeps at least t = m - q + 1 - k q of the passage's q-grams, and their diagonals (place
in the text minus place in the passage) lie within k of each other.  So

1. hashes of all q-grams of a text are looked up in a table of the benchmark's
   q-grams, and stretches that hold fewer than the least t of any passage are left;
2. in what is left, hits are counted for each passage and diagonal band; bands are
   k + 1 wide or more and overlap by k, so every occurrence lies in one whole band;
   bands with t hits or more are kept;
3. these are verified: the passage is aligned with the text inside the band, ends
   free in the text.  Where the text starts or ends inside the band, it is padded with
   a code that no text holds, so a passage that the edge cuts by some of its edits is found.

All accepted alignments count; those of one item that overlap by more than a quarter of
the shorter are one region.

The benchmark is a stated set of queries: it is held by the tasks in blocks of at most
:data:`BLOCK_CHARS` characters, and each block is searched in all texts.

An item shorter than :data:`MIN_CHARS` after normalisation is found where it stands word for
word, by one automaton over all such items.  So short a text is in many documents by
chance: :func:`find_leaks` reports it, :func:`decontaminate` removes no document for it.

Defined results: null and empty texts and items (or items of punctuation alone) match
nothing; texts of any length are searched whole, in overlapping stretches; repeated texts, ids and items each
match; an empty table on either side gives no rows; null ids are kept as null; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripyard.llm.common import MIX, filter_texts, text_steps, to_batch

Q = 8
#: Edits allowed for each character of a passage.
EDIT_RATE = 0.08
#: Longest passage that is searched whole; longer items are searched in windows of this length.
WINDOW_CHARS = 256
#: Items with fewer characters are searched word for word.
MIN_CHARS = 24
#: Characters of benchmark text that one search holds in each task.
BLOCK_CHARS = 4_000_000
#: Characters of a text that are searched at once.
STRETCH = 1 << 20
_TABLE_BITS = 22
#: Powers of the rolling hash's base by the characters that they shift over.
_BASES = {step: np.uint64(pow(int(MIX), step, 1 << 64)) for step in (1, 2, 4)}
_PUNCTUATION = bytes(range(0x21, 0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x7F))
_SPACED = bytes.maketrans(_PUNCTUATION + bytes(range(0x20)), b" " * (len(_PUNCTUATION) + 32))


def normalise(text: bytes) -> np.ndarray:
    """The code points of a text in comparable form."""
    lower = text.decode("utf-8", "replace").lower().encode()
    flat = b" ".join(lower.translate(_SPACED).split()).decode()
    return np.frombuffer(flat.encode("utf-32-le"), np.uint32)


def as_text(codes: np.ndarray) -> str:
    return codes.tobytes().decode("utf-32-le")


def grams(codes: np.ndarray) -> np.ndarray:
    """Rolling hash of the q characters from each place on (q is 8: three doublings)."""
    if len(codes) < Q:
        return np.zeros(0, np.uint64)
    h = (codes.astype(np.uint64) + np.uint64(1)) * MIX
    step = 1
    while step < Q:
        h = h[:-step] * _BASES[step] + h[step:]
        step *= 2
    return h ^ (h >> np.uint64(29))


def budget(m: int) -> int:
    """Edits allowed in m characters: the rate, as far as the lemma leaves a q-gram to look for."""
    return max(0, min(int(EDIT_RATE * m), (m - Q) // Q))


def least_shared(m: int) -> int:
    return m - Q + 1 - budget(m) * Q


@dataclass
class Index:
    """The passages of a block of items and their q-grams."""

    codes: list[np.ndarray]
    item: np.ndarray  # item row of each passage
    at: np.ndarray  # where the passage starts in its item
    gram: np.ndarray  # sorted q-gram hashes of all passages
    passage: np.ndarray  # the passage of each
    place: np.ndarray  # its place there
    table: np.ndarray  # which slots hold a q-gram
    lengths: np.ndarray  # of each passage: its characters, edit budget and least shared q-grams
    edits: np.ndarray
    shared: np.ndarray
    short: dict[str, list[int]]  # items that are searched word for word

    @staticmethod
    def of(items: list[bytes], with_short: bool = True) -> Index:
        codes, item, at = [], [], []
        short: dict[str, list[int]] = {}
        for i, raw in enumerate(items):
            c = normalise(raw)
            if len(c) < MIN_CHARS:
                if len(c) and with_short:
                    short.setdefault(as_text(c), []).append(i)
                continue
            last = max(0, len(c) - WINDOW_CHARS)
            for s in sorted({*range(0, last, WINDOW_CHARS // 2), last}):
                codes.append(c[s : s + WINDOW_CHARS])
                item.append(i)
                at.append(s)
        g = [grams(c) for c in codes]
        gram = np.concatenate(g) if g else np.zeros(0, np.uint64)
        passage = np.repeat(np.arange(len(g)), [len(x) for x in g]) if g else np.zeros(0, np.int64)
        place = np.concatenate([np.arange(len(x)) for x in g]) if g else np.zeros(0, np.int64)
        order = np.argsort(gram, kind="stable")
        table = np.zeros(1 << _TABLE_BITS, bool)
        table[(gram >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
        lengths = [len(c) for c in codes]
        return Index(
            codes, np.array(item, np.int64), np.array(at, np.int64), gram[order], passage[order], place[order], table,
            np.array(lengths, np.int64), np.array([budget(m) for m in lengths], np.int64), np.array([least_shared(m) for m in lengths], np.int64),
            short,
        )

    @cached_property
    def words(self) -> ahocorasick.Automaton:
        """Finds the short items between spaces; made in each task."""
        out = ahocorasick.Automaton()
        for own, items in self.short.items():
            out.add_word(f" {own} ", (len(own), items))
        out.make_automaton()
        return out

    def word_for_word(self, codes: np.ndarray) -> list[tuple[int, int, int, int]]:
        if not self.short or not len(codes):
            return []
        found = self.words.iter(f" {as_text(codes)} ")
        return [(i, end - n - 1, end - 1, 0) for end, (n, items) in found for i in items]


def banded_distance(passage: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edits between the passage and a part of ``text``, and where that part ends.

    ``text`` holds the band: cell (i, d) is text place i + d for d in 0..band, so a row
    is one vector operation.
    """
    m, n = len(passage), len(text)
    band = n - m + 1
    if band < 1:
        return m, 0
    big = m + 1
    row = np.zeros(band + 1, np.int64)  # before the first character: free start anywhere
    offsets = np.arange(band + 1)
    for i in range(m):
        place = i + offsets  # text characters before this cell: i + d
        same = np.full(band + 1, 1, np.int64)
        ok = place < n
        same[ok] = text[place[ok]] != passage[i]
        step = row + same  # both advance: same diagonal
        step[~ok] = big
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)  # passage advances alone
        # text advances alone: along the row to higher diagonals
        row = np.minimum.accumulate(step - offsets) + offsets
    end = int(np.argmin(row))
    return int(row[end]), m + end


def search(codes: np.ndarray, index: Index) -> list[tuple[int, int, int, int]]:
    """(item row, start, end, edits) of every region of a normalised text that holds an item, in text order for each item.

    A region is given by its best alignment.
    """
    found = index.word_for_word(codes)
    overlap = 2 * WINDOW_CHARS + 2 * budget(WINDOW_CHARS)
    for start in range(0, max(1, len(codes)), STRETCH):
        found += [(i, s + start, e + start, d) for i, s, e, d in _search(codes[start : start + STRETCH + overlap], index)]
    regions: list[tuple[int, int, int, int]] = []
    stop = 0  # where the region ends so far
    for i, s, e, d in sorted(found):
        if regions and regions[-1][0] == i:
            old = regions[-1]
            if 4 * (stop - s) > min(e - s, old[2] - old[1]):
                stop = max(stop, e)
                if d < old[3]:
                    regions[-1] = (i, s, e, d)
                continue
        regions.append((i, s, e, d))
        stop = e
    return regions


def _search(codes: np.ndarray, index: Index) -> list[tuple[int, int, int, int]]:
    if not len(index.gram) or len(codes) < Q:
        return []
    g = grams(codes)
    hit = index.table[(g >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)]
    at = np.nonzero(hit)[0]
    if not len(at):
        return []
    lengths, edits, shared = index.lengths, index.edits, index.shared
    # exact look-up of the places that the table lets through
    left = np.searchsorted(index.gram, g[at], side="left")
    real = index.gram[np.minimum(left, len(index.gram) - 1)] == g[at]
    at, left = at[real], left[real]
    # a stretch as long as the longest passage with its edits must hold the least number of any
    reach = int(lengths.max() + edits.max())
    inside = np.searchsorted(at, at + reach) - np.arange(len(at))
    rich = np.nonzero(inside >= shared.min())[0]
    if not len(rich):
        return []
    edges = np.zeros(len(at) + 1, np.int64)
    np.add.at(edges, rich, 1)
    np.add.at(edges, rich + inside[rich], -1)
    near = np.cumsum(edges)[:-1] > 0
    at, left = at[near], left[near]
    right = np.searchsorted(index.gram, g[at], side="right")
    n = right - left
    entry = np.repeat(left - (np.cumsum(n) - n), n) + np.arange(n.sum())
    passage, place = index.passage[entry], np.repeat(at, n)
    diagonal = place - index.place[entry] + WINDOW_CHARS  # never negative
    wide = edits[passage] + 1  # a band of 2k + 1 diagonals, a new one every k + 1
    first = diagonal // wide
    band = np.concatenate([first, first - 1])
    who = np.concatenate([passage, passage])
    over = np.concatenate([np.ones(len(first), bool), diagonal - first * wide < edits[passage]])
    key, count = np.unique(who[over] * (1 << 40) + band[over], return_counts=True)
    who, band = key >> 40, key & ((1 << 40) - 1)
    good = count >= shared[who]
    out: list[tuple[int, int, int, int]] = []
    for p, b in zip(who[good].tolist(), band[good].tolist(), strict=True):
        k, m = int(edits[p]), int(lengths[p])
        low = b * (k + 1) - WINDOW_CHARS - k
        high = low + m + 4 * k + 2
        stretch = codes[max(0, low) : max(0, high)]
        before, after = min(max(0, -low), high - low), max(0, high - max(low, len(codes)))
        if before or after:  # the band goes beyond the text: places there equal no character
            stretch = np.concatenate([np.zeros(before, np.uint32), stretch, np.zeros(after, np.uint32)])
        exact = stretch.tobytes().find(index.codes[p].tobytes())
        if exact >= 0 and exact % 4 == 0:  # no edits: nothing to align
            d, end = 0, exact // 4 + m
        else:
            d, end = banded_distance(index.codes[p], stretch)
        if d <= k:
            out.append((int(index.item[p]), max(0, low + end - m - d), min(len(codes), low + end), d))
    return out


def _blocks(benchmark: DataFrame, item: str, item_text: str) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of at most about :data:`BLOCK_CHARS` characters, each brought to the driver."""
    items = benchmark.select(benchmark[item].cast("long").alias("item"), benchmark[item_text].alias("t")).where("t is not null")
    chars = items.agg(F.sum(F.length("t")).alias("c")).first()["c"] or 0
    blocks = -(-chars // BLOCK_CHARS)
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "t"), F.lit(blocks)) == block) if blocks > 1 else items
        yield sorted(((r["item"], r["t"]) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(key, item, n_regions, edits, start, end) for every text row and benchmark item that it holds.

    Start and end are of the best region, in characters of the normalised text.
    """
    spark = docs.sparkSession
    names = (key, item, "n_regions", "edits", "start", "end")
    schema, ddl = pa.schema([(n, pa.int64()) for n in names]), ", ".join(f"`{n}` long" for n in names)
    source = docs.select(docs[key], docs[text])
    out = spark.createDataFrame([], ddl)
    for rows in _blocks(benchmark, item, item_text):
        ids = [r[0] for r in rows]
        shared = spark.sparkContext.broadcast(Index.of([r[1].encode() for r in rows]))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, ids=ids) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch, texts in text_steps(batches, 1):
                got: list[list] = [[] for _ in schema]
                for doc, raw in zip(batch.column(0).to_pylist(), texts, strict=True):
                    best: dict[int, list] = {}
                    for i, s, e, d in search(normalise(raw), index):
                        old = best.setdefault(i, [0, d, s, e])
                        old[0] += 1
                        if (d, s) < (old[1], old[2]):
                            old[1:] = [d, s, e]
                    for i, (n, d, s, e) in best.items():
                        for column, value in zip(got, (doc, ids[i], n, d, s, e), strict=True):
                            column.append(value)
                yield to_batch(schema, *got)

        out = out.union(source.mapInArrow(run, ddl))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark passage, with all their columns."""
    for rows in _blocks(benchmark, item, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(Index.of([r[1].encode() for r in rows], with_short=False))
        docs = filter_texts(docs, text, lambda shared=shared: lambda texts: [not search(normalise(t), shared.value) for t in texts])
    return docs
