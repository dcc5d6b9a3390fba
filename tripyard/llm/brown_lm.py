"""Brown class-based bigram model: P(w | v) = P(class(w) | class(v)) P(w | class(w)).

Exchange clustering puts words into classes so that the mutual information of adjacent
classes grows most.  The most frequent words (:data:`ITEMS`), whose bigram counts fit a
matrix, are moved one by one until nothing moves.  Every other training word is then
assigned by exchange steps on Spark: its counts of neighbours by class are added up over
the whole corpus, and it joins the class that these neighbours favour most.  In the first
step the neighbours are the words clustered one by one, in each further one
(:data:`ROUNDS`) all words that travel with the tasks, with the classes they have by then.
A word unseen in training is in the class that training words of its ending mostly have.
Class transitions are counted over all training tokens.

    P(b | a) = (n(a, b) + s q(b)) / (n(a) + s),   q(b) = (n(b) + 1) / (N + classes)
    P(w | b) = (c(w) + 1) / (n(b) + V(b) + 1)

so the words known in a class and one unknown word share its mass.

Texts are split twice: to count the words, and to write them as codes, which all further
passes read.  A code is a word's place among the most frequent ones (a fixed number, whose
counts and classes travel with the tasks) or a mark; the marked words are kept beside, and
meet their counts and classes in one join on the word.  What a task gathers is a
fixed-size array or pre-added counts, never its tokens.

Defined results: a null or empty text is its end token alone; texts are read whole;
repeated rows count, and are scored, each time; a null id is in no held-out fold, so
it is learnt from; an empty table gives no rows; without training texts every class
is equally likely; a training word without a known neighbour joins the class with most
tokens; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripyard.llm.common import TEXT_ROWS, fold, most_frequent, stored, text_steps, to_batch

#: Words that are moved one by one, and their classes (all other words have as many again).
ITEMS, CLASSES = 1024, 32
#: Exchange steps for all other words.
ROUNDS = 2
#: Words that travel with the tasks (eight megabytes).
CARRIED = 1 << 19
ENDING_BYTES, ENDINGS = 3, 1 << 16
#: Weight of the class frequencies in the smoothed transitions.
SMOOTHING = 5.0
SWEEPS = 8
#: Distinct words, or entries, that a task adds up before it passes them on.
HELD_WORDS = 1_000_000
#: Entries that a per-worker word cache may hold before it starts anew.
CACHE_ENTRIES = 400_000
#: Bytes of codes that one step inside a task works on.
CODE_STEP = 8 << 20
BLOCK = 1 << 14
FOLDS, HELD_OUT = 7, 2


def word_id(word: bytes) -> int:
    """16 bits of the word's ending, then 48 bits of the word."""
    ending = xxhash.xxh32_intdigest(word[-ENDING_BYTES:], seed=5) & (ENDINGS - 1)
    return (ending << 48) | (xxhash.xxh64_intdigest(word) >> 16)


END = word_id(b"\n")  # no word: words hold no white space
#: How neighbours' counts travel: the side and class, and the count.
_CELL = np.dtype([("cell", "u1"), ("n", "<u4")])


class WordPlaces(dict):
    """word -> its place among the ids met so far, so that tokens are counted without sorting them."""

    def __init__(self):
        super().__init__()
        self.ids, self.new = np.zeros(0, np.uint64), []

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self.ids) + len(self.new)
        self.new.append(word_id(word))
        return at

    def places(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The words' places, and the ids that were met for the first time."""
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        new = np.array(self.new, np.uint64)
        self.ids, self.new = np.concatenate([self.ids, new]), []
        return at, new


def split_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The words of all texts, each text closed by a line break, and every text's number of tokens."""
    words: list[bytes] = []
    lengths = []
    for t in texts:
        own = t.lower().split()
        lengths.append(len(own) + 1)
        words += own
        words.append(b"\n")
    return words, np.array(lengths, np.int64)


def _training(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(docs[text].alias("text"), (fold(key, FOLDS) != HELD_OUT).alias("train"))


# ------------------------------------------------------------------------------------ corpus counts
def word_counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(w, c, a) for every word: its count in the training texts and in all texts."""
    schema = pa.schema([("w", pa.int64()), ("c", pa.int64()), ("a", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, counts = WordPlaces(), np.zeros((2, 0), np.int64)
        held = [np.zeros(0, np.uint64), np.zeros((2, 0), np.int64)]

        def merged() -> list[np.ndarray]:
            w, inverse = np.unique(np.concatenate([held[0], met.ids]), return_inverse=True)
            both = np.concatenate([held[1], counts], axis=1)
            return [w, np.stack([np.bincount(inverse, weights=x, minlength=len(w)).astype(np.int64) for x in both])]

        for batch, texts in text_steps(batches, "text"):
            words, lengths = split_words(texts)
            train = np.repeat(batch.column(1).to_numpy(zero_copy_only=False).astype(bool), lengths)
            at, new = met.places(words)
            counts = np.pad(counts, ((0, 0), (0, len(new))))
            counts += np.stack([np.bincount(x, minlength=len(met.ids)) for x in (at[train], at)])
            if len(met) >= min(CACHE_ENTRIES, HELD_WORDS):
                held, met, counts = merged(), WordPlaces(), np.zeros((2, 0), np.int64)
            if len(held[0]) >= HELD_WORDS:
                yield to_batch(schema, held[0].view(np.int64), *held[1])
                held = [np.zeros(0, np.uint64), np.zeros((2, 0), np.int64)]
        held = merged()
        yield to_batch(schema, held[0].view(np.int64), *held[1])

    rows = _training(docs, key, text).mapInArrow(run, "w long, c long, a long")
    return stored(rows.groupBy("w").agg(F.sum("c").alias("c"), F.sum("a").alias("a")), "words", TEXT_ROWS)


def array_sum(rows: DataFrame, count: Callable[[pa.RecordBatch, np.ndarray], None], size: int) -> np.ndarray:
    """Every task adds its batches into an array of ``size`` numbers; the arrays' sum.

    The arrays travel in blocks, so the adding is spread over tasks; ``size`` is a
    parameter of the model, not of the corpus.
    """
    schema = pa.schema([("block", pa.int32()), ("part", pa.binary())])
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            if batch.num_rows:
                count(batch, total)
        for b in range(0, size, BLOCK):
            part = total[b : b + BLOCK]
            if part.any():
                yield to_batch(schema, [b // BLOCK], [part.tobytes()])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(part, np.int64)
                sums[b] = sums[b] + own if b in sums else own
        for b, part in sums.items():
            yield to_batch(schema, [b], [part.tobytes()])

    got = rows.mapInArrow(run, "block int, part binary").repartition(min(parts, -(-size // BLOCK)), "block")
    out = np.zeros(size, np.int64)
    for b, part in zip(*(c.to_pylist() for c in got.mapInArrow(add, "block int, part binary").toArrow().columns), strict=True):
        out[b * BLOCK : b * BLOCK + len(part) // 8] += np.frombuffer(part, np.int64)
    return out


# -------------------------------------------------------------------------------------------- codes
def coded(docs: DataFrame, key: str, text: str, words: np.ndarray) -> DataFrame:
    """(row, key, held_out, n, codes, rare): each text's tokens as places in ``words`` (sorted ids), -1 for others,
    which stand in ``rare`` in their order."""
    shared = docs.sparkSession.sparkContext.broadcast(words)
    schema = pa.schema([
        ("row", pa.int64()), (key, pa.int64()), ("held_out", pa.bool_()), ("n", pa.int64()), ("codes", pa.binary()), ("rare", pa.binary())
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        known, place = WordPlaces(), np.zeros(0, np.int32)
        for batch, texts in text_steps(batches, text):
            if len(known) >= CACHE_ENTRIES:
                known, place = WordPlaces(), np.zeros(0, np.int32)
            tokens, lengths = split_words(texts)
            at, new = known.places(tokens)
            found = np.searchsorted(words, new)
            there = found < len(words)
            there[there] = words[found[there]] == new[there]
            place = np.concatenate([place, np.where(there, found, -1).astype(np.int32)])
            codes = place[at]
            other = codes < 0
            rare = known.ids[at[other]]
            ends = np.cumsum(lengths)
            rare_ends = np.cumsum(other)[ends - 1]
            yield to_batch(
                schema, batch.column(0), batch.column(1).cast(pa.int64()), batch.column(3), lengths,
                [codes[e - n : e].tobytes() for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)],
                [rare[a:b].tobytes() for a, b in zip([0, *rare_ends.tolist()], rare_ends.tolist(), strict=False)],
            )

    source = docs.select(F.monotonically_increasing_id().alias("row"), docs[key], docs[text], (fold(key, FOLDS) == HELD_OUT).alias("held_out"))
    ddl = f"row long, {key} long, held_out boolean, n long, codes binary, rare binary"
    return stored(source.mapInArrow(run, ddl), "codes", TEXT_ROWS)


def _code_steps(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of the batch: first row, end, the rows' codes, and their lengths."""
    lengths, texts = batch.column("n").to_numpy(), batch.column("codes")
    ends = np.cumsum(lengths) * 4
    start = 0
    while start < len(lengths):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + CODE_STEP, side="right")))
        yield start, stop, np.frombuffer(b"".join(texts[start:stop].to_pylist()), np.int32), lengths[start:stop]
        start = stop


def _previous(values: np.ndarray, lengths: np.ndarray, first: int) -> np.ndarray:
    """The value before each token; ``first`` stands before a text."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[np.cumsum(lengths) - lengths] = first
    return out


def _next(values: np.ndarray, lengths: np.ndarray, last: int) -> np.ndarray:
    """The value after each token; ``last`` stands after a text."""
    out = np.empty_like(values)
    out[:-1] = values[1:]
    out[np.cumsum(lengths) - 1] = last
    return out


# --------------------------------------------------------------------------------------- clustering
def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """A class for each item of a bigram count matrix whose last item (all other words) keeps the last class.

    Maximises sum f(N(a, b)) - sum f(N(a, .)) - sum f(N(., b)) with f(x) = x log x: the
    mutual information of adjacent classes.
    """
    n = len(bigrams) - 1
    label = np.append(np.arange(n) % max(1, classes - 1), classes - 1)
    member = np.zeros((n + 1, classes))
    member[np.arange(n + 1), label] = 1
    table = member.T @ bigrams @ member
    left, right = bigrams.T @ member, bigrams @ member  # left[w, c]: tokens of class c before w
    for _ in range(sweeps):
        moved = 0
        for w in range(n):
            old, own, lw, rw = label[w], bigrams[w, w], left[w].copy(), right[w].copy()
            if not lw.any() and not rw.any():
                continue
            lw[old] -= own
            rw[old] -= own
            # take w out of its class
            table[:, old] -= lw
            table[old, :] -= rw
            table[old, old] -= own
            diag = np.diag(table)
            # putting w into k changes column k by lw and row k by rw; the cell (k, k) gets both and ``own``
            gain = (_xlogx(table + lw[:, None]) - _xlogx(table)).sum(axis=0) + (_xlogx(table + rw[None, :]) - _xlogx(table)).sum(axis=1)
            gain += _xlogx(diag + lw + rw + own) - _xlogx(diag + lw) - _xlogx(diag + rw) + _xlogx(diag)
            rows, cols = table.sum(axis=1), table.sum(axis=0)
            total_r, total_l = rw.sum() + own, lw.sum() + own
            # the margins of the other classes do not depend on k, but for what w itself adds to k
            base_r, base_c = rows + lw, cols + rw
            gain -= _xlogx(base_r + total_r) - _xlogx(base_r) + _xlogx(base_c + total_l) - _xlogx(base_c)
            gain[classes - 1] = -np.inf
            new = int(np.argmax(gain)) if gain.max() > gain[old] + 1e-9 else old
            table[:, new] += lw
            table[new, :] += rw
            table[new, new] += own
            if new != old:
                moved += 1
                label[w] = new
                left[:, old] -= bigrams[w]
                left[:, new] += bigrams[w]
                right[:, old] -= bigrams[:, w]
                right[:, new] += bigrams[:, w]
        if not moved:
            break
    return label


def cluster_items(training: DataFrame, items: np.ndarray, carried: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the words with the codes ``items``, one by one, and the bigram counts between them and all others."""
    m = len(items)
    item = np.full(carried + 1, m, np.int64)  # the last place is that of code -1
    item[items] = np.arange(m)
    first = int(item[end])

    def pairs(batch: pa.RecordBatch, total: np.ndarray) -> None:
        for _, _, codes, lengths in _code_steps(batch):
            own = item[codes]
            total += np.bincount(_previous(own, lengths, first) * (m + 1) + own, minlength=len(total))

    bigrams = array_sum(training.select("n", "codes"), pairs, (m + 1) ** 2).reshape(m + 1, m + 1).astype(float)
    return exchange(bigrams, CLASSES)[:m], bigrams


def preferences(bigrams: np.ndarray, label: np.ndarray, classes: int) -> np.ndarray:
    """How much a neighbour of each class speaks for each class of a word: (sides and neighbours' classes, classes)."""
    member = np.zeros((len(label), classes))
    member[np.arange(len(label)), label] = 1
    table = member.T @ bigrams @ member + 0.5
    pmi = np.log(table) - np.log(table.sum(axis=1, keepdims=True)) - np.log(table.sum(axis=0, keepdims=True))
    return np.concatenate([pmi, pmi.T])  # one before it: row of pmi; one after it: column


def assign(training: DataFrame, words: np.ndarray, class_of: np.ndarray, fixed: np.ndarray, gains: np.ndarray) -> DataFrame:
    """(w, cls) for every training word with a known neighbour, but the ``fixed`` ones: an exchange step.

    ``class_of`` has a class for each carried word, or -1 where it has none yet.  A task adds up
    (word, side, neighbour's class); a word's counts arrive together, from each task one row.
    """
    k = gains.shape[1]
    shared = training.sparkSession.sparkContext.broadcast((words, np.append(class_of, -1), np.append(fixed, False), gains))
    schema = pa.schema([("w", pa.int64()), ("cells", pa.binary())])

    def told(keys: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        cells = np.empty(len(keys), _CELL)
        cells["cell"], cells["n"] = keys % (2 * k), counts
        own = keys // (2 * k)
        starts = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
        raw, size = cells.tobytes(), _CELL.itemsize
        for at in range(0, len(starts), BLOCK):
            some = np.append(starts[at : at + BLOCK], starts[at + BLOCK] if at + BLOCK < len(starts) else len(own)) * size
            offsets = pa.py_buffer((some - some[0]).astype(np.int32).tobytes())
            blobs = pa.Array.from_buffers(pa.binary(), len(some) - 1, [None, offsets, pa.py_buffer(raw[some[0] : some[-1]])])
            yield to_batch(schema, ids[own[starts[at : at + BLOCK]]].view(np.int64), blobs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, class_of, fixed, _ = shared.value
        rare_ids = np.zeros(0, np.uint64)
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for a, b, codes, lengths in _code_steps(batch):
                side = class_of[codes].astype(np.int64)
                rare = np.frombuffer(b"".join(batch.column("rare")[a:b].to_pylist()), np.uint64)
                # the words met here that are not carried are numbered behind the carried ones
                met, place = np.unique(rare, return_inverse=True)
                both = np.union1d(rare_ids, met)
                if len(rare_ids):
                    moved = np.searchsorted(both, rare_ids)
                    own = keys // (2 * k)
                    far = own >= len(words)
                    keys = np.where(far, (len(words) + moved[np.where(far, own - len(words), 0)]) * (2 * k) + keys % (2 * k), keys)
                rare_ids = both
                number = codes.astype(np.int64)
                number[codes < 0] = len(words) + np.searchsorted(both, met)[place]
                before, after = _previous(side, lengths, -1), _next(side, lengths, -1)
                free = ~fixed[codes]
                left, right = free & (before >= 0), free & (after >= 0)
                more = np.concatenate([number[left] * (2 * k) + before[left], number[right] * (2 * k) + k + after[right]])
                own, n = np.unique(more, return_counts=True)
                merged, place = np.unique(np.concatenate([keys, own]), return_inverse=True)
                counts = np.bincount(place, weights=np.concatenate([counts, n]), minlength=len(merged)).astype(np.int64)
                keys = merged
                if len(keys) >= HELD_WORDS:
                    yield from told(keys, counts, np.concatenate([words, rare_ids]))
                    rare_ids, keys, counts = rare_ids[:0], keys[:0], counts[:0]
        yield from told(keys, counts, np.concatenate([words, rare_ids]))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by word: each word's gains are added up, batch by batch; holds the last word's."""
        out = pa.schema([("w", pa.int64()), ("cls", pa.int32())])
        gains = shared.value[3]
        open_word, open_gain = None, np.zeros(k)
        for batch in batches:
            if not batch.num_rows:
                continue
            w, raw = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            cells = np.frombuffer(b"".join(raw), _CELL)
            start = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            of_row = np.repeat(np.arange(len(w)), [len(x) // _CELL.itemsize for x in raw])
            group = np.cumsum(np.append(True, w[1:] != w[:-1]))[of_row] - 1
            table = np.bincount(group * (2 * k) + cells["cell"], weights=cells["n"], minlength=len(start) * 2 * k).reshape(-1, 2 * k)
            gain = table @ gains
            names = w[start]
            if open_word is not None and names[0] == open_word:
                gain[0] += open_gain
            elif open_word is not None:
                yield to_batch(out, [int(open_word)], [int(np.argmax(open_gain))])
            yield to_batch(out, names[:-1], np.argmax(gain[:-1], axis=1).astype(np.int32) if len(names) > 1 else np.zeros(0, np.int32))
            open_word, open_gain = names[-1], gain[-1]
        if open_word is not None:
            yield to_batch(out, [int(open_word)], [int(np.argmax(open_gain))])

    rows = training.select("n", "codes", "rare").mapInArrow(run, "w long, cells binary")
    dealt = rows.repartition("w").sortWithinPartitions("w")  # a word has one row of each task, so no word is large
    return stored(dealt.mapInArrow(choose, "w long, cls int"), "assigned", 4 * TEXT_ROWS)


# ------------------------------------------------------------------------------------------ scoring
def _ending_classes(classed: DataFrame, default: int) -> np.ndarray:
    """The class that the training tokens of each ending mostly have."""
    ending = F.shiftrightunsigned("w", 48).cast("int")
    by_class = classed.where("c > 0").groupBy(ending.alias("ending"), "cls").agg(F.sum("c").alias("n"))
    best = by_class.groupBy("ending").agg(F.max_by("cls", F.struct("n", "cls")).alias("cls"))
    out = np.full(ENDINGS, default, np.int64)
    for r in best.collect():  # at most ENDINGS rows
        out[r["ending"]] = r["cls"]
    return out


def class_of_all(docs: DataFrame, counts: DataFrame, codes: DataFrame, words: np.ndarray, word_c: np.ndarray) -> DataFrame:
    """(w, c, a, cls) for every word of the corpus."""
    training, k = codes.where("NOT held_out"), CLASSES
    # the most frequent training words, ties by id
    order = np.lexsort((words.view(np.int64), -word_c))
    items = np.sort(order[: min(ITEMS, int((word_c > 0).sum()))])
    end = int(np.searchsorted(words, np.uint64(END)))
    end = end if end < len(words) and words[end] == END else -1
    label, bigrams = cluster_items(training, items, len(words), end)
    class_of = np.full(len(words), -1, np.int16)
    class_of[items] = label
    fixed = np.zeros(len(words), bool)
    fixed[items] = True
    gains = preferences(bigrams, np.append(label, k - 1), k)
    assigned = assign(training, words, class_of, fixed, gains)
    for _ in range(1, ROUNDS):
        found = assigned.join(most_frequent(counts, "a", CARRIED).select("w"), "w", "left_semi").toArrow()
        at = np.searchsorted(words, found.column("w").to_numpy().view(np.uint64))
        class_of[at] = found.column("cls").to_numpy()
        assigned = assign(training, words, class_of, fixed, gains)
    spark = docs.sparkSession
    own = spark.createDataFrame([(int(w), int(c)) for w, c in zip(words[items].view(np.int64), label, strict=True)], "w long, item int")
    # items have the first classes, all other words the second ones
    joined = counts.join(assigned, "w", "left").join(F.broadcast(own), "w", "left")
    joined = joined.withColumn("cls", F.coalesce("item", F.col("cls") + k)).drop("item")
    sizes = joined.where(F.col("c") > 0).groupBy("cls").agg(F.sum("c").alias("n")).where(F.col("cls") >= k)
    most = sizes.orderBy(F.desc("n"), "cls").first()
    default = most["cls"] if most else k
    joined = stored(joined.withColumn("cls", F.when(F.col("c") > 0, F.coalesce("cls", F.lit(default)))), "classed")
    endings = _ending_classes(joined, default)
    schema = pa.schema([("w", pa.int64()), ("c", pa.int64()), ("a", pa.int64()), ("cls", pa.int32())])

    def unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = batch.column(0).to_numpy().view(np.uint64)
            cls = batch.column(3).fill_null(-1).to_numpy()
            cls = np.where(cls < 0, endings[(w >> np.uint64(48)).astype(np.int64)], cls).astype(np.int32)
            yield to_batch(schema, batch.column(0), batch.column(1), batch.column(2), cls)

    return stored(joined.select("w", "c", "a", "cls").mapInArrow(unseen, "w long, c long, a long, cls int"), "classes")


def _rare_rows(codes: DataFrame, classed: DataFrame, class_of: np.ndarray, end_class: int) -> DataFrame:
    """(row, held_out, prev, cls, after, c) of every token that is not carried: the classes before and after it.

    ``after`` is null where the next token is no carried one either: that one's row has the step.
    """
    schema = pa.schema([("row", pa.int64()), ("held_out", pa.bool_()), ("at", pa.int64()), ("w", pa.int64()), ("before", pa.int32()), ("after", pa.int32())])
    shared = codes.sparkSession.sparkContext.broadcast(np.append(class_of, -1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            for a, b, tokens, lengths in _code_steps(batch):
                side = class_of[tokens]
                other = tokens < 0
                row = np.repeat(batch.column("row")[a:b].to_numpy(), lengths)[other]
                held = np.repeat(batch.column("held_out")[a:b].to_numpy(zero_copy_only=False), lengths)[other]
                at = (np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths))[other]
                w = np.frombuffer(b"".join(batch.column("rare")[a:b].to_pylist()), np.int64)
                before, after = _previous(side, lengths, end_class)[other], _next(side, lengths, -1)[other]
                yield to_batch(schema, row, held, at, w, before.astype(np.int32), after.astype(np.int32))

    rows = codes.select("row", "held_out", "n", "codes", "rare").mapInArrow(run, "row long, held_out boolean, at long, w long, before int, after int")
    met = rows.join(classed.select("w", "c", "cls"), "w")
    out = pa.schema([("row", pa.int64()), ("held_out", pa.bool_()), ("prev", pa.int32()), ("cls", pa.int32()), ("after", pa.int32()), ("c", pa.int64())])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by text and place: the class before a token is its own text's last one's where none is carried."""
        last = -1
        for batch in batches:
            if not batch.num_rows:
                continue
            cls, before = batch.column("cls").to_numpy(), batch.column("before").to_numpy()
            prev = np.where(before >= 0, before, np.append(last, cls[:-1]))
            last = cls[-1]
            yield to_batch(out, batch.column("row"), batch.column("held_out"), prev.astype(np.int32), cls.astype(np.int32), batch.column("after"), batch.column("c"))

    dealt = met.select("row", "at", "held_out", "before", "after", "cls", "c").repartition("row").sortWithinPartitions("row", "at")
    return stored(dealt.mapInArrow(link, "row long, held_out boolean, prev int, cls int, after int, c long"), "rare", 4 * TEXT_ROWS)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The contract's row for every text: counts, the base's score and the model's, in log10."""
    counts = word_counts(docs, key, text)
    sums = counts.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    n, v = int(sums["n"] or 0), int(sums["v"] or 0)
    carried = most_frequent(counts, "a", CARRIED).select("w", "c").toArrow()
    words = carried.column("w").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(words)
    words, word_c = words[order], carried.column("c").to_numpy().astype(np.int64)[order]
    codes = coded(docs, key, text, words)
    classed = class_of_all(docs, counts, codes, words, word_c)
    k = 2 * CLASSES

    found = most_frequent(classed, "a", CARRIED).select("w", "cls").toArrow()
    class_of = np.zeros(len(words), np.int64)
    class_of[np.searchsorted(words, found.column("w").to_numpy().view(np.uint64))] = found.column("cls").to_numpy()
    end = classed.where(F.col("w") == int(np.array([END], np.uint64).view(np.int64)[0])).first()
    end_class = int(end["cls"]) if end else 0
    rare = _rare_rows(codes, classed, class_of, end_class)

    def moves(batch: pa.RecordBatch, total: np.ndarray) -> None:
        for _, _, tokens, lengths in _code_steps(batch):
            own = np.append(class_of, -1)[tokens]
            before = _previous(own, lengths, end_class)
            both = (own >= 0) & (before >= 0)
            total += np.bincount(before[both] * k + own[both], minlength=len(total))

    def rare_moves(batch: pa.RecordBatch, total: np.ndarray) -> None:
        prev, own, after = (batch.column(c).to_numpy().astype(np.int64) for c in ("prev", "cls", "after"))
        total += np.bincount(prev * k + own, minlength=len(total))
        total += np.bincount((own * k + after)[after >= 0], minlength=len(total))

    table = array_sum(codes.where("NOT held_out").select("n", "codes"), moves, k * k)
    table = (table + array_sum(rare.where("NOT held_out"), rare_moves, k * k)).reshape(k, k).astype(float)
    known = np.zeros(k)
    for r in classed.where("c > 0").groupBy("cls").agg(F.count(F.lit(1)).alias("v")).collect():
        known[r["cls"]] = r["v"]
    steps, shares = class_model(table, known)
    model = docs.sparkSession.sparkContext.broadcast((np.append(class_of, -1), np.append(word_c, 0), steps, shares))  # fixed sizes

    schema = pa.schema([
        ("row", pa.int64()), (key, pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("logs", pa.float64()), ("local", pa.float64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of, word_c, steps, shares = model.value
        for batch in batches:
            if not batch.num_rows:
                continue
            for a, b, tokens, lengths in _code_steps(batch):
                own = class_of[tokens]
                before = _previous(own, lengths, end_class)
                starts = np.cumsum(lengths) - lengths
                gain = np.where((own >= 0) & (before >= 0), steps[before, own], 0.0) - np.where(own >= 0, shares[own], 0.0)
                c = word_c[tokens]
                yield to_batch(
                    schema, batch.column("row")[a:b], batch.column(key)[a:b], batch.column("held_out")[a:b], lengths,
                    np.add.reduceat((c > 0).astype(np.int64), starts), np.add.reduceat(np.log10(c + 1.0), starts), np.add.reduceat(gain, starts),
                )

    ddl = f"row long, {key} long, held_out boolean, n_tokens long, n_known long, logs double, local double"
    scored = codes.select("row", key, "held_out", "n", "codes").mapInArrow(run, ddl)
    part = pa.schema([("row", pa.int64()), ("gain", pa.float64()), ("log", pa.float64()), ("known", pa.int64())])

    def rare_gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, steps, shares = model.value
        for batch in batches:
            prev, own, after, c = (batch.column(x).to_numpy().astype(np.int64) for x in ("prev", "cls", "after", "c"))
            gain = steps[prev, own] - shares[own] + np.where(after >= 0, steps[own, after], 0.0)
            yield to_batch(part, batch.column("row"), gain, np.log10(c + 1.0), (c > 0).astype(np.int64))

    others = rare.mapInArrow(rare_gains, "row long, gain double, log double, known long").groupBy("row").agg(
        F.sum("gain").alias("more"), F.sum("log").alias("more_logs"), F.sum("known").alias("more_known")
    )
    none = F.lit(0.0)
    logs = F.col("logs") + F.coalesce("more_logs", none)
    return scored.join(others, "row", "left").select(
        key, "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))).alias("base_score"),
        (logs + F.col("local") + F.coalesce("more", none)).alias("score"),
    )


def class_model(table: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 of the smoothed transitions, and of the mass that a class's words share, from transition counts and words."""
    size = table.sum(axis=0)
    q = (size + 1) / (size.sum() + len(table))
    return np.log10((table + SMOOTHING * q) / (table.sum(axis=1, keepdims=True) + SMOOTHING)), np.log10(size + known + 1)
