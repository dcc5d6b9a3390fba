"""Phrases whose words stand together more often than chance, counted by HAT-tries.

Every task counts its texts' word sequences in a trie that is only two words deep: below
it, hash containers hold the rest of the sequences.  A container that grows past
:data:`BURST` entries bursts into a trie node with one container for each next word.  When
a task's tries hold more than :data:`HELD` entries, their largest subtrees are spilled as
sorted runs.  Spark's shuffle brings the runs of one prefix together, its sort merges
them, and one pass over the merged rows adds up every prefix.

A phrase can only be as frequent as its parts, so the lengths are counted in three passes:
words; pairs of frequent words; and, for three to five words, the sequence that starts at
each word, cut where a pair is not frequent, whose prefixes are all the phrases that start
there.  Which words and pairs are frequent travels to the tasks as a bitmap of hashed
places.  Its size follows their number up to a fixed bound; it never says no to a frequent
one, so it only saves work.

Words and pairs are added up before they are shuffled; longer sequences are dealt out by
their first three words, so that a pair which starts a third of all sequences is spread.

Counts are per language.  n is the number of words, f(phrase) its occurrences within
pieces, overlaps included.  A candidate has 2 to 5 words and a = f(phrase) >= 100.  A cut
after k words gives l = f(first part), r = f(rest) and floor(1000 a n / (l r)), in exact
decimals of 38 digits; the least cut counts.  A candidate that lies inside a longer one at
least as frequent is dropped.  The first 2,000 of every language are returned.

Defined results: a null text is an empty one, a null language is ``und``; pieces end at
``[.,;:!?]`` and line ends, words at spaces and tabs; repeated rows count each time; an empty
table, or one without a frequent phrase, gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripyard.llm.common import TEXT_ROWS, hashed_bitmap, is_set, mix_one, stored, text_steps, to_batch

#: A candidate's least count, the words of the longest one, and the rows of a language.
LEAST, LONGEST, MOST = 100, 5, 2000
NO_LANGUAGE = "und"
#: Entries of a container before it bursts, and of all tries of a task before they are spilled.
BURST, HELD = 4_096, 500_000
#: Rows of a spilled batch.
SPILL_ROWS = 10_000
#: Distinct words that a task adds up before it passes them on, and words whose ids it remembers.
HELD_WORDS, KNOWN_WORDS = 500_000, 300_000
#: Bytes of text worked on at once.
STEP = 2 << 20
#: Groups that a language's candidates are ranked in before the last ranking.
RANK_GROUPS = 64
#: Copies of a single word's count, so that candidates that share a word meet it in several tasks.
WORD_COPIES = 32

_BREAKS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)
_END = b"."  # between pieces; no word holds a full stop


def tokens(text: bytes) -> list[bytes]:
    """The words of a text with ``.`` where a piece ends."""
    return text.lower().translate(_BREAKS).replace(b"\n", b" . ").split()


# ------------------------------------------------------------------------------------- the trie
class Container(dict):
    """Rest of a sequence (ids as bytes) -> count."""


class Node(dict):
    """Next word id -> Container or Node."""


def _groups(ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each run of equal numbers: the number, where it starts and where it ends."""
    cuts = np.flatnonzero(np.diff(ids)) + 1
    starts = [0, *cuts.tolist()]
    return zip(ids[starts].tolist(), starts, [*cuts.tolist(), len(ids)], strict=True)


class HatTrie:
    """Counts of word-id sequences of one width, padded with zeros."""

    def __init__(self, width: int, burst: int = BURST, depth: int = 2):
        self.width, self.burst, self.depth = width, burst, min(depth, width - 1)
        self.root = Node()
        self.entries = 0
        self.sizes: Counter[int] = Counter()  # entries below each first word

    def add(self, rows: np.ndarray) -> None:
        """Count the rows of a (sequences, width) array of ids."""
        if not len(rows):
            return
        if self.width == 2:
            keys, counts = np.unique(rows[:, 0] << 32 | rows[:, 1], return_counts=True)
            rows = np.stack([keys >> 32, keys & 0xFFFFFFFF], axis=1).astype(">i4")
        else:
            keys, counts = np.unique(np.ascontiguousarray(rows, ">i4").view(f"V{4 * self.width}").ravel(), return_counts=True)
            rows = keys.view(">i4").reshape(-1, self.width)
        before = self.entries
        for first, lo, hi in _groups(rows[:, 0]):
            self._insert(self.root, first, rows, counts, 0, lo, hi)
            self.sizes[first] += self.entries - before
            before = self.entries

    def _insert(self, node: Node, step: int, rows: np.ndarray, counts: np.ndarray, level: int, lo: int, hi: int) -> None:
        """Put the sorted rows lo to hi, which agree up to ``level``, below a node's child."""
        child = node.get(step)
        if type(child) is Node:
            for after, a, b in _groups(rows[lo:hi, level + 1]):
                self._insert(child, after, rows, counts, level + 1, lo + a, lo + b)
            return
        if child is None:
            child = node[step] = Container()
        size, width = len(child), 4 * (self.width - level - 1)
        raw = rows[lo:hi, level + 1 :].tobytes()
        for at, n in zip(range(0, len(raw), width), counts[lo:hi].tolist(), strict=True):
            rest = raw[at : at + width]
            if rest in child:
                child[rest] += n
            else:
                child[rest] = n
        self.entries += len(child) - size
        if len(child) > self.burst and level + 1 < self.depth:
            node[step] = self._burst(child)

    def _burst(self, container: Container) -> Node:
        """The same entries one word deeper."""
        node = Node()
        for rest, n in container.items():
            step = int.from_bytes(rest[:4], "big")
            if step not in node:
                node[step] = Container()
            node[step][rest[4:]] = n
        return node

    def _containers(self, node: Node, prefix: list[int]) -> Iterator[tuple[list[int], Container]]:
        for step, child in node.items():
            if type(child) is Container:
                yield [*prefix, step], child
            else:
                yield from self._containers(child, [*prefix, step])

    def spill(self, leave: int) -> tuple[np.ndarray, np.ndarray]:
        """Take out the largest subtrees, each as a whole, until ``leave`` entries are left: their (sequences, counts)."""
        taken = Node()
        for first, size in self.sizes.most_common():
            if self.entries <= leave:
                break
            taken[first] = self.root.pop(first)
            del self.sizes[first]
            self.entries -= size
        by_depth: dict[int, tuple[list[list[int]], list[Container]]] = {}
        for prefix, container in self._containers(taken, []):
            prefixes, containers = by_depth.setdefault(len(prefix), ([], []))
            prefixes.append(prefix)
            containers.append(container)
        rows, counts = [np.zeros((0, self.width), np.int64)], [np.zeros(0, np.int64)]
        for depth, (prefixes, containers) in by_depth.items():
            sizes = [len(c) for c in containers]
            rests = np.frombuffer(b"".join(map(b"".join, containers)), ">i4").reshape(-1, self.width - depth)
            rows.append(np.hstack([np.repeat(np.array(prefixes, np.int64), sizes, axis=0), rests]))
            counts.append(np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for c in containers]))
        return np.concatenate(rows), np.concatenate(counts)


# ------------------------------------------------------------------------------- a task's counting
class Known(dict):
    """word -> id from 1 on if its place in the bitmap is set, else 0."""

    def __init__(self, lang: bytes, bitmap: np.ndarray):
        super().__init__({_END: 0})
        self.bits, self.shift = bitmap.tobytes(), 64 - (len(bitmap) * 8).bit_length() + 1
        self.seed = xxhash.xxh64_intdigest(lang, 42)
        self.names, self.hashes, self.rare = [b""], [0], 0

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, self.seed)  # as xxhash64(lang, word) gives
        at = mix_one(h) >> self.shift
        if not self.bits[at >> 3] >> (at & 7) & 1:
            if self.rare >= KNOWN_WORDS:
                for w in [w for w, i in self.items() if not i and w != _END]:
                    del self[w]
                self.rare = 0
            self.rare += 1
            self[word] = 0
            return 0
        got = self[word] = len(self.names)
        self.names.append(word)
        self.hashes.append(h)
        return got

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def pairs_in(ids: np.ndarray) -> np.ndarray:
    """Every two neighbours that both are known."""
    both = (ids[:-1] > 0) & (ids[1:] > 0)
    return np.stack([ids[:-1][both], ids[1:][both]], axis=1)


def runs_in(ids: np.ndarray, hashes: np.ndarray, pair_bitmap: np.ndarray) -> np.ndarray:
    """From every word on: up to five words, as far as neighbours are frequent pairs; three at least."""
    linked = np.zeros(len(ids) + LONGEST, bool)
    known = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    linked[known] = is_set(pair_bitmap, hashes[ids[known]], hashes[ids[known + 1]])
    start = np.flatnonzero(linked[: len(ids)] & linked[1 : len(ids) + 1])
    rows = np.zeros((len(start), LONGEST), np.int64)
    padded = np.append(ids, np.zeros(LONGEST, np.int64))
    going = np.ones(len(start), bool)
    for k in range(LONGEST):
        if k:
            going &= linked[start + k - 1]
        rows[:, k] = np.where(going, padded[start + k], 0)
    return rows


def _languages(batch: pa.RecordBatch, texts: list[bytes], place: int) -> dict[str, list[bytes]]:
    out: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column(place).to_pylist(), texts, strict=True):
        out.setdefault(lang, []).append(text)
    return out


def _source(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(docs[lang].cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), docs[text].alias("text"))


def count_words(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> DataFrame:
    """(lang, phrase, f) of the frequent words, and every language's number of words in a row without a phrase."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])

    def flush(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for own, counter in held.items():
            counter.pop(_END, None)
            words, n = list(counter), list(counter.values())
            yield to_batch(schema, [own] * (len(words) + 1), [*words, None], [*n, sum(n)])
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        for batch, texts in text_steps(batches, "text", STEP):
            for own, some in _languages(batch, texts, 0).items():
                counter = held.setdefault(own, Counter())
                for t in some:
                    counter.update(tokens(t))
            if sum(map(len, held.values())) >= HELD_WORDS:
                yield from flush(held)
        yield from flush(held)

    rows = _source(docs, text, lang).mapInArrow(run, "lang string, phrase string, n long")
    return stored(
        rows.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("phrase").isNull() | (F.col("f") >= least)), "words", TEXT_ROWS
    )


def _sequences(
    docs: DataFrame, text: str, lang: str, words: np.ndarray, width: int, pick: Callable[[np.ndarray, np.ndarray], np.ndarray]
) -> DataFrame:
    """(lang, words, n): what the tasks' tries spill, as sorted runs."""
    shared = docs.sparkSession.sparkContext.broadcast(words)
    schema = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string())), ("n", pa.int64())])

    def spill(own: str, known: Known, trie: HatTrie, leave: int) -> Iterator[pa.RecordBatch]:
        """The subtrees in the order of their words: one sorted run after another."""
        ids, n = trie.spill(leave)
        rank = np.empty(len(known.names), np.int64)
        rank[sorted(range(len(rank)), key=known.names.__getitem__)] = np.arange(len(rank))
        order = np.lexsort(rank[ids[:, ::-1]].T)
        ids, n = ids[order], n[order]
        names = pa.array(known.names, pa.string())
        for at in range(0, len(n), SPILL_ROWS):
            some = ids[at : at + SPILL_ROWS]
            ends = np.cumsum((some > 0).sum(axis=1))
            words = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), names.take(pa.array(some[some > 0])))
            yield to_batch(schema, pa.array([own] * len(some), pa.string()), words, n[at : at + SPILL_ROWS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[Known, HatTrie]] = {}
        for batch, texts in text_steps(batches, "text", STEP):
            for own, some in _languages(batch, texts, 0).items():
                if own not in held:
                    held[own] = Known(own.encode(), shared.value), HatTrie(width)
                known, trie = held[own]
                sequence: list[bytes] = []
                for t in some:
                    sequence += tokens(t)
                    sequence.append(_END)
                ids = known.ids(sequence)
                trie.add(pick(ids, np.array(known.hashes, np.uint64)))
            if sum(t.entries for _, t in held.values()) > HELD:
                for own, (known, trie) in held.items():
                    yield from spill(own, known, trie, trie.entries // 2)
            if sum(len(k.names) for k, _ in held.values()) > KNOWN_WORDS:  # the ids start anew
                for own, (known, trie) in held.items():
                    yield from spill(own, known, trie, 0)
                held.clear()
        for own, (known, trie) in held.items():
            yield from spill(own, known, trie, 0)

    return _source(docs, text, lang).mapInArrow(run, "lang string, words array<string>, n long")


def count_pairs(docs: DataFrame, words: np.ndarray, text: str = "text", lang: str = "lang", least: int = LEAST) -> DataFrame:
    """(lang, phrase, f) of the frequent pairs."""
    rows = _sequences(docs, text, lang, words, 2, lambda ids, _: pairs_in(ids))
    counts = rows.groupBy("lang", F.array_join("words", " ").alias("phrase")).agg(F.sum("n").alias("f"))
    return stored(counts.where(F.col("f") >= least), "pairs", TEXT_ROWS)


class OpenPrefixes:
    """Adds up the prefixes of sorted sequences, batch by batch; those of the last sequence stay open."""

    def __init__(self, least: int):
        self.least, self.lang, self.words = least, None, []
        self.counts = [0] * (LONGEST + 1)

    def close(self, common: int) -> tuple[list[str], list[str], list[int]]:
        """The frequent open prefixes with more than ``common`` words."""
        found = [(self.lang, " ".join(self.words[:k]), self.counts[k]) for k in range(3, len(self.words) + 1) if k > common]
        rows = [r for r in found if r[2] >= self.least]
        return [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]

    def merge(self, langs: pa.Array, sequences: pa.ListArray, n: pa.Array) -> tuple[list[str], list[str], list[int]]:
        counts, rows = n.to_numpy(), len(langs)
        flat, sizes = sequences.flatten(), sequences.value_lengths().to_numpy()
        starts = np.cumsum(sizes) - sizes
        words = np.full((rows, LONGEST), -1, np.int64)
        words[np.repeat(np.arange(rows), sizes), np.arange(len(flat)) - np.repeat(starts, sizes)] = flat.dictionary_encode().indices.to_numpy()
        lang = langs.dictionary_encode().indices.to_numpy()
        # how many words each sequence shares with the one before it
        same = (words[1:] == words[:-1]) & (words[1:] >= 0) & (lang[1:] == lang[:-1])[:, None]
        shared = np.append(0, np.cumprod(same, axis=1).sum(axis=1))
        first = flat[: sizes[0]].to_pylist()
        if self.lang == langs[0].as_py():
            while shared[0] < min(len(first), len(self.words)) and first[shared[0]] == self.words[shared[0]]:
                shared[0] += 1
        out = self.close(int(shared[0]))
        held = [0] * (LONGEST + 1)
        for k in range(3, LONGEST + 1):
            begin = np.flatnonzero(np.append(True, shared[1:] < k))
            total = np.add.reduceat(counts, begin)
            if shared[0] >= k:
                total[0] += self.counts[k]
            long_enough = sizes[begin] >= k
            held[k] = int(total[-1]) if long_enough[-1] else 0
            for g in np.flatnonzero((total >= self.least) & long_enough).tolist():
                if g == len(begin) - 1:
                    continue  # the last sequence's stay open
                at = starts[begin[g]]
                for column, value in zip(out, (langs[int(begin[g])].as_py(), " ".join(flat[at : at + k].to_pylist()), int(total[g])), strict=True):
                    column.append(value)
        self.lang, self.words, self.counts = langs[rows - 1].as_py(), flat[starts[-1] :].to_pylist(), held
        return out


def count_longer(
    docs: DataFrame, words: np.ndarray, pairs: np.ndarray, text: str = "text", lang: str = "lang", least: int = LEAST
) -> DataFrame:
    """(lang, phrase, f) of the frequent phrases of three to five words."""
    shared = docs.sparkSession.sparkContext.broadcast(pairs)
    rows = _sequences(docs, text, lang, words, LONGEST, lambda ids, hashes: runs_in(ids, hashes, shared.value))
    merged = rows.repartition("lang", F.slice("words", 1, 3)).sortWithinPartitions("lang", "words")
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The counts of all prefixes of sorted sequences; holds one batch at a time."""
        held = OpenPrefixes(least)
        for batch in batches:
            if batch.num_rows:
                yield to_batch(schema, *held.merge(*batch.columns))
        yield to_batch(schema, *held.close(0))

    return stored(merged.mapInArrow(add_up, "lang string, phrase string, f long"), "longer", 4 * TEXT_ROWS)


# ------------------------------------------------------------------------------------- the scores
def _decimal(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, most: int = MOST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases."""
    c = F.col
    counted = count_words(docs, text, lang, least)
    singles = counted.where("phrase IS NOT NULL")
    word_bits = hashed_bitmap(singles.select(F.xxhash64("lang", "phrase")))
    pairs = count_pairs(docs, word_bits, text, lang, least)
    both = F.split("phrase", " ")
    pair_bits = hashed_bitmap(pairs.select(F.xxhash64("lang", both[0]), F.xxhash64("lang", both[1])))
    candidates = pairs.union(count_longer(docs, word_bits, pair_bits, text, lang, least))

    # every part of every cut looks its count up
    words, size = c("words"), F.size("words")
    own = candidates.select("lang", "phrase", "f", F.split("phrase", " ").alias("words"))

    def joined(start: Column, length: Column) -> Column:
        return F.array_join(F.slice(words, start, length), " ")

    cut = F.transform(
        F.sequence(F.lit(1), size - 1),
        lambda k: F.array(
            F.struct(k.alias("k"), F.lit("l").alias("side"), joined(F.lit(1), k).alias("part"), (k == 1).alias("single")),
            F.struct(k.alias("k"), F.lit("r").alias("side"), joined(k + 1, size - k).alias("part"), (size - k == 1).alias("single")),
        ),
    )
    parts = own.select("lang", "phrase", F.explode(F.flatten(cut)).alias("x")).select(
        "lang", "phrase", "x.k", "x.side", "x.part",
        F.when(c("x.single"), F.pmod(F.xxhash64("phrase"), F.lit(WORD_COPIES)).cast("int")).otherwise(0).alias("copy"),
    )
    copies = singles.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(WORD_COPIES - 1))))
    known = copies.union(candidates.withColumn("copy", F.lit(0))).select("lang", c("phrase").alias("part"), c("f").alias("count"), "copy")
    counts = parts.join(known, ["lang", "part", "copy"])
    looked_up = [
        F.max(F.when((c("k") == k) & (c("side") == side), c("count"))).alias(f"{side}{k}") for k in range(1, LONGEST) for side in "lr"
    ]

    # the most frequent longer candidate that holds each phrase
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda length: F.transform(F.sequence(F.lit(1), size - length + 1), lambda start: F.array_join(F.slice(words, start, length), " ")),
        )
    )
    covers = own.where(size > 2).select("lang", F.explode(inner).alias("phrase"), c("f").alias("cover"))
    none = F.lit(None)
    rows = (
        own.select("lang", "phrase", c("f").alias("a"), none.cast("long").alias("cover"), none.cast("int").alias("k"), none.cast("string").alias("side"), none.cast("long").alias("count"))
        .union(covers.select("lang", "phrase", none.cast("long"), "cover", none.cast("int"), none.cast("string"), none.cast("long")))
        .union(counts.select("lang", "phrase", none.cast("long"), none.cast("long"), "k", "side", "count"))
    )
    one = rows.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("cover").alias("cover"), *looked_up)
    kept = one.where(c("cover").isNull() | (c("cover") < c("a"))).withColumn("copy", F.pmod(F.xxhash64("phrase"), F.lit(WORD_COPIES)).cast("int"))
    totals = counted.where("phrase IS NULL").select("lang", c("f").alias("n")).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.lit(WORD_COPIES - 1)))
    )
    cuts = [
        F.when(
            c(f"l{k}").isNotNull() & c(f"r{k}").isNotNull(),
            F.struct(
                F.call_function(
                    "div",
                    _decimal(c("a")) * _decimal(c("n")) * F.lit(1000).cast("decimal(4,0)"),
                    _decimal(c(f"l{k}")) * _decimal(c(f"r{k}")),
                ).alias("score"),
                F.lit(k).alias("k"), c(f"l{k}").alias("l"), c(f"r{k}").alias("r"),
            ),
        )
        for k in range(1, LONGEST)
    ]
    scored = kept.join(totals, ["lang", "copy"]).withColumn("least", F.array_min(F.array(*cuts)))
    scored = scored.select("lang", "phrase", "a", "least.l", "least.r", "n", "least.score")

    # ranked in groups first, so that no task sorts a whole language
    order = [c("score").desc(), c("a").desc(), c("phrase").asc()]
    group = F.pmod(F.xxhash64("phrase", F.lit(1)), F.lit(RANK_GROUPS))
    some = scored.withColumn("_g", group).withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_g").orderBy(*order)))
    first = some.where(c("_r") <= most).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return first.where(c("rank") <= most).select("lang", c("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
