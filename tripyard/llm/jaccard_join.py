"""N-gram Jaccard join with several global token orders.

A text's set holds its distinct five-word shingles (64-bit hashes).  Two sets with
Jaccard similarity >= 0.8 share a token among the first n - ceil(0.8 n) + 1 of each,
whatever order all tokens are put in.  Three quite different orders are used:

* orders 0 and 1 put one third of the tokens (by hash) first, rarest first, and
  everything else behind.  Only that third is shuffled and counted, and a text with
  enough tokens of its own has nothing but these in its prefix and drops out.  Sets
  with a prefix token in common are tested pair by pair: by their sizes, and by their
  sketches, bitmaps that differ in no more places than the sets in tokens, so that a
  similar pair always passes.  What passes is linked, and the components of the links
  are the groups, first under order 0, then inside each group under order 1;
* order 2 is the order of the hashes; inside a group a pair must share a prefix
  token under it, too.

Groups are verified in blocks of bounded size.  Texts known to be in one component
need no further comparison, so a group of near copies costs about as many
comparisons as it has members.  A group of several blocks is first joined up block by
block and by the blocks' representatives; then the blocks that hold different
components are compared with each other, so no link is lost.

Exact copies are one class with one set.  Very frequent tokens, as every task
reports them, take no part in the counting and come behind all others in orders 0 and 1,
so no task gets a token that a large share of the rows holds, and a passage that many
texts quote is in few prefixes.

Defined results: null, empty and very short texts as the contract has them (no words:
an empty set, in a component of its own; under five words: the whole sequence is one
shingle); texts of any length are read whole; repeated rows are copies of each other;
a repeated id is judged row by row; a row with a null id is compared like any other, but
a null id never names a component unless no member has an id; an empty table gives no
rows; extra columns are ignored.  Rows are told apart by a 64-bit hash of id and text.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripyard.llm.common import (
    TEXT_ROWS,
    WordHashes,
    components,
    is_set,
    likely_members,
    membership,
    mix,
    most_frequent,
    numbers,
    sorted_groups,
    stored,
    text_steps,
    to_batch,
)

SHINGLE, PERCENT = 5, 80
#: Hash classes of the tokens; an order puts one of them first.
CLASSES = 3
#: Tokens that a task counts at once, and the count from which it reports one as frequent.
CHUNK_TOKENS, FREQUENT = 2_000_000, 6
#: Frequent tokens that are known everywhere (a fixed bound: one megabyte).
MAX_FREQUENT = 1 << 16
#: Sets, and tokens, that one verification block holds.
BLOCK_SETS, BLOCK_TOKENS = 128, 1 << 20
#: Exact copies are remembered per task up to this many sets.
SEEN_SETS = 200_000
#: Bits of a set's sketch, powers of two: as many as it has tokens, between these.
LEAST_WIDTH, MOST_WIDTH = 256, 2048
#: Sets with one prefix token that are tested pair by pair; those of a longer list are all linked.
LIST_SETS = 1 << 14


def needed(n: int) -> int:
    """Least overlap of a set of n tokens with any similar set."""
    return (PERCENT * n + 99) // 100


def shingles(text: bytes, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    h = hashes.array(text.lower().split())
    if not len(h):
        return h
    if len(h) < SHINGLE:
        s = h[:1] ^ np.uint64(len(h))
        for j in range(1, len(h)):
            s = mix(s) + h[j : j + 1]
        return mix(s)
    s = h[: len(h) - SHINGLE + 1]
    for j in range(1, SHINGLE):
        s = mix(s) + h[j : len(h) - SHINGLE + 1 + j]
    return np.unique(mix(s))


def set_hash(tokens: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(tokens.tobytes()) - (1 << 63)


def sketch(tokens: np.ndarray) -> bytes:
    """Of each place, by the tokens' low bits, whether an odd number of tokens falls on it.

    Two sketches of one width differ in at most as many places as their sets differ in
    tokens.  A sketch's halves, one xor the other, are the sketch of half its width.
    """
    width = min(MOST_WIDTH, max(LEAST_WIDTH, 1 << (len(tokens) - 1).bit_length()))
    odd = np.bincount((tokens & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


# ------------------------------------------------------------------------------- sets and tokens
def _sketch(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row (kind 0) for each text: id, set hash, set size, row hash, and at a set's first text in a task its sketch;
    rows (kind 1) for tokens frequent in a task."""
    schema = pa.schema(
        [("kind", pa.int32()), ("id", pa.int64()), ("h", pa.int64()), ("n", pa.int64()), ("row", pa.int64()), ("bits", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen, held, size = WordHashes(), set(), [], 0

        def frequent() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= FREQUENT
            n = int(often.sum())
            return to_batch(schema, np.ones(n, np.int32), pa.nulls(n, pa.int64()), values[often].view(np.int64), counts[often], pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()))

        for batch, texts in text_steps(batches, 1):
            h, n, bits = [], [], []
            for t in texts:
                s = shingles(t, hashes)
                own = set_hash(s)
                h.append(own)
                n.append(len(s))
                bits.append(None if own in seen or not len(s) else sketch(s))
                if own not in seen:
                    if len(seen) >= SEEN_SETS:
                        seen.clear()
                    seen.add(own)
                    held.append(s)
                    size += len(s)
                if size >= CHUNK_TOKENS:
                    yield frequent()
                    held, size = [], 0
            yield to_batch(schema, np.zeros(len(h), np.int32), batch.column(0), h, n, batch.column(2), bits)
        if size:
            yield frequent()

    source = docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text"), row_hash(docs, key, text).alias("row"))
    return source.mapInArrow(run, "kind int, id long, h long, n long, row long, bits binary")


def row_hash(docs: DataFrame, key: str, text: str) -> Column:
    """One value for rows with the same id and text, null or not."""
    return F.xxhash64(docs[key].cast("long"), docs[text])


def _likely_rows(docs: DataFrame, key: str, text: str, bitmap: np.ndarray) -> DataFrame:
    """(row, _text) of the rows whose hash has its bit set; a task passes repeated rows on once, as far as it remembers them."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = shared.value, set()
        for batch in batches:
            keep = is_set(bits, numbers(batch.column(0)))
            rows = batch.column(0).to_numpy()
            for i in np.nonzero(keep)[0].tolist():
                if rows[i] in seen:
                    keep[i] = False
                    continue
                if len(seen) >= SEEN_SETS:
                    seen.clear()
                seen.add(int(rows[i]))
            yield batch.filter(pa.array(keep))

    return docs.select(row_hash(docs, key, text).alias("row"), docs[text].alias("_text")).mapInArrow(run, "row long, _text string")


def _order_rows(order: int, frequent: np.ndarray, ranks: np.ndarray) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, int]]:
    """Tokens -> (first-class tokens, further tokens surely in the prefix, base).

    The prefix holds the further tokens and the ``base + (shared first-class tokens)``
    rarest of the shared ones.
    """

    def split(s: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        p = len(s) - needed(len(s)) + 1
        first = s % np.uint64(CLASSES) == order
        rank = np.full(len(s), -1)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
            rank = np.where(frequent[at] == s, ranks[at], -1)
        light = s[first & (rank < 0)]
        more = s[:0]
        if len(light) < p:
            more = s[~first & (rank < 0)]
            for often in (first & (rank >= 0), ~first & (rank >= 0)):  # behind all others: unlike texts share them
                if len(light) + len(more) < p:
                    more = np.concatenate([more, s[often][np.argsort(rank[often], kind="stable")]])
            more = more[: p - len(light)]
        return light, more, p - len(more) - len(light)

    return split


_ENTRY = pa.schema([("kind", pa.int32()), ("token", pa.int64()), ("doc", pa.int64()), ("base", pa.int32())])
_ENTRY_DDL = "kind int, token long, doc long, base int"


def _entry_batch(docs: list[int], sets: list[tuple[np.ndarray, np.ndarray, int]]) -> pa.RecordBatch:
    a, b = [len(x[0]) for x in sets], [len(x[1]) for x in sets]
    base, ids = np.array([x[2] for x in sets], np.int32), np.array(docs, np.int64)
    token = np.concatenate([x[0] for x in sets] + [x[1] for x in sets]).view(np.int64)
    return to_batch(
        _ENTRY,
        np.repeat(np.array([0, 1], np.int32), [sum(a), sum(b)]),
        token,
        np.concatenate([np.repeat(ids, a), np.repeat(ids, b)]),
        np.concatenate([np.repeat(base, a), np.repeat(base, b)]),
    )


def _entries_of_texts(docs: DataFrame, text: str, split) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        for _, texts in text_steps(batches, text):
            ids, rows = [], []
            for t in texts:
                s = shingles(t, hashes)
                own = set_hash(s)
                if not len(s) or own in seen:
                    continue
                if len(seen) >= SEEN_SETS:
                    seen.clear()
                seen.add(own)
                ids.append(own)
                rows.append(split(s))
            if ids:
                yield _entry_batch(ids, rows)

    return docs.select(docs[text]).mapInArrow(run, _ENTRY_DDL)


def _arrays(batch: pa.RecordBatch | pa.Table, column: str) -> list[np.ndarray]:
    col = batch.column(column)
    if isinstance(col, pa.ChunkedArray):
        return [x for c in col.chunks for x in _arrays(pa.RecordBatch.from_arrays([c], names=[column]), column)]
    flat = col.flatten().to_numpy().view(np.uint64)
    ends = np.cumsum(np.diff(col.offsets.to_numpy()))
    return np.split(flat, ends[:-1]) if len(ends) else []


def _entries_of_sets(sets: DataFrame, split) -> DataFrame:
    """Entries whose tokens are told apart by group: a token counts inside its group alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = []
            for g, s in zip(batch.column("g").to_pylist(), _arrays(batch, "tokens"), strict=True):
                salt = mix(np.array([g], np.int64).view(np.uint64))
                light, more, base = split(s)
                rows.append((mix(light ^ salt), mix(more ^ salt), base))
            yield _entry_batch(batch.column("node").to_pylist(), rows)

    return sets.select("node", "g", "tokens").mapInArrow(run, _ENTRY_DDL)


def _shared(entries: DataFrame) -> DataFrame:
    """(token, doc, base, df) of the entries whose token two or more sets have; df 0: surely in the prefix."""
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = pa.schema([("token", pa.int64()), ("doc", pa.int64()), ("base", pa.int32()), ("df", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(kind, token, doc, base) -> pa.RecordBatch:
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (doc[1:] != doc[:-1]) | (kind[1:] != kind[:-1])
            kind, token, doc, base = kind[new], token[new], doc[new], base[new]
            start = np.ones(len(token), bool)
            start[1:] = (token[1:] != token[:-1]) | (kind[1:] != kind[:-1])
            first = np.nonzero(start)[0]
            df = np.repeat(np.diff(np.append(first, len(token))), np.diff(np.append(first, len(token))))
            keep = (kind == 1) | (df > 1)
            return to_batch(schema, token[keep], doc[keep], base[keep], np.where(kind == 1, 0, df)[keep].astype(np.int32))

        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy() for i in range(4)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            # the last token's rows wait for the next batch
            sure = int((cols[0] == 1).sum())  # these come first
            cut = sure if sure == len(cols[0]) else sure + int(np.searchsorted(cols[1][sure:], cols[1][-1]))
            if cut:
                yield told(*(c[:cut] for c in cols))
            held = [c[cut:] for c in cols]
        if held is not None and len(held[0]):
            yield told(*held)

    # surely needed entries can hold frequent tokens: they are dealt by text, the others by token
    dealt = entries.repartition(parts, F.when(F.col("kind") == 0, F.col("token")).otherwise(F.col("doc")))
    return dealt.sortWithinPartitions(F.col("kind").desc(), "token", "doc").mapInArrow(run, "token long, doc long, base int, df int")


def near_pairs(group: np.ndarray, n: np.ndarray, bits: list[bytes]) -> np.ndarray:
    """For each set the number of the first one that it is linked to, by pairs of one group whose sizes and sketches allow for similarity.

    The sets come by group, and by size inside a group.
    """
    parent = np.arange(len(n))
    starts = np.nonzero(np.append(True, group[1:] != group[:-1]))[0]
    of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(n))))
    width = np.array([len(b) for b in bits]) * 8
    tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for w in np.unique(width).tolist():
        own, wide = np.nonzero(width == w)[0], np.nonzero(width == 2 * w)[0]
        row = np.zeros(len(n), np.int64)
        row[own], row[wide] = np.arange(len(own)), len(own) + np.arange(len(wide))
        halves = np.frombuffer(b"".join(bits[i] for i in wide), np.uint64).reshape(len(wide), 2, w // 64)
        table = np.frombuffer(b"".join(bits[i] for i in own), np.uint64).reshape(len(own), w // 64)
        tables[w] = row, np.concatenate([table, halves[:, 0] ^ halves[:, 1]])

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    left = np.arange(len(n))  # sets that may have partners further on
    for apart in range(1, len(n)):
        left = left[left + apart < len(n)]
        other = left + apart
        fits = (group[left] == group[other]) & (PERCENT * n[other] <= 100 * n[left])
        left = left[fits]
        if not len(left):
            break
        a, b = left, left + apart
        new = parent[a] != parent[b]
        a, b, linked = a[new], b[new], False
        for w in np.unique(width[a]).tolist():
            here = width[a] == w
            x, y = a[here], b[here]
            row, table = tables[w]
            differ = np.bitwise_count(table[row[x]] ^ table[row[y]]).sum(axis=1, dtype=np.int64)
            near = differ * (100 + PERCENT) <= (n[x] + n[y]) * (100 - PERCENT)
            for i, j in zip(x[near].tolist(), y[near].tolist(), strict=True):
                i, j, linked = find(i), find(j), True
                parent[max(i, j)] = min(i, j)
        if linked:
            while not np.array_equal(parent, up := parent[parent]):
                parent = up
            apart_yet = np.add.reduceat(parent != starts[of], starts) > 0
            left = left[apart_yet[of[left]]]
    return parent


def _near_edges(lists: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges between the sets of each list (key, doc) that may be similar, tested pair by pair."""
    parts = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(rows: pa.Table) -> pa.RecordBatch:
            key, doc, n = (rows.column(c).to_numpy() for c in ("key", "doc", "n"))
            to = near_pairs(key, n, rows.column("bits").to_pylist())
            linked = to != np.arange(len(to))
            return to_batch(schema, doc[linked], doc[to[linked]])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # the last list's rows wait for the next batch
            key = batch.column(0).to_numpy()
            cut = int(np.argmax(key == key[-1]))
            if cut or held and held[-1].column(0)[0].as_py() != key[0]:
                yield told(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield told(pa.Table.from_batches(held))

    rows = lists.join(classes.select(F.col("h").alias("doc"), "n", "bits"), "doc").select("key", "doc", "n", "bits")
    return rows.repartition(parts, "key").sortWithinPartitions("key", "n", "doc").mapInArrow(run, "a long, b long")


def _prefix_edges(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges that link all sets which have a prefix token in common and may be similar by their sizes and sketches."""
    own = Window.partitionBy("doc")
    rows = (
        shared.withColumn("sure", F.count_if(F.col("df") == 0).over(own))
        .withColumn("common", F.count_if(F.col("df") > 0).over(own))
        .withColumn("at", F.row_number().over(own.orderBy("df", "token")))
        .where((F.col("df") == 0) | (F.col("at") - F.col("sure") <= F.col("base") + F.col("common")))
        .select("token", "doc")
    )
    rows = _freed(stored(rows, "prefixes"))
    # tokens with the same sets make one list
    tokens = rows.groupBy("token").agg(
        F.min("doc").alias("low"), F.max("doc").alias("high"), F.count(F.lit(1)).alias("sets"), F.bit_xor(F.xxhash64("doc")).alias("key")
    )
    lists = rows.join(tokens.where("low < high").select("token", "low", "sets", "key"), "token")
    short = stored(lists.where(F.col("sets") <= LIST_SETS).select("key", "doc").distinct(), "lists")
    long = lists.where((F.col("sets") > LIST_SETS) & (F.col("doc") != F.col("low"))).select(F.col("doc").alias("a"), F.col("low").alias("b"))
    return _near_edges(short, classes).union(long)


# ----------------------------------------------------------------------------------- verification
def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Jaccard similarity of two sorted sets, after the prefix filter under the order of the hashes."""
    n, m = len(x), len(y)
    if PERCENT * max(n, m) > 100 * min(n, m):
        return False
    px, py = x[: n - needed(n) + 1], y[: m - needed(m) + 1]
    at = np.searchsorted(px, py)
    if not (px[np.minimum(at, len(px) - 1)] == py).any():
        return False
    at = np.searchsorted(x, y)
    common = int((x[np.minimum(at, n - 1)] == y).sum())
    return 100 * common >= PERCENT * (n + m - common)


def join_block(sets: list[np.ndarray], labels: list[int]) -> Callable[[int], int]:
    """Components of a block: sets with one label are known to belong together."""
    seen: dict[int, int] = {}
    find_links = [(seen.setdefault(label, i), i) for i, label in enumerate(labels)]
    parent = list(range(len(sets)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in find_links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    for k, i in enumerate(order):
        for j in order[k + 1 :]:
            if PERCENT * len(sets[j]) > 100 * len(sets[i]):
                break
            a, b = find(i), find(j)
            if a != b and similar(sets[i], sets[j]):
                parent[max(a, b)] = min(a, b)
    return find


def _verify(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(node, g, label) after comparing all sets with the same keys; ``rows`` also has node, g, label and tokens."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = pa.schema([("node", pa.int64()), ("g", pa.int64()), ("label", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, keys):
            nodes, labels = group.column("node").to_pylist(), group.column("label").to_pylist()
            find = join_block(_arrays(group, "tokens"), labels)
            yield to_batch(schema, nodes, group.column("g").combine_chunks().cast(pa.int64()), [labels[find(i)] for i in range(len(nodes))])

    dealt = rows.select(*dict.fromkeys([*keys, "node", "g", "label", "tokens"])).repartition(parts, *keys)
    return dealt.sortWithinPartitions(*keys, "node").mapInArrow(run, "node long, g long, label long")


def _blocks(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` with the number of blocks that each group (``by``) needs."""
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_c"), F.sum("n").alias("_t"))
    blocks = F.greatest(F.ceil(F.col("_c") / BLOCK_SETS), F.ceil(F.col("_t") / BLOCK_TOKENS)).cast("long")
    return rows.join(sizes.select(*by, blocks.alias("blocks")), by)


def _with_tokens(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """``rows`` (by node) with their sets' tokens; sets that no row asks for are not moved."""
    return rows.join(likely_members(sets.select("node", "tokens"), "node", membership(rows, "node")), "node")


def _links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges (a, b) whose components are those of all verified links inside the groups.

    ``members`` has node, g and n; only these narrow rows are dealt into blocks, and
    each round fetches the tokens that it compares.
    """
    spread = F.pmod(F.xxhash64("node"), F.col("blocks"))
    first = stored(_blocks(members.withColumn("label", F.col("node")), ["g"]).withColumn("block", spread), "blocks")
    done = stored(_verify(_with_tokens(first, sets), ["g", "block"]), "labels", TEXT_ROWS)
    edges = done.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))
    large = first.where("blocks > 1").select("node", "g", "n")
    if not large.limit(1).count():
        return edges
    members = stored(large.join(done.select("node", "label"), "node"), "members")  # node, g, n, label
    # the blocks' representatives, twice: joins up most of a group of near copies
    for _ in range(2):
        heads = stored(_blocks(members.where("node = label"), ["g"]).withColumn("block", spread), "heads")
        joined = stored(_verify(_with_tokens(heads, sets), ["g", "block"]), "labels", TEXT_ROWS)
        more = joined.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))
        if not more.limit(1).count():
            break
        edges = edges.union(more)
        names = joined.select(F.col("node").alias("label"), F.col("label").alias("_to"))
        members = stored(
            members.join(names, "label", "left").withColumn("label", F.coalesce("_to", "label")).drop("_to"), "members"
        )
    # what is left: sets of one group in different components
    mixed = members.groupBy("g").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l <> h").select("g")
    members = _blocks(members.join(mixed, "g", "left_semi"), ["g", "label"])
    single = members.where("blocks > 1").withColumn("cell", F.xxhash64("label", spread)).withColumn("own", F.col("label")).drop("blocks")
    lumped = _blocks(members.where("blocks = 1").drop("blocks"), ["g"])
    lumped = lumped.withColumn("cell", F.pmod(F.xxhash64("label"), F.col("blocks"))).withColumn("own", F.lit(None).cast("long")).drop("blocks")
    celled = stored(single.unionByName(lumped), "cells")
    if not celled.limit(1).count():
        return edges
    cells = stored(celled.groupBy("g", "cell").agg(F.max("own").alias("own")), "celllist")
    other = cells.select("g", F.col("cell").alias("cell2"), F.col("own").alias("own2"))
    pairs = cells.join(other, "g").where(
        (F.col("cell") <= F.col("cell2")) & ~(F.col("own").eqNullSafe(F.col("own2")) & F.col("own").isNotNull())
    )
    sides = pairs.select("g", "cell", "cell2", F.explode(F.array_distinct(F.array("cell", "cell2"))).alias("side"))
    fetched = _with_tokens(celled, sets).withColumnRenamed("cell", "side")
    last = stored(_verify(fetched.join(sides, ["g", "side"]), ["g", "cell", "cell2"]), "last", TEXT_ROWS)
    named = celled.select("node", F.col("label").alias("_old"))
    changed = last.join(named, "node").where("label <> _old").select(F.col("_old").alias("a"), F.col("label").alias("b")).distinct()
    return edges.union(changed)


# ---------------------------------------------------------------------------------------- operator
def _freed(df: DataFrame) -> DataFrame:
    """``df``, a written table; Spark deletes the shuffle files that led to it when the driver collects garbage, so here it does."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return df


def _judged(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(id, h, n, row) for every row of ``docs``, and (h, component, component_id) for every set with tokens."""
    sketch = stored(_sketch(docs, key, text), "sketch", TEXT_ROWS)
    texts = sketch.where("kind = 0")
    reported = stored(sketch.where("kind = 1").groupBy(F.col("h").alias("token")).agg(F.sum("n").alias("c")), "frequent")
    often = most_frequent(reported, "c", MAX_FREQUENT).toPandas().sort_values(["c", "token"], ascending=[False, True])
    tokens = often["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    # rank: the most frequent token is last of all
    frequent, ranks = tokens[order], (len(tokens) - 1 - np.arange(len(tokens)))[order]

    classes = stored(texts.where("n > 0").groupBy("h").agg(F.min("id").alias("rep"), F.max("n").alias("n"), F.min("row").alias("row"), F.max("bits").alias("bits")), "classes")
    entries = _entries_of_texts(docs, text, _order_rows(0, frequent, ranks))
    groups = components(_prefix_edges(_freed(stored(_shared(entries), "shared", 4 * TEXT_ROWS)), classes))
    grouped = stored(
        groups.select(F.col("node").alias("h"), F.col("component").alias("g")).join(classes.drop("bits"), "h"), "grouped"
    )

    schema = pa.schema([("node", pa.int64()), ("g", pa.int64()), ("n", pa.int64()), ("tokens", pa.list_(pa.int64()))])

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, raw in text_steps(batches, "_text"):
            found = [shingles(t, hashes) for t in raw]
            own = [i for i, (s, h) in enumerate(zip(found, batch.column(1).to_pylist(), strict=True)) if set_hash(s) == h]
            rows = batch.take(pa.array(own, pa.int64()))
            yield to_batch(schema, rows.column(1), rows.column(2), [len(found[i]) for i in own], [found[i].view(np.int64) for i in own])

    # any row of a set gives its tokens, also one without an id; the join moves few other texts
    text_rows = _likely_rows(docs, key, text, membership(grouped, "row"))
    fetched = text_rows.join(grouped.select("row", "h", "g"), "row").select("_text", "h", "g")
    fetched = fetched.mapInArrow(to_sets, "node long, g long, n long, tokens array<long>").withColumn("at", F.monotonically_increasing_id())
    sets = _freed(stored(fetched, "sets", TEXT_ROWS))
    if sets.count() > grouped.count():  # rows that several tasks hold: each set is wanted once
        once = sets.groupBy("node").agg(F.min("at").alias("at")).select("at")
        sets = stored(sets.join(once, "at", "left_semi"), "sets", TEXT_ROWS)

    finer = components(_prefix_edges(stored(_shared(_entries_of_sets(sets, _order_rows(1, frequent, ranks))), "shared", 4 * TEXT_ROWS), classes))
    members = finer.select(F.col("node"), F.col("component").alias("g")).join(sets.select("node", "n"), "node")
    found = components(_links(members, sets))
    named = classes.drop("bits").join(found.select(F.col("node").alias("h"), "component"), "h", "left").withColumn("component", F.coalesce("component", "h"))
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_set = stored(named.join(smallest, "component").select("h", "component", "component_id"), "components")
    return texts, by_set


def similar_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) for every row of ``docs``."""
    texts, by_set = _judged(docs, key, text)
    return (
        texts.join(by_set, (texts["h"] == by_set["h"]) & (texts["n"] > 0), "left")
        .select(texts["id"].alias(key), texts["n"].alias("n_shingles"), F.coalesce(by_set["component_id"], texts["id"]).alias("component_id"))
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, with all its columns: one with the smallest id.

    Texts without words are alike only if the rows repeat.
    """
    texts, by_set = _judged(docs, key, text)
    named = texts.where("n > 0").join(by_set, "h").where(F.col("id").eqNullSafe(F.col("component_id")))
    kept = named.groupBy("component").agg(F.min("row").alias("row")).select("row").union(texts.where("n = 0").select("row").distinct())
    times = texts.groupBy("row").agg((F.count(F.lit(1)) > 1).alias("many"))
    kept = stored(kept.join(times, "row"), "kept")

    def rows(kept: DataFrame) -> DataFrame:
        return docs.join(kept, row_hash(docs, key, text) == kept["row"], "left_semi")

    out, many = rows(kept.where("not many")), kept.where("many")
    if not many.limit(1).count():
        return out
    repeated = rows(many)
    mark = "_row" + "_" * max(len(c) for c in docs.columns)  # no column of the table's
    repeated = repeated.withColumn(mark, row_hash(repeated, key, text)).dropDuplicates([mark])
    return out.union(repeated.select(*docs.columns))
