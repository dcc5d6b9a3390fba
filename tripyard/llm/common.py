"""Shared helpers: shared-folder tables, byte-bounded batches, words and hashes, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step inside a task works on at once (one longer text is its own step).
STEP_BYTES = 4 << 20
#: Rows in one Arrow batch: of whole texts, and of narrow rows.
TEXT_ROWS, NARROW_ROWS = 500, 10_000
#: Entries that a per-worker word cache may hold before it starts anew.
CACHE_ENTRIES = 150_000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

MIX = np.uint64(0x9E3779B97F4A7C15)


# ----------------------------------------------------------------- tables in the shared folder
def shared_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a private one only in a plain local session."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        set_dir = spark.sparkContext.getCheckpointDir()
        if set_dir:
            return set_dir.rstrip("/")
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="llm-shared-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def text_batches(df: DataFrame) -> None:
    """From now on the session moves at most TEXT_ROWS rows in one Arrow batch: whole texts are large.

    What an operator returns runs when its caller asks for it, so this is the session's
    setting; a smaller one stays.
    """
    conf = df.sparkSession.conf
    if int(conf.get(_BATCH_ROWS)) > TEXT_ROWS or int(conf.get(_BATCH_ROWS)) <= 0:
        conf.set(_BATCH_ROWS, TEXT_ROWS)


def stored(df: DataFrame, name: str, batch_rows: int = NARROW_ROWS) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts lineage, survives lost executors.

    ``batch_rows``: rows in one Arrow batch meanwhile; fewer for stages that move whole texts.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/llm-{uuid.uuid4().hex}/{name}"
    old = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, batch_rows)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH_ROWS, old)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(col: str, modulus: int) -> Column:
    """crc32 of the id's text, modulo ``modulus``; a null id is in fold -1."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(modulus), F.lit(-1).cast("long"))


#: Of a sample's bound so much is aimed at: the number of rows below a hash threshold varies a little.
AIM = 0.95
_RANGE = 1 << 40


def hashed_below(h: Column, bound: int, rows: int) -> Column:
    """Whether a row's hash lies so low that about AIM * ``bound`` of ``rows`` rows do; all of fewer rows."""
    return F.lit(True) if rows <= bound else F.pmod(h, F.lit(_RANGE)) < int(_RANGE * AIM * bound / rows)


# ------------------------------------------------------------------------------ batches and words
def text_steps(
    batches: Iterator[pa.RecordBatch], text: str | int = "text", step_bytes: int = STEP_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Row slices of the batches with at most ``step_bytes`` of text, with the texts as UTF-8 (null: empty)."""
    for batch in batches:
        col = batch.column(text)
        raw = col.cast(pa.large_binary()).fill_null(b"")
        ends = np.cumsum(pc.binary_length(raw).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(raw):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + step_bytes, side="right")))
            yield batch.slice(start, stop - start), raw.slice(start, stop - start).to_pylist()
            start = stop


def filter_texts(docs: DataFrame, text: str, make_test: Callable[[], Callable[[list[bytes]], list[bool]]]) -> DataFrame:
    """The rows whose text passes, with all their columns; ``make_test`` is called once in each task."""
    text_batches(docs)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = make_test()
        for batch, texts in text_steps(batches, place):
            yield batch.filter(pa.array(test(texts), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


class WordHashes(dict):
    """word -> 64-bit hash, kept for words seen lately.

    Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text are what ``bytes.split`` gives: it splits at just these six.
    """

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MIX
    return h ^ (h >> np.uint64(29))


def mix_one(h: int) -> int:
    """The same for one number."""
    h = (h ^ (h >> 31)) * int(MIX) & 0xFFFFFFFFFFFFFFFF
    return h ^ (h >> 29)


#: Bits of a membership bitmap: so many for each value, and the least and most of all (32 megabytes).
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 13, 1 << 28
_BLOCK = 1 << 14


def places(bits: int, *values: np.ndarray) -> np.ndarray:
    """The place of each value, or of each tuple of values, in a bitmap of ``bits`` bits (a power of two)."""
    h = mix(values[0].view(np.uint64))
    for v in values[1:]:
        h = mix(h ^ v.view(np.uint64))
    return (h >> np.uint64(64 - (bits.bit_length() - 1))).astype(np.int64)


def is_set(bitmap: np.ndarray, *values: np.ndarray) -> np.ndarray:
    """For each value, or tuple of values, whether its place is set."""
    at = places(len(bitmap) * 8, *values)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def numbers(column: pa.Array) -> np.ndarray:
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def hashed_bitmap(df: DataFrame) -> np.ndarray:
    """A bitmap with the hashed places of the rows' BIGINT columns set (rows with a null first column are left out).

    A value that is there always has its bit set, so filtering by it before a join
    loses nothing; the join itself decides.  The size follows the number of rows, up to a
    fixed bound; beyond that more other values pass.
    """
    schema = pa.schema([("block", pa.int32()), ("bits", pa.binary())])
    rows = df.where(df[df.columns[0]].isNotNull())
    wanted = max(1, rows.count() * BITS_EACH)
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (wanted - 1).bit_length()))
    block = min(_BLOCK, bits // 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            at = places(bits, *[numbers(c) for c in batch.columns])
            by_block = (at >> 3) // block
            for b in np.unique(by_block).tolist():
                part = own.setdefault(b, np.zeros(block, np.uint8))
                here = at[by_block == b] - b * block * 8
                np.bitwise_or.at(part, here >> 3, np.left_shift(1, here & 7).astype(np.uint8))
        for b, part in own.items():
            yield to_batch(schema, [b], [part.tobytes()])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(part, np.uint8)
                found[b] = found[b] | own if b in found else own
        for b, part in found.items():
            yield to_batch(schema, [b], [part.tobytes()])

    parts = rows.mapInArrow(run, "block int, bits binary").repartition("block")
    out = np.zeros(bits // 8, np.uint8)
    for b, part in zip(*(c.to_pylist() for c in parts.mapInArrow(add, "block int, bits binary").toArrow().columns), strict=True):
        out[b * block : (b + 1) * block] |= np.frombuffer(part, np.uint8)
    return out


def membership(df: DataFrame, column: str) -> np.ndarray:
    """The bitmap of one BIGINT column's values."""
    return hashed_bitmap(df.select(column))


def likely_members(df: DataFrame, column: str, bitmap: np.ndarray) -> DataFrame:
    """The rows whose value has its bit set, and perhaps a few more."""
    place = df.columns.index(column)
    shared = df.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            yield batch.filter(pa.array(is_set(bits, numbers(batch.column(place)))))

    return df.mapInArrow(run, df.schema)


def most_frequent(df: DataFrame, count: str, most: int) -> DataFrame:
    """The rows with the largest counts, ``most`` at the most, by a threshold from a histogram (64 bins an octave)."""
    place = F.floor(F.log2(F.col(count).cast("double")) * 64)
    bins = df.where(F.col(count) > 0).groupBy(place.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, total = None, 0
    for r in sorted(bins, key=lambda r: -r["b"]):
        total += r["n"]
        if total > most:
            break
        least = r["b"]
    return df.where(F.lit(False)) if least is None else df.where((F.col(count) > 0) & (place >= least))


def to_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def sorted_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[pa.Table]:
    """Groups of equal keys from batches that are sorted by the keys; holds one group at a time."""
    held: list[pa.RecordBatch] = []

    def key_at(b: pa.RecordBatch, i: int) -> tuple:
        return tuple(b.column(b.schema.get_field_index(k))[i].as_py() for k in keys)

    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            v = batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.nonzero(change)[0].tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == 0 and held and key_at(batch, 0) != last:
                yield pa.Table.from_batches(held)
                held = []
            elif a and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = key_at(batch, batch.num_rows - 1)
    if held:
        yield pa.Table.from_batches(held)


# ---------------------------------------------------------------------------- connected components
def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge list; the component is its smallest node.

    Alternating large-star and small-star steps: each is one minimum per node,
    combined on the map side, and one join, so a node with very many edges is
    split by the skew join.  Every round is written to the shared folder.
    Edges with a null end are ignored; an empty edge list gives no rows.
    """
    pairs = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct(),
        "edges",
    )
    while True:  # each round brings every node's links nearer to the smallest node; it settles in a few
        # large star: every larger neighbour of a node is linked to the node's smallest one
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(low, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        # small star: every smaller neighbour, and the node, are linked to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array("v", "u")).alias("u"), F.col("m").alias("v"))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        nxt = stored(small, "edges")
        # done when each node has one smaller neighbour and that one has none
        state = nxt.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        again = nxt.join(state.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()
        pairs = nxt
        if not again and not state.where("n > 1").limit(1).count():
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
