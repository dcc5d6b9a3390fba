"""How five filters interact: what each removes in every order in which they can be applied.

Every document gets a mask of the filters that it fails.  Documents are counted by part
and mask; what a set of filters leaves of a part depends on these counts alone.  A Gray
code then walks through all 32 sets of filters, toggling one filter at a time: each mask
cell holds the number of its failed filters that are active, and a cell leaves the
running survivors when that number becomes 1 and returns when it becomes 0.  The
survivors of all 32 sets are kept, and a step of an order removes the difference between
the sets before and after it.

Filters (a document fails when): A, under 100 words; B, 100 * distinct words < 80 *
words; C, 100 * [A-Z] characters > 10 * code points; D, it holds any of ``#$%&*|``; E, its
text is identical to that of a smaller id anywhere in the table.

Texts are compared by their SHA-256.  The smallest id of each text comes from one pre-added
minimum, and rows look themselves up by (text, id), so that a text held by a third of all
rows is spread over all tasks.

Defined results: a null text is an empty one; words are maximal runs without white space;
repeated rows count each time and are no copies of each other; a row without an id fails E
never and has no labels; a null label is no label, and of several labels for one id the
largest counts; a null part is the empty string; a part has all 600 rows, zeros included;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripyard.llm.common import stored

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PCT, MAX_CAPITALS_PCT = 100, 80, 10
SYMBOLS = "[#$%&*|]"
#: Measures that are added up for every mask: all documents, good ones, toxic ones.
MEASURES = ("n", "good", "toxic")
RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def own_failures(text: Column) -> dict[str, Column]:
    """Filters A to D, each a condition on the text alone."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < MIN_WORDS,
        "B": distinct * 100 < n * MIN_DISTINCT_PCT,
        "C": capitals * 100 > F.length(text) * MAX_CAPITALS_PCT,
        "D": text.rlike(SYMBOLS),
    }


def _bits(failures: dict[str, Column]) -> Column:
    total = F.lit(0)
    for name, fails in failures.items():
        total = total + F.when(fails, 1 << FILTERS.index(name)).otherwise(0)
    return total


def masks(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents counted by the set of filters that they fail."""
    whole = F.coalesce(docs[text], F.lit(""))
    rows = stored(  # the texts are read once; what is kept of a row is narrow
        docs.select(
            docs[key].alias("id"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"),
            F.unhex(F.sha2(whole.cast("binary"), 256)).alias("same"), _bits(own_failures(whole)).alias("own"),
        )
        .groupBy("id", "part", "same", "own")
        .agg(F.count(F.lit(1)).alias("n")),
        "masks",
    )
    first = rows.where("id IS NOT NULL").groupBy("same").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    known = labels.where(labels[key].isNotNull()).groupBy(labels[key].alias("id")).agg(
        F.max(F.when(labels["quality"] == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(labels["toxic"] == 1, 1).otherwise(0)).alias("toxic"),
    )
    copies = F.when(F.col("first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    named = (
        rows.where("id IS NOT NULL")
        .join(first, ["same", "id"], "left")
        .select("id", "part", "n", (F.col("own") + copies).alias("mask"))
        .join(known, "id", "left")
        .select("part", "mask", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    )
    # rows without an id meet no join, or they would all land in one task
    nameless = rows.where("id IS NULL").select("part", F.col("own").alias("mask"), "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return (
        named.union(nameless)
        .groupBy("part", "mask")
        .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    )


def survivors(cells: np.ndarray, filters: int) -> np.ndarray:
    """What every set of filters leaves, from the counts of every mask: (2^filters, measures).

    ``cells[m]`` holds the measures of the documents whose failed filters are the bits of m.
    """
    size = 1 << filters
    active = np.zeros(size, np.int64)  # each cell's failed filters that are switched on
    running = cells.sum(axis=0)
    out = np.zeros((size, cells.shape[1]), np.int64)
    out[0] = running
    fails = [(np.arange(size) >> f) & 1 == 1 for f in range(filters)]
    state = 0
    for step in range(1, size):
        gray = step ^ (step >> 1)
        f = (gray ^ state).bit_length() - 1
        if gray >> f & 1:
            running = running - cells[fails[f] & (active == 0)].sum(axis=0)
            active[fails[f]] += 1
        else:
            active[fails[f]] -= 1
            running = running + cells[fails[f] & (active == 0)].sum(axis=0)
        state = gray
        out[gray] = running
    return out


def orders_of(part: str, cells: np.ndarray) -> pd.DataFrame:
    """Every order and step of one part."""
    left = survivors(cells, len(FILTERS))
    bits = {name: 1 << i for i, name in enumerate(FILTERS)}
    failing = {name: int(sum(cells[m, 0] for m in range(len(cells)) if m & b)) for name, b in bits.items()}
    alone = {name: int(cells[b, 0]) for name, b in bits.items()}
    rows, shapley = [], dict.fromkeys(FILTERS, 0)
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            after = before | bits[name]
            removed, good, toxic = (int(x) for x in left[before] - left[after])
            shapley[name] += removed
            rows.append((part, "".join(order), step, int(left[after, 0]), removed, failing[name] - removed, alone[name], good, toxic, name))
            before = after
    return pd.DataFrame([(*r[:-1], shapley[r[-1]]) for r in rows], columns=[c.split()[0] for c in RESULT.split(", ")])


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row for each part, order of the filters and step."""

    def walk(group: pd.DataFrame) -> pd.DataFrame:  # at most 32 rows
        cells = np.zeros((1 << len(FILTERS), len(MEASURES)), np.int64)
        cells[group["mask"].to_numpy()] = group[list(MEASURES)].to_numpy()
        return orders_of(group["part"].iloc[0], cells)

    return masks(docs, labels, key, text, part).groupBy("part").applyInPandas(walk, RESULT)
