"""URL filters: a sort-merge range join of url keys with nested rule intervals.

A host turned round label by label, each label closed by a dot
(``www.example.net`` -> ``net.example.www.``), makes "this host and all its
subdomains" one interval of keys: those that start with the rule's key.  The
urls are range-partitioned and sorted by key; each task sweeps its sorted keys
and the sorted rules together and keeps a stack of the rule intervals that hold
the current key.  Intervals of this kind nest or are apart, never cross.  A rule
also has a path prefix, an interval of paths: the paths of one key's rules are sorted,
each knows the nearest one that it lies in, and a url's path goes to the last rule at or
before it and from there up to the first that holds it.  So a url costs about as much
however many rules its host has.  The longest (host, then path) that fits wins.

Rules beyond :data:`BLOCK_RULES` are swept in blocks, each over all urls, and the
longest fit of all blocks wins.

Defined results: a null url, or one without ``://``, has an empty host and path
and fits no rule; an empty url table gives no rows; no rules: every url gets the
default verdict; repeated rules: the block verdict wins over allow; a rule with a
null or empty host is ignored, a null path is ``/``; repeated urls each get their
row; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripyard.llm.common import stored, to_batch

#: Rules that one sweep holds in each task.
BLOCK_RULES = 100_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """``www.example.net`` -> ``net.example.www.``; an empty host has an empty key."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _rule_rows(rules: DataFrame) -> DataFrame:
    host = F.translate(F.col("host"), _UPPER, _LOWER)
    clean = rules.where("host is not null and host <> ''").select(
        host.alias("host"), F.coalesce("path", F.lit("/")).alias("path"), "verdict"
    )
    # block sorts after allow: a rule given with both verdicts blocks
    return clean.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).withColumn("key", host_key(F.col("host")))


class Paths:
    """The path prefixes of the rules of one key, as nested intervals."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        self.rules = sorted(rules)  # (path, rule, verdict)
        self.paths = [r[0] for r in self.rules]
        self.around: list[int] = []  # the nearest path that each lies in
        open_paths: list[int] = []
        for i, path in enumerate(self.paths):
            while open_paths and not path.startswith(self.paths[open_paths[-1]]):
                open_paths.pop()
            self.around.append(open_paths[-1] if open_paths else -1)
            open_paths.append(i)

    def longest(self, path: str) -> tuple[str, str, str] | None:
        at = bisect_right(self.paths, path) - 1
        while at >= 0 and not path.startswith(self.paths[at]):
            at = self.around[at]
        return self.rules[at] if at >= 0 else None


class Sweep:
    """One pass over keys in ascending order, with the stack of rule intervals that hold the key."""

    def __init__(self, rules: list[tuple[bytes, str, str, str]]):
        self.rules, self.next, self.stack = [(k, Paths([r[1:] for r in own])) for k, own in groupby(rules, key=lambda r: r[0])], 0, []

    def at(self, key: bytes) -> list[tuple[bytes, Paths]]:
        """The keys that hold this one, and their rules' paths; the longest key is last."""
        stack, rules = self.stack, self.rules
        while stack and not key.startswith(stack[-1][0]):
            stack.pop()
        while self.next < len(rules) and rules[self.next][0] <= key:
            rule = rules[self.next]
            self.next += 1
            if key.startswith(rule[0]):
                stack.append(rule)
        return stack


def judge_urls(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """(key, host, path, rule, verdict) for every row; ``rules`` has host, path and verdict (allow or block)."""
    rows = _rule_rows(rules)
    total = rows.count()
    blocks = max(1, -(-total // BLOCK_RULES))
    urls = (
        pages.select(pages[key].alias(key), url_host(pages[url]).alias("host"), url_path(pages[url]).alias("path"))
        .withColumn("key", host_key(F.col("host")).cast("binary"))
        .withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string"), "rank": F.lit(0).cast("long")})
    )
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the id and path split a host that holds a large share of the rows over many ranges
    urls = urls.repartitionByRange(parts, "key", "path", key).sortWithinPartitions("key")
    schema = pa.schema([
        (key, pa.int64()), ("host", pa.string()), ("path", pa.string()), ("key", pa.binary()),
        ("rule", pa.string()), ("verdict", pa.string()), ("rank", pa.int64()),
    ])
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("host", "path"), F.lit(blocks)) == block) if blocks > 1 else rows
        held = sorted((r["key"].encode(), r["path"], f"{r['host']}{r['path']}", r["verdict"]) for r in part.collect())

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            sweep = Sweep(held)
            for batch in batches:
                keys, paths, old = (batch.column(i).to_pylist() for i in (3, 2, 6))
                found, verdicts, ranks = batch.column(4).to_pylist(), batch.column(5).to_pylist(), old
                for i, (k, path) in enumerate(zip(keys, paths, strict=True)):
                    for held_by, rules_there in reversed(sweep.at(k)):
                        best = rules_there.longest(path)
                        if best:
                            rank = (len(held_by) << 32) + len(best[0])
                            if rank > ranks[i]:
                                found[i], verdicts[i], ranks[i] = best[1], best[2], rank
                            break
                yield to_batch(schema, *(batch.column(i).cast(schema.field(i).type) for i in range(4)), found, verdicts, ranks)

        if block:  # a task's rows come in the written order of the block before
            urls = stored(urls, "urls").repartitionByRange(parts, "key", "path", key).sortWithinPartitions("key")
        urls = urls.mapInArrow(run, f"{key} long, host string, path string, key binary, rule string, verdict string, rank long")
    return urls.select(key, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
