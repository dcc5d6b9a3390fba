"""Main text by a site style tree: the pages of one host are merged, and unimportant branches removed.

Every block element of a page is a node, named by the path of tags, classes and ids
above it.  Merging the pages of a host gives each node

* its styles: the sequences of child elements it has on the host's pages.  With m
  pages and shares p_i its presentation importance is the entropy
  -sum p_i log_m p_i: a node that always looks the same is a frame;
* its content: the texts beneath it.  A text that m pages share evenly has entropy
  1, one that a single page has, 0; the content importance is 1 minus the mean.

A node's importance mixes both, (1 - g^l) presentation + g^l content with l styles;
on a single page every node has importance 1.  A node that fewer than :data:`MIN_PAGES` of
its host's pages have is judged by the figures of its like: the nodes of that path on all
hosts where it is so rare, merged as if they were one host's.

What a site shows of itself cannot tell a page's own comments or adverts from its own
text, so elements that state a purpose count as well: menus, footers, sidebars and forms by
their tag or role, and class names and ids (adverts, notices, comments ...) are never
content, inside an article or not.  A name is read as its words; it states a purpose if
all of them do but for numbers and words of place (``comments-list``, ``top-banner``), so
``related-work`` or ``share-price`` state none.  A header is only outside an article no
content; inside it, the entropies decide.

A page is an article page if its ``article`` or ``main`` elements hold at least as much
text as any other branch that is not named otherwise.  Such a page keeps what lies inside
them but for nodes that nearly every page of the host repeats (:data:`REPEATED`; a header's
importance counts times :data:`NAMED`).  Every other page keeps the branches of at least
:data:`IMPORTANT`; articles that are smaller than another branch are teasers, and go.

Texts and styles are pre-added per task and combined by sums, so a host with a large
share of all pages is no single task's work.  The weak nodes' figures travel with the
tasks if they measure at most :data:`CARRIED_BYTES`; beyond that pages meet the figures of
their own nodes by a join.

Defined results: null or empty html gives an empty text; a null url, or one without a
host, is judged with all others of that kind; pages of any length are read whole;
repeated pages and ids give a row each; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripyard.llm.common import TEXT_ROWS, stored, text_steps, to_batch
from tripyard.llm.markup import ancestors, read_page
from tripyard.llm.url_rules import url_host

DECAY = 0.9
#: Least importance of a branch on a page without an article, and the most at which one inside an article goes.
IMPORTANT, REPEATED = 0.3, 0.15
#: What is left of the importance of a node inside an article that is named as a header.
NAMED = 0.3
#: Nodes of at least this importance are kept wherever they lie.
SAFE = max(IMPORTANT, REPEATED / NAMED)
#: Pages from which a node's figures are taken to mean something; with fewer on its host it is judged with its like.
MIN_PAGES = 5
#: Pre-added rows that a task holds before it passes them on.
HELD_ROWS = 500_000
#: Weak nodes travel with the tasks up to this size; a node is a row of fixed width.
CARRIED_BYTES, ROW_BYTES = 4 << 20, 32

# Element names and usual class names that state a purpose, and words of place that go with them.
_NOISE_TAGS = frozenset("nav aside footer form menu dialog search fieldset select".split())
_HEADERS = frozenset("header masthead".split())
_NOISE_WORDS = _HEADERS | frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu navbar nav "
    "navigation breadcrumb breadcrumbs footer cookie cookies consent notice notices alert popup modal "
    "comment comments disqus reply replies share sharing social related recommended newsletter subscribe login signup "
    "toolbar pagination pager skip widget tracking search".split()
)
_PLACE_WORDS = frozenset(
    "list box container wrapper wrap area section block top bottom left right side main site page form bar inner outer item "
    "items row slot unit panel button buttons link links holder group".split()
)
_NOISE_NAMES = frozenset("google-ad related-posts related-articles".split())
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
_MAIN_WORDS = frozenset("articlebody article-body post-body entry-content post-content article-content main-content".split())
_CONTAINERS = frozenset("div section article main ul ol dl table aside nav footer header form figure details blockquote".split())


def _parts(key: str) -> tuple[str, list[str], str]:
    tag, _, role = key.partition("@")
    tag = re.split(r"[.#]", tag)
    return tag[0], tag[1:], role


def purpose_words(name: str) -> frozenset[str]:
    """The words of a class name or id that state a purpose other than content, if all of them do."""
    name = name.replace("_", "-")
    words = {w for w in name.split("-") if w and not w.isdigit()} - _PLACE_WORDS
    if name in _NOISE_NAMES or (words and words <= _NOISE_WORDS):
        return frozenset(words)
    return frozenset()


def named_otherwise(key: str) -> bool:
    """Whether a class name or the id of an element states a purpose other than content."""
    return any(purpose_words(n) for n in _parts(key)[1])


def _named_within(key: str) -> bool:
    """The same inside an article, where a header is one of the article."""
    return any(purpose_words(n) - _HEADERS for n in _parts(key)[1])


def stated_purpose(path: str) -> tuple[bool, bool]:
    """(lies in an article or main element, lies in an element that states that it is no content)."""
    main = noise = False
    for key in path.split("/")[1:]:
        tag, names, role = _parts(key)
        if tag in ("article", "main") or role == "main" or _MAIN_WORDS.intersection(names):
            main = True
        if tag in _NOISE_TAGS or role in _NOISE_ROLES or (tag == "header" and not main):
            noise = True
        elif tag not in ("html", "body") and (_named_within(key) if main else named_otherwise(key)):
            noise = True
    return main, noise


def _h(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _containers(path: str) -> Iterator[str]:
    """The nodes that can be removed as a branch: containers below the body."""
    for p in ancestors(path):
        if re.split(r"[.#@]", p.rpartition("/")[2], maxsplit=1)[0] in _CONTAINERS:
            yield p


def _source(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """Key, url, host and html; ``page`` is the same for pages with one content and url, which are judged alike."""
    return pages.select(
        F.xxhash64(pages[url], pages[html]).alias("page"), pages[key].cast("long").alias("key"), pages[url].alias("url"),
        url_host(pages[url]).alias("host"), pages[html].alias("html"),
    )


def _read(html: bytes) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    return read_page(html.decode("utf-8", "replace"))


def node_importance(source: DataFrame) -> DataFrame:
    """(host, node, pages, importance) of every container node of every host; hosts and nodes are hashes."""
    schema = pa.schema([
        ("host", pa.int64()), ("node", pa.int64()), ("kind", pa.int32()), ("what", pa.int64()), ("n", pa.int64()), ("nlogn", pa.float64())
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int, int, int], list[float]] = {}

        def told() -> pa.RecordBatch:
            keys = np.array(list(held), np.int64).reshape(-1, 4)
            sums = np.array(list(held.values())).reshape(-1, 2)
            return to_batch(schema, keys[:, 0], keys[:, 1], keys[:, 2].astype(np.int32), keys[:, 3], sums[:, 0].astype(np.int64), sums[:, 1])

        for batch, raw in text_steps(batches, "html"):
            for host, html in zip(batch.column("host").to_pylist(), raw, strict=True):
                blocks, elements = _read(html)
                h, page, names = _h(host), Counter(), {}
                for path, text in blocks:
                    t = _h(text)
                    if path not in names:
                        names[path] = [_h(p) for p in _containers(path)]
                    for node in names[path]:
                        page[h, node, 1, t] += 1
                for path, style in set(elements):
                    if next(_containers(path), None) == path:
                        page[h, _h(path), 0, _h(style)] = 1
                for k, n in page.items():
                    got = held.setdefault(k, [0, 0.0])
                    got[0] += n
                    got[1] += n * math.log(n)
            if len(held) >= HELD_ROWS:
                yield told()
                held.clear()
        yield told()

    counted = (
        source.select("host", "html")
        .mapInArrow(run, "host long, node long, kind int, what long, n long, nlogn double")
        .groupBy("host", "node", "kind", "what")
        .agg(F.sum("n").alias("n"), F.sum("nlogn").alias("nlogn"))
    )
    counted = stored(counted, "counted", TEXT_ROWS)
    own = _importance(counted, ["host"])
    few = own.where(F.col("pages") < MIN_PAGES).select("host", "node")
    pooled = _importance(counted.join(few, ["host", "node"], "left_semi"), [])
    return own.where(F.col("pages") >= MIN_PAGES).unionByName(few.join(pooled, "node"))


def _importance(counted: DataFrame, host: list[str]) -> DataFrame:
    """(host, node, pages, importance) of the nodes of one host, or of several hosts taken as one."""
    counts = counted.groupBy(*host, "node", "kind", "what").agg(F.sum("n").alias("n"), F.sum("nlogn").alias("nlogn"))
    # a style is counted once a page; a text's entropy over pages is log n - sum(n_j log n_j) / n
    entropy = F.log("n") - F.col("nlogn") / F.col("n")
    nodes = counts.groupBy(*host, "node").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("pages"),
        F.count_if(F.col("kind") == 0).alias("styles"),
        F.sum(F.when(F.col("kind") == 0, F.col("n") * F.log("n"))).alias("slogs"),
        F.avg(F.when(F.col("kind") == 1, entropy)).alias("texts"),
    )
    m = F.log("pages")
    presentation = (m - F.col("slogs") / F.col("pages")) / m
    content = 1 - F.least(F.lit(1.0), F.coalesce(F.col("texts"), m) / m)
    kept = F.pow(F.lit(DECAY), F.col("styles"))
    return nodes.where("pages > 0").select(
        *host, "node", "pages",
        F.when(F.col("pages") == 1, F.lit(1.0)).otherwise((1 - kept) * presentation + kept * content).alias("importance"),
    )


def _repeated(path: str, importance: dict[int, tuple[int, float]], below: float) -> bool:
    """Whether a branch that the path lies in has too little importance."""
    figures = (importance.get(_h(node), (0, 1.0)) for node in _containers(path))
    return any(pages >= MIN_PAGES and value < below for pages, value in figures)


def holds_article(
    paths: list[str], texts: list[str], purpose: dict[str, tuple[bool, bool]], importance: dict[int, tuple[int, float]]
) -> bool:
    """Whether the page's articles hold at least as much text as any branch beside them that may be content."""
    inside = {p for p in purpose if purpose[p] == (True, False)}
    if not inside:
        return False
    above = {a for p in inside for a in ancestors(p)}
    size, beside = 0, Counter()
    for path, text in zip(paths, texts, strict=True):
        if path in inside:
            size += len(text)
        elif not purpose[path][1] and not _repeated(path, importance, IMPORTANT):
            # the outermost element that holds the block and no part of an article
            own = [a for a in ancestors(path) if a not in above]
            at = own[-1] if own else path
            tag = re.split(r"[.#@]", at.rpartition("/")[2], maxsplit=1)[0]
            beside[at if tag in _CONTAINERS else at.rpartition("/")[0]] += len(text)
    return size >= max(beside.values(), default=0)


def main_text(paths: list[str], texts: list[str], importance: dict[int, tuple[int, float]]) -> str:
    """The blocks that are content, joined by line breaks."""
    purpose = {p: stated_purpose(p) for p in set(paths)}
    has_main = holds_article(paths, texts, purpose, importance)
    low: dict[str, bool] = {}
    for p, (main, _) in purpose.items():
        if not has_main:
            low[p] = _repeated(p, importance, IMPORTANT)
            continue
        low[p] = False
        for node in _containers(p):
            name = re.split(r"[.#@]", node.rpartition("/")[2], maxsplit=1)[0]
            if name in ("article", "main") or not main:
                break
            pages, value = importance.get(_h(node), (0, 1.0))
            if named_otherwise(node.rpartition("/")[2]):
                value *= NAMED
            if pages >= MIN_PAGES and value < REPEATED:
                low[p] = True
    kept = [t for p, t in zip(paths, texts, strict=True) if not purpose[p][1] and not low[p] and purpose[p][0] == has_main]
    return "\n".join(kept)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text, n_chars) for every page."""
    source = _source(pages, key, url, html)
    # only nodes that some page may lose are sent to the pages
    weak = stored(
        node_importance(source).where((F.col("pages") >= MIN_PAGES) & (F.col("importance") < SAFE)), "nodes"
    )
    if weak.count() * ROW_BYTES <= CARRIED_BYTES:
        return _judge_carried(source, weak, key)
    return _judge_joined(source, weak, key)


def _out(key: str) -> tuple[pa.Schema, str]:
    return pa.schema([(key, pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())]), (
        f"{key} long, url string, text string, n_chars long"
    )


def _judge_carried(source: DataFrame, weak: DataFrame, key: str) -> DataFrame:
    """The weak nodes, of at most :data:`CARRIED_BYTES`, travel with the tasks."""
    low: dict[int, dict[int, tuple[int, float]]] = {}
    for r in weak.collect():
        low.setdefault(r["host"], {})[r["node"]] = (r["pages"], r["importance"])
    shared = source.sparkSession.sparkContext.broadcast(low)
    out, ddl = _out(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = shared.value
        for batch, raw in text_steps(batches, "html"):
            texts = []
            for host, html in zip(batch.column("host").to_pylist(), raw, strict=True):
                found = _read(html)[0]
                texts.append(main_text([p for p, _ in found], [t for _, t in found], low.get(_h(host), {})))
            yield to_batch(out, batch.column("key"), batch.column("url"), texts, [len(t) for t in texts])

    return source.select("key", "url", "host", "html").mapInArrow(run, ddl)


def _judge_joined(source: DataFrame, weak: DataFrame, key: str) -> DataFrame:
    """Pages meet the weak nodes among their own by joins."""
    schema = pa.schema([("page", pa.int64()), ("host", pa.int64()), ("node", pa.int64())])

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in text_steps(batches, "html"):
            page, hosts, found = [], [], []
            for p, host, html in zip(batch.column("page").to_pylist(), batch.column("host").to_pylist(), raw, strict=True):
                names = {_h(c) for path in {path for path, _ in _read(html)[0]} for c in _containers(path)}
                page += [p] * len(names)
                hosts += [_h(host)] * len(names)
                found += names
            yield to_batch(schema, page, hosts, found)

    held = source.select("page", "host", "html").mapInArrow(own, "page long, host long, node long").distinct()
    verdicts = held.join(weak, ["host", "node"]).groupBy("page").agg(
        F.collect_list("node").alias("nodes"), F.collect_list("pages").alias("counts"), F.collect_list("importance").alias("values")
    )  # at most the nodes of one page

    packed = pa.schema([("page", pa.int64()), ("key", pa.int64()), ("url", pa.string()), ("blocks", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the blocks travel compressed: they are most of what the join moves
        press = zstandard.ZstdCompressor(level=3)
        for batch, raw in text_steps(batches, "html"):
            blobs = [press.compress(json.dumps(_read(html)[0], ensure_ascii=False).encode("utf-8", "surrogatepass")) for html in raw]
            yield to_batch(packed, batch.column("page"), batch.column("key"), batch.column("url"), blobs)

    blocks = source.select("page", "key", "url", "html").mapInArrow(pack, "page long, key long, url string, blocks binary")
    joined = blocks.join(verdicts, "page", "left").select("key", "url", "blocks", "nodes", "counts", "values")
    out, ddl = _out(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch, blobs in text_steps(batches, "blocks"):
            texts = []
            weak = (batch.column(n).to_pylist() for n in ("nodes", "counts", "values"))
            for blob, nodes, counts, values in zip(blobs, *weak, strict=True):
                found = json.loads(unpress.decompress(blob))
                low = dict(zip(nodes, zip(counts, values, strict=True), strict=True)) if nodes else {}
                texts.append(main_text([p for p, _ in found], [t for _, t in found], low))
            yield to_batch(out, batch.column("key"), batch.column("url"), texts, [len(t) for t in texts])

    return joined.mapInArrow(run, ddl)
