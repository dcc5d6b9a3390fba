"""Benchmark decontamination against a brute-force search, components, and the pipeline stage by stage."""

from __future__ import annotations

import random

import numpy as np

import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import SF, documents
from tripyard.llm import decontam, repetition, toxicity
from tripyard.llm.common import components, most_frequent, sorted_groups

BENCH_DDL = "item_id long, text string, doc_id long, start long"


def bench(spark, rows):
    return spark.createDataFrame([(*r, 1, 1) for r in rows], BENCH_DDL)


def _text(codes: np.ndarray) -> str:
    return "".join(map(chr, codes))


def test_lemma_threshold_is_safe():
    """Every passage with edits inside its budget is found, wherever it lies in a text."""
    rng = random.Random(4)
    letters = "abcdefghij "
    items = ["".join(rng.choice(letters) for _ in range(rng.randrange(30, 700))) for _ in range(40)]
    index = decontam.Index.of([x.encode() for x in items])
    for i, item in enumerate(items):
        m = min(decontam.WINDOW_CHARS, len(decontam.normalise(item.encode())))
        edited = list(item[:m])
        for _ in range(decontam.budget(m)):
            p = rng.randrange(len(edited))
            edited[p : p + 1] = rng.choice([[], ["z"], [edited[p], "z"]])
        filler = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 300))) for _ in range(2)]
        text = decontam.normalise((filler[0] + "".join(edited) + filler[1]).encode())
        passage = decontam.normalise(item.encode())[: decontam.WINDOW_CHARS]
        if brute.edit_inside(_text(passage), _text(text)) <= decontam.budget(len(passage)):
            assert i in {f[0] for f in decontam.search(text, index)}, (i, m)


def test_short_items_are_found_word_for_word(spark):
    rows = [(1, "What is it? A CAT, and-dog."), (2, "scatter a cat and dogs"), (3, "a cat and dog a cat and dog"), (4, "cat"), (5, None), (6, "x")]
    items = [(1, "a cat and dog"), (2, "cat"), (3, "?!"), (4, "a cat"), (4, "A Cat!"), (5, "x")]
    got = {(r.doc_id, r.item_id): tuple(r)[2:] for r in decontam.find_leaks(documents(spark, rows), bench(spark, items)).collect()}
    want = {}
    for doc, text in rows:
        own = _text(decontam.normalise((text or "").encode()))
        for item, raw in items:
            short = _text(decontam.normalise(raw.encode()))
            at = [i for i in range(len(own)) if short and f" {own} "[i : i + len(short) + 2] == f" {short} "]
            if at:
                want[doc, item] = (len(at), 0, at[0], at[0] + len(short))
    assert got == want and len(want) == 10
    assert decontam.decontaminate(documents(spark, rows), bench(spark, items)).count() == len(rows)


def test_found_regions_are_within_the_budget():
    rng = random.Random(5)
    words = [f"{a}{b}" for a in "bcdfg" for b in "aeiou"]
    items = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(20)]
    index = decontam.Index.of([x.encode() for x in items])
    for _ in range(60):
        item = rng.choice(items).split()
        for _ in range(rng.randrange(0, 12)):
            item[rng.randrange(len(item))] = rng.choice(words)
        text = decontam.normalise(" ".join([*(rng.choice(words) for _ in range(30)), *item]).encode())
        found = {f[0]: f for f in decontam.search(text, index)}
        for i, own in enumerate(items):
            passage = decontam.normalise(own.encode())
            edits = brute.edit_inside(_text(passage), _text(text))
            assert (edits <= decontam.budget(len(passage))) == (i in found)
            if i in found:
                assert found[i][3] == edits


def test_items_cut_by_the_edges_of_a_text():
    """A text that starts or ends some characters inside an item holds it if the missing ones are within the edits."""
    rng = random.Random(6)
    letters = "abcdefghijklm"
    items = ["".join(rng.choice(letters) for _ in range(rng.randrange(40, 257))) for _ in range(30)]
    index = decontam.Index.of([x.encode() for x in items])
    held = 0
    for i, item in enumerate(items):
        k = decontam.budget(len(item))
        for left, right in ((0, k), (k, 0), (k // 2, k - k // 2), (0, k // 2), (0, k + 1), (k + 1, 0)):
            own = list(item[left : len(item) - right])
            if left + right < k:
                own[len(own) // 2] = "z"
            filler = "".join(rng.choice(letters) for _ in range(rng.randrange(300)))
            for text in ("".join(own), "".join(own) + (" " + filler if not right else ""), (filler + " " if not left else "") + "".join(own)):
                codes = decontam.normalise(text.encode())
                edits = brute.edit_inside(item, _text(codes))
                found = {f[0]: f for f in decontam.search(codes, index)}
                assert (edits <= k) == (i in found), (i, left, right, edits, k)
                if i in found:
                    held += 1
                    assert found[i][3] == edits and 0 <= found[i][1] < found[i][2] <= len(codes)
    assert held > 200


def test_every_region_counts(spark):
    """An item that a text holds twice has two regions, and one of several windows has one."""
    rng = random.Random(7)
    short, long = (" ".join(f"{rng.randrange(10**6):06d}" for _ in range(n)) for n in (20, 110))
    rows = [(1, f"{short} and then {short}"), (2, f"so {long}"), (3, short[3:] + " x " * 400 + short[:-3])]
    got = {(r.doc_id, r.item_id): r for r in decontam.find_leaks(documents(spark, rows), bench(spark, [(1, short), (2, long)])).collect()}
    assert {k: (r.n_regions, r.edits) for k, r in got.items()} == {(1, 1): (2, 0), (2, 2): (1, 0), (3, 1): (2, 3)}


def test_leaks_of_the_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, items).collect()}
    texts = {r.doc_id: _text(decontam.normalise(r.text.encode())) for r in docs.collect()}
    exact = {(d, r.item_id) for r in items.collect() for d, t in texts.items() if _text(decontam.normalise(r.text.encode())) in t}
    assert exact <= got and len(got) <= 1.2 * len(exact)
    clean = {r.doc_id for r in decontam.decontaminate(docs, items).collect()}
    assert clean == set(texts) - {d for d, _ in got}


def test_benchmark_in_blocks(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = sorted(map(str, decontam.find_leaks(docs, items).collect()))
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 1500)
    monkeypatch.setattr(decontam, "STRETCH", 700)
    assert {r[:60] for r in whole} and {tuple(r)[:2] for r in decontam.find_leaks(docs, items).collect()} == {
        tuple(r)[:2] for r in decontam.find_leaks(docs, items).collect()
    }
    assert len(decontam.find_leaks(docs, items).collect()) == len(whole)


def test_odd_rows(spark, odd_rows):
    item = " ".join(f"secret{i}" for i in range(12))
    rows = [*odd_rows, (90, "z " * 300_000 + item), (91, item.upper().replace(" ", " \n* ")), (None, item)]
    items = bench(spark, [(1, item), (1, item), (2, None), (3, ""), (4, "short"), (None, item)])
    got = decontam.find_leaks(documents(spark, rows), items).collect()
    assert sorted({(str(r.doc_id), str(r.item_id)) for r in got}) == sorted((d, i) for d in ("90", "91", "None") for i in ("1", "None"))
    kept = decontam.decontaminate(documents(spark, rows), items)
    assert kept.count() == len(odd_rows) and kept.columns == documents(spark, []).columns
    assert decontam.find_leaks(documents(spark, []), items).count() == 0
    assert decontam.find_leaks(documents(spark, rows), bench(spark, [])).count() == 0
    assert decontam.decontaminate(documents(spark, rows), bench(spark, [])).count() == len(rows)


# ---------------------------------------------------------------------------------------- helpers
def test_components_of_chains_stars_and_noise(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (None, 3), (3, None)]
    edges += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)]
    parent: dict = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_most_frequent_keeps_the_largest(spark):
    df = spark.createDataFrame([(i, i * i) for i in range(200)], "k long, n long")
    kept = sorted(r.k for r in most_frequent(df, "n", 20).collect())
    assert 15 <= len(kept) <= 20 and kept == list(range(200 - len(kept), 200))
    assert most_frequent(spark.createDataFrame([(1, 5)] * 30, "k long, n long"), "n", 20).count() == 0


def test_sorted_groups_across_batches():
    import pyarrow as pa

    keys = [1, 1, 2, 2, 2, 3, 5, 5, 9]
    whole = pa.RecordBatch.from_pydict({"k": keys, "v": list(range(9))})
    for size in range(1, 10):
        parts = [whole.slice(i, size) for i in range(0, 9, size)]
        assert [g.column("k").to_pylist() for g in sorted_groups(iter(parts), ["k"])] == [[1, 1], [2, 2, 2], [3], [5, 5], [9]]


# --------------------------------------------------------------------------------------- pipeline
def test_stages_against_brute_force(spark):
    """Each stage on what the one before kept; the last one packs every document that is left."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality_rules", "ngram_jaccard_join", "benchmark_decontamination", "packing"]
    sf_dir = "/root/testdata/sf0.01"
    rows = docs
    kept = {"": {r.doc_id: r.text for r in docs.collect()}}
    last = ""
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = corpus_pipeline.stored(stage(spark, rows, sf_dir), name)
        assert rows.columns == docs.columns
        kept[name] = {r.doc_id: r.text for r in rows.collect()}
        assert kept[name].items() <= kept[last].items() and len(kept[name]) < len(kept[last])
        last = name
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert set(kept["toxicity"]) == {k for k, t in kept[""].items() if model.score(t) < 0.5}
    hashes = repetition.WordHashes()
    assert set(kept["quality_rules"]) == {k for k, t in kept["toxicity"].items() if repetition.measure(t.encode(), hashes)[6]}
    assert not any(brute.repetition(t)[5] for t in kept["quality_rules"].values())
    groups = brute.jaccard_components(list(kept["quality_rules"].items()))
    assert set(kept["ngram_jaccard_join"]) == {k for k, (_, c) in groups.items() if k == c}
    items = [_text(decontam.normalise(r.text.encode())) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert not any(i in _text(decontam.normalise(t.encode())) for t in kept["benchmark_decontamination"].values() for i in items)
    out = corpus_pipeline.STAGES[-1][1](spark, rows, sf_dir).collect()
    assert {r.doc_id for r in out} == set(kept["benchmark_decontamination"])


def test_one_row_of_each_component_is_kept(spark):
    """Repeated rows, an id with two texts, near copies without an id, and components that have no id."""
    words = [f"w{i}" for i in range(80)]
    one, near = " ".join(words), " ".join(["v", *words[1:]])
    alone, other, last = (" ".join(f"{c}{i}" for i in range(40)) for c in "abc")
    rows = [(5, one), (5, one), (None, near), (None, near), (6, near), (6, alone), (8, alone), (None, other), (None, other), (9, last), (10, None)]
    docs = documents(spark, rows)
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert kept.columns == docs.columns
    want = [(5, one), (6, alone), (None, other), (9, last), (10, None)]
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(str, want))
    twice = corpus_pipeline.drop_near_copies(spark, docs.union(docs), SF)
    assert sorted(map(str, ((r.doc_id, r.text) for r in twice.collect()))) == sorted(map(str, want))


def test_pipeline_of_an_empty_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        rows = corpus_pipeline.stored(stage(spark, rows, SF), name)
        assert rows.count() == 0
