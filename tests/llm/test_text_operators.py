"""Repetition coverage, the class model, the Jaccard join and packing against brute force, odd rows included."""

from __future__ import annotations

import math
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import SF, documents
from tripyard.llm import brown_lm, jaccard_join, packing, repetition
from tripyard.llm.queries import tokenizer_paths


def _rows(spark, path=SF):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]


# ------------------------------------------------------------------------------------- repetition
def test_repetition_base_equals_brute_force(spark, odd_rows):
    rows = odd_rows + _rows(spark)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = repetition.repetition_rules(documents(spark, rows)).select("doc_id", *names, "kept").collect()
    want = sorted((str(k), *brute.repetition(t)) for k, t in rows)
    assert sorted((str(r[0]), *r[1:-1]) for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)


def test_repetition_rejects_repeats_and_keeps_prose(spark):
    prose = " ".join(f"word{i}" for i in range(300))
    rows = [(1, prose), (2, "buy this thing now at once or never again " * 40), (3, "same line here\n" * 50 + prose[:100])]
    docs = documents(spark, rows)
    assert {r.doc_id: r.kept for r in repetition.repetition_rules(docs).collect()} == {1: True, 2: False, 3: False}
    kept = repetition.passing(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]


# ------------------------------------------------------------------------------------ class model
def test_base_score_equals_brute_force_and_model_is_better(spark, odd_rows):
    rows = odd_rows + [(1000 + k, t) for k, t in _rows(spark)]
    got = brown_lm.score(documents(spark, rows)).collect()
    want = brute.unigram(rows)

    def key(r):
        return (str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 6))

    assert sorted(key(r) for r in got) == sorted(key((rows[i][0], *v)) for i, v in want.items())
    held = [r for r in got if r.held_out and (r.doc_id or 0) >= 1000]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_word_counts_beyond_the_carried_ones_come_by_the_join(spark, monkeypatch):
    rows = _rows(spark)
    monkeypatch.setattr(brown_lm, "CARRIED", 50)
    got = {r.doc_id: r for r in brown_lm.score(documents(spark, rows)).collect()}
    for i, v in brute.unigram(rows).items():
        r = got[rows[i][0]]
        assert (r.n_tokens, r.n_known) == v[1:3] and abs(r.base_score - v[4]) < 1e-6


def _classes(spark, rows):
    """word id -> class, by the module's own steps."""
    docs = documents(spark, rows)
    counts = brown_lm.word_counts(docs, "doc_id", "text")
    carried = brown_lm.most_frequent(counts, "a", brown_lm.CARRIED).toPandas()
    ids = carried["w"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(ids)
    codes = brown_lm.coded(docs, "doc_id", "text", ids[order])
    classed = brown_lm.class_of_all(docs, counts, codes, ids[order], carried["c"].to_numpy(np.int64)[order])
    return {r["w"] & (2**64 - 1): r["cls"] for r in classed.collect()}, counts


@pytest.mark.parametrize("carried", [brown_lm.CARRIED, 60, 1])
def test_scores_equal_a_plain_class_model(spark, monkeypatch, odd_rows, carried):
    """The score column from the classes alone, also where most words do not travel with the tasks."""
    monkeypatch.setattr(brown_lm, "CARRIED", carried)
    monkeypatch.setattr(brown_lm, "ITEMS", 20)
    monkeypatch.setattr(brown_lm, "HELD_WORDS", 50)
    rows = odd_rows + [(1000 + k, t) for k, t in _rows(spark)[:60]]
    cls, _ = _classes(spark, rows)
    texts = [(brute.crc_fold(k, 7) == 2, [brown_lm.word_id(w.encode()) for w in brute.words(t)] + [brown_lm.END]) for k, t in rows]
    k = 2 * brown_lm.CLASSES
    table, count = np.zeros((k, k)), Counter()
    for held, w in texts:
        if not held:
            count.update(w)
            for x, y in zip([brown_lm.END, *w], w, strict=False):
                table[cls[x], cls[y]] += 1
    words_of = Counter(cls[w] for w in count)
    size = table.sum(axis=0)
    q = (size + 1) / (size.sum() + k)
    want = []
    for (key, _), (_, w) in zip(rows, texts, strict=True):
        total = 0.0
        for x, y in zip([brown_lm.END, *w], w, strict=False):
            b = cls[y]
            total += math.log10((table[cls[x], b] + 5 * q[b]) / (table[cls[x]].sum() + 5)) + math.log10((count[y] + 1) / (size[b] + words_of[b] + 1))
        want.append((str(key), round(total, 4)))
    got = [(str(r.doc_id), round(r.score, 4)) for r in brown_lm.score(documents(spark, rows)).collect()]
    assert [x[0] for x in sorted(got)] == [x[0] for x in sorted(want)]
    assert np.allclose([x[1] for x in sorted(got)], [x[1] for x in sorted(want)], atol=1e-3)


@pytest.mark.parametrize("held", [brown_lm.HELD_WORDS, 40])
def test_an_exchange_step_against_plain_counting(spark, monkeypatch, held):
    """Every training word that has a known neighbour joins the class that its neighbours favour, carried or not."""
    monkeypatch.setattr(brown_lm, "HELD_WORDS", held)
    rows = _rows(spark)[:80]
    counts = Counter(w for k, t in rows if brute.crc_fold(k, 7) != 2 for w in [*brute.words(t), "\n"])
    ids = {w: brown_lm.word_id(w.encode()) for k, t in rows for w in [*brute.words(t), "\n"]}
    known = np.sort(np.array([ids[w] for w, _ in counts.most_common(40)], np.uint64))
    rng = np.random.default_rng(6)
    class_of = rng.integers(-1, 4, len(known)).astype(np.int16)
    fixed = np.arange(len(known)) < 10
    gains = rng.normal(size=(8, 4))
    codes = brown_lm.coded(documents(spark, rows).repartition(4), "doc_id", "text", known)
    got = {r["w"] & (2**64 - 1): r["cls"] for r in brown_lm.assign(codes.where("NOT held_out"), known, class_of, fixed, gains).collect()}
    side = {int(w): int(c) for w, c in zip(known, class_of, strict=True)}
    total: dict = {}
    for k, t in rows:
        if brute.crc_fold(k, 7) == 2:
            continue
        w = [ids[x] for x in [*brute.words(t), "\n"]]
        for i, x in enumerate(w):
            for j, shift in ((i - 1, 0), (i + 1, 4)):
                c = side.get(w[j], -1) if 0 <= j < len(w) else -1
                if c >= 0:
                    total.setdefault(x, np.zeros(4))
                    total[x] += gains[c + shift]
    for w in known[fixed]:
        total.pop(int(w), None)
    assert set(got) == set(total) and len(got) > 500
    sure = [w for w, g in total.items() if np.diff(np.sort(g)[-2:])[0] > 1e-9]
    assert all(got[w] == int(np.argmax(total[w])) for w in sure) and len(sure) > 500


def test_words_unseen_in_training_go_by_their_ending(spark):
    rows = [(i, "alpha bring beta sing gamma ring alpha bring " * 5) for i in range(60)] + [(i, "alpha zzing beta") for i in range(60, 80)]
    rows = [r for r in rows if r[0] < 60 and brute.crc_fold(r[0], 7) != 2 or r[0] >= 60 and brute.crc_fold(r[0], 7) == 2]
    cls, counts = _classes(spark, rows)
    unseen = brown_lm.word_id(b"zzing")
    assert {r["w"] & (2**64 - 1): r["c"] for r in counts.collect()}[unseen] == 0
    assert cls[unseen] in {cls[brown_lm.word_id(w)] for w in (b"bring", b"sing", b"ring")} or cls[unseen] >= brown_lm.CLASSES


def test_class_model_is_a_distribution():
    """The module's transitions, and the words of a class with one unknown word, add up to 1."""
    rng = np.random.default_rng(1)
    table, known = rng.integers(0, 9, (5, 5)).astype(float), np.array([3, 0, 7, 1, 2.0])
    steps, shares = brown_lm.class_model(table, known)
    assert np.allclose((10**steps).sum(axis=1), 1)
    assert np.allclose((table.sum(axis=0) + known + 1) / 10**shares, 1)
    label = brown_lm.exchange(rng.integers(0, 9, (21, 21)).astype(float), 5)
    assert label[-1] == 4 and set(label[:-1]) <= {0, 1, 2, 3}


def test_exchange_finds_planted_classes():
    """Words that follow each other by class only: the classes are found."""
    rng = np.random.default_rng(2)
    kind = np.repeat([0, 1, 2], 10)
    n = 30
    bigrams = np.zeros((n + 1, n + 1))
    for _ in range(20_000):
        a = rng.integers(n)
        b = rng.choice(np.nonzero(kind == (kind[a] + 1) % 3)[0])
        bigrams[a, b] += 1
    label = brown_lm.exchange(bigrams, 4)
    assert all(len(set(label[:n][kind == k])) == 1 for k in range(3)) and len(set(label[:n])) == 3


def test_class_model_of_an_empty_table(spark):
    assert brown_lm.score(documents(spark, [])).count() == 0


# ----------------------------------------------------------------------------------- Jaccard join
@pytest.mark.parametrize("n_frequent", [0, 40])
@pytest.mark.parametrize("order", [0, 1])
def test_similar_sets_share_a_prefix_token_under_the_counted_orders(order, n_frequent):
    """The prefixes that orders 0 and 1 give, with the counts of the whole collection."""
    rng = np.random.default_rng(order + n_frequent)
    pool = rng.integers(0, 2**63, 900).astype(np.uint64)
    sets = []
    for _ in range(60):
        base = rng.choice(pool, rng.integers(5, 120), replace=False)
        sets.append(np.unique(base))
        for _ in range(2):
            other = base.copy()
            other[: rng.integers(0, max(1, len(base) // 8) + 1)] = rng.integers(0, 2**63)
            sets.append(np.unique(np.append(other, rng.choice(pool, rng.integers(0, 4)))))
    frequent = np.sort(rng.choice(pool, n_frequent, replace=False))
    ranks = rng.permutation(n_frequent)
    split = jaccard_join._order_rows(order, frequent, ranks)
    rows = [split(s) for s in sets]
    df = Counter(t for light, _, _ in rows for t in light.tolist())

    def prefix(light, more, base) -> set[int]:
        shared = sorted((t for t in light.tolist() if df[t] > 1), key=lambda t: (df[t], np.uint64(t).astype(np.int64)))
        return set(more.tolist()) | set(shared[: max(0, base + len(shared))])

    prefixes = [prefix(*r) for r in rows]
    similar = 0
    for i, x in enumerate(sets):
        for j in range(i):
            common = len(np.intersect1d(x, sets[j]))
            if 100 * common >= 80 * (len(x) + len(sets[j]) - common):
                similar += 1
                assert prefixes[i] & prefixes[j]
    assert similar > 40


def test_a_column_of_the_name_used_for_repeats_stays(spark):
    rows = spark.createDataFrame([(1, "a b c d e f", 7), (1, "a b c d e f", 7), (2, "g h i j k l", 8)], "doc_id long, text string, _row_hash long")
    got = jaccard_join.one_of_each(rows)
    assert got.columns == rows.columns and sorted(tuple(r) for r in got.collect()) == [(1, "a b c d e f", 7), (2, "g h i j k l", 8)]


def _check_components(spark, rows):
    got = jaccard_join.similar_components(documents(spark, rows)).collect()
    want = brute.jaccard_components(rows)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted((k, *want[k]) for k, _ in rows)


def test_components_equal_brute_force(spark, odd_rows):
    _check_components(spark, [(k, t) for k, t in odd_rows if k is not None] + [(1000 + k, t) for k, t in _rows(spark)])


@pytest.mark.parametrize("seed", [1, 2])
def test_components_across_blocks(spark, monkeypatch, seed):
    """Chains and groups of near copies that fill many blocks: no link is lost between blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 4)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 3)
    rng = random.Random(seed)
    rows = []
    for g in range(6):
        text = [f"g{g}x{i}" for i in range(rng.choice([12, 40, 90]))]
        for _ in range(40):  # a drifting chain: neighbours are similar, ends need not be
            text = list(text)
            for _ in range(rng.choice([0, 1, 1, 2])):
                text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    rng.shuffle(rows)
    _check_components(spark, rows)


@pytest.mark.parametrize("list_sets", [None, 2])
def test_sets_that_share_tokens_by_chance_are_not_compared(spark, monkeypatch, list_sets):
    """Unlike texts with one passage in common fill few verification blocks, unless a list is too long to test."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 4)
    if list_sets:
        monkeypatch.setattr(jaccard_join, "LIST_SETS", list_sets)
    passage = [f"p{i}" for i in range(30)]
    rows = [(i, " ".join([*passage, *(f"t{i}x{j}" for j in range(6))])) for i in range(120)]
    rows += [(1000 + i, f"{t} end") for i, t in rows[:3]]
    rows += [(2000 + i, t) for i, t in rows[:3]]
    compared, verify = [], jaccard_join._verify

    def counted(sets, keys):
        compared.append(sets.count())
        return verify(sets, keys)

    monkeypatch.setattr(jaccard_join, "_verify", counted)
    _check_components(spark, rows)
    assert sum(compared) > 120 if list_sets else sum(compared) < 60


def test_similar_sets_pass_the_sketches():
    """Whatever their sizes, similar sets of one group are linked; sets of other groups are not."""
    rng = np.random.default_rng(9)
    sets, group, similar = [], [], []
    for g in range(400):
        n = int(rng.choice([1, 4, 5, 60, 250, 256, 270, 500, 520, 1020, 2040, 2100, 4000]))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.concatenate([a[int(len(a) * rng.random() * 0.25) :], rng.integers(0, 2**63, int(n * rng.random() * 0.2)).astype(np.uint64)])
        pair = sorted([a, np.unique(b)], key=len)
        common = len(np.intersect1d(*pair))
        similar.append(100 * common >= 80 * (len(pair[0]) + len(pair[1]) - common))
        sets += pair
        group += [g, g]
    to = jaccard_join.near_pairs(np.array(group), np.array([len(s) for s in sets]), [jaccard_join.sketch(s) for s in sets])
    assert (to[::2] == np.arange(0, 800, 2)).all()
    assert all(to[2 * g + 1] == 2 * g for g in range(400) if similar[g]) and 100 < sum(similar) < 300
    unlike = [jaccard_join.sketch(rng.integers(0, 2**63, 300).astype(np.uint64)) for _ in range(50)]
    assert (jaccard_join.near_pairs(np.zeros(50), np.full(50, 300), unlike) == np.arange(50)).all()
    assert (jaccard_join.near_pairs(np.zeros(50), np.full(50, 300), unlike[:1] * 50) == 0).all()


def test_components_of_nulls_and_empty_tables(spark):
    assert jaccard_join.similar_components(documents(spark, [])).count() == 0
    got = jaccard_join.similar_components(documents(spark, [(None, "a b c d e f"), (None, None), (3, None)])).collect()
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == [("3", 0, "3"), ("None", 0, "None"), ("None", 2, "None")]


def test_rows_without_ids_are_compared(spark):
    """Near copies without an id join the others' component, and links that pass through them hold."""
    words = [f"w{i}" for i in range(80)]
    changed = [range(0), range(6), (*range(6), *range(74, 80))]
    chain = [" ".join(f"v{i}" if i in own else w for i, w in enumerate(words)) for own in changed]
    assert brute.jaccard_components(list(enumerate(chain))) == {0: (76, 0), 1: (76, 0), 2: (76, 0)}
    assert brute.jaccard_components([(0, chain[0]), (2, chain[2])])[2][1] == 2  # linked through the middle one alone
    rows = [(5, chain[0]), (None, chain[1]), (9, chain[2]), (None, chain[1]), (7, "a b c d e f"), (7, chain[2])]
    got = jaccard_join.similar_components(documents(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in got) == [("5", 5), ("7", 5), ("7", 7), ("9", 5), ("None", 5), ("None", 5)]


def test_prefix_filters_hold_for_every_similar_pair():
    """Under each of the orders, two similar sets share a token of their prefixes."""
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.08], rng.integers(0, 2**63, int(rng.integers(0, 4))).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        linked = len(b) > 0 and 100 * common >= 80 * (len(a) + len(b) - common)
        assert jaccard_join.similar(a, b) == linked if len(b) else True


# ---------------------------------------------------------------------------------------- packing
def test_pieces_give_back_every_text(spark, odd_rows):
    from tokenizers import Tokenizer

    rows = [(k, t) for k, t in odd_rows if k not in (None, 6, 7)] + [(1000 + k, t) for k, t in _rows(spark)]
    path, ranks = tokenizer_paths()
    out = packing.pack_documents(documents(spark, rows), path, ranks, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(path)
    pieces: dict = {}
    for r in out:
        assert len(r.ids) == r.length and zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids)) == r.ids_crc32
        pieces.setdefault(r.doc_id, []).append(r)
    for k, t in rows:
        own = sorted(pieces[k], key=lambda r: r.start)
        ids = [i for r in own for i in r.ids]
        assert ids == [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        assert all(r.doc_tokens == len(ids) for r in own)
        assert [r.start for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
    _check_sequences(out)


def _check_sequences(out):
    sequences: dict = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
        assert sum(n for _, n in parts) <= packing.WINDOW
    return sequences


def test_little_padding(spark):
    out = packing.pack_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), *tokenizer_paths()).collect()
    sequences = _check_sequences(out)
    used = [sum(n for _, n in p) for p in sequences.values()]
    padded = sum(1024 - n for n in used if n & (n - 1))
    assert padded < 0.01 * sum(used)


def test_packing_of_repeated_rows_and_empty_tables(spark):
    path, ranks = tokenizer_paths()
    assert packing.pack_documents(documents(spark, []), path, ranks).count() == 0
    out = packing.pack_documents(documents(spark, [(6, "one"), (6, "one"), (None, None), (None, None)]), path, ranks).collect()
    assert len(out) == 4
    _check_sequences(out)


def test_plan_uses_up_every_length():
    rng = np.random.default_rng(3)
    for histogram in (np.zeros(1024, int), rng.integers(0, 50, 1024), np.bincount([700] * 1000, minlength=1024)):
        histogram[0] = 0
        used = np.zeros(1024, int)
        for parts, count in packing.packing_plan(histogram):
            assert sum(parts) <= 1024
            for p in parts:
                used[p] += count
        assert (used == histogram).all()


def test_rank_and_tokenizer_files_agree(spark):
    path, ranks = tokenizer_paths()
    a, b = packing.TokenBytes(path), packing.TokenBytes(path, ranks)
    texts = [t for _, t in _rows(spark)] + ["", " ", "a  b\t\tc\n\n d ", "\x1c x\x85y  z", "it's we'll I'D", "中文🙂 é"]
    assert all(a(t) == b(t) for t in texts)


def test_added_tokens_get_their_own_ids(spark):
    """A text with the tokenizer file's added token has the ids that its library gives by default, by both ways."""
    from tokenizers import Tokenizer

    path, ranks = tokenizer_paths()
    tokenizer = Tokenizer.from_file(path)
    texts = ["abc <|endoftext|> def", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "a<|endoftext|>\n\nb  <|endoftext|>  c", "<|endoftext| >"]
    for paths in ((path,), (path, ranks)):
        out = packing.pack_documents(documents(spark, list(enumerate(texts))), *paths, with_ids=True).collect()
        want = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
        assert {r.doc_id: r.ids for r in out} == want and {r.doc_id: r.doc_tokens for r in out} == {i: len(v) for i, v in want.items()}
    assert want[0] == [39305, 220, 50256, 825, 0]


def test_hot_length_is_spread_over_buckets(spark, monkeypatch):
    """A length that most pieces share gets gapless ranks from many buckets."""
    monkeypatch.setattr(packing, "BUCKET_ROWS", 10)
    rows = spark.range(500).select(
        F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("start"), F.when(F.col("id") % 5 > 0, 300).otherwise(F.col("id") + 1).cast("long").alias("length"),
        F.lit(1).cast("long").alias("ids_crc32"), F.lit(300).cast("long").alias("doc_tokens"),
    )
    _check_sequences(packing.pack(rows).collect())


@pytest.mark.parametrize("entries", [brown_lm.CACHE_ENTRIES, 30])
def test_brown_lm_counts_words_by_their_places(spark, monkeypatch, entries):
    """Each different word is looked at once in a step, and starting a cache anew loses no count."""
    monkeypatch.setattr(brown_lm, "CACHE_ENTRIES", entries)
    met = brown_lm.WordPlaces()
    assert [met.places([b"b", b"a", b"b"])[0].tolist(), met.places([b"c", b"a"])[0].tolist()] == [[0, 1, 0], [2, 1]]
    assert met.ids.tolist() == [brown_lm.word_id(w) for w in (b"b", b"a", b"c")]
    rows = [(i, f"W{i % 50} and w{i % 70} and x{i}") for i in range(1_200)] + [(None, None), (None, "and and")]
    got = {np.uint64(r.w % (1 << 64)): (r.c, r.a) for r in brown_lm.word_counts(documents(spark, rows).coalesce(1), "doc_id", "text").collect()}
    each = {True: Counter(), False: Counter()}
    for k, t in rows:
        train = k is None or zlib.crc32(str(k).encode()) % 7 != 2
        each[train].update([brown_lm.word_id(w.encode()) for w in (t or "").lower().split()] + [brown_lm.END])
    total = each[True] + each[False]
    assert got == {np.uint64(w): (each[True][w], n) for w, n in total.items()}
