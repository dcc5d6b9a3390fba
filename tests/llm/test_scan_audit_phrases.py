"""Licence scan, filter audit and collocations against plain versions."""

from __future__ import annotations

import itertools
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from tests.llm.brute import lower
from tests.llm.conftest import SF, documents
from tripyard.llm import collocations, filter_audit, license_index
from tripyard.llm.common import hashed_bitmap, is_set, places, table
from tripyard.llm.oracle import ORACLE

EMPTY = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"


def with_sql(name: str, tables: dict) -> list[tuple]:
    """The rows of a query's SQL over pandas tables, columns by name."""
    con = duckdb.connect()
    for key, frame in tables.items():
        con.register(key, frame)
    result = con.execute(ORACLE[name])
    order = sorted(range(len(result.description)), key=lambda i: result.description[i][0])
    return sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr)


def rows_by_name(df) -> list[tuple]:
    columns = sorted(df.columns)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# ------------------------------------------------------------------------------------- licence scan
def license_places(words: list[str], t: license_index.Template) -> list[int]:
    def at(p: int, phrase) -> bool:
        return p >= 0 and tuple(words[p : p + len(phrase)]) == tuple(phrase)

    (lead_at, lead), *rest = t.keys
    return [
        p
        for p in range(-lead_at, len(words))
        if at(p + lead_at, lead) and all(any(at(p + k + d, phrase) for d in range(-t.slack, t.slack + 1)) for k, phrase in rest)
    ]


def license_row(text: str | None) -> tuple:
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    base, labels, starts, score = set(), set(), [], 0.0
    for t in license_index.templates():
        found = license_places(words, t)
        if not found:
            continue
        labels.add(t.label)
        standing = max(sum(0 <= p + i < len(words) and words[p + i] == w for i, w in enumerate(t.words)) for p in found)
        score = max(score, standing / len(t.words))
        if t.base:
            base.add(t.label)
            starts += found
    ends = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(starts), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), score


LICENSES = [
    "Released under the MIT License. And the mit-license; MIT LICENSE mit license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files",
    "permission is hereby granted free of charge by me to any person obtaining a copy",  # two words more
    "permission is hereby granted free of charge by me and you too to any person obtaining a copy",  # too far
    "to any person obtaining a copy permission is hereby granted free of charge",  # wrong order
    "GNU General Public License, version 3. GNU General Public License: either version 2",
    "licensed under CC BY-NC 4.0 and CC BY-SA 4.0, licensed under cc by sa 4 0",
    "apache license apache apache license license general public general public license",
    "mit lıcense mıt license ＭＩＴ license mit license",  # dotless i, wide letters
    "license mit", "mit", "public license", "version 3 gnu general public license",
]


def test_license_scan_against_plain_search(spark, odd_rows):
    rows = [*odd_rows, *((100 + i, t) for i, t in enumerate(LICENSES)), (200, "mit license " * 3_000), (None, LICENSES[0]), (100, LICENSES[0])]
    got = license_index.scan(documents(spark, rows))
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((k, *license_row(t)) for k, t in rows), key=repr)


def test_license_labels(spark):
    got = {r["doc_id"]: r for r in license_index.scan(documents(spark, list(enumerate(LICENSES)))).collect()}
    assert (got[0]["n_base"], got[0]["first_word"], got[0]["last_word"], got[0]["labels"]) == (4, 3, 11, "mit")
    assert got[1]["labels"] == "mit" and got[1]["base_labels"] == "" and got[1]["score"] == 1.0
    assert got[2]["labels"] == "mit" and 0 < got[2]["score"] < 1
    assert got[3]["labels"] == got[4]["labels"] == "" and got[3]["score"] == 0.0 and got[3]["first_word"] is None
    assert got[5]["labels"] == "gpl,gpl-2.0,gpl-3.0"
    assert got[6]["labels"] == "cc-by-nc-4.0,cc-by-sa-4.0"
    assert got[7]["base_labels"] == "apache,gpl" and got[7]["n_base"] == 3


@pytest.mark.parametrize("counts", [{}, {"license": 9, "mit": 1, "public": 3}, {"license": 0, "mit": 7, "the": 99}])
def test_license_places_do_not_depend_on_the_counts(spark, monkeypatch, counts):
    """Which words are rare only decides what is looked up."""
    monkeypatch.setattr(license_index, "document_counts", lambda *_: counts)
    rows = list(enumerate(LICENSES))
    got = license_index.scan(documents(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted((k, *license_row(t)) for k, t in rows)


def test_rare_words_are_of_the_first_key_phrase_and_of_the_others():
    t = license_index.parse("x", "one |two three| four |five six|")
    assert t.words == ("one", "two", "three", "four", "five", "six") and t.keys == ((1, ("two", "three")), (4, ("five", "six")))
    assert license_index.rare_words(t, {"two": 5, "three": 4, "five": 3, "six": 9}) == [("three", 2), ("five", 4)]
    assert license_index.rare_words(t, {"two": 1, "three": 2, "five": 3, "six": 9}) == [("two", 1), ("three", 2)]


def test_license_scan_without_rows_and_in_sql(spark):
    assert license_index.scan(spark.createDataFrame([], EMPTY)).count() == 0
    docs = table(spark, SF, "documents")
    assert rows_by_name(license_index.scan(docs)) == with_sql("op11_license_scan", {"documents": docs.toPandas()})


def test_license_scan_stays_in_the_jvm(spark):
    plan = license_index.scan(table(spark, SF, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange|ExistingRDD", plan)


# ------------------------------------------------------------------------------------- filter audit
def plain_audit(rows: list[tuple], labels: list[tuple]) -> list[tuple]:
    """Apply the filters one after another to the rows themselves."""
    first: dict[str, int] = {}
    for k, t, _ in rows:
        if k is not None:
            first[t or ""] = min(k, first.get(t or "", k))

    def fails(k, t) -> set[str]:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        out = {"A"} if len(words) < 100 else set()
        out |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
        out |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t) else set()
        out |= {"D"} if re.search("[#$%&*|]", t) else set()
        return out | ({"E"} if k is not None and first[t] < k else set())

    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, x in labels if x == 1 and k is not None}
    out = []
    for part in sorted({p or "" for *_, p in rows}):
        own = [(k, fails(k, t or "")) for k, t, p in rows if (p or "") == part]
        block, total = [], Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                here = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                total[f] += len(here)
                block.append((
                    f, part, "".join(order), step, len(left), len(here), sum(f in x[1] for x in own) - len(here),
                    sum(x[1] == {f} for x in own), sum(x[0] in good for x in here), sum(x[0] in toxic for x in here),
                ))
        out += [(*r[1:], total[r[0]]) for r in block]
    return out


def audit_rows() -> list[tuple]:
    long_text = " ".join(f"word{i}" for i in range(120))
    return [
        (1, long_text, "en"), (2, long_text, "en"), (2, long_text, "en"), (3, long_text, "de"), (None, long_text, "en"), (None, None, None),
        (4, None, ""), (5, "", None), (6, " \t\n", "en"), (7, long_text.upper(), "en"), (8, long_text + " #", "en"), (9, "a b " * 200, "de"),
        (10, "A" * 10 + "b" * 90, "x"), (11, "A" * 10 + "b" * 89, "x"), (12, "é" * 90 + "A" * 10, "x"), (13, long_text + " | A", "fr"),
        (0, "short", "fr"), (14, "short", "fr"), (15, "short $ short", "fr"), (16, long_text * 300, "de"),
    ]


def test_filter_audit_against_plain_filtering(spark):
    rows = audit_rows()
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (7, 1, 1), (8, None, 1), (None, 1, 1), (14, 1, 0), (15, 1, 0), (99, 1, 1)]
    docs = documents(spark, []).drop("text", "lang", "doc_id")
    extra = [(k, t, p, "x", 7, True) for k, t, p in rows]
    frame = spark.createDataFrame(extra, "doc_id long, text string, lang string, part string, mask int, own boolean")
    assert docs.columns  # the names that other operators use are in the shared fixture
    got = filter_audit.audit(frame, spark.createDataFrame(labels, LABELS))
    assert got.columns == [c.split()[0] for c in filter_audit.RESULT.split(", ")]
    assert sorted(map(tuple, got.collect())) == sorted(plain_audit(rows, labels))
    assert got.count() == 600 * len({p or "" for *_, p in rows})


def test_survivors_of_all_sets():
    rng = np.random.default_rng(3)
    cells = rng.integers(0, 50, (32, 3))
    got = filter_audit.survivors(cells, 5)
    for chosen in range(32):
        assert got[chosen].tolist() == sum(cells[m] for m in range(32) if not m & chosen).tolist()


def test_filter_audit_without_rows_and_in_sql(spark):
    none = spark.createDataFrame([], EMPTY)
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    assert filter_audit.audit(none, labels).count() == 0
    unlabelled = filter_audit.audit(docs, spark.createDataFrame([], LABELS))
    assert unlabelled.agg({"good_lost": "sum", "toxic_lost": "sum"}).first()[0] == 0
    want = with_sql("op12_filter_audit", {"documents": docs.toPandas(), "labels": labels.toPandas()})
    assert rows_by_name(filter_audit.audit(docs, labels)) == want


# ------------------------------------------------------------------------------------- collocations
def plain_collocations(rows: list[tuple], least: int, most: int) -> list[tuple]:
    counts: dict[str, Counter] = {}
    for text, lang in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 6):
                own.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        cand = {g: c for g, c in f.items() if len(g) > 1 and c >= least}
        inside = Counter()
        for g, c in cand.items():
            for i, j in itertools.combinations(range(len(g) + 1), 2):
                if 1 < j - i < len(g):
                    inside[g[i:j]] = max(inside[g[i:j]], c)
        scored = []
        for g, a in cand.items():
            if 100 * inside[g] >= 100 * a:
                continue
            score, k = min((1000 * a * n // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            scored.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (s, a, phrase, x, y) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, x, y, n, -s))
    return sorted(out)


def phrase_rows() -> list[tuple]:
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(30)] + ["é", "中文", "x\x01y", "a'b", "\x00", "q\x1c"]
    share = 1 / np.arange(1, len(vocabulary) + 1)
    rows = []
    for i in range(60):
        words = rng.choice(vocabulary, 80, p=share / share.sum()).tolist()
        words[10:15] = ["New", "york", "CITY", "hall", "now"]
        seps = rng.choice([" ", "\t", "  ", ". ", ", ", "\n", "\r\n", "\x0b"], 80, p=[0.7, 0.05, 0.05, 0.05, 0.05, 0.05, 0.025, 0.025])
        seps[8:16] = " "
        rows.append(("".join(w + s for w, s in zip(words, seps, strict=True)), [None, "en", "de", ""][i % 4]))
    rows += [("la " * 500, "en"), (None, "en"), ("", None), (" .,;", "fr"), ("one two", "fr"), rows[0], rows[0], ("ÀB àb Àb " * 30, "und")]
    return rows


@pytest.mark.parametrize("tight", [False, True])
def test_collocations_against_plain_counting(spark, monkeypatch, tight):
    if tight:  # containers burst, tries spill and ids start anew all the time
        for name, value in {"BURST": 3, "HELD": 40, "HELD_WORDS": 20, "KNOWN_WORDS": 12, "STEP": 300, "SPILL_ROWS": 5}.items():
            monkeypatch.setattr(collocations, name, value)
    rows = phrase_rows()
    frame = spark.createDataFrame([(t, p, "x", 1, 2, ["y"]) for t, p in rows], "text string, lang string, phrase string, n int, f int, words array<string>")
    got = collocations.collocations(frame.repartition(5), least=8, most=25)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain_collocations(rows, 8, 25)
    assert {r[0] for r in want} == {"en", "de", "", "und"} and max(len(r[2].split(" ")) for r in want) == 5
    assert sorted(map(tuple, got.collect())) == want


def test_collocations_without_rows_and_in_sql(spark):
    assert collocations.collocations(spark.createDataFrame([], EMPTY)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, "one two three", "en")], EMPTY)).count() == 0
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = rows_by_name(collocations.collocations(docs))
    assert got and got == with_sql("op13_collocations", {"documents": docs.toPandas()})


def test_trie_counts_what_was_put_in():
    rng = np.random.default_rng(1)
    trie, want, got = collocations.HatTrie(5, burst=4), Counter(), Counter()
    for _ in range(20):
        rows = rng.integers(1, 6, (40, 5)) * (np.arange(5) < rng.integers(3, 6, (40, 1)))
        trie.add(rows)
        want.update(map(tuple, rows.tolist()))
    assert trie.entries == len(want)
    assert any(isinstance(c, collocations.Node) for c in trie.root.values())
    for leave in (trie.entries // 2, 0):
        ids, n = trie.spill(leave)
        assert not {r[0] for r in ids.tolist()} & set(trie.root)  # whole subtrees
        got.update(dict(zip(map(tuple, ids.tolist()), n.tolist(), strict=True)))
        assert trie.entries <= leave
    assert got == want


def test_exact_scores_beyond_64_bits(spark):
    """The decimals that the scores are made of."""
    from pyspark.sql import functions as F

    a, n, x, y = 9_000_000_000_000, 15_000_000_000_007, 9_000_000_000_001, 9_100_000_000_003
    d = [F.lit(v).cast("decimal(19,0)") for v in (a, n, x, y)]
    got = spark.range(1).select(F.call_function("div", d[0] * d[1] * F.lit(1000).cast("decimal(4,0)"), d[2] * d[3]).alias("s")).first()["s"]
    assert got == 1000 * a * n // (x * y)


def test_bitmap_never_loses_a_value(spark):
    values = spark.range(5_000).selectExpr("id * 7919 AS v", "xxhash64(id) AS u")
    own = values.toPandas()
    for columns in (["v"], ["v", "u"]):
        bitmap = hashed_bitmap(values.select(*columns))
        arrays = [own[c].to_numpy() for c in columns]
        assert is_set(bitmap, *arrays).all()
        other = [a + 1 for a in arrays]
        assert is_set(bitmap, *other).mean() < 0.2
    assert places(1 << 13, own["v"].to_numpy()).max() < 1 << 13
    assert not hashed_bitmap(values.where("v < 0").select("v")).any()
