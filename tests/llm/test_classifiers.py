"""Toxicity and quality: held-out accuracy, the estimators' own properties, odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import documents
from tripyard.llm import quality_fm, toxicity

SF = "/root/testdata/sf0.1"


def _auc(score: np.ndarray, label: np.ndarray) -> float:
    order = np.argsort(score, kind="stable")
    ranks = np.empty(len(score))
    ranks[order] = np.arange(1, len(score) + 1)
    for v in np.unique(score):  # ties share their mean rank
        ranks[score == v] = ranks[score == v].mean()
    n = label.sum()
    return (ranks[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def _held_out(rows, labels, column):
    known = {r.doc_id: r[column] for r in labels.collect()}
    got = [(r.score, r.predicted, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    return (np.array([g[i] for g in got]) for i in range(3))


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    rows = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    score, predicted, label = _held_out(rows, labels, "toxic")
    assert _auc(score, label) > 0.95
    assert predicted[label == 1].mean() > 0.8 and predicted[label == 0].mean() < 0.01


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    rows = quality_fm.score(docs, quality_fm.train(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    score, predicted, label = _held_out(rows, labels, "quality")
    assert _auc(score, label) > 0.98
    assert predicted[label == 1].mean() > 0.99 and predicted[label == 0].mean() < 0.1


def test_labels_of_the_held_out_fold_are_not_learnt(spark, tables):
    """Turning every held-out label round changes no score."""
    docs, labels = tables
    from pyspark.sql import functions as F

    small = docs.where("doc_id < 1500")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    turned = labels.select("doc_id", *(F.when(fold == 0, 1 - F.col(c)).otherwise(F.col(c)).cast("int").alias(c) for c in ("quality", "toxic")))
    for module in (toxicity, quality_fm):
        a, b = (module.score(small, module.train(small, t)).collect() for t in (labels, turned))
        assert sorted(map(str, a)) == sorted(map(str, b))


def test_odd_rows_and_empty_tables(spark, odd_rows):
    docs = documents(spark, odd_rows)
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (7, None, None), (None, 1, 1), (8, 1, 1), (10, 0, 1)], "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for module in (toxicity, quality_fm):
        for known in (labels, none):
            model = module.train(docs, known)
            assert module.score(docs, model).count() == len(odd_rows)
            assert module.score(documents(spark, []), model).count() == 0
        module.train(documents(spark, []), labels)
    assert {r.score for r in quality_fm.score(docs, None).collect()} == {0.5}
    assert {r.predicted for r in toxicity.score(docs, toxicity.train(docs, none)).collect()} == {0}
    assert toxicity.clean(docs, toxicity.Model()).count() == len(odd_rows)


def test_long_text_is_scored_to_its_end():
    model = toxicity.Model(-5.0, {"villain": 10.0})
    assert model.score("calm " * 200_000 + "villain") > 0.5 > model.score("calm " * 200_000)


def test_nnpu_separates_hidden_positives():
    """U holds unmarked positives: they are found all the same, and negatives are left alone."""
    rng = np.random.default_rng(0)
    words = [f"{a}{b}{c}" for a in "klmnp" for b in "aeiou" for c in "rstvwxyz"]

    def text(bad: bool) -> list[str]:
        own = set(rng.choice(words, 20).tolist())
        return sorted(own | (set(rng.choice(["badly", "worse", "vile", "nasty"], 2).tolist()) if bad else set()))

    truth = [True] * 300 + [True] * 150 + [False] * 1350
    lists = [text(t) for t in truth]
    model = toxicity.fit(pa.array(lists), np.array([True] * 300 + [False] * 1500), np.arange(1800), 0.1)
    found = [model.score(" ".join(x)) > 0.5 for x in lists]
    assert np.mean(np.array(found) == np.array(truth)) > 0.99


def test_factorisation_identity():
    """The linear-time logit equals the sum over all pairs."""
    rng = np.random.default_rng(4)
    model = quality_fm.Machine(0.3, rng.normal(size=quality_fm.SIZE), rng.normal(size=(quality_fm.SIZE, 3)))
    cols, x = rng.choice(quality_fm.SIZE, 12, replace=False), rng.normal(size=12)
    pairs = sum(model.v[cols[i]] @ model.v[cols[j]] * x[i] * x[j] for i in range(12) for j in range(i + 1, 12))
    assert np.isclose(model.logits(cols, x, np.array([0]))[0], 0.3 + model.w[cols] @ x + pairs)
