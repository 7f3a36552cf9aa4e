"""Quality voting: terms and votes against plain loops, held-out accuracy."""
from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from evalpress.llm import quality_votes as qv
from tests.llm.helpers import collected, docs, words

LABELS = "doc_id long, quality int, toxic int"


def sample(rng: random.Random, good: bool) -> str:
    if good:
        return ". ".join(words(rng, rng.randrange(6, 14)).capitalize() for _ in range(rng.randrange(3, 12))) + "."
    kind = rng.randrange(3)
    some = words(rng, rng.randrange(4, 12))
    return ((some + " ") * 12 if kind == 0 else " ".join(w.upper() + "!!" for w in words(rng, 60).split()) if kind == 1
            else " | ".join(words(rng, 80).split()))


def test_terms_by_hand():
    texts = [b"", b"Ab  c!!", b"one two one two one\nx\nx\n", "ä É".encode(), b" \n "]
    p = qv.Params(slots=16)
    whole = qv.Terms(p).matrix(texts)
    for cut in (1, 2, 3, 5):  # pieces and blocks change nothing
        small = qv.Params(slots=16, piece=cut, block=2)
        assert np.allclose(np.vstack([x for _, x in qv.Terms(small).blocks(texts)]), whole)
    assert whole.shape == (5, qv.Terms(p).size)
    name = qv.CLASSES.index
    for row, t in zip(whole, texts):
        kinds = [int(qv.CLASS_OF[b]) for b in t]
        pairs = Counter(zip(kinds, kinds[1:]))
        for (a, b), n in pairs.items():
            assert math.isclose(row[a * qv.N + b], math.sqrt(n / sum(pairs.values())), rel_tol=1e-5)
    short = [k for k, prev in zip([name("upper"), name("lower"), name("blank"), name("lower"), name("call")], [None] * 5)]
    at = qv.N * qv.N + (short[0] * qv.N + short[1]) * qv.N + short[2]
    assert math.isclose(whole[1, at], math.sqrt(1 / 3), rel_tol=1e-5)


def test_votes_are_exact():
    rng = np.random.default_rng(1)
    p = qv.Params(near=5, power=2.0, rank=6)
    terms = rng.random((60, 30)).astype(np.float32)
    label = (rng.random(60) < 0.4).astype(np.int64)
    m = qv.train(terms, label, 0.4, p)
    ask = np.vstack([rng.random((17, 30)).astype(np.float32), terms[:3], np.zeros((1, 30), np.float32)])
    got = m.score(ask)
    for row, s in zip(m.latent(ask).astype(float), got):
        near = sorted(((float(v.astype(float) @ row), k) for k, v in enumerate(m.vectors)), reverse=True)[:5]
        if not row.any():
            assert s == pytest.approx(0.4)
            continue
        votes = [(max(c, 0) ** 2 * (0.4 / label.sum() if label[k] else 0.6 / (60 - label.sum())), label[k]) for c, k in near]
        assert s == pytest.approx(sum(v for v, y in votes if y) / sum(v for v, _ in votes), abs=1e-4)
    assert np.allclose(m.vectors @ m.vectors.T, m.latent(terms) @ m.latent(terms).T, atol=1e-5)


def test_basis_spans_the_leading_directions():
    rng = np.random.default_rng(2)
    x = (rng.standard_normal((80, 12)) * 2.0 ** -np.arange(12)) @ rng.standard_normal((12, 40))
    want = np.linalg.svd(x)[2][:4]
    got = qv.singular_basis(x, 4)
    assert np.allclose(np.abs(np.linalg.svd(want @ got)[1]), 1, atol=1e-6)


def test_held_out(spark):
    rng = random.Random(4)
    truth = {i: rng.random() < 0.7 for i in range(800)}
    rows = [(i, sample(rng, good)) for i, good in truth.items()]
    labels = [(i, int(g), 0) for i, g in truth.items()] + [(None, 1, 0), (5000, None, 0), (9000, 1, 0)]
    rows += [(2000, None), (2001, ""), (None, "Some text."), (2002, sample(rng, True) * 3000), (2003, "x" * 300_000)]
    rows += [(1, "Copy of a hot id. " * 3)] * 300
    got = collected(qv.quality(docs(spark, rows, clash=True), spark.createDataFrame(labels, LABELS)))
    assert len(got) == len(rows)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 120 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    same = {r["doc_id"]: round(r["score"], 6) for r in got}
    again = collected(qv.quality(docs(spark, rows).repartition(5), spark.createDataFrame(labels, LABELS)))
    assert {r["doc_id"]: round(r["score"], 6) for r in again if r["doc_id"] != 1} == {k: v for k, v in same.items() if k != 1}


def test_sample_is_bounded(spark):
    from pyspark.sql import functions as F

    from evalpress.llm.common import sampled
    d = spark.range(20_000).select((F.col("id") % 15_000).alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    known = spark.range(16_000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("_label"))
    texts, counts = sampled(d, known, 100)
    got = texts.collect()
    assert counts == {0: 13_500, 1: 1_500} and Counter(r["_label"] for r in got) == {0: 100, 1: 100}
    assert len({r["doc_id"] for r in got}) == 200


def test_without_labels(spark):
    none = spark.createDataFrame([], LABELS)
    assert [r["score"] for r in collected(qv.quality(docs(spark, [(1, "a"), (2, None)]), none))] == [0.5, 0.5]
    assert collected(qv.quality(docs(spark, []), none)) == []
    one = spark.createDataFrame([(k, 1, 0) for k in range(9)], LABELS)
    assert {r["score"] for r in collected(qv.quality(docs(spark, [(k, "some text") for k in range(9)]), one))} == {1.0}
