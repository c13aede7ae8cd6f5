import itertools

import numpy as np
from pyspark.sql import functions as F

from letbook.llm import quality
from letbook.llm.queries import op10_quality


def test_held_out(spark):
    folder = "/root/testdata/sf0.01"
    scored = op10_quality(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = scored.where("held_out and quality is not null").collect()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.9
    assert np.mean([g >= 0.3 for g in good]) > 0.97


def test_marginals_by_enumeration():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(9, quality.FEATURES))
    bounds = np.array([0, 4, 5, 9])
    chain = quality.Chain(rng.normal(size=quality.FEATURES) * 0.3, 0.2, rng.normal(size=(2, 2)))
    good, logz, moves = quality.marginals(chain, x, bounds, expect=True)
    want_z, want_moves = 0.0, np.zeros((2, 2))
    for a, b in itertools.pairwise(bounds):
        e = x[a:b] @ chain.weights + chain.bias
        paths = list(itertools.product((0, 1), repeat=b - a))
        weight = np.array([np.exp(sum(e[t] * p[t] for t in range(len(p))) + sum(chain.move[i, j] for i, j in itertools.pairwise(p))) for p in paths])
        want_z += np.log(weight.sum())
        for t in range(b - a):
            share = sum(w for w, p in zip(weight, paths, strict=True) if p[t]) / weight.sum()
            assert abs(share - good[a + t]) < 1e-9
        for w, p in zip(weight, paths, strict=True):
            for i, j in itertools.pairwise(p):
                want_moves[i, j] += w / weight.sum()
    assert abs(logz - want_z) < 1e-9 and np.allclose(moves, want_moves)


def test_features_do_not_depend_on_the_batch():
    texts = ["One line. Two words\n\nAAA 12 | b", None, "", "x\nx\nx x x", "é" * 50]
    x, length, bounds = quality.line_features(texts)
    for i, t in enumerate(texts):
        alone, _, _ = quality.line_features([t])
        assert np.array_equal(alone, x[bounds[i] : bounds[i + 1]])
    assert length.tolist()[:3] == [19, 0, 10]


def test_odd(spark, odd):
    labels = spark.createDataFrame([(5, 1, 0), (4, 0, 0), (None, 1, 0), (6, None, 0), (5, 1, 1), (8, 0, 0)], "doc_id long, quality int, toxic int")
    chain = quality.fit(odd.select("doc_id", "text"), labels)
    scored = quality.score(odd, chain, "doc_id")
    assert scored.count() == odd.count() and scored.where("score is null or score < 0 or score > 1").count() == 0
    assert quality.score(odd.limit(0), chain, "doc_id").count() == 0
    plain = quality.fit(odd.select("doc_id", "text"), labels.where("quality = 1"))
    assert {r["score"] for r in quality.score(odd, plain, "doc_id").collect()} == {0.5}
    kept = quality.score(odd.select("doc_id", "text", "lang"), chain, "doc_id", "text", "lang")
    assert kept.where(F.col("doc_id") == 7).first()["text"].startswith("word0")
