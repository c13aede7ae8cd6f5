import numpy as np
from pyspark.sql import functions as F

from letbook.llm import vectors


def brute(rows, threshold=0.95):
    dims = max(len(v) for _, v in rows if v)
    ok = [bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    x = np.zeros((len(rows), dims))
    for i, (_, v) in enumerate(rows):
        if ok[i]:
            x[i, : len(v)] = v
            x[i] /= np.abs(x[i]).max()
            x[i] /= np.linalg.norm(x[i])
    close = (x @ x.T >= threshold) & np.outer(ok, ok)
    np.fill_diagonal(close, False)
    label = list(range(len(rows)))
    for _ in range(len(rows)):
        new = [min([label[i], *(label[j] for j in np.flatnonzero(close[i]))]) for i in range(len(rows))]
        if new == label:
            break
        label = new
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[label[i]] = min(d, low.get(label[i], d))
    return sorted([(d, int(close[i].sum()), low.get(label[i])) for i, (d, _) in enumerate(rows)], key=str)


def run(frame):
    return sorted([(r[0], r[1], r[2]) for r in vectors.near_duplicates(frame).collect()], key=str)


def test_given_vectors(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assert run(frame) == brute([(r["vec_id"], list(r["embedding"])) for r in frame.collect()])


def recall(got, want):
    return sum(g[1] for g in got) / sum(w[1] for w in want)


def test_planted_groups(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    x = np.concatenate([rng.normal(size=(800, 16)), *(c + 0.08 * rng.normal(size=(30, 16)) for c in centres)])
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)] + [(5000 + i, x[900].tolist()) for i in range(50)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = run(frame), brute(rows)
    assert recall(got, want) >= 0.98
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))


def test_chunks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CHUNK", 8)
    rng = np.random.default_rng(3)
    rows = [(i, (np.ones(7) + 0.05 * rng.normal(size=7)).tolist()) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert recall(run(frame), brute(rows)) >= 0.95


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [1.0]), (4, [0.0, 0.0]), (5, None), (6, []), (7, [1.0, None]),
        (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (10, [1e-300, 0.0, 0.0]), (11, [1e300, 0.0]), (None, [0.0, 1.0]),
        (12, [0.0, 5.0, 0.0]), (2, [2.0, 0.0, 0.0]), (13, [-0.0, 1.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("name", F.lit(1)).withColumn("n", F.lit(1))
    assert run(frame) == brute(rows)
    assert run(frame.limit(0)) == []
    assert run(frame.where("vec_id = 4")) == [(4, 0, 4)]


def test_walk_is_in_order():
    rng = np.random.default_rng(4)
    d1, d2 = rng.random(9), rng.random(7)
    cells = vectors.nearest_cells(d1, d2, 63)
    assert sorted(cells) == list(range(63))
    sums = [d1[c // 7] + d2[c % 7] for c in cells]
    assert sums == sorted(sums)


def test_loose_pairs_beside_a_hot_group_and_few_rows_to_fit(spark):
    rng = np.random.default_rng(5)
    norm = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    one = norm(rng.normal(size=(3000, 64)))
    side = rng.normal(size=one.shape)
    side = norm(side - (side * one).sum(axis=1, keepdims=True) * one)
    two = 0.955 * one + np.sqrt(1 - 0.955**2) * side
    hot = norm(np.ones((1, 64)) + 0.001 * rng.normal(size=(400, 64)))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([one, two, hot]))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = dict(vectors.near_duplicates(frame, fit_rows=200).select("vec_id", "n_links").collect())
    assert sum(got[i] for i in range(3000)) >= 0.99 * 3000
    assert all(got[i] <= 399 for i in range(6000, 6400))
