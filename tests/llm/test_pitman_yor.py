import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from letbook.llm import pitman_yor
from letbook.llm.hashing import encode_lower


def base(rows):
    """(n_tokens, n_known, N, base score) by document, straight from the definition."""
    tokens = [(d, [*encode_lower(t).split(), None]) for d, t in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in tokens]
    counts = Counter(w for (_, ws), h in zip(tokens, held, strict=True) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    return sorted(
        (d, h, len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        for (d, ws), h in zip(tokens, held, strict=True)
    )


def test_base_and_improvement(spark, sf_dir, documents):
    from letbook.llm.queries import op6_pitman_yor

    got = sorted(tuple(r) for r in op6_pitman_yor(spark, sf_dir).collect())
    want = base([(r["doc_id"], r["text"]) for r in documents.collect()])
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5]
        assert abs(g[5] - w[5]) < 1e-6 * abs(w[5])
    held = [g for g in got if g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held)


def test_scores_are_probabilities(spark):
    """Texts of no or one word share less than all of the mass; seen endings beat unseen ones."""
    train = ["a b", "a c", "a a b", "d", "c c c c c b"] * 20
    words = ["a", "b", "c", "d", "unseen"]
    rows = [(i, t, True) for i, t in enumerate(train)] + [(1000 + i, w, False) for i, w in enumerate(words)]
    rows += [(2000, "", False)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, t boolean")
    got = {r["doc_id"]: r for r in pitman_yor.score(frame, F.col("t")).collect()}
    assert got[2000]["n_tokens"] == 1 and got[2000]["n_known"] == 1
    assert got[1004]["n_known"] == 1
    total = sum(10 ** got[1000 + i]["score"] for i in range(4))
    assert total + 10 ** got[2000]["score"] < 1
    # "d" is always a whole text, "a" never ends one, and a word never seen is the least likely
    assert got[1003]["score"] > got[1000]["score"] > got[1004]["score"]


def test_seating():
    rng = np.random.default_rng(1)
    logs = pitman_yor.stirling(0.5)
    # three customers, by hand: S(3,1)=(1-d)(2-d), S(3,2)=3(1-d), S(3,3)=1
    assert np.allclose(np.exp(logs[3, 1:4]), [0.75, 1.5, 1.0])
    c, b = np.full(20_000, 3), np.full(20_000, 0.5)
    t = pitman_yor.draw_tables(c, b, 0.5, logs, rng)
    weights = np.array([0.75, 1.5, 1.0]) * 0.5 ** np.arange(1, 4)
    assert np.allclose(np.bincount(t, minlength=4)[1:] / len(t), weights / weights.sum(), atol=0.02)
    many = pitman_yor.draw_tables(np.array([1, 64, 65, 10**9]), np.full(4, 1e-3), 0.8, pitman_yor.stirling(0.8), rng)
    assert many[0] == 1 and (many >= 1).all() and many[3] < 10**9


def test_mass_of_a_restaurant():
    """The predictive chances of all words in a context sum to one."""
    prior = pitman_yor.Prior()
    word, context = np.array([0, 0, 1, 2, 2]), np.array([0, 5, 5, 0, 5])
    c = np.array([4, 70, 2, 1, 9])
    for t, customers, tables in pitman_yor.seat(word, context, c, 3, 1, prior, 0):
        top = np.full(4, (prior.parent_strength + prior.parent_discount * tables.sum()) / 4)
        top[:3] += customers - prior.parent_discount * tables
        top /= prior.parent_strength + customers.sum()
        assert abs(top.sum() - 1) < 1e-12
        for u in (0, 5, 9):
            at = context == u
            value = (prior.strength + prior.discount * t[at].sum()) * top
            value[word[at]] += c[at] - prior.discount * t[at]
            assert abs(value.sum() / (prior.strength + c[at].sum()) - 1) < 1e-12


def test_odd(odd):
    got = pitman_yor.score(odd, F.lit(True))
    assert got.count() == odd.count()
    assert got.where("isnan(score) or score > 0 or score is null").count() == 0
    assert pitman_yor.score(odd.limit(0), F.lit(True)).count() == 0
    assert pitman_yor.score(odd, F.lit(False)).agg(F.sum("train_tokens")).first()[0] == 0


def test_context_is_the_whole_word_before(spark):
    """Two words of one last byte are two restaurants."""
    train = ["cba left", "dba right"] * 50
    rows = [(i, t, True) for i, t in enumerate(train)] + [(1000, "cba left", False), (1001, "cba right", False)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, t boolean")
    got = {r["doc_id"]: r["score"] for r in pitman_yor.score(frame, F.col("t")).where("doc_id >= 1000").collect()}
    assert got[1000] > got[1001] + 0.5


def test_many_shards_and_blocks(spark, monkeypatch):
    """Counts are the same and probabilities nearly, whatever the number of shards; hot contexts are among the words."""
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{n}" for n in rng.zipf(1.4, 60) if n < 500), i % 7 != 2) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, t boolean").repartition(5, "doc_id")
    few = sorted(tuple(r) for r in pitman_yor.score(frame, F.col("t")).collect())
    monkeypatch.setattr(pitman_yor, "SHARD_CHARS", 10_000)
    many = sorted(tuple(r) for r in pitman_yor.score(frame, F.col("t")).collect())
    for a, b in zip(few, many, strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-9
        assert abs(a[6] - b[6]) < 0.05 * abs(a[6])


def test_packed_names():
    names = np.array([0, 1, 2**56 - 1, 123456789], np.uint64)
    assert (pitman_yor.unpack(pitman_yor.pack(names)) == names).all()
