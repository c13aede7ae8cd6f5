import random

import numpy as np
import pytest

from letbook.llm import neardup
from letbook.llm.hashing import encode_lower, shingle_sets


def brute(rows, size, percent):
    sets = []
    for _, text in rows:
        w = encode_lower(text).split()
        sets.append({tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1 if w else 0))})
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    group = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            group[root(i)] = min(d, group.get(root(i), d))
    return sorted(
        [(d, len(sets[i]), group.get(root(i)), d is not None and d == group[root(i)]) for i, (d, _) in enumerate(rows)], key=str
    )


def run(frame, **how):
    return sorted([tuple(r) for r in neardup.near_duplicates(frame, **how).collect()], key=str)


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_given_documents(documents, size, percent):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert run(documents, size=size, percent=percent) == brute(rows, size, percent)


def test_chains_and_odd_rows(spark, odd):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    rows = []
    for i in range(60):  # a chain: each is one change further from the first
        base = list(base)
        base[rng.randrange(120)] = f"n{i}"
        rows.append((1000 - i, " ".join(base)))
    rows += [(1, "A b"), (2, "a  b"), (3, None), (4, ""), (5, " \t"), (6, "É b"), (7, "é b"), (None, "A b"), (2, "a b")]
    rows += [(None, "lonely words without id")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(frame, size=3, percent=85) == brute(rows, 3, 85)
    assert run(frame.limit(0)) == []
    assert neardup.near_duplicates(odd).count() == odd.count()


def test_signatures_estimate_similarity():
    rng = random.Random(5)
    one = [f"a{i}" for i in range(400)]
    two = one[:300] + [f"b{i}" for i in range(100)]
    rng.shuffle(one)
    values, bounds = shingle_sets([" ".join(x).encode() for x in (one, two)], 1)
    s = neardup.signatures(values, bounds, 2000)
    assert abs((s[0] == s[1]).mean() - 300 / 500) < 0.03
    small, cut = shingle_sets([b"x y z", b""], 1)
    s = neardup.signatures(small, cut, 64)
    assert np.isfinite(s[0]).all() and np.isinf(s[1]).all()
    # three shingles reach every place, each in some order of its own
    assert sorted(np.floor(s[0]).astype(int))[:3] == [0, 0, 0] or len(set(np.floor(s[0]))) > 1
