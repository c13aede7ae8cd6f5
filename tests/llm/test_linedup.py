import random

import pytest
from pyspark.sql import functions as F

from letbook.llm import components, linedup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def mutate(rng, text, edits):
    for _ in range(edits):
        i = rng.randrange(len(text) + 1)
        kind = rng.randrange(3)
        text = text[:i] + ("" if kind == 0 else rng.choice("abé")) + text[i + (kind != 1) :]
    return text


@pytest.mark.parametrize("most", [1, 2, 3])
def test_banded_bit_vectors(spark, most):
    rng = random.Random(most)
    rows = []
    for _ in range(300):
        a = "".join(rng.choice("abcé") for _ in range(rng.randrange(most + 1, 30)))
        b = mutate(rng, a, rng.randrange(most + 3))
        if len(b) >= most:
            rows.append((a, b))
    frame = spark.createDataFrame(rows, "a string, b string")
    got = frame.select("a", "b", linedup.edit_distance(F.col("a"), F.col("b"), most).alias("d")).collect()
    for r in got:
        assert r["d"] == min(distance(r["a"], r["b"]), most + 1), r


def brute(docs, edits, least):
    """Removed places per row, by comparing all pairs of lines."""
    places = [(d, p, line) for d, text in docs for p, line in enumerate((text or "").split("\n")) if len(line) >= least]
    lines = sorted({x[2] for x in places})
    label = {x: x for x in lines}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[:i]:
            if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                label[root(a)] = root(b)
    first = {}
    for d, p, line in places:
        key = (d is not None, d, p)
        first[root(line)] = min(key, first.get(root(line), key), key=lambda k: (k[0], k[1] or 0, k[2]))
    out = []
    for d, text in docs:
        gone = []
        for p, line in enumerate((text or "").split("\n")):
            if len(line) >= least and first[root(line)] != (d is not None, d, p):
                gone.append(p)
        out.append((d, gone))
    return sorted(out, key=str)


def run(spark, docs, edits=1, least=20):
    frame = spark.createDataFrame([(*r, 1, "c") for r in docs], "doc_id long, text string, name int, removed string")
    got = linedup.deduplicate(frame, least, edits).collect()
    for r in got:
        lines = (dict(docs)[r["doc_id"]] or "").split("\n")
        if r["removed"]:
            assert r["text"] == "\n".join(x for i, x in enumerate(lines) if i not in r["removed"])
    return sorted([(r["doc_id"], list(r["removed"] or [])) for r in got], key=str)


@pytest.mark.parametrize("edits", [1, 2])
def test_against_brute_force(spark, edits):
    rng = random.Random(7)
    base = ["".join(rng.choice("ab é") for _ in range(rng.randrange(20, 60))) for _ in range(12)]
    docs = []
    for d in range(30):
        lines = [mutate(rng, rng.choice(base), rng.choice([0, 0, 1, 1, 2, 3])) for _ in range(rng.randrange(5))]
        docs.append((d, "\n".join([*lines, "short"])))
    docs += [(50, None), (51, ""), (52, "\n\n"), (None, base[0]), (53, base[0] + "\n" + base[0])]
    assert run(spark, docs, edits) == brute(docs, edits, 20)


def test_variants_of_one_line_without_links(spark):
    """Many lines share halves with each other and are linked with few."""
    rng = random.Random(8)
    words = [f"w{i:03}" for i in range(12)]
    docs = []
    for d in range(80):
        mine = list(words)
        mine[rng.randrange(12)] = f"v{rng.randrange(400):03}"
        docs.append((d, " ".join(mine)))
    assert run(spark, docs) == brute(docs, 1, 20)


def test_odd(spark, odd):
    done = linedup.deduplicate(odd)
    assert done.columns == odd.columns and done.count() == odd.count()
    assert linedup.deduplicate(odd.limit(0)).count() == 0


def test_query(spark, sf_dir, documents):
    from letbook.llm.queries import op4_lines

    got = {r["doc_id"]: r for r in op4_lines(spark, sf_dir).collect()}
    seen = set()
    for r in documents.orderBy("doc_id").collect():
        again = 0
        for line in r["text"].split("\n"):
            again += len(line) >= 20 and line in seen
            seen.add(line)
        assert got[r["doc_id"]]["n_removed"] >= again
        assert got[r["doc_id"]]["n_lines"] == r["text"].count("\n") + 1


def test_edits_grow_with_the_length_of_lines(spark):
    rng = random.Random(9)
    steps = ((0, 1), (30, 2), (45, 3))

    def linked(a, b):
        most = next(k for low, k in reversed(steps) if min(len(a), len(b)) >= low)
        return abs(len(a) - len(b)) <= most and distance(a, b) <= most

    base = ["".join(rng.choice("abcdef é") for _ in range(n)) for n in (22, 28, 29, 30, 31, 43, 44, 45, 46, 47, 70)]
    lines = sorted({mutate(rng, b, k) for b in base for k in (0, 1, 2, 2, 3, 4)})
    lines = [x for x in lines if len(x) >= 20]
    frame = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r["first"]["doc_id"]: r["class"] for r in linedup.line_classes(frame, 20, steps).collect()}
    label = list(range(len(lines)))
    for _ in lines:
        label = [min(label[j] for j in range(len(lines)) if i == j or linked(lines[i], lines[j])) for i in range(len(lines))]
    for i in range(len(lines)):
        for j in range(i):
            assert (got[i] == got[j]) == (label[i] == label[j]), (lines[i], lines[j])


def test_two_typos_and_a_replaced_word_in_a_long_line(spark):
    words = [f"word{i * 7919 % 1000:03}" for i in range(52)]
    line = " ".join(words)
    typos = line[:50] + "#" + line[51:300] + "#" + line[301:]
    word = " ".join([*words[:20], "words", *words[21:]])
    docs = [(1, line), (2, typos), (3, word), (4, line[:200] + "######" + line[206:])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r["doc_id"] for r in linedup.removed_lines(frame).collect()} == {2, 3}


@pytest.mark.parametrize("most", [1, 3, 5])
def test_alike_ends_do_not_matter(spark, most):
    """Whether lines are near, beside their whole distance; edits at the ends, repeated letters, short and long lines."""
    rng = random.Random(most)
    rows = []
    for _ in range(250):
        a = "".join(rng.choice("aabé") for _ in range(rng.choice([2 * most + 2, 30, 200])))
        b = mutate(rng, a, rng.randrange(most + 3))
        if rng.random() < 0.3:
            b = b[rng.randrange(3) :] + a[: rng.randrange(3)]
        if len(b) >= 2 * most + 2:
            rows.append((a, b))
    frame = spark.createDataFrame(rows, "a string, b string")
    got = frame.select("a", "b", linedup.within_edits(F.col("a"), F.col("b"), most).alias("near"), linedup.core(F.col("a"), F.col("b"), most).alias("core"))
    for r in got.collect():
        assert r["near"] == (distance(r["a"], r["b"]) <= most), r
        cut = len(r["a"]) - len(r["core"]["left"])
        assert cut == len(r["b"]) - len(r["core"]["right"]) and min(map(len, r["core"])) >= 2 * most
        if r["a"] == r["b"]:
            assert len(r["core"]["left"]) == 2 * most


def test_built_in_distance_agrees_with_bit_vectors(spark):
    rng = random.Random(11)
    classes = ((0, 1), (12, 2), (30, 3))
    rows = []
    for _ in range(400):
        a = "".join(rng.choice("abé🙂") for _ in range(rng.randrange(8, 60)))
        rows.append((a, mutate(rng, a, rng.randrange(6))))
    rows = [(a, b) for a, b in rows if len(b) >= 6]
    frame = spark.createDataFrame(rows, "a string, b string")
    pair = F.col("a"), F.col("b")
    got = frame.select(*pair, linedup.few_edits(*pair, classes).alias("few"), linedup.within_edits(*pair, classes).alias("near")).collect()
    for r in got:
        n = min(len(r["a"]), len(r["b"]))
        assert r["few"] == r["near"] == (distance(r["a"], r["b"]) <= (1 if n < 12 else 2 if n < 30 else 3)), r


def test_far_members_of_one_block_are_not_listed(spark, monkeypatch):
    """Variants of a line, each with four letters put in elsewhere, share segments but are eight edits apart."""
    rng = random.Random(5)
    base = " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(60))
    lines = []
    for i in range(0, len(base), 6):
        lines.append(base[:i] + "".join(rng.choice("klmnopqrstuvwxyz") for _ in range(4)) + base[i:])
    asked = []
    plain = components.keep

    def keep(rows, label):
        out = plain(rows, label)
        if label == "asked":
            asked.append(out.count())
        return out

    monkeypatch.setattr(components, "keep", keep)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert linedup.line_classes(docs).select("class").distinct().count() == len(set(lines))
    # the last pairs asked about are those that the heads' questions left open
    assert asked[-1] == 0
