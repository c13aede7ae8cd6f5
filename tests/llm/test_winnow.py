import random
import re

from pyspark.sql import functions as F

from letbook.llm import winnow

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - window + 1, 1 if w else 0)):
            windows.setdefault(tuple(w[i : i + window]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= ids
        out.append((doc, len(w), len(hit), sorted("\0" if x is None else str(x) for x in found)))
    return sorted(out, key=str)


def run(spark, docs, items, **more):
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, name int")
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, key int")
    got = winnow.decontaminate(d, b, **more).collect()
    return sorted([(r["doc_id"], r["n_words"], r["n_hit"], list(r["items"])) for r in got], key=str)


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocab = ["a", "b", "C", "é", "É", "K", "x9"]
    text = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", "-", "\n", "!? "]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 4, 5, 7, 9, 10, 11, 14]))) for i in range(12)] + [(90, None), (None, "q r s t u v w x y z")]
    items.append((91, items[5][1]))
    docs = [(i, text(rng.randrange(0, 60))) for i in range(40)]
    docs += [(100 + i, text(5) + (t or "") + " " + text(5)) for i, (_, t) in enumerate(items)]
    docs += [(200, None), (201, ""), (202, "!!"), (None, "q r s t u v w x y z")] + [docs[3]] * 2
    assert run(spark, docs, items) == brute(docs, items)


def test_long_items_only_and_empty_tables(spark):
    rng = random.Random(6)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(i, text(25)) for i in range(6)]
    docs = [(i, text(300)) for i in range(10)] + [(50, items[2][1])]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], items) == []
    assert run(spark, docs, items, window=4, k=2) == brute(docs, items, 4)


def test_shuffled_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr(winnow, "BROADCAST_ROWS", 0)
    items = [(1, "one two three four five six seven eight nine ten eleven")]
    docs = [(1, "zero One two three four five six seven eight nine ten, twelve"), (2, "nothing here")]
    assert run(spark, docs, items) == brute(docs, items)


def test_every_odd_document(spark, odd):
    items = spark.createDataFrame([(1, "a text without an id, of several words in a line")], "item_id long, text string")
    got = winnow.decontaminate(odd, items)
    assert got.count() == odd.count()
    assert got.where("contaminated").count() == 3
    assert got.where(F.col("doc_id") == 7).first()["n_words"] == 60_000
