import random
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from letbook.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(pieces, texts, size=1024):
    """Each id in exactly one piece; sequences gapless, full or a power of two."""
    tokenizer = Tokenizer.from_file(PATH)
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append(p)
    assert set(docs) == set(texts)
    for d, parts in docs.items():
        parts.sort(key=lambda p: p["start"])
        want = [*tokenizer.encode(texts[d] or "", add_special_tokens=False).ids, 0]
        at = 0
        for p in parts:
            assert p["start"] == at and p["doc_tokens"] == len(want)
            ids = np.frombuffer(bytes(p["ids"]), "<u4").tolist()
            assert ids == want[at : at + p["length"]] and ids
            at += p["length"]
        assert at == len(want)
    for parts in sequences.values():
        parts.sort(key=lambda p: p["offset"])
        at = 0
        for p in parts:
            assert p["offset"] == at
            at += p["length"]
        assert at == size or (at < size and at & (at - 1) == 0)


def test_given_documents(documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    check(packing.pack(documents, PATH).collect(), texts)


def test_hostile_texts(spark):
    rng = random.Random(1)
    bits = [" ", "  ", "\n", "\t", "a", "Word", "it's", "'s", "12", "é", "水", "🙂", "<|endoftext|>", " ", " ", "!?", "\x1c", "\x85", " x"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randrange(12)))) for i in range(1500)] + [(2000, None), (2001, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    check(packing.pack(frame, PATH).collect(), dict(rows))
    check(packing.pack(frame, PATH, size=64).collect(), dict(rows), 64)


def test_cost_is_balanced():
    rng = random.Random(2)
    lengths = [rng.randrange(1, 900) for _ in range(2000)]
    cost, used = defaultdict(float), defaultdict(int)
    pieces, left = packing.assign(lengths, 1024, 1.0, 1 / 1024)
    assert not left
    for _, _, n, s, _ in pieces:
        cost[s] += n + n * n / 1024
        used[s] += n
    full = [cost[s] for s in used if used[s] == 1024]
    assert sum(used.values()) == sum(lengths)
    assert np.std(full) / np.mean(full) < 0.15
    assert packing.capacities(1024 * 3 + 600, 1024) == [1024] * 3 + [512, 64, 16, 8]


def test_odd(odd):
    pieces = packing.pack(odd, PATH)
    assert pieces.where("start = 0").count() == odd.count()
    assert packing.pack(odd.limit(0), PATH).count() == 0


def test_the_cheapest_sequence_with_room():
    """Each choice beside a search through all sequences."""
    rng = random.Random(3)
    lengths = [rng.randrange(1, 64) for _ in range(400)]
    total = sum(lengths)
    room = packing.capacities(total, 64)
    pieces, left = packing.place([(n, i, 0) for i, n in enumerate(lengths)], room, 64, 1.0, 1 / 8)
    assert not left and sum(p[2] for p in pieces) == total
    free, cost = list(room), [0.0] * len(room)
    for i, start, n, s, offset in pieces:
        wanted = lengths[i] - start
        fit = [(cost[k], k) for k in range(len(room)) if free[k] >= wanted]
        assert offset == room[s] - free[s]
        assert (n == wanted and (cost[s], s) == min(fit)) if fit else free[s] == n == max(free)
        free[s] -= n
        cost[s] += n + n * n / 8


def test_short_sequences_do_not_grow_with_partitions(documents):
    few, many = (
        packing.pack(documents.repartition(n), PATH).groupBy("sequence_id").agg({"length": "sum"}).collect() for n in (1, 40)
    )
    short = [sum(r["sum(length)"] < 1024 for r in rows) for rows in (few, many)]
    assert short[0] <= 10 and short[1] <= 10 and abs(len(few) - len(many)) <= 10
