"""Document quality by a linear-chain conditional random field over lines.

Every line is described by its own shape and that of its neighbours (letters, capitals, digits, symbols, bars, word
lengths, repeated words, repeated lines, ends). The chain labels lines good or bad; forward-backward gives each line's
chance of being good, and their mean weighted by line length is the document's raw quality. A logistic curve fitted on
the same sample turns it into `score`.

The chain is fitted by gradient steps on a sample of labelled rows: about `fit_rows` of them, chosen by a hash of the
id, each with the lines of its document all labelled as the document is, documents of more than `fit_lines` lines left
out of the fit. Scores are for all documents and whole texts.

Defined cases: a null text is an empty one, which is one empty line and gets a score like any other; a document with
several label rows counts once per row; null labels are no labels; without both labels every score is 0.5; a null or
repeated id gives a row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import mix, word_hashes

OWN = 14
FEATURES = 3 * OWN + 2


def _classes() -> np.ndarray:
    """0 other, 1 small letter or byte of a longer character, 2 capital, 3 digit, 4 blank, 5 bar, 6 plain stop."""
    kind = np.zeros(256, np.uint8)
    kind[ord("a") : ord("z") + 1] = 1
    kind[128:] = 1
    kind[ord("A") : ord("Z") + 1] = 2
    kind[ord("0") : ord("9") + 1] = 3
    kind[[9, 11, 12, 13, 32]] = 4
    kind[ord("|")] = 5
    kind[[ord(c) for c in ".,;:'-"]] = 6
    return kind


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all lines of all texts: features (lines x FEATURES), byte lengths, and the texts' bounds in lines."""
    docs = [(t or "").encode().split(b"\n") for t in texts]
    count = np.array([len(d) for d in docs], np.int64)
    bounds = np.concatenate([[0], np.cumsum(count)])
    lines = [x for d in docs for x in d]
    n = len(lines)
    length = np.array([len(x) for x in lines], np.int64)
    buf = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)
    starts = np.cumsum(length + 1) - length - 1
    kind = _classes()[buf]
    share = [np.add.reduceat(kind == k, starts, dtype=np.int64) for k in (1, 2, 3, 5, 6)]
    # the line break ending each line is of class 0
    symbols = np.add.reduceat(kind == 0, starts, dtype=np.int64) - 1
    small, capital, digit, bar, stop = share
    hashes, owner, _ = word_hashes(lines)
    words = np.bincount(owner, minlength=n)
    again = np.zeros(n)
    fresh = np.zeros(n)
    whole = np.zeros(n, np.uint64)
    if len(hashes):
        same = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
        again = np.bincount(owner[1:][same], minlength=n)
        order = np.lexsort((hashes, owner))
        h, o = hashes[order], owner[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])])
        fresh = np.bincount(o[new], minlength=n)
        has = np.flatnonzero(words)
        at = np.cumsum(words) - words
        whole[has] = np.add.reduceat(mix(hashes + (np.arange(len(hashes)) - at[owner]).astype(np.uint64)), at[has])
    doc = np.repeat(np.arange(len(docs)), count)
    order = np.lexsort((whole, doc))
    w, d = whole[order], doc[order]
    twin = (w[1:] == w[:-1]) & (d[1:] == d[:-1]) & (w[1:] != 0)
    repeated = np.zeros(n)
    repeated[order[1:][twin]] = 1
    repeated[order[:-1][twin]] = 1
    size, per_word = np.maximum(length, 1), np.maximum(words, 1)
    letters = np.maximum(small + capital, 1)
    end = np.where(length > 0, buf[np.maximum(starts + length - 1, 0)], 0)
    own = np.column_stack(
        [
            np.log1p(length) / 5,
            np.log1p(words) / 4,
            np.minimum((small + capital) / per_word, 30) / 10,
            capital / letters,
            digit / size,
            symbols / size,
            np.minimum(symbols / per_word, 3),
            np.minimum(bar / per_word, 2),
            stop / size,
            again / per_word,
            fresh / per_word,
            np.isin(end, [ord("."), ord("!"), ord("?")]),
            words < 3,
            repeated,
        ]
    ).astype(np.float32)
    first, last = bounds[:-1], bounds[1:] - 1
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first], after[last] = 0, 0
    edge = np.zeros((n, 2), np.float32)
    edge[first, 0], edge[last, 1] = 1, 1
    return np.hstack([own, before, after, edge]), length, bounds


@dataclass
class Chain:
    """weights and bias of `good` against `bad` on a line; move[a, b]: log weight of label b after a."""

    weights: np.ndarray
    bias: float
    move: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    known: bool = True


def marginals(chain: Chain, x: np.ndarray, bounds: np.ndarray, expect: bool = False):
    """Each line's chance of being good; with expect, also the log normaliser and the expected moves, summed."""
    n = len(x)
    em = np.ones((n, 2))
    em[:, 1] = np.exp(np.clip(x @ chain.weights + chain.bias, -30, 30))
    step = np.exp(chain.move)
    count = np.diff(bounds)
    order = np.argsort(-count, kind="stable")
    first, count = bounds[:-1][order], count[order]
    alive = np.searchsorted(-count, -np.arange(count[0] if len(count) else 0), side="left")
    fore, back, logz = np.empty((n, 2)), np.empty((n, 2)), 0.0
    a = None
    for t, k in enumerate(alive):
        at = first[:k] + t
        a = em[at] if t == 0 else (a[:k] @ step) * em[at]
        z = a.sum(axis=1, keepdims=True)
        logz += float(np.log(z).sum()) if expect else 0
        a = a / z
        fore[at] = a
    moves = np.zeros((2, 2))
    b = np.empty((0, 2))
    for t in range(len(alive) - 1, -1, -1):
        k = alive[t]
        at = first[:k] + t
        new = np.ones((k, 2))
        if len(b):
            follow = em[at[: len(b)] + 1] * b
            new[: len(b)] = follow @ step.T
            if expect:
                joint = fore[at[: len(b)]][:, :, None] * step[None] * follow[:, None, :]
                moves += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = new / new.sum(axis=1, keepdims=True)
        back[at] = b
    both = fore * back
    good = both[:, 1] / both.sum(axis=1)
    return (good, logz, moves) if expect else good


def raw_quality(good: np.ndarray, length: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The mean of the lines' chances, each weighted by its length plus one."""
    w = length + 1.0
    return np.add.reduceat(good * w, bounds[:-1]) / np.add.reduceat(w, bounds[:-1]) if len(bounds) > 1 else np.empty(0)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def train(x: np.ndarray, length: np.ndarray, bounds: np.ndarray, labels: np.ndarray, steps: int = 80) -> Chain:
    """The chain that makes the labels of all lines likely, by Adam steps on the penalised log likelihood."""
    if len(set(labels.tolist())) < 2:
        return Chain(np.zeros(FEATURES), 0.0, np.zeros((2, 2)), known=False)
    count = np.diff(bounds)
    y = np.repeat(labels, count).astype(float)
    # every document weighs the same whatever its length would be the other choice; here a line is a line
    seen = np.zeros((2, 2))
    for label in (0, 1):
        seen[label, label] = (count[labels == label] - 1).sum()
    theta = np.zeros(FEATURES + 5)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, steps + 1):
        chain = Chain(theta[:FEATURES], theta[FEATURES], theta[FEATURES + 1 :].reshape(2, 2))
        good, _, moves = marginals(chain, x, bounds, expect=True)
        left = y - good
        grad = np.concatenate([left @ x, [left.sum()], (seen - moves).ravel()]) / len(y) - 1e-4 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.98 * v + 0.02 * grad * grad
        theta = theta + 0.15 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.98**i)) + 1e-8)
    chain = Chain(theta[:FEATURES], theta[FEATURES], theta[FEATURES + 1 :].reshape(2, 2))
    q = _logit(raw_quality(marginals(chain, x, bounds), length, bounds))
    slope, shift = 0.3, 0.0
    for _ in range(400):
        p = 1 / (1 + np.exp(-np.clip(slope * q + shift, -30, 30)))
        slope = max(0.05, slope + 0.05 * float(((labels - p) * q).mean()))
        shift += 0.2 * float((labels - p).mean())
    chain.slope, chain.shift = slope, shift
    return chain


def _describe(batches):
    for batch in batches:
        x, length, bounds = line_features(batch.column("text").to_pylist())
        cut = list(zip(bounds[:-1], bounds[1:], strict=True))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("quality"),
                pa.array([x[a:b].tobytes() for a, b in cut], pa.binary()),
                pa.array([length[a:b].tobytes() for a, b in cut], pa.binary()),
            ],
            ["quality", "x", "length"],
        )


def fit(
    documents: DataFrame, labels: DataFrame, fit_rows: int = 4000, fit_lines: int = 2000, steps: int = 80
) -> Chain:
    """A chain from labels (doc_id, quality) on documents (doc_id, text); see the module for the bounds."""
    named = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col("quality").cast("int").alias("quality")
    )
    rate = min(1.0, fit_rows / max(1, named.count()))
    chosen = named.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fit")), F.lit(1_000_000)) < int(rate * 1e6))
    text = F.coalesce("text", F.lit(""))
    rows = (
        documents.select("doc_id", text.alias("text"))
        .where(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) < fit_lines)
        .join(chosen, "doc_id")
        .select("quality", "text")
        .mapInArrow(_describe, "quality int, x binary, length binary")
        .toArrow()
    )
    got = sorted(zip(*[rows.column(c).to_pylist() for c in ("quality", "x", "length")], strict=True))
    y = np.array([r[0] for r in got], int)
    x = np.frombuffer(b"".join(r[1] for r in got), np.float32).reshape(-1, FEATURES)
    length = np.frombuffer(b"".join(r[2] for r in got), np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(r[2]) // 8 for r in got])]).astype(np.int64)
    return train(x, length, bounds, y, steps)


def score_texts(chain: Chain, texts: list[str | None]) -> np.ndarray:
    if not chain.known or not texts:
        return np.full(len(texts), 0.5)
    x, length, bounds = line_features(texts)
    q = _logit(raw_quality(marginals(chain, x, bounds), length, bounds))
    return 1 / (1 + np.exp(-np.clip(chain.slope * q + chain.shift, -30, 30)))


def score(documents: DataFrame, chain: Chain, *keep: str, name: str = "score") -> DataFrame:
    """The documents' columns `keep` and score, under that name."""
    fields = list(keep)
    schema = documents.select(*fields).schema.add(name, "double")
    sent = fields if "text" in fields else [*fields, "text"]

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sizes, scores, begin = 0, [], 0
            for i, t in enumerate(texts):  # features of a few MB of text at once
                sizes += len(t or "")
                if sizes > 4_000_000 or i == len(texts) - 1:
                    scores.append(score_texts(chain, texts[begin : i + 1]))
                    begin, sizes = i + 1, 0
            values = np.concatenate(scores) if scores else np.empty(0)
            arrays = [batch.column(c) for c in fields]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(values, pa.float64())], [*fields, name])

    return documents.select(*sent).mapInArrow(run, schema)
