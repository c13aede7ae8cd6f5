"""Language identification by words first, then by shorter and shorter character n-grams.

A known word scores its log frequency in each language. An unseen word is looked up by its n-grams (with marks at
both ends) from the longest on: the first length of which any n-gram is known gives the mean of those n-grams' log
frequencies. A document's score per language is the sum over its words; the largest wins, on a tie the smaller name.

`score` is the winner's share after a softmax of the sums divided by the square root of the number of words.

The model is fitted on a sample of labelled rows: about `fit_rows` per language, chosen by a hash of the id, and
keeps the `max_words` and `max_grams` most frequent entries, so what is broadcast has a known bound. Everything else
reads all documents and whole texts.

Defined cases: null text and text without letters give `und` and score 0, as does any text if no labelled row exists;
a null or repeated id gives a row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Letters with the marks on them; fractions, raised figures and numbers in circles are none.
WORD = regex.compile(r"(?:\p{L}\p{M}*+)+")
#: Words whose scores are kept in a task besides the model's own.
CACHE_WORDS = 200_000
#: Added to every count.
SMOOTH = 0.5


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)] if n > 1 else list(word)


def _count(longest: int):
    """Counts of words (n = 0) and n-grams per language in each batch."""

    def run(batches):
        for batch in batches:
            words: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words[lang].update(WORD.findall((text or "").lower()))
            rows: list[tuple[str, int, str, int]] = []
            for lang, counts in words.items():
                found: Counter = Counter()
                for w, c in counts.items():
                    rows.append((lang, 0, w, c))
                    for n in range(1, longest + 1):
                        for g in grams(w, n):
                            found[n, g] += c
                rows += [(lang, n, g, c) for (n, g), c in found.items()]
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "n", "gram", "c"]
            )

    return run


@dataclass
class Model:
    """Log frequencies: a row per word of `words`, then a row per n-gram of `grams`; marks keep the two apart."""

    langs: list[str]
    longest: int
    words: list[str]
    word_logs: np.ndarray
    grams: list[str]
    gram_logs: np.ndarray


def fit(
    labelled: DataFrame,
    fit_rows: int = 2500,
    max_words: int = 150_000,
    max_grams: int = 100_000,
    longest: int = 4,
) -> Model:
    """A model from rows (doc_id, text, lang) with a language; see the module for the bounds."""
    labelled = labelled.where(F.col("lang").isNotNull())
    sizes = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], longest, [], np.empty((0, 0)), [], np.empty((0, 0)))
    rate = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, fit_rows / sizes[k]))])
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("fit")), F.lit(1_000_000)) / 1e6
    sample = labelled.where(draw < rate[F.col("lang")]).select("lang", "text")
    counts = (
        sample.mapInArrow(_count(longest), "lang string, n int, gram string, c long")
        .groupBy("n", "gram")
        .pivot("lang", langs)
        .sum("c")
    )
    total = sum((F.coalesce(F.col(f"`{k}`"), F.lit(0)) for k in langs), F.lit(0))

    def top(rows: DataFrame, most: int) -> tuple[list[str], np.ndarray, list[int]]:
        got = rows.withColumn("total", total).orderBy(F.desc("total"), "n", "gram").limit(most).toArrow()
        count = np.column_stack([got.column(k).fill_null(0).to_numpy() for k in langs]).astype(float)
        return got.column("gram").to_pylist(), count.reshape(-1, len(langs)), got.column("n").to_pylist()

    words, wc, _ = top(counts.where("n = 0"), max_words)
    pieces, gc, length = top(counts.where("n > 0"), max_grams)

    def logs(c: np.ndarray) -> np.ndarray:
        return np.log((c + SMOOTH) / (c.sum(axis=0) + SMOOTH * max(1, len(c)))).astype(np.float32)

    length, gram_logs = np.array(length, int), np.empty(gc.shape, np.float32)
    for n in range(1, longest + 1):
        gram_logs[length == n] = logs(gc[length == n])
    return Model(langs, longest, words, logs(wc), pieces, gram_logs)


class _Rows(dict):
    """Row of a growing table of log frequencies for every word asked for: the model's words, then unseen ones."""

    def __init__(self, model: Model):
        super().__init__(zip(model.words, range(len(model.words)), strict=True))
        self.longest, self.known, self.gram_logs = model.longest, len(model.words), model.gram_logs
        self.grams = dict(zip(model.grams, range(len(model.grams)), strict=True))
        self.table = np.empty((self.known + CACHE_WORDS, len(model.langs)), np.float32)
        self.table[: self.known] = model.word_logs

    def unseen(self, w: str) -> np.ndarray | float:
        for n in range(self.longest, 0, -1):
            at = [self.grams[g] for g in grams(w, n) if g in self.grams]
            if at:
                return self.gram_logs[at].mean(axis=0)
        return 0.0

    def __missing__(self, w: str) -> int:
        n = len(self)
        if n >= len(self.table):  # within one text only: a text may hold more words than are kept
            self.table = np.concatenate([self.table, np.empty_like(self.table)])
        self.table[n] = self.unseen(w)
        self[w] = n
        return n


def score_texts(
    model: Model, texts: list[str | None], rows: _Rows | None = None
) -> tuple[list[str], list[float], _Rows]:
    """Language and score of every text, and the table of words to go on with."""
    rows = _Rows(model) if rows is None else rows
    out, scores = [], []
    for text in texts:
        words = WORD.findall(text.lower()) if text and model.langs else []
        if not words:
            out.append(UNKNOWN)
            scores.append(0.0)
            continue
        if len(rows) - rows.known > CACHE_WORDS:
            rows = _Rows(model)
        at = np.fromiter(map(rows.__getitem__, words), np.int64, len(words))
        sums = rows.table[at].sum(axis=0, dtype=np.float64)
        share = np.exp((sums - sums.max()) / np.sqrt(len(words)))
        best = int(sums.argmax())
        out.append(model.langs[best])
        scores.append(float(share[best] / share.sum()))
    return out, scores, rows


def predict(documents: DataFrame, model: Model, id_column: str = "doc_id") -> DataFrame:
    """(`id_column`, lang_pred, score) for every document."""
    # plain values: what is broadcast is not sent with the code
    shared = documents.sparkSession.sparkContext.broadcast(astuple(model))

    def run(batches):
        model, rows = Model(*shared.value), None
        for batch in batches:
            langs, scores, rows = score_texts(model, batch.column("text").to_pylist(), rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    kind = documents.schema[id_column].dataType.simpleString()
    return (
        documents.select(F.col(id_column).alias("doc_id"), "text")
        .mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
        .withColumnRenamed("doc_id", id_column)
    )
