"""Benchmark decontamination by winnowing, in column functions only.

A text is its words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z are lowered. The fingerprint of a text keeps, of
every `window - k + 1` consecutive k-gram hashes, the smallest, so two texts that share `window` words share a
fingerprint. Benchmark and documents are joined on fingerprints; documents with a hit are then compared word for
word: each benchmark window is looked up in them, and all words of its occurrences are hits.

Items of fewer than `window` words, but not none, are one window each. Those of at least k words are found by the
plain k-gram at their start; shorter ones by their whole word sequence. Both join another key set that is only
built if the benchmark has such items.

Defined cases: null, empty and wordless texts have no words and no hits, as documents and as items; repeated rows
give a row each; items with equal windows are all reported; null doc_id and item_id are kept (a null item_id counts
as an item and is left out of the digest); an empty benchmark or corpus gives no hits or no rows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import keep, lower_ascii

#: Rows of (hash) keys up to which the benchmark's side of a join is broadcast; beyond it both sides are shuffled.
BROADCAST_ROWS = 500_000
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _BREAK, -1), "")


def _gram(hashes: Column, at: Column, k: int) -> Column:
    """Hash of the run of k words that begins at a place (from 0)."""
    return F.xxhash64(*[F.get(hashes, at + j) for j in range(k)])


def _fingerprint(hashes: Column, at: Column, window: int, k: int) -> Column:
    """The smallest k-gram hash of the window that begins at a place."""
    grams = [_gram(hashes, at + j, k) for j in range(window - k + 1)]
    return F.least(*grams) if len(grams) > 1 else grams[0]


def _places(rows: DataFrame, column: str, n: int) -> DataFrame:
    """A row for every place, `at`, where n words begin.

    Rows instead of array functions: what is computed per place is then compiled. The outer form, as the inner one
    would make the words a second time to skip empty arrays.
    """
    places = F.when(F.size(column) >= n, F.sequence(F.lit(0), F.size(column) - n))
    return rows.select("*", F.explode_outer(places).alias("at")).where("at is not null")


def small(rows: DataFrame) -> DataFrame:
    """The rows, marked for broadcast if there are few; counted first."""
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, window: int = 10, k: int = 5, id_column: str = "doc_id"
) -> DataFrame:
    """The documents' rows of `id_column` with n_words, n_hit, items (array of item_id), contaminated."""
    if not 1 <= k < window:
        raise ValueError("1 <= k < window is needed")
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    # a window: its words joined by blanks, which no word holds
    windows = keep(
        items.select(
            "item_id",
            F.explode(
                F.transform(
                    F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1))),
                    lambda i: F.slice("w", i, window),
                )
            ).alias("win"),
        )
        .groupBy(F.size("win").alias("len"), F.array_join("win", " ").alias("win"))
        .agg(F.array_sort(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit("\0")))).alias("items")),
        "windows",
    )
    lengths = sorted(r[0] for r in windows.select("len").distinct().collect())  # at most `window` numbers
    short = sorted({min(n, k) for n in lengths if n < window})
    hashed = windows.select("len", F.transform(F.split("win", " ", -1), lambda w: F.xxhash64(w)).alias("h"))
    start = F.lit(0)
    known = hashed.where(F.col("len") == window).select(_fingerprint(F.col("h"), start, window, k).alias("key"))
    for n in short:
        part = hashed.where((F.col("len") == n) if n < k else F.col("len").between(k, window - 1))
        known = known.unionByName(part.select(_gram(F.col("h"), start, n).alias("key")))
    known = small(known.distinct())

    # equal rows have equal results: a document is known by its id and the hash of its text
    name = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    named = documents.select(F.col(id_column).alias("doc_id"), name.alias("name"), "text")
    scanned = named.select(
        "doc_id", "name", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("h")
    )
    at = F.col("at")
    keys = _places(scanned, "h", window).select("doc_id", "name", _fingerprint(F.col("h"), at, window, k).alias("key"))
    for n in short:
        keys = keys.unionByName(_places(scanned, "h", n).select("doc_id", "name", _gram(F.col("h"), at, n).alias("key")))
    hit = keys.join(known, "key", "left_semi").select("doc_id", "name").distinct()
    pairs = hit.withColumnRenamed("doc_id", "hit_id").withColumnRenamed("name", "hit_name")
    texts = (
        named.join(pairs, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("name") == F.col("hit_name")), "left_semi")
        .dropDuplicates(["doc_id", "name"])
        .select("doc_id", "name", words(F.col("text")).alias("w"))
    )
    occurring = None
    for n in lengths:
        part = _places(texts, "w", n).select(
            "doc_id", "name", "at", F.lit(n).alias("len"), F.array_join(F.slice("w", at + 1, n), " ").alias("win")
        )
        occurring = part if occurring is None else occurring.unionByName(part)
    if occurring is None:  # no item has a word
        occurring = texts.select("doc_id", "name", F.lit(0).alias("at"), F.lit(0).alias("len"), F.lit("").alias("win")).where("false")
    found = occurring.join(small(windows), ["len", "win"])
    # items first as distinct sets, then one by one
    result = (
        found.groupBy("doc_id", "name", "items")
        .agg(F.collect_set(F.struct("at", "len")).alias("spans"))
        .groupBy("doc_id", "name")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        .select(
            F.col("doc_id").alias("r_id"),
            F.col("name").alias("r_name"),
            "items",
            F.size(
                F.array_distinct(
                    F.flatten(
                        F.transform(
                            F.array_distinct("spans"),
                            lambda s: F.sequence(s["at"], s["at"] + s["len"] - 1),
                        )
                    )
                )
            )
            .cast("long")
            .alias("n_hit"),
        )
    )
    return (
        named.select("doc_id", "name", F.size(words(F.col("text"))).cast("long").alias("n_words"))
        .join(result, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("name") == F.col("r_name")), "left")
        .select(
            F.col("doc_id").alias(id_column),
            "name",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )
