"""Near-duplicate documents by SuperMinHash.

A document is its set of distinct shingles of `size` words (A-Z lowered, split at white space). Documents with equal
sets are one class from the start. Every class gets a SuperMinHash signature: each shingle draws a random permutation
of the places, step by step, and bids its step number plus a fraction for the place it reaches; a place keeps the
smallest bid. The draws of one shingle are spread over the places, which lowers the variance, and a document stops as
soon as no later step can win anywhere. Bands of the signature make candidate pairs; a bitmap of each set rules out
those that cannot reach the threshold, without any doubt; every other pair is confirmed on the full sets; links are grouped by union of connected components.

Bands are chosen so that a pair at the threshold is missed with a chance below one in a million.

Defined cases: null, empty and wordless texts have an empty set and are linked with nothing; with fewer words than
`size` the whole sequence is the one shingle; repeated rows give a row each; a null id takes part but is never the
smallest of its group (alone, or among nulls only, its component is null and it is not kept); an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components, link_blocks
from .frames import keep
from .hashing import as_long, chunks, encode_lower, mix, shingle_sets

ROWS = 4
MISS = 1e-6
#: Words of 64 bits in a set's bitmap: each bit two bitmaps differ in is an element the sets differ in.
BITMAP = 16
#: Shingles whose permutations are held at once.
ELEMENTS = 1 << 15


def band_count(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def signatures(shingles: np.ndarray, bounds: np.ndarray, places: int) -> np.ndarray:
    """SuperMinHash values, documents x places; a document without shingles has infinite ones."""
    docs = len(bounds) - 1
    values = np.full((docs, places), np.inf)
    flat = values.reshape(-1)
    owner = np.repeat(np.arange(docs), np.diff(bounds))
    for a in range(0, len(shingles), ELEMENTS):
        x, d = shingles[a : a + ELEMENTS], owner[a : a + ELEMENTS]
        perm = np.tile(np.arange(places, dtype=np.int16), (len(x), 1))
        row = np.arange(len(x))
        for j in range(places):
            bits = mix(x + np.uint64((j + 1) * 0xD1342543DE82EF95 % 2**64))
            k = j + ((bits & np.uint64(0xFFFFFF)) * np.uint64(places - j) >> np.uint64(24)).astype(np.int64)
            slot = perm[row, k].astype(np.int64)
            perm[row, k] = perm[:, j]
            np.minimum.at(flat, d * places + slot, j + (bits >> np.uint64(24)).astype(np.float64) * 2.0**-40)
            first, last = d[0], d[-1] + 1
            more = values[first:last].max(axis=1) >= j + 1
            if not more.all():
                stay = more[d - first]
                if not stay.any():
                    break
                x, d, perm = x[stay], d[stay], perm[stay]
                row = np.arange(len(x))
    return values


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = values.view(np.uint64)
    out = np.empty((len(values), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(values), b + 1, np.uint64)
        for r in range(rows):
            key = mix(key * np.uint64(0x9FB21C651E98DF25) ^ bits[:, b * rows + r])
        out[:, b] = key
    return out


def bitmaps(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64 * BITMAP bits per set, one set for each element."""
    out = np.zeros((len(bounds) - 1, BITMAP), np.uint64)
    place = mix(shingles ^ np.uint64(0x2127599BF4325C37)) % np.uint64(64 * BITMAP)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = (place >> np.uint64(6)).astype(np.int64)
    np.bitwise_or.at(out, (doc, at), np.uint64(1) << (place & np.uint64(63)))
    return out


def set_names(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit name of every set, from its elements' mixed sum and its size."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)))])
    n = np.diff(bounds).astype(np.uint64)
    return mix(sums[bounds[1:]] - sums[bounds[:-1]] + mix(n))


def _signed(size: int, bands: int):
    def run(batches):
        for batch in batches:
            raw = [encode_lower(t) for t in batch.column("text").to_pylist()]
            for a, b in chunks([len(r) for r in raw]):
                shingles, bounds = shingle_sets(raw[a:b], size)
                keys = band_keys(signatures(shingles, bounds, bands * ROWS), bands, ROWS)
                rows = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(as_long(x.reshape(-1))), x.shape[1])
                long_list = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(a, b - a) for c in ("doc_id", "text_hash", "text_hash2")),
                        pa.array(np.diff(bounds)),
                        pa.array(as_long(set_names(shingles, bounds))),
                        rows(keys).cast(long_list),
                        rows(bitmaps(shingles, bounds)).cast(long_list),
                    ],
                    ["doc_id", "text_hash", "text_hash2", "n_shingles", "name", "bands", "bits"],
                )

    return run


def _sets(size: int):
    def run(batches):
        for batch in batches:
            raw = [encode_lower(t) for t in batch.column("text").to_pylist()]
            for a, b in chunks([len(r) for r in raw]):
                shingles, bounds = shingle_sets(raw[a:b], size)
                names = as_long(set_names(shingles, bounds))
                sets = [shingles[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
                same = names == batch.column("name").slice(a, b - a).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[same]), pa.array([s for s, ok in zip(sets, same, strict=True) if ok], pa.binary())],
                    ["name", "shingles"],
                )

    return run


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            keep_ = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(p) + len(q) - len(np.unique(np.concatenate([p, q])))
                keep_.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep_, pa.bool_()))

    return run


def text_hashes(text) -> list:
    """Two hashes that together name a text, null like empty."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("text_hash"), F.xxhash64(F.lit("second"), whole).alias("text_hash2")]


def groups(documents: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, text_hash, text_hash2, n_shingles, label, component_id) for every document; label is null for empty sets."""
    bands = band_count(percent)
    kind = documents.schema[id_column].dataType.simpleString()
    texts = documents.select(F.col(id_column).alias("doc_id"), "text")
    fields = f"doc_id {kind}, text_hash long, text_hash2 long, n_shingles long, name long, bands array<long>, bits array<long>"
    signed = keep(texts.select("*", *text_hashes(F.col("text"))).mapInArrow(_signed(size, bands), fields), "signed")
    some = signed.where("n_shingles > 0")
    # one row per distinct set; equal sets have equal bands
    classes = keep(
        some.groupBy("name").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("bits").alias("bits")
        ),
        "classes",
    )
    blocks = classes.select(F.explode("bands").alias("block"), F.col("name").alias("id"), F.struct("n").alias("info"))

    def may(left, right):
        return 100 * F.least(left["n"], right["n"]) >= percent * F.greatest(left["n"], right["n"])

    def closer(left, right):
        # the sets differ in as many elements at least as their bitmaps in bits
        apart = sum(
            (F.bit_count(left[f"b{i}"].bitwiseXOR(right[f"b{i}"])) for i in range(BITMAP)), F.lit(0)
        )
        both = left["n"] + right["n"]
        return 100 * (both - apart) >= percent * (both + apart)

    # fields rather than an array keep the compiled condition small
    bits = [F.get("bits", F.lit(i)).alias(f"b{i}") for i in range(BITMAP)]
    sketches = classes.select(F.col("name").alias("id"), F.struct("n", *bits).alias("info"))

    def verify(pairs: DataFrame) -> DataFrame:
        asked = pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct()
        # a class without any id is found by its null id
        wanted = classes.join(asked, "name").select("name", F.col("doc_id").alias("wanted"))
        sets = keep(
            texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")))
            .select("name", "text")
            .mapInArrow(_sets(size), "name long, shingles binary")
            .dropDuplicates(["name"]),
            "sets",
        )
        x = sets.select(F.col("name").alias("a"), F.col("shingles").alias("x"))
        y = sets.select(F.col("name").alias("b"), F.col("shingles").alias("y"))
        return pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y").mapInArrow(_confirm(percent), "a long, b long")

    label = components(link_blocks(blocks, verify, may, (lambda _: sketches, closer), rounds=1, spread=True))
    grouped = classes.join(label, classes["name"] == label["id"], "left").select(
        "name", "doc_id", F.coalesce("label", "name").alias("label")
    )
    low = grouped.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_name = grouped.join(low, "label").select("name", "label", "component_id")
    filled = F.col("n_shingles") > 0
    return (
        signed.withColumn("name", F.when(filled, F.col("name")))
        .join(of_name, "name", "left")
        .select(
            "doc_id",
            "text_hash",
            "text_hash2",
            "n_shingles",
            "label",
            F.when(filled, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )
    )


def near_duplicates(
    documents: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id"
) -> DataFrame:
    """(`id_column`, n_shingles, component_id, kept) for every document: links have 100 * common >= percent * union."""
    return (
        groups(documents, size, percent, id_column)
        .select(F.col("doc_id").alias(id_column), "n_shingles", "component_id")
        .withColumn("kept", F.coalesce(F.col(id_column) == F.col("component_id"), F.lit(False)))
    )


def without_near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id") -> DataFrame:
    """The documents, every column, one of each group: of smallest id (null last), then by a hash of the text.

    Documents without shingles are in no group and stay. Of rows with equal id and text one stays. Other rows of an
    id that has several texts are judged by their own texts.
    """
    rows = groups(documents, size, percent, id_column)
    texts = rows.groupBy("doc_id", "text_hash", "text_hash2").agg(F.min("label").alias("label"), F.count("*").alias("copies"))
    order = [F.col("doc_id").asc_nulls_last(), "text_hash", "text_hash2"]
    first = F.row_number().over(Window.partitionBy("label").orderBy(*order))
    grouped = texts.where("label is not null").withColumn("rank", first).where("rank = 1").drop("rank")
    stay = keep(grouped.unionByName(texts.where("label is null")), "stay").toDF("stay id", "stay hash", "stay hash2", "stay label", "stay copies")
    hashes = [h.alias(f"own hash{i}") for i, h in enumerate(text_hashes(F.col("text")))]
    same = (
        F.col(f"`{id_column}`").eqNullSafe(F.col("stay id"))
        & (F.col("own hash0") == F.col("stay hash"))
        & (F.col("own hash1") == F.col("stay hash2"))
    )
    kept = documents.select("*", *hashes).join(stay, same)
    several = (F.col("stay copies") > 1) & F.col("stay label").isNotNull()
    once = kept.where(several).dropDuplicates(["stay id", "own hash0", "own hash1"])
    return kept.where(~several).unionByName(once).select(*[F.col(f"`{c}`") for c in documents.columns])
