"""Near-duplicate embeddings by an inverted multi-index.

Vectors are made unit length; each half has its own codebook, and a vector's cell is its pair of nearest codewords. A
query visits cells in the order of the sum of both halves' distances (multi-sequence order) as far as the target
recall asks, and is compared with the vectors there by cosine in double precision. Equal vectors are one class with a
count. A cell's members are cut into chunks of bounded size, and every pair of chunks is compared by itself: it gives
counts per vector and a spanning forest of its links, not the links. Groups are connected components.

The codebooks are fitted on about `fit_rows` vectors, chosen by a hash. How many cells to visit is measured with a
quarter as many query vectors, chosen by another hash, against all vectors: the smallest number, at least `min_visits`,
by which `recall` of the queries' links are found in each of BANDS bands of cosine, once counting links and once
counting groups, so that a large group of tight copies does not speak for looser ones. A band in which fewer queries
have links than the quantile takes is measured on made-up partners as well, at the band's lower end in random
directions from the queries. All vectors are indexed and all are queries.

Defined cases: vectors that are null, zero, or hold null or non-finite components are linked with nothing; of vectors
of different length the shorter count as padded with zeros; repeated rows are vectors of their own; a null id takes
part but is never the smallest of its group; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .frames import keep

#: Members of a cell that are compared with as many others at once.
CHUNK = 1024
#: Bands of cosine from the threshold to one, and links of a query in a band and batch that are ranked (with weights).
BANDS, RANKED = 5, 16


def unit(batch_column, dims: int) -> np.ndarray:
    """Unit vectors in double precision, padded to `dims`."""
    values = batch_column.values.to_numpy(zero_copy_only=False).astype(float)
    offsets = batch_column.offsets.to_numpy()
    n = np.diff(offsets)
    out = np.zeros((len(n), dims))
    at = np.arange(offsets[0], offsets[-1])
    row = np.repeat(np.arange(len(n)), n)
    out[row, at - offsets[:-1][row]] = values[at]
    # scaled by the largest component first, so that no square overflows or vanishes
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ book.T + (book * book).sum(axis=1), 0)


def codebook(x: np.ndarray, size: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Codewords by Lloyd's rounds from rows drawn at random."""
    rng = np.random.default_rng(seed)
    book = x[rng.choice(len(x), min(size, len(x)), replace=False)]
    for _ in range(rounds):
        near = distances(x, book).argmin(axis=1)
        n = np.bincount(near, minlength=len(book))
        for j in np.flatnonzero(n):
            book[j] = x[near == j].mean(axis=0)
    return book


def walks(d1: np.ndarray, d2: np.ndarray, visits: int) -> np.ndarray:
    """A row of cells (i * size of the second book + j) by rising d1[i] + d2[j] for each row of distances."""
    o1, o2 = d1.argsort(axis=1, kind="stable")[:, :visits], d2.argsort(axis=1, kind="stable")[:, :visits]
    s1, s2 = np.take_along_axis(d1, o1, 1), np.take_along_axis(d2, o2, 1)
    # the cell of places (i, j) has (i + 1) * (j + 1) - 1 others before it
    places = [(i, j) for i in range(o1.shape[1]) for j in range(min(o2.shape[1], visits // (i + 1)))]
    i, j = (np.array(x) for x in zip(*places, strict=True))
    out = np.empty((len(d1), min(visits, len(i))), np.int64)
    step = max(1, 4_000_000 // len(i))
    for a in range(0, len(d1), step):
        part = slice(a, a + step)
        order = (s1[part][:, i] + s2[part][:, j]).argsort(axis=1, kind="stable")[:, : out.shape[1]]
        out[part] = np.take_along_axis(o1[part], i[order], 1) * d2.shape[1] + np.take_along_axis(o2[part], j[order], 1)
    return out


def nearest_cells(d1: np.ndarray, d2: np.ndarray, visits: int) -> list[int]:
    """The multi-sequence walk of one vector."""
    return walks(d1[None], d2[None], visits)[0].tolist()


def rank(d1: np.ndarray, sorted2: np.ndarray, total: float) -> int:
    """Cells at most `total` away, of distances to the first book and sorted ones to the second."""
    return int(np.searchsorted(sorted2, total * (1 + 1e-12) + 1e-15 - d1, side="right").sum())


def fit(sample: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    half = sample.shape[1] // 2
    return codebook(sample[:, :half], size), codebook(sample[:, half:], size)


class _Walker:
    """Distances of vectors to the codewords, and the ranks by which two of them find each other."""

    def __init__(self, x: np.ndarray, books):
        half = x.shape[1] // 2
        self.d1, self.d2 = distances(x[:, :half], books[0]), distances(x[:, half:], books[1])
        self.h1, self.h2 = self.d1.argmin(axis=1), self.d2.argmin(axis=1)
        self.sorted2 = np.sort(self.d2, axis=1)

    def to(self, i: int, other: _Walker, j: int) -> int:
        total = self.d1[i, other.h1[j]] + self.d2[i, other.h2[j]]
        return rank(self.d1[i], self.sorted2[i], float(total))


def _found_at(left: _Walker, i: int, right: _Walker, j: int) -> int:
    """Cells that either end has to visit until one finds the other."""
    return min(left.to(i, right, j), right.to(j, left, i))


def _grid(most: int) -> np.ndarray:
    """Ranks, rounded up by at most a fiftieth."""
    return np.unique(np.minimum(np.ceil(1.02 ** np.arange(math.log(most) / math.log(1.02) + 2)), most)).astype(np.int64)


def band_floor(band, threshold: float):
    return threshold + (1 - threshold) * band / BANDS


def _ranked(queries: np.ndarray, names: np.ndarray, books, threshold: float, most: int):
    """(query, band, rank, n) of the links between the queries and a batch's vectors."""

    def run(batches):
        asked, grid = _Walker(queries, books), _grid(most)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = unit(part.column("embedding"), queries.shape[1])
                cosine = queries @ x.T
                q, v = np.nonzero(cosine >= threshold)
                other = names[q] != part.column("name").to_numpy(zero_copy_only=False)[v]
                q, v = q[other], v[other]
                if not len(q):
                    continue
                width = max(1 - threshold, 1e-9) / BANDS
                band = np.clip(((cosine[q, v] - threshold) / width).astype(int), 0, BANDS - 1)
                near, where = np.unique(v, return_inverse=True)
                seen = _Walker(x[near], books)
                keys, first, n = np.unique(q * BANDS + band, return_inverse=True, return_counts=True)
                order = np.argsort(first, kind="stable")
                starts = np.concatenate([[0], np.cumsum(n)])
                rows = []
                for k, key in enumerate(keys.tolist()):
                    mine = order[starts[k] : starts[k + 1]]
                    some = mine[np.unique(np.linspace(0, len(mine) - 1, RANKED).astype(int))]
                    for m in some.tolist():
                        r = min(_found_at(asked, key // BANDS, seen, where[m]), most)
                        rows.append((key // BANDS, key % BANDS, int(grid[np.searchsorted(grid, r)]), len(mine) / len(some)))
                columns = list(zip(*rows, strict=True))
                types = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["query", "band", "rank", "n"]
                )

    return run


def quantile(ranks, weights, share: float) -> int:
    """The smallest rank that holds `share` of the weight."""
    order = np.argsort(ranks)
    ranks, total = np.asarray(ranks)[order], np.cumsum(np.asarray(weights, float)[order])
    return int(ranks[min(np.searchsorted(total, share * total[-1] * (1 - 1e-12)), len(ranks) - 1)])


def made_up_ranks(queries: np.ndarray, books, cosine: float, most: int, at_least: int) -> list[int]:
    """Ranks of partners at a given cosine in random directions, `at_least` or one per query."""
    rng = np.random.default_rng(11)
    out = []
    for a in range(0, max(at_least, len(queries)), 512):
        x = queries[np.arange(a, min(a + 512, max(at_least, len(queries)))) % len(queries)]
        side = rng.normal(size=x.shape)
        side -= (side * x).sum(axis=1, keepdims=True) * x
        side /= np.maximum(np.sqrt((side * side).sum(axis=1, keepdims=True)), 1e-300)
        one, two = _Walker(x, books), _Walker(cosine * x + math.sqrt(max(0.0, 1 - cosine * cosine)) * side, books)
        out += [min(_found_at(one, i, two, i), most) for i in range(len(x))]
    return out


def cells_to_visit(
    classes: DataFrame, queries: np.ndarray, names: np.ndarray, books, threshold: float, recall: float, min_visits: int, most: int
) -> int:
    """Cells to visit for the recall in each band of cosine, over links and over groups."""
    ranked = keep(
        classes.select("name", "embedding")
        .mapInArrow(_ranked(queries, names, books, threshold, most), "query long, band long, rank long, n double")
        .groupBy("query", "band", "rank")
        .agg(F.sum("n").alias("n")),
        "ranks",
    )
    # a group of m has about m queries in a share of all: each of their m links counts 1 / m^2 of a group
    degree = ranked.groupBy("query").agg(F.sum("n").alias("degree"))
    counted = (
        ranked.join(degree, "query")
        .groupBy("band", "rank")
        .agg(F.sum("n").alias("links"), F.sum(F.col("n") / (F.col("degree") * F.col("degree"))).alias("groups"))
        .collect()
    )
    asking = dict(ranked.groupBy("band").agg(F.count_distinct("query")).collect())
    enough = math.ceil(1 / max(1 - recall, 1e-6))
    visits = min_visits
    for band in range(BANDS):
        rows = [r for r in counted if r["band"] == band]
        for weight in ("links", "groups"):
            if rows:
                visits = max(visits, quantile([r["rank"] for r in rows], [r[weight] for r in rows], recall))
        if asking.get(band, 0) < enough and visits < most:
            made = made_up_ranks(queries, books, min(1.0, band_floor(band, threshold)), most, min(enough, 8000))
            visits = max(visits, quantile(made, np.ones(len(made)), recall))
    return min(visits, most)


def _probed(books, visits: int, dims: int):
    """Rows of each vector: one in its own cell, with all cells it visits, and one in each of those, with its own cell."""
    half = dims // 2

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, max(1, 100_000 // visits)):
                batch = whole.slice(start, max(1, 100_000 // visits))
                x = unit(batch.column("embedding"), dims)
                cells = walks(distances(x[:, :half], books[0]), distances(x[:, half:], books[1]), visits)
                ids = batch.column("name").to_numpy(zero_copy_only=False)
                counts = batch.column("n").to_numpy(zero_copy_only=False)
                raw = [v.tobytes() for v in x]
                packed = [c.astype("<i4").tobytes() for c in cells]
                own = [c[:4] for c in packed]
                at = np.repeat(np.arange(len(x)), cells.shape[1])
                every = cells.ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([cells[:, 0], every])),
                        pa.array(np.concatenate([np.ones(len(x), bool), np.zeros(len(every), bool)])),
                        pa.array(np.concatenate([ids, ids[at]])),
                        pa.array(np.concatenate([counts, counts[at]])),
                        pa.array(raw + [raw[i] for i in at], pa.binary()),
                        pa.array(packed + [own[i] for i in at], pa.binary()),
                    ],
                    ["cell", "home", "name", "n", "x", "cells"],
                )

    return run


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges that connect what all edges (a, b) over 0..n-1 connect."""
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        p, q = root(i), root(j)
        if p != q:
            parent[p] = q
            out.append((i, j))
    return out


def _compared(threshold: float):
    """Of one pair of chunks: (a, b, links of a) with b null for counts, and forest edges (a, b, 0)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])

    def run(queries: pa.Table, members: pa.Table) -> pa.Table:
        out: list[tuple] = []
        members = members.rename_columns(queries.column_names)
        if queries.num_rows and members.num_rows:
            load = lambda t: np.frombuffer(b"".join(t.column("x").to_pylist())).reshape(t.num_rows, -1)
            cells = lambda t: np.frombuffer(b"".join(t.column("cells").to_pylist()), "<i4").reshape(t.num_rows, -1)
            qn, mn = queries.column("name").to_numpy(), members.column("name").to_numpy()
            qw, mw = queries.column("n").to_numpy(), members.column("n").to_numpy()
            close = load(queries) @ load(members).T >= threshold
            # both visit each other's cell: the pair is counted on the smaller name's visit only
            q_home, m_cells = cells(queries)[:, 0], cells(members)
            x, y = np.nonzero(close)
            mutual = np.zeros(len(x), bool)
            for a in range(0, len(x), 1 << 16):  # as many at a time as memory holds
                part = slice(a, a + (1 << 16))
                mutual[part] = (m_cells[y[part]] == q_home[x[part]][:, None]).any(axis=1)
            stay = (qn[x] != mn[y]) & (~mutual | (qn[x] < mn[y]))
            x, y = x[stay], y[stay]
            q_sum = np.bincount(x, weights=mw[y], minlength=len(qn)).astype(np.int64)
            m_sum = np.bincount(y, weights=qw[x], minlength=len(mn)).astype(np.int64)
            out += [(int(qn[i]), None, int(q_sum[i])) for i in np.flatnonzero(q_sum)]
            out += [(int(mn[i]), None, int(m_sum[i])) for i in np.flatnonzero(m_sum)]
            names, at = np.unique(np.concatenate([qn, mn]), return_inverse=True)
            tree = _forest(at[: len(qn)][x], at[len(qn) :][y], len(names))
            out += [(int(names[i]), int(names[j]), 0) for i, j in tree]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.95,
    recall: float = 0.999,
    fit_rows: int = 8000,
    min_visits: int = 4,
    id_column: str = "vec_id",
    column: str = "embedding",
) -> DataFrame:
    """(id, n_links, component_id, kept) for every vector."""
    every = vectors.select(
        F.col(id_column).alias("vec_id"), F.col(column).cast("array<double>").alias("embedding")
    )
    usable = F.coalesce(
        F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists("embedding", lambda v: v != 0),
        F.lit(False),
    )
    # adding zero makes -0.0 equal to 0.0
    same = F.xxhash64(F.transform("embedding", lambda v: v + 0.0))
    named = every.select("vec_id", "embedding", F.when(usable, same).alias("name"))
    classes = keep(
        named.where("name is not null")
        .groupBy("name")
        .agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n"), F.first("embedding").alias("embedding")),
        "classes",
    )
    total, dims = classes.agg(F.count("*"), F.max(F.size("embedding"))).first()
    empty = F.lit(0).cast("long")
    if not total:
        return every.select(
            F.col("vec_id").alias(id_column), empty.alias("n_links"), F.col("vec_id").alias("component_id"),
            F.col("vec_id").isNotNull().alias("kept"),
        )
    dims += dims % 2
    size = int(min(1024, max(4, round((total / 64) ** 0.5))))
    def chosen(by: Column, rows: float) -> tuple[np.ndarray, np.ndarray]:
        """About so many vectors and their names."""
        some = F.pmod(by, F.lit(1_000_003)) < int(1_000_003 * min(1.0, rows / total)) + 1
        got = classes.where(some).orderBy("name").select("name", "embedding").toArrow().combine_chunks()
        x = unit(got.column("embedding").combine_chunks(), dims) if got.num_rows else np.eye(1, dims)
        return x, got.column("name").to_numpy() if got.num_rows else np.zeros(1, np.int64)

    books = fit(chosen(F.col("name"), fit_rows)[0], size)
    # other vectors than the codebooks were fitted on, which lie closer to their codewords than the rest
    queries, names = chosen(F.xxhash64("name", F.lit("query")), fit_rows / 4)
    most = len(books[0]) * len(books[1])
    visits = cells_to_visit(classes, queries, names, books, threshold, recall, min_visits, most)
    rows = keep(
        classes.select("name", "n", "embedding").mapInArrow(
            _probed(books, visits, dims), "cell long, home boolean, name long, n long, x binary, cells binary"
        ),
        "probes",
    )
    # chunks: as many per cell and side as keep them at about CHUNK rows
    sizes = rows.groupBy("cell").agg(
        F.ceil(F.sum(F.col("home").cast("long")) / CHUNK).alias("members"),
        F.ceil(F.sum((~F.col("home")).cast("long")) / CHUNK).alias("queries"),
    )
    part = lambda n: F.pmod(F.xxhash64("name", F.lit("chunk")), F.greatest(n, F.lit(1)))
    dealt = rows.join(sizes.where("members > 0 and queries > 0"), "cell")

    def side(home: bool) -> DataFrame:
        own, other = ("members", "queries") if home else ("queries", "members")
        spread = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))
        rows = dealt.where(F.col("home") == home).select("cell", "name", "n", "x", "cells", part(F.col(own)).alias("own"), spread.alias("other"))
        m, q = ("own", "other") if home else ("other", "own")
        return rows.select("cell", F.col(q).alias("q"), F.col(m).alias("m"), "name", "n", "x", "cells")

    compared = keep(
        side(False)
        .groupBy("cell", "q", "m")
        .cogroup(side(True).toDF("cell2", "q2", "m2", "name2", "n2", "x2", "cells2").groupBy("cell2", "q2", "m2"))
        .applyInArrow(_compared(threshold), "a long, b long, links long"),
        "compared",
    )
    counts = compared.where("b is null").groupBy(F.col("a").alias("name")).agg(F.sum("links").alias("links"))
    label = components(compared.where("b is not null").select("a", "b")).withColumnRenamed("id", "name")
    grouped = (
        classes.select("name", "vec_id", "n")
        .join(label, "name", "left")
        .join(counts, "name", "left")
        .select("name", "vec_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("label", "name").alias("label"))
    )
    low = grouped.groupBy("label").agg(F.min("vec_id").alias("component_id"))
    facts = grouped.join(low, "label").select("name", "n_links", "component_id")
    return (
        named.select("vec_id", "name")
        .join(facts, "name", "left")
        .select(
            F.col("vec_id").alias(id_column),
            F.coalesce("n_links", empty).alias("n_links"),
            F.when(F.col("name").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(id_column) == F.col("component_id"), F.lit(False)))
    )
