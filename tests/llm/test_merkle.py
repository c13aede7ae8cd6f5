"""The manifest beside a plain one."""

import hashlib
import zlib

import pytest
from letbook.llm import merkle
from letbook.llm.queries import op13_merkle
from pyspark.sql import functions as F


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain(rows, tampered):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, source, lang, n_chars, text)."""

    def leaf(row):
        return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([H(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
        return out

    def way(tree, i):
        for layer in tree[:-1]:
            run = layer[i - i % 16 : i - i % 16 + 16]
            yield run[: i % 16], run[i % 16 + 1 :]
            i //= 16

    trees = {}
    for source in sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode())):
        mine = sorted((r for r in rows if r[1] == source), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[source] = mine, levels([leaf(r) for r in mine])
    over = levels([t[-1][0] for _, t in trees.values()])
    out = []
    for k, (mine, tree) in enumerate(trees.values()):
        for i, row in enumerate(mine):
            path = [*way(tree, i), *way(over, k)]
            now = leaf((*row[:4], tampered(row)))
            for left, right in path:
                now = H(*left, now, *right)
            proof = H(*[x for left, right in path for x in (*left, *right)])
            out.append((row[0], leaf(row), tree[-1][0], over[-1][0], proof, now, now == over[-1][0]))
    return out


def lowered(row):
    hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
    return row[4].translate({c: c + 32 for c in range(65, 91)}) if hit and row[4] is not None else row[4]


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def ours(spark, tmp_path, rows, extra=()):
    frame = spark.createDataFrame([(*r, *(1 for _ in extra)) for r in rows], ", ".join([SCHEMA, *(f"{x} int" for x in extra)]))
    frame.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return op13_merkle(spark, str(tmp_path)).collect()


def test_sizes_of_sources(spark, tmp_path, monkeypatch):
    """One block, several levels of blocks, more sources than a block holds."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 16)
    sizes = {"a": 1, "b": 2, "c": 16, "d": 17, "e": 256, "f": 257, "é": 300, "Z": 3} | {f"s{i}": 1 for i in range(20)}
    rows = [(i * 7 % 1009, s, "en", i, f"Text {i} of {s}") for s, n in sizes.items() for i in range(n)]
    assert order(ours(spark, tmp_path, rows)) == order(plain(rows, lowered))


def test_nulls_ties_long_texts_and_clashing_names(spark, tmp_path):
    rows = [
        (None, None, None, None, None),
        (None, None, None, None, "A null id"),
        (5, "a", "en", 1, "Same"),
        (5, "a", "en", 1, "Same"),
        (5, "a", "en", 1, "Other"),
        (2**60 + 1, "a", None, 3, "É水🙂 A" * 50_000),
        (7, "", "de", -1, ""),
        *[(i, None, "fr", 0, f"Row {i}") for i in range(40)],
    ]
    names = ("key", "rank", "n", "digest", "block", "place", "part", "path", "leaf", "root", "now", "id")
    assert order(ours(spark, tmp_path, rows, names)) == order(plain(rows, lowered))
    assert ours(spark, tmp_path, []) == []
    one = [(3, "x", "en", 1, "Lone")]
    assert order(ours(spark, tmp_path, one)) == order(plain(one, lowered))


def test_whole_blocks_at_their_real_size(spark, documents):
    rows = spark.range(0, 4097 * 2 + 5).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 4097, "x").when(F.col("id") < 8194, None).otherwise("y").alias("source"),
        F.lit("en").alias("lang"),
        F.lit(1).cast("long").alias("n_chars"),
        F.concat(F.lit("T"), F.col("id")).alias("text"),
    )
    got = merkle.manifest(rows).collect()
    assert order(got) == order(plain([tuple(r) for r in rows.collect()], lambda r: r[4]))
    assert all(r["verified"] for r in got)


def test_tampering_shows(spark, documents):
    got = {r["doc_id"]: r for r in merkle.manifest(documents, F.when(F.col("doc_id") == 3, F.lit("changed"))).collect()}
    assert not got.pop(3)["verified"] and all(r["verified"] for r in got.values())


@pytest.mark.parametrize("path", ["", "0", "3,a,b,c", "0,x 2,y,z"])
def test_others(path):
    steps = merkle.others(path)
    assert " ".join(",".join([str(at), *rest]) for at, rest in steps) == path
