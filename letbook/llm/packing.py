"""Cost-balanced packing of tokenised documents into sequences.

Every partition is packed by itself, in blocks of documents. Full sequences are cut from long documents as they are; of
the rest, pieces go in descending order of cost (`linear` per token plus `quadratic` per pair of tokens, as attention
has it) each to the sequence of lowest cost so far that has room. A piece that fits nowhere is cut at the most room
left. All sequences of a block are full; the tokens it leaves over, fewer than one sequence, go on to the next block.
What partitions leave over is a small table, packed in the same way by a last pass in a few groups of its own; only
there the end of a group fills powers of two, which need no padding. So no padding is left at all, and how many short
sequences there are does not depend on the input's partitions.

`sequence_id` is the partition number and a counter within it, with a bit of its own in the last pass. The pieces of the
first pass are stored in the shared folder, so that no text is tokenised twice.

Defined cases: a null or empty text has no tokens but the closing id, so it is a piece of one token; repeated rows
are packed as documents of their own; a text of any length is cut into as many pieces as it needs; no rows give no
pieces; a null doc_id stays null; other columns are ignored.
"""

from __future__ import annotations

import heapq
import sys
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .frames import keep

#: Documents and tokens after which a block is packed.
BLOCK_DOCS, BLOCK_TOKENS = 4096, 8_000_000
#: Input partitions whose remainders, less than a sequence each, are packed together at the end.
TAIL_PARTITIONS = 4096
#: Bit of sequence ids that the last pass gives.
LAST_PASS = 1 << 61


class Encoder:
    """Ids as the tokenizer file has them, as little-endian 32-bit bytes.

    The file's vocabulary is read once and run by the faster of the two libraries for the same byte-level encoding.
    """

    def __init__(self, path: str):
        import json

        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        letters = {chr(b): b for b in keep}
        letters |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(keep))}
        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        ranks = {
            bytes(letters[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special
        }
        pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self._coder = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self._special = list(special)

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self._special):
            ids = array("I", self._coder.encode(text, allowed_special="all"))
        else:
            ids = array("I", self._coder.encode_ordinary(text))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()


def capacities(total: int, size: int) -> list[int]:
    """Sequence lengths that sum to the total: full ones, then falling powers of two."""
    full, rest = divmod(total, size)
    return [size] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


class _Rooms:
    """Open sequences by the room that is left, with the cheapest one of each room."""

    def __init__(self, size: int):
        self._heaps: list[list] = [[] for _ in range(size + 1)]
        self._leaves = 1 << size.bit_length()
        self._least: list = [None] * (2 * self._leaves)

    def _mend(self, room: int) -> None:
        at, heap = self._leaves + room, self._heaps[room]
        self._least[at] = (*heap[0], room) if heap else None
        while at > 1:
            at >>= 1
            a, b = self._least[2 * at], self._least[2 * at + 1]
            self._least[at] = b if a is None else a if b is None or a < b else b

    def put(self, room: int, cost: float, sequence: int) -> None:
        heapq.heappush(self._heaps[room], (cost, sequence))
        self._mend(room)

    def take(self, need: int) -> tuple[float, int, int] | None:
        """The cheapest (cost, sequence, room) with at least that room, removed; None if there is none."""
        best, at, end = None, self._leaves + need, 2 * self._leaves
        while at < end:  # the nodes that cover all rooms from `need` on
            if at & 1:
                found = self._least[at]
                if found is not None and (best is None or found < best):
                    best = found
                at += 1
            at >>= 1
            end >>= 1
        if best is not None:
            heapq.heappop(self._heaps[best[2]])
            self._mend(best[2])
        return best

    def largest(self) -> int:
        """The most room that a sequence has."""
        return next((r for r in range(len(self._heaps) - 1, 0, -1) if self._heaps[r]), 0)


def place(
    tails: list[tuple[int, int, int]], room: list[int], size: int, linear: float, quadratic: float
) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int, int]]]:
    """Pieces (document, start, length, sequence, offset) of tails (length, document, start), and tails without room.

    In descending order of length, which is that of cost, each goes to the cheapest sequence with room for it; one
    that fits nowhere is cut at the most room there is.
    """
    out, left, rooms, used = [], [], _Rooms(size), [0] * len(room)
    for s, r in enumerate(room):
        rooms.put(r, 0.0, s)
    todo = [(-n, i, start) for n, i, start in tails]
    heapq.heapify(todo)
    while todo:
        n, i, start = heapq.heappop(todo)
        n = -n
        spot = rooms.take(n)
        if spot is None:
            most = rooms.largest()
            if not most:
                left.append((n, i, start))
                continue
            spot = rooms.take(most)
        cost, s, free = spot
        take = min(n, free)
        out.append((i, start, take, s, used[s]))
        used[s] += take
        if take < free:
            rooms.put(free - take, cost + linear * take + quadratic * take * take, s)
        if take < n:
            heapq.heappush(todo, (take - n, i, start + take))
    return out, left


def assign(
    lengths: list[int], size: int, linear: float, quadratic: float, last: bool = True
) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int, int]]]:
    """Pieces as (document, start, length, sequence, offset), sequences numbered from 0 without gaps.

    All sequences are full; what is left over, less than one, fills falling powers of two or, if this is not the
    last pass, is handed back as (length, document, start).
    """
    out, tails, sequence = [], [], 0
    for i, n in enumerate(lengths):
        for start in range(0, n - n % size, size):
            out.append((i, start, size, sequence, 0))
            sequence += 1
        if n % size:
            tails.append((n % size, i, n - n % size))
    total = sum(t[0] for t in tails)
    pieces, left = place(tails, capacities(total if last else total - total % size, size), size, linear, quadratic)
    return out + [(i, start, n, sequence + s, offset) for i, start, n, s, offset in pieces], left


def pack(
    documents: DataFrame,
    tokenizer: str,
    size: int = 1024,
    end_id: int = 0,
    linear: float = 1.0,
    quadratic: float = 1 / 1024,
    id_column: str = "doc_id",
) -> DataFrame:
    """One row per piece: id, start, length, ids (binary, little-endian 32 bit), doc_tokens, sequence_id, offset."""
    end = np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kind = documents.schema[id_column].dataType
    long = pa.int64()
    schema = pa.schema(list(zip(names, (to_arrow_type(kind), long, long, pa.binary(), long, long, long), strict=True)))
    ddl = f"doc_id {kind.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def packed(items: list[tuple], first: int, last: bool):
        """Rows of items (id, start in the document, ids, the document's tokens), the next number, items left over."""
        parts, left = assign([len(x[2]) // 4 for x in items], size, linear, quadratic, last)

        def cut(i: int, start: int, n: int) -> tuple:
            doc, begin, ids, total = items[i]
            return doc, begin + start, ids[4 * start : 4 * (start + n)], total

        rows = [(*cut(i, start, n), n, first + s, offset) for i, start, n, s, offset in parts]
        order = (0, 1, 4, 2, 3, 5, 6)
        arrays = [pa.array([r[k] for r in rows], f.type) for k, f in zip(order, schema, strict=True)]
        number = max((p[3] for p in parts), default=-1) + 1
        return pa.RecordBatch.from_arrays(arrays, schema=schema), first + number, [cut(i, start, n) for n, i, start in left]

    def blocks(items, first: int, last: bool):
        """Rows of all items, in blocks; what one block leaves over goes to the next."""
        block, tokens = [], 0
        for item in items:
            block.append(item)
            tokens += len(item[2]) // 4
            if len(block) >= BLOCK_DOCS or tokens >= BLOCK_TOKENS:
                rows, first, block = packed(block, first, False)
                tokens = sum(len(x[2]) // 4 for x in block)
                yield rows
        if block:
            rows, first, left = packed(block, first, last)
            yield rows
            if left:  # no sequence yet
                arrays = zip(*[(doc, start, len(ids) // 4, ids, total, None, None) for doc, start, ids, total in left], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)

    def first_pass(batches):
        encode = Encoder(tokenizer)

        def items():
            for batch in batches:
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    ids = encode(text or "") + end
                    yield doc, 0, ids, len(ids) // 4

        yield from blocks(items(), TaskContext.get().partitionId() << 33, False)

    def last_pass(batches):
        def items():
            for batch in batches:
                yield from zip(*[batch.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")], strict=True)

        yield from blocks(items(), LAST_PASS | TaskContext.get().partitionId() << 33, True)

    texts = documents.select(F.col(id_column).alias("doc_id"), "text")
    tokenised = keep(texts.mapInArrow(first_pass, ddl), "packed")
    open_ = tokenised.where("sequence_id IS NULL")
    # a partition leaves less than one sequence
    most = open_.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    groups = max(1, most // (size * TAIL_PARTITIONS))
    tails = open_.repartition(groups, "doc_id", "start").sortWithinPartitions("doc_id", "start", "ids").mapInArrow(last_pass, ddl)
    return tokenised.where("sequence_id IS NOT NULL").unionByName(tails).withColumnRenamed("doc_id", id_column)
