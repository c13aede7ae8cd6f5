"""Conversation repair: the cheapest edits that make turns alternate, by dynamic programming over runs of equal symbols.

Rows (conv_id, turn, role, text) are taken per conversation by turn. A row is blank, a duplicate of an earlier row, or
truncated (the first that holds counts). Edits: keep a row (0), give it the role user or assistant (1), delete it (2; a
must for blank rows and duplicates), insert an empty user or assistant turn (5); a truncated row that stays costs 5
more. Wanted are the cheapest edits after which the first letters of the roles read (s?(ua)+)?, of equally cheap ones
those whose initials K, R, D, I come first in the alphabet.

How it runs: equal rows of a turn are counted before anything is shuffled; whether a row repeats an earlier one is the
smallest turn of its content, another count. Rows are then dealt by range of (conversation, turn, role, text) and cut
into blocks of at most 65,536, so that a conversation of any size is spread. A block is a sequence of runs of equal
symbols; a run's min-plus transition between four states (nothing yet, after s, after u, after a) is raised to its
length by cached binary powers, and choices are unrolled run by run. A conversation that lies inside a block is solved
at once. For one that goes on, the block gives its best edits between any two states, and the blocks of a conversation
are joined in order, equally cheap ways by their edits as text; ways that agree so far are handed on at once.

Results: `totals`, a row per conversation with rows, and `turns`, the repaired ones in order.

Defined cases: a null role or text is one blank space, null turns come first; a null conv_id is a conversation like any
other; rows of equal turn are ordered by role, then text; texts of any length are read by Spark's functions or pass by
one at a time; no rows give no totals and no turns; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import cache, lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .frames import keep
from .merkle import field

SPACE = " \t\n\x0b\x0c\r"
#: A block has at most two to this many rows.
BLOCK_BITS = 16
FAR = 1 << 60
STATES = range(4)
#: State after an inserted or renamed turn, and its role.
NEXT = (2, 2, 3, 2)
ROLES = ("user", "user", "assistant", "user")
KEEPS = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
ACCEPTED = (0, 3)
INSERT, DELETE, RENAME, TRUNCATED = 5, 2, 1, 5
#: No more than two inserts in a row help.
INSERTS = 2


def rows_of(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): nulls in role and text made a blank space."""
    blank = F.lit(" ")
    return turns.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), F.lit(1).alias("copies")
    )


def damage(turns: DataFrame) -> DataFrame:
    """The rows with faults by a hash of conversation and turn: dropped, emptied, without stops, repeated, or by the user."""
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(name.cast("binary")) % 20
    rows = rows_of(turns).withColumn("kind", kind).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies"),
    )


def ordered(rows: DataFrame) -> DataFrame:
    """Distinct rows in order: place, block, n copies, whether one of them is the first of its content, fault and symbol."""
    named = rows.withColumn("same", F.sha2(F.concat(field(F.col("conv_id")), field(F.col("role")), field(F.col("text"))), 256))
    named = named.withColumn("at", F.coalesce(F.col("turn").cast("string"), F.lit("-")))
    first = [F.first(c).alias(c) for c in ("conv_id", "turn", "role", "text")]
    groups = named.groupBy("same", "at").agg(*first, F.sum("copies").alias("n"))
    earliest = named.groupBy("same").agg(F.min(F.struct("turn", "at")).alias("low")).select("same", F.col("low.at").alias("at"), F.lit(True).alias("first"))
    shown = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    whole = F.substring(shown, -1, 1).isin(".", "!", "?")
    placed = (
        groups.join(earliest, ["same", "at"], "left")
        .select(
            "conv_id",
            "turn",
            "role",
            "text",
            "n",
            initial.alias("initial"),
            (shown == "").alias("blank"),
            # the symbol of the first copy: small if it ends whole, D if it has to go
            F.when((shown == "") | F.col("first").isNull(), "D").when(whole, letter).otherwise(F.upper(letter)).alias("symbol"),
        )
        .repartitionByRange("conv_id", "turn", "role", "text")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .withColumn("place", F.monotonically_increasing_id())
    )
    return keep(placed, "turns").withColumn("block", F.shiftright("place", BLOCK_BITS))


def _row_choices(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of one row, without inserts."""
    out = [("D", DELETE, state)]
    if symbol != "D":
        more = 0 if symbol.islower() else TRUNCATED
        if (symbol.lower(), state) in KEEPS:
            out.append(("K", more, KEEPS[symbol.lower(), state]))
        out.append(("R", RENAME + more, NEXT[state]))
    return out


@cache
def power(symbol: str, exponent: int) -> tuple[tuple[int, ...], ...]:
    """Min-plus transition of 2 ** exponent rows of a symbol, inserts before each row included."""
    if exponent:
        half = power(symbol, exponent - 1)
        return tuple(tuple(min(half[a][m] + half[m][b] for m in STATES) for b in STATES) for a in STATES)
    out = []
    for start in STATES:
        line, state = [FAR] * 4, start
        for inserts in range(INSERTS + 1):
            for _, cost, after in _row_choices(symbol, state):
                line[after] = min(line[after], inserts * INSERT + cost)
            state = NEXT[state]
        out.append(tuple(line))
    return tuple(out)


def before(symbol: str, count: int, ends: tuple[int, ...]) -> tuple[int, ...]:
    """Cost to go from each state before a run, from the costs after it."""
    exponent = 0
    while count >> exponent:
        if count >> exponent & 1:
            ends = tuple(min(a + b for a, b in zip(line, ends, strict=True)) for line in power(symbol, exponent))
        exponent += 1
    return ends


def closing(state: int) -> int:
    """Inserts after the last row that make a state an accepted one."""
    return next(k for k in range(3) if (state, NEXT[state], NEXT[NEXT[state]])[k] in ACCEPTED)


END = tuple(INSERT * closing(state) for state in STATES)


def _unroll(symbol: str, count: int, state: int, ends: tuple[int, ...]) -> tuple[str, int]:
    """The first in the alphabet of the cheapest edits of a run from a state, and the state after it."""
    if symbol == "D":
        return "D" * count, state
    costs = [ends]
    for _ in range(count):
        costs.append(before(symbol, 1, costs[-1]))
    edits = []
    for after in costs[-2::-1]:
        here = before(symbol, 1, after)
        while True:
            wanted = here[state]
            ways = [(edit, cost + after[to], to) for edit, cost, to in _row_choices(symbol, state)]
            ways.append(("I", INSERT + here[NEXT[state]], NEXT[state]))
            edit, _, state = min(way for way in ways if way[1] == wanted)
            edits.append(edit)
            if edit != "I":
                break
    return "".join(edits), state


@lru_cache(100_000)
def solve(runs: tuple[tuple[str, int], ...], start: int, ends: tuple[int, ...]) -> tuple[int, str, int]:
    """(cost, edits, state after the rows) of the cheapest way through all runs, ends being the costs to go after them.

    From FAR on, the cost says that there is no way.
    """
    costs = [ends]
    for symbol, count in reversed(runs):
        costs.append(before(symbol, count, costs[-1]))
    if costs[-1][start] >= FAR:
        return FAR, "", start
    state, edits = start, []
    for (symbol, count), after in zip(runs, costs[-2::-1], strict=True):
        part, state = _unroll(symbol, count, state, after)
        edits.append(part)
    return costs[-1][start], "".join(edits), state


#: `to` of a way that ends the conversation.
DONE = -1


def ways_through(runs: tuple[tuple[str, int], ...], alone: bool) -> list[dict]:
    """Best edits from state to state; of a whole conversation from its start to its end."""
    if alone:
        cost, edits, state = solve(runs, 0, END)
        return [{"from": 0, "to": DONE, "cost": cost, "edits": edits + "I" * closing(state)}]
    out = []
    for start in STATES:
        for end in STATES:
            cost, edits, _ = solve(runs, start, tuple(0 if s == end else FAR for s in STATES))
            if cost < FAR:
                out.append({"from": start, "to": end, "cost": cost, "edits": edits})
    return out


_FIGURES = ["distinct", "blank", "duplicate", "truncated", "illegal"]
_LEGAL = ("su", "ua", "au")


class _Segment:
    """Rows of one conversation in one block, as they come."""

    def __init__(self, conv, block: int, place: int):
        self.conv, self.block, self.place = conv, block, place
        self.runs: list[list] = []
        self.low = self.high = self.last = self.first = None
        self.figures = dict.fromkeys(_FIGURES, 0)

    def add(self, turn, initial: str, blank: bool, symbol: str, n: int) -> None:
        f = self.figures
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            f["distinct"] += 1
        if blank:
            f["blank"] += n
        else:
            f["duplicate"] += n - (symbol != "D")
            f["truncated"] += symbol.isupper() and symbol != "D"
        f["illegal"] += n - 1 + (self.last is not None and self.last + initial not in _LEGAL)
        self.first = initial if self.first is None else self.first
        self.last = initial
        for s, k in ((symbol, 1), ("D", n - 1)):
            if k and self.runs and self.runs[-1][0] == s:
                self.runs[-1][1] += k
            elif k:
                self.runs.append([s, k])

    def row(self, alone: bool) -> dict:
        runs = tuple((s, k) for s, k in self.runs)
        names = {x: getattr(self, x) for x in ("block", "place", "low", "high", "first", "last")}
        return {"conv_id": self.conv, **names, **self.figures, "ways": ways_through(runs, alone)}


_FIELDS = ", ".join(f"{x} long" for x in _FIGURES)


def _rows(batches, columns: list[str]):
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in columns], strict=True)


def _batched(rows, schema: pa.Schema, size: int = 2000):
    """Record batches of dictionaries."""
    some = []
    for row in rows:
        some.append(row)
        if len(some) == size:
            yield pa.RecordBatch.from_pylist(some, schema)
            some = []
    if some:
        yield pa.RecordBatch.from_pylist(some, schema)


def _stream(rows: DataFrame, columns: list[str], make, ddl: str) -> DataFrame:
    """make(tuples of the columns, in the rows' order) per task, as rows of the schema."""
    kind = StructType.fromDDL(ddl)
    schema = to_arrow_schema(kind)
    return rows.select(*columns).mapInArrow(lambda batches: _batched(make(_rows(batches, columns)), schema), kind)


def _type(rows: DataFrame, column: str) -> str:
    return rows.schema[column].dataType.simpleString()


def segments(turns: DataFrame) -> DataFrame:
    """(conv_id, block, ...): figures and ways of each conversation in each block, from ordered rows."""

    def make(rows):
        now, edge = None, True  # edge: the segment begins its block
        for block, place, conv_id, turn, initial, blank, symbol, n in rows:
            if now is None or (now.block, now.conv) != (block, conv_id):
                if now is not None:
                    yield now.row(not edge and now.block == block)
                    edge = now.block != block
                now = _Segment(conv_id, block, place)
            now.add(turn, initial, blank, symbol, n)
        if now is not None:
            yield now.row(False)

    turn = _type(turns, "turn")
    ways = "ways array<struct<`from`:int,`to`:int,cost:bigint,edits:string>>"
    return _stream(
        turns.repartition("block").sortWithinPartitions("place"),
        ["block", "place", "conv_id", "turn", "initial", "blank", "symbol", "n"],
        make,
        f"conv_id {_type(turns, 'conv_id')}, block long, place long, low {turn}, high {turn}, first string, last string, {_FIELDS}, {ways}",
    )


def best_ways(parts):
    """Of one conversation's segments in order: (block, place, state, edits) of each in the cheapest way, then the cost.

    Pieces but the last leave as soon as all ways that are still open share them.
    """
    open_ways: dict[int, tuple[int, list[tuple]]] = {0: (0, [])}
    for part in parts:
        after: dict[int, tuple[int, list[tuple]]] = {}
        for way in part["ways"]:
            if way["from"] in open_ways:
                cost, pieces = open_ways[way["from"]]
                new = (cost + way["cost"], [*pieces, (part["block"], part["place"], way["from"], way["edits"])])
                if way["to"] not in after or _rank(new) < _rank(after[way["to"]]):
                    after[way["to"]] = new
        open_ways = after
        some = [pieces for _, pieces in open_ways.values()]
        while all(len(p) > 1 and p[0] == some[0][0] for p in some):
            yield some[0][0]
            for p in some:
                p.pop(0)
    ends = []
    for state, (cost, pieces) in open_ways.items():
        more = 0 if state == DONE else closing(state)
        *others, (block, place, begin, edits) = pieces
        ends.append((cost + more * INSERT, [*others, (block, place, begin, edits + "I" * more)]))
    cost, pieces = min(ends, key=_rank)
    yield from pieces
    yield cost


def _rank(way: tuple[int, list[tuple]]) -> tuple[int, str]:
    return way[0], "".join(p[-1] for p in way[1])


def joined(parts: DataFrame) -> DataFrame:
    """Segments to the pieces (block, place, state, edits) of each conversation's cheapest way, and a row of its totals (cost)."""
    names = parts.columns

    def make(rows):
        for conv_id, mine in groupby((dict(zip(names, row, strict=True)) for row in rows), key=lambda r: r["conv_id"]):
            total = {"conv_id": conv_id, "low": None, "high": None, "last": None, **dict.fromkeys(_FIGURES, 0)}

            def counted(mine=mine, total=total):
                for part in mine:
                    for x in _FIGURES:
                        total[x] += part[x]
                    total["illegal"] += total["last"] is not None and total["last"] + part["first"] not in _LEGAL
                    total["last"] = part["last"]
                    if part["low"] is not None:
                        total["distinct"] -= total["high"] is not None and part["low"] == total["high"]
                        total["low"] = part["low"] if total["low"] is None else total["low"]
                        total["high"] = part["high"]
                    yield part

            for piece in best_ways(counted()):
                if isinstance(piece, int):
                    del total["last"]
                    yield {**total, "cost": piece}
                else:
                    yield {"conv_id": conv_id, **dict(zip(("block", "place", "state", "edits"), piece, strict=True))}

    turn = _type(parts, "low")
    return _stream(
        parts.repartition("conv_id").sortWithinPartitions("conv_id", "block"),
        names,
        make,
        f"conv_id {_type(parts, 'conv_id')}, block long, place long, state int, edits string, low {turn}, high {turn}, {_FIELDS}, cost long",
    )


def repaired(turns: DataFrame, pieces: DataFrame) -> DataFrame:
    """(conv_id, place, step, role, text) of the repaired turns: ordered rows beside the edits of their block."""

    def make(rows):
        edits, at, state, step, conv, place = "", 0, 0, 0, None, 0

        def turn(role: str, text: str):
            nonlocal step
            step += 1
            return {"conv_id": conv, "place": place, "step": step, "role": role, "text": text}

        def inserts():
            nonlocal at, state
            while edits[at : at + 1] == "I":
                yield turn(ROLES[state], "")
                at, state = at + 1, NEXT[state]

        for row_place, piece, start, conv_id, role, text, n in rows:
            if piece is not None:
                yield from inserts()
                edits, at, state = piece, 0, start
                continue
            conv, place, step = conv_id, row_place, 0
            while n:
                if edits.count("D", at, at + n) == n:
                    at += n
                    break
                yield from inserts()
                edit, at, n = edits[at], at + 1, n - 1
                if edit == "R":
                    yield turn(ROLES[state], text)
                    state = NEXT[state]
                elif edit == "K":
                    yield turn(role, text)
                    state = KEEPS[role[:1], state]
        yield from inserts()

    names = ["place", "edits", "state", "conv_id", "role", "text", "n"]
    rows = turns.select("block", "place", "conv_id", "role", "text", "n")
    plan = pieces.select("block", "place", "conv_id", "state", "edits")
    both = rows.unionByName(plan, allowMissingColumns=True)
    return _stream(
        both.repartition("block").sortWithinPartitions("place", F.col("edits").isNull()),
        names,
        make,
        f"conv_id {_type(turns, 'conv_id')}, place long, step long, role string, text string",
    )


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(totals, turns) of rows as `rows_of` or `damage` give them.

    totals: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit; turns: conv_id, place, step, role, text,
    of which place and step are the order.
    """
    turns = ordered(rows)
    both = keep(joined(segments(turns)), "edits")
    pieces = both.where("edits IS NOT NULL")
    order = F.array_sort(F.collect_list(F.struct("block", "edits")))
    audits = pieces.groupBy("conv_id").agg(F.array_join(F.transform(order, lambda p: p["edits"]), "").alias("audit"))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("distinct"), F.lit(0)).cast("long").alias("gaps")
    totals = both.where("edits IS NULL").select(F.col("conv_id").alias("conv"), gaps, *_FIGURES[1:], "cost")
    all_of = audits.join(totals, F.col("conv_id").eqNullSafe(F.col("conv"))).drop("conv")
    return all_of, repaired(turns, pieces)


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of `role:text` of the repaired turns, joined by new lines, read one at a time."""

    def make(rows):
        for conv_id, mine in groupby(rows, key=lambda r: r[0]):
            digest, between = hashlib.sha256(), ""
            for _, role, text in mine:
                digest.update(f"{between}{role}:{text}".encode())
                between = "\n"
            yield {"conv_id": conv_id, "repaired_sha256": digest.hexdigest()}

    inside = turns.repartition("conv_id").sortWithinPartitions("conv_id", "place", "step")
    return _stream(inside, ["conv_id", "role", "text"], make, f"conv_id {_type(turns, 'conv_id')}, repaired_sha256 string")
