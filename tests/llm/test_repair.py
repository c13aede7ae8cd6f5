"""Repairs beside every possible edit, and the query beside a plain one."""

import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import pytest
from letbook.llm import repair
from letbook.llm.queries import op11_repair

WHITE = " \t\n\x0b\x0c\r"


def faults(rows):
    """(kind of the first fault or None) of rows (role, text) in order."""
    seen, out = set(), []
    for role, text in rows:
        shown = text.rstrip(WHITE)
        out.append("blank" if not shown.strip(WHITE) else "duplicate" if (role, text) in seen else None if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def every_way(rows):
    """The cheapest and then first edits of few rows, by trying all of them."""
    kinds = faults(rows)
    gaps = ["", "u", "a", "ua", "au", "uu", "aa"]
    options = []
    for (role, _), kind in zip(rows, kinds, strict=True):
        more = 5 * (kind == "truncated")
        mine = [("D", 2, "")]
        if kind not in ("blank", "duplicate"):
            mine += [("K", more, role[:1] or "-"), ("R", 1 + more, "u"), ("R", 1 + more, "a")]
        options.append(mine)
    best = None
    for fills in itertools.product(gaps, repeat=len(rows) + 1):
        for picks in itertools.product(*options):
            shape = fills[0] + "".join(p[2] + f for p, f in zip(picks, fills[1:], strict=True))
            if re.fullmatch("(s?(ua)+)?", shape):
                cost = 5 * sum(map(len, fills)) + sum(p[1] for p in picks)
                audit = "I" * len(fills[0]) + "".join(p[0] + "I" * len(f) for p, f in zip(picks, fills[1:], strict=True))
                best = min(best or (cost, audit), (cost, audit))
    return best


def plain_way(rows):
    """The same by recursion over rows and the pattern's states, with the edits as text."""
    kinds = faults(rows)
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @cache
    def go(i, state, inserts):
        out = []
        if i == len(rows) and state in ("", "a"):
            out.append((0, ""))
        for letter in "ua":
            if (state, letter) in step and inserts < 3:
                cost, audit = go(i, step[state, letter], inserts + 1)
                out.append((cost + 5, "I" + audit))
        if i < len(rows):
            cost, audit = go(i + 1, state, 0)
            out.append((cost + 2, "D" + audit))
            more = 5 * (kinds[i] == "truncated")
            if kinds[i] not in ("blank", "duplicate"):
                for letter, price, edit in ((rows[i][0][:1], 0, "K"), ("u", 1, "R"), ("a", 1, "R")):
                    if (state, letter) in step:
                        cost, audit = go(i + 1, step[state, letter], 0)
                        out.append((cost + price + more, edit + audit))
        return min(out, default=(10**9, ""))

    for i in range(len(rows), 0, -100):  # so that no recursion goes deep
        go(i, "", 0)
    return go(0, "", 0)


def repaired(rows, audit):
    out, rows, state = [], iter(rows), ""
    for edit in audit:
        role, text = (None, "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit in "IR":
            role = "assistant" if state == "u" else "user"
        out.append((role, text))
        state = role[:1]
    assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in out))
    return out


def summary(conv, rows):
    """What the query says of rows (turn, role, text) in order."""
    body = [(role, text) for _, role, text in rows]
    kinds = faults(body)
    cost, audit = plain_way(tuple(body)) if rows else (0, "")
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(body))
    text = "\n".join(f"{role}:{t}" for role, t in repaired(body, audit))
    counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
    return (conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def damaged(rows):
    for conv, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        for _ in range((kind != 0) + (kind == 3)):
            yield conv, turn, role, text


def plain(rows):
    groups = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in damaged(rows):
        groups[conv].append((turn, role, text))
    first = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return [summary(conv, sorted(group, key=first)) for conv, group in groups.items()]


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def query(spark, folder, rows, extra=()):
    schema = ", ".join(["conv_id long, turn long, role string, text string", *(f"{x} int" for x in extra)])
    spark.createDataFrame([(*r, *(1 for _ in extra)) for r in rows], schema).write.mode("overwrite").parquet(f"{folder}/conversations.parquet")
    return op11_repair(spark, str(folder)).collect()


TEXTS = ["Yes.", "No!", "What", "", "  ", "Yes.", "Is it?\n", "cut off,"]
ROLES = ["system", "user", "assistant", "user", "assistant", "tool", ""]


def random_rows(rng, size):
    return [(rng.choice(ROLES), rng.choice(TEXTS) + rng.choice(["", "a.", "b", "c!"])) for _ in range(size)]


def solved(body):
    segment = repair._Segment(0, 0, 0)
    groups = [(k, list(g)) for k, g in itertools.groupby(zip(body, faults(body), strict=True))]
    for ((role, text), kind), copies in groups:
        letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
        symbol = "D" if kind in ("blank", "duplicate") else letter.upper() if kind else letter
        segment.add(0, role[:1], kind == "blank", symbol, 1)
        for _ in copies[1:]:
            segment.add(0, role[:1], kind == "blank", "D", 1)
    (way,) = segment.row(True)["ways"]
    return way["cost"], way["edits"]


def test_few_rows_beside_every_edit():
    rng = random.Random(1)
    for size in (0, 1, 2, 2, 2, 3, 3, 3, 3):
        body = random_rows(rng, size)
        assert every_way(body) == plain_way(tuple(body))
        if body:
            assert solved(body) == every_way(body)


def test_many_rows_beside_the_recursion():
    rng = random.Random(2)
    for _ in range(300):
        body = random_rows(rng, rng.randint(1, 25))
        assert solved(body) == plain_way(tuple(body))


@pytest.mark.parametrize("symbol", "suaxSUAXD")
def test_powers(symbol):
    for count in (1, 2, 3, 7, 64, 1000):
        costs = repair.END
        for _ in range(count):
            costs = repair.before(symbol, 1, costs)
        assert costs == repair.before(symbol, count, repair.END)


def test_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert order(op11_repair(spark, sf_dir).collect()) == order(plain(rows))


def test_nulls_ties_repeats_and_clashing_names(spark, tmp_path):
    rng = random.Random(3)
    rows = [(None, None, None, None), (None, 1, "user", "A null conversation."), (None, 2, "assistant", None)]
    rows += [(c, rng.choice([None, 0, 1, 2, 3, 5, 9]), rng.choice([*ROLES, None]), rng.choice([*TEXTS, None, "é🙂."])) for c in range(60) for _ in range(rng.randint(1, 9))]
    rows += [(900, 1, "user", "x" * 300_000 + "."), (900, 2, "assistant", "y. " * 100_000)]
    rows += [(901, t, r, "Same.") for t in (1, 2, 3) for r in ("user", "user", "assistant")]
    names = ("n", "block", "place", "kind", "copies", "same", "at", "first", "audit", "cost", "symbol")
    assert order(query(spark, tmp_path, rows, names)) == order(plain(rows))
    assert query(spark, tmp_path, []) == []


def test_conversations_over_many_blocks(spark, tmp_path, monkeypatch):
    """Blocks of four rows: every conversation goes over several of them, and over several tasks."""
    monkeypatch.setattr(repair, "BLOCK_BITS", 2)
    rng = random.Random(4)
    rows = [(1, t, rng.choice(ROLES), rng.choice(TEXTS) + str(t // 2) + rng.choice([".", ""])) for t in range(700)]
    rows += [(c, t, rng.choice(ROLES), rng.choice(TEXTS) + rng.choice([".", "a"])) for c in range(2, 30) for t in range(rng.randint(1, 12))]
    rows += [(50, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(100)]
    rows += [(51, 5, "user", "Again.")] * 300
    assert order(query(spark, tmp_path, rows)) == order(plain(rows))


def test_all_rows_dropped(spark, tmp_path):
    turn = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    (row,) = query(spark, tmp_path, [(7, turn, "user", "Gone.")])
    assert tuple(row) == (7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
