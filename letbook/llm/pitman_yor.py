"""Language-model scores from a hierarchical Pitman-Yor model.

Words (A-Z lowered, split at white space) and one end token per text are customers. A word's context is the word before
it (none at the start of a text): each context is a restaurant, and all have the same parent, the restaurant of all
words, whose own parent is even over the words seen and one for all others.

Seating is sampled by Gibbs: given everything else, the number of tables of a word in a restaurant has weights from
the generalised Stirling numbers and the parent's chance of the word (beyond SEATED customers the rest sit down one
after another). Of `burn` + `samples` sweeps the last `samples` count: predictive probabilities are averaged over them.

How it runs: texts are written in blocks to the shared folder. A block asks the shard of each context once about every
distinct (context, word) it holds, with its counts in training texts; pairs of HOT contexts are dealt by the word, too.
Shards add up the counts and keep what sampling may change: pairs of two customers and more, as one customer has one
table. A sweep draws these pairs' tables in all shards, tells the words' shards the tables of each word, which draw the
parent's tables and tell back each word's weight. Totals are true ones: a context's from its shard, those of hot
contexts and of the parent from all shards (a few thousand numbers that pass through the driver). At last the shards
answer every block, and the block's texts are scored by the answers.

Defined cases: a null or empty text is one end token; a null id counts as one that is trained on; repeated rows are
documents of their own; without training texts every probability is 1 (score 0); an empty table gives no rows; other
columns are ignored. Words are told apart by 56 bits of a hash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .frames import discard, keep
from .hashing import encode_lower, mix, word_hashes

#: Customers up to which the number of tables is drawn from its exact weights.
SEATED = 64
#: Characters of text in a block of documents, and for which a shard answers.
BLOCK_CHARS, SHARD_CHARS = 12_000_000, 16_000_000
#: Contexts with this share of a sampled block's tokens are dealt over all shards; so many blocks are sampled.
HOT, HOT_BLOCKS = 1 / 1000, 8
BYTES = 7


@dataclass(frozen=True)
class Prior:
    """Discount and strength of the context restaurants and of the parent; sweeps."""

    discount: float = 0.8
    strength: float = 5.0
    parent_discount: float = 0.6
    parent_strength: float = 5.0
    burn: int = 2
    samples: int = 3


def stirling(discount: float, most: int = SEATED) -> np.ndarray:
    """log of the generalised Stirling numbers by (customers, tables); -inf where there are none."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[1, 1] = 0
    tables = np.arange(most + 1)
    for c in range(1, most):
        with np.errstate(divide="ignore", invalid="ignore"):
            sit = out[c] + np.log(np.maximum(c - discount * tables, 1e-300))
        out[c + 1, 1:] = np.logaddexp(out[c, :-1], sit[1:])
    return out


def draw_tables(c: np.ndarray, base: np.ndarray, discount: float, logs: np.ndarray, rng) -> np.ndarray:
    """Tables of c customers eating one dish, where a new table has weight `base`."""
    t = np.minimum(c, 1).astype(np.int64)
    few = np.minimum(c, SEATED)
    log_base = np.log(np.maximum(base, 1e-300))
    order = np.argsort(few, kind="stable")
    cut = np.searchsorted(few[order], np.arange(2, SEATED + 2))
    for n in range(2, SEATED + 1):
        at = order[cut[n - 2] : cut[n - 1]]
        for a in range(0, len(at), 100_000):
            part = at[a : a + 100_000]
            weight = logs[n, 1 : n + 1] + np.arange(1, n + 1) * log_base[part, None]
            t[part] = 1 + (weight + rng.gumbel(size=weight.shape)).argmax(axis=1)
    many = np.flatnonzero(c > SEATED)
    seated = np.full(len(many), SEATED, np.int64)
    while len(many):
        step = np.minimum(np.maximum(seated // 16, 1), c[many] - seated)
        new = base[many] / (base[many] + np.maximum(seated - discount * t[many], 1e-9))
        t[many] += rng.binomial(step, new)
        seated += step
        left = seated < c[many]
        many, seated = many[left], seated[left]
    return t


def seat(word: np.ndarray, context: np.ndarray, c: np.ndarray, words: int, shards: int, prior: Prior, seed: int):
    """The sampler over one table of pairs: yields (tables by pair, parent's customers by word, parent's tables by word)
    of every kept sweep.

    word: number of each pair's word; c: customers, all positive; words are `shards` times as many in all.
    """
    rng = np.random.default_rng(seed)
    low, high = stirling(prior.discount), stirling(prior.parent_discount)
    t = np.ones(len(c), np.int64)
    even = 1.0 / (shards * words + 1)
    customers, tables = np.bincount(word, minlength=words), np.ones(words, np.int64)
    for sweep in range(prior.burn + prior.samples):
        spare = prior.parent_strength + prior.parent_discount * shards * tables.sum()
        chance = (customers - prior.parent_discount * tables + spare * even) / (prior.parent_strength + shards * customers.sum())
        shared = shards * np.bincount(context, weights=t)
        t = draw_tables(c, (prior.strength + prior.discount * shared[context]) * chance[word], prior.discount, low, rng)
        customers = np.bincount(word, weights=t, minlength=words).astype(np.int64)
        tables = draw_tables(customers, np.full(words, spare * even), prior.parent_discount, high, rng)
        if sweep >= prior.burn:
            yield t, customers, tables


def pack(names: np.ndarray) -> bytes:
    return np.ascontiguousarray(names.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :BYTES].tobytes()


def unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // BYTES, 8), np.uint8)
    out[:, :BYTES] = np.frombuffer(data, np.uint8).reshape(-1, BYTES)
    return out.view("<u8").ravel()


def tokens(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts, in order: each token's hash (0 for the end), the hash of the word before (0 at the start), its text."""
    hashes, owner, _ = word_hashes(raw)
    hashes = np.maximum(hashes >> np.uint64(64 - 8 * BYTES), np.uint64(1))
    ends = np.cumsum(np.bincount(owner, minlength=len(raw)).astype(np.int64))
    word = np.insert(hashes, ends, np.uint64(0))
    context = np.zeros(len(word), np.uint64)
    context[1:] = word[:-1]  # the end before a text's first word is its start
    return word, context, np.insert(owner, ends, np.arange(len(raw)))


def _shard_of(name: np.ndarray, shards: int) -> np.ndarray:
    return (mix(name ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(shards)).astype(np.int64)


@dataclass(frozen=True)
class Asked:
    """What a block asks: its words and its pairs, both in order of the shard that knows them."""

    names: np.ndarray
    name_bounds: np.ndarray
    context: np.ndarray
    word: np.ndarray
    bounds: np.ndarray
    token_pair: np.ndarray
    token_word: np.ndarray
    pair_word: np.ndarray
    owner: np.ndarray


def ask(raw: list[bytes], shards: int, hot: np.ndarray) -> Asked:
    word, context, owner = tokens(raw)
    names, number = np.unique(word, return_inverse=True)  # contexts are words or 0, which is the end
    order = np.argsort(_shard_of(names, shards), kind="stable")
    names = names[order]
    place = np.empty(len(names), np.int64)
    place[order] = np.arange(len(names))
    number = place[number]
    before = np.empty(len(number), np.int64)
    before[1:] = number[:-1]
    before[0] = number[-1]  # an end
    key, pair = np.unique(before * len(names) + number, return_inverse=True)
    u, w = key // len(names), key % len(names)
    shard = _shard_of(names, shards)[u]
    spread = np.isin(names, hot)[u]
    shard[spread] = _shard_of(names[u[spread]] + mix(names[w[spread]]), shards)
    order = np.argsort(shard, kind="stable")
    place = np.empty(len(key), np.int64)
    place[order] = np.arange(len(key))
    limits = np.arange(shards + 1)
    return Asked(
        names, np.searchsorted(_shard_of(names, shards), limits), names[u[order]], names[w[order]],
        np.searchsorted(shard[order], limits), place[pair], number, w[order], owner,
    )


def _raw(sizes: list[int], data: bytes) -> list[bytes]:
    cut = np.cumsum([0, *sizes])
    text = pa.decompress(data, decompressed_size=int(cut[-1]), codec="zstd", asbytes=True) if cut[-1] else b""
    return [text[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _blocks(schema: pa.Schema):
    """Rows of whole documents of about BLOCK_CHARS bytes together."""

    def run(batches):
        ids, trained, raw, size = [], [], [], 0

        def row():
            data = b"".join(raw)
            columns = [[ids], [trained], [[len(r) for r in raw]], [pa.compress(data, codec="zstd", asbytes=True) if data else b""]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            for i, text, learn in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "trained")), strict=True):
                ids.append(i)
                trained.append(learn)
                raw.append(encode_lower(text))
                size += len(raw[-1]) + 1
                if size >= BLOCK_CHARS:
                    yield row()
                    ids, trained, raw, size = [], [], [], 0
        if ids:
            yield row()

    return run


def _hot(batches):
    for batch in batches:
        for sizes, data in zip(batch.column("sizes").to_pylist(), batch.column("data").to_pylist(), strict=True):
            word, _, _ = tokens(_raw(sizes, data))
            names, n = np.unique(word, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(names[n >= HOT * len(word)].view(np.int64))], ["name"])


#: One form for all rows that pass between tasks: from whom, to whom, what, and arrays as bytes.
_ARROW = pa.schema([("kind", pa.string()), ("shard", pa.int32()), ("other", pa.int64()), *[(c, pa.binary()) for c in "abcdefgh"]])
_ROWS = "kind string, shard int, other long, a binary, b binary, c binary, d binary, e binary, f binary, g binary, h binary"


def _row(kind: str, shard: int, other: int, *arrays) -> tuple:
    data = [x if isinstance(x, bytes) else np.ascontiguousarray(x).tobytes() for x in arrays]
    return (kind, int(shard), int(other), *data, *[b""] * (8 - len(data)))


def _table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * 11
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def _requests(shards: int, hot: np.ndarray):
    def run(batches):
        for batch in batches:
            for block, trained, sizes, data in zip(*(batch.column(c).to_pylist() for c in ("block", "trained", "sizes", "data")), strict=True):
                q = ask(_raw(sizes, data), shards, hot)
                learn = np.array(trained, bool)[q.owner]
                n = np.bincount(q.token_word[learn], minlength=len(q.names)).astype("<u4")
                c = np.bincount(q.token_pair[learn], minlength=len(q.word)).astype("<u4")
                rows = []
                for s in range(shards):
                    a, b = q.bounds[s : s + 2]
                    x, y = q.name_bounds[s : s + 2]
                    heads, runs = _runs(q.context[a:b])
                    if b > a or y > x:
                        rows.append(_row("ask", s, block, pack(q.context[a:b][heads]), runs.astype("<u4"), pack(q.word[a:b]), c[a:b], pack(q.names[x:y]), n[x:y]))
                yield from _table(rows).to_batches()

    return run


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values begins, and its length."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    heads = np.flatnonzero(new)
    return heads, np.diff(np.append(heads, len(values)))


def _told(names: np.ndarray, values: np.ndarray, shard: int, shards: int, kind: str) -> list[tuple]:
    """Rows to the words' shards; names are in their order."""
    bounds = np.searchsorted(_shard_of(names, shards), np.arange(shards + 1))
    return [
        _row(kind, s, shard, pack(names[a:b]), values[a:b].astype("<i8"))
        for s, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))
        if b > a
    ]


def _by_shard(names: np.ndarray, shards: int) -> np.ndarray:
    return names[np.argsort(_shard_of(names, shards), kind="stable")]


def _numbers(names: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Places of names in a table that holds them all."""
    order = np.argsort(table)
    return order[np.searchsorted(table, names, sorter=order)]


def _merged(shards: int, hot: np.ndarray):
    """Counts of all blocks added up. Rows: what each block asked, by number; the shard's contexts and the pairs that are
    sampled ("seats"); its words ("words"); how many tables the words have at first, of single customers and others."""

    def run(table: pa.Table) -> pa.Table:
        asked = table.to_pylist()
        shard = asked[0]["shard"]
        heads = [unpack(r["a"]) for r in asked]
        u = np.concatenate([np.repeat(h, np.frombuffer(r["b"], "<u4")) for h, r in zip(heads, asked, strict=True)])
        w = np.concatenate([unpack(r["c"]) for r in asked])
        c = np.concatenate([np.frombuffer(r["d"], "<u4") for r in asked]).astype(np.int64)
        order = np.lexsort((w, u))
        new = np.ones(len(u), bool)
        new[1:] = (u[order][1:] != u[order][:-1]) | (w[order][1:] != w[order][:-1])
        number = np.empty(len(u), np.int64)
        number[order] = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        u, w = u[order][first], w[order][first]
        c = np.add.reduceat(c[order], first) if len(first) else c
        del order, new, first
        contexts, at = np.unique(u, return_inverse=True)
        code = np.minimum(c, 2).astype(np.uint8)
        active = c >= 2
        rank = np.cumsum(active) - 1
        moved = _by_shard(np.unique(w[active]), shards)
        names, name_of = np.unique(np.concatenate([unpack(r["e"]) for r in asked]), return_inverse=True)
        n = np.bincount(name_of, weights=np.concatenate([np.frombuffer(r["f"], "<u4") for r in asked]), minlength=len(names))
        out, pairs_done, names_done = [], 0, 0
        for r, h in zip(asked, heads, strict=True):
            mine = number[pairs_done : pairs_done + len(r["c"]) // BYTES]
            told = name_of[names_done : names_done + len(r["e"]) // BYTES]
            pairs_done, names_done = pairs_done + len(mine), names_done + len(told)
            drawn = rank[mine][code[mine] == 2]
            out.append(_row("asked", shard, r["other"], code[mine], drawn.astype("<u4"), np.searchsorted(contexts, h).astype("<u4"), r["b"], told.astype("<u4")))
        single = w[code == 1]
        word, times = np.unique(single, return_counts=True)
        order = np.argsort(_shard_of(word, shards), kind="stable")
        out += _told(word[order], times[order], shard, shards, "single")
        a_word = _numbers(w[active], moved)
        out += _told(moved, np.bincount(a_word, minlength=len(moved)), shard, shards, "tell")
        customers = np.bincount(at, weights=c, minlength=len(contexts)).astype("<i8")
        fixed = np.bincount(at[code == 1], minlength=len(contexts)).astype("<i8")
        sampled = np.bincount(at[active], minlength=len(contexts)).astype("<u4")
        warm = np.flatnonzero(np.isin(contexts, hot))
        open_ = np.union1d(np.flatnonzero(sampled), warm)
        out.append(_row("contexts", shard, 0, pack(contexts), customers, fixed, open_.astype("<u4")))
        warm_open = np.searchsorted(open_, warm).astype("<u4")
        ones = np.ones(active.sum(), "<u4")
        out.append(_row("seats", shard, 0, sampled[open_], fixed[open_], warm_open, contexts[warm], pack(moved), a_word.astype("<u4"), c[active].astype("<i8"), ones))
        out.append(_row("words", shard, 0, pack(names), n.astype("<i8")))
        sums = np.array([(n > 0).sum(), n.sum()], "<i8")
        out.append(_row("sums", shard, 0, sums))
        out.append(_row("hot", shard, 0, contexts[warm], customers[warm], (fixed + sampled)[warm].astype("<i8")))
        return _table(out)

    return run


def _parents(shards: int, prior: Prior, sweep: int, spare_even: float):
    """Draws the parent's tables. Rows: the words with their weight in this sweep, and weights for those who told."""
    high = stirling(prior.parent_discount)

    def run(words: pa.Table, tells: pa.Table) -> pa.Table:
        if not words.num_rows:
            return _table([])
        state = words.to_pylist()[0]
        shard, names, n = state["shard"], unpack(state["a"]), np.frombuffer(state["b"], "<i8")
        rng = np.random.default_rng([sweep, shard, 1])
        customers = np.frombuffer(state["c"], "<i8").copy() if state["c"] else np.zeros(len(names), np.int64)
        rows = sorted(tells.to_pylist(), key=lambda r: (r["kind"], r["other"]))
        for r in rows:
            if r["kind"] == "single":
                np.add.at(customers, np.searchsorted(names, unpack(r["a"])), np.frombuffer(r["b"], "<i8"))
        fixed = customers.copy()
        at = {r["other"]: np.searchsorted(names, unpack(r["a"])) for r in rows if r["kind"] == "tell"}
        for r in rows:
            if r["kind"] == "tell":
                customers[at[r["other"]]] += np.frombuffer(r["b"], "<i8")
        tables = draw_tables(customers, np.full(len(names), spare_even), prior.parent_discount, high, rng)
        weight = (customers - prior.parent_discount * tables).astype("<f8")
        out = [_row("reply", other, shard, weight[places].astype("<f4")) for other, places in at.items()]
        kept = state["d"] + weight.astype("<f4").tobytes() if sweep > prior.burn else b""
        out.append(_row("words", shard, 0, state["a"], n, fixed, kept))
        out.append(_row("totals", shard, 0, np.array([customers.sum(), tables.sum()], "<i8")))
        return _table(out)

    return run


def _restaurants(shards: int, prior: Prior, sweep: int, totals: tuple, hot: dict):
    """Draws the tables of the contexts' sampled pairs; the parent's weights come from the words' shards."""
    low = stirling(prior.discount)
    total, spare_even = totals

    def run(seats: pa.Table, replies: pa.Table) -> pa.Table:
        if not seats.num_rows:
            return _table([])
        s = seats.to_pylist()[0]
        shard, pairs_of, fixed = s["shard"], np.frombuffer(s["a"], "<u4"), np.frombuffer(s["b"], "<i8")
        at = np.repeat(np.arange(len(fixed)), pairs_of)
        warm, warm_names = np.frombuffer(s["c"], "<u4"), np.frombuffer(s["d"], "<u8")
        word, c = np.frombuffer(s["f"], "<u4"), np.frombuffer(s["g"], "<i8")
        t = np.frombuffer(s["h"], "<u4")[-len(c) :] if len(c) else np.empty(0)
        weight = np.frombuffer(b"".join(r["a"] for r in sorted(replies.to_pylist(), key=lambda r: r["other"])), "<f4").astype(float)
        shared = fixed + np.bincount(at, weights=t, minlength=len(fixed))
        shared[warm] = [hot[int(x)][1] for x in warm_names]
        chance = (weight + spare_even) / (prior.parent_strength + total)
        base = (prior.strength + prior.discount * shared[at]) * chance[word]
        t = draw_tables(c, base, prior.discount, low, np.random.default_rng([sweep, shard, 0])).astype("<u4")
        moved = unpack(s["e"])
        past = s["h"] if sweep > prior.burn + 1 else b""
        out = [_row("seats", shard, 0, *(s[x] for x in "abcdefg"), past + t.tobytes())]
        out += _told(moved, np.bincount(word, weights=t, minlength=len(moved)), shard, shards, "tell")
        now = (fixed + np.bincount(at, weights=t, minlength=len(fixed)))[warm].astype("<i8")
        out.append(_row("hot", shard, 0, warm_names, np.zeros(len(warm), "<i8"), now))
        return _table(out)

    return run


def _answers(prior: Prior, hot: dict, hots: list[dict]):
    """Per block: of each pair its kind and, if sampled, its discounted customers; of each context what it leaves to the
    parent in each sample; of each word its weights at the parent and its count."""

    def run(asked: pa.Table, known: pa.Table) -> pa.Table:
        state = {r["kind"]: r for r in known.to_pylist()}
        s, own, words = state["seats"], state["contexts"], state["words"]
        names, customers = unpack(own["a"]), np.frombuffer(own["b"], "<i8").astype(float)
        fixed, c = np.frombuffer(own["c"], "<i8"), np.frombuffer(s["g"], "<i8")
        open_, at = np.frombuffer(own["d"], "<u4"), np.repeat(np.frombuffer(own["d"], "<u4"), np.frombuffer(s["a"], "<u4"))
        t = np.frombuffer(s["h"], "<u4").reshape(prior.samples, -1)
        warm = open_[np.frombuffer(s["c"], "<u4")]
        customers[warm] = [hot[int(x)] for x in names[warm]]
        left = np.empty((prior.samples, len(names)))
        for k in range(prior.samples):
            tables = fixed + np.bincount(at, weights=t[k], minlength=len(names))
            tables[warm] = [hots[k][int(x)][1] for x in names[warm]]
            left[k] = (prior.strength + prior.discount * tables) / (prior.strength + customers)
        kept = (c - prior.discount * t.mean(axis=0)).astype("<f4")
        weight = np.frombuffer(words["d"], "<f4").reshape(prior.samples, -1)
        n = np.frombuffer(words["b"], "<i8")
        out = []
        for r in asked.to_pylist():
            heads, told = np.frombuffer(r["c"], "<u4"), np.frombuffer(r["e"], "<u4")
            out.append(
                _row("answer", r["shard"], r["other"], r["a"], kept[np.frombuffer(r["b"], "<u4")], left[:, heads].astype("<f4"),
                     (prior.strength + customers[heads]).astype("<f4"), r["d"], weight[:, told], n[told])
            )
        return _table(out)

    return run


def _scores(shards: int, hot: np.ndarray, prior: Prior, sums: tuple, samples: list[tuple]):
    all_words, all_tokens = sums

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        row = blocks.to_pylist()[0]
        q = ask(_raw(row["sizes"], row["data"]), shards, hot)
        k = prior.samples
        kept, size = np.zeros(len(q.word)), np.ones(len(q.word))
        left, weight, count = np.ones((k, len(q.word))), np.zeros((k, len(q.names))), np.zeros(len(q.names))
        for r in answers.to_pylist():
            a, b = q.bounds[r["shard"] : r["shard"] + 2]
            x, y = q.name_bounds[r["shard"] : r["shard"] + 2]
            code, runs = np.frombuffer(r["a"], np.uint8), np.frombuffer(r["e"], "<u4")
            value = np.where(code == 1, 1 - prior.discount, 0.0)
            value[code == 2] = np.frombuffer(r["b"], "<f4")
            kept[a:b], size[a:b] = value, np.repeat(np.frombuffer(r["d"], "<f4"), runs)
            left[:, a:b] = np.repeat(np.frombuffer(r["c"], "<f4").reshape(k, -1), runs, axis=1)
            weight[:, x:y] = np.frombuffer(r["f"], "<f4").reshape(k, -1)
            count[x:y] = np.frombuffer(r["g"], "<i8")
        chance = kept / size
        for i, (total, spare_even) in enumerate(samples):
            chance += left[i] * ((weight[i] + spare_even) / (prior.parent_strength + total))[q.pair_word] / k
        n = len(row["sizes"])
        base = np.log10((count + 1) / (all_tokens + all_words + 1))
        logs = np.log10(chance)
        sums_of = lambda x: np.bincount(q.owner, weights=x, minlength=n)
        return pa.table(
            {
                "doc_id": pa.array(row["doc_ids"], blocks.schema.field("doc_ids").type.value_type),
                "trained": pa.array(row["trained"], pa.bool_()),
                "n_tokens": pa.array(np.bincount(q.owner, minlength=n).astype(np.int64)),
                "n_known": pa.array(sums_of(count[q.token_word] > 0).astype(np.int64)),
                "base_score": pa.array(sums_of(base[q.token_word])),
                "score": pa.array(sums_of(logs[q.token_pair])),
            }
        )

    return run


def _sum(rows: DataFrame, kind: str) -> tuple:
    """The two numbers of the shards' rows of a kind, added up."""
    got = [np.frombuffer(bytes(r["a"]), "<i8") for r in rows.where(F.col("kind") == kind).select("a").collect()]
    return tuple(int(x) for x in sum(got, np.zeros(2, np.int64)))


def _hot_totals(rows: DataFrame) -> dict:
    """Customers and tables of the hot contexts over all shards."""
    out: dict = {}
    for r in rows.where("kind = 'hot'").select("a", "b", "c").collect():
        for u, c, t in zip(*(np.frombuffer(bytes(r[x]), f) for x, f in (("a", "<u8"), ("b", "<i8"), ("c", "<i8"))), strict=True):
            old = out.get(int(u), (0, 0))
            out[int(u)] = (old[0] + int(c), old[1] + int(t))
    return out


def score(documents: DataFrame, trained, prior: Prior = Prior(), id_column: str = "doc_id") -> DataFrame:
    """Per document: id, trained, n_tokens, n_known, train_tokens, base_score, score. trained: a boolean column."""
    id_type = documents.schema[id_column].dataType
    kind = id_type.simpleString()
    texts = documents.select(F.col(id_column).alias("doc_id"), F.col("text"), F.coalesce(trained, F.lit(False)).alias("trained"))
    chars = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = int(chars // SHARD_CHARS + 1)
    shape = f"doc_ids array<{kind}>, trained array<boolean>, sizes array<int>, data binary"
    schema = pa.schema([("doc_ids", pa.list_(to_arrow_type(id_type))), ("trained", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())), ("data", pa.binary())])
    blocks = keep(texts.mapInArrow(_blocks(schema), shape).withColumn("block", F.monotonically_increasing_id()), "blocks")
    common = {r[0] for r in blocks.limit(HOT_BLOCKS).mapInArrow(_hot, "name long").collect()}
    hot = np.array(sorted({0, *common}), np.int64).astype(np.uint64)

    grouped = lambda rows, *kinds: rows.where(F.col("kind").isin(*kinds)).groupBy("shard")
    asked = blocks.select("block", "trained", "sizes", "data").mapInArrow(_requests(shards, hot), _ROWS)
    seats = keep(asked.groupBy("shard").applyInArrow(_merged(shards, hot), _ROWS), "counts")
    first, words = seats, seats
    sums, hots, samples, kept_hots = _sum(seats, "sums"), _hot_totals(seats), [], []
    customers_of, parents = {u: c for u, (c, _) in hots.items()}, max(sums[0], 1)
    for sweep in range(prior.burn + prior.samples + 1):
        spare_even = (prior.parent_strength + prior.parent_discount * parents) / (sums[0] + 1)
        old = [rows for rows in (seats, words) if rows is not first]
        if sweep:
            drawn = _restaurants(shards, prior, sweep, totals, hots)
            seats = keep(grouped(seats, "seats").cogroup(grouped(words, "reply")).applyInArrow(drawn, _ROWS), "seats")
            hots = _hot_totals(seats)
        told = grouped(seats, "tell", "single")
        words = keep(grouped(words, "words").cogroup(told).applyInArrow(_parents(shards, prior, sweep, spare_even), _ROWS), "words")
        parent_customers, parents = _sum(words, "totals")
        totals = (parent_customers, (prior.parent_strength + prior.parent_discount * parents) / (sums[0] + 1))
        if sweep:
            discard(*old)
        if sweep > prior.burn:
            samples.append(totals)
            kept_hots.append(hots)
    known = seats.where("kind = 'seats'").unionByName(words.where("kind = 'words'")).unionByName(first.where("kind = 'contexts'"))
    answers = grouped(first, "asked").cogroup(known.groupBy("shard")).applyInArrow(_answers(prior, customers_of, kept_hots), _ROWS)
    return (
        blocks.groupBy("block")
        .cogroup(answers.withColumnRenamed("other", "block").groupBy("block"))
        .applyInArrow(
            _scores(shards, hot, prior, sums, samples),
            f"doc_id {kind}, trained boolean, n_tokens long, n_known long, base_score double, score double",
        )
        .select(
            F.col("doc_id").alias(id_column),
            "trained",
            "n_tokens",
            "n_known",
            F.lit(sums[1]).cast("long").alias("train_tokens"),
            "base_score",
            "score",
        )
    )
