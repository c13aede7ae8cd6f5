"""Secret scans: known forms by pattern, the rest by a battery of randomness tests.

Known forms (`assign`, `access`, `hex`) are found leftmost and without overlap, kind by kind. Every other run of 20
or more characters of the base-64 alphabets that holds letters and digits is a candidate, after `=` too, which
belongs to a token at its end only, as padding. Its encoding is inferred: the smallest alphabet that holds it, first
without its hyphens and low lines, which part many tokens into groups.

Three tests ask whether its symbols look drawn evenly and independently: chi-squared over slices of the alphabet that
keep capitals, small letters and digits apart, the runs above and below the middle, the correlation of neighbours.
Fisher's method joins the three p-values; a small one speaks of ordinary text. A fourth asks the other way round
whether ordinary text could look so mixed: how often letters, capitals and digits change, where in names and numbers
they change about as often as TEXT_CHANGES says. A small p-value speaks against ordinary text.

Both decisions are controlled over all candidates of all documents by the step-up rule of Benjamini and Hochberg, each
p-value divided by a weight that grows with its token's length (mean one): long tokens, whose tests have power, are
decided sooner than short ones. Reported as kind `random` is what is not ordinary text at rate `fdr`, which is the
rate of false alarms among reported spans as far as ordinary text keeps to TEXT_CHANGES, and whose evenness is not
rejected at that rate. Only counts of p-values by fine steps (at most STEPS + 1 numbers each) reach the driver.

Defined cases: null is an empty text and gives no spans; repeated rows give a row each; an empty table gives no rows;
a span that overlaps a known form is not added; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import keep

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: Steps in -log10 of the weighted p-value: 0.02 each, up to 20.
STEPS, STEP = 1000, 0.02
#: Share of neighbours between which ordinary tokens change among small letters, capitals and digits (a capital that
#: begins a word changes once): single-case names with numbers, and names of capitalised words.
TEXT_CHANGES = {"base16": 0.1, "base32": 0.1, "base36": 0.1, "base62": 0.2, "base64": 0.2, "base64url": 0.2}
_ALPHABETS = (
    ("base16", "0123456789abcdef"),
    ("base16", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)


def infer(token: str) -> tuple[str, str, str] | None:
    """Name and alphabet of the smallest encoding that holds the token, and what of it is encoded; none if no one does."""
    body = token.rstrip("=")
    plain = body.replace("-", "").replace("_", "")
    for name, letters in _ALPHABETS[:-1]:
        if set(plain) <= set(letters):
            if plain != body and len(body) - len(plain) > len(body) // 8:  # more than part it into groups
                break
            return name, letters, plain
    return (*_ALPHABETS[-1], body) if set(body) <= set(_ALPHABETS[-1][1]) else None


def _chi2_tail(x: float, df: int) -> float:
    """Upper tail of chi-squared, by the cube-root normal form; exact enough from two degrees on."""
    if x <= 0:
        return 1.0
    if df == 6:  # Fisher's sum of three: closed form
        h = x / 2
        return math.exp(-h) * (1 + h + h * h / 2)
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return math.erfc(z / math.sqrt(2)) / 2


def _slices(letters: str, n: int) -> np.ndarray:
    """The slice of each letter: capitals, small letters, digits and signs, each cut in two where tokens are long enough."""
    kinds = ["A" if c.isupper() else "a" if c.islower() else "0" if c.isdigit() else "/" for c in letters]
    size = {k: kinds.count(k) for k in kinds}
    seen: dict[str, int] = {}
    out = []
    for k in kinds:
        half = seen.get(k, 0) * 2 // size[k] if n * size[k] >= 10 * len(letters) else 0
        seen[k] = seen.get(k, 0) + 1
        out.append((k, half))
    numbers = {k: i for i, k in enumerate(dict.fromkeys(out))}
    return np.array([numbers[k] for k in out])


def mixture(body: str, name: str) -> float:
    """Chance that ordinary text of this length changes between kinds of characters as often."""
    kind = ["A" if c.isupper() else "a" if c.islower() else "0" if c.isdigit() else "/" for c in body]
    changes = sum(x != y and (x, y) != ("A", "a") for x, y in zip(kind, kind[1:]))  # noqa: B905
    n, share, tail = len(body) - 1, TEXT_CHANGES[name], 0.0
    for k in range(changes, n + 1):
        tail += math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(share) + (n - k) * math.log1p(-share))
    return min(1.0, tail)


def battery(token: str) -> tuple[float, float] | None:
    """The joined p-value of the three tests, and that of ordinary text; none if no encoding fits or too few symbols are left."""
    fit = infer(token)
    if fit is None or len(fit[2]) < 16:
        return None
    name, letters, body = fit
    place = {c: i for i, c in enumerate(letters)}
    x = np.array([place[c] for c in body], float)
    n, size = len(x), len(letters)
    slice_of = _slices(letters, n)
    slices = int(slice_of.max()) + 1
    seen = np.bincount(slice_of[x.astype(int)], minlength=slices)
    share = np.bincount(slice_of, minlength=slices) / size
    p1 = _chi2_tail(float((((seen - n * share) ** 2) / (n * share)).sum()), slices - 1)
    high = x >= size / 2
    a, b = int(high.sum()), int((~high).sum())
    if a and b:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * a * b / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        p2 = math.erfc(abs(runs - mean) / math.sqrt(2 * var)) if var > 0 else 1.0
    else:
        p2 = 0.5 ** (n - 1)
    y = x - x.mean()
    power = float((y * y).sum())
    r = float((y[1:] * y[:-1]).sum()) / power if power else 1.0
    p3 = math.erfc(abs(r + 1 / n) * math.sqrt(n) / math.sqrt(2))
    tiny = 1e-300
    return _chi2_tail(-2 * sum(math.log(max(p, tiny)) for p in (p1, p2, p3)), 6), mixture(body, name)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(*m.span(), "assign") for m in re.finditer(ASSIGN, text, re.A) if len(m[2]) >= 12] if "=" in text or ":" in text else []
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in re.finditer(ACCESS, text) if m.end() - m.start() >= 18]
    # a run of 16 that starts at a run's start; shorter runs are passed over
    found += [(*m.span(), "hex") for m in re.finditer(r"(?<![0-9a-f])[0-9a-f]{16,}", text)]
    return found


def candidates(text: str, taken: list[tuple[int, int, str]]):
    """Spans of long mixed tokens that touch no known form, with p-values."""
    for m in re.finditer(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}", text):
        a, b = m.span()
        token = m[0]
        if not (any(c.isdigit() for c in token) and any(c.isalpha() for c in token)):
            continue
        if any(s < b and a < e for s, e, _ in taken):
            continue
        p = battery(token)
        if p is not None:
            yield a, b, *p


def _scan(batches):
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("p", pa.float64()), ("q", pa.float64())])
    for batch in batches:
        spans = []
        for text in batch.column("text").to_pylist():
            text = text or ""
            base = base_spans(text)
            rows = [{"start": a, "end": b, "kind": KINDS.index(k), "p": None, "q": None} for a, b, k in base]
            rows += [{"start": a, "end": b, "kind": 3, "p": p, "q": q} for a, b, p, q in candidates(text, base)]
            spans.append(rows)
        found = pa.array(spans, pa.list_(span))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], ["doc_id", "spans"])


def scan(documents: DataFrame, fdr: float = 0.05, id_column: str = "doc_id") -> DataFrame:
    """One row per document: `id_column` and spans, an array of (start, end, kind, p, q), by start then kind."""
    kind = documents.schema[id_column].dataType.simpleString()
    scanned = keep(
        documents.select(F.col(id_column).alias("doc_id"), "text").mapInArrow(
            _scan, f"doc_id {kind}, spans array<struct<start:int,end:int,kind:int,p:double,q:double>>"
        ),
        "secrets",
    )
    tested = scanned.select(F.explode(F.filter("spans", lambda s: s["p"].isNotNull())).alias("s")).select(
        (F.col("s.end") - F.col("s.start")).alias("n"), F.col("s.p").alias("p"), F.col("s.q").alias("q")
    )
    mean = tested.agg(F.avg(F.sqrt("n"))).first()[0] or 1.0

    def step(p: Column, n: Column) -> Column:
        """The step of a weighted p-value, small ones high."""
        at = F.least(F.floor(-F.log10(p * mean / F.sqrt(n) + F.lit(1e-25)) / STEP), F.lit(STEPS))
        return F.greatest(at, F.lit(0))

    def line(p: str) -> int:
        """From which step on p-values are rejected."""
        counts = {r[0]: r[1] for r in tested.groupBy(step(F.col(p), F.col("n")).alias("s")).count().collect()}
        total, above, found = sum(counts.values()), 0, STEPS + 1
        for s in range(STEPS, -1, -1):  # from the smallest p-values on
            above += counts.get(s, 0)
            if above and 10 ** (-s * STEP) <= fdr * above / total:
                found = s
        return found

    uneven, mixed = line("p"), line("q")

    def stays(s):
        n = s["end"] - s["start"]
        return s["p"].isNull() | ((step(s["p"], n) < uneven) & (step(s["q"], n) >= mixed))

    by_place = F.array_sort(
        F.transform(F.filter("spans", stays), lambda s: F.struct(s["start"], s["kind"], s["end"], s["p"], s["q"]))
    )
    names = F.array(*[F.lit(k) for k in KINDS])
    return scanned.select(
        F.col("doc_id").alias(id_column),
        F.transform(
            by_place,
            lambda s: F.struct(
                s["start"].alias("start"), s["end"].alias("end"), F.get(names, s["kind"]).alias("kind"), s["p"].alias("p"), s["q"].alias("q")
            ),
        ).alias("spans"),
    )
