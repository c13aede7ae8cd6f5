"""Main text of HTML pages: words score positive, tags negative, and the best contiguous region is the content.

A page becomes a row of words and tags. Elements that are never content (menus, headers, footers, sidebars, notices,
adverts, forms, scripts, reader comments; by element name, role, class or id) are neutral and give no text. Everything
else gets a weight, and a linear scan finds the contiguous region of the highest sum; the blocks of the smallest element around it are the text.

The weights come from labelled pages: pages that mark their content by an article or main element themselves. A tag's
weight is the log ratio of its places outside and inside the marked content, times one factor that is chosen so that
regions of the labelled pages, found without looking at the mark, agree best with it. About `fit_pages` such pages are
read for it, chosen by a hash of their html; pages longer than `fit_chars` are left out of the fit, never of the
extraction. A page that marks its content is scored by what the labels say of marked places: words inside count,
words outside hardly do, tags outside weigh the most.

Text: character references are decoded, white space inside a block is one space (a br is white space), blocks are
joined by one new line. Headers inside an article keep their headings.

Defined cases: null or empty html, and pages without words, give an empty text; broken, unclosed and truncated markup
is read as browsers roughly do; equal regions: the first one counts; without labelled pages tags weigh what is
assumed of prose and other elements; repeated
rows and null ids give a row each; an empty table gives no rows; other columns are ignored unless they are asked for.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field
from math import log1p

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Element names of HTML, by their part in a page.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img nobr".split()
)
NEVER = frozenset(
    "head nav aside footer header form noscript template button select dialog menu object svg canvas audio video "
    "fieldset script style textarea title xmp iframe noembed noframes".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Not shown, or not a block: text goes on around them.
UNSEEN = frozenset("br script style template noscript link meta base".split())
OF_HEAD = frozenset("base basefont link meta noscript script style template title".split())
#: A start tag of a key ends an open element of the value.
ENDS = {"li": "li", "dt": "dd", "dd": "dt", "tr": "tr", "td": "td", "th": "td", "option": "option"}
#: Taken to be inside content more often than not, before any page is seen.
PROSE = HEADINGS | frozenset("p br b i em strong q blockquote pre".split())
HOLDERS = frozenset("div section ul ol li dl table tr td p span article figure details center blockquote".split())
NEVER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split()
)
#: Parts of class names and ids of what is not content.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar aside "
    "nav navbar navigation menu topbar breadcrumb breadcrumbs pagination pager toolbar header masthead footer cookie "
    "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "comment comments disqus reply replies respond related recommended recommendations share sharing social widget widgets".split()
)
COMMENTS = frozenset("comment comments disqus reply replies respond".split())
#: Class names that only speak of a hint, or name the head of an article.
SPEAKS = frozenset("has with no without layout page free enabled open".split())
OF_ARTICLE = frozenset("article entry post content story main".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>=]+|=)*+)>|[^<]+|<", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

FACTORS = (0.5, 1.0, 2.0, 4.0, 8.0)
USUAL = 2.0
MOST = 4.0
LITTLE = 1e-6


def speaks_of(names: str, hints: frozenset[str]) -> bool:
    """Whether a class or id value names something by a hint as its first or last part."""
    for name in names.split():
        parts = [p.lower() for p in _PARTS.findall(name)]
        if not parts:
            continue
        last = parts[-1] in hints and not SPEAKS.intersection(parts) and not (parts[-1] == "header" and OF_ARTICLE.intersection(parts))
        if last or (parts[0] in hints and parts[-1] not in SPEAKS):
            return True
    return False


def _never(name: str, attributes: str) -> bool:
    """Whether the attributes say that an element is not content."""
    if not attributes or attributes.isspace():
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values)
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "role" and value.lower() in NEVER_ROLES:
            return True
        if key == "style" and "display:none" in value.replace(" ", "").lower():
            return True
        if key in ("class", "id") and name in HOLDERS and speaks_of(value, COMMENTS if name == "article" else HINTS):
            return True
    return False


@dataclass
class Page:
    """Words and tags in order: name of a tag or "" for text, text, number of its block, whether it counts, marks (1 article, 2 main)."""

    names: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    blocks: list[int] = field(default_factory=list)
    counts: list[bool] = field(default_factory=list)
    marks: list[int] = field(default_factory=list)
    #: Places between which a block element of a page's body lies.
    spans: list[tuple[int, int]] = field(default_factory=list)

    def add(self, name: str, text: str, block: int, counts: bool, mark: int) -> None:
        self.names.append(name)
        self.texts.append(text)
        self.blocks.append(block)
        self.counts.append(counts)
        self.marks.append(mark)


def read(source: str) -> Page:
    """The page's words and tags."""
    page, block, pos = Page(), 0, 0
    stack: list[tuple[str, bool, int, int]] = []  # name, whether content ended with it, marks before it, its place
    open_names: Counter[str] = Counter()
    never = mark = heading = soft = 0  # depth of elements that are not content; in a heading; in an article's header
    end = source.rfind(">") + 1
    lowered = None

    def pop() -> None:
        nonlocal never, mark, heading, soft
        name, was_never, before, begin = stack.pop()
        if not never and name not in INLINE and name not in ("html", "body"):
            page.spans.append((begin, len(page.names)))
        open_names[name] -= 1
        never -= was_never
        mark = before
        heading -= name in HEADINGS
        soft -= name == "header" and not was_never

    while pos < end:
        token = _TOKEN.match(source, pos, end)
        pos = token.end()
        name = (token[2] or "").lower()
        if not name:
            if token[0][:2] not in ("<!", "<?"):
                page.add("", token[0], block, not never and not (soft and not heading), mark)
            elif token[0].startswith("<!--") and not token[0].endswith("-->"):
                pos = len(source)
            continue
        inline = name in INLINE
        if not inline and name not in UNSEEN and (not token[1] or open_names[name] or name == "p"):
            block += 1
        if token[1]:
            if open_names[name] and not (inline and _block_above(stack, name)):
                while stack[-1][0] != name:
                    pop()
                outer = stack[-1][2]
                pop()
                page.add("/" + name, "", block, not never, outer)
            continue
        if not inline:
            if open_names["p"] and name not in VOID:
                _end(stack, "p", pop)
            if open_names["head"] and name not in OF_HEAD:
                while open_names["head"]:
                    pop()
            if name in ENDS:
                _end(stack, name, pop)
                _end(stack, ENDS[name], pop)
        page.add(name, " " if name == "br" else "", block, not never, mark)
        if name in RAW:
            lowered = lowered or source.lower()
            close = lowered.find("</" + name, pos) if len(lowered) == len(source) else source.find("</" + name, pos)
            pos = len(source) if close < 0 else (source.find(">", close) + 1 or len(source))
        elif name not in VOID:
            in_article = name == "header" and mark & 1
            gone = (name in NEVER and not in_article) or (name not in ("html", "body", "main") and _never(name, token[3]))
            stack.append((name, bool(gone), mark, len(page.names) - 1))
            open_names[name] += 1
            never += bool(gone)
            heading += name in HEADINGS
            soft += name == "header" and not gone
            if not never:
                mark |= {"article": 1, "main": 2}.get(name, 0)
    rest = re.split(r"<[A-Za-z/!?]", source[max(pos, end) :], maxsplit=1)[0]
    if rest:
        page.add("", rest, block, not never and not (soft and not heading), mark)
    while stack:
        pop()
    return page


def _block_above(stack: list[tuple[str, bool, int, int]], name: str) -> bool:
    """Whether a block lies open inside the inline element."""
    for open_name, *_ in reversed(stack):
        if open_name == name:
            return False
        if open_name not in INLINE:
            return True
    return True


def _end(stack: list[tuple[str, bool, int, int]], name: str, pop) -> None:
    """End the element if only inline elements are open inside it."""
    for depth, (open_name, *_) in enumerate(reversed(stack)):
        if open_name == name:
            for _ in range(depth + 1):
                pop()
            return
        if open_name not in INLINE:
            return


@dataclass(frozen=True)
class Weights:
    """Places of tags inside and outside marked content, and the factor on their log ratio."""

    inside: dict[str, int] = field(default_factory=dict)
    outside: dict[str, int] = field(default_factory=dict)
    factor: float = USUAL

    def tag(self, name: str) -> float:
        name = name.lstrip("/")
        inside = self.inside.get(name, 0) + (5.0 if name in PROSE else 0.5)
        return -self.factor * min(MOST, log1p((self.outside.get(name, 0) + 0.5) / inside))


def marked(page: Page) -> int:
    """The mark that says where content is: 1 article, 2 main, 0 none that holds a word."""
    found = 0
    for name, text, counts, mark in zip(page.names, page.texts, page.counts, page.marks, strict=True):
        if not name and counts and mark and not text.isspace():
            found |= mark
            if found & 1:
                return 1
    return found


def scores(page: Page, weights: Weights, mark: int) -> list[float]:
    """Weight of every word run and tag; mark 0: by the tags alone."""
    known: dict[str, float] = {}
    out = []
    for name, text, counts, where in zip(page.names, page.texts, page.counts, page.marks, strict=True):
        if not counts:
            out.append(0.0)
        elif not name:
            out.append(len(text.split()) * (1.0 if not mark or where & mark else LITTLE))
        elif mark:
            out.append(-LITTLE if where & mark else -MOST * weights.factor)
        else:
            if name not in known:
                known[name] = weights.tag(name)
            out.append(known[name])
    return out


def best_region(values: list[float]) -> tuple[int, int]:
    """(begin, end) of the contiguous run of the highest sum, the first and shortest such; empty if none is positive."""
    best, region, total, begin = 0.0, (0, 0), 0.0, 0
    for i, value in enumerate(values):
        if total <= 0:
            total, begin = 0.0, i
        total += value
        if total > best:
            best, region = total, (begin, i + 1)
    return region


def widened(page: Page, region: tuple[int, int]) -> tuple[int, int]:
    """The smallest block element around a region, if any is around it, so that its short ends are not lost."""
    around = [s for s in page.spans if s[0] <= region[0] and region[1] <= s[1]]
    return min(around, key=lambda s: s[1] - s[0], default=region) if region[1] else region


def text_of(page: Page, region: tuple[int, int]) -> str:
    """The blocks that a region touches."""
    touched = {b for n, b, c in zip(*(x[slice(*region)] for x in (page.names, page.blocks, page.counts)), strict=True) if c and not n}
    blocks: dict[int, list[str]] = {}
    for name, text, block, counts in zip(page.names, page.texts, page.blocks, page.counts, strict=True):
        if counts and block in touched and (not name or text):
            blocks.setdefault(block, []).append(text)
    lines = (" ".join(html.unescape("".join(parts)).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def main_text(source: str | None, weights: Weights) -> str:
    page = read(source or "")
    return text_of(page, widened(page, best_region(scores(page, weights, marked(page)))))


def _counts(batches):
    """Per batch: places of each known tag inside and outside the marks of labelled pages."""
    for batch in batches:
        inside, outside = Counter(), Counter()
        for source in batch.column("html").to_pylist():
            page = read(source)
            mark = marked(page)
            if mark:
                for name, where in zip(page.names, page.marks, strict=True):
                    if name and name[0] != "/":
                        (inside if where & mark else outside)[name if name in _KNOWN else "other"] += 1
        names = sorted({*inside, *outside})
        yield pa.RecordBatch.from_pydict(
            {"name": names, "inside": [inside[n] for n in names], "outside": [outside[n] for n in names]}, _COUNTS
        )


_KNOWN = VOID | INLINE | NEVER | HEADINGS | HOLDERS | frozenset("html body main p pre hr dt dd th thead tbody tfoot caption figcaption address summary".split())
_COUNTS = pa.schema([("name", pa.string()), ("inside", pa.int64()), ("outside", pa.int64())])
_AGREEMENT = pa.schema([("factor", pa.float64()), ("both", pa.int64()), ("either", pa.int64())])


def _agreement(weights: Weights):
    """Per batch and factor: words both in the region found without the mark and in the mark, and words in either."""

    def run(batches):
        for batch in batches:
            both, either = Counter(), Counter()
            for source in batch.column("html").to_pylist():
                page = read(source)
                mark = marked(page)
                if not mark:
                    continue
                words = [len(t.split()) if c and not n else 0 for n, t, c in zip(page.names, page.texts, page.counts, strict=True)]
                for factor in FACTORS:
                    low, high = best_region(scores(page, Weights(weights.inside, weights.outside, factor), 0))
                    for i, (n, where) in enumerate(zip(words, page.marks, strict=True)):
                        found, labelled = low <= i < high, bool(where & mark)
                        both[factor] += n * (found and labelled)
                        either[factor] += n * (found or labelled)
            yield pa.RecordBatch.from_pydict(
                {"factor": list(FACTORS), "both": [both[f] for f in FACTORS], "either": [either[f] for f in FACTORS]}, _AGREEMENT
            )

    return run


def fit(pages: DataFrame, fit_pages: int = 1000, fit_chars: int = 200_000) -> Weights:
    """Weights from the pages that mark their content; see the module for the bounds."""
    usable = pages.where(F.lower("html").rlike("<(article|main)[\\s>]") & (F.length("html") <= fit_chars)).select("html")
    rate = min(1.0, fit_pages / max(1, usable.count()))
    sample = usable.where(F.pmod(F.xxhash64("html", F.lit("fit")), F.lit(1_000_000)) < int(rate * 1e6))
    counted = sample.mapInArrow(_counts, "name string, inside long, outside long").groupBy("name").agg(F.sum("inside"), F.sum("outside"))
    rows = counted.collect()  # one per known tag name
    weights = Weights({r[0]: r[1] for r in rows}, {r[0]: r[2] for r in rows})
    agreed = (
        sample.mapInArrow(_agreement(weights), "factor double, both long, either long")
        .groupBy("factor")
        .agg((F.sum("both") / F.greatest(F.sum("either"), F.lit(1))).alias("share"))
        .collect()  # one per factor
    )
    best = max(agreed, key=lambda r: (r["share"], -abs(r["factor"] - USUAL)), default=None)
    return weights if best is None else Weights(weights.inside, weights.outside, best["factor"])


def extract(pages: DataFrame, weights: Weights, *keep: str) -> DataFrame:
    """The pages' columns `keep`, then text and n_chars."""
    fields = list(keep)
    schema = pages.select(*fields).schema.add("text", "string").add("n_chars", "long")

    def run(batches):
        for batch in batches:
            texts = [main_text(source, weights) for source in batch.column(batch.num_columns - 1).to_pylist()]
            arrays = [batch.column(i) for i in range(len(fields))]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.string()), sizes], [*fields, "text", "n_chars"])

    return pages.select(*fields, F.col("html").alias("html read")).mapInArrow(run, schema)
