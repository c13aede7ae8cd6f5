"""HTML reading with native regular expressions: no parser, no Python in the tasks.

Layouts that do not match give NULL rather than an error.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from letbook.fixed import TOTAL_CLASS
from letbook.functions.text import strip

# A character that HTML does not allow. Cutting at one plain character is far cheaper than
# cutting at a pattern, which Spark compiles anew for every value.
_CUT = "\x00"
# The rest of a tag: a `>` inside quotes does not end it. A quote opens a value only after an equals sign.
_REST = r"""[^>=]*+(?:=\s*+(?:"[^"]*"|'[^']*'|["']?)[^>=]*+)*+"""
_SOME = r"""[^>=]*?(?:=\s*(?:"[^"]*"|'[^']*'|(?!["'\s]))[^>=]*?)*?"""
# Names with their semicolon, and the old ones that need none.
_NAMED = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
# The names that pages use most; looking a name up takes as long as the list.
_USUAL = {n: _NAMED[n] for n in "amp lt gt quot apos nbsp pound euro copy reg trade hellip ndash mdash lsquo rsquo ldquo rdquo bull middot".split()}
_BARE = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
_ENTITY = "&(?:#[0-9]|#[xX][0-9a-fA-F]|[A-Za-z])"
# Numbers that stand for characters of another code page.
_WINDOWS = {n: t for n in range(0x80, 0xA0) if (t := bytes([n]).decode("cp1252", "ignore"))}


def _let(value: Column, use) -> Column:
    """use(x) with x bound to the value, which is then computed once."""
    return F.transform(F.array(value), use)[0]


def _text_map(pairs: dict[str, str]) -> Column:
    """A constant map, given as one text, which keeps plans small."""
    joined = "\x02".join(f"{name}\x01{text}" for name, text in sorted(pairs.items()))
    return F.str_to_map(F.lit(joined), F.lit("\x02"), F.lit("\x01"))


def opening(tag: str, token: str | None = None) -> str:
    """Pattern of an opening tag, if asked for with a class token (case counts in the token)."""
    if token is None:
        return rf"<(?i:{tag})(?=[\s>/]){_REST}>"
    has_class = (
        rf"(?={_SOME}\s(?i:class)\s*=\s*(?:"
        rf'"(?:[^"]*\s)?{token}(?:\s[^"]*)?"'
        rf"|'(?:[^']*\s)?{token}(?:\s[^']*)?'"
        rf"|{token}(?=[\s>])))"
    )
    return rf"<(?i:{tag})(?=\s){has_class}{_REST}>"


def balanced(markup: Column, tag: str) -> Column:
    """The element that begins the markup, its own tag nested as deep as it may be.

    The markup is cut in front of the tag's opening and closing marks, which are counted. An
    element that is not closed goes to the end of the markup. Elements without their own tag
    inside, which most are, take one pattern.
    """
    name = rf"(?i:{tag})(?=[\s>/])"
    whole = rf"^<{name}{_REST}>[^<]*+(?:<(?!/?{name})[^<]*+)*+</(?i:{tag})\s*+>"
    # regexp_substr would match twice here: once to compare with the empty text
    flat = _let(F.regexp_extract(markup, whole, 0), lambda found: F.when(found != "", found))
    marked = F.regexp_replace(markup, rf"(?=</?(?i:{tag})(?=[\s>/]){_REST}>)", _CUT)

    def close(pieces: Column) -> Column:
        def count(s: Column, piece: Column) -> Column:
            change = F.when(s["at"] == 0, 0).when(piece.startswith("</"), -1).otherwise(1)
            depth = s["depth"] + change
            closed = (s["end"] == 0) & (s["at"] > 0) & (depth == 0)
            return F.struct(
                (s["at"] + 1).alias("at"),
                depth.alias("depth"),
                F.when(closed, s["at"]).otherwise(s["end"]).alias("end"),
            )

        zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(0).alias("end"))
        end = F.aggregate(pieces, zero, count, lambda s: s["end"])
        inside = lambda n: F.concat(F.array_join(F.slice(pieces, 1, n), ""), F.lit(f"</{tag}>"))
        return _let(end, lambda n: F.when(n > 0, inside(n)))

    return F.coalesce(flat, _let(F.split(marked, _CUT), close), markup)


def visible(html: Column) -> Column:
    """The page without comments, scripts, styles and the cutting character."""
    hidden = r"(?s)<(?:!--.*?-->|(?i:(script|style)(?=[\s>])[^>]*>.*?</\1\s*>))"
    return F.regexp_replace(F.replace(html, F.lit(_CUT), F.lit("")), hidden, "")


def unescape(text: Column, in_attribute: bool = False) -> Column:
    """Entities resolved in one pass, so that `&amp;lt;` becomes `&lt;`.

    Old names need no semicolon, but in an attribute, where `&copy=1` is part of a link, they do
    when a letter, a digit or an equals sign follows.
    """
    guard = "(?![A-Za-z0-9=])" if in_attribute else ""
    bare = f"^&({'|'.join(_BARE)}){guard}"
    usual, named, legacy = _text_map(_USUAL), _text_map(_NAMED), _text_map({n: html5[n] for n in _BARE})
    windows = F.create_map(*[F.lit(x) for pair in sorted(_WINDOWS.items()) for x in pair])
    unknown = F.lit("\ufffd")

    def char(code: Column) -> Column:
        real = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        known = F.coalesce(F.try_element_at(windows, code), F.when(code > 0, real))
        return F.when((code < 0x110000) & ~code.between(0xD800, 0xDFFF), known)

    def numbered(piece: Column, found: Column) -> Column:
        digits = F.ltrim(F.regexp_replace(found, "^&#[xX]?|;$", ""), F.lit("0"))
        code = F.when(found.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("int")
        short = F.when(F.length(digits) < 8, char(code))
        return F.concat(F.coalesce(short, unknown), F.substr(piece, F.length(found) + 1))

    def worded(piece: Column) -> Column:
        name = F.regexp_extract(piece, "^&([A-Za-z][A-Za-z0-9]*);", 1)
        old = F.regexp_extract(piece, bare, 1)
        return F.coalesce(
            F.concat(F.coalesce(F.try_element_at(usual, name), F.try_element_at(named, name)), F.substr(piece, F.length(name) + 3)),
            F.concat(F.try_element_at(legacy, old), F.substr(piece, F.length(old) + 2)),
            piece,
        )

    def resolve(piece: Column) -> Column:
        found = F.regexp_extract(piece, "^&#(?:[0-9]+|[xX][0-9a-fA-F]+);?", 0)
        return (
            F.when(found != "", numbered(piece, found)).when(piece.rlike("^&[A-Za-z]"), worded(piece)).otherwise(piece)
        )

    # cut in front of each entity, a piece has at most one, at its start
    pieces = F.split(F.regexp_replace(text, f"({_ENTITY})", f"{_CUT}$1"), _CUT)
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, resolve), "")).otherwise(text)


def inner_text(markup: Column, joiner: str = "") -> Column:
    """Text parts between the tags, each stripped, empty ones left out, joined."""
    pieces = F.split(F.regexp_replace(markup, rf"</?[A-Za-z!]{_REST}>", _CUT), _CUT)
    parts = F.transform(pieces, lambda p: strip(unescape(p)))
    return F.array_join(F.filter(parts, lambda p: p != ""), joiner)


def element_markup(html: Column, tag: str, token: str | None = None) -> Column:
    """The first element with this tag and class token, or NULL."""
    at = F.regexp_instr(html, F.lit(opening(tag, token)))
    return _let(F.when(at > 0, F.substr(html, at)), lambda rest: balanced(rest, tag))


def element_text(html: Column, tag: str, token: str | None = None, joiner: str = "") -> Column:
    return inner_text(element_markup(html, tag, token), joiner)


def attribute(markup: Column, name: str) -> Column:
    """Value of an attribute in an opening tag; NULL when absent, empty text when empty."""
    pattern = rf"""(?s)^<{_SOME}\s(?i:{name})\s*=\s*(["']?)((?<=")[^"]*|(?<=')[^']*|[^\s>"'][^\s>]*)"""
    return unescape(F.get(F.regexp_extract_all(markup, F.lit(pattern), F.lit(2)), F.lit(0)), in_attribute=True)


def opening_tag(html: Column, tag: str, token: str | None = None) -> Column:
    return F.regexp_substr(html, F.lit(opening(tag, token)))


def blocks(html: Column, tag: str, token: str | None = None) -> Column:
    """Array with one piece of markup per element that has this tag and class token.

    The page is cut in front of every opening tag, so an element inside another one gets
    its own piece. A piece ends with its element when that is closed within it.
    """
    marked = F.regexp_replace(html, f"({opening(tag, token)})", f"{_CUT}$1")
    # what comes before the first mark is no element
    pieces = F.split(marked, _CUT)
    return F.transform(F.filter(pieces, lambda p, i: i > 0), lambda p: balanced(p, tag))


def result_total(page: Column) -> Column:
    """Second bold number of the navigation line, thousands separators cut; NULL when missing."""
    line = element_markup(page, "p", TOTAL_CLASS)
    return F.replace(inner_text(F.get(blocks(line, "strong"), F.lit(1))), F.lit(","), F.lit("")).try_cast("bigint")
