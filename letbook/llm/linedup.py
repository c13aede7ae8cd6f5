"""Near-duplicate lines by a segment-partition edit join, in DataFrame operations only.

Lines of at least `min_chars` characters are grouped when at most so many single-character edits apart as the shorter
one's length allows (`max_edits`: one number, or pairs of a length and the edits from it on), and only the first line of
a group (smallest id, then place in the document) stays. Equal lines are one from the start. Of the rest, every line
is cut into its edits + 1 segments, at least one of which an edited copy still holds; each line looks its possible
substrings up among the segments of lines shorter by as many characters as edits, at the few places where a copy's
segment can be. Bitmaps of all segments, bounded in size, drop most of these substrings before anything is shuffled.
Lines that share a segment are compared by pieces of the part that did not match (one edit), in blocks that stay open by
which pairs of neighbours occur an odd number of times as well; Spark's own distance drops those too far apart, the banded
bit-parallel edit distance decides on the others, and links are grouped by connected components.

Defined cases: null and empty texts are one empty line, which stays; lines shorter than `min_chars` stay; a null id
comes first; rows with equal id and text are one document for the choice of the first line, so all of them keep it;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components, link_blocks
from .frames import keep, let
from .winnow import small

MIN_CHARS = 20
#: Edits by the length of the shorter line: as many as keep segment rows at about one for five characters.
MAX_EDITS = ((0, 1), (60, 2), (120, 3), (240, 4), (400, 5))
Edits = int | tuple[tuple[int, int], ...]


def edit_classes(max_edits: Edits) -> list[tuple[int, int | None, int]]:
    """(from length, up to but without length, edits) by rising length; the last one has no end."""
    steps = ((0, max_edits),) if isinstance(max_edits, int) else max_edits
    ends = [low for low, _ in steps[1:]] + [None]
    return [(low, end, edits) for (low, edits), end in zip(steps, ends, strict=True)]


def _least_length(min_chars: int, max_edits: Edits) -> int:
    return max(min_chars, 2 * edit_classes(max_edits)[0][2] + 2)


def _inside(length: Column, low: int, end: int | None) -> Column:
    return (length >= low) if end is None else (length >= low) & (length < end)


#: More than the probes of a class.
FORMS = 1000
#: Blocks are told apart by so many bits of a hash; pairs are verified anyway.
BLOCKS = 1 << 48
#: Bits that say which segments there are: 64 MB at most.
MOST_BITS = 1 << 29


def _probes(edits: int) -> list[tuple[int, int, int]]:
    """(length difference, segment, shift) of all substrings to look up; the line's own segments come with (0, i, 0)."""
    out = []
    for diff in range(edits + 1):
        for i in range(edits + 1):
            low, high = max(-i, diff - (edits - i)), min(i, diff + edits - i)
            out += [(diff, i, shift) for shift in range(low, high + 1)]
    return out


def segment_rows(lines: DataFrame, max_edits: Edits, own: bool) -> DataFrame:
    """(no, block, form) of lines (no, line): their own segments, or the substrings they look up among other lines'.

    A block names a segment's number, text and the length of its line; form is edits * FORMS + the number of the probe.
    The list of probes is a constant that rows are multiplied by, so that each is computed in compiled code.
    """
    n = F.col("n")
    lists = []
    for low, end, edits in edit_classes(max_edits):
        probes = [
            F.struct(
                F.lit(low).alias("low"),
                F.lit(2**31 - 1 if end is None else end).alias("end"),
                F.lit(edits).alias("edits"),
                F.lit(edits * FORMS + form).alias("form"),
                F.lit(diff).alias("diff"),
                F.lit(i).alias("i"),
                F.lit(shift).alias("shift"),
            )
            for form, (diff, i, shift) in enumerate(_probes(edits))
            if (diff == shift == 0) == own
        ]
        # a line looks for shorter ones of the class below, too
        here = _inside(n, low, None if end is None else end + edits)
        lists.append(F.when(here, F.array(*probes)).otherwise(F.slice(F.array(*probes), 1, 0)))
    # four bytes a character, so that a part is found without counting characters
    wide = F.encode("line", "UTF-32").alias("wide")
    made = lines.select("no", wide, F.length("line").alias("n")).select("no", "wide", "n", F.explode(F.concat(*lists)).alias("p"))
    target = n - F.col("p.diff")
    begin = F.floor(target * F.col("p.i") / (F.col("p.edits") + 1)).cast("int")
    size = F.floor(target * (F.col("p.i") + 1) / (F.col("p.edits") + 1)).cast("int") - begin
    part = F.substring("wide", (begin + F.col("p.shift")) * 4 + 1, size * 4)
    block = F.xxhash64(target, F.col("p.i"), part).bitwiseAND(F.lit(BLOCKS - 1))
    return made.where((target >= F.col("p.low")) & (target < F.col("p.end"))).select("no", block.alias("block"), F.col("p.form").alias("form"))


def _bitmap(block: Column, bits: int) -> tuple[Column, Column]:
    """Number of the 4 KB bitmap and the bit in it that stand for a block."""
    place = block.bitwiseAND(F.lit(bits - 1))
    return F.shiftright(place, 15).alias("bucket"), place.bitwiseAND(F.lit(32767)).cast("int")


def met_segments(segments: DataFrame, bits: int) -> DataFrame:
    """(bucket, words): bitmaps of all segments' blocks, as words of 64 bits; at most bits / 8 bytes together."""
    bucket, bit = _bitmap(F.col("block"), bits)
    maps = segments.select(bucket, bit.cast("long").alias("bit")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map"))
    word = lambda i: F.conv(F.hex(F.substring("map", i * 8 + 1, F.lit(8))), 16, -10).cast("long")
    return maps.select("bucket", F.transform(F.sequence(F.lit(0), F.lit(511)), word).alias("words"))


def segment_keys(lines: DataFrame, max_edits: Edits) -> DataFrame:
    """(no, block, form): all lines' segments, and of their probes those that some line has as a segment.

    Probes are told by bitmaps, whose size is bounded: a longer table lets more probes through that no segment meets.
    """
    segments = segment_rows(lines, max_edits, own=True)
    some = lines.count() * (edit_classes(max_edits)[-1][2] + 1) * 16
    bits = min(max(1 << some.bit_length(), 1 << 15), MOST_BITS)
    bucket, bit = _bitmap(F.col("block"), bits)
    probes = segment_rows(lines, max_edits, own=False).withColumns({"bucket": bucket, "bit": bit})
    # byte by byte from the lowest bit, the words from the highest byte
    in_word = 56 - (F.shiftright("bit", 3) % 8) * 8 + F.col("bit") % 8
    met = F.shiftright("bit", 6)
    hit = probes.join(F.broadcast(met_segments(segments, bits)), "bucket").where(F.bit_get(F.get("words", met), in_word) == 1)
    return segments.unionByName(hit.select("no", "block", "form"))


def odd_pairs(text: Column) -> Column:
    """Two words of 64 bits, by a hash of two neighbours, of those that occur an odd number of times.

    An edit changes four of the bits at most.
    """

    def step(s: Column, c: Column) -> Column:
        code = F.ascii(c)

        def put(place: Column) -> Column:
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)))
            return F.struct(
                code.bitwiseAND(F.lit(0xFFFF)).alias("last"),
                F.when(place < 64, s["low"].bitwiseXOR(bit)).otherwise(s["low"]).alias("low"),
                F.when(place < 64, s["high"]).otherwise(s["high"].bitwiseXOR(bit)).alias("high"),
            )

        return put((s["last"] * 31 + code * 17).bitwiseAND(F.lit(127)))

    zero = F.lit(0).cast("long")
    first = F.struct(F.lit(0).alias("last"), zero.alias("low"), zero.alias("high"))
    return F.aggregate(F.split(text, ""), first, step, lambda s: F.struct(s["low"].alias("low"), s["high"].alias("high")))


def _rest_pieces(text: Column, length: Column, form: Column, edits: int) -> Column:
    """For one edit: four 16-bit hashes of the half that did not match, counted from its start and from its end."""
    diff, at = F.lit(0), F.lit(0)
    for n, (d, i, _) in enumerate(_probes(edits)):
        diff, at = F.when(form == n, d).otherwise(diff), F.when(form == n, i).otherwise(at)
    target = length - diff
    half = F.floor(target / 2).cast("int")
    begin = F.when(at == 0, half).otherwise(0)
    size = F.when(at == 0, target - half).otherwise(half)

    def packed(offset: Column) -> Column:
        out = F.lit(0).cast("long")
        for k in range(4):
            a, b = F.floor(size * k / 4).cast("int"), F.floor(size * (k + 1) / 4).cast("int")
            h = F.xxhash64(F.substring(text, begin + offset + a + 1, b - a)).bitwiseAND(F.lit(0xFFFF))
            out = out.bitwiseOR(F.shiftleft(h, 16 * k))
        return out

    return F.struct(packed(F.lit(0)).alias("ahead"), packed(diff).alias("behind"))


def _one_edit_may(left: Column, right: Column) -> Column:
    """Pieces before some piece agree counted from the start, those after it counted from the end."""
    ahead, behind = left["ahead"].bitwiseXOR(right["ahead"]), left["behind"].bitwiseXOR(right["behind"])
    out = F.lit(False)
    for e in range(4):
        before = (1 << (16 * e)) - 1
        after = ((1 << 64) - 1) ^ ((1 << (16 * (e + 1))) - 1)
        after = after - (1 << 64) if after >= 1 << 63 else after
        out = out | ((ahead.bitwiseAND(F.lit(before)) == 0) & (behind.bitwiseAND(F.lit(after)) == 0))
    return out


def edit_distance(left: Column, right: Column, most: int) -> Column:
    """Edit distance up to `most` by bit vectors over a band of 2 * most + 1 diagonals; above it `most` + 1.

    Both texts need `most` characters at least.
    """
    k, top = most, 2 * most
    mask = (1 << (top + 1)) - 1
    invert = lambda x: x.bitwiseXOR(F.lit(mask))
    bit = lambda x, n: F.call_function("shiftright", x, n).bitwiseAND(F.lit(1)).cast("int")

    def distance(a: Column, b: Column) -> Column:
        m = F.size(a)

        def step(s: Column, c: Column) -> Column:
            same = F.lit(0)
            for d in range(top + 1):
                same = same + F.when(F.get(a, s["i"] + (d - k)) == c, 1 << d).otherwise(0)

            def carry(pm: Column) -> Column:
                vp, vn = s["vp"], s["vn"]
                d0 = (pm.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(pm).bitwiseOR(vn).bitwiseAND(F.lit(mask))
                return let(F.struct(d0.alias("d0"), vn.bitwiseOR(invert(d0.bitwiseOR(vp))).alias("hp")), after)

            def after(v: Column) -> Column:
                d0, hp = v["d0"], v["hp"]
                hn = d0.bitwiseAND(s["vp"])
                low = F.shiftright(d0, 1)
                left_over = s["i"] - (m - k)  # from 0 on once the band's lower edge has left the text
                at = F.greatest(F.lit(top - 1) - left_over, F.lit(0))
                change = F.when(left_over < 0, 1 - bit(d0, F.lit(top))).otherwise(bit(hp, at) - bit(hn, at))
                return F.struct(
                    (s["i"] + 1).alias("i"),
                    hn.bitwiseOR(invert(low.bitwiseOR(hp))).alias("vp"),
                    low.bitwiseAND(hp).alias("vn"),
                    (s["dist"] + change).alias("dist"),
                )

            return let(same, carry)

        first = F.struct(
            F.lit(0).alias("i"),
            F.lit(mask ^ ((1 << k) - 1)).alias("vp"),
            F.lit(0).alias("vn"),
            F.lit(k).alias("dist"),
        )
        return F.aggregate(b, first, step, lambda s: F.least(s["dist"], F.lit(most + 1)))

    pair = let(
        F.struct(F.split(left, "").alias("a"), F.split(right, "").alias("b")), lambda p: distance(p["a"], p["b"])
    )
    return F.when(F.abs(F.length(left) - F.length(right)) > most, most + 1).otherwise(pair)


def _same(parts: Callable, most: Column) -> Column:
    """How many characters two texts have alike, `most` at the most, found by halving steps; parts(at, size) are compared."""

    def step(at: Column, size: Column) -> Column:
        left, right = parts(at, size)
        return F.when((at + size <= most) & (left == right), at + size).otherwise(at)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(17, -1, -1)]), F.lit(0), step)


def core(left: Column, right: Column, most: int) -> Column:
    """(left, right) without what they begin and end with alike, which no distance depends on; 2 * `most` characters stay."""

    def cut(t: Column) -> Column:
        spare = F.least(t["n"], t["m"]) - 2 * most

        def inside(start: Column, end: Column) -> Column:
            return F.struct(
                F.substring(t["left"], start + 1, t["n"] - start - end).alias("left"),
                F.substring(t["right"], start + 1, t["m"] - start - end).alias("right"),
            )

        ahead = lambda at, size: (F.substring(t["left"], at + 1, size), F.substring(t["right"], at + 1, size))
        behind = lambda at, size: (
            F.substring(t["left"], t["n"] - at - size + 1, size),
            F.substring(t["right"], t["m"] - at - size + 1, size),
        )
        return let(_same(ahead, spare), lambda start: let(_same(behind, spare - start), lambda end: inside(start, end)))

    return let(F.struct(left.alias("left"), right.alias("right"), F.length(left).alias("n"), F.length(right).alias("m")), cut)


def _allowed(shorter: Column, max_edits: Edits) -> Column:
    out = F
    for low, end, edits in edit_classes(max_edits):
        out = out.when(_inside(shorter, low, end), edits)
    return out.otherwise(-1)


def few_edits(left: Column, right: Column, max_edits: Edits) -> Column:
    """Whether Spark's distance, which is compiled, is as small as the shorter line's length allows."""
    top = edit_classes(max_edits)[-1][2]
    allowed = _allowed(F.least(F.length(left), F.length(right)), max_edits)
    # -1, which stands for more than the most, counts as one more; the distance is written once, as a join computes it as often
    return F.pmod(F.levenshtein(left, right, top), F.lit(top + 2)) <= allowed


def within_edits(left: Column, right: Column, max_edits: Edits) -> Column:
    """Whether two lines are as few edits apart as the shorter one's length allows, by bit vectors.

    Pairs too far apart are dropped before. Lines long enough for the widest band all take that one.
    """
    classes = edit_classes(max_edits)
    top = classes[-1][2]
    shorter = F.least(F.length(left), F.length(right))

    def near(band: int) -> Column:
        return let(core(left, right, band), lambda c: edit_distance(c["left"], c["right"], band) <= _allowed(shorter, max_edits))

    out = F.when(~few_edits(left, right, max_edits), False)
    for low, end, edits in classes:
        if edits < top and low < 2 * top:
            out = out.when(_inside(shorter, low, end), near(edits))
    return out.otherwise(near(top))


#: Two hashes that together name a line.
IDENTITY = ("line_id", "line_id2")


def _identity(line: str) -> list[Column]:
    return [F.xxhash64(line).alias("line_id"), F.xxhash64(F.lit("second"), line).alias("line_id2")]


def _occurrences(documents: DataFrame, id_column: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(
        F.col(id_column).alias("doc_id"), F.xxhash64(text).alias("name"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line")
    )


def line_classes(
    documents: DataFrame, min_chars: int = MIN_CHARS, max_edits: Edits = MAX_EDITS, id_column: str = "doc_id"
) -> DataFrame:
    """(line_id, line_id2, n, first, class): every distinct long line, its count, its first place and its group's number."""
    lines = keep(
        _occurrences(documents, id_column)
        .where(F.length("line") >= _least_length(min_chars, max_edits))
        .groupBy(*_identity("line"))
        .agg(F.first("line").alias("line"), F.min(F.struct("doc_id", "pos")).alias("first"), F.count("*").alias("n"))
        .withColumn("no", F.monotonically_increasing_id()),
        "lines",
    )
    keys = keep(segment_keys(lines.select("no", "line"), max_edits).withColumnRenamed("no", "id"), "keys")
    shared = keys.groupBy("block").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    members = keep(keys.join(shared.select("block"), "block"), "members")
    texts = keep(
        lines.select(F.col("no").alias("id"), "line")
        .join(small(members.select("id").distinct()), "id", "left_semi"),
        "texts",
    )
    edits, form = F.floor(F.col("form") / FORMS).cast("int"), F.col("form") % FORMS
    pieces = _rest_pieces(F.col("line"), F.length("line"), form, 1)
    info = F.struct(F.length("line").alias("n"), edits.alias("edits"), F.when(edits == 1, pieces).alias("pieces"))
    blocks = keep(members.join(texts, "id").select("block", "id", info.alias("info")).distinct(), "blocks")

    def may(left: Column, right: Column) -> Column:
        """A block is of one class, so both have the same edits."""
        close = F.abs(left["n"] - right["n"]) <= left["edits"]
        return close & ((left["edits"] > 1) | _one_edit_may(left["pieces"], right["pieces"]))

    def sketches(ids: DataFrame) -> DataFrame:
        sketch = F.struct(F.length("line").alias("n"), odd_pairs(F.col("line")).alias("odd"))
        return texts.join(ids, "id", "left_semi").select("id", sketch.alias("info"))

    def closer(left: Column, right: Column) -> Column:
        allowed = _allowed(F.least(left["n"], right["n"]), max_edits)
        apart = sum((F.bit_count(left["odd"][w].bitwiseXOR(right["odd"][w])) for w in ("low", "high")), F.lit(0))
        return (F.abs(left["n"] - right["n"]) <= allowed) & (apart <= 4 * allowed)

    def verify(pairs: DataFrame) -> DataFrame:
        a = texts.select(F.col("id").alias("a"), F.col("line").alias("left"))
        b = texts.select(F.col("id").alias("b"), F.col("line").alias("right"))
        both = pairs.join(a, "a").join(b, "b")
        return both.where(within_edits(F.col("left"), F.col("right"), max_edits)).select("a", "b")

    near = (texts.withColumnRenamed("line", "whole"), lambda left, right: few_edits(left, right, max_edits))
    label = components(link_blocks(blocks, verify, may, (sketches, closer), near, rounds=2)).withColumnRenamed("id", "no")
    grouped = lines.drop("line").join(label, "no", "left").withColumn("class", F.coalesce("label", "no"))
    return grouped.select(*IDENTITY, "n", "first", "class")


def removed_lines(
    documents: DataFrame, min_chars: int = MIN_CHARS, max_edits: Edits = MAX_EDITS, id_column: str = "doc_id"
) -> DataFrame:
    """(doc_id, name, removed): places of the lines that go, for documents that lose any; name is the text's hash."""
    classes = keep(line_classes(documents, min_chars, max_edits, id_column), "classes")
    groups = classes.groupBy("class").agg(F.min("first").alias("first"), F.sum("n").alias("n")).where("n > 1")
    repeated = classes.select(*IDENTITY, "class").join(groups.select("class", "first"), "class").drop("class")
    return (
        _occurrences(documents, id_column)
        .where(F.length("line") >= _least_length(min_chars, max_edits))
        .select("doc_id", "name", "pos", *_identity("line"))
        .join(repeated, list(IDENTITY))
        .where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("pos") == F.col("first.pos"))))
        .groupBy("doc_id", "name")
        .agg(F.array_sort(F.collect_set("pos")).alias("removed"))
    )


def deduplicate(
    documents: DataFrame,
    min_chars: int = MIN_CHARS,
    max_edits: Edits = MAX_EDITS,
    id_column: str = "doc_id",
    removed: str = "removed",
) -> DataFrame:
    """The documents, every column, with `text` without the removed lines, and `removed` (array of places, or null).

    A column of that name is replaced; give another name where it clashes.
    """
    gone = removed_lines(documents, min_chars, max_edits, id_column).select(
        F.col("doc_id").alias("gone id"), F.col("name").alias("gone name"), F.col("removed").alias("gone lines")
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    left = F.array_join(
        F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains("gone lines", i)), "\n"
    )
    joined = documents.join(
        gone, F.col(id_column).eqNullSafe(F.col("gone id")) & (F.xxhash64(text) == F.col("gone name")), "left"
    )
    return (
        joined.withColumn("text", F.when(F.col("gone lines").isNull(), F.col("text")).otherwise(left))
        .withColumn(removed, F.col("gone lines"))
        .drop("gone id", "gone name", "gone lines")
    )
