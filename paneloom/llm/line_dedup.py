"""Line dedup by a segment-partition edit join, on DataFrame functions only.

Lines (ends trimmed) that are equal, or of at least ``MIN_CHARS`` code points and within
``threshold`` edits, are linked; of each linked class the first line stays, by doc_id (null last),
then position. A line is cut into threshold + 1 segments, one of which survives so few edits:
segment hashes with the line's length form the index, and each line probes it with the substrings that
segments of its own and slightly shorter lengths can have moved to. A hash that only one line has is dropped by
a mergeable aggregate before lines meet. An edit changes the counts of letters by two at most, so pairs
whose counts are further apart never leave the join. Candidates are verified by an edit
distance kept in the bits of one long, a band of 2 * threshold + 1 diagonals.

Lines are made distinct before the join by a mergeable aggregate, so a line in a third of all
documents is one row. Texts don't move for it: only hashes do, and the texts of lines whose hashes meet, which
a bitmap of fixed size (4 MB) picks out before the exchange; letters are counted in these alone.

Definitions: null texts count as empty; blank lines stay; repeated rows (same id and text) are one
document and get the same result; extra columns stay. Lines end at line feeds alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom.llm.common import components, own_names, text_of
from paneloom.session import materialise

THRESHOLD = 2
MIN_CHARS = 10  # two edits are at most a fifth; shorter lines are compared for equality only
_BITS = 1 << 24
_LETTERS = "abcdefghijklmnopqrstuvwxyz"  # counted modulo 4, two bits each


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, doc_hash (they name a document), line_no, line (trimmed), line_key; blank lines left out."""
    text = text_of(text_col)
    return (
        docs.select(
            F.col(id_col).cast("long").alias("doc"),
            F.xxhash64(text).alias("doc_hash"),
            F.posexplode(F.split(text, "\n")).alias("line_no", "raw"),
        )
        .select("doc", "doc_hash", "line_no", _trimmed("raw").alias("line"))
        .where("line <> ''")
        .withColumn("line_key", F.unhex(F.md5("line")))
    )


def _trimmed(raw: str) -> Column:
    """``raw`` without blanks at its ends; trimming walks the whole line, so only lines that need it are."""
    needs = [
        end(raw, F.lit(blank)) for blank in (" ", "\t", "\r") for end in (F.startswith, F.endswith)
    ]
    trimmed = F.trim(raw, F.lit(" \t\r"))
    return F.when(reduce(lambda a, b: a | b, needs), trimmed).otherwise(F.col(raw))


def with_cuts(lines: DataFrame, threshold: int) -> DataFrame:
    """``lines`` with ``wide``, the line in four bytes a character, so that cutting it needs no walk over
    characters, ``chars``, their number, and the places where segments of its own and shorter
    lengths meet, all computed once."""
    parts = threshold + 1
    return (
        lines.withColumn("wide", F.encode("line", "UTF-32"))
        .withColumn("chars", F.shiftright(F.octet_length("wide"), 2))
        .withColumns(
            {
                f"cut{gap}_{i}": F.floor((F.col("chars") - gap) * i / parts).cast("int")
                for gap in range(threshold + 1)
                for i in range(1, parts)
            }
        )
    )


def probes(threshold: int) -> list[tuple[bool, Column]]:
    """Hashes of the substrings that a line of :func:`with_cuts` looks up, and whether each is one of
    its own segments.

    A substring is looked up where both the edits left of it and those right of it can be few enough.
    """
    parts = threshold + 1
    chars = F.col("chars")
    look = []
    for gap in range(threshold + 1):
        cuts = [F.lit(0), *[F.col(f"cut{gap}_{i}") for i in range(1, parts)], chars - gap]
        for i in range(1, parts + 1):
            start, end = cuts[i - 1], cuts[i]
            low = max(-(i - 1), gap - (parts - i))
            high = min(i - 1, gap + (parts - i))
            for shift in range(low, high + 1):
                piece = F.substring("wide", (start + shift) * 4 + 1, (end - start) * 4)
                inside = (start + shift >= 0) & (end + shift <= chars)
                key = F.xxhash64(F.lit(i), chars - gap, piece)
                look.append((gap == 0 and shift == 0, F.when(inside, key)))
    return look


def letters(line: Column) -> Column:
    """One long: the counts of ``_LETTERS`` modulo 4."""
    packed = F.lit(0).cast("long")
    for i, letter in enumerate(_LETTERS):
        count = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter), F.lit("")))
        packed = packed.bitwiseOR(F.shiftleft((count % 4).cast("long"), 2 * i))
    return packed


def may_be_near(a: Column, b: Column, threshold: int) -> Column:
    """Whether letter counts of two lines are as close as those of lines within ``threshold`` edits.

    Counts modulo 4 are at least as close as the counts, so no such pair is left out.
    """

    def apart(i: int) -> Column:
        gap = (F.shiftright(a, 2 * i) - F.shiftright(b, 2 * i)).bitwiseAND(F.lit(3))
        return F.least(gap, F.lit(4) - gap)

    return reduce(lambda x, y: x + y, map(apart, range(len(_LETTERS)))) <= 2 * threshold


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def within_edits(left: Column, right: Column, threshold: int) -> Column:
    """Edit distance of two arrays of characters, at most ``threshold``, else null.

    Bit p of a word stands for row i + p - threshold of column i; the distance is followed down the
    band's lowest diagonal and then along the last row.
    """
    width = 2 * threshold + 1
    full = (1 << width) - 1
    n, m = F.size(left), F.size(right)

    def step(state: Column, i: Column) -> Column:
        char = F.get(right, i)
        match = reduce(
            lambda a, b: a.bitwiseOR(b),
            [
                F.when(
                    (i + (p - threshold) >= 0) & F.get(left, i + (p - threshold)).eqNullSafe(char),
                    F.lit(1 << p),
                ).otherwise(F.lit(0))
                for p in range(width)
            ],
        ).cast("long")
        up, down, dist = state["up"], state["down"], state["dist"]

        def not_(x: Column) -> Column:
            return F.bitwise_not(x).bitwiseAND(F.lit(full))

        def after_zero(zero: Column) -> Column:
            plus = down.bitwiseOR(not_(zero.bitwiseOR(up)))
            minus = zero.bitwiseAND(up)
            moved = F.shiftright(zero, 1)
            row = F.greatest(F.lit(0), F.lit(width - 2) - (i - (n - threshold)))
            bit = F.expr("1L")

            def has(word: Column, place: Column) -> Column:
                return F.call_function("shiftright", word, place.cast("int")).bitwiseAND(bit)

            falls = F.when(
                i < n - threshold, F.lit(1) - has(zero, F.lit(width - 1))
            ).otherwise(has(plus, row) - has(minus, row))
            return F.struct(
                minus.bitwiseOR(not_(moved.bitwiseOR(plus))).alias("up"),
                moved.bitwiseAND(plus).alias("down"),
                (dist + falls).cast("long").alias("dist"),
            )

        return _let(match, lambda x: _let(_zero(x, up, down, full), after_zero))

    start = F.struct(
        F.lit(full - ((1 << threshold) - 1)).cast("long").alias("up"),
        F.lit(0).cast("long").alias("down"),
        F.lit(threshold).cast("long").alias("dist"),
    )
    run = F.aggregate(
        F.when(m > 0, F.sequence(F.lit(0), m - 1)).otherwise(F.array().cast("array<int>")),
        start,
        step,
        lambda s: s["dist"],
    )
    near = (F.abs(n - m) <= threshold) & (n > threshold)
    return F.when(near & (run <= threshold), run)


def _zero(match: Column, up: Column, down: Column, full: int) -> Column:
    carried = (match.bitwiseAND(up) + up).bitwiseXOR(up)
    return carried.bitwiseOR(match).bitwiseOR(down).bitwiseAND(F.lit(full))


def _bitmap(ids: DataFrame) -> DataFrame:
    """(bucket, words): at most 512 rows of 1,024 words of 32 bits, whatever ``ids`` holds."""
    at = F.pmod("id", F.lit(_BITS))
    # four bytes at a time, so that a bit is found in whole numbers; byte 0 is a word's highest
    words = F.transform(
        F.sequence(F.lit(0), F.lit(1023)),
        lambda i: F.conv(F.hex(F.substring("bits", i * 4 + 1, F.lit(4))), 16, 10).cast("long"),
    )
    return (
        ids.select(
            F.call_function("bitmap_bucket_number", at).alias("bucket"),
            F.call_function("bitmap_bit_position", at).alias("place"),
        )
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("place").alias("bits"))
        .select("bucket", words.alias("words"))
    )


def _marked(df: DataFrame, id_col: str, bitmap: DataFrame) -> DataFrame:
    """``df`` with ``in_bitmap``: whether the row's id may be among those of the bitmap."""
    at = F.pmod(id_col, F.lit(_BITS))
    place = F.call_function("bitmap_bit_position", at).cast("int")
    word = F.get("bitmap_bits", F.shiftright(place, 5))
    shift = F.lit(24) - place.bitwiseAND(F.lit(24)) + place.bitwiseAND(F.lit(7))
    bit = F.call_function("shiftright", word, shift).bitwiseAND(F.lit(1))
    own = bitmap.select(
        F.col("bucket").alias("bitmap_bucket"), F.col("words").alias("bitmap_bits")
    )
    return (
        df.join(
            F.broadcast(own),
            F.call_function("bitmap_bucket_number", at) == F.col("bitmap_bucket"),
            "left",
        )
        .withColumn("in_bitmap", F.coalesce(bit == 1, F.lit(False)))
        .drop("bitmap_bucket", "bitmap_bits")
    )


def _meeting(lines: DataFrame, threshold: int) -> DataFrame:
    """(hash, id, own): the looked-up hashes that occur twice, once as a line's own. A line that has
    such a hash twice by itself is among them, and meets nothing later."""
    look = probes(threshold)
    names = [f"h{n}" for n in range(len(look))]
    distinct = (
        with_cuts(lines, threshold)
        .select("line_key", "id", *[c.alias(n) for n, (_, c) in zip(names, look)])
        .groupBy("line_key")
        .agg(*[F.min(c).alias(c) for c in ["id", *names]])
    )
    looked = distinct.select(
        "id",
        F.explode(
            F.array(
                *[
                    F.struct(F.col(n).alias("hash"), F.lit(own).alias("own"))
                    for n, (own, _) in zip(names, look)
                ]
            )
        ).alias("look"),
    ).select("id", "look.hash", "look.own").where("hash is not null")
    # id is counted, so that both readers need the same columns and share the exchange of ``distinct``
    def shared(rows: DataFrame) -> DataFrame:
        return (
            rows.groupBy("hash")
            .agg(F.count("id").alias("times"), F.max("own").alias("any_own"))
            .where("times > 1 and any_own")
            .select("hash")
        )

    # a bitmap of fixed size keeps nearly all rows out of a second exchange; the rest is told exactly
    bitmap = _bitmap(shared(looked).select(F.col("hash").alias("id")))
    likely = materialise(
        _marked(looked, "hash", bitmap).where("in_bitmap").select("hash", "id", "own")
    )
    return materialise(
        likely.join(shared(likely), "hash", "left_semi")
        .groupBy("hash", "id")
        .agg(F.max("own").alias("own"))
    )


def _linked(
    docs: DataFrame, threshold: int, min_chars: int, id_col: str, text_col: str
) -> tuple[DataFrame, DataFrame]:
    """Links between different lines, and all lines (doc, doc_hash, line_no, line_key)."""
    if min_chars <= 2 * threshold:
        raise ValueError("min_chars must be above twice the threshold")
    lines = _lines(docs, id_col, text_col).withColumns(
        {"id": F.xxhash64("line"), "length": F.char_length("line")}
    )
    meeting = _meeting(lines.where(F.col("length") >= min_chars), threshold)
    ids = meeting.select("id").distinct()
    marked = _marked(lines, "id", _bitmap(ids)).withColumn(
        "line", F.when(F.col("in_bitmap") & (F.col("length") >= min_chars), F.col("line"))
    )
    lines = materialise(marked.select("doc", "doc_hash", "line_no", "line_key", "id", "line"))
    texts = materialise(
        lines.where("line is not null")
        .join(ids, "id", "left_semi")
        .groupBy("line_key", "id")
        .agg(F.min("line").alias("line"))
        .withColumns({"length": F.char_length("line"), "letters": letters(F.col("line"))})
    )
    found = meeting.join(texts.select("id", "line_key", "length", "letters"), "id")
    index = found.where("own").select(
        "hash",
        F.col("line_key").alias("b"),
        F.col("length").alias("b_length"),
        F.col("letters").alias("b_letters"),
    )
    pairs = materialise(
        found.select("hash", F.col("line_key").alias("a"), "length", "letters")
        .join(index, "hash")
        .where(
            F.col("length").between(F.col("b_length"), F.col("b_length") + threshold)
            & ((F.col("length") > F.col("b_length")) | (F.col("a") < F.col("b")))
        )
        .where(may_be_near(F.col("letters"), F.col("b_letters"), threshold))
        .select("a", "b")
        .distinct()
    )

    def side(name: str) -> DataFrame:
        chars = F.regexp_extract_all("line", F.lit("(?s)."), F.lit(0))
        return texts.select(F.col("line_key").alias(name), chars.alias(f"{name}_chars"))

    links = (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .select("a", "b", within_edits(F.col("a_chars"), F.col("b_chars"), threshold).alias("edits"))
        .where("edits is not null")
    )
    return materialise(links), lines.drop("id", "line")


def near_lines(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    min_chars: int = MIN_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Links between different lines: a, b (line keys), edits."""
    return _linked(docs, threshold, min_chars, id_col, text_col)[0]


def repeated_lines(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    min_chars: int = MIN_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc, doc_hash, dropped: for each document that loses lines, their numbers from 0, ascending."""
    links, lines = _linked(docs, threshold, min_chars, id_col, text_col)
    classes = components(links).select(F.col("node").alias("line_key"), "component")
    place = F.struct(F.col("doc").isNull().alias("last"), "doc", "doc_hash", "line_no")
    placed = lines.join(classes, "line_key", "left").select(
        "doc", "doc_hash", "line_no", F.coalesce("component", "line_key").alias("class")
    )
    first = (
        placed.groupBy("class")
        .agg(F.min(place).alias("first"), F.max(place).alias("final"))
        .where("first <> final")
        .drop("final")
    )
    return (
        placed.join(first, "class")
        .where(place != F.col("first"))
        .groupBy("doc", "doc_hash")
        .agg(F.sort_array(F.collect_set("line_no")).alias("dropped"))
    )


@own_names("own_hash", "in_bitmap", "bitmap_bits", "dropped_doc", "dropped_hash")
def deduplicate(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    min_chars: int = MIN_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with its columns and ``dropped``, the numbers of the lines that go.

    Only texts that may lose lines move; the same kind of bitmap tells the others.
    A column called ``dropped`` is replaced; all others stay as they are.
    """
    found = materialise(repeated_lines(docs, threshold, min_chars, id_col, text_col)).select(
        F.col("doc").alias("dropped_doc"), F.col("doc_hash").alias("dropped_hash"), "dropped"
    )
    plain = docs.drop("dropped")
    marked = _marked(
        plain.withColumn("own_hash", F.xxhash64(text_of(text_col))),
        "own_hash",
        _bitmap(found.select(F.col("dropped_hash").alias("id"))),
    )
    nothing = F.array().cast("array<int>")
    losing = marked.where("in_bitmap").join(
        found,
        F.col(id_col).cast("long").eqNullSafe(F.col("dropped_doc"))
        & (F.col("own_hash") == F.col("dropped_hash")),
        "left",
    )
    return (
        losing.withColumn("dropped", F.coalesce("dropped", nothing))
        .select(*plain.columns, "dropped")
        .union(marked.where("not in_bitmap").select(*plain.columns, nothing.alias("dropped")))
    )


def remaining(text: Column, dropped: Column) -> Column:
    """The text without the lines whose numbers are in ``dropped``."""
    kept = F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(dropped, i))
    return F.when(F.size(dropped) == 0, text).otherwise(F.array_join(kept, "\n"))


def digest(found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_kept, dropped_lines (numbers joined by commas), text_sha256 of what remains."""
    text = text_of(text_col)
    count = F.size(F.split(text, "\n")).cast("long")
    return found.select(
        F.col(id_col).alias("doc_id"),
        count.alias("n_lines"),
        (count - F.size("dropped")).alias("n_kept"),
        F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped_lines"),
        F.sha2(remaining(text, F.col("dropped")).cast("binary"), 256).alias("text_sha256"),
    )
