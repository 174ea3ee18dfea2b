"""Collocations: phrases of two to four words whose parts seldom occur apart, by SON partitioning.

A phrase that occurs ``SUPPORT`` times among the n words of its language occurs in at least one shard
ceil(SUPPORT * words of the shard / n) times. So three passes over the texts do:

1. each shard is mined completely for words and pairs at that lowered local support; what a shard
   sends counts for itself, less what an unsent phrase may have had there, and the sums say which
   phrases may reach the support anywhere (at local support 1 nothing is unsent and the sums are exact);
2. the same for three and four words, where all pairs inside must be candidates;
3. all candidates are counted globally, by their text.

A shard is a run of pieces that one task reads, at most ``SHARD_WORDS`` words of all languages; a
longer piece is cut with three words of overlap. Its memory is bounded, so from ``SUPPORT`` shards
on the local support is 1. Candidates reach the tasks as a bitmap of hashes of at most ``MOST_BITS``
bits: a hash that agrees by chance only makes pass 2 or 3 count a phrase in vain, since pass 3 counts
the texts themselves.

Definitions: a null text is empty, a null language is ``und``; repeated rows count as often as they
occur; other columns aren't read. No words: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.llm.common import text_of
from paneloom.session import materialise

SUPPORT = 30
MOST_WORDS = 4
SHARD_WORDS = 1 << 18
TOP = 2000
COVERED_PERCENT = 80
LANGS = 10_000  # languages whose size the tasks know; the others are mined at local support 1
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
KEY_SHIFT = np.uint64(16)  # keys of 48 bits: narrower rows; equal keys only add candidates
SALTS = 64
CHUNK_BYTES = 1 << 22  # texts that are split at once; a longer one is split by itself
BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

_UPPER = bytes(range(65, 91))
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
_BLANK, _WORD, _BREAK = range(3)
_KINDS = bytes(
    _BREAK if c in BREAKS else _BLANK if c in BLANKS else _WORD for c in range(256)
)


def _buffers(texts: pa.Array) -> tuple[np.ndarray, pa.Buffer]:
    """Offsets and bytes of an array of type binary, as ``texts.to_pylist()`` is slow."""
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(1, dtype=np.int32), pa.py_buffer(b"")
    ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return ends, data or pa.py_buffer(b"")


def _values(texts: pa.Array) -> list[bytes]:
    ends, data = _buffers(texts)
    ends, data = ends.tolist(), data.to_pybytes()
    return [data[a:b] for a, b in zip(ends, ends[1:])]


class Tokens:
    """Lower-cased words of some texts, with a token that is none where a piece ends.

    ``is_word`` tells the tokens apart, ``first`` is the first token of each text and, at its end, the
    number of all."""

    def __init__(self, data: bytes, offsets: np.ndarray):
        kinds = np.frombuffer(data.translate(_KINDS), np.uint8)
        word = kinds == _WORD
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        first[edges], last[edges - 1] = word[edges], word[edges - 1]
        starts = np.flatnonzero(first | (kinds == _BREAK))
        self.is_word = first[starts]
        self.first = np.searchsorted(starts, offsets)
        sizes = np.flatnonzero(last) - starts[self.is_word] + 1
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        letters = data.translate(_LOWER, BREAKS + BLANKS)
        self.words = pa.Array.from_buffers(
            pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(letters)]
        )
        self.words_before = np.concatenate([[0], np.cumsum(self.is_word)])


def tokens_of(texts: pa.Array) -> Iterator[Tokens]:
    """Tokens of runs of the texts, none of them null."""
    ends, data = _buffers(texts.cast(pa.binary()))
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(ends, int(ends[at]) + CHUNK_BYTES, "right")) - 1
        to = min(max(to, at + 1), len(texts))
        run = data[int(ends[at]) : int(ends[to])].to_pybytes()
        yield Tokens(run, ends[at : to + 1] - ends[at])
        at = to


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Shard:
    """Words of one language. ``own`` marks words that belong here, the rest is overlap."""

    def __init__(self, lang: str, segments: list[tuple[pa.Array, np.ndarray, int]]):
        words = pa.concat_arrays([w for w, _, _ in segments]).dictionary_encode()
        self.words = words.dictionary
        size = sum(len(is_word) + 1 for _, is_word, _ in segments)  # a break after each
        word, self.own = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
        at = 0
        for _, is_word, count in segments:
            word[at : at + len(is_word)] = is_word
            self.own[at : at + count] = is_word[:count]
            at += len(is_word) + 1
        self.ids = np.zeros(size, dtype=np.int64)  # 0 is the break
        self.ids[word] = words.indices.to_numpy() + 1
        seed = xxhash.xxh3_64_intdigest(lang.encode())
        hashes = [xxhash.xxh3_64_intdigest(w, seed) for w in _values(self.words)]
        self.hashes = np.array([0, *hashes], dtype=np.uint64)[self.ids]

    def __len__(self) -> int:
        return int(self.own.sum())

    def phrases(self, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(words, starts, keys) of all phrases of 1 to ``most`` words."""
        starts, hashes = np.flatnonzero(self.own), self.hashes
        values = hashes[starts]
        yield 1, starts, values >> KEY_SHIFT
        for n in range(2, most + 1):
            inside = starts + n <= len(self.ids)
            inside[inside] = self.ids[starts[inside] + n - 1] > 0
            starts, values = starts[inside], values[inside]
            values = _mixed(values * np.uint64(0xD6E8FEB86659FD93) + hashes[starts + n - 1])
            yield n, starts, values >> KEY_SHIFT

    def exact(self, starts: np.ndarray, n: int) -> tuple[pa.Array, np.ndarray]:
        """Different phrases at ``starts`` and their numbers, told apart by their words."""
        code = self.ids[starts]
        for i in range(1, n):
            code = _codes(code) if i > 1 else code
            code = code * (len(self.words) + 1) + self.ids[starts + i]
        code = _codes(code)
        counts = np.bincount(code)
        first = np.empty(len(counts), dtype=np.int64)
        first[code] = starts  # any of them
        words = [self.words.take(pa.array(self.ids[first + i] - 1)) for i in range(n)]
        return pc.binary_join_element_wise(*words, pa.scalar(b" ")), counts


def _codes(values: np.ndarray) -> np.ndarray:
    """Numbers from 0 for the different values."""
    return pa.array(values).dictionary_encode().indices.to_numpy().astype(np.int64)


def shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[dict[str, Shard]]:
    """Shards of at most ``size`` words and breaks, by language."""
    kept: dict[str, list] = {}
    held = 0
    for batch in batches:
        langs = map(str, _values(batch.column("lang").cast(pa.binary())), repeat("utf-8"))
        for tokens in tokens_of(batch.column("text")):
            before, bounds = tokens.words_before, tokens.first.tolist()
            for begin, end, lang in zip(bounds, bounds[1:], langs):
                for at in range(begin, end, size):
                    to = min(at + size + MOST_WORDS - 1, end)
                    count = min(size, end - at)
                    if held and held + count > size:
                        yield {k: Shard(k, v) for k, v in kept.items()}
                        kept, held = {}, 0
                    words = tokens.words[before[at] : before[to]]
                    kept.setdefault(lang, []).append((words, tokens.is_word[at:to], count))
                    held += count
    if held:
        yield {k: Shard(k, v) for k, v in kept.items()}


class Bitmap:
    """Candidate hashes, of bounded size."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.last = np.uint64(len(bits) * 8 - 1)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self.last
        byte = self.bits[(at >> np.uint64(3)).astype(np.int64)]
        return (byte >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def local_support(support: int, words: int, total: int | None) -> int:
    return max(1, -(-support * words // total)) if total else 1


def _mine(sizes: dict[str, tuple[int, int]], levels: range, pairs, support: int, size: int):
    """Phrases that are frequent in their shard: (lang_no, key, bonus). A row without a key tells
    how many occurrences an unsent phrase may have had in the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pairs and Bitmap(pairs.value)
        for parts in shards(batches, size):
            for lang, shard in parts.items():
                number, total = sizes.get(lang, (-1, None))
                least = local_support(support, len(shard), total)
                if least > 1:
                    yield _sent(number, [None], [least - 1])
                usable = None
                for n, starts, values in shard.phrases(levels[-1]):
                    if n == 2 and known:
                        usable = np.zeros(len(shard.ids) + MOST_WORDS, dtype=bool)
                        usable[starts] = known(values)
                    if n not in levels:
                        continue
                    if usable is not None:
                        fit = usable[starts]
                        for i in range(1, n - 1):
                            fit &= usable[starts + i]
                        values = values[fit]
                    keys, counts = np.unique(values, return_counts=True)
                    often = counts >= least
                    yield _sent(number, keys[often].view(np.int64), counts[often] - (least - 1))

    return run


def _sent(number: int, keys, bonus) -> pa.RecordBatch:
    return pa.record_batch(
        [
            pa.array(np.full(len(keys), number, dtype=np.int32)),
            pa.array(keys, pa.int64()),
            pa.array(bonus, pa.int64()),
        ],
        ["lang_no", "key", "bonus"],
    )


def _candidates(texts: DataFrame, sizes, levels, pairs, support: int, size: int) -> DataFrame:
    """Hashes of the phrases that may reach the support.

    In a language of at least ``support`` shards nothing is unsent, so the sums are filtered at
    once; of smaller ones they are kept until it is known how much may be unsent.
    """
    small = [number for number, total in sizes.values() if total < support * size]
    unsent = F.lit(0)
    if small:
        unsent = F.when(F.col("lang_no").isin(small), support - 1).otherwise(0)
    mined = texts.mapInArrow(
        _mine(sizes, levels, pairs, support, size), "lang_no int, key long, bonus long"
    )
    sums = materialise(
        mined.groupBy("lang_no", "key")
        .agg(F.sum("bonus").alias("bonus"))
        .where(F.col("key").isNull() | (F.col("bonus") >= support - unsent))
    )
    most = sums.where("key is null").select("lang_no", F.col("bonus").alias("unsent"))
    possible = F.col("bonus") + F.coalesce("unsent", F.lit(0))
    return (
        sums.where("key is not null")
        .join(F.broadcast(most), "lang_no", "left")  # at most LANGS rows
        .where(possible >= support)
        .select("key")
    )


def _bitmap(keys: DataFrame):
    """Broadcast bitmap of the hashes; the driver gets at most ``MOST_BITS`` / 64 words of it."""
    keys = materialise(keys)
    bits = LEAST_BITS
    while bits < MOST_BITS and bits < 32 * keys.count():
        bits *= 2
    at = F.col("key").bitwiseAND(F.lit(bits - 1))
    rows = (
        keys.select(
            F.shiftright(at, 6).cast("int").alias("word"),
            F.expr(f"shiftleft(1L, CAST(key & 63 AS INT))").alias("bit"),
        )
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bit"))
        .toArrow()
    )
    words = np.zeros(bits // 64, dtype="<i8")
    words[rows.column("word").to_numpy()] = rows.column("bit").to_numpy()
    return keys.sparkSession.sparkContext.broadcast(words.view(np.uint8))


def _count(short, long, size: int):
    """Counts of the candidates in each shard, by text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {n: Bitmap((short if n < 3 else long).value) for n in range(1, MOST_WORDS + 1)}
        for parts in shards(batches, size):
            for lang, shard in parts.items():
                for n, starts, values in shard.phrases(MOST_WORDS):
                    texts, counts = shard.exact(starts[known[n](values)], n)
                    yield pa.record_batch(
                        [
                            pa.array([lang] * len(texts), pa.string()),
                            pa.array(np.full(len(texts), n, dtype=np.int32)),
                            texts.cast(pa.string()),
                            pa.array(counts, pa.int64()),
                        ],
                        ["lang", "words", "phrase", "a"],
                    )

    return run


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [np.diff(t.words_before[t.first]) for t in tokens_of(batch.column("text"))]
        langs = batch.column("lang").dictionary_encode()
        counts = np.zeros(len(langs.dictionary), dtype=np.int64)
        np.add.at(counts, langs.indices.to_numpy(), np.concatenate([counts[:0], *rows]))
        yield pa.record_batch([langs.dictionary, pa.array(counts)], ["lang", "n"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(text_of().alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, n): all words of each language."""
    counted = _texts(docs).mapInArrow(_count_words, "lang string, n long")
    return counted.groupBy("lang").agg(F.sum("n").alias("n"))


def frequent_phrases(
    docs: DataFrame,
    sizes: DataFrame,
    support: int = SUPPORT,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """(lang, words, phrase, a): exact numbers of all phrases of 1 to 4 words that occur ``support``
    times in their language. ``sizes`` as of :func:`word_counts`."""
    texts = _texts(docs)
    largest = sizes.where("n > 0").orderBy(F.desc("n"), "lang").limit(LANGS).collect()
    known = {r["lang"]: (i, r["n"]) for i, r in enumerate(largest)}
    short = _bitmap(_candidates(texts, known, range(1, 3), None, support, shard_words))
    long = _bitmap(
        _candidates(texts, known, range(3, MOST_WORDS + 1), short, support, shard_words)
    )
    counted = texts.mapInArrow(
        _count(short, long, shard_words), "lang string, words int, phrase string, a long"
    )
    return materialise(
        counted.groupBy("lang", "words", "phrase")
        .agg(F.sum("a").alias("a"))
        .where(F.col("a") >= support)
    )


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def scored(frequent: DataFrame) -> DataFrame:
    """(lang, words, phrase, a, l, r, score) of the phrases of two words and more, at their weakest
    cut. All parts are frequent themselves, so both joins find them."""
    parts = F.split("phrase", " ", -1)
    number = frequent.select("lang", F.col("phrase").alias("part"), F.col("a").alias("of_part"))
    cuts = frequent.where("words > 1").select(
        "*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    )
    cuts = cuts.withColumns(
        {
            "first": F.array_join(F.slice(parts, F.lit(1), F.col("k")), " "),
            "rest": F.array_join(F.slice(parts, F.col("k") + 1, F.col("words")), " "),
        }
    )
    for side, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(
            number.withColumnsRenamed({"part": side, "of_part": name}), ["lang", side]
        )
    score = F.expr(
        "cast(a as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"
    )
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return (
        cuts.groupBy("lang", "words", "phrase", "a")
        .agg(lowest)
        .select("lang", "words", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )


def not_covered(phrases: DataFrame, frequent: DataFrame, percent: int = COVERED_PERCENT) -> DataFrame:
    """Without phrases that lie in a longer frequent one with at least ``percent`` of their number."""
    parts = F.split("phrase", " ", -1)
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda m: F.transform(
                F.sequence(F.lit(1), F.col("words") - m + 1),
                lambda at: F.array_join(F.slice(parts, at, m), " "),
            ),
        )
    )
    within = (
        frequent.where("words > 2")
        .select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    covered = _wide("longer") * 100 >= _wide("a") * percent
    return (
        phrases.join(within, ["lang", "phrase"], "left")
        .where(~F.coalesce(covered, F.lit(False)))
        .drop("longer")
    )


def collocations(
    docs: DataFrame, support: int = SUPPORT, top: int = TOP, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language."""
    sizes = materialise(word_counts(docs))
    frequent = frequent_phrases(docs, sizes, support, shard_words)
    left = not_covered(scored(frequent), frequent)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt")
    first = Window.partitionBy("lang", "salt").orderBy(*order)
    last = Window.partitionBy("lang").orderBy(*order)
    return (
        left.select("*", salt)
        .withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= top)
        .withColumn("rank", F.row_number().over(last))
        .where(F.col("rank") <= top)
        .join(sizes, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
