"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

A shingle is five consecutive words (lower-cased runs of word characters); a text of fewer words is one
shingle. Weights are (1 + ln tf) * idf with the smoothed idf 1 + IDF_GAIN * ln(N / df) / ln(1 / RARE);
shingles in less than RARE of all documents count as in RARE of them. Each sample draws, per shingle,
r and c from Gamma(2, 1) and beta from U(0, 1), t = floor(ln w / r + beta), and keeps the
shingle with the least ln c - r (t - beta + 1): two texts agree on (shingle, t) with the
probability of their weighted Jaccard similarity. ``BANDS`` bands of ``ROWS`` samples make candidates;
links need a weighted Jaccard similarity of 0.8, computed from the whole texts.

Scale: document frequencies are exact for frequent shingles alone, of which there are at most
2 * mean length / RARE. A shingle in RARE of all documents has at least half of that share in partitions
that show it as frequent, so partition sums find them all, and a second count is exact. Equal
texts are one node. In a bucket, texts are compared with ``LEADERS`` leaders, so pairs grow with
the rows, not with the squares of groups. Texts whose bucket still
holds several components are sampled again into ``LONG_BANDS`` bands of
``LONG_ROWS``, of which a linked pair shares one with probability 0.99, compared with leaders there
too, and every long bucket that still holds several components is finished: all its texts of different components meet,
in blocks of two chunks of about ``BLOCK`` texts, where total weights and distances to one text (a metric) rule out
pairs. Components of ``BLOCK`` texts have chunks of their own, which don't meet each other. Pairs with
a leader travel in chunks of at most ``CHUNK`` texts, so a leader of a third of all rows is no hot group.

Definitions: equal texts are one class, empty and null ones included; texts without words have no other
links. class_id is the smallest doc_id of the class, null if it has none. Repeated rows get the same class.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Callable, Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneloom.llm.common import compact, components, lean, own_names, text_of
from paneloom.session import materialise

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS, LEADERS = 10, 4, 2
RARE = 0.01
IDF_GAIN = 0.25
LONG_BANDS, LONG_ROWS = 25, 8  # for texts in crowded buckets
BLOCK = 64
USUAL = np.log(np.array([1 + IDF_GAIN])).astype(np.float32)[0]
CHUNK = 256
CHUNK_SHINGLES = 1 << 21  # counted at once
_TABLE_BITS = 18
_CHARACTERS = 1 << 18  # hashed at once
_BASE = 0x9FB21C651E98DF25  # odd, so it has an inverse
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


@cache
def _word_characters() -> np.ndarray:
    """For each code point whether it is a word character (\\w)."""
    found = np.zeros(sys.maxunicode + 1, bool)
    for run in re.finditer(r"\w+", "".join(map(chr, range(len(found))))):
        found[run.start() : run.end()] = True
    return found


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of the base, and their inverses, modulo 2 ** 64."""
    bases = np.ones((2, n), np.uint64)
    bases[0, 1:] = np.uint64(_BASE)
    bases[1, 1:] = np.uint64(pow(_BASE, -1, 1 << 64))
    power, inverse = np.cumprod(bases, axis=1, dtype=np.uint64)
    return power, inverse


def _word_ids(text: str) -> np.ndarray:
    """Hashes of the words of a text: polynomials of their code points, from running sums."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _word_characters()[codes]
    found, start = [], 0
    while start < len(codes):
        end = min(start + _CHARACTERS, len(codes))
        if end < len(codes):  # not inside a word
            gap = np.flatnonzero(~inside[start:end])
            if len(gap):
                end = start + int(gap[-1]) + 1
            else:
                rest = ~inside[end:]
                end = end + int(rest.argmax()) if rest.any() else len(codes)
        power, inverse = _powers(max(_CHARACTERS, 1 << (end - start - 1).bit_length()))
        edges = np.flatnonzero(np.diff(inside[start:end], prepend=False, append=False))
        sums = np.zeros(end - start + 1, np.uint64)
        np.cumsum((codes[start:end] + np.uint64(1)) * power[: end - start], out=sums[1:])
        first, last = edges[::2], edges[1::2]
        found.append(_mixed((sums[last] - sums[first]) * inverse[first]))
        start = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Different shingle hashes of a whole text, ascending, and how often each occurs."""
    ids = _word_ids(text or "")
    if not len(ids):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    width = min(WORDS, len(ids))
    n = len(ids) - width + 1
    mixed = ids[:n].copy()
    for i in range(1, width):
        mixed *= _MIX[0]
        mixed += ids[i : i + n]
    return np.unique(_mixed(mixed), return_counts=True)


class Weights:
    """Shingle weights, from the frequent shingles (ascending) and their document frequencies."""

    def __init__(self, documents: int, frequent: np.ndarray, counts: np.ndarray):
        self.frequent = frequent
        share = np.log(max(documents, 1) / np.maximum(counts, 1)) / math.log(1 / RARE)
        self.idf = 1 + IDF_GAIN * np.clip(share, 0, 1)

    def of(self, hashes: np.ndarray, tf: np.ndarray) -> np.ndarray:
        idf = np.full(len(hashes), 1 + IDF_GAIN)
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, hashes), len(self.frequent) - 1)
            hit = self.frequent[at] == hashes
            idf[hit] = self.idf[at[hit]]
        return (1 + np.log(tf)) * idf


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of (hashes ascending, weights); 0 without shingles."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(a[0], b[0]), len(a[0]) - 1)
    hit = a[0][at] == b[0]
    common = float(np.minimum(a[1][at[hit]], b[1][hit]).sum())
    return common / (float(a[1].sum()) + float(b[1].sum()) - common)


class Sampler:
    """Consistent weighted samples; the draws come from fixed tables addressed by hashes."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 11):
        random = np.random.default_rng(seed)
        size, self.bands, self.rows = 1 << _TABLE_BITS, bands, rows
        self.r = random.gamma(2, 1, size).astype(np.float32)
        self.log_c = np.log(random.gamma(2, 1, size)).astype(np.float32)
        self.beta = random.random(size, dtype=np.float32)
        # value and t of the usual weight, that of a rare shingle that occurs once
        level = np.floor(USUAL / self.r + self.beta)
        self.usual = self.log_c - self.r * (level - self.beta + 1)
        self.factor = random.integers(1, 2**63, (bands * rows, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def samples(self, hashes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each sample its shingle and t."""
        best = np.full(len(self.factor), np.inf, np.float32)
        chosen = np.zeros(len(self.factor), np.uint64)
        level = np.zeros(len(self.factor), np.float32)
        logs = np.log(weights).astype(np.float32)
        usual = logs == USUAL
        lanes = np.arange(len(self.factor))
        for own, log_w in ((hashes[usual], None), (hashes[~usual], logs[~usual])):
            for start in range(0, len(own), 2048):  # bounded memory for very long texts
                part = own[start : start + 2048]
                at = ((part * self.factor) >> np.uint64(64 - _TABLE_BITS)).view(np.int64)
                if log_w is None:
                    value = self.usual[at]
                else:
                    r, beta = self.r[at], self.beta[at]
                    t = np.floor(log_w[start : start + 2048] / r + beta)
                    value = self.log_c[at] - r * (t - beta + 1)
                j = value.argmin(axis=1)
                least = value[lanes, j]
                better = least < best
                spot = at[lanes, j][better]
                best[better] = least[better]
                chosen[better] = part[j][better]
                log_best = USUAL if log_w is None else log_w[start : start + 2048][j][better]
                level[better] = np.floor(log_best / self.r[spot] + self.beta[spot])
        return chosen, level.astype(np.int64)

    def band_keys(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One signed key for each band, none without shingles."""
        if not len(hashes):
            return np.zeros(0, np.int64)
        chosen, level = self.samples(hashes, weights)
        each = _mixed(chosen ^ (level.astype(np.uint64) * _MIX[0])).reshape(self.bands, self.rows)
        key = np.arange(self.bands, dtype=np.uint64)
        for i in range(self.rows):
            key = _mixed(key * _MIX[0] + each[:, i])
        return key.view(np.int64)


def _count(pick: Callable[[np.ndarray, np.ndarray, int], tuple]) -> Callable:
    """Counts of shingles over batches of texts, a bounded number at once.

    ``pick`` gets the different shingles of some documents, in how many each occurs, and the number
    of documents; it says which leave the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            hashes, counts = np.unique(
                np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True
            )
            hashes, counts = pick(hashes, counts, len(held))
            return pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64)), pa.array(np.full(len(hashes), 0))],
                names=["shingle", "n", "documents"],
            )

        def total(n: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([None], pa.int64()), pa.array([0], pa.int64()), pa.array([n], pa.int64())],
                names=["shingle", "n", "documents"],
            )

        documents = 0
        for batch in lean(batches):
            for text in batch.column(0):
                hashes, _ = shingles(text.as_py())
                held.append(hashes)
                size += len(hashes)
                documents += 1
                if size >= CHUNK_SHINGLES:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()
        yield total(documents)

    return run


def _mostly_frequent(hashes, counts, documents):
    keep = counts >= RARE / 2 * documents
    return hashes[keep], counts[keep]


def corpus_weights(texts: DataFrame) -> Weights:
    """Weights over all rows of ``texts`` (text). The driver gets at most 2 * mean length / RARE
    shingles, a number that doesn't grow with the rows."""
    counted = "shingle long, n long, documents long"
    sums = materialise(
        texts.mapInArrow(_count(_mostly_frequent), counted)
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    )
    documents = sums.where("shingle is null").select("documents").first()
    documents = documents[0] if documents else 0
    likely = sums.where((F.col("shingle").isNotNull()) & (F.col("n") >= RARE / 2 * documents))
    chosen = np.sort(_longs(likely, "shingle").view(np.uint64))

    def among(hashes, counts, _):
        at = np.minimum(np.searchsorted(chosen, hashes), max(len(chosen) - 1, 0))
        keep = chosen[at] == hashes if len(chosen) else np.zeros(len(hashes), bool)
        return hashes[keep], counts[keep]

    if not len(chosen):
        return Weights(documents, chosen, np.zeros(0))
    exact = (
        texts.mapInArrow(_count(among), counted)
        .where("shingle is not null")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= RARE * documents)
        .toPandas()
    )
    hashes = exact["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Weights(documents, hashes[order], exact["n"].to_numpy(np.int64)[order])


def _longs(df: DataFrame, name: str) -> np.ndarray:
    return df.select(name).toPandas()[name].to_numpy(np.int64)


def _signatures(shared, *sampling) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, sampler = shared.value, Sampler(*sampling)
        for batch in lean(batches):
            keys = []
            for text in batch.column(1):
                hashes, tf = shingles(text.as_py())
                keys.append(sampler.band_keys(hashes, weights.of(hashes, tf)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.list_(pa.int64()))], names=["node", "bands"]
            )

    return run


def _verify(shared) -> Callable:
    """Rows (leader, chunk, node, text) in order, the leader's own text first: (a, b, likeness)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        group, first = None, None
        for batch in lean(batches):
            found: list[tuple[bytes, bytes, float]] = []
            for leader, chunk, node, text in zip(*(batch.column(i) for i in range(4))):
                leader, chunk, node = leader.as_py(), chunk.as_py(), node.as_py()
                if node == leader and group == (leader, chunk):
                    continue
                hashes, tf = shingles(text.as_py())
                own = hashes, weights.of(hashes, tf)
                if node == leader:
                    group, first = (leader, chunk), own
                elif group == (leader, chunk):
                    found.append((leader, node, similarity(first, own)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f[0] for f in found], pa.binary()),
                    pa.array([f[1] for f in found], pa.binary()),
                    pa.array([f[2] for f in found], pa.float64()),
                ],
                names=["a", "b", "likeness"],
            )

    return run


def _compared(pairs: DataFrame, texts: DataFrame, shared) -> DataFrame:
    """Different pairs (a, b) with their likeness; ``texts`` has each node's text once."""
    pairs = compact(pairs)
    chunks = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(CHUNK)).alias("chunks"))
    asked = pairs.join(chunks, "a").select(
        F.col("a").alias("leader"),
        F.pmod(F.xxhash64("b"), F.col("chunks")).alias("chunk"),
        F.col("b").alias("node"),
    )
    every = F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)
    leaders = chunks.select(
        F.col("a").alias("leader"), F.explode(every).alias("chunk"), F.col("a").alias("node")
    )
    rows = (
        asked.union(leaders)
        .join(texts, "node")
        .select("leader", "chunk", "node", "text", (F.col("node") != F.col("leader")).alias("later"))
        .repartition("leader", "chunk")
        .sortWithinPartitions("leader", "chunk", "later")
        .select("leader", "chunk", "node", "text")
    )
    return materialise(rows.mapInArrow(_verify(shared), "a binary, b binary, likeness double"))


def _node(text_col: str):
    return F.unhex(F.md5(text_of(text_col)))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """node (of each different text that has a link), component."""
    spark = docs.sparkSession
    weights = corpus_weights(docs.select(text_of(text_col).alias("text")))
    shared = spark.sparkContext.broadcast(weights)
    signed = docs.select(_node(text_col).alias("node"), text_of(text_col).alias("text")).mapInArrow(
        _signatures(shared), "node binary, bands array<long>"
    )
    # equal texts become one row before their bands are rows
    bands = [f"band{n}" for n in range(BANDS)]
    signed = materialise(
        signed.select("node", *[F.get("bands", F.lit(n)).alias(c) for n, c in enumerate(bands)])
        .groupBy("node")
        .agg(*[F.max(c).alias(c) for c in bands])
    )
    buckets = signed.select("node", F.posexplode(F.array(*bands)).alias("band", "key")).where(
        "key is not null"
    )
    large = (
        buckets.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    )
    members = compact(buckets.join(large, ["band", "key"]))
    texts = materialise(
        docs.select(F.col(id_col).alias("id"), _node(text_col).alias("node"), text_of(text_col).alias("text"))
        .join(members.select("node").distinct(), "node", "left_semi")
        .groupBy("node")
        .agg(F.min("text").alias("text"))
    )
    alone = members.withColumn("component", F.col("node"))
    links = _led(alone, texts, shared, leaders=LEADERS)
    state = components(links)
    # texts that share a bucket with another component are sampled again into longer bands, in which
    # texts of a middling likeness seldom meet
    crowded = _divided(members, state).select("node").distinct()
    longer = compact(
        texts.join(crowded, "node")
        .select("node", "text")
        .mapInArrow(
            _signatures(shared, LONG_BANDS, LONG_ROWS, 23), "node binary, bands array<long>"
        )
        .select("node", F.posexplode("bands").alias("band", "key"))
    )
    state = _merged(state, _led(compact(_divided(longer, state)), texts, shared, leaders=LEADERS))
    return _merged(state, _met(compact(_divided(longer, state)), texts, shared))


def _divided(members: DataFrame, state: DataFrame) -> DataFrame:
    """The texts of buckets (band, key) that hold more than one component, and these."""
    placed = members.join(state, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    several = (
        placed.groupBy("band", "key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("band", "key")
    )
    return placed.join(several, ["band", "key"])


def _led(mixed: DataFrame, texts: DataFrame, shared, leaders: int) -> DataFrame:
    """The links (a, b) found by comparing each bucket's texts with its leaders, as far as they are in
    other components."""
    order = Window.partitionBy("band", "key").orderBy(F.xxhash64("node"), "node")
    heads = (
        mixed.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= leaders)
        .select("band", "key", F.col("node").alias("a"), F.col("component").alias("own"))
    )
    led = (
        mixed.join(heads, ["band", "key"])
        .where("component <> own")
        .select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"))
        .distinct()
    )
    near = _compared(led, texts, shared).where(F.col("likeness") >= SIMILARITY)
    return near.select("a", "b")


def _met(mixed: DataFrame, texts: DataFrame, shared) -> DataFrame:
    """All links (a, b) between texts of a bucket in different components, short of those that
    join nothing more within a block."""
    sizes = mixed.groupBy("band", "key", "component").agg(F.count("*").alias("n"))
    # the chunks of a large component are its own, small components share chunks (own: empty)
    sizes = sizes.withColumn(
        "own", F.when(F.col("n") >= BLOCK, F.col("component")).otherwise(F.unhex(F.lit("")))
    )
    chunks = compact(
        sizes.groupBy("band", "key", "own").agg(F.ceil(F.sum("n") / F.lit(BLOCK)).alias("chunks"))
    )
    placed = (
        mixed.join(sizes.drop("n"), ["band", "key", "component"])
        .join(chunks, ["band", "key", "own"])
        .select(
            "band",
            "key",
            "own",
            F.pmod(F.xxhash64("node"), F.col("chunks")).alias("chunk"),
            "node",
            "component",
        )
    )
    each = chunks.select(
        "band", "key", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk")
    )
    one, other = (
        each.select("band", "key", F.struct("own", "chunk").alias(name)) for name in ("p", "q")
    )
    blocks = (
        one.join(other, ["band", "key"])
        .where("p <= q and (p.own <> q.own or p.own = unhex(''))")
        .withColumn("block", F.xxhash64("band", "key", "p", "q"))
        # the sides of a block meet each other; a chunk that meets itself is on side 2
        .select(
            "band",
            "key",
            "block",
            F.explode(
                F.when(
                    F.col("p") == F.col("q"), F.array(F.struct(F.lit(2).alias("side"), F.col("p").alias("c")))
                ).otherwise(
                    F.array(
                        F.struct(F.lit(0).alias("side"), F.col("p").alias("c")),
                        F.struct(F.lit(1).alias("side"), F.col("q").alias("c")),
                    )
                )
            ).alias("part"),
        )
        .select("band", "key", "block", "part.side", "part.c.own", "part.c.chunk")
    )
    rows = (
        blocks.join(placed, ["band", "key", "own", "chunk"])
        .join(texts, "node")
        .select("block", "side", "node", "component", "text")
        .repartition("block")
        .sortWithinPartitions("block")
    )
    return materialise(rows.mapInArrow(_meeting(shared), "a binary, b binary").distinct())


def _meeting(shared) -> Callable:
    """Rows (block, side, node, component, text) in order of blocks: links (a, b)."""

    def links(rows: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        rows.sort(key=lambda row: row[-1])
        root = {row[2]: row[2] for row in rows}

        def of(component: bytes) -> bytes:
            while root[component] != component:
                root[component] = component = root[root[component]]
            return component

        pivot = rows[-1][3]
        far = [1 - similarity(row[3], pivot) for row in rows]
        reach = 1 - SIMILARITY + 1e-9
        for j, (side, b, b_component, b_own, b_total) in enumerate(rows):
            for i in range(j - 1, -1, -1):
                a_side, a, a_component, a_own, a_total = rows[i]
                if a_total < (SIMILARITY - 1e-9) * b_total:
                    break
                if (a_side == side) != (side == 2) or abs(far[i] - far[j]) > reach:
                    continue
                x, y = of(a_component), of(b_component)
                if x != y and similarity(a_own, b_own) >= SIMILARITY:
                    root[x] = y
                    yield a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        held: list[tuple] = []
        block = None

        def out() -> pa.RecordBatch:
            found = list(links(held)) if held else []
            return pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], pa.binary()) for i in range(2)], names=["a", "b"]
            )

        for batch in lean(batches):
            for own, side, node, component, text in zip(*(batch.column(i) for i in range(5))):
                if own.as_py() != block:
                    yield out()
                    block, held = own.as_py(), []
                hashes, tf = shingles(text.as_py())
                weight = weights.of(hashes, tf)
                held.append(
                    (side.as_py(), node.as_py(), component.as_py(), (hashes, weight), float(weight.sum()))
                )
        yield out()

    return run


def _merged(state: DataFrame, links: DataFrame) -> DataFrame:
    """``state`` with its components joined where a link goes from one to another."""
    if links.isEmpty():
        return state
    return components(state.withColumnsRenamed({"node": "a", "component": "b"}).union(links))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size (rows)."""
    found = near_classes(docs, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), _node(text_col).alias("node"))
    placed = materialise(
        rows.join(found, "node", "left").select(
            "doc_id", F.coalesce("component", "node").alias("class")
        )
    )
    heads = placed.groupBy("class").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")
    )
    return placed.join(heads, "class").select("doc_id", "class_id", "class_size")


@own_names("own_key", "own_turn", "own_id", "own_node")
def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class, that of the smallest doc_id (null last), then text hash.
    All columns stay as they are, whatever they are called."""
    found = near_classes(docs, id_col, text_col)
    order = F.struct(F.col("own_id").isNull().alias("last"), "own_id", "own_node")
    rows = docs.select(F.col(id_col).alias("own_id"), _node(text_col).alias("own_node"))
    heads = (
        rows.join(found.withColumnRenamed("node", "own_node"), "own_node", "left")
        .groupBy(F.coalesce("component", "own_node").alias("class"))
        .agg(F.min(order).alias("head"))
        .select("head.own_id", "head.own_node")
    )
    kept = docs.withColumn("own_key", _node(text_col)).join(
        heads,
        (F.col("own_key") == F.col("own_node")) & F.col(id_col).eqNullSafe(F.col("own_id")),
    )
    # rows repeated with the same id and text: one of them
    same = Window.partitionBy("own_node", "own_id").orderBy("own_node")
    return (
        kept.withColumn("own_turn", F.row_number().over(same))
        .where("own_turn = 1")
        .drop("own_turn", "own_key", "own_node", "own_id")
    )
