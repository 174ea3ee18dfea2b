"""Hard negatives from Hilbert-ordered blocks with zone maps.

Rows are written to Parquet sorted by length, label and the place of their vector on a Hilbert curve, and
cut into blocks of at most ``BLOCK_ROWS`` rows of one label. A block's zone map holds the least and largest
value of each dimension, so for an anchor a the inner products inside lie between the sums of
min(a_d least_d, a_d largest_d) and max(...). Anchors come in chunks, ordered along the curve as well. A chunk
reads a block if the interval of one of its anchors meets what that anchor looks for:

* positives: the own block is read first; then the blocks of the label whose upper bound reaches the
  anchor's kth best score so far;
* negatives: the blocks of other labels whose interval meets the anchor's windows
  [percent of the positive's score, the positive's score].

Bounds: the curve's cells come from a sample of at most ``SAMPLE`` rows, which decides about the order
only. Chunks have at most about ``CHUNK_ROWS`` anchors, and zone maps are compared in parts of ``ZONE_ROWS``;
nothing is broadcast but the cells.

Each component x becomes floor(256 x). Definitions: rows with a null label, or a vector that is null or holds
null or (times 256) non-finite components take no part; vectors are compared with those of equal length only. A row is
not its own positive; a repeated row is another row. Scores beyond 64 bits are clipped. Ties go to the smaller
vec_id, null last. Other columns aren't read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.llm.common import shared_folder
from paneloom.session import materialise

BLOCK_ROWS = 512
CHUNK_ROWS = 512
ZONE_ROWS = 1024
FILE_ROWS = 1 << 16
SAMPLE = 4096
MOST_VALUES = 1 << 22
BITS = 4  # of the curve, a dimension
PERCENT = 80
NO_ID = 2**63 - 1  # stands for a null id inside the groups
LONG = np.iinfo(np.int64)


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> list[bytes]:
    """Places on the Hilbert curve, as bytes in that order. ``cells``: a column of numbers below
    2**bits for each dimension."""
    x = cells.astype(np.int64).T.copy()
    dims, rows = x.shape
    if not dims:
        return [b""] * rows
    # turn and mirror the axes of each level as the curve enters its cube
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for d in range(dims):
            mirrored = (x[d] & bit) > 0
            swapped = np.where(mirrored, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(mirrored, low, swapped)
            x[d] ^= swapped
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros(rows, dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn
    planes = [((x >> level) & 1).astype(np.uint8) for level in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(planes), axis=0).T
    return [row.tobytes() for row in np.ascontiguousarray(packed)]


class Cells:
    """Cells of equal share in each dimension, and evenly spaced places on the curve."""

    def __init__(self, sample: np.ndarray):
        shares = np.arange(1, 1 << BITS) / (1 << BITS)
        self.edges = np.quantile(sample, shares, axis=0) if len(sample) else np.zeros((0, 0))
        self.places = sorted(self.keys(sample))

    def keys(self, x: np.ndarray) -> list[bytes]:
        columns = [np.searchsorted(self.edges[:, d], x[:, d]) for d in range(x.shape[1])]
        return hilbert_keys(np.array(columns, dtype=np.int64).reshape(x.shape[1], len(x)).T)

    def parts(self, keys: list[bytes], most: int) -> np.ndarray:
        """Which of at most ``most`` stretches of the curve each key lies in."""
        step = max(1, -(-len(self.places) // most))
        return np.searchsorted(np.array(self.places[step::step], dtype=object), np.array(keys, dtype=object))


def by_width(vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, positions, matrix) of the vectors of each length."""
    widths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        values = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield int(width), at, values.astype(np.float64).reshape(len(at), int(width))


def _placed(cells, most: int):
    """Adds the place on the curve and the stretch of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[bytes] = [b""] * batch.num_rows
            parts = np.zeros(batch.num_rows, dtype=np.int32)
            for width, at, x in by_width(batch.column("vector")):
                if width in cells.value:
                    own = cells.value[width].keys(x)
                    parts[at] = cells.value[width].parts(own, most)
                    for i, key in zip(at, own):
                        keys[i] = key
            yield pa.record_batch(
                [*batch.columns, pa.array(keys, pa.binary()), pa.array(parts)],
                [*batch.schema.names, "place", "stretch"],
            )

    return run


def _blocks(size: int):
    """Numbers blocks in sorted rows: a new one at each length, label or ``size`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, last = TaskContext.get().partitionId() << 32, 0, None
        for batch in batches:
            numbers = np.empty(batch.num_rows, dtype=np.int64)
            owners = zip(batch.column("width").to_pylist(), batch.column("label").to_pylist())
            for i, owner in enumerate(owners):
                if owner != last or held == size:
                    block, held, last = block + 1, 0, owner
                held += 1
                numbers[i] = block
            yield pa.record_batch(
                [*batch.columns, pa.array(numbers)], [*batch.schema.names, "block"]
            )

    return run


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Zone maps. A block that two tasks read has two, each for its part."""
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        for block in np.unique(blocks):
            part = batch.take(pa.array(np.flatnonzero(blocks == block)))
            ((width, _, x),) = by_width(part.column("vector"))
            yield pa.record_batch(
                [
                    part.column("width")[:1],
                    part.column("label")[:1],
                    pa.array([block], pa.int64()),
                    pa.array([x.min(axis=0)], pa.list_(pa.float64())),
                    pa.array([x.max(axis=0)], pa.list_(pa.float64())),
                ],
                ["width", "label", "block", "least", "largest"],
            )


def intervals(anchors: np.ndarray, least: np.ndarray, largest: np.ndarray):
    """Lower and upper bounds of the inner products of each anchor in each zone."""
    plus, minus = np.maximum(anchors, 0), np.minimum(anchors, 0)
    slack = 1e-9 * (np.abs(anchors) @ np.maximum(np.abs(least), np.abs(largest)).T)
    return plus @ least.T + minus @ largest.T - slack, plus @ largest.T + minus @ least.T + slack


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as long or as Python's numbers."""
    most = np.abs(x).max(initial=0) * np.abs(y).max(initial=0) * max(1, x.shape[1])
    if most < 2**53:
        return (x @ y.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in m], dtype=object).reshape(m.shape) for m in (x, y)]
    return np.array(whole[0] @ whole[1].T, dtype=object).reshape(len(x), len(y))


def _stacked(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def _empty(kinds: dict[str, str]) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series(dtype=k) for c, k in kinds.items()})


def _wanted(keys: Sequence[str], same_label: bool):
    def group(asks: pd.DataFrame, zones: pd.DataFrame) -> pd.DataFrame:
        if asks.empty or zones.empty:
            return _empty({**{k: str(asks[k].dtype) for k in keys}, "block": "int64"})
        low, high = intervals(
            _stacked(asks["vector"]), _stacked(zones["least"]), _stacked(zones["largest"])
        )
        meets = (high >= asks["low"].to_numpy()[:, None]) & (low <= asks["high"].to_numpy()[:, None])
        alike = asks["label"].to_numpy()[:, None] == zones["label"].to_numpy()[None, :]
        blocks = np.unique(zones["block"].to_numpy()[(meets & (alike == same_label)).any(axis=0)])
        return pd.DataFrame({**{k: [asks[k].iloc[0]] * len(blocks) for k in keys}, "block": blocks})

    return group


def best(scores: np.ndarray, fits: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """(row, column) of the k largest scores of each row where ``fits``, ties to smaller ids."""
    q, n = np.nonzero(fits)
    if not len(q):
        return q, n
    if fits.shape[1] > k and scores.dtype != object:
        kept = np.where(fits, scores, LONG.min)
        kth = np.partition(kept, -k, axis=1)[:, -k]
        q, n = np.nonzero(fits & (scores >= kth[:, None]))
    order = np.lexsort((rows[n], ids[n], -scores[q, n], q))
    q, n = q[order], n[order]
    first = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[first], n[first]


def _long(scores: np.ndarray) -> np.ndarray:
    return np.array([min(max(int(s), LONG.min), LONG.max) for s in scores], dtype=np.int64)


FOUND = {"anchor": "int64", "window": "int64", "id": "int64", "row_key": "int64", "score": "int64"}


def _positives(k: int):
    def group(asks: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        if asks.empty or data.empty:
            return _empty(FOUND)
        ids, rows = data["id"].to_numpy(np.int64), data["row_key"].to_numpy(np.int64)
        own = asks["row_key"].to_numpy(np.int64)
        scores = products(_stacked(asks["vector"]), _stacked(data["vector"]))
        fits = own[:, None] != rows[None, :]
        fits &= (scores >= asks["low"].to_numpy()[:, None]).astype(bool)
        q, n = best(scores, fits, ids, rows, k)
        found = (own[q], np.zeros(len(q), dtype=np.int64), ids[n], rows[n], _long(scores[q, n]))
        return pd.DataFrame(dict(zip(FOUND, found)))

    return group


def _negatives(k: int, percent: int):
    def group(asks: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        if asks.empty or data.empty:
            return _empty(FOUND)
        ids, rows = data["id"].to_numpy(np.int64), data["row_key"].to_numpy(np.int64)
        own = asks["row_key"].to_numpy(np.int64)
        scores = products(_stacked(asks["vector"]), _stacked(data["vector"]))
        other = asks["label"].to_numpy()[:, None] != data["label"].to_numpy()[None, :]
        windows = [list(w) for w in asks["windows"]]
        parts = []
        for w in range(max(map(len, windows))):
            have = np.array([len(own) > w for own in windows])
            top = np.array([int(own[w]) if len(own) > w else 0 for own in windows], dtype=object)
            # in whole numbers: 100 negatives reach percent positives, and no more than the positive
            least = np.array([-(-percent * t // 100) for t in top], dtype=object)
            if scores.dtype != object:
                top, least = _long(top), _long(least)
            inside = (scores >= least[:, None]) & (scores <= top[:, None])
            q, n = best(scores, inside.astype(bool) & other & have[:, None], ids, rows, k)
            found = (own[q], np.full(len(q), w), ids[n], rows[n], _long(scores[q, n]))
            parts.append(pd.DataFrame(dict(zip(FOUND, found))))
        return pd.concat(parts, ignore_index=True)

    return group


def _own(df: DataFrame) -> DataFrame:
    """Columns of its own, as both sides of a group come from the same rows."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


class Blocks:
    """The table of blocks of one run, below the shared folder."""

    def __init__(self, rows: DataFrame, block_rows: int, chunk_rows: int):
        spark = rows.sparkSession
        count, asked, width = rows.agg(
            F.count("*"), F.sum(F.col("asks").cast("long")), F.max(F.size("vector"))
        ).first()
        self.chunk_rows = chunk_rows
        most = max(1, min(SAMPLE, MOST_VALUES // max(1, width or 0)))
        part = F.pmod(F.xxhash64("id", "vector"), F.lit(1 << 30))
        share = int(min(1.0, most / max(1, count)) * (1 << 30)) + 1
        sample = rows.where(part < share).select("vector").limit(2 * most).toArrow()
        cells = {w: Cells(x) for w, _, x in by_width(sample.column("vector").combine_chunks())}
        stretches = max(1, -(-(asked or 0) // chunk_rows))
        kind = "id long, label string, asks boolean, vector array<double>, width int, row_key long"
        placed = rows.select(
            "*", F.size("vector").alias("width"), F.monotonically_increasing_id().alias("row_key")
        ).mapInArrow(
            _placed(spark.sparkContext.broadcast(cells), stretches),
            f"{kind}, place binary, stretch int",
        )
        order = ["width", "label", "place", F.xxhash64("row_key")]
        folder = f"{shared_folder(spark)}/zones-{uuid.uuid4().hex}"
        (
            placed.repartitionByRange(max(1, -(-count // FILE_ROWS)), *order)
            .sortWithinPartitions(*order)
            .mapInArrow(_blocks(block_rows), f"{kind}, place binary, stretch int, block long")
            .drop("place")
            .write.parquet(folder)
        )
        self.table = spark.read.parquet(folder)
        zones = self.table.select("width", "label", "block", "vector").mapInArrow(
            _bounds, "width int, label string, block long, least array<double>, largest array<double>"
        )
        self.zones = materialise(zones)
        parts = max(1, -(-self.zones.count() // ZONE_ROWS))
        self.zones = self.zones.withColumn("zone_part", F.pmod(F.xxhash64("block"), F.lit(parts)))

    def chunks(self, asks: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Anchors in chunks: ``keys``, a stretch of the curve, and parts of it if it has many."""
        own = [*keys, "stretch"]
        parts = F.ceil(F.count("*") / F.lit(self.chunk_rows)).alias("parts")
        part = F.pmod(F.xxhash64("row_key"), F.col("parts")).cast("int")
        return asks.join(asks.groupBy(*own).agg(parts), own).withColumn("part", part).drop("parts")

    def wanted(self, asks: DataFrame, keys: Sequence[str], same_label: bool) -> DataFrame:
        """(chunk, block): blocks whose interval meets [low, high] of an anchor of the chunk."""
        chunk = [*keys, "stretch", "part"]
        there = self.zones.select(*keys, "zone_part").distinct()
        zones = self.zones.join(asks.select(*chunk).distinct(), list(keys))
        group = [*chunk, "zone_part"]
        types = dict(asks.dtypes)
        kind = ", ".join(f"{c} {types[c]}" for c in chunk)
        return (
            _own(asks.join(there, list(keys)))
            .groupBy(*group)
            .cogroup(_own(zones).groupBy(*group))
            .applyInPandas(_wanted(chunk, same_label), f"{kind}, block long")
            .distinct()
        )

    def read(self, asks: DataFrame, wanted: DataFrame, keys: Sequence[str], group) -> DataFrame:
        """Wanted blocks with the anchors of their chunks."""
        chunk = [*keys, "stretch", "part"]
        rows = self.table.select(
            "block", "id", "row_key", "vector", F.col("label").alias("label_of_row")
        )
        data = rows.join(wanted, "block")
        data = data.drop("label").withColumnRenamed("label_of_row", "label")
        return (
            _own(asks.join(wanted, chunk))
            .groupBy(*chunk, "block")
            .cogroup(_own(data).groupBy(*chunk, "block"))
            .applyInPandas(group, "anchor long, window long, id long, row_key long, score long")
        )


def _ranked(found: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "row_key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    k: int = 5,
    percent: int = PERCENT,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and
    each of its k best rows of the same label, the k best rows of other labels that score between
    ``percent`` of the positive's score and that score."""
    number = F.transform(F.col(vector_col), lambda x: x.cast("double") * 256)
    finite = F.forall(
        number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    rows = vectors.where(F.coalesce(finite, F.lit(False)) & label.isNotNull()).select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        label.cast("string").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
        # floor gives a long; from 2**53 on every double is whole
        F.transform(
            number, lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)
        ).alias("vector"),
    )
    blocks = Blocks(rows, block_rows, chunk_rows)
    anchors = blocks.table.where("asks").select(
        "id", "row_key", "label", "width", "stretch", "block", "vector"
    )

    alike = ["width", "label"]
    infinite = F.lit(float("inf"))
    asks = materialise(
        blocks.chunks(anchors, alike).withColumns({"low": -infinite, "high": infinite})
    )
    chunk = [*alike, "stretch", "part"]
    first = asks.select(*chunk, "block").distinct()
    asks = asks.drop("block")
    near = materialise(
        _ranked(blocks.read(asks, first, alike, _positives(k)), ["anchor"], k)
    )
    reached = near.where(F.col("rank") == k).select(
        F.col("anchor").alias("row_key"), F.col("score").cast("double").alias("reached")
    )
    asks = asks.join(reached, "row_key", "left").withColumn(
        "low", F.coalesce("reached", "low")
    )
    more = blocks.wanted(asks, alike, True).join(first, [*chunk, "block"], "left_anti")
    far = blocks.read(asks, more, alike, _positives(k))
    positives = materialise(
        _ranked(near.drop("rank").unionByName(far), ["anchor"], k).withColumn(
            "place", F.col("rank") - 1
        )
    )

    # a window below zero is empty
    windows = positives.where("score >= 0").groupBy(F.col("anchor").alias("row_key")).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("place", "score"))), lambda p: p["score"]
        ).alias("windows")
    )
    bounds = {
        "low": F.array_min("windows").cast("double") * (percent / 100) * (1 - 1e-12),
        "high": F.array_max("windows").cast("double") * (1 + 1e-12),
    }
    asks = materialise(
        blocks.chunks(anchors.drop("block").join(windows, "row_key"), ["width"]).withColumns(bounds)
    )
    wanted = blocks.wanted(asks, ["width"], False)
    found = blocks.read(asks, wanted, ["width"], _negatives(k, percent))
    pairs = positives.select(
        "anchor",
        F.col("place").cast("long").alias("window"),
        F.nullif("id", F.lit(NO_ID)).alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return (
        _ranked(found, ["anchor", "window"], k)
        .withColumn("negative_id", F.nullif("id", F.lit(NO_ID)))
        .withColumnRenamed("score", "negative_score")
        .drop("id", "row_key")
        .join(pairs, ["anchor", "window"])
        .join(
            anchors.select(
                F.col("row_key").alias("anchor"), F.nullif("id", F.lit(NO_ID)).alias("anchor_id")
            ),
            "anchor",
        )
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
