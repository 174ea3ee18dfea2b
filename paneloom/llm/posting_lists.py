"""Approximate nearest neighbours by balanced posting lists.

A bounded sample is halved again and again into parts of equal size; the parts' means are the centroids.
Every row is indexed: it is written to the list of its nearest centroid and, near a boundary, to the
lists of further ones (within ``NEAR`` times the least distance, at most ``REPLICAS``). Centroids are searched by a graph in memory (near
ones linked, and a ring) that is walked as long as it finds centroids within a ratio of the least
distance. The lists within that ratio are read by a query first. The ratio is fitted: the least one at
which the sample's own neighbours are found with probability ``FOUND``; the whole table is denser than
the sample, so its neighbours lie nearer.

One ratio doesn't suit every query where density varies, so the lists left out are checked. Of each
list the least and largest distance of its rows to the centroid are known, over all rows; by the
triangle inequality these bound the distance of any of its rows to a query. Lists that may hold a row as
near as the k-th found are read too, once, by the first list of each row. So the result is exact for
any rows; what varies is how many lists are read (all, where distances tell little, as in random
directions of many dimensions).

Bounds: the sample has at most ``MOST_LISTS`` * ``ROWS_PER_LIST`` rows and ``MOST_VALUES`` numbers;
centroids and graph, all that is broadcast, have ``MOST_LISTS`` entries. A list longer than
``BLOCK_ROWS`` is read in blocks, its queries in parts of ``QUERY_ROWS``: no group grows with a list.

Definitions: vectors that are null, zero, empty or hold null or non-finite components take no part;
vectors are compared with those of equal length only. A row is not its own candidate, a repeated row is
another row. Ties go to the smaller vec_id, null last. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.llm.common import numbered
from paneloom.session import materialise

LIST_ROWS = 256
MOST_LISTS = 16_384
ROWS_PER_LIST = 16
LEAST_SAMPLE = 16_384
MOST_VALUES = 1 << 24
LINKS = 16
REPLICAS = 4
NEAR = 1.06
FOUND = 0.97
PROBES = 256  # sample rows for which the ratio is fitted
BLOCK_ROWS = 4096
QUERY_ROWS = 1024
FAR = 1e100  # units from the centre beyond which a vector is cut
NO_ID = 2**63 - 1  # stands for a null id inside the groups


def halves(x: np.ndarray, parts: int) -> list[np.ndarray]:
    """Rows of ``x`` in ``parts`` parts of equal size, neighbours next to each other."""
    todo, done = [(np.arange(len(x)), parts)], []
    while todo:
        rows, n = todo.pop()
        if n == 1 or len(rows) < 2:
            done.append(rows)
            continue
        own = x[rows]
        left = n // 2
        cut = max(1, min(len(rows) - 1, len(rows) * left // n))
        a = own[np.square(own - own.mean(axis=0)).sum(axis=1).argmax()]
        b = own[np.square(own - a).sum(axis=1).argmax()]
        for _ in range(6):
            order = np.argsort(own @ (b - a), kind="stable")
            a, b = own[order[:cut]].mean(axis=0), own[order[cut:]].mean(axis=0)
        todo += [(rows[order[cut:]], n - left), (rows[order[:cut]], left)]
    return done


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    gaps = np.square(x).sum(axis=1)[:, None] + np.square(y).sum(axis=1) - 2 * x @ y.T
    return np.maximum(gaps, 0)


@dataclass
class Index:
    """Centroids, the graph that joins them, and the ratio up to which lists are read."""

    centroids: np.ndarray
    links: np.ndarray
    ratio: float = 1.0
    centre: np.ndarray | float = 0.0
    unit: float = 1.0

    def placed(self, x: np.ndarray) -> np.ndarray:
        """Vectors about the sample's centre, in units of its size: sums of squares neither cancel
        nor overflow (beyond ``FAR`` units a vector is cut, see ``bounds``)."""
        with np.errstate(over="ignore"):
            return np.clip(x / self.unit - self.centre, -FAR, FAR)

    def bounds(self, x: np.ndarray, at: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest distance, rounding included, of placed rows to the centroids ``at``:
        to all of them, or row by row to one each. A row that was cut may be anywhere."""
        c = self.centroids[at]
        if isinstance(at, slice):
            gaps, size = _squares(x, c), np.square(x).sum(axis=1)[:, None] + np.square(c).sum(axis=1)
        else:
            gaps, size = np.square(x - c).sum(axis=1), np.square(x).sum(axis=1) + np.square(c).sum(axis=1)
        # the place itself is rounded too, by the size of the original vector
        moved = 1e-15 * (1 + np.abs(self.centre).max(initial=0)) * x.shape[1]
        slack = 1e-15 * (x.shape[1] + 4) * size
        low = np.maximum(np.sqrt(np.maximum(gaps - slack, 0)) - moved, 0)
        high = np.sqrt(gaps + slack) + moved
        cut = (np.abs(x) >= FAR).any(axis=1)
        low[cut], high[cut] = 0, np.inf
        return low, high

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int, k: int) -> Index:
        centroids = np.array([sample[rows].mean(axis=0) for rows in halves(sample, lists)])
        _, first = np.unique(centroids, axis=0, return_index=True)
        centroids = centroids[np.sort(first)]
        count = len(centroids)
        near = [
            _squares(centroids[i : i + 1024], centroids).argsort(axis=1)[:, : LINKS + 1]
            for i in range(0, count, 1024)
        ]
        at = np.arange(count)[:, None]
        links = np.concatenate([*near]) if near else np.zeros((0, 1), dtype=np.int64)
        index = cls(centroids, np.concatenate([links, (at + 1) % count, (at - 1) % count], axis=1))
        index.ratio = index._fitted(sample, k)
        return index

    def near(self, x: np.ndarray, ratio: float) -> np.ndarray:
        """Distances of the centroids that the graph finds within ``ratio`` of the nearest one;
        infinite for others."""
        count = len(self.centroids)
        gaps = np.full((len(x), count), np.inf)
        walked = np.zeros(gaps.shape, dtype=bool)
        starts = np.arange(0, count, max(1, int(count**0.5)))
        gaps[:, starts] = np.sqrt(_squares(x, self.centroids[starts]))
        while True:
            limit = gaps.min(axis=1, keepdims=True) * ratio
            rows, nodes = np.nonzero((gaps <= limit) & ~walked)
            if not len(rows):
                return np.where(gaps <= limit, gaps, np.inf)
            walked[rows, nodes] = True
            found = np.zeros(gaps.shape, dtype=bool)
            found[rows[:, None], self.links[nodes]] = True
            rows, nodes = np.nonzero(found & np.isinf(gaps))
            for i in range(0, len(rows), 16_384):
                r, c = rows[i : i + 16_384], nodes[i : i + 16_384]
                gaps[r, c] = np.sqrt(np.square(x[r] - self.centroids[c]).sum(axis=1))

    def homes(self, x: np.ndarray) -> list[list[int]]:
        """The lists that hold each row, the nearest first."""
        out: list[list[int]] = []
        for i in range(0, len(x), 512):
            gaps = self.near(x[i : i + 512], NEAR)
            order = np.argsort(gaps, axis=1, kind="stable")[:, :REPLICAS]
            kept = np.isfinite(np.take_along_axis(gaps, order, axis=1))
            out += [own[k].tolist() for own, k in zip(order, kept)]
        return out

    def probes(self, x: np.ndarray) -> list[list[int]]:
        """The lists that each query reads."""
        out: list[list[int]] = []
        for i in range(0, len(x), 512):
            gaps = self.near(x[i : i + 512], self.ratio)
            out += [np.flatnonzero(row < np.inf).tolist() for row in gaps]
        return out

    def _fitted(self, sample: np.ndarray, k: int) -> float:
        if len(sample) < 2 or len(self.centroids) < 2:
            return 1.0
        asked = np.arange(0, len(sample), max(1, len(sample) // PROBES))[:PROBES]
        gaps = _squares(sample[asked], sample)
        gaps[np.arange(len(asked)), asked] = np.inf
        nearest = gaps.argsort(axis=1)[:, : min(k, len(sample) - 1)]
        homes = dict(zip(found := np.unique(nearest), self.homes(sample[found])))
        lists = np.sqrt(_squares(sample[asked], self.centroids))
        least = np.maximum(lists.min(axis=1), np.finfo(float).tiny)
        needed = [
            lists[q, homes[n]].min() / least[q] for q, own in enumerate(nearest) for n in own
        ]
        return float(max(1.0, np.quantile(needed, FOUND))) * (1 + 1e-9)


def _by_width(vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, positions, matrix) of the vectors of each length."""
    widths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        values = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield int(width), at, values.astype(np.float64).reshape(len(at), int(width))


def fit(rows: DataFrame, k: int) -> dict[int, Index]:
    """An index for each length of vectors, from a bounded sample."""
    count, width = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not count:
        return {}
    lists = min(MOST_LISTS, -(-count // LIST_ROWS))
    most = max(1, min(max(LEAST_SAMPLE, lists * ROWS_PER_LIST), MOST_VALUES // width))
    part = F.pmod(F.xxhash64("id", "vector"), F.lit(1 << 30))
    sample = rows.where(part < int(min(1.0, most / count) * (1 << 30)) + 1)
    vectors = sample.select("vector").limit(2 * most).toArrow().column("vector").combine_chunks()
    out = {}
    for width, _, x in _by_width(vectors):
        unit = float(np.abs(x).max())
        centre = (x / unit).mean(axis=0)
        placed = x / unit - centre
        # once more, for vectors that lie close together far from zero
        near = float(np.abs(placed).max())
        if 0 < near and near * unit > 0:
            unit, centre, placed = unit * near, centre / near, placed / near
        out[width] = Index.fit(placed, max(1, min(lists * len(x) // max(1, len(vectors)), len(x))), k)
        out[width].centre, out[width].unit = centre, unit
    return out


def _post(indexes):
    """Lists of every row, its least and largest distance to the first one's centroid, and the lists
    that a query reads. A length that the sample lacks has one list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = indexes.value
        for batch in batches:
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            homes: list = [[0]] * len(asks)
            probes: list = [[0] if a else [] for a in asks]
            low, high = np.zeros(len(asks)), np.full(len(asks), np.inf)
            for width, at, x in _by_width(batch.column("vector")):
                if width not in known:
                    continue
                x = known[width].placed(x)
                for i, own in zip(at, known[width].homes(x)):
                    homes[i] = own
                low[at], high[at] = known[width].bounds(x, np.array([homes[i][0] for i in at]))
                own = at[asks[at]]
                for i, read in zip(own, known[width].probes(x[asks[at]])):
                    probes[i] = read
            kind = pa.list_(pa.int32())
            yield pa.record_batch(
                [*batch.columns, pa.array(homes, kind), pa.array(probes, kind), pa.array(low), pa.array(high)],
                [*batch.schema.names, "homes", "probes", "low", "high"],
            )

    return run


def _left_out(indexes, spans):
    """The lists that a query hasn't read and that may hold a row as near as its k-th one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ends = indexes.value, spans.value
        for batch in batches:
            probes = batch.column("probes").to_pylist()
            kth = batch.column("kth").to_numpy(zero_copy_only=False)
            more: list = [[]] * len(kth)
            for width, at, x in _by_width(batch.column("vector")):
                if width not in known:
                    continue  # has one list
                index = known[width]
                lists, low, high = ends[width]
                for i in range(0, len(at), 512):
                    own = at[i : i + 512]
                    least, most = (g[:, lists] for g in index.bounds(index.placed(x[i : i + 512])))
                    reach = (kth[own] / index.unit * (1 + 1e-9))[:, None]
                    # a list is left out if all its rows are surely farther, inwards or outwards
                    open_ = ~((least - high > reach) | (low - most > reach))
                    for j, row in zip(own, open_):
                        read = lists[row]
                        more[j] = read[~np.isin(read, probes[j])].tolist()
            yield pa.record_batch(
                [*(batch.column(c) for c in ("id", "row_key", "vector", "kth")), pa.array(more, pa.list_(pa.int32()))],
                ["id", "row_key", "vector", "kth", "more"],
            )

    return run


def nearest(queries, query_rows, data, ids, rows, k: int):
    """(query position, data position, distance) of the k nearest of ``data`` for each query."""
    # products only choose candidates; their distances are taken from the differences
    unit = max(np.abs(queries).max(initial=0), np.abs(data).max(initial=0)) or 1.0
    gaps = _squares(queries / unit, data / unit)
    gaps[query_rows[:, None] == rows[None, :]] = np.inf
    kth = np.partition(gaps, min(k, len(rows)) - 1, axis=1)[:, min(k, len(rows)) - 1]
    slack = 1e-12 * queries.shape[1] * (1 + np.where(kth < np.inf, kth, 0))
    q, n = np.nonzero((gaps <= (kth + slack)[:, None]) & (gaps < np.inf))
    scores = np.empty(len(q))
    for i in range(0, len(q), 16_384):
        part = slice(i, i + 16_384)
        scores[part] = distances(queries[q[part]], data[n[part]])
    order = np.lexsort((rows[n], ids[n], scores, q))
    q, n, scores = q[order], n[order], scores[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return q[place < k], n[place < k], scores[place < k]


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances row by row; only very large or small ones are scaled."""
    gaps = np.abs(x - y)
    most = gaps.max(axis=1, initial=0)
    unit = np.where((most > 0) & ((most > 1e140) | (most < 1e-140)), most, 1.0)[:, None]
    return np.sqrt(np.square(gaps / unit).sum(axis=1)) * unit[:, 0]


def _search(k: int):
    columns = ["query_row", "query_id", "vec_id", "row_key", "score"]

    def group(key, queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or data.empty:
            return pd.DataFrame({c: pd.Series(dtype="float64" if c == "score" else "int64") for c in columns})
        ids, rows = data["id"].to_numpy(np.int64), data["row_key"].to_numpy(np.int64)
        asked = queries["row_key"].to_numpy(np.int64)
        q, n, scores = nearest(
            np.stack(queries["vector"].to_numpy()).astype(np.float64),
            asked,
            np.stack(data["vector"].to_numpy()).astype(np.float64),
            ids,
            rows,
            k,
        )
        # what a query has found already bounds what leaves the list
        kept = scores <= queries["kth"].to_numpy(np.float64)[q]
        q, n, scores = q[kept], n[kept], scores[kept]
        own = queries["id"].to_numpy(np.int64)[q]
        return pd.DataFrame(dict(zip(columns, (asked[q], own, ids[n], rows[n], scores))))

    return group


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows found for each row where ``is_query``."""
    number = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = F.forall(
        number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    usable = F.coalesce(finite & F.exists(number, lambda x: x != 0), F.lit(False))
    rows = vectors.where(usable).select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
        number.alias("vector"),
    )
    indexes = vectors.sparkSession.sparkContext.broadcast(fit(rows, k))
    kind = "id long, asks boolean, vector array<double>, homes array<int>, probes array<int>, low double, high double"
    posted = numbered(rows.mapInArrow(_post(indexes), kind)).withColumn("width", F.size("vector"))
    narrow = ["width", "id", "row_key", "vector"]
    order = Window.partitionBy("query_row").orderBy("score", "vec_id", "row_key")

    def best(found: DataFrame) -> DataFrame:
        ranked = found.dropDuplicates(["query_row", "row_key"]).withColumn("rank", F.row_number().over(order))
        return ranked.where(F.col("rank") <= k)

    first = materialise(best(_read(
        posted.select(*narrow, F.lit(float("inf")).alias("kth"), F.explode("probes").alias("list")),
        posted.select(*narrow, F.explode("homes").alias("list")),
        k, block_rows, query_rows,
    )))
    # at most MOST_LISTS rows for each length of vectors
    ends: dict[int, list] = {}
    spans = posted.groupBy("width", F.element_at("homes", 1).alias("list")).agg(F.min("low"), F.max("high"))
    for width, *span in spans.orderBy("width", "list").collect():
        ends.setdefault(width, []).append(span)
    ends = {w: (np.array([s[0] for s in of]), *np.array([s[1:] for s in of], dtype=float).T) for w, of in ends.items()}
    # infinite while fewer than k are found
    kth = first.where(F.col("rank") == k).select(F.col("query_row").alias("row_key"), F.col("score").alias("kth"))
    asked = posted.where("asks").join(kth, "row_key", "left").fillna(float("inf"), ["kth"])
    more = asked.select("id", "row_key", "vector", "probes", "kth").mapInArrow(
        _left_out(indexes, vectors.sparkSession.sparkContext.broadcast(ends)),
        "id long, row_key long, vector array<double>, kth double, more array<int>",
    )
    more = materialise(more.withColumn("width", F.size("vector")).select(*narrow, "kth", F.explode("more").alias("list")))
    rest = _read(
        more, posted.select(*narrow, F.element_at("homes", 1).alias("list")), k, block_rows, query_rows
    )
    return (
        best(first.drop("rank").unionByName(rest))
        .withColumns({c: F.nullif(c, F.lit(NO_ID)) for c in ("query_id", "vec_id")})
        .select("query_id", "rank", "vec_id", "score")
    )


def _read(queries: DataFrame, data: DataFrame, k: int, block_rows: int, query_rows: int) -> DataFrame:
    """The k nearest rows in each list, for each of its queries, as far as they are within ``kth``;
    ``queries`` and ``data`` are (width, id, row_key, vector, list), queries with ``kth``."""

    def places(rows: DataFrame, column: str, most: int) -> DataFrame:
        parts = F.ceil(F.count("*") / F.lit(most)).cast("int").alias(f"{column}_parts")
        return rows.groupBy("width", "list").agg(parts)

    # at most MOST_LISTS rows for each length of vectors
    sizes = F.broadcast(
        places(data, "homes", block_rows).join(places(queries, "probes", query_rows), ["width", "list"])
    )

    keys = ["width", "list", "homes", "probes"]

    def dealt(rows: DataFrame, own: str, other: str, *more: str) -> DataFrame:
        """Rows of each list, dealt into ``own`` parts and copied to all ``other`` parts."""
        part = F.pmod(F.xxhash64("row_key"), F.col(f"{own}_parts")).cast("int")
        return (
            rows.join(sizes, ["width", "list"])
            .withColumn(own, part)
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1)))
            # aliases, as both sides come from the same rows
            .select(*[F.col(c).alias(c) for c in (*keys, "id", "row_key", "vector", *more)])
        )

    return (
        dealt(queries, "probes", "homes", "kth")
        .groupBy(*keys)
        .cogroup(dealt(data, "homes", "probes").groupBy(*keys))
        .applyInPandas(
            _search(k), "query_row long, query_id long, vec_id long, row_key long, score double"
        )
    )
