"""Posting lists and hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paneloom.llm import posting_lists as pl
from paneloom.llm import queries
from paneloom.llm import zone_maps as zm
from paneloom.lookup import lookup_table

TABLE = "vec_id long, embedding array<double>, label int, rank int, score int, list int, block int"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def odd_rows(rng, dims):
    """Nulls, repeated rows, one very common vector, other lengths, ties."""
    rows = [(i, [rng.uniform(-1, 1) for _ in range(dims)], i % 4) for i in range(600)]
    rows += [(1000 + i, rows[10][1], 2) for i in range(200)]
    rows += [(100, rows[100][1], 1), (100, rows[100][1], 1), (None, rows[7][1], 0), (None, rows[8][1], 1)]
    rows += [(700, None, 1), (800, [0.0] * dims, 1), (900, [float("nan")] + [0.1] * (dims - 1), 1)]
    rows += [(1300, [float("inf")] + [0.1] * (dims - 1), 1), (1400, [None] * dims, 1), (1500, [], 1)]
    rows += [(1600, [0.5, 0.25], 1), (1700, [0.5, 0.3], 2), (1800, rows[0][1], None)]
    return rows


def frame(spark, rows):
    return lookup_table(spark, [(i, v, y, 1, 2, 3, 4) for i, v, y in rows], TABLE)


# ------------------------------------------------------------------ posting lists


def brute_nearest(rows, asked, k):
    rows = [(n, i, v) for n, (i, v, _) in enumerate(rows) if usable(v) and any(v)]
    out = []
    for p, q, x in rows:
        if q is None or not asked(q):
            continue
        found = sorted(
            (float(np.sqrt(np.square(np.array(x) - np.array(y)).sum())), i is None, i or 0, n)
            for n, i, y in rows
            if n != p and len(y) == len(x)
        )[:k]
        out += [(q, r + 1, None if none else i, s) for r, (s, none, i, _) in enumerate(found)]
    return sorted(out, key=str)


def test_all_lists_read_is_exact(spark, monkeypatch):
    monkeypatch.setattr(pl, "FOUND", 1.0)
    monkeypatch.setattr(pl, "LIST_ROWS", 60)
    rows = odd_rows(random.Random(2), 5)
    monkeypatch.setattr(pl.Index, "_fitted", lambda self, sample, k: float("inf"))
    got = pl.search(frame(spark, rows), F.col("vec_id") % 100 == 0, 10, block_rows=70, query_rows=3)
    assert sorted(map(tuple, got.collect()), key=str) == brute_nearest(rows, lambda q: q % 100 == 0, 10)


def test_few_lists_find_most(spark, monkeypatch):
    """Clustered vectors: a small share of the lists holds nearly all neighbours."""
    monkeypatch.setattr(pl, "LIST_ROWS", 40)
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 4, (60, 8))
    x = centres[rng.integers(0, 60, 3000)] + rng.normal(0, 0.5, (3000, 8))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    got = pl.search(frame(spark, rows), F.col("vec_id") % 20 == 0, 10)
    want = brute_nearest(rows, lambda q: q % 20 == 0, 10)
    assert len(got := [tuple(r) for r in got.collect()]) == len(want)
    assert len({r[::2] for r in got} & {r[::2] for r in want}) >= 0.93 * len(want)
    index = pl.Index.fit(x, 75, 10)
    read = np.mean([len(p) for p in index.probes(x[::20])])
    assert read < 0.2 * len(index.centroids)


def uneven(kind, rng, n=1500, dims=12):
    """Rows whose density varies, or whose squares overflow or cancel."""
    x = rng.normal(0, 1, (n, dims))
    if kind == "half alike":
        x[: n // 2] = x[0]
        x = x[rng.permutation(n)]
    elif kind == "queries apart":
        x = np.repeat(x[: n // 50], 50, axis=0) + rng.normal(0, 1e-3, (n, dims))
        x[::20] = rng.normal(0, 1, (len(x[::20]), dims))
    elif kind == "scales":
        x *= np.exp(rng.normal(0, 3, (n, 1)))
    elif kind == "large":
        x *= 1e200
    elif kind == "far off":
        x += 1e7
    elif kind == "one far row":
        x[7] *= 1e250
    return x


@pytest.mark.parametrize("kind", ["half alike", "queries apart", "scales", "large", "far off", "one far row"])
def test_uneven_rows_lose_no_neighbour(spark, monkeypatch, kind):
    """One ratio for all queries misses neighbours here; the bounds of the lists do not."""
    monkeypatch.setattr(pl, "LIST_ROWS", 30)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(uneven(kind, np.random.default_rng(9)))]
    got = pl.search(frame(spark, rows), F.col("vec_id") % 20 == 0, 10).collect()
    with np.errstate(over="ignore"):
        x = np.array([v for _, v, _ in rows])
        asked = np.arange(0, len(x), 20)
        gaps = pl.distances(np.repeat(x[asked], len(x), axis=0), np.tile(x, (len(asked), 1))).reshape(len(asked), -1)
    gaps[np.arange(len(asked)), asked] = np.inf
    order = np.argsort(gaps, axis=1, kind="stable")[:, :10]
    want = {(int(q), r + 1, int(n)) for q, own in zip(asked, order) for r, n in enumerate(own)}
    assert {(r.query_id, r.rank, r.vec_id) for r in got} == want


def test_bounds_leave_lists_out(spark, monkeypatch):
    """In clustered rows the second reading is small too."""
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 4, (60, 8))
    x = centres[rng.integers(0, 60, 3000)] + rng.normal(0, 0.5, (3000, 8))
    index = pl.Index.fit(x, 75, 10)
    low, high = index.bounds(x)
    true = np.sqrt(np.square(x[:, None] - index.centroids).sum(axis=2))
    assert (low <= true).all() and (true <= high).all() and (high - low).max() < 1e-5
    home = np.array([h[0] for h in index.homes(x)])
    reach = np.array([true[home == c, c].max(initial=0) for c in range(len(index.centroids))])
    kth = np.sort(np.sqrt(pl._squares(x[::20], x)), axis=1)[:, 10:11]
    assert (true[::20] - reach <= kth).mean() < 0.3


def test_balanced_parts():
    x = np.random.default_rng(1).normal(0, 1, (1000, 3))
    x[300:700] = x[0]
    parts = pl.halves(x, 16)
    assert sorted(np.concatenate(parts)) == list(range(1000))
    assert {len(p) for p in parts} <= {62, 63}
    assert [len(p) for p in pl.halves(x[:2], 5)].count(1) == 2


def test_graph_reaches_all_within_the_ratio():
    x = np.random.default_rng(7).normal(0, 1, (4000, 4))
    index = pl.Index.fit(x, 300, 5)
    true = np.sqrt(pl._squares(x[:200], index.centroids))
    want = true <= true.min(axis=1, keepdims=True) * 1.5
    got = np.isfinite(index.near(x[:200], 1.5))
    assert (want & got).sum() >= 0.99 * want.sum() and not (got & ~want).any()


def test_boundary_rows_have_several_lists():
    x = np.random.default_rng(8).normal(0, 1, (2000, 3))
    homes = pl.Index.fit(x, 20, 5).homes(x)
    assert {len(h) for h in homes} > {1} and max(map(len, homes)) <= pl.REPLICAS
    assert all(len(set(h)) == len(h) >= 1 for h in homes)


def test_distances_of_large_and_small_values():
    x = np.array([[3e200, 4e200], [3e-200, 4e-200], [3.0, 4.0], [0.0, 0.0]])
    got = pl.distances(x, np.zeros((4, 2)))
    assert got.tolist() == pytest.approx([5e200, 5e-200, 5.0, 0.0])


def test_no_vectors(spark):
    df = frame(spark, [(0, None, 1), (100, [0.0, 0.0], 1), (200, [1.0], 1)])
    assert pl.search(df, F.col("vec_id") % 100 == 0).count() == 0
    assert pl.search(df.where("false"), F.col("vec_id") % 100 == 0).count() == 0
    alone = frame(spark, [(0, [1.0], 1), (5, [2.0], 1)])
    assert list(map(tuple, pl.search(alone, F.col("vec_id") % 100 == 0).collect())) == [(0, 1, 5, 1.0)]


@pytest.mark.parametrize("table", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_neighbours_query(spark, table):
    rows = [(*r, 0) for r in spark.read.parquet(f"{table}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = brute_nearest(rows, lambda q: q % 100 == 0, 10)
    got = [tuple(r) for r in queries.neighbours(spark, table).collect()]
    assert len(got) == len(want) and [r[:2] for r in sorted(got)] == [r[:2] for r in sorted(want)]
    assert len({r[::2] for r in got} & {r[::2] for r in want}) >= 0.93 * len(want)
    gaps = {(q, i): s for q, _, i, s in brute_nearest(rows, lambda q: q % 100 == 0, 10**9)}
    assert all(s == gaps[q, i] for q, _, i, s in got)


# ------------------------------------------------------------------ hard negatives


def brute_negatives(rows, asked, k=5):
    rows = [
        (n, i, [math.floor(256 * x) for x in v], y)
        for n, (i, v, y) in enumerate(rows)
        if usable(v) and y is not None
    ]
    out = []
    for p, q, x, label in rows:
        if q is None or not asked(q):
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(x, y)), i is None, i or 0, n, other)
            for n, i, y, other in rows
            if n != p and len(y) == len(x)
        )
        for s, none, i, _, _ in [r for r in scored if r[4] == label][:k]:
            fit = [r for r in scored if r[4] != label and 80 * -s <= 100 * -r[0] <= 100 * -s][:k]
            out += [
                (q, None if none else i, rank + 1, None if r[1] else r[2], -s, -r[0])
                for rank, r in enumerate(fit)
            ]
    return sorted(out, key=str)


@pytest.mark.parametrize("dims, block_rows, chunk_rows", [(3, 16, 4), (6, 64, 2), (2, 512, 512)])
def test_hard_negatives(spark, dims, block_rows, chunk_rows):
    rows = odd_rows(random.Random(dims), dims)
    got = zm.hard_negatives(
        frame(spark, rows), F.col("vec_id") % 100 == 0, F.col("label"),
        block_rows=block_rows, chunk_rows=chunk_rows,
    )
    want = brute_negatives(rows, lambda q: q % 100 == 0)
    assert len(want) > 20 and sorted(map(tuple, got.collect()), key=str) == want


def test_hilbert_neighbours_touch():
    """Successive cells of the curve differ by one step in one dimension, and all are visited."""
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.array(np.meshgrid(*[range(1 << bits)] * dims)).reshape(dims, -1).T
        keys = zm.hilbert_keys(cells, bits)
        path = cells[sorted(range(len(keys)), key=keys.__getitem__)]
        assert len(set(keys)) == len(cells)
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_intervals_hold():
    rng = np.random.default_rng(3)
    zones = [np.floor(rng.normal(0, 90, (20, 7))) for _ in range(12)]
    anchors = np.floor(rng.normal(0, 90, (15, 7)))
    low, high = zm.intervals(
        anchors, np.array([z.min(axis=0) for z in zones]), np.array([z.max(axis=0) for z in zones])
    )
    for n, z in enumerate(zones):
        scores = anchors @ z.T
        assert (scores.min(axis=1) >= low[:, n]).all() and (scores.max(axis=1) <= high[:, n]).all()


def test_blocks_are_skipped(spark):
    """Clusters along the curve: an anchor reads few blocks."""
    rng = np.random.default_rng(9)
    centres = rng.normal(0, 1, (8, 4))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    x = centres[rng.integers(0, 8, 2000)] + rng.normal(0, 0.02, (2000, 4))
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(x)]
    df = frame(spark, rows).select(
        F.col("vec_id").alias("id"), F.col("label").cast("string").alias("label"),
        (F.col("vec_id") == 0).alias("asks"), F.transform("embedding", lambda v: F.floor(v * 256).cast("double")).alias("vector"),
    )
    blocks = zm.Blocks(df, 50, 8)
    anchors = blocks.table.where("asks").drop("block")
    own = x[0] * 256 @ (x[0] * 256)
    asks = blocks.chunks(anchors, ["width"]).withColumns({"low": F.lit(0.9 * own), "high": F.lit(own)})
    read, there = blocks.wanted(asks, ["width"], False).count(), blocks.zones.count()
    assert 0 < read < 0.4 * there


def test_large_scores(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) * 2.0**22 for _ in range(3)], i % 3) for i in range(120)]
    got = zm.hard_negatives(frame(spark, rows), F.col("vec_id") % 20 == 0, F.col("label"), block_rows=16)
    assert sorted(map(tuple, got.collect()), key=str) == brute_negatives(rows, lambda q: q % 20 == 0)


def test_no_negatives(spark):
    anchor = F.col("vec_id") % 100 == 0
    df = frame(spark, [(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, None, 2), (3, [1.0, 2.0], None)])
    assert zm.hard_negatives(df, anchor, F.col("label")).count() == 0
    assert zm.hard_negatives(df.where("false"), anchor, F.col("label")).count() == 0


def test_hard_negatives_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = [
        (i, v, (y + 1) % 10 if i % 7 == 0 else y)
        for i, v, y in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    ]
    got = queries.hard_negatives(spark, sf)
    assert sorted(map(tuple, got.collect()), key=str) == brute_negatives(rows, lambda q: q % 100 == 0)
