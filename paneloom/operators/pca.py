"""Principal components of a factor matrix.

Each task reduces its rows to their count, means and k x k centred moments, which are merged row by
row of that matrix in two steps; the driver receives the k rows, solves the k x k eigenproblem and
the scores are plain column expressions again. The plan has the same size for any number of factors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom.operators.panel import wide_to_long
from paneloom.operators.ranking import _sum_left_to_right


@dataclass(frozen=True)
class Components:
    names: tuple[str, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]
    loadings: np.ndarray  # (n_components, k)
    explained: np.ndarray  # variance ratio per component

    @property
    def columns(self) -> list[str]:
        return [f"PC{i + 1}" for i in range(len(self.loadings))]


@dataclass(frozen=True)
class Moments:
    names: tuple[str, ...]
    n: int
    means: np.ndarray
    covariance: np.ndarray  # population

    @property
    def scales(self) -> np.ndarray:
        """Population deviations; 1 for a constant column."""
        deviation = np.sqrt(np.diag(self.covariance))
        tiny = 10 * np.finfo(float).eps * np.maximum(np.abs(self.means), 1.0)
        return np.where(deviation <= tiny, 1.0, deviation)


#: Task results that one merging group of the first step takes.
MERGED_AT_ONCE = 256
PARTIAL = "i int, part int, n bigint, means array<double>, moments array<double>"


def _merge(a: tuple, b: tuple) -> tuple:
    """Count, means and centred moments of two sets of rows together (pairwise update)."""
    n = a[0] + b[0]
    delta = b[1] - a[1]
    cross = np.multiply.outer(b[2] - a[2], delta) * (a[0] * b[0] / n)
    return n, a[1] + delta * (b[0] / n), a[2] + (b[2] - a[2]) * (b[0] / n), a[3] + b[3] + cross


def _partial_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per matrix row of a task's own moments."""
    whole = None
    for batch in batches:
        if not batch.num_rows:
            continue
        x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        means = x.mean(axis=0)
        x = x - means
        here = (len(x), means, means, x.T @ x)
        whole = here if whole is None else _merge(whole, here)
    if whole is None:
        return
    n, means, _, moments = whole
    k, part = len(means), TaskContext.get().partitionId()
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(range(k), pa.int32()),
            pa.array([part] * k, pa.int32()),
            pa.array([n] * k, pa.int64()),
            pa.array([means] * k, pa.list_(pa.float64())),
            pa.array(list(moments), pa.list_(pa.float64())),
        ],
        ["i", "part", "n", "means", "moments"],
    )


def _merged_rows(rows: pd.DataFrame) -> pd.DataFrame:
    """The partial results of one matrix row, in the order of their parts, as one."""
    rows = rows.sort_values("part")
    i, part = int(rows["i"].iloc[0]), int(rows["part"].iloc[0])
    whole = None
    for n, means, moments in zip(rows["n"], rows["means"], rows["moments"]):
        means = np.asarray(means)
        here = (n, means, means[i], np.asarray(moments))
        whole = here if whole is None else _merge(whole, here)
    n, means, _, moments = whole
    return pd.DataFrame([(i, part, n, means, moments)], columns=list(rows.columns))


def _moment_rows(matrix: DataFrame, names: Sequence[str]) -> DataFrame:
    """(i, n, means, moments), one row per factor; rows with a missing value take no part."""
    values = matrix.select(*[F.col(f"`{n}`").cast("double").alias(f"c{i}") for i, n in enumerate(names)])
    partial = values.na.drop().mapInArrow(_partial_moments, PARTIAL)
    block = F.floor(F.col("part") / F.lit(MERGED_AT_ONCE))
    return (
        partial.groupBy("i", block)
        .applyInPandas(_merged_rows, PARTIAL)
        .groupBy("i")
        .applyInPandas(_merged_rows, PARTIAL)
        .drop("part")
    )


def matrix_moments(matrix: DataFrame, names: Sequence[str]) -> Moments:
    """Count, means and covariances of the complete rows of a matrix."""
    rows = sorted(_moment_rows(matrix, names).collect())  # one per factor
    if not rows:
        raise ValueError("no complete factor rows")
    n = rows[0]["n"]
    moments = np.array([r["moments"] for r in rows])
    return Moments(tuple(names), n, np.array(rows[0]["means"]), (moments + moments.T) / (2 * n))


def covariance_table(matrix: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same covariances as rows (factor_a, factor_b, covariance), each pair once; NULL over no rows."""
    label = F.array(*[F.lit(n) for n in names])
    found = _moment_rows(matrix, names).select("i", "n", F.posexplode("moments").alias("j", "moment"))
    pairs = matrix.sparkSession.range(len(names)).select(
        F.col("id").cast("int").alias("i"),
        F.explode(F.sequence(F.col("id").cast("int"), F.lit(len(names) - 1))).alias("j"),
    )
    return pairs.join(found, ["i", "j"], "left").select(
        F.element_at(label, F.col("i") + 1).alias("factor_a"),
        F.element_at(label, F.col("j") + 1).alias("factor_b"),
        (F.col("moment") / F.col("n")).alias("covariance"),
    )


def _z(means: Sequence[float], scales: Sequence[float], names: Sequence[str]) -> list[Column]:
    return [
        (F.col(f"`{n}`") - F.lit(float(m))) / F.lit(float(s))
        for n, m, s in zip(names, means, scales)
    ]


def standardise(
    matrix: DataFrame, names: Sequence[str], keys: Sequence[str] = ("date", "asset")
) -> DataFrame:
    """Every factor minus its mean over its population deviation."""
    moments = matrix_moments(matrix, names)
    z = _z(moments.means, moments.scales, names)
    return matrix.select(*keys, *[c.alias(n) for c, n in zip(z, names)])


def fit_components(
    matrix: DataFrame, names: Sequence[str], n_components: int | None = None
) -> Components:
    """Components of the standardised complete matrix (population deviation, constant column / 1).

    ``n_components`` defaults to one less than the number of factors and is kept within 1..k. Signs
    are fixed: the first loading of largest magnitude is positive.
    """
    k = len(names)
    moments = matrix_moments(matrix, names)
    scales = moments.scales
    values, vectors = np.linalg.eigh(moments.covariance / np.outer(scales, scales))
    order = np.argsort(values)[::-1]
    values, vectors = np.maximum(values[order], 0.0), vectors[:, order].T
    wanted = k - 1 if n_components is None else n_components
    wanted = max(1, min(wanted, k))
    for v in vectors:
        magnitude = np.abs(v)
        lead = int(np.argmax(magnitude >= magnitude.max() - 1e-12))
        if v[lead] < 0:
            v *= -1
    total = values.sum()
    explained = values / total if total else values
    return Components(
        tuple(names),
        tuple(float(m) for m in moments.means),
        tuple(float(s) for s in scales),
        vectors[:wanted],
        explained[:wanted],
    )


def component_scores(
    matrix: DataFrame, components: Components, keys: Sequence[str] = ("date", "asset")
) -> DataFrame:
    z = _z(components.means, components.scales, components.names)
    scores = [
        _sum_left_to_right([c * F.lit(float(w)) for c, w in zip(z, loading)]).alias(name)
        for name, loading in zip(components.columns, components.loadings)
    ]
    return matrix.select(*keys, *scores)


def select_components(
    scores: DataFrame,
    n_components: int,
    wanted: Sequence[int],
    prefix: str = "",
    keys: Sequence[str] = ("date", "asset"),
) -> DataFrame:
    """Chosen components (1-based) as factors in long form; numbers out of range are left out."""
    valid = [c for c in wanted if 1 <= c <= n_components]
    if not valid:
        raise ValueError(f"no component of {list(wanted)} lies in 1..{n_components}")
    labelled = scores.select(*keys, *[F.col(f"PC{c}").alias(f"{prefix}PC{c}") for c in valid])
    return wide_to_long(labelled, list(keys))
