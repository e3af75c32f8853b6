"""Whitening of integer vectors by Golub-Kahan-Lanczos bidiagonalisation.

``A`` is the matrix of centred rows.  Each step is one job that forms ``p = A y`` row
by row and, in the same pass, ``A' p`` and the inner products of ``p`` with all left
vectors so far; partial sums are added up by Spark, and a few numbers for each
dimension reach the driver.  Left vectors are never stored: each is ``A w`` for a
vector ``w`` the driver keeps, so a task that is run again needs nothing but its rows.
Both sides are orthogonalised against all vectors before them.  The singular values
of the small bidiagonal matrix are the deviations, its right vectors turned by the
Lanczos vectors the components.  Rows of one direction more than once, or directions
without deviation, end a Lanczos sequence early; a new start vector carries on.

Cases: vectors that are null, empty or hold null or non-finite entries are left out,
as are vectors with an entry whose scaled integer needs more than 62 bits, and those
that are not as long as most (the longest among lengths equally frequent).  Rows may
repeat and ids may be null; each row counts.  Components without deviation (below
1e-12 of the largest singular value) are not numbered: equal rows, or one, or none give
no rows.  A ``deviation`` beyond 64 bits is null.  Other columns are not carried along,
so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from fileload.llm.text import col
from fileload.session import stage_table

#: Entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: A left vector that leans this much on earlier ones is formed once more.
LEAN = 1e-7
#: Relative sizes below which a norm is nothing, and a Ritz vector is settled.
ZERO, SETTLED = 1e-12, 1e-15

_SUMS = "kind string, i int, value double"


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``id_col`` and ``x``, the usable vectors as integers, written once."""
    c = col(vector_col).cast("array<double>")
    edge = F.lit(2.0**62 / scale)
    usable = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < edge))
    rows = df.where(c.isNotNull() & (F.size(c) > 0)).where(usable)
    x = F.transform(c, lambda v: F.floor(v * scale).cast("long") + F.lit(shift).cast("long"))
    rows = stage_table(rows.select(col(id_col), x.alias("x")), "vectors")
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(2).collect()
    return rows.where(F.size("x") == sizes[0]["d"]) if len(sizes) > 1 else rows


@dataclass(frozen=True)
class Fit:
    """Exact counts and sums of the rows, and what the bidiagonal matrix gave."""

    n: int
    sums: tuple[int, ...]
    #: Unit components as rows, by falling eigenvalue, and the eigenvalues.
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    steps: int
    #: Whether n * x - sum fits in 64 bits, and its squares' sum too.
    narrow: tuple[bool, bool]


def _rows(column: pa.Array, d: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(-1, d)


def _scatter(x: np.ndarray, fit_n: int, sums: tuple[int, ...], narrow: bool) -> np.ndarray:
    """n * x - sum, exactly: Python integers where 64 bits do not hold it."""
    if narrow:
        return x * np.int64(fit_n) - np.array(sums, np.int64)
    return x.astype(object) * fit_n - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...], narrow: bool) -> np.ndarray:
    return (_scatter(x, n, sums, narrow) / n).astype(np.float64)


def _counts(rows: DataFrame) -> tuple[int, list[int], bool, bool]:
    """How many rows, exact sums for each dimension, and whether 64 bits do."""
    limit = 2**62

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = _rows(batch.column(0), len(batch.column(0)[0]))
                wide = int(np.abs(x).max()) * len(x) >= limit
                total = x.astype(object).sum(0) if wide else x.sum(0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(x.shape[1], dtype=np.int32)),
                        pa.array(np.full(x.shape[1], len(x))),
                        pa.array([str(int(s)) for s in total]),
                        pa.array(x.min(0)),
                        pa.array(x.max(0)),
                    ],
                    names=["i", "n", "s", "low", "high"],
                )

    parts = rows.select("x").mapInArrow(run, "i int, n long, s string, low long, high long")
    found = (
        parts.groupBy("i")
        .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.min("low").alias("low"), F.max("high").alias("high"))
        .collect()
    )
    found.sort(key=lambda r: r["i"])
    if not found:
        return 0, [], True, True
    n = found[0]["n"]
    spread = max(n * max(abs(r["low"]), abs(r["high"])) for r in found)
    off = max(max(abs(n * r["low"] - int(r["s"])), abs(n * r["high"] - int(r["s"]))) for r in found)
    return n, [int(r["s"]) for r in found], spread < limit, off * off * len(found) < limit


def _products(rows: DataFrame, n: int, sums: tuple[int, ...], narrow: bool, y: np.ndarray, left: np.ndarray):
    """One alternating product: ``p = A y``; returns ``A' p``, ``U' p`` and ``p' p``,
    the columns of ``left`` giving the left vectors ``U = A left``."""
    d, k = left.shape

    def run(batches):
        grown, lean, norm = np.zeros(d), np.zeros(k), 0.0
        for batch in batches:
            if batch.num_rows:
                a = _centred(_rows(batch.column(0), d), n, sums, narrow)
                p = a @ y
                grown += p @ a
                lean += p @ (a @ left)
                norm += float(p @ p)
        kinds = ["g"] * d + ["c"] * k + ["n"]
        places = np.r_[np.arange(d), np.arange(k), 0].astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds), pa.array(places), pa.array(np.r_[grown, lean, norm])], names=["kind", "i", "value"]
        )

    out = np.zeros(d), np.zeros(k), np.zeros(1)
    place = {"g": out[0], "c": out[1], "n": out[2]}
    for r in rows.select("x").mapInArrow(run, _SUMS).groupBy("kind", "i").agg(F.sum("value").alias("value")).collect():
        place[r["kind"]][r["i"]] = r["value"]
    return out[0], out[1], float(out[2][0])


def _orthogonal(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


def _fresh(basis: np.ndarray, seed: int) -> np.ndarray:
    """A unit vector outside of the basis."""
    v = _orthogonal(np.random.default_rng(seed).standard_normal(len(basis)), basis)
    v = _orthogonal(v / np.linalg.norm(v), basis)
    return v / np.linalg.norm(v)


def fit(rows: DataFrame, components: int = 32) -> Fit:
    """Bidiagonalise the centred rows until the wanted components are settled."""
    n, sums, narrow, short = _counts(rows)
    d, sums = len(sums), tuple(sums)
    empty = Fit(n, sums, np.zeros((0, d)), np.zeros(0), 0.0, 0, (narrow, short))
    if not n:
        return empty
    right, left, grown = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))
    alphas, betas = [], []
    v, beta, size = _fresh(right, 0), 0.0, 0.0
    while True:
        k = len(alphas)
        y = v - beta * left[:, k - 1] if k else v
        g, lean, norm = _products(rows, n, sums, narrow, y, left)
        if np.abs(lean).max(initial=0) > LEAN * np.sqrt(norm):
            y = y - left @ lean
            g, lean, norm = _products(rows, n, sums, narrow, y, left)
        # What still leans on earlier left vectors is taken off without another pass.
        y, g, norm = y - left @ lean, g - grown @ lean, norm - float(lean @ lean)
        alpha = float(np.sqrt(max(norm, 0.0)))
        size = max(size, alpha, beta)
        right = np.column_stack([right, v])
        if alpha <= ZERO * size or alpha == 0.0:
            alpha, w, g = 0.0, np.zeros(d), np.zeros(d)
        else:
            w, g = y / alpha, g / alpha
        left, grown = np.column_stack([left, w]), np.column_stack([grown, g])
        alphas.append(alpha)
        rest = _orthogonal(g, right)
        beta = float(np.linalg.norm(rest))
        bidiagonal = np.diag(alphas) + np.diag(betas, 1)
        p, deviations, q = np.linalg.svd(bidiagonal)
        if len(alphas) == d:
            break
        open_ends = beta * np.abs(p[-1, :components])
        if len(alphas) > components and beta > ZERO * size and (open_ends <= SETTLED * deviations[0]).all():
            break
        if beta <= ZERO * size or beta == 0.0:
            v, beta = _fresh(right, len(alphas)), 0.0
        else:
            v = rest / beta
            v = _orthogonal(v, right)
            v /= np.linalg.norm(v)
        betas.append(beta)
    keep = min(components, int((deviations > ZERO * deviations[0]).sum()))
    found = (right @ q.T).T[:keep]
    found /= np.linalg.norm(found, axis=1, keepdims=True)
    trace = _trace(rows, n, sums, narrow)
    return Fit(n, sums, found, deviations[:keep] ** 2 / n, trace, len(alphas), (narrow, short))


def _trace(rows: DataFrame, n: int, sums: tuple[int, ...], narrow: bool) -> float:
    d = len(sums)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a = _centred(_rows(batch.column(0), d), n, sums, narrow)
                yield pa.RecordBatch.from_arrays([pa.array([float((a * a).sum())])], names=["value"])

    return (rows.select("x").mapInArrow(run, "value double").agg(F.sum("value")).first()[0] or 0.0) / n


def identity_error(rows: DataFrame, fitted: Fit) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    n, sums, narrow, k, d = fitted.n, fitted.sums, fitted.narrow[0], len(fitted.components), len(fitted.sums)
    turn = (fitted.components / np.sqrt(fitted.eigenvalues)[:, None]).T

    def run(batches):
        square, total = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            if batch.num_rows:
                z = _centred(_rows(batch.column(0), d), n, sums, narrow) @ turn
                square += z.T @ z
                total += z.sum(0)
        values = np.r_[square.ravel(), total]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], names=["i", "value"])

    values = np.zeros(k * k + k)
    for r in rows.select("x").mapInArrow(run, "i int, value double").groupBy("i").agg(F.sum("value").alias("value")).collect():
        values[r["i"]] = r["value"]
    mean = values[k * k :] / n
    covariance = values[: k * k].reshape(k, k) / n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max(initial=0))


def whiten(df: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each usable vector and component: its id, ``component`` from 1, ``n``
    rows fitted, ``deviation`` (sum over dimensions of (n * x - sum)**2), ``whitened``,
    ``explained`` (the component's share of the deviations' squares) and
    ``identity_error``.  A component's sign is the one that makes its largest entry
    positive, the same for all rows."""
    rows = integer_vectors(df, id_col, vector_col)
    fitted = fit(rows, components)
    k, d = len(fitted.components), len(fitted.sums)
    schema = StructType(
        [
            rows.schema[id_col],
            StructField("component", IntegerType()),
            StructField("n", LongType()),
            StructField("deviation", LongType()),
            StructField("whitened", DoubleType()),
            StructField("explained", DoubleType()),
            StructField("identity_error", DoubleType()),
        ]
    )
    if not k:
        return df.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, fitted)
    largest = fitted.components[np.arange(k), np.abs(fitted.components).argmax(1)]
    turn = (fitted.components * np.sign(largest)[:, None] / np.sqrt(fitted.eigenvalues)[:, None]).T
    explained = fitted.eigenvalues / fitted.trace
    n, sums, (narrow, short) = fitted.n, fitted.sums, fitted.narrow

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows(batch.column(1), d)
            off = _scatter(x, n, sums, narrow)
            if short and narrow:
                deviation = pa.array((off * off).sum(1))
            else:
                whole = (off.astype(object) ** 2).sum(1).tolist()
                deviation = pa.array([v if v < 2**63 else None for v in whole], pa.int64())
            whitened = (off / n).astype(np.float64) @ turn
            m = len(x)
            row = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(row),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n)),
                    deviation.take(row),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)
