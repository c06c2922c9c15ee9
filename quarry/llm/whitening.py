"""PCA whitening of embeddings; eigenvectors refined from single to extended precision.

*Fit*.  Vectors become integers x = floor(64 c) + 1000000.  One pass sums n
and x, a second one the products of x - m, m being the rounded mean, so the
sums are integers that a double holds exactly (below 2^53) and don't depend on
how the rows are split; the fraction of the mean is taken off afterwards.  A
task reports one packed row per matrix row, and these are added in two levels,
so that no group grows with the number of tasks.  The driver sees a d x d
matrix, whose size the dimension bounds.

*Eigenvectors*.  LAPACK in float32 gives a first basis, which Ogita and
Aishima's iteration corrects by matrix products alone: with R = I - X'X and
S = X'VX the correction is E_ij = (S_ij + e_j R_ij) / (e_j - e_i), or R_ij / 2
where two eigenvalues are closer than the error of S.  It runs in double, and
at last in extended precision.  Vectors of such a cluster are turned by the
eigenvectors of the small matrix X_c'(V - mu I)X_c (a sub-solve), in which the
differences of close eigenvalues are no longer hidden by their size.

Results for odd rows: a null vector, or one with a null or non-finite entry,
is dropped; so is one whose length is not the commonest (of equally common
ones the longest).  |64 c| above 2^30 counts as 2^30.  A deviation that a long
can't hold is null.  A direction without variance (its eigenvalue is rounding
error) has a null ``whitened`` and ``explained`` 0.  Rows that repeat an id,
or have none, are rows of their own.  No vectors, no rows.  Further columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Rows of a batch that are held as doubles at once.
BATCH_ROWS = 4096
#: Groups in which the tasks' partial sums are added before the last sum.
FAN_IN = 64

_LIMIT = 2.0 ** 30


def vectors(batches: Iterator[pa.RecordBatch], size: int | None = None) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, x) of the usable vectors of one length, or of each length in turn if none is given."""
    for whole in batches:
        for at in range(0, whole.num_rows, BATCH_ROWS):
            batch = whole.slice(at, BATCH_ROWS)
            column = batch.column(1).cast(pa.large_list(pa.float64()))
            lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
            for n in sorted(set(lengths.tolist()) - {-1, 0}) if size is None else [size]:
                picked = np.flatnonzero(lengths == n)
                flat = pc.list_flatten(column.take(pa.array(picked)))
                c = flat.to_numpy(zero_copy_only=False).reshape(len(picked), n)    # nulls arrive as NaN
                good = np.isfinite(c).all(axis=1)
                x = np.clip(np.floor(SCALE * c[good]), -_LIMIT, _LIMIT).astype(np.int64) + OFFSET
                if len(x):
                    yield batch.column(0).take(pa.array(picked[good])), x


def column_sums(table: DataFrame) -> tuple[int, np.ndarray]:
    """n and the sums of x, over the vectors of the commonest length."""
    def run(batches):
        found: dict[int, list] = {}
        for _, x in vectors(batches):
            held = found.setdefault(x.shape[1], [0, np.zeros(x.shape[1], np.int64)])
            held[0] += len(x)
            held[1] += x.sum(axis=0)
        for size, (n, total) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * size, pa.int32()), pa.array(np.arange(size), pa.int32()),
                 pa.array([n] * size, pa.int64()), pa.array(total)], names=["size", "i", "n", "total"])

    sums = (table.mapInArrow(run, "size int, i int, n long, total long")
            .groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
    # a row per length: the commonest one comes to the driver, as long as a vector
    best = (sums.groupBy("size").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", "total"))).alias("totals"))
            .orderBy(F.desc("n"), F.desc("size")).limit(1).collect())
    if not best:
        return 0, np.zeros(0, np.int64)
    return best[0].n, np.array([t.total for t in best[0].totals], np.int64)


def _added(rows: DataFrame, *keys: str) -> DataFrame:
    """(i, part, row): the packed rows added up for each value of the keys."""
    def run(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(r.as_buffer()) for r in group.column("row"))
        return pa.table({"i": group.column("i").slice(0, 1), "part": group.column("part").slice(0, 1),
                         "row": pa.array([total.tobytes()], pa.binary())})

    return rows.groupBy(*keys).applyInArrow(run, "i int, part int, row binary")


def scatter(table: DataFrame, size: int, project) -> np.ndarray:
    """Sum of y'y over all vectors, y = ``project`` of a block of them."""
    def run(batches):
        from pyspark import TaskContext

        total = None
        for _, x in vectors(batches, size):
            y = project(x)
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            part = TaskContext.get().partitionId() % FAN_IN
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total)), pa.int32()), pa.array([part] * len(total), pa.int32()),
                 pa.array([r.tobytes() for r in total], pa.binary())], names=["i", "part", "row"])

    partial = _added(table.mapInArrow(run, "i int, part int, row binary"), "i", "part")
    return np.array([np.frombuffer(r.row) for r in _added(partial, "i").orderBy("i").collect()])


def covariance(table: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """n, the sums S of x and the covariance of x (divisor n)."""
    n, total = column_sums(table)
    if not n:
        return 0, total, np.zeros((0, 0))
    middle = np.floor_divide(2 * total + n, 2 * n)
    products = scatter(table, len(total), lambda x: (x - middle).astype(np.float64))
    rest = np.array([int(s) - n * int(m) for s, m in zip(total, middle)], np.longdouble) / n
    return n, total, (products.astype(np.longdouble) / n - np.outer(rest, rest)).astype(np.float64)


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Index groups of at least two eigenvalues (sorted) whose neighbours are closer than ``gap``."""
    cut = np.flatnonzero(np.abs(np.diff(values)) > gap) + 1
    return [g for g in np.split(np.arange(len(values)), cut) if len(g) > 1]


def refine(matrix: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One step of Ogita and Aishima: eigenvalues, the corrected basis and the width of a cluster."""
    n = len(matrix)
    away = np.eye(n, dtype=basis.dtype) - basis.T @ basis
    inner = basis.T @ (matrix @ basis)
    values = np.diag(inner) / (1 - np.diag(away))
    off = inner - np.diag(values)
    norm = lambda m: float(np.sqrt((np.abs(m) ** 2).sum()))  # noqa: E731 - an upper bound of the spectral norm
    gap = 2 * (norm(off) + float(np.abs(values).max(initial=0)) * norm(away))
    apart = values[None, :] - values[:, None]
    close = np.abs(apart) <= gap
    step = np.where(close, away / 2, (inner + values[None, :] * away) / np.where(close, 1, apart))
    return values, basis + basis @ step, gap


def eigenpairs(matrix: np.ndarray, steps: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, to double precision."""
    n = len(matrix)
    if not n:
        return np.zeros(0), np.zeros((0, 0))
    scale = float(np.abs(matrix).max()) or 1.0
    values, basis = np.linalg.eigh((matrix / scale).astype(np.float32))
    order = np.argsort(-values, kind="stable")
    basis = basis[:, order]
    for kind, count in ((np.float64, steps), (np.longdouble, 3)):
        a, x, last = (matrix / scale).astype(kind), basis.astype(kind), np.inf
        floor = 16 * n * float(np.finfo(kind).eps)
        for _ in range(count):
            values, new, gap = refine(a, x)
            change = float(np.abs(new - x).max())
            x = new
            order = np.argsort(-values, kind="stable")
            values, x = values[order], x[:, order]
            groups = _clusters(values, max(gap, floor))
            for g in groups:
                # the cluster alone, its common part taken off, in which close eigenvalues are far apart
                part, mu = x[:, g], values[g].mean()
                small = part.T @ (a @ part - mu * part)
                small = ((small + small.T) / 2).astype(np.float64)
                size = float(np.abs(small).max()) or 1.0
                turned = np.linalg.eigh(small / size)[1][:, ::-1]
                x[:, g] = part @ turned.astype(kind)
            if change <= floor and (not groups or change >= last):
                break
            last = change
        basis = x
    # the sub-solves' turns are orthogonal to double precision only
    basis = basis @ (1.5 * np.eye(n, dtype=basis.dtype) - basis.T @ basis / 2)
    a = matrix.astype(np.longdouble)
    basis = basis / np.sqrt((basis ** 2).sum(axis=0))
    values = (basis * (a @ basis)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order].astype(np.float64), basis[:, order].astype(np.float64)


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """Sum of (n x - S)^2 of each vector: exact integers, None where a long can't hold them."""
    bound = (float(np.abs(x).max(initial=0)) * n + float(np.abs(total).max(initial=0))) or 1.0
    if bound < 2.0 ** 62:
        away = n * x - total
        if float(np.abs(away).max(initial=0)) ** 2 * len(total) < 2.0 ** 62:
            return (away * away).sum(axis=1).astype(object)
    rows = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, total, strict=True)) for row in x]
    return np.array([r if r < 2 ** 63 else None for r in rows], object)


def whitened(embeddings: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id",
             vector_column: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable vector and component."""
    kind = embeddings.schema[id_column].dataType.simpleString()
    schema = (f"{id_column} {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    table = embeddings.select(id_column, vector_column)
    n, total, spread = covariance(table)
    if not n:
        return table.sparkSession.createDataFrame([], schema)
    size = len(total)
    values, basis = eigenpairs(spread)
    count = min(components, size)
    trace = float(np.trace(spread))
    live = values[:count] > size * np.finfo(np.float64).eps * max(trace, 0)
    explained = np.where(live, values[:count] / (trace or 1.0), 0.0)
    onto = basis[:, :count] / np.sqrt(np.where(live, values[:count], 1.0))
    # x - S/n as an exact whole part and the fraction that is left
    middle = np.floor_divide(2 * total + n, 2 * n)
    rest = np.array([(int(s) - n * int(m)) / n for s, m in zip(total, middle)])

    def project(x: np.ndarray) -> np.ndarray:
        return ((x - middle) - rest) @ onto

    first = scatter(table, size, lambda x: np.column_stack([project(x)[:, live], np.ones(len(x))])) if live.any() else None
    if first is None:
        error = 0.0
    else:
        mean = first[-1, :-1] / n
        error = float(np.abs(first[:-1, :-1] / n - np.outer(mean, mean) - np.eye(int(live.sum()))).max())

    def rows(batches):
        for ids, x in vectors(batches, size):
            k = len(x)
            z = project(x)
            each = np.repeat(np.arange(k), count)
            dead = np.tile(~live, k)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, count + 1), k), pa.int32()),
                 pa.array(np.full(k * count, n)), pa.array(deviations(x, n, total).tolist(), pa.int64()).take(pa.array(each)),
                 pa.array(z.ravel(), mask=dead), pa.array(np.tile(explained, k)), pa.array(np.full(k * count, error))],
                names=[id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return table.mapInArrow(rows, schema)
