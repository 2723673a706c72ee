"""Embedding whitening: exact distributed covariance, eigenvectors refined from float32 to double precision.

The covariance is summed in whole numbers, so it depends neither on how rows are dealt to
tasks nor on tasks that run again. Its eigenvectors are found in float32 and corrected by
Ogita and Aishima's iteration, which needs matrix products in the higher precision alone and
doubles the right digits in each step. Eigenvalues too close together for it form clusters;
the eigenvectors of a cluster are told apart by a small eigenproblem in their own subspace.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelens.llm.common import stored

SCALE, SHIFT = 1024, 100_000
#: Entries beyond this, in units of 1 / SCALE, are refused: sums of their products would leave whole numbers of 64 bits.
LARGEST = 1 << 40
#: Steps of the refinement; from seven digits on, three reach sixteen where eigenvalues are apart.
STEPS = 12

SUMS = "i int, total decimal(38,0)"
PRODUCTS = "i int, j int, total decimal(38,0)"
WHITE = "vec_id long, deviation decimal(38,0), w array<double>"


def usable(vector):
    """Rows whose vector has entries, none of them null, infinite or NaN."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


def matrix_of(column):
    """x of an Arrow list column of equally long vectors: whole numbers, one row a vector."""
    import numpy as np
    import pyarrow as pa

    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    scaled = np.floor(SCALE * values)
    if len(scaled) and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"an entry is beyond {LARGEST // SCALE}")
    return scaled.astype(np.int64).reshape(len(column), -1) + SHIFT


def summed(totals, width: int):
    """A batch of exact sums (i, total) or (i, j, total) from a list of Python numbers."""
    from decimal import Decimal

    import numpy as np
    import pyarrow as pa

    total = pa.array([Decimal(int(v)) for v in totals], pa.decimal128(38, 0))
    if len(totals) == width:
        return pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), total], names=["i", "total"])
    i, j = np.triu_indices(width)
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), total], names=["i", "j", "total"])


def adder():
    """Vectors to the sum of x in each dimension, one set of rows a task."""
    import numpy as np

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                own = matrix_of(batch.column("vector")).sum(axis=0).astype(object)
                total = own if total is None else total + own
        if total is not None:
            yield summed(np.asarray(total), len(total))

    return run


def products(centre):
    """Vectors to the sums of products of x less whole numbers near its mean, one set of rows a task.

    Blocks are small enough for every sum in a float64 matrix product to be a whole
    number below 2^53, hence exact.
    """
    import numpy as np

    def gram(y):
        top = max(1, int(np.abs(y).max(initial=0)))
        rows = (1 << 53) // (top * top)
        if not rows:
            return y.T.astype(object) @ y.astype(object)
        total = 0
        for at in range(0, len(y), min(rows, 1 << 16)):
            block = y[at : at + min(rows, 1 << 16)].astype(np.float64)
            total = total + (block.T @ block).astype(np.int64).astype(object)
        return total

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                own = gram(matrix_of(batch.column("vector")) - np.array(centre, np.int64))
                total = own if total is None else total + own
        if total is not None:
            yield summed(total[np.triu_indices(len(centre))], len(centre))

    return run


def covariance(n: int, sums: list[int], centre: list[int], upper: dict[tuple[int, int], int]):
    """Covariance matrix (divisor n) in double precision from exact sums around `centre`."""
    import numpy as np

    d = len(sums)
    off = [s - n * c for s, c in zip(sums, centre)]
    found = np.empty((d, d))
    for (i, j), total in upper.items():
        # Whole numbers up to the last division, which rounds once.
        found[i, j] = found[j, i] = (n * total - off[i] * off[j]) / (n * n)
    return found


def refined_eigenvectors(matrix):
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, to double precision.

    A step with the approximations X measures R = I - X'X and S = X'AX, takes each
    eigenvalue as S_ii / (1 - R_ii) and adds X E, where E_ij is (S_ij + e_j R_ij) /
    (e_j - e_i), or R_ij / 2 where two eigenvalues are too close to tell apart by the
    residuals. Such clusters span the right subspace; inside it the matrix, less the
    cluster's mean eigenvalue, is small, and its own eigenvectors, found in double
    precision, turn the columns. Products are taken in extended precision.
    """
    import numpy as np

    wide = np.longdouble
    a = matrix.astype(wide)
    size = max(float(np.abs(matrix).max(initial=0)), np.finfo(float).tiny)
    rough, x = np.linalg.eigh((matrix / size).astype(np.float32))
    # Scaled to a spectral norm of about 1.
    size *= max(float(np.abs(rough).max()), 0.5)
    x, a = x[:, ::-1].astype(wide), a / wide(size)
    d, one = len(a), np.eye(len(a), dtype=wide)
    before = np.inf
    for _ in range(STEPS):
        r, s = one - x.T @ x, x.T @ a @ x
        # Symmetric to the last digit, so that a step between two close eigenvalues stays a turn.
        r, s = (r + r.T) / 2, (s + s.T) / 2
        e = np.diag(s) / (1 - np.diag(r))
        apart = e[None, :] - e[:, None]
        residual = s - np.diag(e)
        # Gaps below this are within what the residuals leave open.
        least = 2 * (np.sqrt((residual**2).sum()) + np.sqrt((r**2).sum()))
        close = np.abs(apart) <= least
        step = np.where(close, r / 2, (s + e[None, :] * r) / np.where(close, 1, apart))
        x = x + x @ step
        for group in clusters(e, float(least)):
            inner = x[:, group]
            middle = e[group].mean()
            small = inner.T @ (a @ inner - middle * inner)
            _, turn = np.linalg.eigh(((small + small.T) / 2).astype(np.float64))
            x[:, group] = inner @ turn[:, ::-1].astype(wide)
        moved = float(np.abs(step).max(initial=0))
        if moved < 1e-17 or (moved >= before and moved < 1e-15):
            break
        before = moved
    x = x / np.sqrt((x * x).sum(axis=0))
    e = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-e, kind="stable")
    return (e[order] * size).astype(np.float64), x[:, order].astype(np.float64)


def clusters(e, least: float) -> list[list[int]]:
    """Places of neighbouring eigenvalues no further apart than `least`, in groups of two or more."""
    order = sorted(range(len(e)), key=lambda k: -e[k])
    groups, group = [], order[:1]
    for one, other in zip(order, order[1:]):
        if e[one] - e[other] <= least:
            group.append(other)
        else:
            groups.append(group)
            group = [other]
    return [g for g in [*groups, group] if len(g) > 1]


def projector(n: int, sums: list[int], vectors, values):
    """Vectors to their deviation, exact, and their whitened components."""
    from decimal import Decimal

    import numpy as np
    import pyarrow as pa

    mean = np.array([s / n for s in sums])
    fractions = [(s // n, s % n) for s in sums]
    whole, rest = (np.array(f, np.int64) for f in zip(*fractions))
    part = rest / n
    # Numbers of 64 bits hold n * x - S and the sum of its squares below this.
    roomy = float(1 << 62)
    total = np.array(sums, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix_of(batch.column("vector"))
            far = float(np.abs(x - mean).max()) * n + n
            if len(mean) * far * far < roomy:
                deviation = ((n * (x - whole) - rest) ** 2).sum(axis=1)
                deviation = pa.array(deviation, pa.int64()).cast(pa.decimal128(38, 0))
            else:
                deviation = ((n * x.astype(object) - total) ** 2).sum(axis=1)
                deviation = pa.array([Decimal(int(v)) for v in deviation], pa.decimal128(38, 0))
            centred = (x - whole).astype(np.float64) - part
            with np.errstate(divide="ignore", invalid="ignore"):
                white = (centred @ vectors) / np.sqrt(values)
            offsets = pa.array(np.arange(len(x) + 1) * len(values), pa.int32())
            flat = white.ravel()
            flat = pa.array(flat, pa.float64(), mask=~np.isfinite(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), deviation, pa.ListArray.from_arrays(offsets, flat)],
                names=["vec_id", "deviation", "w"],
            )

    return run


def identity_error(white: DataFrame, components: int) -> float:
    """Largest absolute entry of the whitened covariance less the identity; Spark's covariance centres as it goes."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    w = [F.get("w", F.lit(i)) for i in range(components)]
    found = white.agg(*[F.covar_pop(w[i], w[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(table: DataFrame, key: str, vector: str, components: int = 8) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error per vector and leading component.

    Vectors that are null, empty or hold null or non-finite entries are left out. Rows that repeat count each time; a null key stays null.
    No rows give no rows. Vectors of different lengths are an error. Where the vectors
    vary in fewer directions than components are asked for, only those directions are
    returned, so one vector, or copies of one, give no rows. What reaches the driver is
    the covariance: its size depends on the dimensions alone.
    """
    rows = table.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(usable(F.col("vector")))
    none = table.sparkSession.createDataFrame(
        [], "vec_id long, component int, n long, deviation decimal(38,0), whitened double,"
        " explained double, identity_error double")
    n, shortest, longest = rows.agg(F.count("*"), F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if shortest != longest:
        raise ValueError(f"vectors of {shortest} and of {longest} entries")
    if not n:
        return none
    sums = rows.mapInArrow(adder(), SUMS).groupBy("i").agg(F.sum("total").alias("total"))
    sums = [int(r.total) for r in sums.orderBy("i").collect()]
    centre = [round(s / n) for s in sums]
    upper = rows.mapInArrow(products(centre), PRODUCTS).groupBy("i", "j").agg(F.sum("total").alias("total"))
    cov = covariance(n, sums, centre, {(r.i, r.j): int(r.total) for r in upper.collect()})
    values, vectors = refined_eigenvectors(cov)
    trace = float(cov.trace())
    # Directions without variance have eigenvalues of rounding errors alone.
    leading = [k for k in range(min(components, len(values))) if values[k] > 1e-13 * trace * len(values)]
    if trace <= 0 or not leading:
        return none
    k = len(leading)
    white = stored(rows.mapInArrow(projector(n, sums, vectors[:, :k], values[:k]), WHITE), "whitened")
    error = identity_error(white, k)
    explained = F.array(*[F.lit(float(v) / trace) for v in values[:k]])
    return white.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    """The first eight whitened components of all embeddings; a deviation beyond 64 bits is null."""
    found = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
    return found.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))
