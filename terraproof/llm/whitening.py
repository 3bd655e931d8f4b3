"""Whitening of embeddings: a two-pass covariance over whole numbers, LAPACK's symmetric eigenvectors, one projection.

An entry c, as double, becomes x = floor(SCALE * c) + OFFSET. Components are fitted on the different x vectors, each
once. The first pass sums them exactly; the second centres by that mean and sums outer products, one GEMM for each
batch; both passes merge their partial sums by treeAggregate. A third pass measures how far the covariance of the
whitened fit vectors is from the identity. What comes to the driver and is broadcast is bounded by ``most_dims``, whatever
the number of rows.

Vectors travel packed: the offset is taken away and the numbers are written in the least whole type that holds them,
so that equal vectors are equal bytes and a vector of 64 floats is mostly 65 bytes in the shuffle.

Defined results: rows whose vector is null, or holds a null, a NaN or an infinity, give no rows. Vectors of another length
than most of the fit vectors have (ties: the longer) give none either. Repeated rows give repeated results and count once
in the fit. Components whose variance is below FLAT of the largest are left out, as nothing can be divided by it; with one
different vector, or none, there is no component and no row. Entries beyond 2**61 / SCALE and vectors of more than
``most_dims`` entries raise an error. Null ids and input columns of any name are no obstacle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, LongType, StructField, StructType

from terraproof.llm.common import ensure_checkpoint_dir, forget_files, release_memory

SCALE, OFFSET = 64, 1_000_000
FLAT = 1e-10
TYPES = (np.dtype("<i1"), np.dtype("<i2"), np.dtype("<i4"), np.dtype("<i8"))
LOW_BITS = 31


def rounded(values: np.ndarray) -> np.ndarray:
    """x - OFFSET of finite entries."""
    scaled = np.floor(values * float(SCALE))
    if len(scaled) and np.abs(scaled).max(initial=0.0) > 2.0**61:
        raise OverflowError("an entry is too large for a whole number of 64 bits")
    return scaled.astype(np.int64)


def usable(lists: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, entries as a matrix of doubles) of the vectors without null or non-finite entries, by length."""
    sizes = np.where(lists.is_null().to_numpy(zero_copy_only=False), -1, lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False))
    out = []
    for d in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == d)
        values = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
        good = np.isfinite(values).all(1)
        out.append((at[good], values[good]))
    return out


def packed(xs: np.ndarray) -> list[bytes]:
    """Each row in the least of TYPES that holds it, after that type's number."""
    most = np.maximum(xs.max(1), ~xs.min(1))
    kinds = np.searchsorted([np.iinfo(t).max for t in TYPES], most)
    out: list[bytes] = [b""] * len(xs)
    for k, kind in enumerate(TYPES):
        at = np.flatnonzero(kinds == k)
        body, width = xs[at].astype(kind).tobytes(), kind.itemsize * xs.shape[1]
        for n, i in enumerate(at):
            out[i] = bytes((k,)) + body[n * width : (n + 1) * width]
    return out


def unpacked(rows: list[bytes]) -> Iterator[np.ndarray]:
    """Matrices of the packed rows, one for each type and length among them."""
    kinds: dict[tuple[int, int], list[bytes]] = {}
    for r in rows:
        kinds.setdefault((r[0], len(r)), []).append(r)
    for (k, n), mine in kinds.items():
        raw = np.frombuffer(b"".join(mine), np.uint8).reshape(-1, n)[:, 1:]
        yield np.ascontiguousarray(raw).view(TYPES[k]).astype(np.int64)


def whole_sums(xs: np.ndarray) -> list[int]:
    """Exact sums of the columns; the halves of the numbers cannot overflow in fewer than 2**31 rows."""
    high, low = xs >> LOW_BITS, xs & ((1 << LOW_BITS) - 1)
    return [(int(h) << LOW_BITS) + int(v) for h, v in zip(high.sum(0), low.sum(0), strict=True)]


class Centre:
    """The mean of the fit vectors as a whole part and a rest below one half, so that centring loses no digit."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.whole = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
        self.rest = np.array([(s - n * int(w)) / n for s, w in zip(sums, self.whole, strict=True)])

    def __call__(self, xs: np.ndarray) -> np.ndarray:
        return (xs - self.whole).astype(np.float64) - self.rest

    def deviations(self, xs: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n * x - S)**2, exact; the offset cancels."""
        n, sums = self.n, self.sums
        most = float(n) * np.abs(xs).max(initial=0) + max(map(abs, sums))
        if most**2 * len(sums) < 2.0**62:
            apart = xs * n - np.array(sums, np.int64)
            return pa.array((apart * apart).sum(1)).cast(pa.decimal128(38, 0))
        return pa.array([sum((n * int(x) - s) ** 2 for x, s in zip(row, sums, strict=True)) for row in xs], pa.decimal128(38, 0))


def _gathered(fit: DataFrame, part: Callable[[Iterator[np.ndarray]], object], merge: Callable[[object, object], object]) -> object:
    """``part`` of the matrices of each task, merged in a tree of tasks; None without rows."""

    def run(rows: Iterator) -> Iterator:
        def matrices() -> Iterator[np.ndarray]:
            held: list[bytes] = []
            for r in rows:
                held.append(bytes(r[0]))
                if len(held) == 4096:
                    yield from unpacked(held)
                    held.clear()
            yield from unpacked(held)

        yield part(matrices())

    both = lambda a, b: b if a is None else a if b is None else merge(a, b)
    return fit.rdd.mapPartitions(run).treeAggregate(None, both, both)


def first_pass(fit: DataFrame, most_dims: int) -> Centre | None:
    """Counts and exact sums by length; the length of most vectors is that of the fit."""

    def part(matrices: Iterator[np.ndarray]) -> dict[int, tuple[int, list[int]]]:
        found: dict = {}
        for xs in matrices:
            if xs.shape[1] > most_dims:
                raise ValueError(f"a vector has {xs.shape[1]} entries; the bound is {most_dims}")
            found = merge(found, {xs.shape[1]: (len(xs), whole_sums(xs))})
        return found

    def merge(a: dict, b: dict) -> dict:
        both = dict(a)
        for d, (n, s) in b.items():
            m, t = both.get(d, (0, [0] * d))
            both[d] = (n + m, [x + y for x, y in zip(s, t, strict=True)])
        return both

    found = _gathered(fit, part, merge)
    if not found:
        return None
    d = max(found, key=lambda k: (found[k][0], k))
    return Centre(*found[d])


def outer_sums(fit: DataFrame, dims: int, prepare: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(sum of the prepared rows' outer products, sum of the prepared rows)."""

    def part(matrices: Iterator[np.ndarray]) -> tuple | None:
        found = None
        for xs in matrices:
            if xs.shape[1] == dims:
                c = prepare(xs)
                mine = (c.T @ c, c.sum(0))
                found = mine if found is None else merge(found, mine)
        return found

    merge = lambda a, b: (a[0] + b[0], a[1] + b[1])
    return _gathered(fit, part, merge)


def components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(unit eigenvectors as columns, eigenvalues), largest first; each vector's largest entry is positive."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = np.flatnonzero(values > max(0.0, FLAT * values[0]))[:most]
    vectors = vectors[:, kept]
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(kept))])
    return vectors * signs, values[kept]


def whiten(df: DataFrame, id_col: str, vector_col: str, most: int = 16, most_dims: int = 4096) -> DataFrame:
    """One row for each row of ``df`` with a usable vector and each component up to ``most``.

    Columns: the id, component, n, deviation (a decimal, as a long holds it only for some 10**8 vectors), whitened,
    explained, identity_error.
    """
    spark = df.sparkSession
    id_field = df.schema[id_col]
    names = (("component", IntegerType()), ("n", LongType()), ("deviation", DecimalType(38, 0)), ("whitened", DoubleType()), ("explained", DoubleType()), ("identity_error", DoubleType()))
    schema = StructType([StructField("_id", id_field.dataType), *(StructField(x, t) for x, t in names)])
    # the names below are the operator's own, whatever ``df`` calls its columns
    slim = df.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_vector"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, values in usable(batch.column("_vector")):
                if len(values):
                    yield pa.RecordBatch.from_arrays([pa.array(packed(rounded(values)), pa.binary())], names=["x"])

    home = f"{ensure_checkpoint_dir(spark)}/whitening-{uuid.uuid4().hex}"
    try:
        slim.select("_vector").mapInArrow(pack, "x binary").distinct().write.parquet(home)
        fit = spark.read.schema("x binary").parquet(home)
        centre = first_pass(fit, most_dims)
        values = np.zeros(0)
        if centre is not None:
            n, dims = centre.n, len(centre.sums)
            covariance = outer_sums(fit, dims, centre)[0] / n
            vectors, values = components(covariance, most)
        if not len(values):
            return spark.createDataFrame([], schema).withColumnRenamed("_id", id_col)
        project = vectors / np.sqrt(values)
        explained = values / np.trace(covariance)
        squares, total = outer_sums(fit, dims, lambda xs: centre(xs) @ project)
        mean = total / n  # some 1e-13, so that taking its square away loses nothing
        error = float(np.abs(squares / n - np.outer(mean, mean) - np.eye(len(values))).max())
    finally:
        forget_files(spark, home)
    model = spark.sparkContext.broadcast((centre, project, explained, error))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, project, explained, error = model.value
        k = len(explained)
        for batch in batches:
            for start in range(0, len(batch), 4096):
                part = batch.slice(start, 4096)
                for at, values in usable(part.column("_vector")):
                    if values.shape[1] != len(project) or not len(at):
                        continue
                    xs = rounded(values)
                    of_row = np.repeat(np.arange(len(at)), k)
                    columns = [
                        part.column("_id").take(pa.array(at[of_row])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))), pa.array(np.full(len(of_row), centre.n)),
                        centre.deviations(xs).take(pa.array(of_row)), pa.array((centre(xs) @ project).ravel()), pa.array(np.tile(explained, len(at))), pa.array(np.full(len(of_row), error)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["_id", *(x for x, _ in names)])
        release_memory()

    return slim.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
