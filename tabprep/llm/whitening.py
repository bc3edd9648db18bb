"""Whitening of embeddings from exact integer moments, counted on bit planes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.session import shared_path

#: Rows whose planes are packed together.
CHUNK_ROWS = 1 << 16
#: Exact sums travel as parts of so many bits, so that a long holds the sum of 2^23 of them.
LIMB = 40
#: Numbers beyond this are set to it before they are shifted.
LARGEST = 1 << 62


class Moments(NamedTuple):
    """Rows, sums and cross-products of integer vectors, as Python numbers of any size."""

    n: int
    sums: list[int]
    products: list[list[int]]

    def covariance(self):
        """Centred as integers, n * C - S S', and only then divided."""
        import numpy as np

        dims = range(len(self.sums))
        return np.array(
            [[(self.n * self.products[i][j] - self.sums[i] * self.sums[j]) / self.n**2 for j in dims] for i in dims]
        ).reshape(len(dims), len(dims))


def chunk_moments(x) -> Moments:
    """Exact moments of the rows of an int64 matrix.

    Each dimension is shifted to begin at zero and cut into bit planes; a plane is packed along
    the rows into 64-bit words. A cross-product is the sum of the popcounts of ANDed planes,
    weighted by powers of two, and the shift is taken back on the sums.
    """
    import numpy as np

    n, dims = x.shape
    least = x.min(axis=0)
    y = x.astype(np.uint64) - least.astype(np.uint64)  # modulo 2^64, the true difference
    deep = int(y.max()).bit_length()
    words = -(-n // 64) * 8
    planes = np.zeros((deep, dims, words), dtype=np.uint8)
    for a in range(deep):
        bits = ((y >> np.uint64(a)) & np.uint64(1)).astype(np.uint8)
        planes[a, :, : -(-n // 8)] = np.packbits(bits.T, axis=1)
    flat = planes.reshape(deep * dims, words).view(np.uint64)
    exact = np.int64 if 2 * deep + n.bit_length() < 62 else object
    sums = np.zeros(dims, dtype=exact)
    products = np.zeros((dims, dims), dtype=exact)
    for a in range(deep):
        counts = np.bitwise_count(flat[a * dims : (a + 1) * dims]).sum(axis=1, dtype=np.int64)
        sums = sums + counts.astype(exact) * (1 << a)
        for i in range(dims):
            both = np.bitwise_count(flat[a * dims + i] & flat[a * dims :]).sum(axis=1, dtype=np.int64)
            for b, part in enumerate(both.reshape(deep - a, dims), start=a):
                part = part.astype(exact) * (1 << (a + b))
                products[i] = products[i] + part
                if b > a:
                    products[:, i] = products[:, i] + part
    shift, partial, square = least.tolist(), sums.tolist(), products.tolist()
    back = [
        [square[i][j] + shift[i] * partial[j] + shift[j] * partial[i] + n * shift[i] * shift[j] for j in range(dims)]
        for i in range(dims)
    ]
    return Moments(n, [s + n * m for s, m in zip(partial, shift)], back)


def _limbs(value: int) -> list[int]:
    """Signed parts of ``LIMB`` bits, least first."""
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value:
        out.append(sign * (value & ((1 << LIMB) - 1)))
        value >>= LIMB
    return out


def exact_moments(vectors: DataFrame, name: str, dims: int) -> Moments:
    """The moments of all rows of an ``array<long>`` column; tasks send sums, never rows."""

    def add_up(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def sent(parts) -> pa.RecordBatch:
            found = chunk_moments(np.concatenate(parts))
            cells = [(-1, -1, found.n)] + [(i, -1, s) for i, s in enumerate(found.sums)]
            cells += [(i, j, found.products[i][j]) for i in range(dims) for j in range(i, dims)]
            rows = [(i, j, k, v) for i, j, value in cells for k, v in enumerate(_limbs(value))]
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["i", "j", "limb", "v"])

        parts, rows = [], 0
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dims)
            for at in range(0, len(x), CHUNK_ROWS):
                piece = x[at : at + CHUNK_ROWS]
                if rows + len(piece) > CHUNK_ROWS:
                    yield sent(parts)
                    parts, rows = [], 0
                parts.append(piece)
                rows += len(piece)
        if rows:
            yield sent(parts)

    sent = vectors.select(name).mapInArrow(add_up, "i int, j int, limb int, v long")
    n, sums, products = 0, [0] * dims, [[0] * dims for _ in range(dims)]
    for r in sent.groupBy("i", "j", "limb").agg(F.sum("v").alias("v")).collect():  # as many as dims ask for
        part = r["v"] << LIMB * r["limb"]
        if r["i"] < 0:
            n += part
        elif r["j"] < 0:
            sums[r["i"]] += part
        else:
            products[r["i"]][r["j"]] += part
    for i in range(dims):
        for j in range(i):
            products[i][j] = products[j][i]
    return Moments(n, sums, products)


class Whitener(NamedTuple):
    """Falling eigenvalues with their unit eigenvectors as columns, from exact moments."""

    n: int
    sums: list[int]
    values: list[float]
    axes: list[list[float]]
    explained: list[float]

    @classmethod
    def fit(cls, moments: Moments, components: int) -> Whitener:
        """Components whose eigenvalue is zero to double precision are left out."""
        import numpy as np

        v = moments.covariance()
        values, axes = np.linalg.eigh(v)
        values, axes = values[::-1], axes[:, ::-1]
        trace = float(np.trace(v))
        least = trace * len(v) * np.finfo(float).eps
        rank = min(components, int(np.count_nonzero(values > least))) if trace > 0 else 0
        kept = values[:rank]
        return cls(moments.n, moments.sums, kept.tolist(), axes[:, :rank].tolist(), [float(e) / trace for e in kept])

    def centred(self, x):
        """n * x - S, exact: int64 where it fits, else Python numbers."""
        import numpy as np

        if self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0) < 1 << 62:
            return self.n * x - np.array(self.sums, dtype=np.int64)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)

    def whitened(self, centred):
        import numpy as np

        scale = np.array(self.axes).reshape(centred.shape[1], -1) / np.sqrt(self.values)
        return (centred / self.n).astype(np.float64) @ scale

    def deviations(self, centred) -> list[int | None]:
        """Exact sums of squares; null beyond a long."""
        import numpy as np

        largest = int(np.abs(centred).max(initial=0))
        if centred.shape[1] * largest * largest < 1 << 63:
            return (centred.astype(np.int64) ** 2).sum(axis=1).tolist()
        sums = (centred.astype(object) ** 2).sum(axis=1).tolist()
        return [s if s < 1 << 63 else None for s in sums]


def integers(vector: Column, scale: int, offset: int) -> Column:
    """floor(scale * c) + offset of each entry, held within plus and minus 2^62 before the offset."""
    held = lambda c: F.greatest(F.least(F.lit(float(scale)) * c, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(held(c)) + F.lit(offset).cast("long"))


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    components: int = 16,
    scale: int = 64,
    offset: int = 1_000_000,
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of each vector and component.

    Entries become integers, floor(scale * c) + offset. The distinct integer vectors, n of them
    with sums S, are the fit list; it is written to the shared folder, and its cross-products
    are counted exactly on bit planes (``chunk_moments``). Only these, some dims^2 numbers, reach
    the driver. Covariances are centred as integers and have divisor n. ``deviation`` is the sum
    over dimensions of (n * x - S)^2; ``whitened`` is x - S / n on the unit eigenvector, by the
    root of the eigenvalue; ``explained`` its share of the trace; ``identity_error`` the largest
    entry of the whitened fit list's covariance minus the identity, measured on the list.

    Vectors that are null, empty, of another size than most, or hold null or non-finite entries
    are dropped; zero vectors stay. Repeated rows all come back and count once in the fit. A
    component without variance is left out, so a table of one distinct vector, or none, gives no
    rows. Entries beyond 2^62 after scaling count as 2^62; a deviation beyond a long is null.
    Null ids are kept. Columns other than id and vector are not looked at.
    """
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    given = vectors.where(v.isNotNull() & finite & (F.size(v) > 0)).select(
        F.col(id_col).cast("long").alias("id"), integers(v, scale, offset).alias("x")
    )
    sizes = given.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    dims = sizes["dims"] if sizes else 1
    given = given.where(F.size("x") == dims)
    spark = vectors.sparkSession
    path = shared_path(spark, "whitening")
    given.select("x").distinct().write.parquet(path)
    distinct = spark.read.schema("x array<long>").parquet(path)
    fitted = Whitener.fit(exact_moments(distinct, "x", dims), components) if sizes else Whitener(0, [0], [], [[]], [])
    k = len(fitted.values)

    def matrix(batch, at: int):
        return batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dims)

    def squares(batches: Iterator) -> Iterator:
        """Sums of products of the whitened rows, one per pair of components, and of the rows themselves."""
        import numpy as np
        import pyarrow as pa

        total = np.zeros((k + 1, k + 1))
        for b in batches:
            for at in range(0, b.num_rows, CHUNK_ROWS):
                w = fitted.whitened(fitted.centred(matrix(b, 0)[at : at + CHUNK_ROWS]))
                w = np.hstack([w, np.ones((len(w), 1))])
                total += w.T @ w
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(a.ravel()) for a in (i, j, total)], ["i", "j", "v"])

    error = None
    if k:
        import numpy as np

        cells = distinct.mapInArrow(squares, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
        found = np.zeros((k + 1, k + 1))
        for r in cells.collect():
            found[r["i"], r["j"]] = r["v"]
        mean = found[k, :k] / fitted.n
        error = float(np.abs(found[:k, :k] / fitted.n - np.outer(mean, mean) - np.eye(k)).max())

    def score(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            if not k or not b.num_rows:
                continue
            centred = fitted.centred(matrix(b, 1))
            rows = b.num_rows * k
            spread = pa.array(np.repeat(np.arange(b.num_rows), k))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(spread),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b.num_rows)),
                    pa.array(np.full(rows, fitted.n, dtype=np.int64)),
                    pa.array(fitted.deviations(centred), pa.int64()).take(spread),
                    pa.array(fitted.whitened(centred).ravel()),
                    pa.array(np.tile(fitted.explained, b.num_rows)),
                    pa.array(np.full(rows, error)),
                ],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    shape = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return given.mapInArrow(score, shape).withColumnRenamed("id", id_col)
