"""Approximate nearest neighbours by collision counting over sorted single projections."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabprep.llm.common import free_names
from tabprep.session import reliable_checkpoint

#: Vectors that share one index at most; few vectors are still dealt into ``SHARDS`` of ``LEAST_ROWS``.
SHARD_ROWS, SHARDS, LEAST_ROWS = 65_536, 12, 16_384
#: Queries whose products with a shard are found at once.
BLOCK = 64
#: Products nearer than this, relative to the lengths, are formed anew, each in the same way.
_CLOSE = 1e-9


class CollisionIndex:
    """Sorted arrays of one random projection each, over vectors made equally long.

    A vector x becomes (x, sqrt(M^2 - |x|^2)) / M for the largest length M, and a query its
    direction, so the largest inner product is the smallest distance. A vector collides with a
    query on a projection if its place in that sorted array lies in the window around the query
    there. Virtual rehashing widens all windows of a query by a factor a round; a vector is
    verified, by its true inner product, once it has collided on ``share`` of the projections.
    The search ends when a vector as near as the k-th best found would have been verified with the
    probability that ``sure`` standard deviations stand for, or when all have been.

    Collisions are counted over the ranks that the sorted arrays give the vectors: two
    comparisons of 16-bit numbers per vector and projection. Products with a block of
    queries are formed at once; those of vectors that are not verified are never looked at.
    """

    def __init__(self, vectors, ids, rows, longest: float, projections: int, share: float, sure: float, width: float, growth: float, seed: int):
        import numpy as np

        self.vectors, self.ids, self.rows, self.longest = vectors, ids, rows, longest
        rng = np.random.default_rng(seed)
        self.axes = rng.standard_normal((vectors.shape[1] + 1, projections))
        rest = np.sqrt(np.maximum(0, 1 - (vectors**2).sum(1) / longest**2))
        placed = ((vectors / longest) @ self.axes[:-1] + rest[:, None] * self.axes[-1]).T
        order = np.argsort(placed, axis=1, kind="stable")
        self.values = np.take_along_axis(placed, order, axis=1)
        kind = np.uint16 if len(vectors) < 1 << 16 else np.uint64
        self.ranks = np.empty(order.shape, dtype=kind)
        np.put_along_axis(self.ranks, order, np.arange(len(vectors), dtype=kind)[None, :], axis=1)
        self.needed, self.share, self.sure = int(np.ceil(share * projections)), share, sure
        self.width, self.growth = width, growth

    def search(self, queries, query_rows, k: int) -> Iterator[tuple]:
        """(positions, scores) of up to k vectors for each query, best first, ties to smaller ids."""
        import numpy as np

        for at in range(0, len(queries), BLOCK):
            block = queries[at : at + BLOCK]
            products = block @ self.vectors.T
            placed = (block / np.linalg.norm(block, axis=1)[:, None]) @ self.axes[:-1]
            windows: dict = {}
            for n, query in enumerate(block):
                yield self._one(query, query_rows[at + n], k, n, placed, products[n], windows)

    def _windows(self, width: float, placed, known: dict):
        """Ends of the windows of all queries of a block, one row of projections each, found together."""
        import numpy as np

        if width not in known:
            known[width] = tuple(
                np.stack([np.searchsorted(v, p + s * width, side) for v, p in zip(self.values, placed.T)], axis=1)
                for s, side in ((-1, "left"), (1, "right"))
            )
        return known[width]

    def _collisions(self, low, high):
        """How many windows each vector lies in."""
        import numpy as np

        kind = self.ranks.dtype.type
        counts = np.zeros(len(self.rows), dtype=np.uint8 if len(self.values) < 256 else np.uint16)
        above, inside = np.empty(len(self.rows), dtype=kind), np.empty(len(self.rows), dtype=bool)
        for rank, first, size in zip(self.ranks, low.astype(kind), (high - low).astype(kind)):
            np.subtract(rank, first, out=above)  # modulo the type's size, so ranks below the window are far above it
            np.less(above, size, out=inside)
            np.add(counts, inside.view(np.uint8), out=counts)
        return counts

    def _one(self, query, row, k, n, placed, products, windows):
        from math import erf, sqrt

        import numpy as np

        own, m = self.rows == row, len(self.values)
        length, width = float(np.linalg.norm(query)), self.width
        while True:
            low, high = (ends[n] for ends in self._windows(width, placed, windows))
            whole = bool((low == 0).all() and (high == len(self.rows)).all())
            hit = (self._collisions(low, high) >= self.needed) & ~own if not whole else ~own
            places = np.flatnonzero(hit)
            if len(places) >= k or whole:
                found = products[places]
                if len(found) > k:  # also all that are equal to the k-th but for rounding
                    least = np.partition(found, len(found) - k)[len(found) - k] - _CLOSE * length * self.longest
                    places = places[found >= least]
                scores = (self.vectors[places] * query).sum(axis=1)
                best = np.lexsort((self.ids[places], -scores))[:k]
                places, scores = places[best], scores[best]
                if whole:
                    return places, scores
                gap = sqrt(max(0.0, 2 - 2 * scores[-1] / (length * self.longest)))
                p = erf(width / (gap * sqrt(2))) if gap else 1.0
                if p - self.sure * sqrt(p * (1 - p) / m) >= self.share:
                    return places, scores
            width *= self.growth


def usable(vector: Column, size: int) -> Column:
    """Whether a vector has the right size, only finite components, and one that is not zero."""
    v = vector.cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(v) == size) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector: str = "embedding",
    projections: int = 48,
    share: float = 0.2,
    sure: float = 1.3,
    width: float = 0.25,
    growth: float = 1.25,
    shard_rows: int = SHARD_ROWS,
    seed: int = 11,
) -> DataFrame:
    """(query_id, rank, id, score) of the k vectors with the largest inner product found.

    Vectors are dealt into shards by a hash of their row: of ``shard_rows`` at most on average, and
    ``LEAST_ROWS`` where there are not many, so that several tasks share the work. Every vector is
    in one shard; every query visits every shard, in blocks, and the shards' best k are merged.
    So a task holds one index and a batch of queries. ``projections``, ``share``, ``sure``,
    ``width`` and ``growth`` are those of ``CollisionIndex``; all rows are indexed, nothing is sampled.

    Vectors that are null, zero, of another size than most, or hold null or non-finite
    components take no part. A query's own row is left out, a repeated row is not. Ties go to
    the smaller id, null ids last. No vectors or no queries give no rows. Columns other than id
    and vector are not looked at, so their names cannot clash.
    """
    given = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")
    )
    common = given.where("v is not null").groupBy(F.size("v").alias("n")).count()
    top = common.orderBy(F.desc("count"), "n").first()
    dim = top["n"] if top else 0
    marked = reliable_checkpoint(
        given.where(usable(F.col("v"), dim)).withColumn("row", F.monotonically_increasing_id())
    )
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    total, longest = marked.agg(F.count("*"), F.max(length)).first()
    result = "query_id long, query_row long, id long, score double"
    shards = max(-(-(total or 0) // shard_rows), min(SHARDS, -(-(total or 0) // LEAST_ROWS)), 1)
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    data = marked.select(F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"), "id", "v", "row", F.lit(0).alias("side"))
    asks = marked.where("q").select(every.alias("shard"), "id", "v", "row", F.lit(1).alias("side"))
    both = data.unionByName(asks).repartitionById(shards, F.col("shard"))

    def search(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        key, parts, index = None, [], None
        for b in batches:
            names = b.schema.names
            column = {c: b.column(names.index(c)) for c in names}
            shard, side = (column[c].to_numpy(zero_copy_only=False) for c in ("shard", "side"))
            row = column["row"].to_numpy(zero_copy_only=False)
            ids = column["id"].fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
            known = column["id"].is_valid().to_numpy(zero_copy_only=False)
            v = column["v"].flatten().to_numpy(zero_copy_only=False).reshape(len(row), dim)
            edges = np.flatnonzero(np.diff(np.stack([shard, side]), axis=1).any(0)) + 1
            for a, z in zip([0, *edges], [*edges, len(row)]):
                if shard[a] != key:
                    key, parts, index = shard[a], [], None
                if not side[a]:
                    parts.append((v[a:z], ids[a:z], row[a:z], known[a:z]))
                    continue
                if index is None:
                    if not parts:
                        continue
                    x, i, r, ok = (np.concatenate(p) for p in zip(*parts))
                    index, parts = CollisionIndex(x, i, r, longest, projections, share, sure, width, growth, seed), []
                for at in range(a, z, 256):
                    to = min(z, at + 256)
                    out = []
                    for q, (places, scores) in zip(range(at, to), index.search(v[at:to], row[at:to], k)):
                        out += [(ids[q], row[q], i if g else None, s) for i, g, s in zip(index.ids[places].tolist(), ok[places], scores.tolist())]
                    if out:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
                            ["query_id", "query_row", "id", "score"],
                        )

    found = both.sortWithinPartitions("shard", "side", "row").mapInArrow(search, result)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    (name,) = free_names(found, [id_col])
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(name), "score")
    )
