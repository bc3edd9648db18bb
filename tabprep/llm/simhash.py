"""SimHash fingerprints and their groups, linked through a forest of vantage-point trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import free_names
from tabprep.llm.components import connected_components

SHINGLE = 4
SEED = 42
RADIUS = 4
#: Runs up to this size are searched by shifting; larger ones by vantage-point trees.
SHIFTED = 16
LEAF = 512


def fingerprints(texts: list[bytes | None], shingle: int = SHINGLE):
    """Signed 64-bit SimHash of each UTF-8 text; null and wordless texts give zero."""
    import numpy as np
    import xxhash

    h = xxhash.xxh64_intdigest
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    out = np.zeros(len(texts), dtype=np.uint64)
    for row, text in enumerate(texts):
        words = (text or b"").translate(low).split()
        if not words:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        n = max(1, len(words) - shingle + 1)
        starts = [0, *(ends[: n - 1] + 1).tolist()]
        stops = ends[-n:].tolist()
        hashes = np.array([h(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)], dtype="<u8")
        total = np.zeros(64, dtype=np.int64)
        for k in range(0, n, 255 * 256):
            bits = np.unpackbits(hashes[k : k + 255 * 256].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            whole = len(bits) // 255 * 255
            if whole:  # sums of 255 bits fit a byte
                total += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
            total += bits[whole:].sum(axis=0, dtype=np.int64)
        set_bits = np.packbits((2 * total > n).astype(np.uint8), bitorder="little")
        out[row] = set_bits.view("<u8")[0]
    return out.view(np.int64)


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint of each whole text as a signed long."""
    from pyspark.sql.types import LongType, StructField, StructType

    at = docs.columns.index(text)

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            found = fingerprints(b.column(at).cast(pa.binary()).to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found)], [*b.schema.names, name])

    return docs.mapInArrow(add, StructType([*docs.schema.fields, StructField(name, LongType())]))


def block_masks(radius: int = RADIUS, blocks: int = 6) -> list[int]:
    """Masks of ``blocks - radius`` out of ``blocks`` parts of the 64 bits.

    Two fingerprints at most ``radius`` bits apart agree on all bits of at least one mask.
    """
    edges = [64 * k // blocks for k in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(parts, blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _grow(points, radius: int) -> list[tuple[int, int]]:
    """Links that join each component within ``points``; whatever is reached is not compared again."""
    import numpy as np

    links, rest, front = [], points, []
    while len(rest):
        if not front:
            front, rest = [rest[0]], rest[1:]
        x = front.pop()
        near = np.bitwise_count(rest ^ x) <= radius
        if near.any():
            reached = rest[near]
            links += [(int(x), int(y)) for y in reached]
            front += list(reached)
            rest = rest[~near]
    return links


def vantage_links(points, radius: int = RADIUS, leaf: int = LEAF) -> list[tuple[int, int]]:
    """Links that give distinct unsigned ``points`` the components of all pairs within ``radius``.

    A shard is parted by the distance to a vantage point. By the triangle inequality the two
    ends of a link differ by at most ``radius`` in it, so the inner shard d <= t and the outer
    shard d > t - radius together hold both ends of every link; the overlap is their boundary.
    A shard that no distance parts well is searched whole, leaving out what is already linked.
    """
    import numpy as np

    links, shards = [], [points]
    while shards:
        now = shards.pop()
        if len(now) <= leaf:
            links += _grow(now, radius)
            continue
        d = np.bitwise_count(now ^ now[0]).astype(np.int64)
        inner = np.cumsum(np.bincount(d, minlength=65))  # inner[t]: how many have d <= t
        outer = len(now) - np.concatenate([np.zeros(radius, np.int64), inner])[:65]  # d > t - radius
        worst = np.maximum(inner, outer)
        t = int(np.argmin(worst * 65 + np.arange(65)))
        if inner[t] + outer[t] > 1.5 * len(now) or worst[t] > 0.9 * len(now):
            links += _grow(now, radius)
        else:
            shards += [now[d <= t], now[d > t - radius]]
    return links


def near_links(prints: DataFrame, radius: int = RADIUS, blocks: int = 6, name: str = "fingerprint") -> DataFrame:
    """Links (u, v) between distinct fingerprints that connect all pairs within ``radius`` bits.

    Each mask is a tree with a metric of its own: the bits that differ inside the mask. A near
    pair has distance zero in some tree, so there triangle bounds leave no overlap between the
    shards, which are the values of the masked bits. Within a shard the links follow from full
    distances by ``vantage_links``. Shards are rows that lie next to each other after one sort,
    so a task holds one of them at a time. Per shard at most as many links as points come out.
    """
    masks = [_signed(m) for m in block_masks(radius, blocks)]
    x = F.col(name)
    shards = prints.select(
        x.alias("x"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(k).alias("tree"), x.bitwiseAND(F.lit(m).cast("long")).alias("shard"))
                    for k, m in enumerate(masks)
                ]
            )
        ),
    )

    def link(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def searched(x, first) -> Iterator:
            """Runs begin where ``first`` is true."""
            begin = np.flatnonzero(first)
            size = np.diff(np.append(begin, len(x)))
            run = np.repeat(np.arange(len(begin)), size)
            small = size[run] <= SHIFTED
            us, vs = [], []
            for k in range(1, min(SHIFTED, len(x))):
                near = np.flatnonzero(
                    (run[k:] == run[:-k]) & small[k:] & (np.bitwise_count(x[k:] ^ x[:-k]) <= radius)
                )
                us.append(x[near])
                vs.append(x[near + k])
            for r in np.flatnonzero(size > SHIFTED):
                pairs = vantage_links(x[begin[r] : begin[r] + size[r]], radius)
                us.append(np.array([a for a, _ in pairs], np.uint64))
                vs.append(np.array([b for _, b in pairs], np.uint64))
            if us:
                u, v = np.concatenate(us), np.concatenate(vs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u.astype(np.uint64).view(np.int64)), pa.array(v.astype(np.uint64).view(np.int64))],
                    ["u", "v"],
                )

        left = None  # the run that the next batch may go on with, in parts
        for b in batches:
            t, s, x = (b.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 0))
            x = x.view(np.uint64)
            if not len(x):
                continue
            if left and (t[0], s[0]) != left[0]:
                whole = np.concatenate(left[1])
                yield from searched(whole, np.arange(len(whole)) == 0)
                left = None
            first = np.append(True, (t[1:] != t[:-1]) | (s[1:] != s[:-1]))
            last = int(np.flatnonzero(first)[-1])
            if left and last == 0:
                left[1].append(x)
                continue
            if left:
                x = np.concatenate([*left[1], x])
                more = len(x) - len(first)
                first = np.concatenate([np.arange(more) == 0, first])
                first[more] = False
                last += more
            yield from searched(x[:last], first[:last])
            left = ((t[-1], s[-1]), [x[last:]])
        if left:
            whole = np.concatenate(left[1])
            yield from searched(whole, np.arange(len(whole)) == 0)

    dealt = shards.repartition("tree", "shard").sortWithinPartitions("tree", "shard", "x").select("x", "tree", "shard")
    return dealt.mapInArrow(link, "u long, v long")


def fingerprint_labels(marked: DataFrame, radius: int = RADIUS, name: str = "fingerprint") -> DataFrame:
    """(fingerprint, label) for every distinct fingerprint; equal labels are one component."""
    prints = marked.select(name).distinct()
    labels = connected_components(near_links(prints, radius, name=name))
    return prints.join(labels.withColumnRenamed("node", name), name, "left").select(
        name, F.coalesce("label", name).alias("label")
    )


def group_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", radius: int = RADIUS
) -> DataFrame:
    """``docs`` without its text but with ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest id among the rows linked by chains of fingerprints at most
    ``radius`` bits apart, the row itself included. Copies are collapsed to one fingerprint
    before the search, so their number costs nothing there. Texts without words, null ones
    included, have fingerprint zero and are linked like any other. Null ids never become
    component ids; a component of null ids has a null one. Repeated rows are all returned,
    an empty frame gives an empty one. Columns of ``docs`` named like the result are renamed.
    """
    from tabprep.session import reliable_checkpoint

    for name in ("fingerprint", "component_id"):
        if name in docs.columns:
            docs = docs.withColumnRenamed(name, free_names(docs, [name])[0])
    marked = reliable_checkpoint(with_fingerprint(docs, text).drop(text))
    (label,) = free_names(marked, ["label"])
    labels = fingerprint_labels(marked, radius).withColumnRenamed("label", label)
    least = marked.groupBy("fingerprint").agg(F.min(id_col).alias("component_id"))
    known = reliable_checkpoint(least.join(labels, "fingerprint"))
    groups = known.groupBy(label).agg(F.min("component_id").alias("component_id"))
    ids = known.select("fingerprint", label).join(groups, label).select("fingerprint", "component_id")
    return marked.join(ids, "fingerprint").withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` per group of near duplicates: the one with the smallest id.

    Groups are those of ``group_near_duplicates``. Null ids come last; rows with equal ids are
    told apart by a hash of all columns, and of rows that are equal throughout one stays.
    Columns are those of ``docs``.
    """
    from tabprep.session import reliable_checkpoint

    mark, key, lone, label = free_names(docs, ["fingerprint", "row_key", "lone", "label"])
    keyed = docs.withColumn(key, F.xxhash64(*docs.columns))
    slim = keyed.select(F.col(id_col).alias("id"), F.col(key).alias("key"), F.col(text).alias("text"))
    marked = reliable_checkpoint(with_fingerprint(slim).drop("text"))
    labels = fingerprint_labels(marked, radius)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))
    least = marked.groupBy("fingerprint").agg(first.alias("first"))
    reps = least.join(labels, "fingerprint").groupBy("label").agg(F.min("first").alias("first"))
    copies = marked.groupBy("id", "key").count()
    reps = reps.select("first.id", "first.key").join(
        copies.where("count > 1").select(F.col("id").alias("i"), F.col("key").alias("k"), F.lit(False).alias(lone)),
        F.col("id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k")),
        "left",
    )
    reps = reps.select(F.col("id").alias(mark), F.col("key").alias(label), F.coalesce(lone, F.lit(True)).alias(lone))
    kept = keyed.join(reps, (F.col(key) == F.col(label)) & F.col(id_col).eqNullSafe(F.col(mark)))
    again = kept.where(~F.col(lone)).dropDuplicates([key, id_col])
    return kept.where(lone).unionByName(again).select(*docs.columns)
