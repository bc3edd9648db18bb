"""Packs documents into token windows: best fit decreasing over a tree of remaining capacities."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.subwords import byte_bpe, byte_bpe_special, encoder

#: Sequence ids are this power of two times the partition's number, plus a count.
PARTITION_BITS = 33


class CapacityTree:
    """Counts open windows by remaining capacity; finds the least capacity that is large enough."""

    def __init__(self, most: int):
        self._size = 1 << most.bit_length()
        self._count = [0] * (2 * self._size)

    def add(self, capacity: int, change: int) -> None:
        k = capacity + self._size
        while k:
            self._count[k] += change
            k >>= 1

    def tightest(self, need: int) -> int | None:
        """The smallest capacity >= need that some open window has."""
        k = need + self._size
        if self._count[k]:
            return need
        while k > 1:
            if not k & 1 and self._count[k + 1]:  # a right-hand neighbour covers larger capacities
                k += 1
                while k < self._size:
                    k *= 2
                    k += not self._count[k]
                return k - self._size
            k >>= 1
        return None


def best_fit_decreasing(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """(window number, offset) for each length, longest first, each put where it leaves least room."""
    tree, opened, count = CapacityTree(window), [[] for _ in range(window + 1)], 0
    out = [(0, 0)] * len(lengths)
    for k in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        capacity = tree.tightest(lengths[k])
        if capacity is None:
            number, capacity = count, window
            count += 1
        else:
            number = opened[capacity].pop()
            tree.add(capacity, -1)
        out[k] = (number, window - capacity)
        left = capacity - lengths[k]
        if left:
            opened[left].append(number)
            tree.add(left, 1)
    return out


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    window: int = 1024,
    end_id: int = 0,
    block_tokens: int = 4_000_000,
    vocabulary: tuple | None = None,
) -> DataFrame:
    """Pieces of all documents, each with its place in a sequence of at most ``window`` ids.

    A document is its subword ids and ``end_id``. Overlong ones are cut into full windows; what
    is left of each document is packed with the others of its block by best fit decreasing. A
    block is what follows one another in an input partition, ``block_tokens`` ids or a little
    more, so no task holds more than that, nothing is shuffled, no key can be hot, and a task
    that is run again gives the same pieces. Only the last windows of a block stay unfilled;
    partitions far below a block's size waste about one window each.

    ``vocabulary`` is a file of ranks, a pattern and the special tokens; where a text spells one of
    these, it is its one id. Result: the id column, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit),
    ``doc_tokens``, ``sequence_id``, ``offset``. Null and empty texts are just ``end_id``;
    repeated rows and rows with a null id are packed one by one; no rows give no pieces.
    Other columns are left out, so their names cannot clash.
    """
    named = vocabulary or (*byte_bpe(), byte_bpe_special())

    def pack(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encode = encoder(*named).ids
        end, step = np.array([end_id], dtype="<u4").tobytes(), 4 * window
        number = TaskContext.get().partitionId() << PARTITION_BITS
        full: list[tuple] = []
        tails: list[tuple] = []
        held = 0

        def batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            key, start, ids, total, sequence, offset = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(key, kind),
                    pa.array(start, pa.int64()),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(total, pa.int64()),
                    pa.array(sequence, pa.int64()),
                    pa.array(offset, pa.int64()),
                ],
                ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        def closed(kind: pa.DataType) -> Iterator:
            nonlocal number, held
            places = best_fit_decreasing([len(t[2]) // 4 for t in tails], window)
            rows = full + [(*t, number + n, at) for t, (n, at) in zip(tails, places, strict=True)]
            number += 1 + max((n for n, _ in places), default=-1)
            full.clear()
            tails.clear()
            held = 0
            for k in range(0, len(rows), 4096):
                yield batch(rows[k : k + 4096], kind)

        kind = None
        for b in batches:
            kind = b.schema.field(0).type
            for key, body in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = encode(body.as_py() or "") + end
                total = len(ids) // 4
                cut = len(ids) - len(ids) % step
                for at in range(0, cut, step):
                    full.append((key, at // 4, ids[at : at + step], total, number, 0))
                    number += 1
                if cut < len(ids):
                    tails.append((key, cut // 4, ids[cut:], total))
                held += total
                if held >= block_tokens:
                    yield from closed(kind)
        if held:
            yield from closed(kind)

    source = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return source.mapInArrow(pack, schema).withColumnRenamed("id", id_col)
