"""Exact substring deduplication: rolling hashes of word windows, counted across all documents."""

from __future__ import annotations

import re
from itertools import compress

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tabprep.llm.common import free_names

WINDOW = 35
#: Text that is hashed together, and text whose windows are counted together.
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20

# Odd multipliers (and, at use, their inverses modulo 2 to the 64).
_BYTE_BASE, _BASE, _BASE_2 = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xAF251AF3B0F025B5
_STEP = 1 << 20
_WORD_END = re.compile(rb"[\x09-\x0D\x20]|\Z")


def _powers(base: int, n: int):
    import numpy as np

    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mixed(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _byte_values():
    import numpy as np

    return _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BYTE_BASE))


def word_hashes(data: bytes):
    """(places, hashes) of the words of UTF-8 text: a polynomial over bytes, modulo 2 to the 64."""
    import numpy as np

    space = np.zeros(256, dtype=bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    values, inverse = _byte_values(), pow(_BYTE_BASE, -1, 1 << 64)
    places, hashes, at = [], [], 0
    while at < len(data):
        stop = min(len(data), at + _STEP)
        stop = _WORD_END.search(data, stop).start()
        part = np.frombuffer(data, np.uint8, stop - at, at)
        edge = np.diff(np.concatenate([[True], space[part], [True]]).astype(np.int8))
        begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[part] * _powers(_BYTE_BASE, len(part)))])
        hashes.append(_mixed((total[end] - total[begin]) * _powers(inverse, len(part) + 1)[begin]))
        places.append(begin + at)
        at = stop
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(places), np.concatenate(hashes)


def window_hashes(words, size: int, base: int):
    """Rabin-Karp hash of each run of ``size`` word hashes, from one running sum."""
    import numpy as np

    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _powers(base, len(words)))])
    return _mixed((total[size:] - total[:n]) * _powers(pow(base, -1, 1 << 64), n))


class Block:
    """The windows of the texts of one block; the same texts in any order give the same one."""

    def __init__(self, texts: list[bytes], size: int, buckets: int):
        import numpy as np

        self.size = size
        places, words = word_hashes(b" ".join(texts))
        bounds = np.cumsum([len(t) + 1 for t in texts])
        self.doc = np.searchsorted(bounds, places, side="right")
        h, other = window_hashes(words, size, _BASE), window_hashes(words, size, _BASE_2)
        self.starts = np.flatnonzero(self.doc[: len(h)] == self.doc[size - 1 :][: len(h)]) if len(h) else np.zeros(0, np.int64)
        unique, first, self.number, self.count = np.unique(
            h[self.starts], return_index=True, return_inverse=True, return_counts=True
        )
        bucket = (other[self.starts][first] >> np.uint64(20)) % np.uint64(buckets)
        self.order = np.argsort(bucket, kind="stable")
        self.unique, self.bucket = unique[self.order], bucket[self.order].astype(np.int64)

    def by_bucket(self) -> list[tuple[int, bytes]]:
        import numpy as np

        if not len(self.bucket):
            return []
        begin = np.flatnonzero(np.append(True, np.diff(self.bucket) != 0))
        return [(int(self.bucket[a]), p.tobytes()) for a, p in zip(begin, np.split(self.unique, begin[1:]))]

    def removed(self, elsewhere) -> list:
        """Per word, whether a repeated window covers it. ``elsewhere``: flags in the order sent."""
        import numpy as np

        flag = np.empty(len(self.unique), dtype=bool)
        flag[self.order] = elsewhere
        hit = self.starts[(flag | (self.count > 1))[self.number]]
        edge = np.zeros(len(self.doc) + self.size + 1, dtype=np.int32)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + self.size, -1)
        return np.cumsum(edge)[: len(self.doc)] > 0


def remove_repeated(
    docs: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``docs`` with ``kept`` text, ``n_words``, ``n_removed`` and ``removed`` (word intervals).

    A word goes if one of the windows that cover it, ``window`` words in a row of one document,
    starts anywhere else as well, in the same document or another. ``kept`` has the other words
    with one space between; ``removed`` lists maximal intervals as ``from-to``, end exclusive.

    Documents are dealt into blocks by a hash of the row. Each block sends every distinct window
    hash once to one of many buckets, told by a second hash, eight bytes each; a bucket answers
    with one bit per hash: seen in another block or not. So a passage that a third of all rows
    share costs one hash per block. The shuffled text serves both passes. Blocks and buckets
    have bounded sizes and grow in number with the text. Two different windows are taken for
    equal only if 64 bits and the bucket agree.

    Null texts count as empty and keep no words; texts shorter than a window keep all. Repeated
    rows repeat each other's windows. No rows give no rows. Columns of ``docs`` that bear a name
    of the result are renamed with closing underscores.
    """
    names = ("kept", "n_words", "n_removed", "removed")
    for name in names:
        if name in docs.columns:
            docs = docs.withColumnRenamed(name, free_names(docs, [name])[0])
    text = text if text in docs.columns else free_names(docs, [text])[0]
    block, bucket, hashes, bits = free_names(docs, ["block", "bucket", "hashes", "bits"])
    size = docs.agg(F.sum(F.octet_length(text) + F.lit(1).cast("long"))).first()[0] or 0
    blocks, buckets = 1 + size // block_bytes, 1 + size // bucket_bytes
    row_hash = F.xxhash64(*docs.columns)
    dealt = docs.withColumn(block, F.pmod(row_hash, F.lit(blocks))).repartition(block)

    def texts_of(table) -> tuple[list[bytes], list[int]]:
        """UTF-8 texts in an order that does not depend on how rows arrived."""
        import pyarrow as pa

        found = [t or b"" for t in table.column(text).cast(pa.binary()).to_pylist()]
        order = sorted(range(len(found)), key=found.__getitem__)
        return [found[k] for k in order], order

    def send(key, table):
        import pyarrow as pa

        texts, _ = texts_of(table)
        rows = Block(texts, window, buckets).by_bucket()
        return pa.table(
            [
                pa.array([key[0].as_py()] * len(rows), pa.int64()),
                pa.array([b for b, _ in rows], pa.int64()),
                pa.array([h for _, h in rows], pa.binary()),
            ],
            names=[block, bucket, hashes],
        )

    def answer(table):
        import numpy as np
        import pyarrow as pa

        parts = [np.frombuffer(x.as_py(), np.uint64) for x in table.column(hashes)]
        whole = np.concatenate(parts)
        order = np.argsort(whole, kind="stable")
        same = np.diff(whole[order]) == 0
        seen = np.empty(len(whole), dtype=bool)
        seen[order] = np.append(same, False) | np.append(False, same)
        flags = np.split(seen, np.cumsum([len(p) for p in parts])[:-1])
        return table.select([block, bucket]).append_column(
            bits, pa.array([np.packbits(f).tobytes() for f in flags], pa.binary())
        ).append_column("n", pa.array([len(f) for f in flags], pa.int64()))

    def finish(key, table, answers):
        import numpy as np
        import pyarrow as pa

        texts, order = texts_of(table)
        made = Block(texts, window, buckets)
        replies = sorted(zip(*(answers.column(c).to_pylist() for c in (bucket, bits, "n"))))
        flags = [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for _, b, n in replies]
        gone = made.removed(np.concatenate([*flags, np.zeros(0, bool)]))
        ends = np.searchsorted(made.doc, np.arange(len(texts)), side="right")
        kept, counts, lost, spans, at = [], [], [], [], 0
        for body, end in zip(texts, ends.tolist()):
            own = gone[at:end]
            words, at = body.split(), end
            counts.append(len(words))
            lost.append(int(own.sum()))
            if lost[-1]:
                words = compress(words, (~own).tolist())
                edge = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
                spans.append(",".join(f"{a}-{b}" for a, b in edge.reshape(-1, 2).tolist()))
            else:
                spans.append("")
            kept.append(b" ".join(words))
        out = table.drop_columns([block]).take(pa.array(order, pa.int64()))
        for name, column in zip(
            names, (pa.array(kept, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(lost, pa.int64()), pa.array(spans, pa.string()))
        ):
            out = out.append_column(name, column)
        return out

    sent = dealt.groupBy(block).applyInArrow(send, f"`{block}` long, `{bucket}` long, `{hashes}` binary")
    told = sent.groupBy(bucket).applyInArrow(answer, f"`{block}` long, `{bucket}` long, `{bits}` binary, n long")
    kinds = (StringType(), LongType(), LongType(), StringType())
    result = StructType([*docs.schema.fields, *(StructField(n, k) for n, k in zip(names, kinds))])
    return dealt.groupBy(block).cogroup(told.groupBy(block)).applyInArrow(finish, result)
