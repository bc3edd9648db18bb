"""Runs of periodic words: tiles per period octave, boundary extensions, and intervals stitched by Spark."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from tabprep.llm.common import free_names
from tabprep.llm.substrings import _BASE, _mixed, _powers
from tabprep.session import reliable_checkpoint

#: A run repeats its period so often at least, and has so many words at least.
TIMES, LEAST = 4, 6
#: Words that are searched together, and boundaries between two words of one tile.
GROUP_WORDS, TILE = 1 << 19, 16
_CELLS = 1 << 22


def _smallest_primes(n: int):
    """For each number below ``n`` its smallest prime divisor."""
    import numpy as np

    out = np.arange(n, dtype=np.int64)
    for p in range(2, int(n**0.5) + 1):
        if out[p] == p:
            part = out[p * p :: p]
            part[part == np.arange(p * p, n, p)] = p
    return out


def _numbered(bodies: list[bytes]):
    """Word numbers of all texts, longest first, each text closed by a number of its own; the order and the ends."""
    import numpy as np

    index: dict = defaultdict(count().__next__)
    words = [body.split() for body in bodies]
    order = sorted(range(len(words)), key=lambda k: -len(words[k]))
    parts = []
    for k in order:
        parts.append(np.fromiter(map(index.__getitem__, words[k]), np.int64, len(words[k])))
        parts.append(np.array([-1 - k], np.int64))
    ends = np.cumsum([len(words[k]) + 1 for k in order])
    return np.concatenate(parts), np.array(order), ends


def _extents(ids, b, q, size: int):
    """(true, back, ahead) at boundaries ``b`` for periods ``q``: whether the words of [b, b + size) equal those
    ``q`` later, and how many more do before and behind them, up to ``size`` each."""
    import numpy as np

    out = []
    for at in range(0, len(b), step := max(1, _CELLS // (3 * size))):
        place = b[at : at + step, None] + np.arange(-size, 2 * size)
        later = place + q[at : at + step, None]
        inside = (place >= 0) & (later < len(ids))
        same = inside & (ids[np.where(inside, place, 0)] == ids[np.where(inside, later, 0)])
        stop = np.zeros((len(same), 1), dtype=bool)
        back = np.argmin(np.hstack([same[:, :size][:, ::-1], stop]), axis=1)
        ahead = np.argmin(np.hstack([same[:, 2 * size :], stop]), axis=1)
        out.append((same[:, size : 2 * size].all(axis=1), back, ahead))
    return tuple(np.concatenate(p) for p in zip(*out))


def tile_fragments(bodies: list[bytes]) -> Iterator[tuple]:
    """Arrays (text, period, from, to): stretches whose words equal those one period later.

    Octave k has the periods from 2^k up to twice that, and a boundary every 2^k words. A run
    of at least four periods holds the whole cells behind two boundaries or more, so each cell
    whose words return one period later is extended from its boundary to both sides: the
    values of Z-functions forward and backward, found by comparing words and cut at one cell.
    Rolling hashes pick the cells and leave out periods that are multiples of a smaller one; no
    text is reported by hashes alone. Stretches are joined inside a tile of some boundaries;
    those of different tiles overlap, and ``find_runs`` stitches them.
    """
    import numpy as np

    ids, order, ends = _numbered(bodies)
    starts = np.concatenate([[0], ends[:-1]])
    lengths = ends - starts - 1
    power = _powers(_BASE, len(ids) + 1)
    inverse = _powers(pow(_BASE, -1, 1 << 64), len(ids) + 1)
    value = _mixed((ids + (1 << 40)).astype(np.uint64) * np.uint64(_BASE))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * power[:-1])])
    longest = int(lengths[0]) if len(lengths) else 0
    prime = _smallest_primes(max(2, longest // TIMES + 1))
    size = 1
    while longest >= max(LEAST, TIMES * size):
        active = int(np.searchsorted(-lengths, -TIMES * size, side="right"))
        end = int(ends[active - 1])
        cells = (total[size : end + 1] - total[: end + 1 - size]) * inverse[: end + 1 - size]
        right = cells[size:]
        left = cells[::size][: -(-len(right) // size)]
        padded = np.full(len(left) * size, ~left[-1] if len(left) else 0, dtype=np.uint64)
        padded[: len(right)] = right
        row, at = np.nonzero(padded.reshape(-1, size) == left[:, None])
        b, q = row * size, size + at
        last = len(cells) - 1

        def returns(b, q):
            ok = (b >= 0) & (b + q <= last)
            return ok & (cells[np.where(ok, b, 0)] == cells[np.where(ok, b + q, 0)])

        goes_on = returns(b - size, q) | returns(b + size, q)
        b, q = b[goes_on], q[goes_on]
        inside = q < len(prime)
        b, q = b[inside], q[inside]
        simple, rest = np.ones(len(q), dtype=bool), q.copy()
        while len(open_ := np.flatnonzero(simple & (rest > 1))):
            r = prime[rest[open_]]
            p, x, y = q[open_] // r, b[open_], q[open_]
            simple[open_] = (total[x + y - p] - total[x]) * power[p] != total[x + y] - total[x + p]
            rest[open_] //= r
        b, q = b[simple], q[simple]
        if len(b):
            true, back, ahead = _extents(ids, b, q, size)
            whole = true & ((back == size) | (ahead == size))
            b, q, back, ahead = b[whole], q[whole], back[whole], ahead[whole]
        if len(b):
            by = np.lexsort((b, q))
            b, q, back, ahead = b[by], q[by], back[by], ahead[by]
            tile = b // (TILE * size)
            first = np.append(True, (np.diff(q) != 0) | (np.diff(b) != size) | (np.diff(tile) != 0))
            begin = np.flatnonzero(first)
            until = np.append(begin[1:], len(b)) - 1
            text = np.searchsorted(ends, b[begin], side="right")
            low = b[begin] - back[begin] - starts[text]
            yield order[text], q[begin], low, b[until] + size + ahead[until] - starts[text]
        size *= 2


def collapsed(body: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """The words of a text with one space between, without those that a run (start, length, period) repeats."""
    import numpy as np

    words = body.split()
    if runs:
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in runs:
            edge[start + period] += 1
            edge[start + length] -= 1
        gone = np.cumsum(edge)[:-1] > 0
        words = [w for w, g in zip(words, gone.tolist()) if not g]
    return b" ".join(words)


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``runs`` (start, period, length by start and period) and the text ``collapsed``.

    A run is a stretch of consecutive words with smallest period q, of at least six words and
    four periods, that no neighbouring word extends. ``collapsed`` holds the words, one space
    between, that no run covers behind its first period.

    Texts are cut into tiles per octave of periods inside the tasks that read them (see
    ``tile_fragments``); intervals are shuffled by text and period and stitched where they
    overlap or touch, then gathered per text and joined to the rows. Equal texts are one
    text to the shuffle, told by two 64-bit hashes, so copies cost one set of intervals. Work
    grows as n log n in the words of a text, whatever its periods; memory as its words.

    Null and wordless texts have no runs and an empty ``collapsed``. Repeated rows all
    come back. No rows give no rows. Columns of ``docs`` named like the result are renamed with
    closing underscores.
    """
    for name in ("runs", "collapsed"):
        if name in docs.columns:
            docs = docs.withColumnRenamed(name, free_names(docs, [name])[0])
    text = text if text in docs.columns else free_names(docs, [text])[0]
    key, other = free_names(docs, ["text_key", "text_key_2"])
    body = F.coalesce(text, F.lit(""))
    keyed = docs.withColumns({key: F.xxhash64(body), other: F.xxhash64(F.lit(7), body)})

    def search(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        names = ["key", "other", "period", "low", "high"]
        for b in batches:
            bodies = b.column(2).cast(pa.binary()).to_pylist()
            keys = [b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)]
            sizes = np.cumsum([len(x) // 2 for x in bodies])
            for group in np.split(np.arange(len(bodies)), np.flatnonzero(np.diff(sizes // GROUP_WORDS)) + 1):
                if not len(group):
                    continue
                for doc, *columns in tile_fragments([bodies[k] for k in group]):
                    rows = [k[group[doc]] for k in keys] + columns
                    yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()) for r in rows], names)

    slim = keyed.where(F.col(text).isNotNull()).select(key, other, text)
    found = slim.mapInArrow(search, "key long, other long, period long, low long, high long").distinct()
    same = Window.partitionBy("key", "other", "period").orderBy("low", "high")
    reached = F.max("high").over(same.rowsBetween(Window.unboundedPreceding, -1))
    islands = found.withColumn("fresh", F.coalesce(F.col("low") > reached, F.lit(True)).cast("long")).withColumn(
        "island", F.sum("fresh").over(same)
    )
    runs = islands.groupBy("key", "other", "period", "island").agg(
        F.min("low").alias("start"), (F.max("high") - F.min("low") + F.col("period")).alias("length")
    )
    runs = runs.where((F.col("length") >= LEAST) & (F.col("length") >= TIMES * F.col("period")))
    gathered = runs.groupBy(F.col("key").alias(key), F.col("other").alias(other)).agg(
        F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs")
    )
    gathered = reliable_checkpoint(gathered)  # a side of its own lets adaptive execution split a hot text
    joined = keyed.join(gathered, [key, other], "left").select(*docs.columns, "runs")
    joined = joined.withColumn("runs", F.coalesce("runs", F.array().cast(joined.schema["runs"].dataType)))
    at = joined.columns.index(text)

    def collapse(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            bodies = b.column(at).cast(pa.binary()).to_pylist()
            runs = b.column(b.num_columns - 1).to_pylist()
            out = [
                collapsed(body or b"", [(r["start"], r["length"], r["period"]) for r in found])
                for body, found in zip(bodies, runs)
            ]
            column = pa.array(out, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, column], [*b.schema.names, "collapsed"])

    return joined.mapInArrow(collapse, StructType([*joined.schema.fields, StructField("collapsed", StringType())]))
