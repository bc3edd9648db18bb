"""Near-duplicate classes: a multi-index join of b-bit minwise signatures, confirmed on whole shingle sets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tabprep.llm.common import free_name
from tabprep.llm.components import connected_components
from tabprep.llm.substrings import _BASE, _mixed, window_hashes, word_hashes
from tabprep.session import reliable_checkpoint, shared_path

SHINGLE = 2
#: Links hold at 100 * intersection >= SHARE * union.
SHARE = 80
#: A signature has CHUNKS chunks of four symbols of 16 bits; a chunk is one long.
CHUNKS, SYMBOLS, BITS = 8, 4, 16
#: Two chunks may differ in so many symbols, so every pair within this distance meets in some chunk.
ERRORS = 1
RADIUS = CHUNKS * (ERRORS + 1) - 1
#: Members further apart than this are not joined by a chunk they share: about 0.44 similar.
FAR = 18
#: Members of a group that one task links at once: signatures of a bucket, and sets of a class.
BUCKET_ROWS, CLASS_ROWS = 1 << 16, 1 << 12
#: Bytes of text hashed at once, which takes many times as much memory, and rows whose sets a worker holds at once.
_TEXT_BYTES, _SET_ROWS = 1 << 20, 1 << 10

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SYMBOL_MASKS = [((1 << BITS) - 1) << BITS * k for k in range(SYMBOLS)]


def shingle_sets(texts: list[bytes | None], shingle: int = SHINGLE) -> list:
    """Sorted distinct 64-bit shingle hashes of each UTF-8 text; of fewer words, the hash of all as one."""
    import numpy as np

    out, at = [], 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size < _TEXT_BYTES):
            size += len(texts[stop] or b"") + 1
            stop += 1
        bodies = [(t or b"").translate(_LOWER) for t in texts[at:stop]]
        places, words = word_hashes(b" ".join(bodies))
        ends = np.searchsorted(places, np.cumsum([len(b) + 1 for b in bodies]))
        hashes = window_hashes(words, shingle, _BASE)
        begin = 0
        for end in ends.tolist():
            n = end - begin
            if n >= shingle:
                own = np.sort(hashes[begin : end - shingle + 1])
                own = own[np.append(True, own[1:] != own[:-1])]
            elif n:
                few = np.append(words[begin:end], np.uint64(n))
                own = window_hashes(few, n + 1, _BASE)
            else:
                own = np.zeros(0, np.uint64)
            out.append(own)
            begin = end
        at = stop
    return out


def signatures(sets: list):
    """Per set its chunks, rows of CHUNKS longs: 16 bits of each of 32 smallest permuted hashes; empty sets give zeros."""
    import numpy as np

    chunks = np.zeros((len(sets), CHUNKS), dtype=np.uint64)
    some = np.flatnonzero([len(s) for s in sets])
    if not len(some):
        return chunks.view(np.int64)
    rng = np.random.default_rng(97)
    factors = rng.integers(0, 1 << 63, CHUNKS * SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for low in range(0, len(some), 2048):
        part = some[low : low + 2048]
        whole = np.concatenate([sets[k] for k in part])
        starts = np.concatenate([[0], np.cumsum([len(sets[k]) for k in part])[:-1]])
        for k, factor in enumerate(factors):
            least = _mixed(np.minimum.reduceat(whole * factor, starts))
            symbol = least >> np.uint64(64 - BITS)
            chunks[part, k // SYMBOLS] |= symbol << np.uint64(BITS * (k % SYMBOLS))
    return chunks.view(np.int64)


def digests(sets: list):
    """A 64-bit digest of each set."""
    import numpy as np

    out = np.zeros(len(sets), dtype=np.uint64)
    for k, own in enumerate(sets):
        out[k] = np.bitwise_xor.reduce(_mixed(own * np.uint64(_BASE))) ^ np.uint64(len(own)) if len(own) else 0
    return _mixed(out).view(np.int64)


def _chunk_names() -> list[str]:
    return [f"chunk_{k}" for k in range(CHUNKS)]


def signed_sets(docs: DataFrame, id_col: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """(id, set_id, size, chunks, members) of each row; ``members`` holds the hashes of its set."""

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa

        slices = (b.slice(low, _SET_ROWS) for b in batches for low in range(0, b.num_rows, _SET_ROWS))
        for b in slices:
            sets = shingle_sets(b.column(1).cast(pa.binary()).to_pylist(), shingle)
            columns = [pa.array(digests(sets)), pa.array([len(s) for s in sets], pa.int64())]
            columns += [pa.array(c.copy()) for c in signatures(sets).T]
            columns.append(pa.array([s.tobytes() for s in sets], pa.binary()))
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names)

    slim = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    names = ["id", "set_id", "size", *_chunk_names(), "members"]
    longs = [StructField(n, LongType()) for n in names[1:-1]]
    return slim.mapInArrow(add, StructType([slim.schema["id"], *longs, StructField("members", BinaryType())]))


def chunk_keys(sets: DataFrame) -> DataFrame:
    """(set_id, key) per chunk and set of allowed errors: the chunk with one of its symbols masked out.

    Two chunks with at most one wrong symbol agree under one of the four masks, so enumerating
    masks stands for enumerating the 4 * 65535 wrong values. A key carries chunk and mask.
    """
    structs = [
        F.struct(
            F.lit(c * SYMBOLS + k).cast("byte").alias("part"),
            F.col(name).bitwiseAND(F.lit(_signed(~mask & (1 << 64) - 1)).cast("long")).alias("value"),
        )
        for c, name in enumerate(_chunk_names())
        for k, mask in enumerate(_SYMBOL_MASKS)
    ]
    return sets.select("set_id", F.inline(F.array(*structs)))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def grown(n: int, near: Callable) -> list[tuple[int, int]]:
    """Links that join each component of ``n`` points; what has been reached is not compared again.

    ``near(k, rest)`` tells which of the places ``rest`` are linked to place k.
    """
    import numpy as np

    links, rest, front = [], np.arange(n), []
    while len(rest):
        if not front:
            front, rest = [int(rest[0])], rest[1:]
            if not len(rest):
                break
        k = front.pop()
        hit = near(k, rest)
        if hit.any():
            reached = rest[hit].tolist()
            links += [(k, j) for j in reached]
            front += reached
            rest = rest[~hit]
    return links


def near_signatures(chunks, far: int = FAR) -> Callable:
    """Whether signatures differ in at most ``far`` symbols."""
    import numpy as np

    symbols = np.ascontiguousarray(chunks).view(np.uint16)
    return lambda k, rest: (symbols[rest] != symbols[k]).sum(axis=1) <= far


def near_sets(members: list, share: int = SHARE) -> Callable:
    """Whether sets share enough of their hashes, counted exactly over posting lists."""
    import numpy as np

    sizes = np.array([len(m) for m in members])
    held: dict = {}

    def index(places):
        """Posting lists of the members at ``places``."""
        whole = np.concatenate([members[j] for j in places])
        owner = np.repeat(np.arange(len(places)), sizes[places])
        order = np.argsort(whole, kind="stable")
        held.update(places=places, hashes=whole[order], owners=owner[order])

    def near(k: int, rest):
        if not held or 2 * len(rest) < len(held["places"]):
            index(rest)
        begin = np.searchsorted(held["hashes"], members[k], side="left")
        count = np.searchsorted(held["hashes"], members[k], side="right") - begin
        at = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
        both = np.bincount(held["owners"][at], minlength=len(held["places"]))
        both = both[np.searchsorted(held["places"], rest)]
        return 100 * both >= share * (sizes[k] + sizes[rest] - both)

    return near


def group_links(rows: DataFrame, group: list[str], payload: list[str], near: Callable, block: int) -> DataFrame:
    """Links (u, v) between the ``set_id`` of rows of one group that give its components under ``near``.

    ``near`` makes the test from the payload columns of some rows, each a list or array. A group
    of at most ``block`` rows is linked in one task, whose cost is what ``grown`` compares. A
    larger one is dealt into blocks by a hash, each with the group's hub (its smallest id), and
    linked inside; then the rows that are not yet in the hub's component, as a rule few, meet
    every block of the group. So no pair of a group goes untested unless already connected.
    """
    sizes = rows.groupBy(*group).agg(F.count("*").alias("rows_in"), F.min("set_id").alias("hub"))
    spread = rows.join(sizes.where(F.col("rows_in") > 1), group)
    blocks = F.ceil(F.col("rows_in") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("set_id"), blocks).cast("int")
    every = F.sequence(F.lit(0), blocks - 1)
    home = spread.withColumn("cell", F.explode(F.when(F.col("set_id") == F.col("hub"), every).otherwise(F.array(own))))
    columns = [*group, "cell", "set_id", *payload]

    def link(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held, key = [], None

        def flushed() -> Iterator:
            table = pa.Table.from_batches(held)
            ids = table.column("set_id").to_numpy()
            keys = np.stack([table.column(c).to_numpy() for c in [*group, "cell"]])
            edges = np.flatnonzero(np.append(True, np.diff(keys, axis=1).any(axis=0)))
            data = [table.column(c) for c in payload]
            us, vs = [], []
            for a, z in zip(edges.tolist(), [*edges[1:].tolist(), len(ids)]):
                if z - a > 1:
                    pairs = grown(z - a, near(*[d[a:z] for d in data]))
                    us += [ids[a + i] for i, _ in pairs]
                    vs += [ids[a + j] for _, j in pairs]
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(b.schema.names.index(c)).to_numpy() for c in [*group, "cell"]])
            last = np.flatnonzero(np.append(True, np.diff(keys, axis=1).any(axis=0)))[-1]
            if held and (last or tuple(keys[:, 0]) != key):
                first = 0
                if tuple(keys[:, 0]) == key:
                    first = int(np.flatnonzero((keys != keys[:, :1]).any(axis=0))[0])
                    held.append(b.slice(0, first))
                yield from flushed()
                held = []
                if last > first:
                    held = [b.slice(first, last - first)]
                    yield from flushed()
                held = [b.slice(last)]
            elif last:
                held = [b.slice(0, last)]
                yield from flushed()
                held = [b.slice(last)]
            else:
                held.append(b)
            key = tuple(keys[:, -1])
        if held:
            yield from flushed()

    def linked(cells: DataFrame) -> DataFrame:
        dealt = cells.select(*columns).repartition(*group, "cell").sortWithinPartitions(*group, "cell", "set_id")
        return dealt.mapInArrow(link, "u long, v long")

    links = reliable_checkpoint(linked(home).distinct())
    if sizes.where(F.col("rows_in") > block).isEmpty():
        return links
    labels = reliable_checkpoint(connected_components(links))
    of = labels.select(F.col("node").alias("set_id"), "label")
    of_hub = labels.select(F.col("node").alias("hub"), F.col("label").alias("hub_label"))
    large = spread.where(F.col("rows_in") > block).join(of, "set_id", "left").join(of_hub, "hub", "left")
    inside = F.coalesce(F.col("label") == F.col("hub_label"), F.col("set_id") == F.col("hub"))
    large = reliable_checkpoint(large.withColumn("odd", ~inside).select(*group, "set_id", *payload, "rows_in", "odd"))
    odd = large.groupBy(*group).agg(F.count_if("odd").alias("odd_in")).where("odd_in > 0")
    grid = large.join(odd, group)
    half = F.lit(max(1, block // 2))
    across, down = F.ceil(F.col("rows_in") / half).cast("int"), F.ceil(F.col("odd_in") / half).cast("int")
    place = F.xxhash64("set_id", F.lit(1))
    as_any = F.transform(F.sequence(F.lit(0), down - 1), lambda d: d * across + F.pmod(place, across).cast("int"))
    as_odd = F.transform(F.sequence(F.lit(0), across - 1), lambda a: F.pmod(place, down).cast("int") * across + a)
    cells = F.array_distinct(F.when(F.col("odd"), F.concat(as_any, as_odd)).otherwise(as_any))
    return links.unionByName(linked(grid.withColumn("cell", F.explode(cells)))).distinct()


def class_links(sets: DataFrame, members: DataFrame, share: int = SHARE, bucket_rows: int = BUCKET_ROWS, class_rows: int = CLASS_ROWS) -> DataFrame:
    """Confirmed links (u, v) that give the components of all found pairs of distinct sets.

    ``sets`` (set_id, chunks) has one row per set, ``members`` (set_id, members) one or more.
    """
    sets = reliable_checkpoint(sets)
    keys = chunk_keys(sets)
    shared = keys.groupBy("part", "value").agg(F.count("*").alias("held")).where("held > 1").select("part", "value")
    live = keys.join(reliable_checkpoint(shared), ["part", "value"])
    rows = reliable_checkpoint(live.join(sets, "set_id").select("part", "value", "set_id", *_chunk_names()))

    def by_signature(*chunks):
        import numpy as np

        return near_signatures(np.stack([c.to_numpy() for c in chunks], axis=1))

    def by_members(column):
        import numpy as np

        return near_sets([np.frombuffer(m, np.uint64) for m in column.to_pylist()], share)

    maybe = group_links(rows, ["part", "value"], _chunk_names(), by_signature, bucket_rows)
    labels = connected_components(maybe).select(F.col("node").alias("set_id"), F.col("label").alias("class"))
    labels = reliable_checkpoint(labels)
    whole = members.join(F.broadcast(labels) if labels.count() < 100_000 else labels, "set_id").dropDuplicates(["set_id"])
    return group_links(whole.select("class", "set_id", "members"), ["class"], ["members"], by_members, class_rows)


def near_duplicate_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    share: int = SHARE,
    bucket_rows: int = BUCKET_ROWS,
    class_rows: int = CLASS_ROWS,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) of each row of ``docs``.

    A row's set are the distinct ``shingle``-word shingles of its text, A-Z lower-cased; of fewer
    words, all of them as one. Rows link if 100 * intersection >= share * union; ``component_id``
    is the smallest id reachable, and ``kept`` tells whether it is the row's own.

    Equal sets are one set from the start, told by 64 bits. A set's signature has 32 symbols,
    the low-order 16 bits of a minwise hash each, in eight chunks. By the pigeonhole principle two
    signatures at most 15 symbols apart have a chunk with at most one wrong symbol; with that
    symbol masked they share a key (``chunk_keys``). Sets of one key within ``FAR`` symbols form
    candidate classes; inside a class links are confirmed on whole sets. A pair of similarity
    0.8 shares no key with a probability of about one in a million. Neither step emits
    the pairs of a group, nor needs a large group in one task (``group_links``).

    Null and wordless texts have an empty set and link with nothing, so their component is their
    own id. Null ids become no component unless a component has no other; such rows are kept.
    Repeated rows all come back. No rows give no rows. Only id and text are looked at, so no
    other column can clash.
    """
    path = shared_path(docs.sparkSession, "shingle-sets")
    signed_sets(docs, id_col, text, shingle).write.parquet(path)
    table = docs.sparkSession.read.parquet(path)
    slim = table.select("id", "set_id", "size")
    filled = table.where("size > 0")
    sets = filled.groupBy("set_id").agg(*[F.max(c).alias(c) for c in _chunk_names()])
    links = class_links(sets, filled.select("set_id", "members"), share, bucket_rows, class_rows)
    labels = reliable_checkpoint(connected_components(links).select(F.col("node").alias("set_id"), "label"))
    least = slim.where("size > 0").groupBy("set_id").agg(F.min("id").alias("least"))
    known = least.join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    groups = known.groupBy("label").agg(F.min("least").alias("component_id"))
    ids = known.join(groups, "label").select(F.col("set_id").alias("of"), "component_id")
    found = slim.join(ids, (F.col("set_id") == F.col("of")) & (F.col("size") > 0), "left")
    component: Column = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("id"))
    name = free_name(["n_shingles", "component_id", "kept"], id_col)
    return found.select(
        F.col("id").alias(name),
        F.col("size").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
