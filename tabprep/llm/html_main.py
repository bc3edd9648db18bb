"""Main text of pages; boilerplate is found by a suffix array over the token streams of a host."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import free_names
from tabprep.llm.html_blocks import ARTICLE, FRAME, OPEN, page_blocks
from tabprep.llm.url_filter import host_of
from tabprep.session import reliable_checkpoint

#: Repeated runs of so many tokens count as boilerplate; a power of two.
LEAST_RUN = 8
#: A block inside an article goes only if so many articles hold all of it, and so large a share of those beside it.
ARTICLE_PAGES, ARTICLE_SHARE = 3, 0.2
#: Pages of a host that share one suffix array.
GROUP_PAGES = 500
#: Groups of large hosts whose runs a bucket holds the share of (about eight million bytes each).
BUCKET_GROUPS = 8
#: Sizes of so many large hosts, at most, are sent to every task (some megabytes).
BROADCAST_HOSTS = 50_000


def run_owners(streams: Sequence, owner: Sequence[int], least: int = LEAST_RUN):
    """For each stream of token codes, how many distinct owners the run of ``least`` tokens at each place has.

    The streams are joined with unique separators and their suffixes are sorted by doubling up
    to the first ``least`` tokens: equal neighbours there are the substrings of that length.
    A run that would go on over the end of its stream has one owner. ``least`` must be a power of two.
    """
    import numpy as np

    sizes = np.array([len(s) for s in streams], dtype=np.int64)
    total = int(sizes.sum()) + len(streams)
    text = np.empty(total, dtype=np.int64)
    page = np.empty(total, dtype=np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    for k, s in enumerate(streams):
        a = int(starts[k])
        text[a : a + len(s)] = s
        text[a + len(s)] = -1 - k
        page[a : a + len(s) + 1] = owner[k]
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order, width = np.argsort(rank, kind="stable"), 1
    while width < least:
        after = np.zeros(total, dtype=np.int64)
        after[: max(0, total - width)] = rank[width:] + 1
        key = rank * (total + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(total, dtype=np.int64)
        rank[order] = new
        width *= 2
    begin = np.flatnonzero(np.append(True, np.diff(rank[order]) != 0)) if total else np.zeros(0, np.int64)
    count = np.zeros(total, dtype=np.int64)
    if total:
        order = np.lexsort((page, rank))
        fresh = np.append(True, (np.diff(page[order]) != 0) | (np.diff(rank[order]) != 0))
        count = np.add.reduceat(fresh.astype(np.int64), begin)[rank]
    return [count[int(a) : int(a) + int(n)] for a, n in zip(starts, sizes)]


def _covered(shared, least: int = LEAST_RUN):
    """Which tokens of a stream lie in a run that begins where ``shared`` is true."""
    import numpy as np

    edge = np.zeros(len(shared) + least + 1, dtype=np.int64)
    at = np.flatnonzero(shared)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + least, -1)
    return np.cumsum(edge)[: len(shared)] > 0


def repeated_tokens(streams: Sequence, owner: Sequence[int], least: int = LEAST_RUN, owners: int = 2):
    """For each stream of token codes, which tokens lie in a run shared by so many distinct owners;
    overlapping runs make up all longer repeats."""
    return [_covered(n >= owners, least) for n in run_owners(streams, owner, least)]


def _run_hashes(tokens: Sequence[Sequence[str]], least: int = LEAST_RUN) -> list:
    """For each stream of tokens, a 64-bit hash of the run of ``least`` tokens that begins at each place."""
    import numpy as np
    import pandas as pd
    import xxhash

    from tabprep.llm.substrings import _mixed

    codes, known = pd.factorize(np.array([t for ts in tokens for t in ts], dtype=object))
    hashes = np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) for t in known], dtype=np.uint64)
    out = []
    for t in np.split(hashes[codes], np.cumsum([len(t) for t in tokens])[:-1]) if len(codes) else [hashes] * len(tokens):
        n = max(0, len(t) - least + 1)
        h = np.zeros(n, dtype=np.uint64)
        for k in range(least):
            h = _mixed(h * np.uint64(0xD1342543DE82EF95) + t[k : k + n])
        out.append(h)
    return out


def _page_runs(pages: list[list[tuple[str, int]]], least: int):
    """(hashes of runs, identities of pages, runs asked for) of the whole streams of pages: distinct pairs by rising
    hash, two pages a run at most, and the rising hashes of the runs that hold open text."""
    import numpy as np
    import xxhash

    tokens = [[t for text, _ in blocks for t in text.split()] for blocks in pages]
    runs, asked = _run_hashes(tokens, least), [np.zeros(0, np.uint64)]
    for blocks, h in zip(pages, runs, strict=True):
        is_open = np.array([kind == OPEN for text, kind in blocks for _ in text.split()], dtype=np.int64)
        before = np.concatenate([[0], np.cumsum(is_open)])
        asked.append(h[before[least : least + len(h)] > before[: len(h)]])
    own = [xxhash.xxh64_intdigest(" ".join(t).encode("utf-8", "surrogatepass")) for t in tokens]
    run = np.concatenate([*runs, np.zeros(0, np.uint64)])
    page = np.repeat(np.array(own, dtype=np.uint64), [len(r) for r in runs])
    return *_first_pages(run, page), np.unique(np.concatenate(asked))


def _first_pages(run, page, most: int = 2):
    """Distinct pairs by rising run, ``most`` pages a run at most."""
    import numpy as np

    order = np.lexsort((page, run))
    run, page = run[order], page[order]
    fresh = np.append(True, (np.diff(run) != 0) | (np.diff(page) != 0))[: len(run)]
    run, page = run[fresh], page[fresh]
    begin = np.flatnonzero(np.append(True, np.diff(run) != 0)[: len(run)])
    size = np.diff(np.append(begin, len(run)))
    kept = np.arange(len(run)) - np.repeat(begin, size) < most
    return run[kept], page[kept]


def _stale_blocks(pages: list[list[tuple[str, int]]], least: int) -> list[list[bool]]:
    """For each block of each page, whether it is boilerplate that stands inside an article.

    Each block is a stream of its own, so no run crosses its border. Articles with the same
    text are one owner, whatever frame is around them. A block is stale if runs shared by
    ``ARTICLE_PAGES`` owners, and by ``ARTICLE_SHARE`` of them, cover all of it; but an article
    that such blocks make up by half or more is a copy of others and keeps all of them.
    """
    import pandas as pd

    inside = [[text.split() for text, kind in blocks if kind == ARTICLE] for blocks in pages]
    known = {text: k for k, text in enumerate(dict.fromkeys(map(repr, inside)))}
    owner = [known[repr(blocks)] for blocks in inside]
    owners = least_owners(len(known))
    stale = [[False] * len(blocks) for blocks in pages]
    if len(known) < owners:
        return stale
    first = {who: k for k, who in reversed(list(enumerate(owner)))}  # equal articles are searched once
    places = [(k, j) for k in first.values() for j in range(len(inside[k]))]
    codes: dict[str, int] = {}
    streams = [[codes.setdefault(t, len(codes)) for t in inside[k][j]] for k, j in places]
    masks = repeated_tokens(streams, [owner[k] for k, _ in places], least, owners)
    found: dict[int, list[tuple[bool, int]]] = {}
    for (k, _), mask in zip(places, masks, strict=True):
        found.setdefault(owner[k], []).append((bool(len(mask) and mask.all()), len(mask)))
    for k, blocks in enumerate(pages):
        own = found.get(owner[k], [])
        if 2 * sum(n for covered, n in own if covered) < sum(n for _, n in own):
            at = iter(own)
            stale[k] = [kind == ARTICLE and next(at)[0] for _, kind in blocks]
    return stale


def _articles(pages: list[list[tuple[str, int]]]):
    """The tokens of each block in articles, per page, and the identity of each page's article."""
    import numpy as np
    import xxhash

    inside = [[text.split() for text, kind in blocks if kind == ARTICLE] for blocks in pages]
    return inside, np.array([xxhash.xxh64_intdigest(repr(x).encode("utf-8", "surrogatepass")) for x in inside], dtype=np.uint64)


def least_owners(articles: int) -> int:
    """How many of so many distinct articles must share a run that counts as boilerplate."""
    return max(ARTICLE_PAGES, int(ARTICLE_SHARE * articles))


def _owned_runs(pages: list[list[tuple[str, int]]], owned, least: int, runs=None, share: float = 0.0):
    """(rising hashes of runs in the blocks of articles, how many of the articles in ``owned`` hold each): those in
    ``runs``, or those that at least ``share`` of the articles hold."""
    import numpy as np
    import pandas as pd

    inside, identity = _articles(pages)
    own, first = set(owned.tolist()), dict(zip(identity.tolist(), range(len(pages))))  # equal articles are counted once
    places = [(k, block) for who, k in first.items() if who in own for block in inside[k]]
    if runs is None:
        codes = pd.factorize(np.array([t for _, block in places for t in block], dtype=object))[0]
        streams = np.split(codes, np.cumsum([len(block) for _, block in places])[:-1]) if places else []
        counts = run_owners(streams, [k for k, _ in places], least)
        often = [n >= share * len(owned) for n in counts]
        places, often = [p for p, x in zip(places, often) if x.any()], [x for x in often if x.any()]  # the others need no hash
        hashes = _run_hashes([block for _, block in places], least)
        hashes = [h[x[: len(h)]] for h, x in zip(hashes, often, strict=True)]
    else:
        hashes = [h[np.isin(h, runs)] for h in _run_hashes([block for _, block in places], least)]
    pairs = [(np.full(len(h), k), h) for (k, _), h in zip(places, hashes, strict=True) if len(h)]
    if not pairs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    both = pd.DataFrame({"k": np.concatenate([k for k, _ in pairs]), "h": np.concatenate([h for _, h in pairs])}).drop_duplicates()
    return np.unique(both["h"].to_numpy(), return_counts=True)


def _stale_by_runs(pages: list[list[tuple[str, int]]], least: int, runs) -> list[list[bool]]:
    """As ``_stale_blocks``, given the hashes of the runs that enough articles of the whole host share."""
    import numpy as np

    stale = [[False] * len(blocks) for blocks in pages]
    if not len(runs):
        return stale
    for k, blocks in enumerate(pages):
        inside = [text.split() for text, kind in blocks if kind == ARTICLE]
        shared = [np.append(np.isin(h, runs), np.zeros(len(t) - len(h), bool)) for t, h in zip(inside, _run_hashes(inside, least))]
        own = [(bool(len(x) and _covered(x, least).all()), len(x)) for x in shared]
        if 2 * sum(n for covered, n in own if covered) < sum(n for _, n in own):
            at = iter(own)
            stale[k] = [kind == ARTICLE and next(at)[0] for _, kind in blocks]
    return stale


def main_texts(pages: list[list[tuple[str, int]]], least: int = LEAST_RUN, known=None, stale_runs=None) -> list[str]:
    """Main text of each page of one host, given its blocks.

    All blocks of all pages are the streams, so a run counts as repeated wherever it stands;
    pages with the same stream count as one. Blocks of the frame go. An article or main element
    is evidence: of its blocks only stale ones go, each as a whole (``_stale_blocks``), so copies of
    an article keep their text. Of other blocks repeated runs go and unique runs stay. ``known``
    has hashes of runs with open text that two pages of the whole host share, ``stale_runs`` those that
    enough of its articles do.
    """
    import numpy as np
    import pandas as pd

    if not pages:
        return []
    tokens = [[t for text, _ in blocks for t in text.split()] for blocks in pages]
    if any(kind == OPEN for blocks in pages for _, kind in blocks):
        codes = pd.factorize(np.array([t for ts in tokens for t in ts], dtype=object))[0]
        streams = np.split(codes, np.cumsum([len(t) for t in tokens])[:-1])
        owner = pd.factorize(np.array([" ".join(t) for t in tokens], dtype=object))[0]
        covered = repeated_tokens(streams, owner, least)
    else:
        covered = [np.zeros(len(t), dtype=bool) for t in tokens]
    if known is not None and len(known):
        for k, h in enumerate(_run_hashes(tokens, least)):
            shared = np.append(np.isin(h, known), np.zeros(len(tokens[k]) - len(h), bool))
            covered[k] = covered[k] | _covered(shared, least)
    staled = _stale_blocks(pages, least) if stale_runs is None else _stale_by_runs(pages, least, stale_runs)
    out = []
    for blocks, mask, stale in zip(pages, covered, staled, strict=True):
        at, kept = 0, []
        for (text, kind), gone in zip(blocks, stale, strict=True):
            n = len(text.split())
            own = mask[at : at + n]
            at += n
            if kind == ARTICLE and not gone:
                kept.append(text)
            elif kind == OPEN and not own.all():
                kept.append(" ".join(w for w, hit in zip(text.split(), own) if not hit))
        out.append("\n".join(kept))
    return out


def extract_main_text(
    pages: DataFrame, url: str = "url", html: str = "html", least: int = LEAST_RUN, group_pages: int = GROUP_PAGES
) -> DataFrame:
    """``pages`` without ``html`` but with ``text``, the main text of each whole page.

    Pages are parsed where they are read; then the blocks of a host meet. A host with more than
    ``group_pages`` pages is dealt by a hash of its rows into groups of about that size, each
    with a suffix array of its own, so no task holds more than a group, whatever the host's share
    of all rows; the result is that of one suffix array over the host. The groups read the same shuffled blocks
    four times. First they tell which articles they hold (eight bytes a page meet by host), and hear which of them are
    theirs to count. A run that a share of all articles holds has that share in some group, so the runs that do are the
    only ones that groups then name, and count, for the host. Where a host has open text, groups also send the
    hashes of all runs, with two pages each, to buckets and hear which with open text other pages share.
    The sizes of hosts above that bound are joined in, by broadcast if there are at most ``BROADCAST_HOSTS``.

    Null and empty pages have an empty text. Null urls, and urls without a host, share the
    empty host. Repeated rows are all returned and count as one page; no rows give none. A
    column of ``pages`` named ``text`` is renamed with closing underscores.
    """
    if "text" in pages.columns:
        pages = pages.withColumnRenamed("text", free_names(pages, ["text"])[0])
    kept = [c for c in pages.columns if c != html]
    host, groups, group, blocks, kinds = free_names(pages, ["host", "groups", "group", "blocks", "kinds"])

    sizes = pages.groupBy(host_of(F.col(url)).alias(host)).count().where(F.col("count") > group_pages)
    sizes = reliable_checkpoint(sizes.select(host, F.ceil(F.col("count") / group_pages).cast("int").alias(groups)))
    large, total = sizes.agg(F.count("*"), F.coalesce(F.sum(groups), F.lit(0))).first()
    if large <= BROADCAST_HOSTS:
        sizes = F.broadcast(sizes)

    from pyspark.sql.types import ArrayType, ByteType, StringType, StructField, StructType

    source = pages.select(*kept, html)
    row = [f for f in source.schema.fields if f.name != html]
    parsed_type = StructType(
        [*row, StructField(blocks, ArrayType(StringType())), StructField(kinds, ArrayType(ByteType()))]
    )

    def parse(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            found = [page_blocks(x.as_py()) for x in b.column(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [
                    *b.columns[: len(kept)],
                    pa.array([[t for t, _ in f] for f in found], pa.list_(pa.string())),
                    pa.array([[k for _, k in f] for f in found], pa.list_(pa.int8())),
                ],
                [*kept, blocks, kinds],
            )

    # Hosts of one group are group -1.
    spread = F.pmod(F.xxhash64(*[c for c in kept if c != url], url, blocks), F.coalesce(groups, F.lit(1)))
    spread = F.when(F.col(groups).isNull(), F.lit(-1)).otherwise(spread)

    def blocks_of(table) -> list[list[tuple[str, int]]]:
        return [
            list(zip(t, k))
            for t, k in zip(table.column(blocks).to_pylist(), table.column(kinds).to_pylist(), strict=True)
        ]

    def judged(table, known=None, stale=None):
        import pyarrow as pa

        texts = main_texts(blocks_of(table), least, known, stale)
        return table.select(kept).append_column("text", pa.array(texts, pa.string()))

    parsed = source.mapInArrow(parse, parsed_type).withColumn(host, host_of(F.col(url)))
    dealt = parsed.join(sizes, host, "left").withColumn(group, spread.cast("int"))
    dealt = dealt.select(*kept, blocks, kinds, host, group)
    result = StructType([*row, StructField("text", StringType())])
    if not large:
        return dealt.groupBy(host, group).applyInArrow(lambda table: judged(table), result)

    buckets = 1 + total // BUCKET_GROUPS
    message = "host string, group int, bucket int, articles long, runs binary, pages binary, asked binary"
    names = [part.split()[0] for part in message.split(", ")]

    def sent(rows):
        import pyarrow as pa

        types = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        columns = list(zip(*rows)) or [[] for _ in types]
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    def ints(value):
        import numpy as np

        return np.frombuffer(value or b"", "<u8")

    def flat(values) -> bytes:
        return values.astype("<u8").tobytes()

    def hold(key, table):
        """The articles of a group, and whether it has open text."""
        import numpy as np

        host, group = (x.as_py() for x in key)
        if group < 0:
            return sent([])
        pages = blocks_of(table)
        has_open = any(kind == OPEN for page in pages for _, kind in page)
        return sent([(host, group, int(has_open), None, flat(np.unique(_articles(pages)[1])), None, None)])

    def own(table):
        """Every article of a host to one of the groups that hold it, and the number of all."""
        import numpy as np

        rows = sorted(table.to_pylist(), key=lambda r: r["group"])
        held = [ints(r["runs"]) for r in rows]
        known, first = np.unique(np.concatenate(held), return_index=True)
        group = np.repeat(np.arange(len(rows)), [len(h) for h in held])[first]
        has_open = max(r["bucket"] for r in rows)
        return sent([(r["host"], r["group"], has_open, len(known), flat(known[group == k]), None, None) for k, r in enumerate(rows)])

    def name(key, table, told):
        """The runs that may have their share in the host, as bucket -1; all runs of hosts with open text, by buckets."""
        import numpy as np

        host, group = (x.as_py() for x in key)
        if group < 0:
            return sent([])
        (to,) = told.to_pylist()
        pages, owned, n = blocks_of(table), ints(to["runs"]), to["articles"]
        runs = np.zeros(0, np.uint64)
        if len(owned) and n >= least_owners(n):
            runs, _ = _owned_runs(pages, owned, least, share=least_owners(n) / n * (1 - 1e-12))
        rows = [(host, group, -1, n, flat(runs), to["runs"], None)]
        if to["bucket"]:
            run, page, asked = _page_runs(pages, least)
            at, of = ((x >> np.uint64(20)) % np.uint64(buckets) for x in (run, asked))
            rows += [(host, group, int(b), n, flat(run[at == b]), flat(page[at == b]), flat(asked[of == b])) for b in np.unique(at)]
        return sent(rows)

    def answer(key, table):
        """To each group the runs that any group of its host named; of a bucket, those asked for that two pages share."""
        import numpy as np

        rows = table.to_pylist()
        runs = [ints(r["runs"]) for r in rows]
        if key[1].as_py() < 0:
            union = flat(np.unique(np.concatenate(runs)))
            return sent([(r["host"], r["group"], -1, r["articles"], union, r["pages"], None) for r in rows])
        run, _ = _first_pages(np.concatenate(runs), np.concatenate([ints(r["pages"]) for r in rows]))
        twice = run[1:][run[1:] == run[:-1]]
        told = [flat(np.intersect1d(ints(r["asked"]), twice)) for r in rows]
        return sent([(r["host"], r["group"], r["bucket"], None, t, None, None) for r, t in zip(rows, told)])

    def count(key, table, told):
        """How many articles of a group hold each of the runs named for its host."""
        host, group = (x.as_py() for x in key)
        if group < 0:
            return sent([])
        (to,) = [r for r in told.to_pylist() if r["bucket"] < 0]
        named = ints(to["runs"])
        run, n = _owned_runs(blocks_of(table), ints(to["pages"]), least, named) if len(named) else (named, named)
        return sent([(host, group, -1, to["articles"], flat(run), flat(n), None)])

    def total_of(table):
        """The runs that enough articles of a host share, to each of its groups."""
        import numpy as np

        rows = table.to_pylist()
        run, at = np.unique(np.concatenate([ints(r["runs"]) for r in rows]), return_inverse=True)
        n = np.bincount(at, np.concatenate([ints(r["pages"]) for r in rows]), len(run))
        stale = flat(run[n >= least_owners(rows[0]["articles"])])
        return sent([(r["host"], r["group"], -1, None, stale, None, None) for r in rows])

    def judge(key, table, told):
        import numpy as np

        if key[1].as_py() < 0:
            return judged(table)
        rows = told.to_pylist()
        known, stale = (np.concatenate([ints(None), *[ints(r["runs"]) for r in rows if (r["bucket"] < 0) == s]]) for s in (False, True))
        return judged(table, known, stale)

    grouped = dealt.groupBy(host, group)
    owners = grouped.applyInArrow(hold, message).groupBy("host").applyInArrow(own, message)
    named = grouped.cogroup(owners.groupBy("host", "group")).applyInArrow(name, message)
    told = named.groupBy("host", "bucket").applyInArrow(answer, message)
    counted = grouped.cogroup(told.groupBy("host", "group")).applyInArrow(count, message)
    stale = counted.groupBy("host").applyInArrow(total_of, message)
    heard = stale.unionAll(told.where("bucket >= 0"))
    return grouped.cogroup(heard.groupBy("host", "group")).applyInArrow(judge, result)
