"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier adds spans."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from tabprep.llm.common import free_names
from tabprep.llm.pii_spans import KINDS, base_spans, candidates, features, masked, written
from tabprep.session import reliable_checkpoint

#: Distinct candidates that the classifier is fitted on, at most: as many of each kind and vote pattern, by hash.
SAMPLE = 20_000
ACCEPT = 0.9


def estimate_reliability(counts: Mapping[tuple[int, ...], int], rounds: int = 50) -> tuple[dict, list]:
    """Posterior of each vote pattern, and each labeler's vote shares given (not given) the class.

    Expectation-maximisation for two classes and independent labelers that vote 1, -1 or 0
    (abstain), begun from the share of yes among the votes cast. One pseudo-count per vote,
    three for a vote in a labeler's own sense, keeps the classes from changing places.
    """
    import numpy as np

    patterns = sorted(counts)
    if not patterns:
        return {}, []
    weight = np.array([counts[p] for p in patterns], dtype=float)
    votes = np.array(patterns) + 1
    post = np.array([(1 + sum(v > 0 for v in p)) / (2 + sum(v != 0 for v in p)) for p in patterns])
    shares: list = []
    for _ in range(rounds):
        shares = []
        for k in range(votes.shape[1]):
            yes, no = (np.bincount(votes[:, k], weights=weight * q, minlength=3) for q in (post, 1 - post))
            yes, no = yes + np.array([1, 1, 3]), no + np.array([3, 1, 1])
            shares.append((yes / yes.sum(), no / no.sum()))
        prior = ((weight * post).sum() + 1) / (weight.sum() + 2)
        score = np.full(len(patterns), np.log(prior / (1 - prior)))
        for k, (yes, no) in enumerate(shares):
            score += np.log(yes[votes[:, k]] / no[votes[:, k]])
        post = 1 / (1 + np.exp(-score))
    return dict(zip(patterns, post.tolist())), shares


def fit_classifier(
    rows: list[list[float]], targets: list[float], weights: list[float] | None = None, steps: int = 300, penalty: float = 1e-3
):
    """Weights of a logistic regression on soft targets of weighted rows; the last one is the constant."""
    import numpy as np

    x = np.array([[*r, 1.0] for r in rows])
    y = np.array(targets)
    share = np.ones(len(y)) if weights is None else np.array(weights, dtype=float)
    share = share / share.sum()
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        gap = share * (1 / (1 + np.exp(-(x @ w))) - y)
        w -= 0.5 * (x.T @ gap + penalty * w)
    return w


class SpanModel(NamedTuple):
    """What tasks need to judge a candidate; no weights if there was nothing to learn from."""

    weights: list[float]
    accept: float = ACCEPT

    def spans(self, text: str) -> tuple[list, list]:
        """(base spans, all spans) of a text; added spans never overlap others."""
        base = base_spans(text)
        taken, added = [(a, b) for _, a, b in base], []
        for c in candidates(text) if self.weights else ():
            if c.base or 1 not in c.votes or -1 in c.votes or any(a < c.end and c.start < b for a, b in taken):
                continue
            if self.score(features(text, c)) >= self.accept:
                added.append((c.kind, c.start, c.end))
                taken.append((c.start, c.end))
        return base, base + added

    def score(self, row: list[float]) -> float:
        from math import exp

        z = sum(w * v for w, v in zip(self.weights, [*row, 1.0]))
        return 1 / (1 + exp(-max(-50.0, min(50.0, z))))


def fit_spans(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> SpanModel:
    """Votes of all candidates in all texts weigh the labelers; a bounded sample fits the classifier.

    Equal candidates are one row with their number from the first aggregate on, so a vector that
    a third of all rows share is neither all of the sample nor a burden to one task. The
    sample takes the same number of distinct rows of every kind and vote pattern, by the hash of
    their features, all where there are fewer; a row weighs as many candidates as it stands for.
    Only counts of vote patterns (at most 27 a kind) and the sample reach the driver, and no size
    or skew of a table can leave the sample empty.
    """

    def collect(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            rows = []
            for cell in b.column(0):
                body = cell.as_py() or ""
                rows += [(list(c.votes), features(body, c)) for c in candidates(body)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([v for v, _ in rows], pa.list_(pa.int32())),
                    pa.array([f for _, f in rows], pa.list_(pa.float64())),
                ],
                ["votes", "features"],
            )

    found = docs.select(text).mapInArrow(collect, "votes array<int>, features array<double>")
    kind = F.slice("features", 1, len(KINDS)).alias("kind")
    rows = reliable_checkpoint(found.groupBy("votes", "features").count()).select("*", kind)
    patterns = rows.groupBy("kind", "votes").agg(F.count("*").alias("distinct"), F.sum("count").alias("total")).collect()
    if not patterns:
        return SpanModel([])
    counts: Counter = Counter()
    for p in patterns:
        counts[tuple(p["votes"])] += p["total"]
    posterior, _ = estimate_reliability(counts)
    quota = max(1, sample // len(patterns))
    # Hashes are spread evenly, so below this bound lie about twice as many as are wanted; then the first are taken.
    large = [p for p in patterns if p["distinct"] > 2 * quota]
    hashed = F.xxhash64("features", "votes")
    below = F.lit(True)
    for p in large:
        own = (F.col("kind") == F.array(*map(F.lit, p["kind"]))) & (F.col("votes") == F.array(*map(F.lit, p["votes"])))
        below &= ~own | (hashed <= (2 * quota << 64) // p["distinct"] - (1 << 63))
    order = Window.partitionBy("kind", "votes").orderBy(hashed, "features")
    picked = rows.where(below).withColumn("place", F.row_number().over(order)).where(F.col("place") <= quota).collect()
    held: Counter = Counter()
    for r in picked:
        held[tuple(r["kind"]), tuple(r["votes"])] += r["count"]
    whole = {(tuple(p["kind"]), tuple(p["votes"])): p["total"] for p in patterns}
    stands_for = {key: whole[key] / n for key, n in held.items()}
    weights = [r["count"] * stands_for[tuple(r["kind"]), tuple(r["votes"])] for r in picked]
    fitted = fit_classifier([r["features"] for r in picked], [posterior[tuple(r["votes"])] for r in picked], weights)
    return SpanModel(fitted.tolist())


def find_personal_data(docs: DataFrame, text: str = "text", model: SpanModel | None = None) -> DataFrame:
    """``docs`` with ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` and ``base`` for the base spans, ``spans`` for all and ``masked``, the text without them.

    Spans are ``kind:start:end`` in code points, end exclusive, by kind and start, joined by
    commas. Base spans always stay; others are added where at least one labeler says yes, none
    says no and the classifier is sure. Without ``model`` one is fitted on ``docs``.

    Texts are searched whole, whatever their length. Null ones count as empty and are masked to empty ones; rows are judged one by one, so
    repeated rows all stay and no rows give none. Columns of ``docs`` that bear a name of the
    result are renamed with closing underscores.
    """
    names = [*(f"n_{k}" for k in KINDS), "base", "spans", "masked"]
    for name in names:
        if name in docs.columns:
            docs = docs.withColumnRenamed(name, free_names(docs, [name])[0])
    text = text if text in docs.columns else free_names(docs, [text])[0]
    known = model or fit_spans(docs, text)
    at = docs.columns.index(text)

    def judge(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            bodies = [cell.as_py() or "" for cell in b.column(at)]
            found = [known.spans(body) for body in bodies]
            yield pa.RecordBatch.from_arrays(
                [
                    *b.columns,
                    *(pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS),
                    pa.array([written(base) for base, _ in found], pa.string()),
                    pa.array([written(spans) for _, spans in found], pa.string()),
                    pa.array([masked(t, spans) for t, (_, spans) in zip(bodies, found)], pa.string()),
                ],
                [*b.schema.names, *names],
            )

    kinds = [LongType()] * len(KINDS) + [StringType()] * 3
    result = StructType([*docs.schema.fields, *(StructField(n, k) for n, k in zip(names, kinds))])
    return docs.mapInArrow(judge, result)
