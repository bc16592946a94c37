"""Mixing sources to target weights by subset-sum budget fitting (operator 12).

Documents are counted by source and exact length. A source's target is its share of the
budget by weight, at most ``CAP`` times its size; what is above is shared again. As many
whole passes over the source as fit are taken. The rest of the budget is filled per
source from its counts (at most sqrt(2 x size) different lengths, so a group is small):
the same share of every length first, up to ``ROOM`` words below the budget, then the
longest that fit, and the last words by a bounded knapsack over what is left, which
finds the largest sum within the budget. Which documents of a length are taken is drawn
by a seeded hash: each gets its number among those of its length, without bringing them
together, and the first ones are taken.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import gapless, keep

WEIGHTS, SHARE, CAP, SEED = (3, 1, 2), 1.5, 2, 42
#: Words of a source's budget that are left to the knapsack.
ROOM = 1 << 16
#: Sources that may be mixed: their totals and targets go through the driver.
MAX_SOURCES = 100_000


def targets(totals: Sequence[int], weights: Sequence[float], share: float = SHARE, cap: float = CAP) -> list[float]:
    """Words of each source: ``share`` of all words by weight, none above ``cap`` times its total."""
    out, rest, open_ = [0.0] * len(totals), share * sum(totals), list(range(len(totals)))
    while open_:
        unit = rest / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] > cap * totals[i]]
        for i in full or open_:
            out[i] = float(cap * totals[i]) if full else unit * weights[i]
        if not full:
            break
        rest -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def knapsack(lengths: np.ndarray, left: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length (at most ``left``) have the largest sum within ``budget``."""
    out = np.zeros(len(lengths), np.int64)
    if budget <= 0 or not len(lengths):
        return out
    reached, via, steps = np.zeros(budget + 1, bool), np.full(budget + 1, -1, np.int32), []
    reached[0] = True
    best = budget // int(np.gcd.reduce(lengths)) * int(np.gcd.reduce(lengths))
    for i, (length, count) in enumerate(zip(lengths.tolist(), left.tolist())):
        part = 1
        count = min(count, budget // length)
        while count > 0 and not reached[best]:
            take = min(part, count)
            by = take * length
            new = reached[:budget + 1 - by] & ~reached[by:]
            via[by:][new] = len(steps)
            reached[by:] |= new
            steps.append((i, take, by))
            count, part = count - take, part * 2
        if reached[best]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, take, by = steps[via[at]]
        out[i] += take
        at -= by
    return out


def fit(lengths: np.ndarray, counts: np.ndarray, target: float, room: int = ROOM) -> tuple[int, np.ndarray]:
    """Whole passes over a source, and how many documents of each length are taken once more."""
    total = int((lengths * counts).sum())
    if not total:
        return 0, np.zeros(len(lengths), np.int64)
    budget = int(round(target))
    whole, rest = divmod(budget, total)
    bulk = max(0, rest - room)
    extra = np.array([c * bulk // total for c in counts.tolist()], np.int64)
    rest -= int((extra * lengths).sum())
    for i in np.argsort(-lengths, kind="stable").tolist():
        if rest <= room:
            break
        if lengths[i]:
            more = min(int(counts[i] - extra[i]), (rest - room) // int(lengths[i]))
            extra[i] += more
            rest -= more * int(lengths[i])
    usable = np.flatnonzero((lengths > 0) & (extra < counts))[::-1]
    extra[usable] += knapsack(lengths[usable], (counts - extra)[usable], rest)
    return whole, extra


def _fitted(room: int):
    schema = pa.schema([("source_no", pa.int32()), ("size", pa.int64()), ("whole", pa.int64()), ("extra", pa.int64())])

    def run(found: pa.Table) -> pa.Table:
        found = found.sort_by("size")
        lengths, counts = (found.column(c).to_numpy() for c in ("size", "n"))
        whole, extra = fit(lengths, counts, found.column("target")[0].as_py(), room)
        return pa.table([found.column("source_no"), pa.array(lengths), pa.array(np.full(len(lengths), whole, np.int64)), pa.array(extra)],
                        schema=schema)

    return run


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED, room: int = ROOM) -> DataFrame:
    """Rows (doc_id, size, source_size, target, taken), one per row of ``docs`` (doc_id, text, source; others are ignored).

    Size: words, runs without ASCII white space (0 for null and empty texts). Sources
    in the order of their code points, null last, weigh ``weights`` in turn. ``taken`` is
    the size times the passes that take the document. A source's sum stays within its
    target rounded to a whole word, and below it by less than the smallest gap its lengths
    leave. Rows that repeat are documents of their own; which of equal ones is taken
    cannot be told apart. The same ``seed`` gives the same result. An empty table gives none.
    """
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"))
    sized = keep(sized.withColumn("draw", F.xxhash64(F.lit(seed), "doc_id")), "sizes")
    counts = keep(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    totals = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")).orderBy(
        F.asc_nulls_last("source")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: mix by a coarser column")
    sizes = [r["source_size"] for r in totals]
    goals = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share, cap)
    sources = docs.sparkSession.createDataFrame(
        [(i, r["source"], s, t) for i, (r, s, t) in enumerate(zip(totals, sizes, goals))],
        "source_no int, of string, source_size long, target double")
    plan = keep(
        counts.join(sources, F.col("source").eqNullSafe(F.col("of"))).select("source_no", "size", "n", "target")
        .groupBy("source_no").applyInArrow(_fitted(room), "source_no int, size long, whole long, extra long"), "plan")
    known = sized.join(sources, F.col("source").eqNullSafe(F.col("of"))).select("doc_id", "draw", "source_no", "size")
    numbered = gapless(keep(known, "drawn"), ["source_no", "size"], "nth")
    taken = F.col("size") * (F.col("whole") + (F.col("nth") < F.col("extra")).cast("long"))
    return numbered.join(plan, ["source_no", "size"]).withColumn("taken", taken).join(
        sources.drop("of"), "source_no").select("doc_id", "size", "source_size", "target", "taken")
