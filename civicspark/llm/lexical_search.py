"""Ranked lexical search by hybrid TAAT-DAAT (operator 11).

The terms of the searched items are the vocabulary. One map pass counts them in every
whole document; numbers of documents and terms come from aggregates of that. A second
map pass reads the counts in blocks of documents, each with its inverted lists, and
ranks the block for every item: short lists are summed term at a time into accumulators;
these are then one more list, with the largest accumulator as its bound, beside the long
lists, which are taken by falling bound. A document is admitted only while the bounds of
what is left could still lift a new one to the k-th place; after that, documents whose
sum and remaining bounds stay below it are skipped, and long lists are only searched
for those that remain. The least k-th place known is that of the block, or that of a
sixteenth of the documents ranked before all others (a lower bound for every block;
no document is left out by it). A block returns at most k documents an item, and the
best k of all blocks are the result: that of scoring every document.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import keep

TOP = 50
#: Separators become spaces, A-Z small letters; bytes of other characters stay.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
#: Bytes of item texts that are searched for in one pass; more items take several passes.
ITEM_BYTES = 32 << 20
#: Bytes of a text that are split at a time.
PIECE = 1 << 20
#: Documents and list entries of a block; a list is short if it holds less than one in SHORT of the block's documents.
BLOCK_DOCS, BLOCK_ENTRIES, SHORT = 16_384, 4_000_000, 16
#: One in SEED documents is ranked first, for the least score that counts.
SEED = 16


def terms(text: bytes | None) -> Iterator[list[bytes]]:
    """Terms of a whole text in pieces: maximal runs of letters and digits of ASCII and of all other characters, A-Z lower-cased."""
    folded, at = (text or b"").translate(FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + PIECE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def _counted(vocabulary: dict[bytes, int]):
    """(doc_id, text) -> (doc_id, n, terms, tfs): number of terms, known ones and how often they occur."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids, tfs = [], [], []
            for text in batch.column("text"):
                found = Counter()
                for piece in terms(text.as_py()):
                    found.update(map(vocabulary.get, piece))
                sizes.append(found.total())
                found.pop(None, None)
                ids.append(np.fromiter(found.keys(), np.int32, len(found)))
                tfs.append(np.fromiter(found.values(), np.int64, len(found)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int64()))], ["doc_id", "n", "terms", "tfs"])

    return run


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


@dataclass(frozen=True)
class Items:
    """Terms of each item (numbers in the vocabulary), weights of the vocabulary, and what all documents have."""
    terms: list[np.ndarray]
    weights: np.ndarray
    documents: int
    length: int


class Block:
    """Inverted lists of some documents, in ascending order of ids (null last)."""

    def __init__(self, items: Items, n: np.ndarray, sizes: np.ndarray, found: np.ndarray, tf: np.ndarray):
        doc = np.repeat(np.arange(len(n)), sizes)
        norm = np.array([50 + 50 * int(x) * items.documents // max(items.length, 1) for x in n], np.int64)
        worth = items.weights[found] * (1_000_000_000 * tf // (1000 * tf + 20 * norm[doc]))
        order = np.lexsort((doc, found))
        self.doc, self.worth, self.size = doc[order], worth[order], len(n)
        known, first = np.unique(found[order], return_index=True)
        ends = np.append(first[1:], len(order))
        self.lists = {int(t): (int(a), int(b)) for t, a, b in zip(known, first, ends)}
        self.most = dict(zip(known.tolist(), np.maximum.reduceat(self.worth, first).tolist() if len(first) else []))

    def ranked(self, wanted: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """At most k documents of the highest sums above zero, best first, and the sums; those below ``least`` may be missing."""
        lists = [self.lists[t] + (self.most[t],) for t in wanted.tolist() if self.most.get(t, 0) > 0]
        short = [x for x in lists if (x[1] - x[0]) * SHORT < self.size]
        long = sorted((x for x in lists if (x[1] - x[0]) * SHORT >= self.size), key=lambda x: -x[2])
        sums = np.zeros(self.size, np.int64)
        for a, b, _ in short:
            sums[self.doc[a:b]] += self.worth[a:b]
        left, least = sum(x[2] for x in long), max(least, 1)
        least = max(least, _kth(sums, k))
        while long and left >= least:  # a document of the long lists alone could still count
            a, b, most = long.pop(0)
            sums[self.doc[a:b]] += self.worth[a:b]
            left -= most
            least = max(least, _kth(sums, k))
        open_ = np.flatnonzero(sums + left >= least)
        open_ = open_[sums[open_] > 0]
        for a, b, most in long:
            docs = self.doc[a:b]
            at = np.minimum(np.searchsorted(docs, open_), len(docs) - 1)
            hit = docs[at] == open_
            sums[open_[hit]] += self.worth[a:b][at[hit]]
            left -= most
            open_ = open_[sums[open_] + left >= least]
        best = open_[np.argsort(-sums[open_], kind="stable")[:k]]
        return best, sums[best]


def _kth(sums: np.ndarray, k: int) -> int:
    return int(np.partition(sums, len(sums) - k)[len(sums) - k]) if len(sums) >= k else 0


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, docs, entries = [], 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_DOCS):
            part = batch.slice(at, BLOCK_DOCS)
            held.append(part)
            docs += part.num_rows
            entries += len(part.column("terms").flatten())
            if docs >= BLOCK_DOCS or entries >= BLOCK_ENTRIES:
                yield pa.Table.from_batches(held)
                held, docs, entries = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _ranked(items: Items, k: int, least: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _blocks(batches):
            found = found.sort_by("doc_id").combine_chunks()
            ids = found.column("doc_id").combine_chunks()
            lists, tfs = (found.column(c).combine_chunks() for c in ("terms", "tfs"))
            block = Block(items, found.column("n").to_numpy(), lists.value_lengths().to_numpy(),
                          lists.flatten().to_numpy(), tfs.flatten().to_numpy())
            for i, wanted in enumerate(items.terms):
                best, sums = block.ranked(wanted, k, int(least[i]))
                if len(best):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(best), i, np.int32)), ids.take(pa.array(best)), pa.array(sums)], ["item", "doc_id", "score"])

    return run


def _best(candidates: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _pass(docs: DataFrame, items: list[tuple], k: int) -> DataFrame:
    """The result for items (id, text) whose texts fit into a task."""
    spark, names = docs.sparkSession, list({i: None for i, _ in items})
    of: dict = {i: set() for i in names}
    for i, text in items:
        for piece in terms(text):
            of[i].update(piece)
    vocabulary = {t: n for n, t in enumerate(sorted(set().union(*of.values())))}
    counts = keep(docs.mapInArrow(_counted(vocabulary), "doc_id long, n long, terms array<int>, tfs array<long>"), "term-counts")
    documents, length = counts.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(max(1, len(vocabulary)), np.int64)
    holding = counts.select(F.explode("terms").alias("term")).groupBy("term").count()  # one row for each term of the items at most
    for term, n in holding.collect():
        weights[term] = weight(documents, n)
    known = Items([np.array(sorted(vocabulary[t] for t in of[i]), np.int64) for i in names], weights, documents, length)
    kind = "item int, doc_id long, score long"
    seed = counts.where(F.pmod(F.xxhash64("doc_id"), F.lit(SEED)) == 0)
    least = np.zeros(len(names), np.int64)
    for item, score in _best(seed.mapInArrow(_ranked(known, k, least), kind), k).where(F.col("rank") == k).select("item", "score").collect():
        least[item] = score
    best = _best(counts.mapInArrow(_ranked(known, k, least), kind), k)
    named = spark.createDataFrame(list(enumerate(names)), "item int, item_id long")
    return best.join(named, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the ``k`` documents of each item with the highest scores above 0.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are ignored.
    Null and empty texts have no terms: such documents are never found and not counted,
    such items find nothing. Ties go by ascending doc_id, null last; every row of a
    repeated doc_id is a document of its own. Rows that repeat an item_id (null included)
    are one item with the terms of all. Items are searched for in passes of about
    ``item_bytes`` of their texts, whatever their number.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").cast("binary").alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + F.lit(16)), F.lit(0))).first()[0]
    passes, out = max(1, -(-total // item_bytes)), None
    for i in range(passes):
        share = items.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == i).distinct()
        found = _pass(docs, [(r["item_id"], bytes(r["text"] or b"")) for r in share.collect()], k)
        out = found if out is None else out.union(found)
    return out
