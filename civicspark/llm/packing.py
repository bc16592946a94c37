"""Packing token sequences by best-fit decreasing (operator 3).

Documents are tokenized in Arrow batches; those above the capacity are first cut
into full windows, which leaves one piece below the capacity. Best-fit decreasing
looks only at lengths, and there are at most ``capacity`` of them: the driver gets
the number of pieces of each length, whatever the size of the corpus, and places
whole groups of equal pieces at once. A segment tree indexed by remaining capacity
finds the tightest open window for a length. The resulting plan (ranks of a length
-> windows and offset; bounded by the capacity, not by the data) goes to the
executors, where each piece reads its place by its rank among the pieces of its
length. The packing is that of one sequential run over all pieces.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from .common import gapless, keep

CAPACITY = 1024
#: Id that ends every document, and the tokenizer's only added token.
END, ADDED = 0, {"<|endoftext|>": 50256}
#: Pre-tokenizer of byte-level BPE vocabularies of this kind (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoding(ranks: bytes) -> tiktoken.Encoding:
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=table, special_tokens=ADDED)


class Ids:
    """Ids of whole texts and the end id: those of the vocabulary's ``tokenizers`` file, by tiktoken at three times its speed.

    tiktoken gives up on very long runs of white space; such texts go to the file's own tokenizer.
    """

    def __init__(self, ranks: bytes, whole: str):
        self.fast, self.whole, self.slow = encoding(ranks), whole, None

    def __call__(self, text: str) -> np.ndarray:
        try:
            ids = self.fast.encode_to_numpy(text, allowed_special=set(ADDED))
        except ValueError:
            self.slow = self.slow or Tokenizer.from_str(self.whole)
            ids = self.slow.encode(text, add_special_tokens=False).ids
        return np.append(ids, END).astype("<u4")


def pieces(
    docs: DataFrame, ranks_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None,
) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids): full windows of each document and what is left.

    ``ids`` holds unsigned 32-bit little-endian ids. Null and empty texts have the end
    id alone. ``ranks_path`` is a tiktoken rank file and ``tokenizer_path`` the ``tokenizers``
    file of the same vocabulary (by default its namesake ending in .json); the driver reads
    both, a few MB that travel with the job.
    """
    with open(ranks_path, "rb") as file:
        ranks = file.read()
    with open(tokenizer_path or ranks_path.rsplit(".", 1)[0] + ".json", encoding="utf-8") as file:
        whole = file.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_ids = Ids(ranks, whole)
        for batch in batches:
            row, start, length, total, ids = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                found = token_ids(text.as_py() or "")
                for at in range(0, len(found), capacity):
                    part = found[at:at + capacity]
                    row.append(i)
                    start.append(at)
                    length.append(len(part))
                    total.append(len(found))
                    ids.append(part.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(total, pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "start", "length", "doc_tokens", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, start long, length long, doc_tokens long, ids binary")


class OpenWindows:
    """Segment tree over remaining capacities: which of them have open windows."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.groups: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def add(self, remaining: int, first: int, n: int) -> None:
        """Open ``n`` windows from number ``first`` on with ``remaining`` free places each."""
        if remaining and n:
            self.groups[remaining].append((first, n))
            self._change(remaining, n)

    def take(self, remaining: int) -> tuple[int, int]:
        first, n = self.groups[remaining].pop()
        self._change(remaining, -n)
        return first, n

    def _change(self, remaining: int, n: int) -> None:
        node = self.leaves + remaining
        while node:
            self.count[node] += n
            node //= 2

    def tightest(self, length: int) -> int:
        """Smallest remaining capacity of at least ``length`` with an open window; 0 if none."""
        node = self.leaves + length
        while not self.count[node]:
            while node & 1:  # a right child: nothing larger below this parent
                node //= 2
            if not node:
                return 0
            node += 1
        while node < self.leaves:
            node *= 2
            node += not self.count[node]
        return node - self.leaves


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, pieces, first window, offset) of best-fit decreasing.

    Row r places the pieces of its length with the ranks first, first + 1, ... at one
    offset of as many consecutive windows.
    """
    tree, out, windows = OpenWindows(capacity), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room:
                first, n = tree.take(room)
            else:
                room = capacity
                first, n = windows, -(-left // (capacity // length))
                windows += n
            # equal pieces fill the tightest window before they go to the next one
            each = room // length
            full = min(n, left // each)
            for j in range(each if full else 0):
                out.append((length, rank + j * full, full, first, capacity - room + j * length))
            rank, left = rank + full * each, left - full * each
            tree.add(room - each * length, first, full)
            if full < n and left:
                for j in range(left):
                    out.append((length, rank + j, 1, first + full, capacity - room + j * length))
                tree.add(room - left * length, first + full, 1)
                full, left = full + 1, 0
            tree.add(room, first + full, n - full)
    return np.array(out, np.int64).reshape(-1, 5)


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``found`` (a column ``length`` of 1 to ``capacity``, any others) with sequence_id and offset.

    Lengths beyond the capacity fail. Equal rows are interchangeable; an empty table stays empty.
    """
    found = keep(found, "pieces")
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError("a piece does not fit the capacity")
    places = plan(counts, capacity)
    shift = 1 << 44
    places = places[np.lexsort((places[:, 1], places[:, 0]))]
    first_rank = places[:, 0] * shift + places[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            at = np.searchsorted(first_rank, length * shift + rank, side="right") - 1
            kept = [c for c in batch.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(places[at, 3] + rank - places[at, 1]), pa.array(places[at, 4])],
                [*kept, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields)
    return gapless(found, ["length"], "_rank").mapInArrow(run, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the packed pieces laid together; a group holds at most the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")).select(
        "sequence_id", "length",
        F.aggregate("parts", F.lit(b""), lambda ids, x: F.concat(ids, x["ids"])).alias("ids"))
