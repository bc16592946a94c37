"""Trie of conversation prefixes by composable fingerprints (operator 13).

A turn is named by two 64-bit hashes of (role, text). A prefix is named by the products
P(t1 ... tn) = sum of t_i x B^(i-1) for two odd bases, modulo 2^64; products compose:
P(xy) = P(x) + B^|x| P(y). So the prefixes of a rebuilt conversation (the first k turns
of its base, then its own turns after the first h) are
P(base head of k) + B^(k-h) (P(own prefix) - P(own head of h)): no rebuilt text is made,
and texts are read once. The products of one long conversation are made in several
tasks: turns are sorted over all tasks, each multiplies its stretch, and one product
per task is carried to the next.

Equal names are checked, not trusted: all turns of a name must have the same role and
text, and all members of a node the same parent and the same last turn. By induction over
the depth, nodes are then exactly the equal prefixes. If a check fails, everything is
named anew with another seed.

Sums over a subtree need no walk: a node belongs to its smallest member, so every
conversation owns one stretch of its path, from some depth downwards. The sum below a
node is that of its owner's stretch from the node on, and the whole stretches of all
other members that own one, which begin below the node: one grouping.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import keep
from .runs import BASES

#: Conversations of one base, and heads of at most HEADS - 1 turns.
FAMILY, HEADS = 100, 6
#: Nodes of a stretch that are summed in one group.
STRETCH = 4096
NODE = ["depth", "p1", "p2"]
INVERSE = [pow(b, -1, 1 << 64) for b in BASES]


def _power(base: int, exponent: int) -> np.uint64:
    return np.uint64(pow(base, exponent, 1 << 64))


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
        np.cumprod(out, out=out)
    return out


def _unsigned(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def _products():
    """Sorted turns (conv_id, t1, t2, chars, part) -> place and products within the part: at, p1, p2 and those before the turn, q1, q2."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, done, carry = None, 0, [np.uint64(0)] * 2
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids = batch.column("conv_id").to_numpy()
            first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            start = np.repeat(first, np.diff(np.append(first, n)))
            goes_on = conv is not None and ids[0] == conv
            before = np.where(start == 0, done if goes_on else 0, 0)
            columns = {"at": np.arange(n) - start + before + 1}
            last = start[-1]
            for k, base in enumerate(BASES):
                symbol, powers = _unsigned(batch.column(f"t{k + 1}")), _powers(base, n)
                part = symbol * powers[np.arange(n) - start]
                sums = np.append(np.uint64(0), np.cumsum(part, dtype=np.uint64))
                after, earlier = sums[1:] - sums[start], sums[:-1] - sums[start]
                if goes_on:
                    own = start == 0
                    scale = _power(base, done)
                    after[own], earlier[own] = carry[k] + scale * after[own], carry[k] + scale * earlier[own]
                columns[f"p{k + 1}"], columns[f"q{k + 1}"] = after.view(np.int64), earlier.view(np.int64)
                carry[k] = after[-1]
            done = int(columns["at"][-1])
            conv = ids[-1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("part", "conv_id", "t1", "t2", "chars")), *(pa.array(columns[c], pa.int64()) for c in ("at", "p1", "p2", "q1", "q2"))],
                ["part", "conv_id", "t1", "t2", "chars", "at", "p1", "p2", "q1", "q2"])

    return run


def _carried(carries: dict[int, tuple[int, int, int, int]]):
    """Adds to the first conversation of a part what earlier parts hold of it: part -> (conv_id, turns, p1, p2)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, conv = (batch.column(c).to_numpy() for c in ("part", "conv_id"))
            columns = {c: batch.column(c).to_numpy().copy() for c in ("at", "p1", "p2", "q1", "q2")}
            for p in np.unique(part).tolist():
                if p in carries:
                    of, turns, *products = carries[p]
                    own = (part == p) & (conv == of)
                    columns["at"][own] += turns
                    for k, base in enumerate(BASES):
                        for c in (f"p{k + 1}", f"q{k + 1}"):
                            x = columns[c].view(np.uint64)
                            x[own] = np.uint64(products[k]) + _power(base, turns) * x[own]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv_id", "t1", "t2", "chars")), *(pa.array(columns[c]) for c in ("at", "p1", "p2", "q1", "q2"))],
                ["conv_id", "t1", "t2", "chars", "at", "p1", "p2", "q1", "q2"])

    return run


def _carries(ends: list) -> dict[int, tuple[int, int, int, int]]:
    """From each part's smallest conv_id, and largest with its turns and products: at most one carry a part."""
    out, carry = {}, None
    for part, low, (high, turns, p1, p2) in sorted(ends):
        products = [p1 % (1 << 64), p2 % (1 << 64)]
        if carry and carry[0] == low:
            out[part] = carry
            if high == low:
                products = [(c + pow(b, carry[1], 1 << 64) * p) % (1 << 64) for c, b, p in zip(carry[2:], BASES, products)]
                turns += carry[1]
        carry = (high, turns, *products)
    return out


def _turns(conversations: DataFrame, seed: int) -> DataFrame | None:
    """(conv_id, t1, t2, chars, at, p1, p2, q1, q2) of every turn; None if two different turns have one name."""
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]).where("conv_id IS NOT NULL")
    named = turns.withColumns({"t1": F.xxhash64(F.lit(seed), "role", "text"), "t2": F.xxhash64(F.lit(seed + 1), "text", "role")})
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    found = keep(
        named.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv_id", "t1", "t2", F.length("text").cast("long").alias("chars"), F.spark_partition_id().alias("part"))
        .mapInArrow(_products(), "part int, conv_id long, t1 long, t2 long, chars long, at long, p1 long, p2 long, q1 long, q2 long"), "turns")
    same = named.groupBy("t1", "t2").agg(F.min(F.struct("role", "text")).alias("a"), F.max(F.struct("role", "text")).alias("b"))
    if same.where("a <> b").limit(1).count():
        return None
    ends = found.groupBy("part").agg(
        F.min("conv_id").alias("low"), F.max(F.struct("conv_id", "at", "p1", "p2")).alias("end")).collect()  # one row a part
    return found.mapInArrow(
        _carried(_carries([(r["part"], r["low"], tuple(r["end"])) for r in ends])),
        "conv_id long, t1 long, t2 long, chars long, at long, p1 long, p2 long, q1 long, q2 long")


def _joined():
    """Own turns after the head -> turns of the rebuilt conversation: depth and products with the base's head in front."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, h, at = (batch.column(c).to_numpy() for c in ("k", "h", "at"))
            columns = []
            for i, inverse in enumerate(INVERSE):
                scale = _powers(inverse, HEADS)[h - k]
                head, own = _unsigned(batch.column(f"head{i + 1}")), _unsigned(batch.column(f"own{i + 1}"))
                for c in (f"p{i + 1}", f"q{i + 1}"):
                    columns.append((head + scale * (_unsigned(batch.column(c)) - own)).view(np.int64))
            p1, q1, p2, q2 = map(pa.array, columns)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(at - h + k), p1, p2, q1, q2, *(batch.column(c) for c in ("t1", "t2", "chars"))],
                ["conv_id", "depth", "p1", "p2", "q1", "q2", "t1", "t2", "chars"])

    return run


def _members(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, p1, p2, q1, q2, t1, t2, chars, ends): every prefix of every rebuilt conversation, and whether it is the whole."""
    row = ["at", "p1", "p2", "q1", "q2", "t1", "t2", "chars"]
    convs = keep(turns.groupBy("conv_id").agg(
        F.max("at").alias("n"),
        F.array_sort(F.collect_list(F.when(F.col("at") < HEADS, F.struct(*row)))).alias("head")  # at most HEADS - 1 turns
    ), "convs")
    base = convs.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("head").alias("base_head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    sized = (
        convs.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(base, "base", "left")
        .withColumn("base_head", F.filter("base_head", lambda x: x["at"] <= F.col("h")))
        .withColumn("k", F.coalesce(F.array_size("base_head"), F.lit(0)))
        .withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    )
    zero = F.lit(0).cast("long")
    product = lambda array, n, c: F.coalesce(F.try_element_at(F.col(array), F.when(n > 0, n))[c], zero)
    sized = keep(sized.select(
        "conv_id", "h", "k", "length", "base_head",
        *[product("base_head", F.col("k"), f"p{i}").alias(f"head{i}") for i in (1, 2)],
        *[product("head", F.col("h"), f"p{i}").alias(f"own{i}") for i in (1, 2)]), "heads")
    columns = ["conv_id", *NODE, "q1", "q2", "t1", "t2", "chars"]
    root = sized.select("conv_id", *[zero.alias(c) for c in columns[1:]])
    heads = sized.select("conv_id", F.explode("base_head").alias("x")).select(
        "conv_id", F.col("x.at").alias("depth"), *[f"x.{c}" for c in columns[2:]])
    own = turns.join(sized.select(F.col("conv_id").alias("c"), "h", "k", "head1", "head2", "own1", "own2"), [F.col("conv_id") == F.col("c"), F.col("at") > F.col("h")]).drop("c")
    rest = own.mapInArrow(_joined(), "conv_id long, depth long, p1 long, p2 long, q1 long, q2 long, t1 long, t2 long, chars long")
    lengths = sized.select(F.col("conv_id").alias("c"), "length")
    return root.union(heads).union(rest.select(*columns)).join(lengths, F.col("conv_id") == F.col("c")).select(
        *columns, (F.col("depth") == F.col("length")).alias("ends"))


def _digests():
    """Rows sorted by node and conv_id -> SHA-256 of each node's ids, one at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            out = []
            *keys, ids = (batch.column(c).to_pylist() for c in (*NODE, "conv_id"))
            for key, conv in zip(zip(*keys), ids):
                if key != node:
                    if node is not None:
                        out.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(f",{conv}".encode())
            yield _batch(out)
        if node is not None:
            yield _batch([(*node, digest.hexdigest())])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], [*NODE, "ends_sha256"])

    return run


def _subtrees(nodes: DataFrame, members: DataFrame, values: list[str]) -> DataFrame:
    """(node, values): sums of ``values`` of ``nodes`` over the subtree of each node, the node included."""
    stretch = F.floor(F.col("depth") / STRETCH).cast("long")
    owned = nodes.select(F.col("conv_id").alias("owner"), *NODE, stretch.alias("stretch"), *values)
    below = Window.partitionBy("owner").orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    later = owned.groupBy("owner", "stretch").agg(*[F.sum(v).alias(v) for v in values]).select(
        "owner", "stretch", *[F.coalesce(F.sum(v).over(below), F.lit(0)).alias(f"later_{v}") for v in values])
    inside = Window.partitionBy("owner", "stretch").orderBy(F.desc("depth"))
    own = owned.select("owner", "stretch", *NODE, *[F.sum(v).over(inside).alias(v) for v in values]).join(later, ["owner", "stretch"]).select(
        *NODE, *[(F.col(v) + F.col(f"later_{v}")).alias(v) for v in values])
    whole = owned.groupBy("owner").agg(F.min("depth").alias("top"), *[F.sum(v).alias(v) for v in values])
    others = members.select("conv_id", *NODE).join(whole, [F.col("conv_id") == F.col("owner"), F.col("depth") < F.col("top")]).select(*NODE, *values)
    return own.union(others).groupBy(*NODE).agg(*[F.sum(v).alias(v) for v in values])


def trie(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one per node.

    Every conv_id c is rebuilt: the first h turns of conversation c - c % 100 (none if it
    is absent), then its own after the first h; h is the unsigned CRC-32 of c in decimal,
    modulo 6. A node is a distinct sequence of first turns (role, text) of rebuilt
    conversations, the root that of none; conv_id is its smallest member. Turns go by
    number, null first, equal numbers by role and text; repeated rows are turns of
    their own. Null roles and texts are empty; rows with a null conv_id are ignored, as are
    other columns. An empty table has no nodes.
    """
    for seed in count(step=2):
        turns = _turns(conversations, seed)
        if turns is None:
            continue
        members = keep(_members(turns), "members")
        same = ["q1", "q2", "t1", "t2"]
        nodes = keep(members.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"),
            *[F.min(c).alias(c) for c in same], F.max(F.struct(*same)).alias("most")), "nodes")
        if not nodes.where(F.struct(*same) != F.col("most")).limit(1).count():
            break
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    valued = keep(nodes.join(children, NODE, "left").select(
        *NODE, "q1", "q2", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")), "valued")
    sums = _subtrees(valued, members, ["leaf", "saved"]).withColumnsRenamed({"leaf": "n_leaves", "saved": "saved_tokens"})
    ends = members.where("ends").select(*NODE, "conv_id")
    digests = ends.repartition(*NODE).sortWithinPartitions(*NODE, "conv_id").mapInArrow(
        _digests(), "depth long, p1 long, p2 long, ends_sha256 string")
    parents = valued.select((F.col("depth") + 1).alias("_depth"), F.col("p1").alias("_q1"), F.col("p2").alias("_q2"), F.col("conv_id").alias("parent_conv_id"))
    return (
        valued.join(sums, NODE).join(digests, NODE, "left")
        .join(parents, [F.col("depth") == F.col("_depth"), F.col("q1") == F.col("_q1"), F.col("q2") == F.col("_q2")], "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
    )
