"""Sharding by a hierarchical weighted hash tree (operator 1), JVM-side only.

A tree is a tuple of regions, a region a tuple of racks, a rack a tuple of shard
weights; a weight of a rack or region is the sum below it. A key descends the
tree: at each level every child draws ``-ln(u) / weight`` with ``u`` a uniform
hash of (key, level, child), and the smallest draw wins. A child's draw depends
on itself alone, so a key moves only towards a subtree whose weight grew or away
from one whose weight shrank. ``grow`` hangs a new shard into a region of its
own: that region is the only subtree whose weight changes, so the new shard
takes keys and no other shard does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

Rack = tuple[float, ...]
Tree = tuple[tuple[Rack, ...], ...]


def uniform_tree(shards: int, base: int = 24, racks: int = 2, per_rack: int = 4) -> Tree:
    """Tree of equal shards: up to ``base`` in full regions, every further one grown on its own."""
    if shards < 1:
        raise ValueError("a tree needs a shard")
    laid = min(shards, base)
    lines = [(1.0,) * min(per_rack, laid - i) for i in range(0, laid, per_rack)]
    tree: Tree = tuple(tuple(lines[i:i + racks]) for i in range(0, len(lines), racks))
    for _ in range(shards - laid):
        tree = grow(tree)
    return tree


def grow(tree: Tree, weight: float = 1.0) -> Tree:
    """One more shard, numbered last, in a rack and region of its own."""
    return (*tree, ((weight,),))


def _draw(key: Column, level: str, node: Column, weight: Column) -> Column:
    """Exponential draw with the rate ``weight``."""
    high = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), node), 11)
    return -F.log((high + F.lit(0.5)) / F.lit(float(2 ** 53))) / weight


def _descend(key: Column, level: str, children: list[tuple[Column, Column]]) -> Column:
    """Node of the smallest draw among (node, weight); null if no child has weight."""
    drawn = [F.when(w > 0, F.struct(_draw(key, level, n, w).alias("draw"), n.alias("node"))) for n, w in children]
    return F.array_min(F.array(*drawn))["node"]


def _numbers(values: list, kind: str) -> Column:
    return F.array(*[F.lit(v).cast(kind) for v in values])


def assign(docs: DataFrame, tree: Tree, key: str = "doc_id", out: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row in ``out`` (replaced if present): a projection without a shuffle.

    Shards are numbered from 0 in the order of the tree. Repeated keys, equal texts
    or not, share a shard (law ``key``). A null key is a key of its own; a tree
    without weight gives null; an empty table stays empty.
    """
    racks = [rack for region in tree for rack in region]
    region_starts = [sum(map(len, tree[:i])) for i in range(len(tree))]
    rack_starts = [sum(map(len, racks[:i])) for i in range(len(racks))]
    rack_weights = _numbers([float(sum(r)) for r in racks], "double")
    weights = _numbers([float(w) for r in racks for w in r], "double")
    named = F.col(key).cast("string")

    def level(name: str, first: Column, n: Column, most: int, weight_of: Column) -> Column:
        return _descend(named, name, [
            (first + j, F.when(F.lit(j) < n, F.get(weight_of, first + j))) for j in range(most)])

    # One column a level: each choice is computed once and read by the next.
    region, rack = f"_region_of_{out}", f"_rack_of_{out}"
    sizes, starts = _numbers([len(r) for r in tree], "int"), _numbers(region_starts, "int")
    shards, shard_starts = _numbers([len(r) for r in racks], "int"), _numbers(rack_starts, "int")
    return (
        docs.withColumn(region, level("region", F.lit(0), F.lit(len(tree)), len(tree),
                                      _numbers([float(sum(map(sum, r))) for r in tree], "double")))
        .withColumn(rack, level("rack", F.get(starts, region), F.get(sizes, region), max(map(len, tree)), rack_weights))
        .withColumn(out, level("shard", F.get(shard_starts, rack), F.get(shards, rack), max(map(len, racks)), weights))
        .drop(region, rack)
    )
