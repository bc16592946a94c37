"""Benchmark decontamination with SimHash windows of the items' sizes (operator 7), JVM-side only.

A document is contaminated by a benchmark item if one of its windows of as many words
as the item has a weighted 5-word-shingle similarity of 0.8 or more with it: the
shared weight over the united weight, a shingle weighing as often as it occurs.

1. Only places that share enough shingles with an item can hold such a window. With
   m and k shingles a similarity of 0.8 takes (m + k) * 4/9 common ones, so windows are
   placed where that many of a document's shingles are an item's; no window is lost,
   and a window knows the items that it was placed for.
2. Windows with equal content are merged. Each gets a 64-bit SimHash of its shingles.
3. Multi-index Hamming search: the fingerprint is cut into radius + 1 blocks; windows are
   candidates of an item of theirs if they agree in a block, so all within the radius are.
   A pair comes from the first block that agrees and leaves the join once.
4. The exact similarity of every candidate decides.

Fewer than five words are one shingle, the whole sequence: such an item matches windows
of as many words with that shingle, whose fingerprint is the shingle's hash itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import keep

SHINGLE, SIMILARITY = 5, 0.8
#: Differing bits of 64 that candidates may have. At similarity 0.8 about 9.7 +- 2.9 bits differ.
RADIUS = 24
#: Shingles of the benchmark up to which they are broadcast (16 bytes each); beyond, the join shuffles.
BROADCAST_SHINGLES = 1_000_000


def _runs(hashes: Column, width: int = SHINGLE) -> Column:
    """Hashes of all runs of ``width`` words, in order; of fewer words none.

    No lambda refers to ``hashes``, so that a filter pushed below the projection, which
    repeats the expression, stays linear.
    """
    n = F.greatest(F.size(hashes) - width + 1, F.lit(0))
    shifted = F.arrays_zip(*[F.slice(hashes, F.lit(k + 1), n).alias(f"w{k}") for k in range(width)])
    return F.transform(shifted, lambda w: F.xxhash64(*[w[f"w{k}"] for k in range(width)]))


def _with_words(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the hashes of the words of the lower-case text in ``out``, instead of the text."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")
    return df.withColumn(out, F.transform(words, lambda w: F.xxhash64(w))).drop(text)


def _with_shingles(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the shingle hashes of the lower-case text in ``out``, instead of the text."""
    return _with_words(df, text, "_hashes").withColumn(out, _runs(F.col("_hashes"))).drop("_hashes")


def fingerprint(grams: Column) -> Column:
    """64-bit SimHash: a bit is set if more than half of the hashes have it."""
    def bit(b: int) -> Column:
        ones = F.aggregate(grams, F.lit(0), lambda n, x: n + F.shiftrightunsigned(x, b).bitwiseAND(F.lit(1)).cast("int"))
        return F.when(ones * 2 > F.size(grams), F.lit(1 << b if b < 63 else -(1 << 63))).otherwise(F.lit(0).cast("bigint"))

    out = bit(0)
    for b in range(1, 64):
        out = out.bitwiseOR(bit(b))
    return out


def _bits(print_: Column, radius: int) -> list[Column]:
    """The bits of each of radius + 1 blocks."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [F.shiftrightunsigned(print_, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:])]


def _blocks(print_: Column, radius: int) -> Column:
    """(block number, bits of the block) of radius + 1 blocks."""
    return F.array(*[F.struct(F.lit(i).alias("block"), x.alias("bits")) for i, x in enumerate(_bits(print_, radius))])


def _first_equal(differing: Column, radius: int) -> Column:
    """Number of the first block in which ``differing`` has no bit; null if every block has one."""
    return F.coalesce(*[F.when(x == 0, F.lit(i)) for i, x in enumerate(_bits(differing, radius))])


def common(a: Column, b: Column) -> Column:
    """Number of common elements of two arrays, repeats included."""
    def times(x: Column, grams: Column) -> Column:
        return F.size(F.filter(grams, lambda y: y == x))

    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    return F.when(plain, F.size(F.array_intersect(a, b))).otherwise(F.aggregate(
        F.array_intersect(a, b), F.lit(0), lambda n, x: n + F.least(times(x, a), times(x, b))))


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("doc"), text.alias("text"))


def _items(benchmark: DataFrame) -> DataFrame:
    """(item_id, item, size, words, grams): every item with a word, ``item`` naming its sequence of words.

    Items of fewer than five words have size 0 and no grams. Equal rows are one item.
    """
    found = _with_words(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")), "text", "words")
    return found.where(F.size("words") > 0).distinct().select(
        "item_id", F.xxhash64("words").alias("item"), F.greatest(F.size("words") - SHINGLE + 1, F.lit(0)).alias("size"),
        "words", _runs(F.col("words")).alias("grams"))


def _bounded(item_grams: DataFrame) -> DataFrame:
    """Broadcast if there are few enough."""
    return F.broadcast(item_grams) if item_grams.count() <= BROADCAST_SHINGLES else item_grams


def _short(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, doc, item, start, n_words): the first place of each item of fewer than five words in each document."""
    lengths = sorted(r[0] for r in items.select(F.size("words")).distinct().collect())
    wanted = _bounded(reduce(DataFrame.unionByName, [
        items.where(F.size("words") == n).select("item", F.lit(n).alias("n_words"), F.explode(_runs(F.col("words"), n)).alias("gram"))
        for n in lengths]).distinct())
    runs = F.array(*[F.struct(F.lit(n).alias("n_words"), _runs(F.col("words"), n).alias("grams")) for n in lengths])
    own = (
        _with_words(docs, "text", "words").select("doc_id", "doc", F.explode(runs).alias("r"))
        .select("doc_id", "doc", "r.n_words", F.posexplode("r.grams").alias("start", "gram"))
    )
    return own.join(wanted, ["n_words", "gram"]).groupBy("doc_id", "doc", "item", "n_words").agg(F.min("start").alias("start"))


def _places(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, doc, item, size, width, start): windows of ``size`` shingles with enough shingles of an item of that size."""
    item_grams = _bounded(items.select("item", "size", F.explode(F.array_distinct("grams")).alias("gram")))
    own = _with_shingles(docs, "text", "grams").select(
        "doc_id", "doc", F.size("grams").alias("n"), F.posexplode_outer("grams").alias("at", "gram"))
    met = own.join(item_grams, "gram").groupBy("doc_id", "doc", "n", "item", "size").agg(
        F.sort_array(F.collect_set("at")).alias("at"))
    width = F.least("n", "size")
    met = met.withColumn("width", width).withColumn(
        "need", F.ceil((F.col("width") + F.col("size")) * F.lit(SIMILARITY / (1 + SIMILARITY)) - F.lit(1e-9)).cast("int"))
    # every stretch of ``need`` matches that fits a window, and all windows around it
    first = F.explode(F.sequence(F.lit(0), F.size("at") - F.col("need")))
    fitting = (
        met.where(F.size("at") >= F.col("need")).select("*", first.alias("k"))
        .withColumn("low", F.get("at", F.col("k"))).withColumn("high", F.get("at", F.col("k") + F.col("need") - 1))
        .withColumn("from", F.greatest(F.lit(0), F.col("high") - F.col("width") + 1))
        .withColumn("to", F.least(F.col("low"), F.col("n") - F.col("width")))
        .where("from <= to")
    )
    return fitting.select(
        "doc_id", "doc", "item", "size", "width", F.explode(F.sequence("from", "to")).alias("start")).distinct()


def leaks(
    docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, doc, item_id, start, n_words, differing_bits, similarity): the best window of each document and item.

    ``doc`` is the XXH64 of the text, ``start`` the window's first word. A document of
    fewer words than an item of five or more is one window. Null or empty texts and
    items match nothing. Items with a null id are searched for like all others, and each
    text of theirs is an item. Rows that repeat id and text are one document, a null
    doc_id is kept as null. Other columns are ignored.
    """
    if similarity < SIMILARITY:
        raise ValueError("windows are placed for similarities of 0.8 or more")
    own, items = _identified(docs, id_col, text_col), keep(_items(benchmark), "items")
    # items of equal words are searched for once
    long = items.where("size > 0").groupBy("item", "size").agg(F.first("grams").alias("grams"))
    places = keep(_places(own, long), "places")
    lists = places.groupBy("doc_id", "doc").agg(F.collect_list(F.struct("item", "size", "width", "start")).alias("windows"))
    same = [F.col("doc_id").eqNullSafe(F.col("_id")), F.col("doc") == F.col("_doc")]
    # the same join at every size: a broadcast of few windows would turn into a shuffle of all texts at some point
    texts = own.join(lists.withColumnsRenamed({"doc_id": "_id", "doc": "_doc"}).hint("merge"), same).select("doc_id", "doc", "text", "windows")
    found = keep(
        _with_shingles(texts, "text", "all").select("doc_id", "doc", "all", F.explode("windows").alias("w"))
        .select("doc_id", "doc", "w.item", "w.size", "w.start", F.slice("all", F.col("w.start") + 1, F.col("w.width")).alias("grams"))
        .select("*", F.xxhash64("grams").alias("content")).distinct(), "windows")
    contents = found.groupBy("item", "content").agg(F.first("grams").alias("grams"))
    windows = keep(contents.withColumn("print", fingerprint(F.col("grams"))), "prints")
    prints = long.select("item", F.col("grams").alias("item_grams"), fingerprint(F.col("grams")).alias("item_print"))
    left = windows.select("item", "content", "print", F.explode(_blocks(F.col("print"), radius)).alias("b")).alias("l")
    right = prints.select("item", "item_print", F.explode(_blocks(F.col("item_print"), radius)).alias("b")).alias("r")
    differing = F.col("print").bitwiseXOR(F.col("item_print"))
    pairs = left.join(
        right, (F.col("l.item") == F.col("r.item")) & (F.col("l.b") == F.col("r.b")) & (F.bit_count(differing) <= radius)
        & (_first_equal(differing, radius) == F.col("l.b.block"))
    ).select("l.item", "content", F.bit_count(differing).alias("differing_bits"))
    verified = (
        pairs.join(windows.select("item", "content", "grams"), ["item", "content"])
        .join(prints.select("item", "item_grams"), "item")
        .withColumn("shared", common(F.col("grams"), F.col("item_grams")))
        .withColumn("similarity", F.col("shared") / (F.size("grams") + F.size("item_grams") - F.col("shared")))
        .where(F.col("similarity") >= similarity)
        .select("item", "content", "differing_bits", "similarity")
    )
    best = F.max(F.struct("similarity", -F.col("start"), -F.col("differing_bits"), F.col("size") + SHINGLE - 1))
    leaking = (
        found.drop("grams").join(verified, ["item", "content"]).groupBy("doc_id", "doc", "item").agg(best.alias("best"))
        .select("doc_id", "doc", "item", (-F.col("best")["col2"]).alias("start"), F.col("best")["col4"].alias("n_words"),
                (-F.col("best")["col3"]).alias("differing_bits"), F.col("best")["similarity"].alias("similarity"))
    )
    short = items.where("size = 0")
    if not short.isEmpty():
        leaking = leaking.unionByName(_short(own, short).select(
            "*", F.lit(0).alias("differing_bits"), F.lit(1.0).alias("similarity")))
    # an id that several texts share is one item, its best window counts; each text without an id is one
    nameless = F.when(F.col("item_id").isNull(), F.col("item"))
    of_ids = F.max(F.struct("similarity", -F.col("start"), -F.col("differing_bits"), "n_words"))
    return (
        leaking.join(items.select("item_id", "item"), "item")
        .groupBy("doc_id", "doc", "item_id", nameless.alias("_nameless")).agg(of_ids.alias("best"))
        .select("doc_id", "doc", "item_id", (-F.col("best")["col2"]).alias("start"), F.col("best")["n_words"].alias("n_words"),
                (-F.col("best")["col3"]).alias("differing_bits"), F.col("best")["similarity"].alias("similarity"))
    )


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without a leak, all columns as they are (whatever their names)."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    found = leaks(docs, benchmark, **options).select(F.col("doc_id").alias("_leak_id"), F.col("doc").alias("_leak")).distinct()
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("_id"),
        F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("_doc"))
    same = [F.col("_id").eqNullSafe(F.col("_leak_id")), F.col("_doc") == F.col("_leak")]
    return packed.join(found, same, "left_anti").select("row.*")
