"""Text-cutting, packing and sharding operators against plain Python."""

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from civicspark.llm import common, packing, queries, repeats, runs, sharding, substring_dedup, suffix_dedup

from . import brute

SF_DIR = "/root/testdata/sf0.001"
DOC = "doc_id long, text string"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def repetitive(seed, n=40):
    """Texts made of shared passages, shared lines and noise, some of one letter only."""
    rng = random.Random(seed)
    passages = [" ".join("".join(rng.choice("abcdéß") for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(5, 60)))
                for _ in range(8)]
    out = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.6 else "".join(rng.choice("xyz ") for _ in range(rng.randint(1, 150)))
                 for _ in range(rng.randint(0, 6))]
        out.append((i, rng.choice([" ", "\n", "  "]).join(parts)))
    return out + [(n, "a" * 700), (n + 1, "a" * 120 + "b"), (n + 2, None), (n + 3, ""), (n + 4, out[0][1])]


def cut_bytes(spark, docs):
    frame = spark.createDataFrame(docs, DOC).repartition(7)
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.sha) for r in suffix_dedup.deduplicate(frame).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha")).collect()}


def cut_words(spark, docs):
    frame = spark.createDataFrame(docs, DOC).repartition(7)
    return {r.doc_id: (r.n_words, r.n_removed, r.sha) for r in substring_dedup.deduplicate(frame).select(
        "row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("sha")).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_are_cut_as_by_brute_force(spark, seed):
    docs = repetitive(seed)
    assert cut_bytes(spark, docs) == brute.cut_bytes(docs)
    assert cut_words(spark, docs) == brute.cut_words(docs)


def test_small_pieces_and_combinations_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 150)
    monkeypatch.setattr(repeats, "COMBINED", 5)
    docs = repetitive(3)
    assert cut_bytes(spark, docs) == brute.cut_bytes(docs)
    assert cut_words(spark, docs) == brute.cut_words(docs)


def test_cut_queries(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in queries.QUERIES["op4_suffix_array_dedup"](spark, SF_DIR).collect()}
    assert got == brute.cut_bytes(docs) and sum(g[1] for g in got.values())
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in queries.QUERIES["op6_substring_dedup"](spark, SF_DIR).collect()}
    assert got == brute.cut_words(docs) and sum(g[1] for g in got.values())


def test_cut_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60))
    frame = spark.createDataFrame(
        [(4, long, "p", 1), (4, long, "q", 2), (4, long + " tail", "r", 3), (None, long[:150], "s", 4), (9, long, "t", 5)],
        DOC + ", starts string, kind int")
    first = {r.row.starts: r for r in suffix_dedup.deduplicate(frame).collect()}
    assert first["s"].n_removed == 0 and first["t"].n_removed == len(long)
    assert first["p"].n_removed == first["q"].n_removed == first["r"].n_removed == 150
    words = {r.row.starts: r for r in substring_dedup.deduplicate(frame).collect()}
    assert words["s"].n_removed == 0 and words["t"].n_removed == 60 and words["p"].n_removed == words["r"].n_removed
    assert suffix_dedup.deduplicate(frame.where("false")).count() == substring_dedup.deduplicate(frame.where("false")).count() == 0


def test_equal_windows_share_a_minimizer():
    rng = np.random.default_rng(0)
    text = rng.integers(0, 3, 500).astype(np.uint64)
    symbols = np.concatenate([text[:300], text[100:400], text])
    lengths = np.array([300, 300, 500])
    found = runs.runs(runs.mix(symbols + np.uint64(1)), lengths, 20, 6)
    seen, starts = {}, np.cumsum(lengths) - lengths
    for d, s, n, m in zip(found["doc"], found["start"], found["windows"], found["minimizer"]):
        for k in range(n):
            at = starts[d] + s + k
            assert seen.setdefault(tuple(symbols[at:at + 20]), m) == m
    assert sum(found["windows"]) == sum(n - 19 for n in lengths)


def bins(counts, capacity):
    """Free places that best-fit decreasing leaves, one piece at a time."""
    left = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            room = min((r for r in left if r >= length), default=None)
            if room is not None:
                left.remove(room)
            left.append((capacity if room is None else room) - length)
    return sorted(left)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(0)
    for _ in range(100):
        capacity = rng.choice([5, 16, 30])
        counts = {n: rng.randint(1, 12) for n in rng.sample(range(1, capacity + 1), rng.randint(1, capacity))}
        used = {}
        for length, _, n, window, offset in packing.plan(counts, capacity).tolist():
            for k in range(n):
                used.setdefault(window + k, []).append((offset, length))
        for places in used.values():
            assert all(a[0] + a[1] == b[0] for a, b in zip([(0, 0), *sorted(places)], sorted(places)))
        assert sorted(capacity - sum(n for _, n in v) for v in used.values()) == bins(counts, capacity)
        assert sorted(used) == list(range(len(used)))


def test_token_ids_are_the_tokenizer_files():
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    with open(RANKS, "rb") as ranks, open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as whole:
        token_ids = packing.Ids(ranks.read(), whole.read())
    texts = ["", " ", "a", "It's  we'll\n\n\tgo 123½ ²³ ٣٤", "naïve café    x", "日本語 ​👩‍👩‍👧 é", "a<|endoftext|>b", "\x00\x1c\x85 z", "x" * 3000]
    texts += ["".join(random.Random(i).choices("aé \n\t'sß1٣.,!  日<|>", k=200)) for i in range(200)]
    texts += [" " * 2_000_000, "\n" * 2_000_000, "a" + " \n" * 600_000 + "b"]
    for text in texts:
        assert token_ids(text).tolist() == [*reference.encode(text, add_special_tokens=False).ids, 0]


def test_packing_round_trip(spark):
    docs = [(1, None), (2, ""), (3, "word " * 4000), (5, " " * 2_000_000), (6, "\n" * 2_000_000), (4, "a b"), (4, "a b"), (None, "z")] + [(10 + i, "some text " * i) for i in range(300)]
    frame = spark.createDataFrame(docs, DOC).withColumn("offset", F.lit(7)).repartition(5)
    packed = common.keep(packing.pack(packing.pieces(frame, RANKS)), "packed")
    rows = packed.collect()
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc_id, text in docs:
        want = np.array([*reference.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        parts = sorted(by_doc[doc_id], key=lambda r: r.start)
        times = 2 if doc_id == 4 else 1
        assert b"".join(p.ids for p in parts) == want * times and {p.doc_tokens for p in parts} == {len(want) // 4}
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        assert [p.offset for p in parts] == np.cumsum([0, *[p.length for p in parts]])[:-1].tolist()
        assert sum(p.length for p in parts) <= 1024
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= total / 1024 * 1.02 + 1
    laid = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert laid == {k: b"".join(p.ids for p in v) for k, v in by_sequence.items()}
    assert packing.pack(packing.pieces(frame.where("false"), RANKS)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(packed.select((F.col("length") + 2000).alias("length")))


def descent(tree, key):
    """Shard of a key by a plain descent: at each level the child of the smallest draw, subtrees without weight left out."""
    def draw(level, node, weight):
        seed = 42  # Spark's hash of several columns: each one's hash seeds the next, nulls are passed over
        for part in ([] if key is None else [str(key).encode()]) + [level.encode(), node.to_bytes(4, "little")]:
            seed = xxhash.xxh64_intdigest(part, seed)
        return -math.log(((seed >> 11) + 0.5) / 2 ** 53) / weight

    def choose(level, nodes):
        return min((draw(level, node, weight), node) for node, weight in nodes if weight > 0)[1]

    racks = [(r, rack) for r, region in enumerate(tree) for rack in region]
    shards = [(k, weight) for k, (_, rack) in enumerate(racks) for weight in rack]
    region = choose("region", [(r, sum(map(sum, t))) for r, t in enumerate(tree)])
    rack = choose("rack", [(k, sum(rack)) for k, (r, rack) in enumerate(racks) if r == region])
    return choose("shard", [(s, weight) for s, (k, weight) in enumerate(shards) if k == rack])


def test_shards_against_a_plain_descent(spark):
    keys = [*range(600), -5, 2 ** 40, None]
    ids = spark.createDataFrame([(k,) for k in keys], "doc_id long")
    for tree in (sharding.uniform_tree(24), sharding.grow(sharding.uniform_tree(24)), (((1.0, 3.0), (2.0,)), ((0.0, 4.0),), ((0.5,) * 5, (7.0, 0.0)))):
        assert {r.doc_id: r.shard for r in sharding.assign(ids, tree).collect()} == {k: descent(tree, k) for k in keys}


def test_shards_move_only_into_the_new_one(spark):
    ids = spark.range(30000).select(F.col("id").alias("doc_id"), F.lit(1).alias("shard"))
    for tree in (sharding.uniform_tree(24), sharding.uniform_tree(5), (((1.0, 3.0), (2.0,)), ((0.0, 4.0),))):
        weights = [w for region in tree for rack in region for w in rack]
        found = sharding.assign(sharding.assign(ids, tree), sharding.grow(tree, 2.0), out="grown")
        counts = {r[0]: r[1] for r in found.groupBy("shard").count().collect()}
        for i, w in enumerate(weights):
            assert abs(counts.get(i, 0) / 30000 - w / sum(weights)) < 0.02
        assert {r[0] for r in found.where("shard <> grown").select("grown").distinct().collect()} == {len(weights)}


def test_weight_change_moves_only_between_changed_subtrees(spark):
    ids = spark.range(20000).select(F.col("id").alias("doc_id"))
    before = (((1.0, 1.0), (1.0, 1.0)), ((1.0, 1.0), (1.0, 1.0)))
    after = (((1.0, 1.0), (1.0, 3.0)), ((1.0, 1.0), (1.0, 1.0)))
    moved = sharding.assign(sharding.assign(ids, before), after, out="after").where("shard <> after")
    # inside the unchanged region and inside the unchanged rack nothing moves between shards
    assert moved.where("shard >= 4 AND after >= 4").count() == 0
    assert moved.where("shard < 2 AND after < 2").count() == 0 and moved.count() > 0


def test_shard_query(spark):
    rows = queries.QUERIES["op1_hash_tree"](spark, SF_DIR).collect()
    texts = dict(tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots = {}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "key")
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_gapless_numbers_repeated_rows(spark):
    rows = spark.createDataFrame([("a", 1)] * 500 + [("a", None), (None, 3), (None, 3), ("b", 1)], "k string, v int").repartition(4)
    found = common.gapless(common.keep(rows, "rows"), ["k"], "n").collect()
    assert sorted(r.n for r in found if r.k == "a") == list(range(501))
    assert sorted(r.n for r in found if r.k is None) == [0, 1] and [r.n for r in found if r.k == "b"] == [0]
