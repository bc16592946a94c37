"""Ranked search, mixing and the prefix trie against plain Python."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicspark.llm import lexical_search, mixing, prefix_trie, queries

from . import brute

SF_DIR = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, item_id string, score double, n int, terms string, source string"
CONV = "conv_id long, turn long, role string, text string, depth int, p1 string, part int, head string"


def zipf_docs(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Äpfel", "naïve", "x1", "漢字"]
    docs = [(i, " ".join(words[min(len(words) - 1, int(rng.paretovariate(0.7)) - 1)] for _ in range(rng.randint(0, 80)))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "w1 " * 5000), (5, docs[7][1]), (None, docs[9][1]), (n + 3, "W1,w2;W3_w4")]
    items = [(i, " ".join(rng.choice(words[:200]) for _ in range(rng.randint(1, 25)))) for i in range(12)]
    return docs, items + [(12, None), (13, "..."), (3, "w250 w3"), (None, "w7 w9"), (14, docs[0][1])]


def found(spark, docs, items, **more):
    docs = spark.createDataFrame([(*d, "x", 0.5, 1, "y", "z") for d in docs], DOC).repartition(5)
    items = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, lexical_search.search(docs, items, **more).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_search_is_that_of_scoring_every_document(spark, seed, monkeypatch):
    docs, items = zipf_docs(seed)
    wanted = sorted(brute.search(docs, items), key=repr)
    assert found(spark, docs, items) == wanted
    monkeypatch.setattr(lexical_search, "PIECE", 7)
    monkeypatch.setattr(lexical_search, "SHORT", 4)
    assert found(spark, docs, items, item_bytes=200) == wanted
    assert found(spark, docs, items, k=3) == [r for r in wanted if r[1] <= 3]


def test_blocks_and_bounds_lose_no_document():
    rng = np.random.default_rng(3)
    n, v = 500, 40
    for _ in range(20):
        rows = [np.flatnonzero(rng.random(v) < rng.random()) for _ in range(n)]
        sizes, ids = np.array([len(r) for r in rows]), np.concatenate(rows)
        items = lexical_search.Items([], rng.integers(0, 900, v), n, int(sizes.sum()) + 1)
        block = lexical_search.Block(items, sizes, sizes, ids, rng.integers(1, 5, len(ids)))
        wanted = rng.choice(v, 12, replace=False)
        sums = np.zeros(n, np.int64)
        for t in wanted.tolist():
            a, b = block.lists.get(t, (0, 0))
            sums[block.doc[a:b]] += block.worth[a:b]
        order = np.argsort(-sums, kind="stable")[:10]
        order = order[sums[order] > 0]
        best, scores = block.ranked(wanted, 10, 0)
        assert best.tolist() == order.tolist() and scores.tolist() == sums[order].tolist()
        least = int(sums[order[4]])
        best, scores = block.ranked(wanted, 10, least)
        assert best.tolist()[:5] == order.tolist()[:5] and (sums[best] == scores).all()


def test_search_of_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == [] and found(spark, [(1, "a")], []) == []


def test_targets_share_what_is_above_the_limit():
    assert mixing.targets([100, 100, 100], (3, 1, 2)) == [200.0, 83 + 1 / 3, 166 + 2 / 3]
    assert mixing.targets([], ()) == [] and mixing.targets([0, 10], (3, 1)) == [0.0, 15.0]
    rng = random.Random(5)
    for _ in range(50):
        sizes = [rng.randint(0, 1000) for _ in range(rng.randint(1, 9))]
        out = mixing.targets(sizes, [(3, 1, 2)[i % 3] for i in range(len(sizes))])
        assert math.isclose(sum(out), 1.5 * sum(sizes), abs_tol=1e-6) and all(t <= 2 * s + 1e-6 for t, s in zip(out, sizes))


def test_knapsack_is_the_best_sum():
    rng = random.Random(6)
    for _ in range(200):
        lengths = np.array(sorted(rng.sample(range(1, 40), rng.randint(1, 6)), reverse=True))
        left = np.array([rng.randint(0, 4) for _ in lengths])
        budget = rng.randint(0, 150)
        sums = {0}
        for x, c in zip(lengths.tolist(), left.tolist()):
            sums = {s + k * x for s in sums for k in range(c + 1)}
        taken = mixing.knapsack(lengths, left, budget)
        assert (taken <= left).all() and int((taken * lengths).sum()) == max(s for s in sums if s <= budget)
        assert int((mixing.fit(lengths, left, float(budget), room=10)[1] <= left).all()) or not left.any()


def mixed(spark, docs, **more):
    frame = spark.createDataFrame([(i, text, source, "x", 7, 1.5) for i, text, source in docs],
                                  "doc_id long, text string, source string, size string, nth int, target double")
    return sorted(map(tuple, mixing.mix(frame.repartition(7), **more).collect()), key=repr)


def test_mix_meets_its_targets(spark):
    rng = random.Random(7)
    docs = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.choice([0, 3, rng.randint(1, 60)]))),
             rng.choice(["a", "a", "a", "B", "é", None, "one"])) for i in range(900)]
    docs += [(900, None, "a"), (901, " x y z", "a"), (902, "w " * 90_000, "B"), (5, "w w", "a"), (5, "w w", "a"), (None, "w", "a"), (904, None, "nil")]
    out = mixed(spark, docs)
    assert out == mixed(spark, docs) and len(out) == len(docs)
    of = {(i, len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))): source for i, text, source in docs}
    totals, taken, goal = Counter(), Counter(), {}
    for i, size, source_size, target, took in out:
        source = of[(i, size)]
        totals[source] += size
        taken[source] += took
        goal[source] = (source_size, target)
        assert took in (0, size, 2 * size)
    order = sorted([s for s in totals if s is not None]) + [None]
    wanted = mixing.targets([totals[s] for s in order], [(3, 1, 2)[k % 3] for k in range(len(order))])
    for source, target in zip(order, wanted):
        assert goal[source] == (totals[source], target)
        if source == "B":  # all but the longest twice: nothing else fits
            assert taken[source] == 2 * totals[source] - 90_000 < target
        else:
            assert abs(taken[source] - target) <= 1
    even = [d for d in docs if d[0] != 902]
    assert mixed(spark, even, seed=1) != mixed(spark, even) and mixed(spark, []) == []


def conversations(seed, n=330):
    rng = random.Random(seed)
    texts, rows = ["", "hi", "hi there", "ja", "grüße 漢", None], []
    for c in rng.sample(range(1000), n):
        rows += [(c, t if rng.random() < 0.9 else None, rng.choice(["u", "a", None]) if rng.random() < 0.2 else "ua"[t % 2], rng.choice(texts[:3] if t < 3 else texts))
                 for t in range(rng.randint(1, 9))]
    rows += [(1001, t, "u", "same") for t in range(700)] + [(1002, t, "u", "same") for t in range(650)] + [(1001, 3, "u", "same")] * 3
    return rows + [(None, 1, "u", "x"), (100, 0, "u", "hi"), (199, None, None, None)]


def nodes(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], CONV).repartition(5)
    return sorted(map(tuple, prefix_trie.trie(frame).collect()), key=repr)




@pytest.mark.parametrize("seed", [1, 2])
def test_trie_is_that_of_the_rebuilt_turns(spark, seed):
    rows = [r for r in conversations(seed) if r[0] is None or r[0] < 1000]
    out = nodes(spark, rows)
    assert len(out) == len(set(out)) and set(out) == brute.trie(rows)


def test_long_and_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "STRETCH", 16)
    rows = [(c, t, "u", "same") for c, n in ((1001, 700), (1002, 650), (1003, 700)) for t in range(n)] + [(1001, 3, "u", "same")] * 3
    out = {r[1]: r for r in nodes(spark, rows)}
    heads = {c: zlib.crc32(str(c).encode()) % 6 for c in (1001, 1002, 1003)}  # their base is absent
    lengths = {1001: 703 - heads[1001], 1002: 650 - heads[1002], 1003: 700 - heads[1003]}
    assert len(out) == max(lengths.values()) + 1
    for d, row in out.items():
        ids = [c for c, n in lengths.items() if n >= d]
        saved = sum(4 * (sum(n >= e for n in lengths.values()) - 1) for e in range(max(d, 1), max(lengths.values()) + 1))
        assert row[0] == min(ids) and row[3] == len(ids) and row[5] == 1 and row[6] == saved


def test_equal_names_of_different_turns_are_found(spark, monkeypatch):
    rows = conversations(3)[:60]
    plain, seeds = nodes(spark, rows), []
    real = F.xxhash64

    def poor(*columns):
        seeds.append(columns[0])
        return real(*columns) % 3 if len(seeds) <= 2 else real(*columns)  # the first pair of names is useless

    monkeypatch.setattr(prefix_trie.F, "xxhash64", poor)
    assert nodes(spark, rows) == plain and len(seeds) == 4


def test_trie_of_nothing(spark):
    assert nodes(spark, []) == [] and nodes(spark, [(None, 1, "u", "x")]) == []
    assert len(nodes(spark, [(7, None, None, None)])) in (1, 2)


@pytest.mark.parametrize("name", ["op11_lexical_search", "op12_source_mix", "op13_prefix_trie"])
def test_registered_queries(spark, name):
    from checks import compare

    ok, note, _ = compare.compare(spark, compare.connect(SF_DIR), name, queries.QUERIES[name], queries.ORACLES.get(name), SF_DIR)
    assert ok, note
