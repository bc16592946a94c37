"""Nearest vectors by cell against all pairs."""

import re

import numpy as np
from pyspark.sql import functions as F

from civicspark.operators import vector_index
from civicspark.operators.vector_index import VectorIndex


def clustered(n, dim, centres=200, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    return middle[rng.integers(centres, size=n)] + 0.5 * rng.normal(size=(n, dim))


def frame(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, v.tolist()) for i, v in enumerate(vectors)], "id long, v array<double>")


def nearest(stored, asked, k):
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    score = np.round(unit(asked) @ unit(stored).T, 12)
    return {q: np.argsort(-row, kind="stable")[:k].tolist() for q, row in enumerate(score)}


def lists(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["query"], r["rank"])):
        out.setdefault(r["query"], []).append(r["key"])
    return out


def test_recall_of_ten_thousand_vectors_and_pruned_reading(spark, tmp_path):
    stored, asked = clustered(10_000, 32), clustered(150, 32, seed=2)
    asked[:100] = stored[:100] + 0.1
    index = VectorIndex.build(frame(spark, stored), "id", "v", str(tmp_path / "index"), cell_rows=100)
    assert len(index.centroids) == 100 and index.rows.sum() == 10_000
    want = nearest(stored, asked, 10)
    found = index.search(frame(spark, asked), "id", "v", k=10)
    got = lists(found)
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.95 * 1500
    assert lists(index.search(frame(spark, asked), "id", "v", k=10, probes=3, complete=True)) == want
    one = index.search(frame(spark, asked[:1]), "id", "v", k=10, probes=2)
    plan = spark._jvm.PythonSQLUtils.explainString(one._jdf.queryExecution(), "formatted")
    assert len(lists(one)[0]) == 10
    filters = re.findall(r"PartitionFilters: (.*)", plan)
    assert filters and all(re.search(r"cell#\d+ IN \(\d+, ?\d+\)", f) for f in filters), filters  # two of a hundred cells are read


def test_blocks_of_hot_cells_and_many_queries(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vector_index, "SIDE", 16)
    monkeypatch.setattr(vector_index, "QUERY_SIDE", 8)
    stored = np.concatenate([clustered(300, 8, centres=3), np.ones((40, 8)), 2 * np.ones((10, 8))])
    index = VectorIndex.build(frame(spark, stored), "id", "v", str(tmp_path / "index"), cell_rows=150)
    assert lists(index.search(frame(spark, stored), "id", "v", k=7, probes=1, complete=True)) == nearest(stored, stored, 7)


def test_unusable_vectors_and_empty_tables(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [1.0]), (6, [0.0, 1.0]), (7, [None, 1.0]), (8, [])], "id long, v array<float>")
    index = VectorIndex.build(rows, "id", "v", str(tmp_path / "a"))
    found = index.search(rows, "id", "v", k=5, complete=True)
    assert lists(found) == {1: [1, 6], 6: [6, 1]}
    assert VectorIndex(spark, str(tmp_path / "a")).rows.tolist() == [2]  # read again by path
    empty = VectorIndex.build(rows.where("false"), "id", "v", str(tmp_path / "b"), dim=2)
    assert empty.search(rows, "id", "v").count() == 0 and index.search(rows.where("false"), "id", "v", complete=True).count() == 0
    assert vector_index.recall(found, found.where(F.col("rank") == 1)).first().asDict() == {"pares": 2, "achados": 2, "desiguais": 0}


def test_a_query_is_sent_to_a_block_once(spark, tmp_path):
    """Twenty cells are one block: a query that visits all of them leaves one row, not twenty."""
    stored = clustered(400, 8)
    index = VectorIndex.build(frame(spark, stored), "id", "v", str(tmp_path / "index"), cell_rows=20)
    asked = frame(spark, stored[:30]).toDF("query", "qvector")
    sent = asked.mapInArrow(index._cells(20, False), "query long, qvector array<double>, block int, cells array<int>").collect()
    assert len(sent) == 30 and all(r.cells == [c for c in range(20) if index.rows[c]] for r in sent)
