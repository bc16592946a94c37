"""What a Python task holds at a time: Arrow batches by bytes, runs and their combination once."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from civicspark.llm import repeats, suffix_dedup
from civicspark.llm.common import BATCH_BYTES, keep


def _sizes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])


def test_batches_of_long_texts_are_bounded_by_bytes(spark):
    keep(spark.range(1), "any")
    docs = spark.range(0, 1000, 1, 1).select(F.expr("repeat('word ', 4000)").alias("text"))
    found = docs.mapInArrow(_sizes, "n long, size long").agg(F.sum("n"), F.max("size"), F.count("n")).first()
    assert found[0] == 1000 and found[1] <= 2 * BATCH_BYTES and found[2] >= 10


def test_texts_over_a_batch_are_whole(spark):
    text = "".join(chr(97 + i * i % 23) for i in range(3 * BATCH_BYTES))
    docs = spark.createDataFrame([(1, text), (2, "x" + text[:200])], "doc_id long, text string")
    rows = {r["row"]["doc_id"]: r for r in suffix_dedup.deduplicate(docs).collect()}
    assert rows[1]["n_bytes"] == len(text) and rows[2]["n_removed"] == 200


def test_runs_of_a_task_are_combined_in_less_than_three_times_their_size():
    n, rng = repeats.COMBINED, np.random.default_rng(1)
    held = repeats.Held(True)
    rows = {"key": rng.integers(0, n // 2, n), "span": rng.integers(0, n, n), "doc": rng.integers(0, 1000, n),
            "tag": np.zeros(n, np.int32), "start": np.arange(n), "windows": np.ones(n, np.int64)}
    held.rows, held.size = [{k: v.copy() for k, v in rows.items()}], n
    size = sum(v.nbytes for v in rows.values())
    tracemalloc.start()
    try:
        out = list(held.flush())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(b.num_rows for b in out) >= n and peak < 3 * size
