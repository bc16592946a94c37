"""Building a text index reads its table once."""

from civicspark.operators.text_index import TextIndex


def test_texts_are_taken_apart_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    table = spark.sql("SELECT id, concat('texto ', id) AS text FROM range(40)").mapInArrow(run, "id bigint, text string")
    index = TextIndex.build(table, str(tmp_path / "index"), "id", ["text"], buckets=4)
    assert seen.value == 40
    plain = spark.sql("SELECT id, concat('texto ', id) AS text FROM range(40)")
    assert sorted(r.id for r in index.search(plain, "%o 3_%").collect()) == list(range(30, 40))
