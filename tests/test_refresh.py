"""Loads that appear as a whole, views refreshed by range, distinct counts that merge."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from civicspark.functions import bitmaps
from civicspark.operators import load, upsert as ups
from civicspark.plans import rollup, views
from civicspark.sources.store import ConcurrentLoad, StarStore, atomic
from civicspark.streaming import landing, refresh

from .conftest import rows


def now():
    return F.lit("2026-06-14 12:00:00").cast("timestamp")


def themes(spark, *ids):
    return spark.createDataFrame([(i, f"t{i}", i % 2 == 0) for i in ids], "tema_id INT, nome STRING, critico BOOLEAN")


def ids(store):
    return sorted(r["tema_id"] for r in rows(store.read("dim_temas")))


def test_a_reader_sees_all_tables_of_a_load_or_none(spark, tmp_path):
    store, reader = (StarStore(spark, str(tmp_path / "star")) for _ in range(2))
    party = spark.sql("SELECT 1 AS partido_id, 'PX' AS sigla, 'X' AS nome")
    with store.begin() as one:
        one.write("dim_temas", themes(spark, 1, 2))
        with one.begin() as inner:  # part of the load around it
            inner.write("dim_partidos", party)
        assert ids(one) == [1, 2] and ids(reader) == []
    assert ids(reader) == [1, 2] and reader.read("dim_partidos").count() == 1 and reader.manifest().number == 1
    with pytest.raises(ZeroDivisionError), store.begin() as two:
        two.write("dim_temas", themes(spark, 3))
        raise ZeroDivisionError
    assert ids(reader) == [1, 2] and reader.manifest().number == 1


def test_of_two_loads_one_fails_cleanly_and_runs_again(spark, tmp_path):
    store, other = (StarStore(spark, str(tmp_path / "star")) for _ in range(2))
    store.write("dim_temas", themes(spark, 1))
    tries = []

    def add(one, new):
        have = one.read("dim_temas")
        tries.append(new)
        if len(tries) == 1:  # a second load starts and ends in the meantime
            atomic(other, lambda two: add(two, 3))
        one.write("dim_temas", have.unionByName(themes(spark, new), allowMissingColumns=True))

    atomic(store, lambda one: add(one, 2))
    assert tries == [2, 3, 2] and ids(store) == [1, 2, 3] and store.versions("dim_temas") == [3]
    # a table that has been read before is not overwritten either
    have = store.read("dim_temas")
    other.write("dim_temas", themes(spark, 9))
    with pytest.raises(ConcurrentLoad):
        store.write("dim_temas", have)
    assert ids(store) == [9]


def test_loads_of_several_threads_lose_nothing(spark, tmp_path):
    root, failed = str(tmp_path / "star"), []

    def run(n):
        try:
            atomic(StarStore(spark, root), lambda one: one.write(
                "dim_temas", one.read("dim_temas").unionByName(themes(spark, n), allowMissingColumns=True)), attempts=20)
        except Exception as exc:
            failed.append(exc)

    threads = [threading.Thread(target=run, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and ids(StarStore(spark, root)) == [0, 1, 2, 3]


def test_reading_names_no_old_folder(spark, tmp_path):
    store = StarStore(spark, str(tmp_path / "star"), range_width=10)
    props = lambda found, text: spark.createDataFrame([(i, "PL", text) for i in found], "proposicao_id INT, tipo STRING, ementa STRING")
    load.apply_batch(store, "fato_proposicoes", props(range(40), "a"), now())
    load.apply_batch(store, "fato_proposicoes", props([15], "b"), now())
    folders = [f for found in store.manifest().tables["fato_proposicoes"].values() for f in found]
    assert len(folders) == 4 and sum("/v=00000002" in f for f in folders) == 1
    for note in ("1", "", "?"):  # a note that lags behind or is broken
        store._put("_loads/_newest", note, True)
        assert store.manifest().number == 2
    assert all("v=00000002" in f or "faixa=1/" not in f for f in store.read("fato_proposicoes").inputFiles())


def filled(spark, root):
    rng = random.Random(4)
    store = StarStore(spark, root, range_width=100)
    store.write("dim_temas", themes(spark, *range(1, 6)))
    store.write("dim_partidos", spark.createDataFrame([(i, f"P{i}", "x") for i in range(1, 5)], "partido_id INT, sigla STRING, nome STRING"))
    store.write("dim_deputados", spark.createDataFrame(
        [(i, f"d{i}", i % 5 or None, "SP", "x") for i in range(1, 40)], "deputado_id INT, nome STRING, partido_id INT, uf STRING, situacao STRING"))
    load.apply_batch(store, "fato_proposicoes", spark.createDataFrame(
        [(i, "PL", "e", i % 6 or None, f"2026-{1 + i % 12:02}-03") for i in range(500)],
        "proposicao_id INT, tipo STRING, ementa STRING, tema_id INT, data_apresentacao STRING").withColumn("data_apresentacao", F.to_date("data_apresentacao")), now())
    load.apply_batch(store, "ponte_proposicao_autores", spark.createDataFrame(
        [(i, "deputado", f"a{k}", f"u{k}", k) for i in range(500) for k in rng.sample(range(1, 45), 2)],
        "proposicao_id INT, autor_tipo STRING, nome_autor STRING, uri_autor STRING, deputado_id INT"), now())
    return store


def same(maintained, direct):
    return sorted(map(repr, rows(maintained.select(*direct.columns)))) == sorted(map(repr, rows(direct)))


def check(store):
    t = store.tables()
    assert same(refresh.heatmap_tema_partido(store), views.heatmap_tema_partido(t))
    assert same(refresh.data_quality(store), views.data_quality(t))
    assert same(refresh.kpis(store).withColumn("despesas_total", F.col("despesas_total").cast("double")),
                views.kpis(t).withColumn("despesas_total", F.col("despesas_total").cast("double")))


def test_views_follow_streamed_loads(spark, raw, tmp_path):
    store = filled(spark, str(tmp_path / "star"))
    first = refresh.refresh(store)
    assert first["_vw_proposicoes"] == [0, 1, 2, 3, 4] == first["_vw_autoria"]
    check(store)
    seen = []
    for day, found in enumerate(([10, 11, 620], [310, 311], [12, 630]), 1):
        raw.put("proposicoes", f"2026-01-0{day}T00-00-00Z", [{"id": i, "siglaTipo": "PEC", "ementa": f"n{day}"} for i in found])

    def after(s):
        seen.append(refresh.refresh(s)["_vw_proposicoes"])
        check(s)

    landing.load_increment(store, raw.path, str(tmp_path / "check"), now(), max_files=1, after=after)
    assert seen == [[0, 6], [3], [0, 6]]  # only changed key ranges are read
    # rows move between themes, with the view in the same load
    moved = spark.createDataFrame([(i, 5) for i in range(200, 290)] + [(300, None)], "proposicao_id INT, tema_id INT")

    def move(one):
        stored = one.read("fato_proposicoes", one.touched("fato_proposicoes", moved))
        one.write("fato_proposicoes", ups.set_values(stored, moved, ["tema_id"]))
        return refresh.refresh(one)

    assert atomic(store, move)["_vw_autoria"] == [2, 3]
    check(store)
    number = store.manifest().number
    assert not any(refresh.refresh(store).values()) and store.manifest().number == number  # nothing to do
    atomic(store, move)  # a replay: the same ranges, the same view
    check(store)
    # a changed dimension concerns every range
    store.write("dim_deputados", store.read("dim_deputados").withColumn("partido_id", F.lit(1)))
    assert refresh.refresh(store)["_vw_autoria"] == [0, 1, 2, 3, 4, 6]
    check(store)


def test_views_of_an_empty_store(spark, tmp_path):
    store = StarStore(spark, str(tmp_path / "star"))
    assert not any(refresh.refresh(store).values())
    check(store)


def test_periods_from_monthly_bitmaps(spark, tmp_path):
    t = filled(spark, str(tmp_path / "star")).tables()
    months = rollup.monthly_authorship(t)
    for first, last in (("2026-01-01", "2026-12-31"), ("2026-02-01", "2026-04-30")):
        within = t["fato_proposicoes"].where(F.col("data_apresentacao").between(first, last))
        direct = views.heatmap_tema_partido({**t, "fato_proposicoes": within}).select(*rollup.KEYS, *rollup.COUNTED)
        assert same(rollup.authorship_of(months, first, last), direct)
    ids_ = spark.sql("SELECT id % 3 AS k, CASE WHEN id % 7 > 0 THEN id * 1000 END AS x FROM range(100)")
    parts = bitmaps.bitmaps(ids_, ["k"], "x")
    direct = ids_.groupBy("k").agg(F.count_distinct("x").alias("n"))
    assert same(bitmaps.distinct_count(parts.union(parts), ["k"], "n"), direct)


def test_a_refresh_lists_a_folder_once_however_many_ranges(spark, tmp_path, monkeypatch):
    store = StarStore(spark, str(tmp_path / "star"), range_width=10)
    store.write("fato_proposicoes", spark.range(200).selectExpr("CAST(id AS INT) AS proposicao_id", "'PL' AS tipo", "'e' AS ementa"))
    asked, path = [], StarStore._path
    monkeypatch.setattr(StarStore, "_path", lambda self, name: asked.append(name) or path(self, name))
    assert refresh.PROPOSITIONS.refresh(store) == list(range(20))
    assert len([name for name in asked if name.endswith("=*")]) == 1
    assert refresh.PROPOSITIONS.read(store).agg(F.sum("proposicoes")).first()[0] == 200


def test_partial_rows_of_a_range_lie_in_one_file(spark, tmp_path):
    store = StarStore(spark, str(tmp_path / "star"), range_width=10)
    store.write("fato_proposicoes", spark.range(100).selectExpr(
        "CAST(id AS INT) AS proposicao_id", "'PL' AS tipo", "'e' AS ementa", "CAST(id % 7 AS INT) AS tema_id"))
    store.write("ponte_proposicao_autores", spark.range(100).selectExpr(
        "id AS proposicao_id", "'Deputado' AS autor_tipo", "concat('n', id) AS nome_autor", "CAST(id % 5 AS INT) AS partido_id"))
    store.write("dim_partidos", spark.range(5).selectExpr("CAST(id AS INT) AS partido_id", "concat('P', id) AS sigla", "'x' AS nome"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        refresh.AUTHORSHIP.refresh(store)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "star" / "_views" / "_vw_autoria").rglob("part-*.parquet"))) == 10
    assert refresh.AUTHORSHIP.read(store).agg(F.sum("qtd_proposicoes")).first()[0] == 100


def test_an_update_does_not_pass_through_the_driver(spark, tmp_path):
    store = StarStore(spark, str(tmp_path / "star"))
    store.write("fato_proposicoes", spark.range(50).selectExpr("CAST(id AS INT) AS proposicao_id", "'PL' AS tipo", "'e' AS ementa"))
    moved = store.read("fato_proposicoes").where("proposicao_id % 5 = 1").select("proposicao_id", F.lit(3).alias("tema_id"))
    done = ups.set_values(store.read("fato_proposicoes"), moved, ["tema_id"])
    assert "Broadcast" not in done._jdf.queryExecution().executedPlan().toString()
    assert done.where("tema_id = 3").count() == 10 and done.count() == 50


def test_partial_rows_are_made_without_a_broadcast_of_a_fact(spark, tmp_path):
    """Propositions are joined with their authors whatever size Spark guesses; dimensions may be broadcast."""
    store = StarStore(spark, str(tmp_path / "star"), range_width=10)
    store.write("fato_proposicoes", spark.range(50).selectExpr(
        "CAST(id AS INT) AS proposicao_id", "'PL' AS tipo", "'e' AS ementa", "CAST(id % 7 AS INT) AS tema_id"))
    store.write("ponte_proposicao_autores", spark.range(100).selectExpr(
        "id % 60 AS proposicao_id", "'Deputado' AS autor_tipo", "concat('n', id) AS nome_autor", "CAST(id % 5 AS INT) AS partido_id"))
    store.write("dim_partidos", spark.range(5).selectExpr("CAST(id AS INT) AS partido_id", "concat('P', id) AS sigla", "'x' AS nome"))
    t = {name: store.read(name) for name in ("ponte_proposicao_autores", "dim_partidos", "dim_deputados")}
    t["fato_proposicoes"] = store.read("fato_proposicoes").withColumn("faixa", F.lit(0))
    made = refresh.AUTHORSHIP.rows(t)
    plan = made._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "proposicao_id" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)
    assert made.agg(F.sum("qtd_proposicoes")).first()[0] > 0
