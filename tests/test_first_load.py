"""A core load reads each listing once, and what is loaded into empty ranges is not joined."""

import pytest
from pyspark.sql import functions as F

from civicspark import schemas
from civicspark.operators import load, upsert as U
from civicspark.sources import envelopes as env
from civicspark.sources.store import StarStore


def listings(raw, broken=()):
    raw.put("partidos", "2026-01-01", [{"id": "1", "sigla": "A", "nome": "a"}])
    raw.put("deputados", "2026-01-01", [{"id": "1", "nome": "d", "siglaPartido": "A", "siglaUf": "SP"}])
    raw.put("proposicoes", "2026-01-01", [{"id": "1", "siglaTipo": "PL", "ementa": "x"}, {"id": "1", "ementa": "y"}, {"id": "2", "ementa": "z"}])
    raw.put("votacoes", "2026-01-01", [{"id": "v1", "data": "2026-01-01T10:00:00"}, {"id": None, "data": "2026-01-01T10:00:00"}])
    for entity in broken:
        raw.put(entity, "2026-01-02", None, text='{"_meta": {"endpoint": "/x"}, "dados": [{"id": ')


@pytest.mark.parametrize("broken", [(), ("proposicoes",), ("partidos", "votacoes")])
def test_listings_are_read_again_only_for_broken_documents(spark, raw, tmp_path, monkeypatch, broken):
    listings(raw, broken)
    read, real = [], env.read_envelopes
    monkeypatch.setattr(env, "read_envelopes", lambda s, d, entity, *a, **b: (read.append(entity), real(s, d, entity, *a, **b))[1])
    store = StarStore(spark, str(tmp_path / "star"))
    counts = load.load_core(store, raw.path, F.current_timestamp())
    assert {name: read.count(name) for name in load.ALL_LISTINGS} == {name: 1 + (name in broken) for name in load.ALL_LISTINGS}
    assert counts["fato_proposicoes"] == 2 and counts["fato_votacoes"] == 1
    errors = store.read("pipeline_erros").collect()
    assert sorted(r["entidade_id"].split("/")[0] for r in errors) == sorted(broken)


@pytest.mark.parametrize("small", [True, False])
def test_rows_for_an_empty_table_are_not_shuffled(spark, tmp_path, small):
    batch = spark.createDataFrame([(1, "PL", "a"), (2, None, "b"), (None, "X", "c")], "proposicao_id int, tipo string, ementa string")
    stored = StarStore(spark, str(tmp_path / "star")).read("fato_proposicoes")
    merged = U.upsert(stored, batch, U.POLICIES["fato_proposicoes"], F.lit("2026-01-01").cast("timestamp"), batch_is_small=small)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    rows = sorted(merged.select("proposicao_id", "tipo", "ementa", "ingested_at").collect(), key=lambda r: r["ementa"])
    assert [(r[0], r[2]) for r in rows] == [(1, "a"), (2, "b"), (None, "c")] and all(r["ingested_at"] for r in rows)
    assert merged.schema.names == schemas.struct_type("fato_proposicoes").names
