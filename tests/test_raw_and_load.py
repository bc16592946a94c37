import datetime

import pytest
from pyspark.sql import functions as F

from civicspark.functions import uri
from civicspark.operators import bridges, load, transforms as T
from civicspark.schemas import conform
from civicspark.sources import costlog, datasets, envelopes as env
from civicspark.sources.seeds import THEMES
from civicspark.sources.store import StarStore
from civicspark.streaming import landing

from .conftest import rows

NOW = "2026-06-14 00:00:00"


def now(text=NOW):
    return F.lit(text).cast("timestamp")


def test_latest_and_all_listings(spark, raw):
    raw.put("partidos", "2026-01-01T00-00-00Z", [{"id": 1, "sigla": "OLD", "nome": "x"}])
    raw.put("partidos", "2026-01-02T00-00-00Z", [{"id": 1, "sigla": "NEW", "nome": "x"}, {"id": 2, "sigla": " nan ", "nome": "y"}])
    raw.put("partidos", "2026-01-03T00-00-00Z_1", {"id": 1, "sigla": "DETAIL"})
    latest = datasets.read_dataset(spark, raw.path, "partidos", latest=True)
    assert rows(T.partidos(latest)) == [{"partido_id": 1, "sigla": "NEW", "nome": "x"}]
    everything = datasets.read_dataset(spark, raw.path, "partidos")
    assert sorted(r["sigla"] for r in rows(everything)) == [" nan ", "NEW", "OLD"]


def test_oldest_valid_row_wins(spark, raw):
    raw.put("proposicoes", "2026-01-01T00-00-00Z", [
        {"id": 1, "siglaTipo": "PL", "ementa": "old", "dataApresentacao": "2026-01-01T10:00"}, {"id": 2, "ementa": ""}, {"ementa": "no id"}])
    raw.put("proposicoes", "2026-01-02T00-00-00Z", [{"id": 1, "ementa": "new"}, {"id": 2, "ementa": "second", "dataApresentacao": "x"}])
    out = rows(T.proposicoes(datasets.read_dataset(spark, raw.path, "proposicoes")), "proposicao_id")
    assert [(r["proposicao_id"], r["ementa"], r["tipo"], r["data_apresentacao"]) for r in out] == [
        (1, "old", "PL", datetime.date(2026, 1, 1)), (2, "second", "", None)]


def test_votes_approval_and_date(spark, raw):
    raw.put("votacoes", "2026-01-01T00-00-00Z", [
        {"id": "a", "data": "2026-01-01", "aprovacao": 1}, {"id": "b", "data": "2026-01-01", "aprovacao": 0},
        {"id": "c", "data": "2026-01-01"}, {"id": "d", "data": "2026-01-01", "aprovacao": 2},
        {"id": "e", "data": "2026-01-01", "aprovacao": "1"}, {"id": "f", "data": "x"}])
    out = rows(T.votacoes(datasets.read_dataset(spark, raw.path, "votacoes")), "votacao_id")
    assert [(r["votacao_id"], r["aprovacao"]) for r in out] == [("a", True), ("b", False), ("c", None), ("d", None), ("e", True)]


def test_expenses(spark, raw):
    good = {"codDocumento": 8030573, "parcela": None, "ano": 2025, "mes": 1, "tipoDespesa": "A  B", "valorDocumento": 10.5,
            "nomeFornecedor": " F ", "cnpjCpfFornecedor": "00.1/2-3"}
    raw.put("deputados_despesas", "2026-01-01T00-00-00Z_7", [good, {**good, "parcela": 2}] + [
        {**good, "codDocumento": i, "valorDocumento": v} for i, v in enumerate([0, -1, None, "abc"])], "/deputados/7/despesas")
    raw.put("deputados_despesas", "2026-01-02T00-00-00Z_7", [{**good, "tipoDespesa": "later"}], "/deputados/7/despesas")
    raw.put("deputados_despesas", "2026-01-03T00-00-00Z_8", [], "/deputados/8/despesas")
    raw.put("deputados_despesas", "2026-01-04T00-00-00Z_x", [good], "/deputados/abc/despesas")
    out = rows(load.read_expenses(spark, raw.path), "parcela")
    assert [(r["cod_documento"], r["parcela"], r["deputado_id"], r["tipo_despesa"], str(r["valor_glosa"])) for r in out] == [
        ("8030573", 0, 7, "A B", "0.00"), ("8030573", 2, 7, "A B", "0.00")]
    assert out[0]["fornecedor_nome"] == "F" and out[0]["fornecedor_cnpj"] == "00123"


def test_details_object_or_list(spark, raw):
    raw.put("votacoes", "2026-01-01T00-00-00Z_a", {"id": "a", "idProposicao": 5}, "/votacoes/a")
    raw.put("votacoes", "2026-01-01T00-00-00Z_b", [{"id": "b", "idProposicao": 6}], "/votacoes/b")
    raw.put("votacoes", "2026-01-01T00-00-00Z_c", [], "/votacoes/c")
    raw.put("votacoes", "2026-01-01T00-00-00Z", [{"id": "z"}])
    out = rows(datasets.read_dataset(spark, raw.path, "votacoes_detalhe"), "_endpoint")
    assert [(r["_endpoint"], r["idProposicao"]) for r in out] == [("/votacoes/a", "5"), ("/votacoes/b", "6"), ("/votacoes/c", None)]


def test_lineage_and_filters(spark, raw):
    raw.put("deputados", "2026-01-01T00-00-00Z", [{"id": 1, "nome": "Ana Lima", "siglaUf": "SP"}, {"id": 0, "nome": "B", "siglaUf": "RJ"}], count=3)
    docs = env.read_envelopes(spark, raw.path, "deputados", "ARRAY<STRUCT<id: STRING>>")
    assert [(r["announced"], r["found"], r["consistent"]) for r in rows(env.lineage(docs))] == [(3, 2, False)]
    read = lambda **f: [r["nome"] for r in rows(datasets.read_dataset(spark, raw.path, "deputados", **f))]
    assert read(uf="SP", partido=None) == ["Ana Lima"] and read(nome="lima") == ["Ana Lima"] and read(order_by="nome", descending=True) == ["B", "Ana Lima"]
    listing = datasets.read_dataset(spark, raw.path, "deputados", latest=True)
    assert rows(datasets.deputy_ids(listing)) == [{"deputado_id": 1}]


def test_every_dataset_can_be_read(spark, raw):
    for name, ds in datasets.DATASETS.items():
        suffix = "" if ds.kind == "listing" else "_9"
        raw.put(ds.entity, f"2026-01-01T00-00-00Z{suffix}", {"id": 9} if ds.kind == "detail" else [{"id": 9}],
                f"/{ds.entity.split('_')[0]}/9/x" if suffix else None)
        assert datasets.read_dataset(spark, raw.path, name).count() >= 1, name


def test_landing_round_trip(spark, raw):
    data = spark.range(1050).selectExpr("CAST(id AS STRING) AS id", "'n' || id AS nome")
    env.land(data, raw.path, "partidos", "2026-01-01T00-00-00Z", page_size=100)
    docs = env.read_envelopes(spark, raw.path, "partidos", "ARRAY<STRUCT<id: STRING, nome: STRING>>", multi_line=False)
    audit = rows(env.lineage(docs))
    assert all(r["consistent"] and r["found"] <= 100 for r in audit) and sum(r["found"] for r in audit) == 1050
    assert env.records(docs).select("id").distinct().count() == 1050


def test_both_layouts_in_one_folder(spark, raw):
    raw.put("partidos", "2026-01-01T00-00-00Z", [{"id": "a"}, {"id": "b"}])
    env.land(spark.range(2500).selectExpr("CAST(id AS STRING) AS id", "'n' AS nome").repartition(30), raw.path, "partidos", "2026-01-02T00-00-00Z")
    read = datasets.read_dataset(spark, raw.path, "partidos")
    assert read.select("id").distinct().count() == read.count() == 2502
    assert read.select(*env.ORIGIN).distinct().count() == 2502


def test_unreadable_listings_are_logged(spark, raw, tmp_path):
    for entity, record in (("partidos", {"id": 1, "sigla": "P", "nome": "x"}), ("deputados", {"id": 1, "nome": "D", "siglaUf": "SP"}),
                           ("proposicoes", {"id": 1, "ementa": "e"}), ("votacoes", {"id": "1-1", "data": "2026-01-01"})):
        raw.put(entity, "2026-01-01T00-00-00Z", [record])
    raw.put("proposicoes", "2026-01-02T00-00-00Z", None, text='{"_meta": {}, "dados": [{"id": 2,')
    store = StarStore(spark, str(tmp_path / "star"))
    assert load.load_core(store, raw.path, now())["fato_proposicoes"] == 1
    logged = rows(store.read("pipeline_erros"))
    assert [(r["etapa"], r["entidade_id"][:29]) for r in logged] == [("transform", "proposicoes/2026-01-02T00-00-")]


def test_values_out_of_range_fail_the_write(spark):
    rows_out = spark.createDataFrame([(3_000_000_000, "PL", "e")], "proposicao_id long, tipo string, ementa string")
    with pytest.raises(Exception, match="OVERFLOW|overflow"):
        conform(rows_out, "fato_proposicoes").collect()


def _authors(**over):
    return {"uri": "https://x/deputados/1", "nome": "Ana", "codTipo": 10000, "tipo": "Deputado(a)", "ordemAssinatura": 1, "proponente": 1, **over}


def test_author_rules(spark, raw):
    raw.put("proposicoes_autores", "2026-01-01T00-00-00Z_1", [
        {"uri": None, "nome": None, "tipo": None}, _authors(uri="https://x/partidos/5/", nome="P"), _authors(), _authors(ordemAssinatura=9)],
        "/proposicoes/1/autores")
    records = datasets.read_dataset(spark, raw.path, "proposicoes_autores")
    out = rows(T.autores(records), "nome_autor")
    assert [(r["autor_tipo"], r["nome_autor"], r["deputado_id"], r["partido_id"], r["ordem_assinatura"]) for r in out] == [
        ("Desconhecido", "(sem nome)", None, None, None), ("Deputado(a)", "Ana", 1, None, 1), ("Deputado(a)", "P", None, 5, 1)]


def test_main_author_election(spark):
    cases = {
        1: [("a", None, True), ("b", 5, True), ("c", 1, False)],  # proponent with the lowest order
        2: [("a", None, False), ("b", 3, False), ("c", 2, False)],  # lowest order
        3: [("a", None, False), ("b", None, False)],  # first
        4: [("a", 1, False), ("b", 1, False)],  # tie: first by position
        5: [("a", 1, False), ("b", None, True)],  # a proponent beats any order
    }
    data = [(p, "s", "", i, n, "T", 1, 2, o, q) for p, lst in cases.items() for i, (n, o, q) in enumerate(lst)]
    schema = "proposicao_id INT, _snapshot STRING, _part STRING, _pos INT, nome_autor STRING, autor_tipo STRING, deputado_id INT, partido_id INT, ordem_assinatura INT, proponente BOOLEAN"
    for parts in (1, 7):
        out = rows(T.main_authors(spark.createDataFrame(data, schema).repartition(parts)), "proposicao_id")
        assert [(r["autor_principal_nome"], r["qtd_autores"]) for r in out] == [("b", 3), ("c", 3), ("a", 2), ("a", 2), ("b", 2)]


def test_single_votes(spark, raw):
    voter = lambda i: {"id": i, "siglaPartido": "PX", "siglaUf": " SP "}
    raw.put("votacoes_votos", "2026-01-01T00-00-00Z_a", [
        {"tipoVoto": "Sim", "deputado_": voter(1)}, {"tipoVoto": "Não", "deputado": voter(2)}, {"tipoVoto": "Sim", "deputado_": voter(None)},
        {"tipoVoto": "Não", "deputado_": voter(1)}], "/votacoes/a/votos")
    out = rows(T.votos(datasets.read_dataset(spark, raw.path, "votacoes_votos")), "deputado_id")
    assert [(r["votacao_id"], r["deputado_id"], r["tipo_voto"], r["sigla_uf_voto"]) for r in out] == [("a", 1, "Sim", "SP"), ("a", 2, "Não", "SP")]


def test_core_load_is_idempotent(spark, raw, tmp_path):
    raw.put("partidos", "2026-01-01T00-00-00Z", [{"id": 5, "sigla": "PX", "nome": "Partido X"}])
    raw.put("deputados", "2026-01-01T00-00-00Z", [
        {"id": 1, "nome": "Ana", "siglaPartido": "PX", "siglaUf": "SP"}, {"id": 2, "nome": "Bia", "siglaPartido": "??", "siglaUf": "RJ"}])
    raw.put("proposicoes", "2026-01-01T00-00-00Z", [
        {"id": i, "siglaTipo": "PL", "ementa": f"e{i}", "dataApresentacao": "2026-06-01"} for i in (10, 11, 12, 13)])
    raw.put("votacoes", "2026-01-01T00-00-00Z", [{"id": "v1", "data": "2026-06-01T10:00", "aprovacao": 1}, {"id": "v2", "data": "2026-06-02T10:00"}])
    store = StarStore(spark, str(tmp_path / "star"))
    counts = load.load_core(store, raw.path, now())
    assert counts == {"dim_partidos": 1, "dim_deputados": 2, "fato_proposicoes": 4, "fato_votacoes": 2}
    before = {t: rows(df) for t, df in store.tables().items()}
    load.load_core(store, raw.path, now())
    assert {t: sorted(map(repr, rows(df))) for t, df in store.tables().items()} == {t: sorted(map(repr, r)) for t, r in before.items()}
    assert [(r["deputado_id"], r["partido_id"]) for r in rows(store.read("dim_deputados"), "deputado_id")] == [(1, 5), (2, None)]

    # authorship: authors, none, unreadable, absent
    raw.put("proposicoes_autores", "2026-01-01T00-00-00Z_10", [_authors(nome="stale")], "/proposicoes/10/autores")
    raw.put("proposicoes_autores", "2026-01-02T00-00-00Z_10", [_authors(), _authors(uri="https://x/deputados/99", nome="Zé", proponente=0)], "/proposicoes/10/autores")
    raw.put("proposicoes_autores", "2026-01-01T00-00-00Z_11", [], "/proposicoes/11/autores")
    raw.put("proposicoes_autores", "2026-01-01T00-00-00Z_12", [], text="{broken")
    got = load.load_authorship(store, raw.path, now())
    assert got == {"alvos": 4, "processadas": 2, "com_autores": 1, "sem_autores": 1, "autores_inseridos": 2, "autores_orfaos": 1, "erros": 2}
    flags = {r["proposicao_id"]: r for r in rows(store.read("fato_proposicoes"))}
    assert (flags[10]["autores_carregados"], flags[10]["qtd_autores"], flags[10]["autor_principal_nome"]) == (True, 2, "Ana")
    assert (flags[11]["autores_carregados"], flags[11]["qtd_autores"]) == (True, 0)
    assert not flags[12]["autores_carregados"] and not flags[13]["autores_carregados"]
    errors = rows(store.read("pipeline_erros"), "entidade_id")
    assert [(e["entidade_tipo"], e["entidade_id"], e["mensagem"]) for e in errors] == [
        ("proposicao", "11", bridges.NO_AUTHORS), ("proposicao", "12", bridges.UNREADABLE), ("proposicao", "13", bridges.NOT_LANDED),
        ("autor", "99", "Deputado autor sem correspondencia em dim_deputados (prop 10)")]
    again = load.load_authorship(store, raw.path, now())
    assert again["alvos"] == 2 and again["erros"] == 2
    assert load.load_authorship(store, raw.path, now(), proposicao_id=10)["processadas"] == 1
    assert store.read("ponte_proposicao_autores").count() == 2

    # roll call: linked vote with single votes, symbolic vote
    raw.put("votacoes", "2026-01-02T00-00-00Z_v1", {"idProposicao": 0, "proposicoesAfetadas": [{"id": 10, "uri": "u/10"}], "descricao": "D"}, "/votacoes/v1")
    raw.put("votacoes", "2026-01-02T00-00-00Z_v2", [{"uriProposicao": "u/proposicoes/777"}], "/votacoes/v2")
    raw.put("votacoes_votos", "2026-01-02T00-00-00Z_v1", [{"tipoVoto": "Sim", "deputado_": {"id": 1, "siglaPartido": "PX"}}], "/votacoes/v1/votos")
    raw.put("votacoes_votos", "2026-01-02T00-00-00Z_v2", [], "/votacoes/v2/votos")
    got = load.load_roll_calls(store, raw.path, now())
    assert got == {"alvos": 2, "processadas": 2, "com_votos": 1, "sem_votos": 1, "votos_inseridos": 1, "vinculadas": 2, "erros": 0}
    votes = {r["votacao_id"]: r for r in rows(store.read("fato_votacoes"))}
    assert (votes["v1"]["proposicao_id"], votes["v1"]["qtd_votos"], votes["v1"]["objeto_votacao"]) == (10, 1, "D")
    # unknown proposition: no id, but the uri is kept
    assert (votes["v2"]["proposicao_id"], votes["v2"]["uri_proposicao"], votes["v2"]["votos_carregados"]) == (None, "u/proposicoes/777", True)


def test_link_rules(spark):
    schema = "votacao_id STRING, idProposicao STRING, uriProposicaoObjeto STRING, uriProposicao STRING, proposicoesAfetadas ARRAY<STRUCT<id: STRING, uri: STRING>>, objetoVotacao STRING, descricao STRING, codTipoVotacao STRING"
    data = [("a", "0", None, None, [("7", "u/8")], None, "d", "1"), ("b", None, "u/9/", None, [], "o", "d", None),
            ("c", None, None, None, None, None, None, None), ("d", "3", None, None, [("7", "u/8")], "", "d", None)]
    out = rows(T.vote_links(spark.createDataFrame(data, schema)), "votacao_id")
    assert [(r["proposicao_id"], r["uri_proposicao"], r["objeto_votacao"]) for r in out] == [
        (7, "u/8", "d"), (9, "u/9/", "o"), (None, None, None), (3, None, "d")]


def test_seed_and_cost_log(spark, tmp_path):
    store = StarStore(spark, str(tmp_path / "star"))
    assert load.load_themes(store, now()) == len(THEMES) == 10 and load.load_themes(store, now()) == 10
    assert store.read("dim_temas").where("critico").count() == 5
    log = tmp_path / "custo.csv"
    log.write_text("data,etapa,modelo,tokens_in,tokens_out,custo_usd,registros_processados,observacao\n"
                   "2026-06-14,embed_pending,38535,0.000771,m\n2026-06-14,summarize_pending,171627,0.041087,m\n2026-05-01,embed_pending,5,9.999999,m\n")
    month = rows(costlog.roll_up(costlog.read(spark, str(log))), "periodo", "operacao")
    assert [(r["operacao"], r["tokens"], r["dentro_do_teto"]) for r in month] == [
        ("embed_pending", 5, True), ("embed_pending", 38535, True), ("summarize_pending", 171627, True)]


def test_streamed_increment_equals_batch(spark, raw, tmp_path):
    for day in range(1, 4):
        raw.put("proposicoes", f"2026-01-0{day}T00-00-00Z", [{"id": i, "ementa": f"d{day}-{i}"} for i in range(day, day + 3)])
    store, check = StarStore(spark, str(tmp_path / "star")), str(tmp_path / "check")
    seen = []
    landing.load_increment(store, raw.path, check, now(), max_files=1, after=lambda s: seen.append(s.read("fato_proposicoes").count()))
    # one file per batch, last load wins
    got = {r["proposicao_id"]: r["ementa"] for r in rows(store.read("fato_proposicoes"))}
    assert got == {1: "d1-1", 2: "d2-2", 3: "d3-3", 4: "d3-4", 5: "d3-5"} and seen == [3, 4, 5]
    raw.put("proposicoes", "2026-01-04T00-00-00Z", [{"id": 9, "ementa": "new"}])
    landing.load_increment(store, raw.path, check, now(), max_files=1)
    assert store.read("fato_proposicoes").count() == 6


def test_store_ignores_unfinished_versions(spark, tmp_path):
    store = StarStore(spark, str(tmp_path / "star"))
    df = spark.sql("SELECT 1 AS tema_id, 'a' AS nome, true AS critico")
    store.write("dim_temas", df)
    (tmp_path / "star" / "dim_temas" / "v=00000002").mkdir()
    assert store.versions("dim_temas") == [1] and store.read("dim_temas").count() == 1
    store.write("dim_temas", df.union(df.withColumn("tema_id", F.lit(2))))
    assert store.read("dim_temas").count() == 2


def test_loads_rewrite_only_the_key_ranges_they_touch(spark, tmp_path):
    store = StarStore(spark, str(tmp_path / "star"), range_width=100)
    props = lambda ids, text: spark.createDataFrame([(i, "PL", text) for i in ids], "proposicao_id INT, tipo STRING, ementa STRING")
    assert load.apply_batch(store, "fato_proposicoes", props(range(0, 500, 50), "old"), now()) == 10
    load.apply_batch(store, "fato_proposicoes", props([150, 160], "new"), now())
    assert {n: int(p.split("v=")[1][:8]) for n, p in store.ranges("fato_proposicoes").items()} == {0: 1, 1: 2, 2: 1, 3: 1, 4: 1}
    got = {r["proposicao_id"]: r["ementa"] for r in rows(store.read("fato_proposicoes"))}
    assert got == {**{i: "old" for i in range(0, 500, 50)}, 150: "new", 160: "new"}
    # an unfinished version does not count
    (tmp_path / "star" / "fato_proposicoes" / "v=00000003" / "faixa=1").mkdir(parents=True)
    assert store.read("fato_proposicoes").count() == 11
    votes = spark.sql("SELECT 'x-1' AS votacao_id, timestamp'2026-01-01' AS data UNION ALL SELECT '2265603-49', timestamp'2026-01-01'")
    assert load.apply_batch(store, "fato_votacoes", votes, now()) == 2 and min(store.ranges("fato_votacoes")) < 0
    load.apply_batch(store, "fato_votacoes", votes, now())
    assert store.read("fato_votacoes").count() == 2


def test_error_log_grows(spark, tmp_path):
    store = StarStore(spark, str(tmp_path / "star"))
    for n in range(2):
        load.append_errors(store, spark.sql(f"SELECT 'autores' AS etapa, 'm{n}' AS mensagem"))
    assert sorted(r["mensagem"] for r in rows(store.read("pipeline_erros"))) == ["m0", "m1"]


def test_owner_key_of_text_ids(spark):
    df = spark.sql("SELECT '/votacoes/2265603-49/votos' AS e")
    assert df.select(uri.owner_key(F.col("e"))).first()[0] == "2265603-49"


def test_landing_writes_pages_without_a_shuffle_and_gives_every_row_back(spark, tmp_path):
    rows = spark.range(0, 1050, 1, 3).selectExpr(
        "CAST(id AS STRING) AS id", "CASE WHEN id % 7 = 0 THEN NULL ELSE concat('é \"\\n', id) END AS ementa", "id % 3 AS _owner")
    endpoint = F.when(F.col("_owner") > 0, F.concat(F.lit("/proposicoes/"), F.col("_owner")))
    context = spark.sparkContext
    context.setJobGroup("landing", "landing")
    env.land(rows, str(tmp_path), "proposicoes", "2026-01-01T00-00-00Z", endpoint=endpoint)
    context.setLocalProperty("spark.jobGroup.id", None)
    jobs = context.statusTracker().getJobIdsForGroup("landing")
    assert sum(len(context.statusTracker().getJobInfo(j).stageIds) for j in jobs) == 1
    read = env.read_envelopes(spark, str(tmp_path), "proposicoes", "ARRAY<STRUCT<id STRING, ementa STRING, _owner STRING>>")
    assert read.where("_count <> size(dados) OR _count > 100 OR _corrupt IS NOT NULL").count() == 0
    assert {r["_endpoint"] for r in read.select("_endpoint").distinct().collect()} == {None, "/proposicoes/1", "/proposicoes/2"}
    back = env.records(read)
    assert back.select("id", "ementa").exceptAll(rows.select("id", "ementa")).count() == 0 and back.count() == 1050
    assert back.where("coalesce(_endpoint, '/proposicoes/0') <> concat('/proposicoes/', _owner)").count() == 0
