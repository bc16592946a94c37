"""Author rows parse their URI once."""

from civicspark.operators import transforms


def test_the_uri_is_parsed_once_for_all_fields(spark):
    records = spark.sql("""SELECT 's' AS _snapshot, 'p' AS _part, CAST(id AS INT) AS _pos, id AS proposicao_id, CASE id
        WHEN 0 THEN 'https://x/deputados/12/' WHEN 1 THEN 'https://x/Partidos/7' WHEN 2 THEN 'https://x/orgaos/C' WHEN 3 THEN ' nan ' WHEN 4 THEN 'x/deputados/99999999999' END AS uri,
        'n' AS nome, '1' AS codTipo, 't' AS tipo, '1' AS ordemAssinatura, '1' AS proponente FROM range(6)""")
    rows = transforms.autores_all(records)
    assert [c for c in rows.columns if c.startswith("_")] == ["_snapshot", "_part", "_pos"]
    found = {r.proposicao_id: (r.autor_id, r.deputado_id, r.partido_id, r.uri_autor) for r in rows.collect()}
    assert found == {0: (12, 12, None, "https://x/deputados/12/"), 1: (7, None, 7, "https://x/Partidos/7"), 2: (None, None, None, "https://x/orgaos/C"),
                     3: (None,) * 4, 4: (None, None, None, "x/deputados/99999999999"), 5: (None,) * 4}
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") == 2
