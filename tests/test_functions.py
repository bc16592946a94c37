import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from civicspark.functions import coerce, cost, formats, text, uri, vectors


def apply(spark, fn, values, kind="string"):
    data = list(enumerate(values))
    df = spark.createDataFrame(data, f"i INT, x {kind}").repartition(2)
    return [r[1] for r in sorted(df.select("i", fn(F.col("x"))).collect())] if values else []


def test_safe_str(spark):
    given_ = [None, "", " NaN ", "none", "NULL", "  SP ", "123", " a", "nan x", "\x1fb "]
    assert apply(spark, text.safe_str, given_) == [None, None, None, None, None, "SP", "123", "a", "nan x", "b"]
    assert apply(spark, text.safe_str, [123], "int") == ["123"]


def test_clean_text(spark):
    given_ = ["  Ementa da  proposicao  ", "a\x01b\x0bc\nd\te", "\x07", None, "", "Ação  　já"]
    assert apply(spark, text.clean_text, given_) == ["Ementa da proposicao", "abc d e", None, None, None, "Ação já"]
    assert apply(spark, lambda c: text.clean_text(c, 3), ["ab cd"]) == ["ab "]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_categories=["Cs"]), max_size=30), min_size=20, max_size=60))
def test_text_rules_follow_python(spark, values):
    import re

    control = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
    clean = [" ".join(control.sub("", v).split()) or None for v in values]
    assert apply(spark, text.clean_text, values) == clean
    strip = [v.strip() for v in values]
    assert apply(spark, text.strip_space, values) == strip
    full = ["".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)) for v in values]
    assert apply(spark, lambda c: text.strip_accents_full(c), values) == full


def test_keys(spark):
    assert apply(spark, text.normalize_key, ["Saúde Pública", "Tributário / Fiscal", "__x__", " ÇÃO "]) == [
        "saude_publica", "tributario_fiscal", "x", "cao"]
    assert apply(spark, text.theme_key, ["Tecnologia e IA", "Saúde"]) == ["tecnologiaeia", "saude"]
    assert apply(spark, text.strip_accents, ["João ñ ü", None]) == ["Joao n u", None]


def test_documents_numbers(spark):
    assert apply(spark, text.normalize_cnpj_cpf, ["00.360.305/0001-04", "nan", "-", "003605970031112"]) == [
        "00360305000104", None, None, "003605970031112"]


def test_uri(spark):
    links = ["https://x/deputados/204554", "https://x/partidos/36898/", "https://x/orgaos/Comissao", None, "77"]
    assert apply(spark, uri.numeric_tail, links) == [204554, 36898, None, None, 77]
    links = ["https://x/Deputados/178871", "https://x/partidos/36898/", "https://x/orgaos/253", "https://x/orgaos/Comissao", None, "77"]
    assert apply(spark, uri.resource_of, links) == ["deputados", "partidos", "orgaos", None, None, None]


def test_path_classifier(spark):
    paths = ["/deputados", "/deputados/123/despesas", "/votacoes/2024-1234-99/votos", "/x"]
    assert apply(spark, uri.path_entity, paths) == ["deputados", "deputados_despesas", "votacoes_votos", "unknown"]
    assert apply(spark, uri.path_identifier, paths) == [None, "123", "2024-1234-99", "x"]
    assert apply(spark, uri.owner_id, ["/deputados/12/despesas", "/deputados/abc/despesas", "/deputados"]) == [12, None, None]


def test_coercion(spark):
    flags = ["1", "0", "2", "true", "Sim", " t ", "nao", None, "1.0", "1.7"]
    assert apply(spark, coerce.to_flag, flags) == [True, False, False, True, True, True, False, False, True, True]
    assert apply(spark, coerce.to_approval, ["1", "0", None, "2", "1.0", "0.0", "x"]) == [True, False, None, None, True, False, None]
    assert apply(spark, coerce.to_int, ["12", "12.0", "abc", "", None, "99999999999", " 7 ", "NaN"]) == [12, 12, None, None, None, None, 7, None]
    assert [str(v) if v is not None else None for v in apply(spark, coerce.to_money, ["1.5", "abc", "1e2", "-3", None])] == [
        "1.50", None, "100.00", "-3.00", None]
    assert [str(v) for v in apply(spark, coerce.to_day, ["2026-06-14T10:00", "x", "2026-06-14"])] == ["2026-06-14", "None", "2026-06-14"]
    assert apply(spark, coerce.to_number, ["1.5", "NaN", None, "x"]) == [1.5, 0.0, 0.0, 0.0]


def test_formats(spark):
    pairs = spark.createDataFrame([(0, 1.0, 0.0), (1, 1.0, 3.0), (2, None, 2.0)], "i INT, a DOUBLE, b DOUBLE")
    assert [r[0] for r in pairs.orderBy("i").select(formats.pct(F.col("a"), F.col("b"))).collect()] == ["0%", "33.3%", "0.0%"]
    assert apply(spark, formats.fmt_int, [1234567, None], "long") == ["1.234.567", "0"]
    assert apply(spark, formats.fmt_brl, [1234.5, -2.0], "double") == ["R$ 1.235", "-R$ 2"]
    assert apply(spark, formats.fmt_millions, [35895139.32, 2e6], "double") == ["R$ 35,9 mi", "R$ 2 mi"]
    days = spark.sql("SELECT DATE '2026-06-12' AS d UNION ALL SELECT NULL")
    assert sorted(r[0] for r in days.select(formats.fmt_day(F.col("d"))).collect()) == ["12/06/2026", "—"]
    assert sorted(r[0] for r in days.select(formats.fmt_day_short(F.col("d"))).collect()) == ["", "12/06"]
    one = spark.sql("SELECT TIMESTAMP '2026-06-13 01:53:00' AS t, 2026 AS a, 1 AS m, 13 AS bad")
    row = one.select(formats.fmt_last_load(F.col("t")), formats.fmt_hour(F.col("t")), formats.fmt_month(F.col("a"), F.col("m")),
                     formats.fmt_month(F.col("a"), F.col("bad"))).first()
    assert tuple(row) == ("13/06/2026 · 01:53 UTC", "01:53", "jan/26", "13/26")


def test_cosine_and_literals(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 2.0]), ([1.0, 0.0], [-3.0, 0.0]), ([0.0, 0.0], [1.0, 1.0])],
                               "a ARRAY<FLOAT>, b ARRAY<FLOAT>")
    assert sorted(r[0] for r in df.select(vectors.cosine(F.col("a"), F.col("b"))).collect()) == [-1.0, 0.0, 0.0, 1.0]
    parsed = apply(spark, vectors.parse_vector, ["[0.1, 0.2]", "[x,1]", "[]"])
    assert parsed[0] == pytest.approx([0.1, 0.2]) and parsed[1:] == [None, None]
    assert apply(spark, vectors.format_vector, [[0.5, -1.0]], "array<float>") == ["[0.50000000,-1.00000000]"]


def test_cost_and_prompt(spark):
    assert [str(v) for v in apply(spark, cost.embed_cost, [38535], "long")] == ["0.000771"]
    row = spark.sql("SELECT 100000L AS a, 50000L AS b").select(cost.chat_cost(F.col("a"), F.col("b"))).first()
    assert str(row[0]) == "0.045000"
    shown = apply(spark, lambda c: text.render_prompt(F.lit(""), c), ["Altera a lei {tipo}."])[0]
    assert shown.startswith("Proposicao (Proposicao):") and "Altera a lei {tipo}." in shown
    sections = text.prompt_sections(f"# t\n## System\n{text.PROMPT_SYSTEM}\n## User\n\n{text.PROMPT_USER}\n")
    assert sections == {"system": text.PROMPT_SYSTEM, "user": text.PROMPT_USER}
