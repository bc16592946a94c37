"""Seed rows of the theme dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Theme id, name, description, critical.
THEMES = [
    (1, "Saude", "Proposicoes sobre sistema de saude publica, SUS, planos de saude, medicamentos, vigilancia sanitaria e epidemiologica.", True),
    (2, "Tributario", "Impostos, contribuicoes, reforma tributaria, incentivos fiscais, desoneracao, ICMS, IR, IOF e legislacao fiscal em geral.", True),
    (3, "Trabalho", "Relacoes trabalhistas, CLT, terceirizacao, salario minimo, previdencia, reforma trabalhista e direitos do trabalhador.", True),
    (4, "Tecnologia e IA", "Inteligencia artificial, regulacao de plataformas digitais, ciberseguranca, protecao de dados (LGPD), economia digital e inovacao.", True),
    (5, "Meio Ambiente", "Legislacao ambiental, codigo florestal, licenciamento, mudancas climaticas, agrotoxicos e recursos hidricos.", False),
    (6, "Seguranca Publica", "Legislacao penal, policia, presidiarios, armas de fogo, trafico de drogas, violencia e seguranca no transito.", False),
    (7, "Educacao", "Ensino basico, superior, tecnico, FUNDEB, ENEM, cotas, financiamento estudantil e politicas pedagogicas.", False),
    (8, "Direitos Humanos", "Protecao de minorias, igualdade racial, genero, criancas e adolescentes, pessoas com deficiencia e povos indigenas.", False),
    (9, "Infraestrutura", "Obras publicas, transporte, saneamento basico, habitacao, energia eletrica, telecomunicacoes e mobilidade urbana.", False),
    (10, "Economia", "Politica economica, orcamento, divida publica, exportacoes, industria, comercio exterior e regulacao financeira.", True),
]


def themes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(THEMES, "tema_id INT, nome STRING, descricao STRING, critico BOOLEAN")
