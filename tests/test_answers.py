import json

import pytest
from pyspark.sql import functions as F

from quaestor.sources import answers as A


def read(spark, column, **body):
    return spark.createDataFrame([(json.dumps(body),)], "b string").select(column(F.col("b")).alias("x")).first().x


def test_only_fields_with_a_value(spark):
    got = read(spark, A.federal_record, PROCESSO="1", EMENTA="EMENTA  X", TRIBUNAL="stf", CLASSE=" ", INTEIRO_TEOR="sem link", PRECEDENTE_RELEVANTE=1)
    assert got == {"numero": "1", "ementa": "X", "tribunal": "STF", "aviso": "sem data nem órgão", "precedente_relevante": "true"}


def test_the_first_text_that_is_there(spark):
    hit = lambda **s: read(spark, lambda c: A.supreme_record(c, "acordaos"), _source=s)
    got = hit(ementa_texto="", decisao_texto="<p>D &amp; E</p>", documental_indexacao_texto="I", documental_tese_tema_texto=793, relator_processo_nome="A", relator_acordao_nome="A", processo_numero=5)
    assert (got.content, got.theme, got.writer, got.number, got.kind, got.organ) == ("D & E", "Tema 793", None, "5", "ACORDAOS", "Supremo Tribunal Federal")
    assert hit(base="sumulas", is_vinculante=True).kind == "Súmula Vinculante" and hit(base="sumulas", is_vinculante=False).kind == "Súmula"


def test_numbers_with_and_without_the_national_form(spark):
    got = read(spark, A.electoral_record, numeroUnico="06012345620226170000", siglaClasse="RE", relatores=[{"nome": "X"}, None])
    assert (got.number, got.without_cnj, got["class"], got.judges) == ("0601234-56.2022.6.17.0000", False, "RE", "X")
    got = read(spark, A.electoral_record, numeroProcesso="77", numeroDecisao="8", siglaClasse="RE")
    assert (got.number, got.without_cnj) == ("RE nº 77, acórdão nº 8", True)
    assert read(spark, A.electoral_record).hollow


def test_an_answer_out_of_contract_fails(spark):
    assert read(spark, A.sentence_records, total=0, sentencas=[]).found == []
    with pytest.raises(Exception, match="out of contract, with fields: items, total"):
        read(spark, A.sentence_records, items=[], total=1)
