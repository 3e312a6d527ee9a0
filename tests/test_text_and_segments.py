import datetime

import pytest
from pyspark.sql import functions as F

from quaestor.functions import text as T
from quaestor.operators import segment as G
from quaestor.sources import files as S
from quaestor.sources.html import html_blocks


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_functions(spark):
    def v(c):
        return one(spark, c)

    assert v(T.fold(F.lit("AÇÃO Não ÿ"))) == "acao nao y"
    assert v(T.ementa_key(F.lit("curta"))) is None
    assert v(T.truncate_tokens(F.lit("a" * 9 + "." + "b" * 20), 3)) == "a" * 9 + ". [...]"
    assert v(T.truncate_tokens(F.lit("a." + "b" * 20), 3)) == "a." + "b" * 10 + " [...]"
    assert v(T.html_clean(F.lit("&lt;b&gt;x  <i>y</i>&amp;"))) == "x y &"
    assert v(T.date_of(F.lit("04/07/2006"))) == datetime.date(2006, 7, 4)
    assert v(T.date_long(F.lit("2006-07-04"))) == "4 de julho de 2006"
    assert v(T.date_es(F.lit("14 de mayo de 2026"))) == "2026-05-14"
    assert v(T.law_norm(F.lit("lei nº 8.742"))) == "LEI-8742" and v(T.law_norm(F.lit("Portaria 5"))) is None
    assert v(T.process_number(F.lit("REsp 2.098.934/RO"))) == "2098934" and v(T.process_number(F.lit("Tema 1285"))) is None
    assert v(T.state_of_case(F.lit("Manuela y otros Vs. El Salvador Vs. Perú."))) == "Perú"
    assert v(T.url_of_language(F.lit("http://x/seriec_149_ESP2.pdf"), "por")) == "http://x/seriec_149_por2.pdf"
    assert v(T.snippet(F.lit("x" * 30 + "Saúde" + "y" * 30), ["saude"], 12)) == "[...] " + "xxxxSaúdeyyy" + " [...]"
    cite = T.citation(F.lit("Ximenes Lopes Vs. Brasil"), F.lit("2006-07-04"), F.lit("C"), F.lit(149), F.lit(89), F.lit(None).cast("string"), F.lit("CC"), F.lit(None).cast("string"))
    assert v(cite) == "Corte IDH. Caso Ximenes Lopes Vs. Brasil. Sentença de 4 de julho de 2006. Série C No. 149, par. 89."


@pytest.mark.parametrize(("a", "b", "same"), [
    ("CPAP apneia sono", "apneia sono CPAP", True), ("Ação, penal", "acao penal", True), ("a b a", "b a", True),
    ("a nao b", "b nao a", False), ("a adj5 b", "b adj5 a", False), ('"a b"', '"b a"', False), ("a e b", "a ou b", False),
    ("a E b", "a e b", False), ("a E b OU c", "a OU b E c", False),
])
def test_search_keys(spark, a, b, same):
    assert (one(spark, T.search_key(F.lit(a))) == one(spark, T.search_key(F.lit(b)))) is same


def test_numbered_paragraphs():
    text = "I. INTRO\n\n1. Primeiro parágrafo\ncontinua a) item\n- 3 -\n\n12 Cf. nota de rodapé\n2. Segundo 7. não abre\n7. nem esta\n9\nsegue\n\nIII\nCOMPETÊNCIA\n\n3. Terceiro http://x.y/z fim\nA CORTE\nDECIDE\npor unanimidade"
    got = G.numbered_paragraphs(text)
    assert [g[0] for g in got] == [1, 2, 3]
    assert got[0][1] == "Primeiro parágrafo continua a) item"
    assert got[1][1] == "Segundo 7. não abre 7. nem esta segue" and got[1][2] == ["III COMPETÊNCIA"]
    assert got[2][1] == "Terceiro fim A CORTE DECIDE por unanimidade"
    assert G.numbered_paragraphs("") == [] and G.numbered_paragraphs(None) == []


def test_case_lists(spark):
    text = "PODER\n1 - 0800307-06.2025.4.05.8103 - APELAÇÃO CÍVEL\nx\nEMENTA\num\n\n dois\n2 – 0007508-25.2015.4.05.8300 – REMESSA\nEMENTA\ntrês"
    assert [(c.ordem, c.tipo) for c in one(spark, G.cases_lenient(F.lit(text)))] == [(1, "APELAÇÃO CÍVEL"), (2, "REMESSA")]
    strict = one(spark, G.cases_strict(F.lit(text)))
    assert len(strict) == 1 and strict[0].ementa.startswith("um\ndois")


def test_documents(spark):
    with pytest.raises(ValueError):
        S.word97_text(b"not one")
    assert ("p", "", "x y") in html_blocks("<div><p>x <b>y</b><script>no</script></p></div>")
    assert html_blocks(None) == [] and html_blocks("<p>open") == [("p", "", "open")]


def test_law_types_are_whole_words(spark):
    def v(text):
        return spark.range(1).select(T.law_norm(F.lit(text))).first()[0]

    assert [v(x) for x in ("L.E.I. 5", "LEINO 5", "MPN 5", "N 5", "")] == [None] * 5
    assert [v(x) for x in ("Lei 8.742/93", "lei n. 8.742", "LEI-008742", "Decreto-Lei nº 4.657", "medida  provisória no 2.164", "LC 80", "Lei Complementar N° 80")] == ["LEI-8742", "LEI-8742", "LEI-8742", "DEL-4657", "MPR-2164", "LCP-80", "LCP-80"]


def test_word_fields_keep_their_results(spark):
    def v(text):
        return spark.range(1).select(T.word_controls(F.lit(text))).first()[0]

    assert v("a \x13LINK \x13 inner \x14one\x15\x14 shown \x13x\x14two\x15\x15 b") == "a  shown two b"
    assert v("\x13" * 9 + "deep" + "\x15" * 9 + "left") == "left"
    assert v("\x13 never closed") == "never closed" and v("a\x07b\r\r\r\rc\x1e") == "a\tb\n\nc-"


def test_markdown_lines_and_fences(spark):
    def v(text):
        return spark.range(1).select(T.markdown_strip(F.lit(text))).first()[0]

    assert v("# A\ntext\n```\n# code\n- x\n```\n> quoted\n- one\n---\n`c` **b** [l](u)") == "A\n\ntext\n\nquoted\n- one\n\n" + "-" * 50 + "\n\nc b l"
    assert v("open ``` fence") == "open ``` fence" and v("") == ""


def test_word97_main_text_only():
    assert S.word97_text(S.make_word97("corpo ação", notes="nota de rodapé")) == "corpo ação"
    assert S.word97_text(S.make_word97("corpo", wide=True, notes="nota")) == "corpo"
    with pytest.raises(ValueError, match="older"):
        S.word97_text(S.make_word97("x", version=105))
    with pytest.raises(ValueError):
        S.word97_text(b"{\\rtf1}")
