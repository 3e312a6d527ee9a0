"""Partial answers, pages of a single hit, headers, topics, anchors and logs, on what the rules are for."""

import pytest
from pyspark.sql import functions as F

from quaestor.functions import text as T
from quaestor.operators import topics as O
from quaestor.sources import files as S
from quaestor.sources import portal_documents as D


def of(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


def row(k, label, value):
    return f'<tr id="tabelaDocumentos:{k}:a"><span class="label_pontilhada x">{label}</span>\n<td class="c">{value}</td>'


def test_rows_keep_to_themselves(spark):
    """Row 2 has no number and must not take that of row 10; rows are ordered as numbers; entities are read."""
    body = row(10, "Número", "B &amp; C") + row(2, "Classe", "REC") + row(10, "Relator(a)", "Ana") + '<div id="painel_ementa-1">' + "é " * 40 + "</div>"
    got = of(spark, body, D.partial_rows)
    assert [(r.indice, r.numero, r.classe, r.relator, r.ementa) for r in got] == [(2, None, "REC", None, ("é " * 40).strip()), (10, "B & C", None, "Ana", None)]


@pytest.mark.parametrize("body", [None, "", "<![CDATA[]]>" + row(1, "Número", "fora"), row(1, "Classe", "sem número"), "x" * 200_000])
def test_no_rows(spark, body):
    assert of(spark, body, D.partial_rows) == []


@pytest.mark.parametrize("size,kept", [(50, False), (51, True)])
def test_short_digests_do_not_count(spark, size, kept):
    body = row(0, "Número", "1") + f'<div id="painel_ementa-0"><b>{"d" * size}</b></div>'
    assert (of(spark, body, D.partial_rows)[0].ementa is not None) is kept


def part(title, body):
    return f'<div class="paragrafoBRS"><div class="docTitulo">{title}</div><div class="docTexto">{body}</div></div>\n'


def test_single_document(spark):
    page = '<div class="documento">' + part("Processo", "EDcl no REsp 12 / SP\n<br>2020/1") + part("Relator", "Ministra ANA  (77)") + part("Órgão Julgador", "T1 -\nPRIMEIRA") + part("Data do Julgamento", " 01/02/2026 ")
    page += part("Data da Publicação/Fonte", "DJe 05/02/2026<br>RT 1") + part("Ementa", "A &lt; B.<br/>C") + part("Acórdão", "Vistos") + "</div><footer>rodapé</footer>"
    d = of(spark, page, D.single_document)
    assert tuple(d) == ("EDcl no REsp 12", "Ministra ANA", "T1 - PRIMEIRA", "DJe 05/02/2026", "01/02/2026", "ACÓRDÃO", "A < B. C")
    d = of(spark, '<div class="documento">' + part("Processo", "sem forma") + "</div>", D.single_document)
    assert tuple(d) == ("sem forma", "", "Superior Tribunal de Justiça", "", None, "ACOR", "")


@pytest.mark.parametrize("page", [None, "", "<div class='x'>" + part("Processo", "REsp 1 / SP"), '<div class="documento">' + part("Relator", "Ana"), '<div class="documento"><div class="paragrafoBRS"><div class="docTitulo">Processo</div></div>'])
def test_other_pages_are_none(spark, page):
    assert of(spark, page, D.single_document) is None


@pytest.mark.parametrize("paragraphs,want", [
    (["1ª TURMA", "x", "2a turma", "3 Turma"], ("3ª Turma", None, None)),
    (["", "", "", "", "", "9ª Turma"], (None, None, None)),
    (["SESSÃO VIRTUAL: 01/02/2026", "Sessao: 03/04/2026", "GAB 2 - Des. José Ávila 3"], (None, "03/04/2026", "Des. José Ávila")),
    ([], (None, None, None)),
    (None, (None, None, None)),
])
def test_headers(spark, paragraphs, want):
    got = of(spark, paragraphs, T.list_header, "array<string>")
    assert tuple(got) == want


@pytest.mark.parametrize("value,want", [("12", 12), (" 12-A", 12), ("-3 bis", -3), ("artigo 5", 0), ("", 0), (None, 0), ("9" * 30, 0)])
def test_leading_numbers(spark, value, want):
    assert of(spark, value, T.leading_number) == want


@pytest.mark.parametrize("line,want", [
    ("er vergab alles des schpfschkeit in ststzu von 3", None),
    ("gabine vides destino", None),
    ("Gab. 5 modestia", None),
    ("10ª Turma - GABINETE 33 - DESEMBARGADOR José Ávila", "DESEMBARGADOR José Ávila"),
    ("Gab Des Fulano", "Des Fulano"),
])
def test_syllables_are_no_cabinet(spark, line, want):
    assert of(spark, [line], T.list_header, "array<string>").gabinete == want


def test_topics(spark):
    cites = spark.createDataFrame([("Violência", 1, 7)] * 3 + [("Violência", 1, 2), ("Violência", 1, None), ("Violência", 2, 9), ("Outro", 2, 1), ("Violência", 3, 5)], "topic string, doc bigint, paragraph int")
    got = [tuple(r) for r in O.topic_map(cites, "VIOLENCIA").collect()]
    assert got == [("Violência", 1, 5, "7(3x), 2"), ("Violência", 2, 1, "9"), ("Violência", 3, 1, "5")]
    assert O.topic_map(cites, "violência", 1).count() == 1
    with pytest.raises(ValueError, match="Outro.*Violência"):
        O.topic_map(cites, "viol")
    with pytest.raises(ValueError, match=r"\[\]"):
        O.topic_map(cites.where("1 = 0"), "x")


def test_anchors(spark):
    anchors = [("São José", "a"), ("jose", "b")]
    assert [of(spark, x, lambda c: O.first_anchor(c, anchors)) for x in ("caso SAO JOSE e outros", "José", "João", None)] == ["a", "b", None, None]
    assert of(spark, "José", lambda c: O.first_anchor(c, [])) is None
    table = spark.range(5).select("id", F.col("id").cast("string").alias("n"))
    assert O.curated(table, "n", "n", "id", 5) == [(str(k), str(k)) for k in range(5)]
    with pytest.raises(ValueError, match="more than 4"):
        O.curated(table, "n", "n", "id", 4)


def test_log_is_appended_without_texts_and_never_fails(spark, tmp_path):
    calls = spark.createDataFrame([("alfa", "corpo secreto"), (None, None)], "busca string, texto string")
    for _ in range(2):
        assert O.append_log(calls, f"{tmp_path}/log", ["texto", "absent"])
    lines = [r.value for r in spark.read.text(f"{tmp_path}/log").collect()]
    assert sorted(lines, key=len) == ["{}", "{}", '{"busca":"alfa"}', '{"busca":"alfa"}']
    (tmp_path / "file").write_text("x")
    assert O.append_log(calls, f"{tmp_path}/file/below", ["texto"]) is False


@pytest.mark.parametrize("raw,want", [
    (b"--b\r\n%PDF-1.4 \xff\x00 %%EOF more %%EOF\r\n--b--", b"%PDF-1.4 \xff\x00 %%EOF more %%EOF"),
    (b"%%EOF %PDF-", None), (b"%PDF-1.4 none", None), (b"", None), (None, None), (b"%PDF-%%EOF", b"%PDF-%%EOF"),
    (b"%PDF-" + bytes(range(256)) * 8000 + b"%%EOF tail", b"%PDF-" + bytes(range(256)) * 8000 + b"%%EOF"),
])
def test_pdf_in_a_body(spark, raw, want):
    got = of(spark, raw, S.cut_pdf, "binary")
    assert (None if got is None else bytes(got)) == want
