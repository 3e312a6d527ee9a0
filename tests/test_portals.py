from pyspark.sql import functions as F

from quaestor.sources import cards as P


def one(spark, html, column):
    return spark.createDataFrame([(html,)], "html string").select(column(F.col("html")).alias("x")).first().x


PAGE = """<div class="numDocs">1.234 documentos</div>
<div class="itemlistadocumentos"><span>Processo</span><b>REsp&nbsp;1872321</b>/ SP<p>(RECURSO ESPECIAL)</p><p>Ministra NANCY ANDRIGHI (1118)</p><p>DJe 01/02/2021</p><p>Decisão: 09/12/2020</p><h4>Ementa</h4>CIVIL.<br>CONSUMIDOR ...<a>(+)</a><p>Ministro OUTRO</p></div>
<div class="itemlistadocumentos"><span>Processo</span><b>HC 1</b><p>sem tipo</p><h4>Ementa</h4>TEXTO</div>"""


def test_a_list_of_cards(spark):
    first, second = one(spark, PAGE, P.listed_cards)
    assert tuple(first) == ("REsp 1872321 / SP", "RECURSO ESPECIAL", "Ministra NANCY ANDRIGHI", "DJe 01/02/2021", "09/12/2020", "CIVIL. CONSUMIDOR ...", True)
    assert (second.number, second.kind, second.reporter, second.summary, second.cut) == ("HC 1 sem tipo", "ACOR", None, "TEXTO", False)
    assert one(spark, PAGE, P.told_total) == 1234 and one(spark, "<p>none</p>", P.told_total) is None
    assert one(spark, "<p>none</p>", P.listed_cards) == [] and one(spark, None, P.listed_cards) is None


def test_notes_of_a_bulletin(spark):
    note = '<div class="clsInformativoBlocoItem"><span id="temaNota1">Informativo de Jurisprudência - Edição Extraordinária n. 33 - Direito Penal - 28 de julho de 2026. Tema</span><h3 class="clsInformativoOrgaojulgador">TERCEIRA SEÇÃO</h3><div class="divLinha"><div class="clsInformativoLabel">Processo</div><div class="clsInformativoTexto">REsp 1/SP, Rel. Ministro A</div></div><div class="divLinha"><div class="clsInformativoLabel">Destaque</div></div><div class="divLinha"><div class="clsInformativoTextoFormatado">A <span>Defensoria</span> .</div></div></div>'
    empty = '<div class="clsInformativoBlocoItem"><span id="temaNota0">(NÃO PUBLICADO)</span></div>'
    (got,) = one(spark, empty + note, P.bulletin_notes)
    assert tuple(got) == ("Informativo de Jurisprudência - Edição Extraordinária n. 33", "28 de julho de 2026", "TERCEIRA SEÇÃO", "REsp 1/SP", None, "A Defensoria.")


def test_values_are_carried_over_any_number_of_ranges(spark):
    rows = []
    organ, edition = {}, {}
    for k in range(200):
        edition[k] = "A" if k < 70 else "B" if k < 120 else "A" if k < 150 else None
        organ[k] = f"o{k}" if k in (3, 50, 90, 91, 160) else None
        rows.append((k // 10, k % 10, edition[k], organ[k]))
    want, held = {}, None
    for k in range(200):
        if k and edition[k] != edition[k - 1]:
            held = None
        held = organ[k] or held
        want[k] = held
    df = spark.createDataFrame(rows, "page int, n int, edition string, organ string").repartition(7)
    for parts in (1, 3, 40):
        got = {r.page * 10 + r.n: r.carried for r in P.carried(df, ["page", "n"], "organ", "edition", "carried", parts).collect()}
        assert got == want
    assert P.carried(df.limit(0), ["page", "n"], "organ", "edition", "carried").count() == 0


def test_cards_of_labels_and_of_rows(spark):
    card = '<div class="card resultadoItem"><a class="numero-processo">1-2/TJRJ</a><div class="resLabel">Relator</div><div class="resValue">Des. <b>X</b></div><a class="copiarCitacao" data-citacao="(TJRJ, AG 1,  17ª Câmara de Direito Privado , Relator X)"></a></div>'
    (got,) = one(spark, card, P.labelled_cards)
    assert (got.number, got.organ, got.fields) == ("1-2/TJRJ", "17ª Câmara de Direito Privado", {"RELATOR": "Des. X"})
    table = '<tr><td>Des(a). MARIA - Julgamento: 02/03/2020 - QUARTA CÂMARA CÍVEL</td></tr><tr><td><div class="divEmenta"><textarea>Ementa: T &lt; 1</textarea></div></td></tr><tr><td><div class="divEmenta"><textarea>só</textarea></div></td></tr>'
    first, second = one(spark, table, P.ruled_rows)
    assert tuple(first) == ("MARIA", "02/03/2020", "Quarta Câmara Cível", "T < 1") and second.summary == "só"
