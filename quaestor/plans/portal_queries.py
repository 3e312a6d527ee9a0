"""Queries on the portals' pages. The markup is made from the texts of the tables, in the shapes that the portals print; SQL has what a reader should find."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources import cards as P
from .registry import Tables, query


def escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def markup(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


COLLAPSED = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"
doc = lambda: F.col("doc_id")


def _list_page() -> Column:
    """Two cards of a document: one that tells all, in one of two orders; one with a cut summary, twice told dates and lines after its end."""
    number = markup("<span>Processo</span><b>REsp&nbsp;", doc(), "</b><i>/ SP</i>")
    told = markup("<p>Ministro FULANO ", F.col("source"), " (1140)</p><p>DJe 01/02/2020</p><p>Decisão: 05/06/2019</p>")
    text = markup("<h4>EMENTA</h4><p>", F.replace(escaped(F.col("text")), F.lit("\n"), F.lit("</p><p>")), "</p>")
    one = F.when(doc() % 3 == 0, markup(told, number, "<p>(RECURSO ESPECIAL)</p>", text)).otherwise(markup(number, "<p>(RECURSO ESPECIAL)</p>", told, text))
    two = markup("<span>processo</span><b>AREsp ", doc(), "</b><p>(AGRAVO)</p><p>DJEN 03/04/2021</p><p>DJe 05/05/2022</p>", text, "<p>...</p><a>(+)</a><p>Ministra OUTRA</p>")
    return markup('<div class="numDocs"><b>1.', F.lpad((doc() % 1000).cast("string"), 3, "0"), ' documentos</b></div><div class="a itemlistadocumentos">', one, '</div><script>x("Ementa")</script><div class="itemlistadocumentos b">', two, "</div>")


query(
    "src_html_statem",
    f"""select doc_id, 1000 + doc_id % 1000 as total, 1 as n, 'REsp ' || doc_id || ' / SP' as number, 'RECURSO ESPECIAL' as kind, 'Ministro FULANO ' || source as reporter, 'DJe 01/02/2020' as published, '05/06/2019' as decided, {COLLAPSED} as summary, ends_with({COLLAPSED}, '...') as cut from documents
union all select doc_id, 1000 + doc_id % 1000, 2, 'AREsp ' || doc_id, 'AGRAVO', null, 'DJEN 03/04/2021', null, trim({COLLAPSED} || ' ...'), true from documents""",
)(
    lambda t: t.documents.select("doc_id", _list_page().alias("html")).select("doc_id", P.told_total(F.col("html")).alias("total"), F.posexplode(P.listed_cards(F.col("html"))).alias("n", "c"))
    .select("doc_id", "total", (F.col("n") + 1).alias("n"), "c.number", "c.kind", "c.reporter", "c.published", "c.decided", "c.summary", "c.cut")
)


def _bulletins(t: Tables) -> DataFrame:
    """Pages of ten notes; an edition has 25, its organ is printed with every seventh note and where an edition begins."""
    row = lambda label, cls, value: markup('<div class="divLinha"><div class="clsInformativoLabel">', label, '</div><div class="', cls, '">', value, "</div></div>")
    edition = F.expr("doc_id div 25")
    title = markup('<span id="temaNota', doc(), '" hidden>Informativo de Jurisprudência n. ', edition, " - 18 de agosto de 2026. Tema</span>")
    organ = F.when(doc() % 7 == 0, markup('<h3 class="clsInformativoOrgaojulgador">TURMA &amp; ', doc(), "</h3>")).otherwise("")
    point = markup('<div class="divLinha"><div class="clsInformativoLabel">Destaque</div></div><div class="divLinha"><div class="clsInformativoTextoFormatado">', escaped(F.col("text")), "</div></div>")
    note = markup('<div class="clsInformativoBlocoItem">', title, organ, row("Processo", "clsInformativoTexto", markup("REsp ", doc(), ", Rel. Ministro X, julgado em 1/2/2020")), row("Tema", "clsInformativoTexto", F.lit("tema")), point, "</div>")
    empty = F.when(doc() % 10 == 0, F.lit('<div class="clsInformativoBlocoItem"><span id="temaNota0">Informativo de Jurisprudência n. 9 (NÃO PUBLICADO)</span></div>')).otherwise("")
    pages = t.documents.select(F.expr("doc_id div 10").alias("page"), "doc_id", F.concat(empty, note).alias("item"))
    # ten notes a page
    return pages.groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "item"))), lambda x: x["item"]), "\n").alias("html"))


def _bulletin(t: Tables) -> DataFrame:
    notes = _bulletins(t).select("page", F.posexplode(P.bulletin_notes(F.col("html"))).alias("n", "x")).select("page", "n", "x.*")
    return P.carried(notes, ["page", "n"], "organ", "edition", "carried").select("page", "process", "edition", "date", "point", F.coalesce("carried", F.lit("Tribunal")).alias("organ"))


query(
    "src_html_bulletin",
    f"""select doc_id // 10 as page, 'REsp ' || doc_id as process, 'Informativo de Jurisprudência n. ' || doc_id // 25 as edition, '18 de agosto de 2026' as date, nullif(regexp_replace({COLLAPSED}, '\\s+([.,;:)])', '\\1', 'g'), '') as point,
  coalesce(last_value(case when doc_id % 7 = 0 then 'TURMA & ' || doc_id end ignore nulls) over (partition by doc_id // 25 order by doc_id), 'Tribunal') as organ from documents""",
)(_bulletin)

query(
    "src_html_tjrj",
    f"""select doc_id, case when doc_id % 4 > 0 then '300' || doc_id || '-77.2026.8.19.0000/TJRJ' else cast(doc_id as varchar) end as number, case when doc_id % 3 > 0 then '17ª Câmara de ' || source end as organ, 'Acórdão' as kind, {COLLAPSED} as summary, 'Des. ' || lang as reporter from documents""",
)(
    lambda t: t.documents.select("doc_id", F.explode(P.labelled_cards(_labelled())).alias("c")).select("doc_id", "c.number", "c.organ", "c.kind", F.col("c.fields")["EMENTA"].alias("summary"), F.col("c.fields")["RELATOR"].alias("reporter"))
)


def _labelled() -> Column:
    number = F.when(doc() % 4 > 0, markup('<a class="numero-processo"> 300', doc(), "-77.2026.8.19.0000/TJRJ </a>")).otherwise(markup('<a class="consultaProcessual" data-link="x?num_processo=', doc(), '">ver</a>'))
    organ = F.when(doc() % 3 > 0, markup("  17ª Câmara de ", F.col("source"), " , ")).otherwise("")
    pair = lambda label, value: markup('<div class="resLabel">', label, '</div> <div class="resValue">', value, "</div>")
    return markup('<div id="resultado1" class="card mb-3 resultadoItem"><div class="resValueTipoJurisprudencia">Acórdão</div>', number, pair("Ementa", F.lit("velha")), pair("ementa", escaped(F.col("text"))), pair("Relator", markup("Des. <b>", F.col("lang"), "</b>")), '<a class="copiarCitacao" data-citacao="(TJRJ, AG 1,', organ, 'Relator X, D.E. 1)"></a></div>')


query(
    "src_html_ejuris",
    """select doc_id, 'FULANA ' || lang as judge, case when doc_id % 2 = 0 then '01/02/2020' end as decided, case when doc_id % 2 = 0 then 'Quarta Câmara Src' || substr(source, 4) end as organ, trim(text) as summary from documents""",
)(lambda t: t.documents.select("doc_id", F.explode(P.ruled_rows(_ruled())).alias("r")).select("doc_id", "r.judge", "r.decided", "r.organ", "r.summary"))


def _ruled() -> Column:
    told = F.when(doc() % 2 == 0, markup(" - Julgamento: 01/02/2020 - QUARTA CÂMARA ", F.upper("source"))).otherwise("")
    return markup("<table><tr><td>Relação de 1 até 10</td></tr><tr><td>Des(a). FULANA ", F.col("lang"), told, '</td></tr><tr><td><div class="divEmenta" id="divementa_1"><textarea>Ementa: ', escaped(F.col("text")), "</textarea></div></td></tr></table>")


query(
    "src_html_panels",
    f"""select doc_id, case when doc_id % 3 > 0 then 1000 + doc_id % 1000 end as total, 'id' || doc_id as id, '700-' || doc_id as number, case when doc_id % 2 = 0 then 'APELAÇÃO' end as class, 'Min. ' || lang as reporter, 'Crime; ' || source as subjects, nullif({COLLAPSED}, '') as summary from documents""",
)(lambda t: t.documents.select("doc_id", _panel().alias("html")).select("doc_id", P.panels_total(F.col("html")).alias("total"), F.explode(P.panels(F.col("html"))).alias("p")).select("doc_id", "total", "p.id", "p.number", "p.class", "p.reporter", "p.subjects", "p.summary"))


def _panel() -> Column:
    field = lambda name, value: markup('<span class="x" data-id="', name, '">', F.coalesce(value, F.lit("")), "</span>")
    total = F.when(doc() % 3 > 0, markup("<p>Exibindo <b>1</b> a 10 de <b>1.", F.lpad((doc() % 1000).cast("string"), 3, "0"), "</b></p>")).otherwise("")
    body = markup(field("id", markup("id", doc())), field("numero_processo", markup(" 700-", doc())), F.when(doc() % 2 == 0, field("classe", F.lit("APELAÇÃO"))).otherwise(""), field("ministro_relator", markup("Min. <i>", F.col("lang"), "</i>")), "<dl><dt>Assuntos:</dt><dd>", F.coalesce(markup("Crime; ", F.col("source")), F.lit("")), "</dd></dl>", field("ementa", markup("EMENTA : ", escaped(F.col("text")))))
    return markup(total, '<div class="panel panel-default"><div>', body, '</div></div><div class="panel"><span data-id="outro">x</span></div>')


query(
    "src_html_sumula",
    f"""select doc_id, 'Súmula ' || doc_id as number, 'DIREITO ' || upper(lang) as subject, case when doc_id % 4 < 2 then {COLLAPSED} else 'Verbete ' || doc_id || ' curto' end as text, case when doc_id % 4 = 1 then 'Superior Tribunal de Justiça' when doc_id % 4 = 0 then 'PRIMEIRA SEÇÃO' else 'TERCEIRA SEÇÃO' end as organ,
  case when doc_id % 4 = 0 then 'CANCELADA' when doc_id % 4 = 3 then 'REVOGADA' end as status, case when doc_id % 4 = 0 then 'nota ' || doc_id when doc_id % 4 = 3 then 'pela lei ' || source end as note from documents where doc_id % 4 > 1 or {COLLAPSED} <> ''""",
)(lambda t: t.documents.where((doc() % 4 > 1) | (F.trim(F.regexp_replace("text", r"\s+", " ")) != "")).select("doc_id", F.explode(P.digests(_digest())).alias("d")).select("doc_id", F.concat(F.lit("Súmula "), "d.number").alias("number"), "d.subject", "d.text", "d.organ", "d.status", "d.note"))


def _digest() -> Column:
    head = markup('<div class="gridSumula"><span class="numeroSumula">', doc(), "</span>")
    subject = markup('<section class="blocoVerbete"><div class="ramoSumula">DIREITO ', F.upper("lang"), "</div>")
    whole = markup('<div class="clsVerbete">', escaped(F.col("text")), "</div>")
    marked = markup(head, '<b class="clsINDE">cancelada</b>', subject, whole, '<div class="clsOrgaoJulgador">PRIMEIRA SEÇÃO</div><div class="clsCOM">nota ', doc(), "</div></section></div>")
    plain = markup(head, subject, whole, "</section></div>")
    loose = markup(head, subject, "<p>Verbete <b>", doc(), "</b> curto (TERCEIRA SEÇÃO, julgado em 01/02/2020, DJe de 03/03/2020)</p>")
    return F.when(doc() % 4 == 0, marked).when(doc() % 4 == 1, plain).when(doc() % 4 == 2, markup(loose, "</section></div>")).otherwise(markup(loose, "<p>Súmula revogada: pela lei ", F.col("source"), "</p></section></div>"))


query(
    "src_html_jsf_regional",
    f"""select doc_id, case when doc_id % 3 = 0 then lpad(cast(doc_id as varchar), 7, '0') || '-39.2023.4.01.3200' else 'AC ' || doc_id end as numero, case when doc_id % 2 = 0 then 'APELAÇÃO CÍVEL' end as classe, 'Des. ' || lang as relator, nullif(trim(regexp_replace(regexp_replace(text, '[<>&]|\\]\\]', ' ', 'g'), '\\s+', ' ', 'g')), '') as origem from documents""",
)(
    lambda t: t.documents.select("doc_id", F.explode(P.regional_rows(_regional())).alias("m")).select("doc_id", *[F.col("m")[n].alias(n) for n in ("numero", "classe", "relator", "origem")])
)


def _regional() -> Column:
    cell = lambda label, value: markup('<td><span class="label_pontilhada">', label, "</span></td><td>", value, "</td>")
    number = F.when(doc() % 3 == 0, markup("<b>", doc(), "</b><br/> ", F.lpad(doc().cast("string"), 7, "0"), "-39.2023.4.01.3200")).otherwise(markup("AC ", doc(), "<br>outro"))
    body = F.regexp_replace("text", r"[<>&]|\]\]", " ")
    row = markup('<tr id="tabelaDocumentos:0:linha">', cell("Número", number), F.when(doc() % 2 == 0, cell("Classe", F.lit("APELAÇÃO <i>CÍVEL</i>"))).otherwise(cell("Classe", F.lit(" "))), cell("Relator(a)", markup("Des. ", F.col("lang"))), cell("Origem", body), cell("Número", F.lit("segundo")), '</tr><tr id="tabelaDocumentos:1:linha">', cell("Classe", F.lit("sem número")), "</tr>")
    return F.when(doc() % 2 == 0, markup("<update><![CDATA[", row, "]]></update>")).otherwise(escaped(row))
