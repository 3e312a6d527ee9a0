"""Documents of portal pages, headers of lists, topics, anchors and logs, over pages and texts made from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import topics as O
from ..operators.relational import positions
from ..sources import files as S
from ..sources import portal_documents as D
from .registry import Tables, query

#: First line of a text, white space as single blanks.
FIRST = r"trim(regexp_replace(split_part(coalesce(text, ''), chr(10), 1), '\s+', ' ', 'g'))"


def _first() -> Column:
    return T.collapse(F.split_part(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(1)))


# --- rows of a partial answer --------------------------------------------------------------------------------------
def _partial(t: Tables) -> DataFrame:
    """Answers of three rows: the second digest is a heading, every other third row has no number, what stands outside CDATA doesn't count."""

    def row(k: int, fields: list) -> Column:
        cells = [F.concat(F.lit(f'<span class="label_pontilhada">{label}</span><td> '), value, F.lit(" </td>")) for label, value in fields]
        return F.concat(F.lit(f'<tr id="tabelaDocumentos:{k}:linha">'), *cells, F.lit(f'</tr><a id="tabelaDocumentos:{k}:abrir"></a>'))

    line = T.xml_escape(_first())
    third = F.when(F.col("doc_id") % 2 == 0, row(2, [("Número", F.concat(F.lit("N"), "doc_id", F.lit("-2")))])).otherwise(row(2, [("Classe", F.lit("REC"))]))
    rows = F.concat(row(0, [("Número", F.concat(F.lit("N"), "doc_id")), ("Relator(a)", F.coalesce("source", F.lit("")))]), row(1, [("Classe", F.lit("REC")), ("Decisão", F.concat(F.lit("<b>Sim:</b> "), line))]), third)
    digest = lambda k, c: F.concat(F.lit(f'<div id="painel_ementa-{k}" class="e">'), c, F.lit("</div>"))
    panels = F.concat(digest(0, F.concat(F.lit("x" * 60 + " "), line)), digest(1, F.lit("curta")), digest(2, F.concat(F.lit("<i>" + "y" * 60 + "</i>\n "), line)))
    return t.documents.select("doc_id", F.concat(F.lit('tabelaDocumentos:9:fora <update><![CDATA['), rows, F.lit("]]></update><update><![CDATA["), panels, F.lit("]]></update>")).alias("body"))


query(
    "src_html_jsf_table",
    rf"""with p as (select doc_id, source, {FIRST} as line from documents)
select doc_id, 0 as indice, 'N' || doc_id as numero, cast(null as varchar) as classe, nullif(trim(source), '') as relator, cast(null as varchar) as decisao, trim(repeat('x', 60) || ' ' || line) as ementa from p
union all select doc_id, 1, null, 'REC', null, trim('Sim: ' || line), trim(repeat('y', 60) || ' ' || line) from p
union all select doc_id, 2, 'N' || doc_id || '-2', null, null, null, null from p where doc_id % 2 = 0""",
)(lambda t: _partial(t).select("doc_id", F.explode(D.partial_rows(F.col("body"))).alias("r")).select("doc_id", "r.indice", "r.numero", "r.classe", "r.relator", "r.decisao", "r.ementa"))


# --- the page of a single hit ---------------------------------------------------------------------------------------
def _single(t: Tables) -> DataFrame:
    """Pages of one document; every third page is a list instead, every fifth document names no issue of the gazette."""

    def part(title: str, body: Column) -> Column:
        return F.concat(F.lit(f'<div class="paragrafoBRS"><div class="docTitulo"> {title} </div><div class="docTexto">'), body, F.lit("</div></div>"))

    issue = F.when(F.col("doc_id") % 5 == 0, "sem data").otherwise(F.concat(F.lit("DJEN 0"), (1 + F.col("doc_id") % 9), F.lit("/10/2025<br/>RSTJ vol. 1")))
    page = F.concat(
        F.when(F.col("doc_id") % 3 == 0, '<div class="listadocumentos">').otherwise('<div class="documento">'),
        part("Processo", F.concat(F.lit("REsp "), "doc_id", F.lit(" / SP<br>RECURSO ESPECIAL"))),
        part("Relator", F.concat(F.lit("Ministro  "), F.coalesce("source", F.lit("")), F.lit(" (1128)"))),
        part("Data da Publicação/Fonte", issue),
        part("Ementa", T.xml_escape(F.coalesce("text", F.lit("")))),
        part("Ementa", F.lit("outra")),
        F.lit("</div><footer>fim</footer>"),
    )
    return t.documents.select("doc_id", page.alias("html"))


query(
    "src_html_single_doc",
    r"""select doc_id, 'REsp ' || doc_id as numero, trim('Ministro ' || coalesce(source, '')) as relator, 'Superior Tribunal de Justiça' as orgao,
case when doc_id % 5 = 0 then '' else 'DJEN 0' || (1 + doc_id % 9) || '/10/2025' end as publicado, 'ACOR' as tipo,
trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) as ementa from documents where doc_id % 3 > 0""",
)(lambda t: _single(t).select("doc_id", D.single_document(F.col("html")).alias("d")).where("d is not null").select("doc_id", "d.numero", "d.relator", "d.orgao", "d.publicado", "d.tipo", "d.ementa"))

# --- bodies of several parts ------------------------------------------------------------------------------------------
query("src_multipart_pdf", "select doc_id, case when doc_id % 4 > 0 then '%PDF-1.4 ' || coalesce(text, '') || ' %%EOF' || chr(10) || coalesce(text, '') || '%%EOF' end as body from documents")(
    lambda t: t.documents.select(
        "doc_id",
        F.decode(S.cut_pdf(F.encode(F.concat(F.lit("--b\r\n%%EOF\r\n"), F.when(F.col("doc_id") % 4 > 0, "%PDF-1.4 ").otherwise("PDF "), F.coalesce("text", F.lit("")), F.lit(" %%EOF\n"), F.coalesce("text", F.lit("")), F.lit("%%EOF\r\n--b--")), "UTF-8")), "UTF-8").alias("body"),
    )
)

# --- headers of lists -------------------------------------------------------------------------------------------------
def _headers() -> Column:
    """Six paragraphs: the sixth is no header, every second list corrects its panel in the fifth, some lack a session or a cabinet."""
    return F.array(
        _first(),
        F.concat(F.lit("Julgamentos da "), 1 + F.col("doc_id") % 7, F.lit("ª Turma")),
        F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("Sessão de julgamento: 0"), 1 + F.col("doc_id") % 9, F.lit("/08/2025"))).otherwise("Sessão: a marcar"),
        F.when(F.col("doc_id") % 4 > 0, F.concat(F.lit("Gab. 5 - Des. Fulano de "), F.coalesce("lang", F.lit("")))).otherwise("Gabinete"),
        F.when(F.col("doc_id") % 2 == 0, "8 TURMA").otherwise(""),
        F.lit("9ª Turma - sessão: 01/01/2020 - gab - des. Outro"),
    )


query(
    "fn_list_metadata",
    """select doc_id, case when doc_id % 2 = 0 then '8ª Turma' else (1 + doc_id % 7) || 'ª Turma' end as turma, case when doc_id % 3 > 0 then '0' || (1 + doc_id % 9) || '/08/2025' end as sessao,
case when doc_id % 4 > 0 then trim('Des. Fulano de ' || coalesce(lang, '')) end as gabinete from documents""",
)(lambda t: t.documents.select("doc_id", T.list_header(_headers()).alias("h")).select("doc_id", "h.*"))

# --- order of articles -----------------------------------------------------------------------------------------------
query(
    "srt_article_numeric",
    """select p_partkey, case when p_partkey % 3 = 0 then 0 else cast(regexp_extract(p_brand, '[0-9]+') as bigint) end as article,
row_number() over (order by case when p_partkey % 3 = 0 then 0 else cast(regexp_extract(p_brand, '[0-9]+') as bigint) end, p_partkey) as place from part""",
)(lambda t: _articles(t))


def _articles(t: Tables) -> DataFrame:
    """All parts in the order of the number that their article begins with, places dealt over ranges; text without one is 0."""
    article = F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise(F.concat(F.lit(" "), F.regexp_extract("p_brand", "[0-9]+", 0), F.lit("-A bis")))
    keys = t.part.select(F.struct(T.leading_number(article).alias("article"), "p_partkey").alias("k"))
    return positions(keys, "k").select("k.p_partkey", "k.article", (F.col("pos") + 1).alias("place"))


# --- topics, anchors, logs --------------------------------------------------------------------------------------------
def _citations(t: Tables) -> DataFrame:
    """Numbers of two to four digits that the lines of texts name: topic, document, line."""
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "body"))
    return lines.select(F.explode(F.regexp_extract_all("body", F.lit(r"(\b[0-9]{2,4}\b)"), F.lit(1))).alias("topic"), F.col("doc_id").alias("doc"), (F.col("line") + 1).alias("paragraph"))


query(
    "fts_topic_map",
    r"""with l as (select doc_id, unnest(string_split(text, chr(10))) as body, generate_subscripts(string_split(text, chr(10)), 1) as paragraph from documents),
c as (select unnest(regexp_extract_all(body, '\b[0-9]{2,4}\b')) as topic, doc_id, paragraph from l), n as (select topic, doc_id, paragraph, count(*) as n from c group by all)
select topic, doc_id as doc, cast(sum(n) as bigint) as cited, string_agg(paragraph || case when n > 1 then '(' || n || 'x)' else '' end, ', ' order by n desc, paragraph) as paragraphs from n group by topic, doc_id""",
)(lambda t: O.topic_documents(_citations(t)))
query(
    "jn_anchor",
    """with c as (select c_custkey, strip_accents(lower(r.r_name || ' ' || n_name || ' ' || c_name)) as name from customer join nation on c_nationkey = n_nationkey join region r on n_regionkey = r_regionkey)
select c_custkey, min_by(r_name, r_regionkey) as anchor from c left join region on contains(name, strip_accents(lower(r_name))) group by c_custkey""",
)(
    lambda t: t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "c_custkey", O.first_anchor(F.concat_ws(" ", "r_name", "n_name", "c_name"), O.curated(t.region, "r_name", "r_name", "r_regionkey")).alias("anchor")
    )
)


def _logged(t: Tables) -> DataFrame:
    """Calls of two kinds appended one after the other to one log, read back."""
    path = S.scratch(t.spark, "calls")
    calls = t.events.select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"), F.col("event_type").alias("busca"), F.col("event_id").alias("n"), F.col("props").alias("texto"))
    for kind in (F.col("busca") == "error", F.col("busca") != "error"):
        O.append_log(calls.where(kind), path, ["texto"])
    return S.jsonl_log(t.spark, path, "ts string, busca string, n bigint, texto string")


query("snk_query_log", "select event_type as busca, count(*) as n, cast(sum(event_id) as bigint) as total, cast(0 as bigint) as texts from events group by event_type")(
    lambda t: _logged(t).where("valid").groupBy("busca").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("total"), F.count("texto").alias("texts"))
)
