"""Queries on the services' JSON answers, made from the tables in the shapes that the services send; SQL restates each rule on the columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources import answers as A
from .portal_queries import escaped
from .registry import query

COLLAPSED = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"
doc = lambda: F.col("doc_id")


def on(n: int, k: int, value: Column | str, other: Column | str | None = None) -> Column:
    """value in documents whose id leaves k by n: a field that is there in some answers only."""
    lit = lambda x: F.lit(x) if isinstance(x, str) or x is None else x
    return F.when(doc() % n == k, lit(value)).otherwise(lit(other))


def obj(**fields: Column | str) -> Column:
    return F.to_json(F.struct(*[(F.lit(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()]))


query(
    "src_elastic_json",
    f"""select doc_id, case when doc_id % 2 = 0 then 'AC ' || doc_id else '000' || doc_id end as numero, nullif({COLLAPSED}, '') as ementa, case when doc_id % 3 = 0 then '05/06/2020' end as data, case doc_id % 4 when 0 then 'http://a/' || doc_id when 1 then 'http://b' end as link,
  case when doc_id % 5 = 0 then 'true' end as relevante, case when lang = 'en' then 'STF' else 'TRF5' end as tribunal, case when lang = 'en' then 'sem data nem órgão' end as aviso,
  3 + (doc_id % 3 = 0)::int + (doc_id % 4 < 2)::int + (doc_id % 5 = 0)::int + (lang = 'en')::int - ({COLLAPSED} = '')::int as fields from documents""",
)(lambda t: _federal(t))


def _federal(t):
    body = T.one_line(F.col("text"))
    made = obj(
        PROCESSO_CITACAO=on(2, 0, F.concat(F.lit(" AC "), doc()), " "), PROCESSO=F.concat(F.lit("000"), doc()), EMENTA=F.concat(F.lit("EMENTA  "), body), DATA_DECISAO=on(3, 0, "2020-06-05T00:00:00", "sem data"),
        LINK_INTEIRO_TEOR=on(4, 0, F.concat(F.lit("http://a/"), doc()), ""), INTEIRO_TEOR=on(4, 1, "http://b", "texto"), PRECEDENTE_RELEVANTE=on(5, 0, "1", "0"), TRIBUNAL=F.when(F.col("lang") == "en", "stf").otherwise("trf5"), CLASSE="  ",
    )
    m = F.col("m")
    whole = doc().isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull()  # SQL's count is null where one of them is
    return t.documents.select("doc_id", whole.alias("whole"), A.federal_record(made).alias("m")).select("doc_id", m["numero"].alias("numero"), m["ementa"].alias("ementa"), m["data_julgamento"].alias("data"), m["link_inteiro_teor"].alias("link"), m["precedente_relevante"].alias("relevante"), m["tribunal"].alias("tribunal"), m["aviso"].alias("aviso"), F.when(F.col("whole"), F.size("m")).alias("fields"))


query(
    "src_stf_json",
    f"""select doc_id, case when doc_id % 3 = 0 then 'RE ' || doc_id else 'Título ' || lang end as number, case doc_id % 5 when 0 then 'Súmula Vinculante' when 1 then 'Súmula' when 2 then 'Informativo' when 3 then 'Recurso' else 'ACORDAOS' end as kind,
  case when doc_id % 2 = 0 then 'B' end as writer, case when doc_id % 4 = 0 then '2020' else '2019' end as date, case when doc_id % 2 = 0 then {COLLAPSED} else 'indexação ' || source end as content, case when doc_id % 2 = 0 then 'Tema ' || doc_id else 'texto' end as theme, case when doc_id % 7 = 0 then 'Pleno' else 'Supremo Tribunal Federal' end as organ from documents""",
)(lambda t: _supreme(t))


def _supreme(t):
    body = F.trim(F.regexp_replace("text", r"\s+", " "))
    safe = escaped(body)
    content = on(2, 0, F.when(doc() % 4 == 0, F.concat(F.lit("<p>"), safe, F.lit("</p>"))), "")
    source = F.struct(
        F.element_at(F.array(*map(F.lit, ("sumulas", "sumulas", "novo_informativo", "acordaos", ""))), (doc() % 5 + 1).cast("int")).alias("base"), (doc() % 5 == 0).alias("is_vinculante"), on(3, 0, F.concat(F.lit("RE "), doc()), " ").alias("processo_codigo_completo"), F.concat(F.lit("Título "), "lang").alias("titulo"),
        on(5, 3, "Recurso", "").alias("processo_classe_processual_unificada_extenso"), F.lit("A").alias("relator_processo_nome"), on(2, 0, "B", "A").alias("relator_acordao_nome"), on(4, 0, "2020", "").alias("publicacao_data"), F.lit("2019").alias("julgamento_data"),
        content.alias("ementa_texto"), on(2, 0, F.when(doc() % 4 != 0, safe), None).alias("decisao_texto"), F.concat(F.lit("indexação "), "source").alias("documental_indexacao_texto"), on(2, 0, doc().cast("string"), "texto").alias("documental_tese_tema_texto"), on(7, 0, "Pleno").alias("orgao_julgador"),
    )
    return t.documents.select("doc_id", A.supreme_record(F.to_json(F.struct(source.alias("_source"))), "acordaos").alias("r")).select("doc_id", "r.number", "r.kind", "r.writer", "r.date", "r.content", "r.theme", "r.organ")


query(
    "src_bnp_json",
    r"""select doc_id, 'RG ' || doc_id as number, source as organ, concat_ws(chr(10) || chr(10), case when length(trim(text)) > 0 then 'QUESTÃO JURÍDICA: ' || trim(text) end, case when doc_id % 2 = 0 then 'TESE: ' || lang end, case when doc_id % 3 > 0 then 'PROCESSOS PARADIGMA: ' || case when doc_id % 3 = 1 then 'P1' else 'P1, P' || doc_id end end) as content, case when doc_id % 3 = 2 then 'http://p' end as source from documents""",
)(lambda t: _precedents(t))


def _precedents(t):
    case = lambda n, link: F.struct(n.alias("numero"), F.lit(link).alias("link"))
    none = F.array().cast("array<struct<numero:string,link:string>>")
    cases = F.when(doc() % 3 == 1, F.array(case(F.lit("P1"), ""), case(F.lit(""), "http://x"))).when(doc() % 3 == 2, F.array(case(F.lit("P1"), "http://p"), case(F.concat(F.lit("P"), doc()), "http://q"))).otherwise(none)
    one = F.struct(F.lit("RG").alias("tipo"), doc().cast("string").alias("nr"), F.col("source").alias("orgao"), F.col("text").alias("questao"), on(2, 0, F.col("lang"), "").alias("tese"), cases.alias("processosParadigma"))
    return t.documents.select("doc_id", F.explode(A.precedent_records(F.to_json(F.struct(F.array(one).alias("resultados"))))).alias("r")).select("doc_id", "r.*")


query(
    "src_sjur_json",
    f"""select doc_id, case doc_id % 4 when 0 then 'CNJ ' || doc_id when 1 then lpad(cast(doc_id as varchar), 7, '0') || '-12.2020.6.00.0000' when 2 then 'AE nº ' || doc_id || ', acórdão nº 9' end as number, doc_id % 4 > 1 as without_cnj, case when doc_id % 2 = 0 then 'Agravo (AE)' else 'Agravo' end as class, case when doc_id % 3 = 0 then 'Min. A; B' else '' end as judges, nullif({COLLAPSED}, '') as summary, doc_id % 4 = 3 and {COLLAPSED} = '' as hollow from documents""",
)(lambda t: _electoral(t))


def _electoral(t):
    who = lambda a, b: F.struct(F.lit(a).cast("string").alias("descricaoCompleta"), F.lit(b).cast("string").alias("nome"))
    made = obj(
        numeroUnicoFormatado=on(4, 0, F.concat(F.lit("CNJ "), doc()), " "), numeroUnico=on(4, 1, F.concat(F.lpad(doc().cast("string"), 7, "0"), F.lit("1220206000000")), "123"), numeroProcesso=on(4, 2, doc().cast("string"), ""), numeroDecisao="9", siglaClasse=on(2, 0, "AE", ""), descricaoClasse="Agravo",
        textoEmenta=F.concat(F.lit("<p>"), escaped(F.col("text")), F.lit("</p>")), relatores=on(3, 0, F.array(who("Min. A", "x"), who(None, "B"), who("", " "))),
    )
    return t.documents.select("doc_id", A.electoral_record(made).alias("r")).select("doc_id", "r.*")


query(
    "src_sentencas_json",
    f"""select doc_id, cast(doc_id % 50 as bigint) as total, 's' || doc_id as id, 'Auditoria ' || source as organ, case when doc_id % 2 = 0 then 'a, ' || lang else '' end as subjects, coalesce(text, '') as text from documents""",
)(
    lambda t: t.documents.select("doc_id", A.sentence_records(F.to_json(F.struct((doc() % 50).alias("total"), F.array(F.struct(F.concat(F.lit("s"), doc()).alias("id_sentenca"), F.lit("1").alias("num_processo"), F.concat(F.lit("  Auditoria \n"), "source").alias("des_orgao"), on(2, 0, F.array(F.lit(" a"), F.lit(""), F.col("lang"))).alias("des_assuntos"), F.col("text").alias("texto"))).alias("sentencas")))).alias("r"))
    .select("doc_id", "r.total", F.explode("r.found").alias("f")).select("doc_id", "total", "f.id", "f.organ", "f.subjects", "f.text")
)
