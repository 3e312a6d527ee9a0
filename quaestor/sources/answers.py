"""Records from the services' JSON answers. What a field is taken from, in which order, stands in lists; an answer out of contract is an error, not an empty one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as T

# Fields of the supreme court's documents that hold the main text, the number and the date, the first that isn't empty counts.
CONTENT = ["ementa_texto", "sumula_texto", "decisao_texto", "resumo_noticia", "conteudo_texto", "documental_indexacao_texto"]
NUMBER = ["processo_codigo_completo", "titulo", "processo_numero"]
DATE = ["publicacao_data", "julgamento_data"]
KIND = ["processo_classe_processual_unificada_extenso", "processo_classe_processual_unificada_classe_sigla"]
BULLETINS = ["informativos", "novo_informativo"]
# Fields of the federal service and their names here.
FEDERAL = {
    "numero": ["PROCESSO_CITACAO", "PROCESSO"],
    "classe": ["CLASSE"],
    "relator": ["RELATOR"],
    "orgao_julgador": ["ORGAO_JULGADOR"],
    "data_julgamento": ["DATA_DECISAO"],
    "fonte_publicacao": ["FONTE_PUBLICACAO"],
    "decisao": ["DECISAO"],
    "ementa": ["EMENTA"],
    "tipo": ["TIPO_DOCUMENTO"],
}


def filled(c: Column) -> Column:
    """Stripped text, null where nothing is left."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def first_of(m: Column, names: list[str]) -> Column:
    return F.coalesce(*[filled(m[n]) for n in names])


def within_contract(c: Column, schema: str, needed: list[str]) -> Column:
    """The answer read by ``schema``; reading one that lacks a needed field fails the job and tells which fields there are."""
    read = F.from_json(c, schema)
    there = F.coalesce(F.json_object_keys(c), F.array())
    whole = F.forall(F.array(*map(F.lit, needed)), lambda n: F.array_contains(there, n))
    told = F.raise_error(F.concat(F.lit("an answer out of contract, with fields: "), F.array_join(F.slice(there, 1, 10), ", ")))
    return F.when(whole, read).otherwise(told.cast(schema if schema.startswith("struct") else f"struct<{schema}>"))


def federal_record(source: Column) -> Column:
    """map of what a document of the federal service has, by its names here: only fields with a value, flags only where they are set."""
    m = F.from_json(source, "map<string,string>")
    link = F.coalesce(filled(m["LINK_INTEIRO_TEOR"]), F.when(filled(m["INTEIRO_TEOR"]).startswith("http"), filled(m["INTEIRO_TEOR"])))
    court = F.upper(F.coalesce(filled(m["TRIBUNAL"]), F.lit("")))
    fields = {n: first_of(m, names) for n, names in FEDERAL.items()}
    fields["ementa"] = F.nullif(F.regexp_replace(fields["ementa"], r"^EMENTA(?:[ \t\n\f\r]+|\z)", ""), F.lit(""))
    fields["data_julgamento"] = F.date_format(T.date_of(F.left(fields["data_julgamento"], F.lit(10))), "dd/MM/yyyy")
    fields |= {"link_inteiro_teor": link, "precedente_relevante": F.when(m["PRECEDENTE_RELEVANTE"] == "1", "true"), "representativo_controversia": F.when(m["REPRESENTATIVO_CONTROVERSIA"] == "1", "true")}
    fields |= {"tribunal": court, "aviso": F.when(court == "STF", "sem data nem órgão")}
    return F.map_filter(F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*fields.values())), lambda k, v: v.isNotNull())


def supreme_record(hit: Column, base: str) -> Column:
    """struct(number, kind, reporter, writer, date, content, theme, organ) of a hit of the supreme court."""
    m = F.from_json(F.get_json_object(hit, "$._source"), "map<string,string>")
    own = F.coalesce(filled(m["base"]), F.lit(base))
    kind = F.when(own == "sumulas", F.when(m["is_vinculante"] == "true", "Súmula Vinculante").otherwise("Súmula")).when(own.isin(BULLETINS), "Informativo").otherwise(first_of(m, KIND))
    reporter, writer = filled(m["relator_processo_nome"]), filled(m["relator_acordao_nome"])
    theme = filled(m["documental_tese_tema_texto"])
    content = T.collapse(T.unescape(F.regexp_replace(first_of(m, CONTENT), r"<[^>]*>", " ")))
    return F.struct(first_of(m, NUMBER).alias("number"), F.coalesce(kind, F.lit(base.upper())).alias("kind"), reporter.alias("reporter"), F.when(~writer.eqNullSafe(reporter), writer).alias("writer"), first_of(m, DATE).alias("date"), content.alias("content"), F.when(theme.rlike(r"^\d+$"), F.concat(F.lit("Tema "), theme)).otherwise(theme).alias("theme"), F.coalesce(filled(m["orgao_julgador"]), F.lit("Supremo Tribunal Federal")).alias("organ"))


PRECEDENT = "resultados array<struct<tipo:string,nr:string,orgao:string,situacao:string,questao:string,tese:string,processosParadigma:array<struct<numero:string,link:string>>>>"


def precedent_records(c: Column) -> Column:
    """array<struct(number, organ, content, source)> of an answer of the precedents' bank: sections that are there, the first case's link."""

    def one(r: Column) -> Column:
        cases = F.filter(F.transform(F.coalesce(r["processosParadigma"], F.array()), lambda p: filled(p["numero"])), lambda x: x.isNotNull())
        parts = [F.concat(F.lit("QUESTÃO JURÍDICA: "), filled(r["questao"])), F.concat(F.lit("TESE: "), filled(r["tese"])), F.when(F.size(cases) > 0, F.concat(F.lit("PROCESSOS PARADIGMA: "), F.array_join(cases, ", ")))]
        return F.struct(F.concat_ws(" ", r["tipo"], r["nr"]).alias("number"), r["orgao"].alias("organ"), F.concat_ws("\n\n", *parts).alias("content"), filled(F.get(r["processosParadigma"], F.lit(0))["link"]).alias("source"))

    return F.transform(F.from_json(c, PRECEDENT)["resultados"], one)


ELECTORAL = "numeroUnicoFormatado string, numeroUnico string, numeroProcesso string, numeroDecisao string, siglaClasse string, descricaoClasse string, textoEmenta string, relatores array<struct<descricaoCompleta:string,nome:string>>"


def electoral_record(c: Column) -> Column:
    """struct(number, without_cnj, class, judges, summary, hollow) of a decision of the electoral service."""
    r = F.from_json(c, ELECTORAL)
    raw = F.when(F.coalesce(filled(r["numeroUnico"]), F.lit("")).rlike(r"^\d{20}$"), F.regexp_replace(filled(r["numeroUnico"]), r"^(\d{7})(\d{2})(\d{4})(\d)(\d{2})(\d{4})$", "$1-$2.$3.$4.$5.$6"))
    cnj = F.coalesce(filled(r["numeroUnicoFormatado"]), raw)
    process = F.trim(F.concat(F.coalesce(filled(r["siglaClasse"]), F.lit("")), F.lit(" nº "), filled(r["numeroProcesso"])))
    other = F.concat(process, F.coalesce(F.concat(F.lit(", acórdão nº "), filled(r["numeroDecisao"])), F.lit("")))
    long, short = filled(r["descricaoClasse"]), filled(r["siglaClasse"])
    judges = F.filter(F.transform(F.coalesce(r["relatores"], F.array()), lambda x: F.coalesce(filled(x["descricaoCompleta"]), filled(x["nome"]))), lambda x: x.isNotNull())
    number, summary = F.coalesce(cnj, other), filled(T.collapse(T.unescape(F.regexp_replace(F.coalesce(r["textoEmenta"], F.lit("")), r"<[^>]*>", " "))))
    return F.struct(number.alias("number"), cnj.isNull().alias("without_cnj"), F.coalesce(F.concat(long, F.lit(" ("), short, F.lit(")")), long, short).alias("class"), F.array_join(judges, "; ").alias("judges"), summary.alias("summary"), (number.isNull() & summary.isNull()).alias("hollow"))


SENTENCES = "total bigint, sentencas array<struct<id_sentenca:string,num_processo:string,des_orgao:string,des_assuntos:array<string>,texto:string>>"


def sentence_records(c: Column) -> Column:
    """struct(total, found array<struct(id, process, organ, subjects, text)>) of an answer of the military courts."""
    r = within_contract(c, SENTENCES, ["total", "sentencas"])
    one = lambda s: F.struct(s["id_sentenca"].alias("id"), s["num_processo"].alias("process"), T.collapse(F.coalesce(s["des_orgao"], F.lit(""))).alias("organ"), F.array_join(F.filter(F.transform(F.coalesce(s["des_assuntos"], F.array()), filled), lambda x: x.isNotNull()), ", ").alias("subjects"), F.coalesce(s["texto"], F.lit("")).alias("text"))
    return F.struct(r["total"].alias("total"), F.transform(F.coalesce(r["sentencas"], F.array()), one).alias("found"))
