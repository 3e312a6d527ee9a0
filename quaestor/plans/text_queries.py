"""Scalar functions applied to whole tables (documents, pages), each with its SQL twin."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as T
from .registry import before, query

FOLD = "strip_accents(lower({}))"
#: Words that name terms leave out: articles, prepositions, query operators.
STOP = ["and", "e", "et", "for", "of", "or", "ou", "the", "to", "y"]


def on_documents(name: str, column: Callable[[], Column], sql: str) -> None:
    """A query (doc_id, value) over documents; sql is the expression of value."""
    query(name, f"select doc_id, {sql} as value from documents")(lambda t: t.documents.select("doc_id", column().alias("value")))


def on_pages(name: str, column: Callable[[], Column], sql: str) -> None:
    query(name, f"select page_id, {sql} as value from pages")(lambda t: t.pages.select("page_id", column().alias("value")))


@before
def columns() -> None:
    """Stand-in inputs of the queries below, made anew for each session."""
    global text, url, html, doc_id, labelled, ruling, case, parties, paper, YEAR, iso, br, spanish, kind, name, title, raw, law, search
    text, url, html, doc_id = F.col("text"), F.col("url"), F.col("html"), F.col("doc_id")
    labelled = F.when(doc_id % 2 == 1, F.concat(F.lit("Acordam. EMENTA: "), text)).otherwise(text)
    ruling = F.concat(F.lit("EMENTA PODER JUDICIARIO x EMENTA 0059104-96.2025 EMENTA: "), F.replace(text, F.lit("\n"), F.lit(" ")), F.lit(" RELATÓRIO "), text)
    case = F.concat(F.lit("APELANTE: A\nADVOGADO B\n"), F.when(doc_id % 2 == 1, "EMENTA\n").otherwise(""), text)
    # a name may hold the words that end it: they are broken by a backslash, as markup is escaped elsewhere
    spelled = F.regexp_replace(F.replace(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("\\"), F.lit("\\\\")), r"(?i)A(?=PELADO|DVOGADO)", r"$0\\")
    parties = F.concat(F.coalesce(F.concat(F.lit("Apelante: "), spelled, F.lit(" ")), F.lit("")), F.lit("Apelado: B ADVOGADO C"))
    paper = F.concat(url, F.lit("_ESP"), F.col("page_id") % 3, F.lit(".pdf"))
    YEAR = F.lit(1990) + doc_id % 40
    iso = F.format_string("%04d-%02d-%02d", YEAR, 1 + doc_id % 12, 1 + doc_id % 28)
    br = F.format_string("%02d/%02d/%04d", 1 + doc_id % 28, 1 + doc_id % 12, YEAR)
    spanish = F.concat(F.lit("San José, "), (1 + doc_id % 28).cast("string"), F.lit(" de "), F.element_at(F.array(*map(F.lit, T.MONTHS_ES)), (1 + doc_id % 12).cast("int")), F.lit(" de "), YEAR.cast("string"))
    kind = F.element_at(F.array(F.lit("CC"), F.lit("OC"), F.lit("SS"), F.lit("MP")), (1 + doc_id % 4).cast("int"))
    name = F.concat(F.lit("Caso Gomes "), F.regexp_replace(text, r"[\s.]+", " "), F.lit(" e outros Vs. Brasil"))
    title = F.concat(F.lit("Corte IDH. Caso Nome "), doc_id, F.lit(" Vs. Chile. Fondo y Reparaciones. Sentencia de 1 de mayo de 2001. Serie C No. 7"))
    raw = F.lpad(F.concat(doc_id.cast("string"), F.lit("20254058103")), 20, "0")
    law = F.when(doc_id % 6 == 0, F.concat(F.lit("Lei nº 8."), F.lpad(doc_id % 1000, 3, "0"), F.lit("/93"))).when(doc_id % 6 == 1, "LC 80").when(doc_id % 6 == 2, "Decreto-Lei 4.657").when(doc_id % 6 == 3, "Medida Provisória 2.164-41").when(doc_id % 6 == 4, "Decreto n. 03.048").otherwise("Portaria 5")
    search = F.concat(F.regexp_replace(text, "[^A-Za-z ]", " "), F.when(doc_id % 2 == 0, " adj5 Zeta").otherwise(" Zeta alfa"))


S = {"F": FOLD.format("text")}
ALNUM = f"regexp_replace({S['F']}, '[^a-z0-9]', '', 'g')"
KEY = f"regexp_replace({ALNUM}, '^ementa', '')"
UNESC = "replace(replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')"
CLEAN = "trim(regexp_replace(regexp_replace(" + UNESC + r", '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))"
TRIMMED = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"

on_documents("fn_fold", lambda: T.fold(text), S["F"])
on_documents("fn_fold_same_length", lambda: F.length(T.fold(text)).cast("bigint"), "cast(length(text) as bigint)")
on_documents("fn_fold_ordinal", lambda: T.fold_ordinal(F.concat(F.lit("1ª Turma, 2º grau:  "), text)), f"trim(regexp_replace(translate({FOLD.format(chr(39) + '1ª Turma, 2º grau:  ' + chr(39) + ' || text')}, 'ªº', 'ao'), '\\s+', ' ', 'g'))")
on_documents("fn_alnum_key", lambda: T.alnum_key(text), ALNUM)
on_documents("fn_ementa_key", lambda: T.ementa_key(text), f"case when length({KEY}) >= 200 then left({KEY}, 200) end")
on_documents(
    "fn_truncate_tokens",
    lambda: T.truncate_tokens(text, 100),
    """case when length(text) <= 400 then text
            when instr(reverse(left(text, 400)), '.') > 0 and 400 - instr(reverse(left(text, 400)), '.') > 200
              then left(text, 401 - instr(reverse(left(text, 400)), '.')) || ' [...]'
            else left(text, 400) || ' [...]' end""",
)
on_pages("fn_html_clean", lambda: T.html_clean(html), CLEAN.format("html"))
on_pages("fn_full_text_html", lambda: T.full_text_html(html), "array_to_string(list_filter(list_transform(string_split(" + UNESC.format(r"regexp_replace(regexp_replace(html, '(?is)<(?:script|style)\b.*?</(?:script|style)>', '', 'g'), '<[^>]+>', chr(10), 'g')") + ", chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10))")
on_pages("fn_br_to_lines", lambda: T.br_to_lines(html), "regexp_replace(" + TRIMMED.format(r"regexp_replace(replace(" + UNESC.format(r"regexp_replace(regexp_replace(html, '(?i)<br\s*/?>', chr(10), 'g'), '<[^>]+>', '', 'g')") + r", chr(13), ''), '[ \t]+\n', chr(10), 'g')") + r", '\n{3,}', chr(10) || chr(10), 'g')")
LABELLED = "case when doc_id % 2 = 1 then 'Acordam. EMENTA: ' || text else text end"
on_documents("fn_ementa_section", lambda: T.ementa_section(labelled), f"case when regexp_matches({CLEAN.format(LABELLED)}, '(EMENTA|Ementa)') then trim(regexp_extract({CLEAN.format(LABELLED)}, '(?s)(?:EMENTA|Ementa)\\s*[:\\-]?\\s*(.+)$', 1)) else trim(left({CLEAN.format(LABELLED)}, 2000)) end")
on_documents("fn_ementa_julia", lambda: T.ementa_report(ruling), "trim(replace(text, chr(10), ' '))")
CASE = "'APELANTE: A' || chr(10) || 'ADVOGADO B' || chr(10) || case when doc_id % 2 = 1 then 'EMENTA' || chr(10) else '' end || text"
on_documents("fn_ementa_app", lambda: T.ementa_of_case(case), r"case when doc_id % 2 = 1 then regexp_replace(trim(text), '\n{3,}', chr(10) || chr(10), 'g') else regexp_replace(array_to_string(list_filter(string_split(text, chr(10)), lambda x: not regexp_matches(upper(x), 'APELANTE:|APELADO:|ADVOGADO|AUTOR:|REU:')), chr(10)), '^\s+|\s+$', '', 'g') end")
PARTY_WORDS = ["APELANTE", "APELADO", "AUTOR", "REU", "ADVOGADO", "IMPETRANTE", "IMPETRADO"]
# every third line of the text names a party; a line with EMENTA ends the search in every other document
PARTY_LINES = "list_transform(string_split(text, chr(10)), lambda x, i: case when i % 3 = 1 then 'Advogado ' || x when i = 5 and doc_id % 2 = 1 then 'Ementa do autor' else x end)"
on_documents(
    "fn_parties_app",
    lambda: T.lines_with(F.array_join(F.transform(F.split(text, "\n"), lambda x, i: F.when(i % 3 == 0, F.concat(F.lit("Advogado "), x)).when((i == 4) & (doc_id % 2 == 1), "Ementa do autor").otherwise(x)), "\n"), PARTY_WORDS),
    f"array_to_string(list_transform(list_filter(case when list_position(list_transform({PARTY_LINES}, lambda x: contains(upper(x), 'EMENTA')), true) > 0 then {PARTY_LINES}[1:list_position(list_transform({PARTY_LINES}, lambda x: contains(upper(x), 'EMENTA')), true)] else {PARTY_LINES} end, lambda x: regexp_matches(upper(x), '{'|'.join(PARTY_WORDS)}')), lambda x: trim(x)), chr(10))",
)
query("fn_parties_lib", "select doc_id, trim(replace(text, chr(10), ' ')) as appellant, 'B' as appellee from documents")(
    lambda t: t.documents.select("doc_id", F.regexp_replace(T.party(parties, "APELANTE", ["APELADO", "ADVOGADO"]), r"\\(\\?)", "$1").alias("appellant"), T.party(parties, "APELADO", ["ADVOGADO"]).alias("appellee"))
)
TOPIC_LINES = "list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '' and not starts_with(x, 'Trata-se'))"
on_documents("fn_topic", lambda: T.topic(text), f"case when len(string_split(left(coalesce({TOPIC_LINES}[1], ''), 80), '.')) > 2 then array_to_string(string_split(left(coalesce({TOPIC_LINES}[1], ''), 80), '.')[1:3], '.') || '.' else left(coalesce({TOPIC_LINES}[1], ''), 80) end")
on_documents("fn_clean_ementa", lambda: T.clean_lines(text), "array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10))")
on_documents("fn_limpar_texto", lambda: T.replace_broken(F.concat(F.lit("�x"), text)), "'ax' || replace(text, chr(65533), 'a')")
on_documents(
    "fn_markdown_strip",
    lambda: T.markdown_strip(F.concat(F.lit("## Head\n**bold** [a](b) `c` “q” — x\n"), text)),
    TRIMMED.format(
        "translate("
        + r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace('## Head' || chr(10) || '**bold** [a](b) `c` “q” — x' || chr(10) || text, '(?m)^#{1,3}\s+(.+)$', chr(10) || '\1' || chr(10), 'g'), '\*\*([^*]+)\*\*', '\1', 'g'), '\*([^*]+)\*', '\1', 'g'), '__([^_]+)__', '\1', 'g'), '_([^_]+)_', '\1', 'g'), '\[([^\]]+)\]\([^)]+\)', '\1', 'g'), '(?m)^>\s*', '', 'g'), '(?s)```[^`]*```', '', 'g'), '`([^`]+)`', '\1', 'g'), '(?m)^[\-*]{3,}$', chr(10) || repeat('-', 50) || chr(10), 'g'), '(?m)^[\-*]\s+', '- ', 'g'), '\n{3,}', chr(10) || chr(10), 'g')"
        + ", '•–—“”‘’', '---\"\"''''')"
    ),
)
query("fn_risk_label", "select o_orderkey, case o_orderstatus when 'O' then 'VERDE - Alinhado' when 'F' then 'VERMELHO - Divergente' else 'Nao avaliado' end as value from orders")(
    lambda t: t.orders.select("o_orderkey", T.risk_label(F.when(F.col("o_orderstatus") == "O", "verde").when(F.col("o_orderstatus") == "F", "vermelho").otherwise(F.col("o_orderstatus"))).alias("value"))
)
on_documents("fn_word_controls", lambda: T.word_controls(F.concat(F.lit("\x13 LINK \x14shown\x15\x13gone\x15 a\x07b\x1e"), text)), TRIMMED.format(r"regexp_replace('shown a' || chr(9) || 'b-' || regexp_replace(text, '[ \t]+\n', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g')"))
on_documents("fn_url_strip", lambda: T.url_strip(text), r"trim(regexp_replace(regexp_replace(text, '(?i)(dispon[ií]vel em:?\s*)?https?://\S+', '', 'g'), '[ \t]{2,}', ' ', 'g'))")
POS = "least(nullif(instr(" + FOLD.format("text") + ", 'tion'), 0), nullif(instr(" + FOLD.format("text") + ", 'eau'), 0))"
on_documents(
    "fn_snippet",
    lambda: T.snippet(text, ["tion", "eau"], 240),
    f"""case when {POS} is null then left(text, 240) || case when length(text) > 240 then ' [...]' else '' end
        else case when {POS} - 1 - 80 > 0 then '[...] ' else '' end
             || substr(text, greatest(0, {POS} - 81) + 1, 240)
             || case when greatest(0, {POS} - 81) + 240 < length(text) then ' [...]' else '' end end""",
)
on_documents("fn_suspect_regex", lambda: T.suspect(F.concat(text, F.when(doc_id % 3 == 0, " Cf. nota").otherwise(""))), "doc_id % 3 = 0 or regexp_matches(text, '\\bCfr?\\.')")
on_documents("fn_sanitize_xml", lambda: T.sanitize_xml(F.concat(F.lit("a--b "), text)), "replace('a--b ' || text, '--', '—')")
on_documents("fn_latin1_typography", lambda: T.latin1_typography(F.concat(F.lit("“a” – ‘b’ — "), text)), "'\"a\" - ''b'' - ' || translate(text, '“”‘’–—', '\"\"''''--')")
on_documents("fn_sha256", lambda: F.sha2(text, 256), "sha256(text)")
on_documents("fn_is_pdf", lambda: F.substring(F.encode(F.when(doc_id % 2 == 0, F.concat(F.lit("%PDF-1"), text)).otherwise(text), "UTF-8"), 1, 5) == F.encode(F.lit("%PDF-"), "UTF-8"), "doc_id % 2 = 0 or starts_with(text, '%PDF-')")
on_pages("fn_fold_entities", lambda: T.fold_entities(html), r"regexp_replace(translate(" + FOLD.format(UNESC.format("regexp_replace(html, '<[^>]+>', ' ', 'g')")) + r", '’‘‐‑', '''''--'), '\s+', ' ', 'g')")
on_pages("fn_host_norm", lambda: T.host_norm(url), "regexp_replace(url, '(?i)^https?://(www\\.)?', 'https://www.')")
on_pages("fn_url_lang", lambda: T.url_of_language(F.when(F.col("page_id") % 2 == 0, paper).otherwise(url), "por"), "case when page_id % 2 = 0 then url || '_por' || (page_id % 3) || '.pdf' end")
on_pages("fn_pagination", lambda: T.pagination(F.format_string("Exibindo %d - %d de 4.%03d, Página: 1/%d", F.col("page_id"), F.col("page_id") + 30, F.col("page_id") % 1000, F.lit(7)))["total"], "4000 + page_id % 1000")

ISO = "printf('%04d-%02d-%02d', 1990 + doc_id % 40, 1 + doc_id % 12, 1 + doc_id % 28)"
PT = "['" + "','".join(T.MONTHS_PT) + "']"
LONG = f"((1 + doc_id % 28) || ' de ' || {PT}[1 + doc_id % 12] || ' de ' || (1990 + doc_id % 40))"
query("fn_date_parse", f"select doc_id, case when doc_id % 3 = 2 then null else cast({ISO} as date) end as value from documents")(lambda t: t.documents.select("doc_id", T.date_of(F.when(doc_id % 3 == 0, iso).when(doc_id % 3 == 1, br).otherwise("?")).alias("value")))
on_documents("fn_date_long", lambda: T.date_long(F.when(doc_id % 4 == 0, F.lit(None)).when(doc_id % 4 == 1, "s/d").otherwise(iso)), f"case when doc_id % 4 = 0 then '' when doc_id % 4 = 1 then 's/d' else {LONG} end")
on_documents("fn_date_es", lambda: T.date_es(F.when(doc_id % 5 == 0, text).otherwise(spanish)), f"case when doc_id % 5 = 0 then null else {ISO} end")
on_documents(
    "fn_citation",
    lambda: T.citation(F.concat(F.lit("Nome "), doc_id, F.lit(" Vs. Brasil")), F.when(doc_id % 5 > 0, iso), F.when(doc_id % 2 == 0, "C"), F.when(doc_id % 3 > 0, doc_id), F.when(doc_id % 7 > 0, doc_id % 90), F.when(doc_id % 6 == 0, "Mérito"), kind, F.when(doc_id % 8 == 0, "http://x/a.pdf")),
    f"""'Corte IDH. ' || case when doc_id % 4 = 1 then 'Nome ' || doc_id || ' Vs. Brasil.' else 'Caso Nome ' || doc_id || ' Vs. Brasil.' end || ' '
      || case doc_id % 4 when 2 then 'Supervisão de Cumprimento de Sentença. Resolução' else case when doc_id % 6 = 0 then 'Mérito. ' else '' end
           || case doc_id % 4 when 0 then 'Sentença' when 3 then 'Decisão' else 'Parecer Consultivo OC-' || coalesce(case when doc_id % 3 > 0 then cast(doc_id as varchar) end, '') || '/' || case when doc_id % 5 > 0 then substr({ISO}, 3, 2) else '00' end end end
      || case when doc_id % 5 > 0 then ' de ' || {LONG} else '' end || '.'
      || case when doc_id % 4 = 3 then ' [tipo MP — rótulo canônico não definido]' else '' end
      || case when doc_id % 2 = 0 or doc_id % 3 > 0 then ' ' || concat_ws(' ', case when doc_id % 2 = 0 then 'Série C' end, case when doc_id % 3 > 0 then 'No. ' || doc_id end) || case when doc_id % 7 > 0 then ', par. ' || (doc_id % 90) else '' end || '.'
              when doc_id % 7 > 0 then ' Par. ' || (doc_id % 90) || '.' else '' end
      || case when doc_id % 8 = 0 then ' Disponível em: http://x/a.pdf' else '' end""",
)
on_documents("fn_state_of_case", lambda: T.state_of_case(F.concat(F.replace(text, F.lit("\n"), F.lit(" ")), F.when(doc_id % 3 == 0, " Vs. Perú.").when(doc_id % 3 == 1, " Vs. País 9").otherwise(""))), "case when doc_id % 3 = 0 then 'Perú' end")
CORE = r"'Gomes ' || regexp_replace(text, '[\s.]+', ' ', 'g') || ' e outros'"
on_documents("fn_core_name", lambda: T.core_name(name), CORE)
query("fn_name_terms", f"select doc_id, array_to_string(list_filter(regexp_split_to_array({CORE}, '[^0-9A-Za-zÀ-ÿ]+'), lambda w: length(w) > 1 and not list_contains({STOP}, {FOLD.format('w')}))[1:4], ' ') as value from documents")(
    lambda t: t.documents.select("doc_id", F.array_join(T.name_terms(name, STOP), " ").alias("value"))
)
query("fn_title_decompose", "select doc_id, 'Nome ' || doc_id || ' Vs. Chile' as name, 'Fondo y Reparaciones' as stage from documents")(lambda t: t.documents.select("doc_id", T.title_parts(title).alias("p")).select("doc_id", "p.name", "p.stage"))
RAW = "lpad(doc_id || '20254058103', 20, '0')"
CNJ = f"substr({RAW},1,7) || '-' || substr({RAW},8,2) || '.' || substr({RAW},10,4) || '.' || substr({RAW},14,1) || '.' || substr({RAW},15,2) || '.' || substr({RAW},17,4)"
on_documents("fn_cnj_format", lambda: T.cnj_format(F.when(doc_id % 4 == 0, "123").otherwise(raw)), f"case when doc_id % 4 = 0 then '' else {CNJ} end")
on_documents("fn_cnj_digits", lambda: T.digits(T.cnj_format(raw)), RAW)
on_documents("fn_is_cnj", lambda: T.is_cnj(F.when(doc_id % 2 == 0, T.cnj_format(raw)).otherwise(raw)), "doc_id % 2 = 0")
on_documents("fn_process_number", lambda: T.process_number(F.when(doc_id % 3 == 0, F.concat(F.lit("AgInt no REsp 2.098."), F.lpad(doc_id % 1000, 3, "0"), F.lit("/RO"))).when(doc_id % 3 == 1, F.concat(F.lit("Tema "), doc_id)).otherwise("AREsp 12345")), "case doc_id % 3 when 0 then '2098' || lpad(cast(doc_id % 1000 as varchar), 3, '0') when 2 then '12345' end")
on_documents("fn_law_norm", lambda: T.law_norm(law), "case doc_id % 6 when 0 then 'LEI-8' || lpad(cast(doc_id % 1000 as varchar), 3, '0') when 1 then 'LCP-80' when 2 then 'DEL-4657' when 3 then 'MPR-2164' when 4 then 'DEC-3048' end")
#: SQL of search_key over a column q; accents go first, then all but plain signs.
SEARCH_KEY = r"""o as (select *, regexp_matches(q, '(?i)["()]|(^|\s)(e|ou|and|or|nao|não|not|adj[0-9]*|prox[0-9]*|com[0-9]*|mesmo[0-9]*)(\s|$)|(^|\s)-\S') as ordered from s),
     w as (select *, list_transform(list_filter(string_split(regexp_replace(regexp_replace(strip_accents(q), '[^0-9A-Za-z\s*$+-]', ' ', 'g'), '\s+', ' ', 'g'), ' '), lambda x: x <> ''), lambda x: case when x in ('E', 'OU', 'NAO', 'AND', 'OR', 'NOT') then x else lower(x) end) as l from o),
     v as (select *, array_to_string(case when ordered then l else list_sort(list_distinct(l)) end, ' ') as value from w)"""


def _requests(t):
    """A nested request of each document, its fields in one of two orders, the text as it is or in capitals."""
    text, n = F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(F.translate("text", string.ascii_lowercase, string.ascii_uppercase)).alias("buscaGeral"), F.col("doc_id").alias("tamanho")
    noise = F.lit('a "query":"B  a" é').alias("nota")
    one = F.to_json(F.struct(F.lit("bnp").alias("mcp"), F.struct(text, F.array(F.struct(n, noise)).alias("lista")).alias("filtro"), F.lit("Zeta  ALFA, é").alias("query")))
    two = F.to_json(F.struct(F.lit("é; alfa zeta").alias("query"), F.struct(F.array(F.struct(noise, n)).alias("lista"), text).alias("filtro"), F.lit("bnp").alias("mcp")))
    return t.documents.select("doc_id", F.when(F.col("doc_id") % 3 == 0, one).otherwise(two).alias("request"))


query(
    "fn_cache_key",
    rf"""with s as (select doc_id, case when doc_id % 2 = 0 then text else translate(text, '{string.ascii_lowercase}', '{string.ascii_uppercase}') end as q from documents), {SEARCH_KEY}
select doc_id, sha256('{{"filtro":{{"buscaGeral":"' || value || '","lista":[{{"nota":"a \"query\":\"B  a\" é","tamanho":' || doc_id || '}}]}},"mcp":"bnp","query":"alfa e zeta"}}') as key from v""",
)(lambda t: _requests(t).select("doc_id", T.request_key(F.col("request")).alias("key")))
query("fn_search_key", f"with s as (select doc_id, text as q from documents), {SEARCH_KEY} select doc_id, value from v")(lambda t: t.documents.select("doc_id", T.search_key(text).alias("value")))
query("fn_sanitize_query", r"""select doc_id, trim(regexp_replace(regexp_replace('auxílio-doença ' || text, '[#!+'';_|-]', ' ', 'g'), '\s+', ' ', 'g')) as query,
  array_to_string(list_sort(list_distinct(regexp_extract_all('auxílio-doença ' || text, '[#!+'';_|-]'))), '') as removed from documents""")(
    lambda t: t.documents.select("doc_id", T.sanitize_query(F.concat(F.lit("auxílio-doença "), text)).alias("s")).select("doc_id", "s.query", F.array_join("s.removed", "").alias("removed"))
)
