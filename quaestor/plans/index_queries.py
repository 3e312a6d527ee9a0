"""Queries on what the written index holds beside words: places, fields, similar words, updates, filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import querylang as Q
from ..operators.cards import cards, case_card
from ..operators.index import Segments
from ..operators.search import Index, index_of
from ..sources.files import scratch
from .registry import Tables, query
from .search_queries import DL, TOK, has, ranked

# --- sentences and paragraphs -------------------------------------------------------------------------------------------
PLACED = r"""par as (select doc_id, unnest(l) as body, generate_subscripts(l, 1) as par from (select doc_id, string_split(strip_accents(lower(text)), chr(10)) as l from documents)),
sen as (select doc_id, par, unnest(l) as body, generate_subscripts(l, 1) as sent from (select doc_id, par, string_split(regexp_replace(body, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) as l from par)),
w as (select doc_id, par, sent, term, row_number() over (partition by doc_id order by par, sent, k) as pos from (select doc_id, par, sent, unnest(l) as term, generate_subscripts(l, 1) as k from (select doc_id, par, sent, regexp_extract_all(body, '[\p{L}\p{N}]+') as l from sen)))"""
#: Each query of the court's dialect, with the condition that SQL puts on pairs of words a, b of one document.
PAIRS = {
    "the ADJ3 and": "b.pos - a.pos between 1 and 3",
    "the PROX2 and": "a.pos <> b.pos and abs(b.pos - a.pos) <= 2",
    "the COM and": "a.par = b.par and a.sent = b.sent",
    "the MESMO and": "a.par = b.par",
}
LONE = {"the NAO COM and": "a.par = b.par and a.sent = b.sent", "the NAO MESMO and": "a.par = b.par", "the NAO ADJ5 and": "b.pos - a.pos between 1 and 5"}


def _cjf_sql() -> str:
    parts = [f"select distinct '{q}' as query, a.doc_id as \"row\" from w a join w b on a.doc_id = b.doc_id where a.term = 'the' and b.term = 'and' and {c}" for q, c in PAIRS.items()]
    parts += [f"select distinct '{q}', a.doc_id from w a where a.term = 'the' and not exists (select 1 from w b where b.doc_id = a.doc_id and b.term = 'and' and {c})" for q, c in LONE.items()]
    parts += [r"select distinct 'th$3e', doc_id from w where regexp_full_match(term, 'th.{0,3}e')", r"select distinct 'th??e', doc_id from w where regexp_full_match(term, 'th..e')"]
    return f"with {PLACED} " + " union all ".join(parts)


def _cjf(t: Tables) -> DataFrame:
    held, out = index_of(t.documents), None
    for q in [*PAIRS, *LONE, "th$3e", "th??e"]:
        one = held.rows(Q.parse(q, "cjf")).select(F.lit(q).alias("query"), "row")
        out = one if out is None else out.unionByName(one)
    return out


query("fts_dialect_cjf_ops", _cjf_sql())(_cjf)


# --- fields ---------------------------------------------------------------------------------------------------------------
def _page_index(t: Tables, name: str = "pages") -> Index:
    body = F.regexp_replace("html", r"<[^>]*>", " ")
    fields = {"title": F.regexp_extract("html", r"<title>([^<]*)", 1), "body": body}
    return index_of(t.pages, "page_id", fields, {"title": 5.0})


FIELDS = r"""f as (select page_id, 'title' as field, 5.0 as weight, regexp_extract(html, '<title>([^<]*)', 1) as body from pages union all select page_id, 'body', 1.0, regexp_replace(html, '<[^>]*>', ' ', 'g') from pages),
tok as (select page_id, field, weight, unnest(l) as term, len(l) as dl from (select page_id, field, weight, regexp_extract_all(strip_accents(lower(body)), '[\p{L}\p{N}]+') as l from f)),
size as (select count(*) as n, field, sum(len(regexp_extract_all(strip_accents(lower(body)), '[\p{L}\p{N}]+'))) / count(*) as a from f group by field),
hit as (select page_id, field, weight, term, count(*) as f, first(dl) as dl from tok group by page_id, field, weight, term),
df as (select field, term, count(*) as df from hit group by field, term),
part as (select page_id, term, field, weight * case when ln((n - df + 0.5) / (df + 0.5)) <= 0 then 1e-6 else ln((n - df + 0.5) / (df + 0.5)) end * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl / a)) as part
  from hit join df using (field, term) join size using (field))"""
query(
    "fts_dialect_stf",
    f"""with {FIELDS}
select page_id as "row", round(-sum(part * case when term = 'le' then 2 else 1 end), 6) as score from part
where term in ('le', 'de') and page_id in (select page_id from part where term = 'le') and page_id in (select page_id from part where term = 'de') group by page_id order by score, page_id limit 25""",
)(lambda t: ranked(_page_index(t).search(Q.to_stf("le^2 de"), "stf", limit=25)))
query(
    "fts_fields",
    f"""with {FIELDS}
select page_id as "row", round(-sum(part), 6) as score from part where field = 'title' and term = 'the' or field = 'body' and term = 'of'
group by page_id having bool_or(field = 'title') and bool_or(field = 'body') """,
)(lambda t: ranked(_page_index(t).search("the[TITULO] E of[TEXTO]", "cjf", limit=1_000_000, names={"TITULO": "title", "TEXTO": "body"})))

# --- similar words, weights -----------------------------------------------------------------------------------------------
SIMILAR = f"(select term from (select distinct term from {TOK}) where levenshtein(term, 'onthe') <= 2)"
query(
    "fts_dialect_sjur",
    f"""with h as (select doc_id, sum(f) as f, 1.0 as w from (select doc_id, term, count(*) as f from {TOK} where term in {SIMILAR} group by 1, 2) group by doc_id
  union all select doc_id, count(*), 3.0 from {TOK} where term = 'of' group by doc_id),
d as (select w, count(*) as df from h group by w), s as (select count(*) as n, avg(dl) as a from {DL})
select "row", round(score, 6) as score from (
  select h.doc_id as "row", -sum(h.w * case when ln((n - df + 0.5) / (df + 0.5)) <= 0 then 1e-6 else ln((n - df + 0.5) / (df + 0.5)) end * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl / a))) as score
  from h join d using (w) join {DL} l on l.doc_id = h.doc_id cross join s group by h.doc_id) q
where "row" in (select doc_id from h where w = 1) and "row" in (select doc_id from h where w = 3) """,
)(lambda t: ranked(index_of(t.documents).search("onthe~2 of^3", "sjur", limit=1_000_000)))
query("fts_similar_words", f"select term from (select distinct term from {TOK}) where levenshtein(term, 'onthe') <= 2")(lambda t: index_of(t.documents).similar_words("onthe", 2))


# --- updates ---------------------------------------------------------------------------------------------------------------
def _updated(t: Tables) -> Index:
    """An index of all documents, then German ones again with other texts, French ones gone, Spanish ones changed word by word in two steps."""
    store = Segments(t.spark, scratch(t.spark, "updates"), most=3)
    docs = t.documents
    store.put(docs, {"text": F.col("text")}, "doc_id")
    store.put(docs.where("lang = 'de'").withColumn("text", F.concat("source", F.lit(" neu "), "text")), {"text": F.col("text")}, "doc_id")
    store.delete(docs.where("lang = 'fr'").select(F.col("doc_id").alias("row")))
    for word in ("uno", "dos"):
        store.put(docs.where("lang = 'es'").withColumn("text", F.concat(F.lit(f"{word} "), "text")), {"text": F.col("text")}, "doc_id")
    return Index.of(store)


STATE = r"(select doc_id, lang, case lang when 'de' then source || ' neu ' || text when 'es' then 'dos ' || text else text end as text from documents where lang <> 'fr')"
STATE_TOK = f"(select doc_id, len(l) as dl, unnest(l) as term from (select doc_id, regexp_extract_all(strip_accents(lower(text)), '[\\p{{L}}\\p{{N}}]+') as l from {STATE}))"
query(
    "fts_index_update",
    f"""with k as {STATE_TOK}, h as (select doc_id, term, count(*) as f, first(dl) as dl from k where term in ('neu', 'dos', 'uno', 'the', 'le') group by 1, 2),
d as (select term, count(*) as df from h group by term), s as (select count(*) as n, sum(len(regexp_extract_all(strip_accents(lower(text)), '[\\p{{L}}\\p{{N}}]+'))) / count(*) as a from {STATE})
select h.doc_id as "row", round(-sum(case when ln((n - df + 0.5) / (df + 0.5)) <= 0 then 1e-6 else ln((n - df + 0.5) / (df + 0.5)) end * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl / a))), 6) as score
from h join d using (term) cross join s group by h.doc_id""",
)(lambda t: ranked(_updated(t).bm25([Q.Term(w) for w in ("neu", "dos", "uno", "the", "le")])))

# --- filters, languages, flags -----------------------------------------------------------------------------------------------
ORDER = ["en", "fr", "es", "de"]
VERSIONS = r"(select doc_id, lang, source, text, n_chars, doc_id // 4 as work from documents)"
query(
    "fts_cards",
    f"""with v as {VERSIONS}, leaf as (
  select doc_id, term, count(*) as f from {TOK} where term in ('de', 'of') group by 1, 2),
d as (select term, count(*) as df from leaf group by term), s as (select count(*) as n, avg(dl) as a from {DL}),
scored as (select leaf.doc_id, -sum(case when ln((n - df + 0.5) / (df + 0.5)) <= 0 then 1e-6 else ln((n - df + 0.5) / (df + 0.5)) end * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl / a))) as score
  from leaf join d using (term) join {DL} l using (doc_id) cross join s group by leaf.doc_id),
hit as (select doc_id, work, lang as found, score from scored join v using (doc_id) where strip_accents(lower(source)) in ('src1', 'src2', 'src3') and n_chars >= 200 and work in (select work from v where regexp_matches(text, '\\b[0-9]{{2,4}}\\b')) order by score, doc_id limit 40),
once as (select *, row_number() over (order by score, doc_id) as place from (select * from hit qualify row_number() over (partition by work order by score, doc_id) = 1) order by score, doc_id limit 10),
pick as (select o.place, o.work, o.found, o.score, v.lang, v.text, row_number() over (partition by o.place order by list_position(['fr', 'en', 'es', 'de'], v.lang), v.doc_id) as r from once o join v on v.work = o.work)
select place, work, found, lang, round(score, 6) as score, md5(text) as digest, lang <> 'fr' as translate, regexp_matches(text, '\\bCfr?\\.') as suspect from pick where r = 1""",
)(lambda t: _cards(t))


def _cards(t: Tables) -> DataFrame:
    versions = t.documents.withColumns({"row": F.col("doc_id"), "work": F.expr("doc_id div 4"), "part": F.lit(1)})
    articles = versions.where(F.col("text").rlike(r"\b[0-9]{2,4}\b")).select("work")
    found = cards(index_of(t.documents), versions, "de OR of", "fr", ORDER, T.fold(F.col("source")).isin("src1", "src2", "src3") & (F.col("n_chars") >= 200), articles)
    return found.select("place", "work", "found", "lang", F.round("score", 6).alias("score"), F.md5("text").alias("digest"), "translate", "suspect")


query(
    "fts_case_card",
    r"""with c as (select distinct source as c from documents where contains(lower(source), 'src1')), r as (select c, row_number() over (order by length(c), c) as n from c), ch as (select c from r where n = 1),
d as (select * from documents where source = (select c from ch))
select (select c from ch) as "case", coalesce((select list(c order by n) from r where n > 1), []) as others,
  coalesce((select list(a order by cast(a as bigint), a) from (select distinct unnest(regexp_extract_all(text, '\b[0-9]{2,4}\b')) as a from d)), []) as articles,
  coalesce((select list(split_part(text, chr(10), 1) order by doc_id) from d where length(text) < 2000), []) as reparations, (select list_sort(list(distinct lang)) from d) as langs""",
)(lambda t: _card(t))


def _card(t: Tables) -> DataFrame:
    docs = t.documents.withColumn("case", F.col("source"))
    articles = docs.select("case", F.explode(F.regexp_extract_all("text", F.lit(r"(\b[0-9]{2,4}\b)"), F.lit(1))).alias("article"))
    reparations = docs.where(F.length("text") < 2000).select("case", F.col("doc_id").alias("place"), F.get(F.split("text", "\n"), F.lit(0)).alias("text"))
    return case_card(docs, articles, reparations, docs, "SRC1")


query(
    "prj_json_to_analysis",
    """select event_id, case when event_id % 7 > 0 then cast(json_extract(props, '$.k') as bigint) end as k, case when event_id % 7 = 0 then 'falha' else coalesce(json_extract_string(props, '$.alerta'), 'amarelo') end as alerta, event_id % 7 = 0 as failed from events""",
)(lambda t: _analyses(t))


def _analyses(t: Tables) -> DataFrame:
    """Answers of an agent, some cut short: a broken one is a row that says so, never one with defaults."""
    said = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("Resposta: "), F.left("props", F.length("props") - 1))).otherwise(F.col("props"))
    read = t.events.select("event_id", F.from_json(said, "k bigint, alerta string, _corrupt_record string", {"mode": "PERMISSIVE"}).alias("p"))
    failed = F.col("p._corrupt_record").isNotNull()
    return read.select("event_id", "p.k", F.when(failed, "falha").otherwise(F.coalesce("p.alerta", F.lit("amarelo"))).alias("alerta"), failed.alias("failed"))
