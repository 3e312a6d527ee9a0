"""Full-text search over documents: index, ranking, boolean dialects, expansion, relaxation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import querylang as Q
from ..operators.search import Index, index_of, lengths, similar, tokens  # noqa: F401
from .registry import Tables, query

TOK = r"(select doc_id, unnest(l) as term, generate_subscripts(l, 1) - 1 as pos from (select doc_id, regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{N}]+') as l from documents))"
DL = r"(select doc_id, len(regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{N}]+')) as dl from documents)"


def bm25_sql(leaves: list[str], where: str = "true", limit: int = 10) -> str:
    """SQL of a ranked search; a leaf is a condition on term."""
    parts = " union all ".join(f"select doc_id, f, (select count(*) from (select distinct doc_id from {TOK} where {x})) as df from (select doc_id, count(*) as f from {TOK} where {x} group by doc_id)" for x in leaves)
    return f"""with h as ({parts}), s as (select count(*) as n, avg(dl) as a from {DL})
select "row", round(score, 6) as score from (
  select h.doc_id as "row", -sum(case when ln((n - df + 0.5) / (df + 0.5)) <= 0 then 1e-6 else ln((n - df + 0.5) / (df + 0.5)) end * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl / a))) as score
  from h join {DL} d on d.doc_id = h.doc_id cross join s group by h.doc_id) q
where {where} order by score, "row" limit {limit}"""


def has(word: str) -> str:
    return f"q.\"row\" in (select doc_id from {TOK} where term = '{word}')"


def index(t: Tables) -> Index:
    return index_of(t.documents)


def ranked(df):
    return df.select("row", F.round("score", 6).alias("score"))


query("fts_tokenize", f"select term, count(distinct doc_id) as docs, count(*) as n from {TOK} group by term")(lambda t: tokens(t.documents).groupBy("term").agg(F.countDistinct("row").alias("docs"), F.count(F.lit(1)).alias("n")))
query("fts_index_build", f"select term, doc_id as \"row\", count(*) as tf, array_to_string(list(pos order by pos), ',') as positions from {TOK} group by term, doc_id")(
    lambda t: index(t).postings.select("term", "row", "tf", F.array_join("positions", ",").alias("positions"))
)
query("fts_rebuild", f"select doc_id as \"row\", dl from {DL}")(lambda t: lengths(t.documents))
query("fts_bm25", bm25_sql(["term = 'herea'", "term = 'onthe'", "term = 'the'"], limit=1000000))(lambda t: ranked(index(t).bm25([Q.Term("herea"), Q.Term("onthe"), Q.Term("the")])))
query("srt_bm25_topk", bm25_sql(["term = 'tion'", "term = 'eau'"]))(lambda t: ranked(index(t).search("tion OR eau")))
query("fts_search", bm25_sql(["term = 'the'", "term = 'tion'"], f"{has('the')} and {has('tion')}"))(lambda t: ranked(index(t).search("the AND tion")))
query("fts_expand", bm25_sql(["term = 'the'", "term = 'die'", "term = 'tion'"], f"({has('the')} or {has('die')}) and {has('tion')}"))(lambda t: ranked(index(t).search(Q.expand("the tion", {"the": ["die"]})[0])))
query("fts_prefix", f"select \"row\" from (select distinct doc_id as \"row\" from {TOK} where starts_with(term, 'thinsh')) q")(lambda t: index(t).rows(Q.parse("thinsh*")))
query("fts_phrase", f"select distinct a.doc_id as \"row\" from {TOK} a join {TOK} b on a.doc_id = b.doc_id and b.pos = a.pos + 1 where a.term = 'of' and b.term = 'the'")(lambda t: index(t).rows(Q.parse('"of the"')))
query("fts_dialect_julia", f"select distinct a.doc_id as \"row\" from {TOK} a join {TOK} b on a.doc_id = b.doc_id and abs(b.pos - a.pos) between 1 and 2 where a.term = 'the' and b.term = 'and'")(lambda t: index(t).rows(Q.parse("the adj2 and", "julia")))
query("fts_dialect_lucene", f"select q.\"row\" from (select doc_id as \"row\" from documents) q where {has('the')} and not {has('tion')}")(lambda t: index(t).rows(Q.parse(Q.to_lucene("the não tion")[0], "lucene")))
query("fts_dialect_stm", f"select q.\"row\" from (select doc_id as \"row\" from documents) q where {has('eau')} and not {has('tion')}")(lambda t: index(t).rows(Q.parse(Q.to_stm("eau nao tion")[0], "stm")))
query("fts_dialect_bnp", f"select q.\"row\" from (select doc_id as \"row\" from documents) q where {has('the')} and not {has('of')}")(lambda t: index(t).rows(Q.parse("+the -of eau", "bnp")))
query("fts_dialect_brs_cjf", f"select q.\"row\" from (select doc_id as \"row\" from documents) q where {has('die')} or {has('les')}")(lambda t: index(t).rows(Q.parse(Q.stj_to_cjf("die ou les"), "cjf")))
query("fts_dialect_explicit_and", f"select q.\"row\" from (select doc_id as \"row\" from documents) q where {has('die')} and {has('und')}")(lambda t: index(t).rows(Q.parse(Q.explicit_and("die und"), "cjf")))
query("fts_sanitize", f"select q.\"row\" from (select doc_id as \"row\" from documents) q where {has('les')} and {has('des')}")(lambda t: index(t).rows(Q.parse(Q.to_fts5("les, (des) -- AND"))))
query("fts_relax_or", bm25_sql(["term = 'die'", "term = 'zzzz'"]))(lambda t: ranked(index(t).search_or_relax("die E zzzz", "cjf")[0]))
query("fts_relax_plus", bm25_sql(["term = 'die'", "term = 'zzzz'"]))(lambda t: ranked(index(t).search_or_relax("+die +zzzz", "bnp")[0]))
query("fts_positive_terms", f"select doc_id, instr(strip_accents(lower(text)), 'onthe') as at from documents")(lambda t: t.documents.select("doc_id", F.instr(T.fold(F.col("text")), Q.positive_words("onthe NOT herea")[0]).cast("bigint").alias("at")))
query("fts_paragraph_hits", f"select p.doc_id, p.par, p.lang <> 'en' as translate, regexp_matches(body, '\\bCfr?\\.') as suspect from (select doc_id, lang, generate_subscripts(l, 1) as par, unnest(l) as body from (select doc_id, lang, string_split(text, chr(10)) as l from documents)) p where list_contains(regexp_extract_all(strip_accents(lower(body)), '[\\p{{L}}\\p{{N}}]+'), 'onthe')")(lambda t: _paragraph_hits(t, "onthe"))


def _paragraph_hits(t: Tables, word: str):
    pars = t.documents.select("doc_id", "lang", F.posexplode(F.split("text", "\n")).alias("p", "body"))
    words = F.regexp_extract_all(T.fold(F.col("body")), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    return pars.where(F.array_contains(words, word)).select("doc_id", (F.col("p") + 1).alias("par"), (F.col("lang") != "en").alias("translate"), T.suspect(F.col("body")).alias("suspect"))


query("jn_fts_par_doc", f"select k.term, d.doc_id, d.lang, k.tf from (select term, doc_id, count(*) as tf from {TOK} where term in ('herea', 'onthe') group by 1, 2) k join documents d using (doc_id)")(
    lambda t: index(t).postings.where(F.col("term").isin("herea", "onthe")).join(t.documents, F.col("row") == F.col("doc_id")).select("term", "doc_id", "lang", "tf")
)
query("fts_reception", f"select item_id, case when hits > 0 then 'HA' when (select count(*) from {TOK} where term = 'the') > 0 then 'SEM' else 'NAO_APURADO' end as verdict from (select b.item_id, count(d.doc_id) as hits from benchmark b left join documents d on contains(d.text, b.text) group by b.item_id)")(
    lambda t: _reception(t)
)


def _reception(t: Tables):
    found = index(t).holding(t.documents, t.benchmark, "doc_id", "text", "item_id", "text", fold=False)
    heard = F.lit(not index(t).rows(Q.Term("the")).isEmpty())
    told = t.benchmark.select("item_id").join(found.select(F.col("item").alias("item_id")).distinct().withColumn("hit", F.lit(True)), "item_id", "left")
    return told.select("item_id", F.when(F.col("hit"), "HA").when(heard, "SEM").otherwise("NAO_APURADO").alias("verdict"))


query("fts_similar", "select b.vec_id, round(list_cosine_similarity(cast(a.embedding as double[]), cast(b.embedding as double[])), 6) as cosine from embeddings a join embeddings b on a.vec_id = 7 and b.vec_id <> 7 order by cosine desc, b.vec_id limit 10")(lambda t: similar(t.embeddings, 7))
query("fts_semantic", "select b.vec_id, round(list_cosine_similarity(cast(a.embedding as double[]), cast(b.embedding as double[])), 6) as cosine from embeddings a join embeddings b on a.vec_id = 3 and b.vec_id <> 3 order by cosine desc, b.vec_id limit 400")(lambda t: similar(t.embeddings, 3, 400))
query("fts_suggest_judge", "select distinct source from documents where contains(strip_accents(lower(source)), 'src1')")(lambda t: t.documents.where(F.contains(T.fold(F.col("source")), F.lit("src1"))).select("source").distinct())
query("fts_get_document", "select doc_id, text from documents where doc_id = 42")(lambda t: t.documents.where(F.col("doc_id") == 42).select("doc_id", "text"))
