"""Checks taken in the pass, glossary entries in texts, and sinks that commit versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import checks as C
from ..operators import params as P
from ..operators.glossary import matches
from ..sources.files import scratch
from ..sources.snapshots import Store
from ..streaming import cache, logs
from .registry import Tables, query

# --- checks -----------------------------------------------------------------------------------------------------------------
query("flt_verify_pushdown", "select doc_id, lang, n_chars from documents where lang = 'fr' and n_chars >= 100")(
    lambda t: C.rows_within(t.documents.where("lang = 'fr' and n_chars >= 100").select("doc_id", "lang", "n_chars"), {"lang": F.col("lang") == "fr", "n_chars": F.col("n_chars") >= 100})
)


def _answers(t: Tables, broken: bool) -> DataFrame:
    """JSON answers of up to 50 documents: how many there are, and those that hold a digit; told rightly, or whether or not there are any."""
    hit = F.when(F.col("text").rlike("[0-9]"), F.struct(F.col("doc_id").alias("id"), F.col("lang")))
    hits = F.array_sort(F.collect_list(hit))
    by = t.documents.groupBy("source", F.expr("doc_id div 1000").alias("page")).agg(hits.alias("hits"), F.count(F.lit(1)).alias("n"))
    total = F.col("n") if broken else F.size("hits")
    return by.select("source", "page", F.to_json(F.struct(total.cast("bigint").alias("total"), "hits")).alias("body"))


SILENT = "select source, doc_id // 1000 as page, count(*) as told, count_if(regexp_matches(text, '[0-9]')) as hits from documents group by 1, 2"
query("chk_total_vs_rows", f"select source, page, told, hits, told > 0 and hits = 0 as silent from ({SILENT})")(
    lambda t: C.answers(_answers(t, True), "body", "id bigint, lang string").select("source", "page", "told", F.size("hits").cast("bigint").alias("hits"), ((F.col("told") > 0) & (F.size("hits") == 0)).alias("silent"))
)
query("chk_hits_settled", "select source, doc_id as id, lang from documents where regexp_matches(text, '[0-9]')")(
    lambda t: C.hits_of(C.answers(_answers(t, False), "body", "id bigint, lang string"))[0].select("source", "hit.id", "hit.lang")
)
query("chk_unknown_is_error", "select doc_id, case lang when 'en' then 'CC' when 'fr' then 'OC' end as kind, lang not in ('en', 'fr') as refused from documents")(
    lambda t: P.understood(t.documents.withColumn("asked", F.when(F.col("lang") == "en", " Sentença").when(F.col("lang") == "fr", "PARECER").otherwise(F.col("lang"))), "asked", P.KINDS, "kind").select("doc_id", "kind", "refused")
)

# --- glossary ------------------------------------------------------------------------------------------------------------------
W = r"regexp_extract_all(strip_accents(lower({})), '[\p{{L}}\p{{N}}]+')"
query(
    "jn_glossary",
    f"""with recursive e as (select distinct array_to_string(l[1:k], ' ') as term, k as size from (select {W.format('text')} as l, unnest([2, 3, 5]) as k from benchmark) where len(l) >= k),
w as (select doc_id, {W.format('text')} as l from documents),
g as (select doc_id, i as pos, k as size, array_to_string(l[i:i + k - 1], ' ') as term from (select doc_id, l, k, unnest(generate_series(1, len(l) - k + 1)) as i from (select doc_id, l, unnest([2, 3, 5]) as k from w))),
best as (select doc_id, pos, max(size) as size, max_by(term, size) as term from g join e using (term, size) group by doc_id, pos),
nxt as (select b.doc_id, b.pos, b.size, b.term, c.pos as after from best b asof left join best c on b.doc_id = c.doc_id and b.pos + b.size <= c.pos),
pick as (select doc_id, min(pos) as pos from best group by doc_id union all select n.doc_id, n.after from pick p join nxt n on n.doc_id = p.doc_id and n.pos = p.pos where n.after is not null)
select n.doc_id as "row", n.pos - 1 as pos, n.size, n.term from pick join nxt n using (doc_id, pos)""",
)(lambda t: matches(t.documents, _glossary(t)))


def _glossary(t: Tables) -> DataFrame:
    words = F.regexp_extract_all(T.fold(F.col("text")), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    return t.benchmark.select(words.alias("l"), F.explode(F.array(*map(F.lit, (2, 3, 5)))).alias("k")).where(F.size("l") >= F.col("k")).select(F.array_join(F.slice("l", F.lit(1), F.col("k")), " ").alias("term"))


# --- sinks ---------------------------------------------------------------------------------------------------------------------
def _cases(t: Tables) -> Store:
    """Orders as cases in the states of a folder tree."""
    store = Store(t.spark, scratch(t.spark, "cases"), "caso bigint, risco string", "estado", "caso")
    store.append(t.orders.select(F.col("o_orderkey").alias("caso"), F.col("o_orderpriority").alias("risco"), F.col("o_orderstatus").alias("estado")))
    return store


def _after(store: Store, *changes) -> Store:
    for change in changes:
        change(store)
    return store


query("snk_archive", "select o_orderkey as caso, o_orderpriority as risco, o_orderstatus as estado, '2026-01-31' as archive from orders where o_orderstatus <> 'P' union all select o_orderkey, o_orderpriority, o_orderstatus, null from orders where o_orderstatus = 'X'")(
    lambda t: (s := _after(_cases(t), lambda s: s.purge("P"), lambda s: s.archive("2026-01-31"), lambda s: s.archive("2026-02-01"))).read(archived=True).unionByName(s.read().withColumn("archive", F.lit(None).cast("string")))
)
query("snk_purge_state", "select o_orderkey as caso, o_orderstatus as estado, 2 as version from orders where o_orderstatus <> 'F' union all select o_orderkey, o_orderstatus, 1 from orders")(
    lambda t: (s := _after(_cases(t), lambda s: s.purge("F"))).read().select("caso", "estado", F.lit(2).alias("version")).unionByName(s.read(1).select("caso", "estado", F.lit(1).alias("version")))
)
query("snk_update_risk", "select o_orderkey as caso, case when o_orderkey % 2 = 0 then 'verde' else o_orderpriority end as risco, o_orderstatus as estado from orders")(
    lambda t: _after(_cases(t), lambda s: s.patch(t.orders.where("o_orderstatus in ('F', 'O', 'P')").select(F.col("o_orderkey").alias("caso"), F.when(F.col("o_orderkey") % 2 == 0, "verde").otherwise("").alias("risco")))).read()
)
query("snk_save_analysis", "select doc_id, lang, case when lang = 'en' and length(text) > 0 then text else 'antiga ' || source end as analise from documents")(lambda t: _analysed(t))


def _analysed(t: Tables) -> DataFrame:
    store = Store(t.spark, scratch(t.spark, "analyses"), "doc_id bigint, analise string", "lang", "doc_id")
    store.append(t.documents.select("doc_id", F.concat(F.lit("antiga "), "source").alias("analise"), "lang"))
    store.patch(t.documents.where("lang in ('en', 'de')").select("doc_id", F.when(F.col("lang") == "en", F.col("text")).otherwise("").alias("analise")))
    return store.read()


query("snk_meta_json", "select o_orderkey, cast(json_object('numero', o_orderkey, 'risco', o_orderpriority, 'estado', o_orderstatus) as varchar) as meta, o_orderkey as numero, o_orderpriority as risco, o_orderstatus as estado from orders")(lambda t: _meta(t))


def _meta(t: Tables) -> DataFrame:
    """Metadata as JSON lines in a folder for each state, read back: the text of each line, and what it tells."""
    path = scratch(t.spark, "meta")
    told = F.struct(F.col("o_orderkey").alias("numero"), F.col("o_orderpriority").alias("risco"), F.col("o_orderstatus").alias("estado"))
    t.orders.select(F.to_json(told, {"ignoreNullFields": "false"}).alias("value"), F.col("o_orderstatus").alias("folder")).write.partitionBy("folder").text(path)
    lines = t.spark.read.schema("value string, folder string").text(path).select("value", F.from_json("value", "numero bigint, risco string, estado string").alias("m"))
    return lines.select(F.col("m.numero").alias("o_orderkey"), F.col("value").alias("meta"), "m.*")


# --- a cache with state -----------------------------------------------------------------------------------------------------------
TTL = 172_800


def _cached(t: Tables) -> DataFrame:
    """Purchases and signups put an entry of their user, all other events read it."""
    path = scratch(t.spark, "cache-events")
    put = F.col("event_type").isin("purchase", "signup")
    t.events.select(F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("at"), F.when(put, "put").otherwise("get").alias("op"), F.when(put, F.concat("event_type", F.lit(":"), "event_id")).alias("body"), F.when(put, F.lit(TTL)).alias("ttl_s")).write.parquet(path)
    events = t.spark.readStream.schema("key string, id bigint, at timestamp, op string, body string, ttl_s int").parquet(path)
    with cache.keyed_state(t.spark):
        answers = logs.drained(cache.answered(events), "str_ttl_cache", "append", scratch(t.spark, "checkpoint"))
    return answers.where("what <> 'purged'").select("key", "id", "what", "body", "hits")


query(
    "str_ttl_cache",
    f"""with e as (select cast(user_id as varchar) as key, event_id as id, ts, event_type in ('purchase', 'signup') as put, event_type || ':' || event_id as body from events),
g as (select *, last_value(case when put then ts end ignore nulls) over w as since, last_value(case when put then body end ignore nulls) over w as held, count_if(put) over w as turn from e window w as (partition by key order by ts, id rows between unbounded preceding and 1 preceding)),
h as (select *, coalesce(since + interval {TTL} second >= ts, false) as hit from g where not put)
select key, id, case when hit then 'hit' else 'miss' end as what, case when hit then held end as body, case when hit then count(*) over (partition by key, turn order by ts, id rows unbounded preceding) else 0 end as hits from h""",
)(_cached)
