"""Updates with rules, totals and errors of portal pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import updates as U
from ..sources import cards as P
from ..sources.files import scratch
from .portal_queries import escaped, markup
from .registry import Tables, query

query(
    "upd_topic",
    """select coalesce(n.tema, o.tema) as tema, coalesce(n.documento, o.documento) as documento, coalesce(n.fonte, o.fonte) as fonte, coalesce(n.citacoes, o.citacoes) as citacoes
from (select source as tema, doc_id as documento, 'Caderno 1' as fonte, n_chars as citacoes from documents where lang in ('en', 'fr')) o full join (select source as tema, doc_id as documento, 'Caderno ' || lang as fonte, case when n_chars >= 100 then n_chars + 1 end as citacoes from documents where lang in ('fr', 'de')) n on o.tema = n.tema and o.documento = n.documento""",
)(lambda t: U.put_topics(_topics(t, ["en", "fr"], F.lit("Caderno 1"), F.col("n_chars")), _topics(t, ["fr", "de"], F.concat(F.lit("Caderno "), "lang"), F.when(F.col("n_chars") >= 100, F.col("n_chars") + 1)), ["tema", "documento"], "fonte"))


def _topics(t: Tables, langs: list[str], source: Column, n: Column) -> DataFrame:
    return t.documents.where(F.col("lang").isin(langs)).select(F.col("source").alias("tema"), F.col("doc_id").alias("documento"), source.alias("fonte"), n.alias("citacoes"))


query(
    "upd_glossary",
    "select c_custkey, n_name as pt, coalesce(r_name, 'curadoria') as fonte from customer join nation on c_nationkey = n_nationkey left join (select * from region where r_name like 'A%') on n_regionkey = r_regionkey",
)(lambda t: U.seeded(t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("pt"), F.col("n_regionkey").alias("k")), t.region.where("r_name like 'A%'").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("fonte")), "k", "fonte").select("c_custkey", "pt", "fonte"))

query("upd_schema_migrate", r"select doc_id, lang, case when lang = 'en' then regexp_matches(text, '\bCfr?\.') else false end as suspeito, case when lang = 'en' then source end as fonte from documents")(lambda t: _migrated(t))


def _migrated(t: Tables) -> DataFrame:
    """Rows written by an older and by a later version, read as one table."""
    columns = {"suspeito": F.lit(False), "fonte": F.lit(None).cast("string")}
    old, new = scratch(t.spark, "version-1"), scratch(t.spark, "version-2")
    t.documents.where("lang <> 'en'").select("doc_id", "lang").write.parquet(old)
    t.documents.where("lang = 'en'").select("doc_id", "lang", F.col("text").rlike(r"\bCfr?\.").alias("suspeito"), F.col("source").alias("fonte")).write.parquet(new)
    return U.migrated(t.spark.read.parquet(old), columns, ["paragrafo_id"]).unionByName(U.migrated(t.spark.read.parquet(new), columns, ["paragrafo_id"]))


query(
    "upd_cache_put",
    """with c as (select event_type as mcp, user_id as key, max(event_id) as seen, count(*) as hits from events group by 1, 2),
n as (select event_type as mcp, user_id as key, max_by(event_id, event_id) as last from events where user_id % 3 = 0 and event_type <> 'error' group by 1, 2)
select mcp, key, 'new ' || last as body, 9500 as fetched_at, 60 as ttl_s, 0 as hits from n
union all select mcp, key, 'old ' || seen, seen, 1000, hits from c where not exists (select 1 from n where n.mcp = c.mcp and n.key = c.key) and seen + 1000 >= 9500""",
)(lambda t: _cache_after(t))


def _cache_after(t: Tables) -> DataFrame:
    own = t.events.select(F.col("event_type").alias("mcp"), F.col("user_id").alias("key"), "event_id")
    held = own.groupBy("mcp", "key").agg(F.max("event_id").alias("fetched_at"), F.count(F.lit(1)).alias("hits")).select("mcp", "key", F.concat(F.lit("old "), "fetched_at").alias("body"), "fetched_at", F.lit(1000).cast("bigint").alias("ttl_s"), "hits")
    # empty answers are no entries
    puts = own.where("key % 3 = 0").select("mcp", "key", F.when(F.col("mcp") == "error", "").otherwise(F.concat(F.lit("new "), "event_id")).alias("body"), F.lit(60).alias("ttl_s"), F.col("event_id").alias("seq"))
    return U.put_cache(held, puts, 9500)


# --- totals and errors -------------------------------------------------------------------------------------------------------
query("agg_portal_totals", "select doc_id, n_chars as trf1, case when doc_id % 2 = 0 then doc_id end as stj, 1 + (doc_id % 2 = 0)::int as courts from documents")(
    lambda t: t.documents.select("doc_id", P.court_totals(_totals_page(), ["TRF1", "STJ"]).alias("m")).select("doc_id", F.col("m")["TRF1"].alias("trf1"), F.col("m")["STJ"].alias("stj"), F.size("m").alias("courts"))
)


def _totals_page() -> Column:
    row = lambda court, n: markup("<tr><td class='x'>", court, "</td> <td><b>", n, " Documento(s)</b></td></tr>")
    return markup("<table>", row("XXX", F.lit(7)), row("TRF1", F.lit(1)), F.when(F.col("doc_id") % 2 == 0, row("STJ", F.col("doc_id"))).otherwise(""), row("TRF1", F.col("n_chars")), "</table>")


query(
    "chk_portal_error",
    r"""select doc_id, case when doc_id % 3 = 0 then coalesce(nullif(trim(regexp_replace(text, '\s+', ' ', 'g')), ''), 'erro não detalhado pelo portal') when doc_id % 3 = 1 then 'erro não detalhado pelo portal' end as message from documents""",
)(lambda t: t.documents.select("doc_id", P.portal_error(F.when(F.col("doc_id") % 3 < 2, markup('<li class="ui-messages-error-detail">', F.when(F.col("doc_id") % 3 == 0, escaped(F.col("text"))).otherwise(" "), "</li>")).otherwise(F.col("text"))).alias("message")))
