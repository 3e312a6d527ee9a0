"""Sources, sinks, segmentation and streams, as round trips over files that the query itself writes from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import params as P
from ..operators import segment as G
from ..sources import files as S
from ..sources import html as H
from ..streaming import logs as L
from .registry import Tables, before, query


@before
def columns() -> None:
    """Stand-in inputs of the queries below, made anew for each session."""
    global MAGIC, BLOCKS, FORM, CARD, LIST, NUMBERED
    MAGIC = F.when(F.col("doc_id") % 3 == 0, F.unhex(F.lit("D0CF11E0A1B11AE10000"))).when(F.col("doc_id") % 3 == 1, F.encode(F.lit("{\\rtf1 x"), "UTF-8")).otherwise(F.encode("text", "UTF-8"))
    BLOCKS = F.concat(F.lit("[titulo removido] CAP I\n1. Primeiro\nsegue\n\n2. "), F.replace("text", F.lit("\n"), F.lit(" ")))
    FORM = F.concat(F.lit('<input name="q" value="'), "page_id", F.lit('"/><input name="s" value="x"/><input name="q" value="last"/>'))
    CARD = F.concat(F.lit("<dl><dt>Relatora:</dt><dd>Ana "), "page_id", F.lit("</dd><dt>Órgão julgador</dt><dd>1&amp;2</dd></dl>"))
    LIST = F.concat(F.lit("PODER\n1 - 0800307-06.2025.4.05.8103 - APELAÇÃO CÍVEL\nAPELANTE: A\nEMENTA\nTexto um "), "doc_id", F.lit("\n\n segue\n2 - 0007508-25.2015.4.05.8300 - REMESSA\nEMENTA\nTexto dois\n"))
    NUMBERED = F.array_join(F.transform(F.split("text", "\n"), lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n\n")


def _texts(t: Tables) -> str:
    path = S.scratch(t.spark, "texts")
    t.documents.repartition(4, "doc_id").select(F.concat_ws(" ", F.lit("doc"), "doc_id", F.sha2("text", 256)).alias("value")).write.option("compression", "none").text(path)
    return path


query("src_text_dispatch", "select 'doc ' || doc_id || ' ' || sha256(text) as line from documents")(lambda t: S.whole_texts(t.spark, _texts(t)).select(F.explode(F.filter(F.split("body", "\n"), lambda x: x != "")).alias("line")))
query("src_doc_dispatch", "select doc_id, case doc_id % 3 when 0 then 'word97' when 1 then 'rtf' else 'text' end as kind from documents")(lambda t: t.documents.select("doc_id", S.doc_kind(MAGIC).alias("kind")))
def _log(t: Tables) -> str:
    path = S.scratch(t.spark, "log")
    line = F.when(F.col("event_id") % 50 == 0, F.lit("{not json")).otherwise(F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"), F.col("event_type").alias("busca"), F.col("event_id").alias("n"))))
    t.events.select(line.alias("value")).write.text(path)
    return path


LOG_SCHEMA = "ts string, busca string, n bigint"
query("src_jsonl_log", "select count_if(event_id % 50 = 0) as broken, count_if(event_id % 50 <> 0) as good, cast(sum(case when event_id % 50 <> 0 then event_id end) as bigint) as n from events")(
    lambda t: S.jsonl_log(t.spark, _log(t), LOG_SCHEMA).agg(F.count_if(~F.col("valid")).alias("broken"), F.count_if("valid").alias("good"), F.sum("n").alias("n"))
)
query("src_paragraph_txt", "select doc_id, unnest([1, 2]) as number, unnest(['Primeiro' || chr(10) || 'segue', replace(text, chr(10), ' ')]) as body, unnest(['CAP I', '']) as titles from documents")(
    lambda t: t.documents.select("doc_id", F.explode(S.paragraph_blocks(BLOCKS)).alias("b")).select("doc_id", "b.number", "b.body", F.array_join("b.titles", "|").alias("titles"))
)
query("snk_paragraph_txt", "select doc_id, '[titulo removido] CAP I' || chr(10) || '1. Primeiro' || chr(10) || 'segue' || chr(10) || chr(10) || '2. ' || replace(text, chr(10), ' ') as body from documents")(
    lambda t: t.documents.select("doc_id", S.paragraph_blocks(BLOCKS).alias("b")).select("doc_id", S.paragraph_file(F.col("b.number"), F.col("b.body"), F.col("b.titles")).alias("body"))
)
query("snk_markdown_report", "select '# Relatorio' || chr(10) || string_agg('- ' || o_orderstatus || ': ' || n, chr(10) order by o_orderstatus) as report from (select o_orderstatus, count(*) as n from orders group by 1)")(
    lambda t: t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).agg(F.array_sort(F.collect_list(F.concat(F.lit("- "), "o_orderstatus", F.lit(": "), "n"))).alias("l")).select(F.concat(F.lit("# Relatorio\n"), F.array_join("l", "\n")).alias("report"))
)
cases = lambda t: t.orders.select(F.col("o_orderkey").cast("string").alias("caso"), F.col("o_orderstatus").alias("estado"), F.col("o_orderpriority").alias("risco"))
query("snk_folder_move", "select cast(o_orderkey as varchar) as caso, case when o_orderkey = 1 then 'X' else o_orderstatus end as estado from orders")(lambda t: S.move_case(cases(t), "1", "X").select("caso", "estado"))
# --- result pages ----------------------------------------------------------------------------------------------------
query("src_html_catalogue", r"""select page_id, unnest(regexp_extract_all(html, '(?is)<li[^>]*>\s*<a href="([^"]*)"[^>]*>([^<]*)</a>', 1)) as url from pages""")(lambda t: t.pages.select("page_id", F.explode(H.catalogue(F.col("html"))).alias("c")).select("page_id", "c.url"))
query("src_html_form", "select page_id, 'last' as q, 'x' as s from pages")(lambda t: t.pages.select("page_id", H.form_fields(FORM).alias("m")).select("page_id", F.col("m")["q"].alias("q"), F.col("m")["s"].alias("s")))
query("src_html_cards_label", "select page_id, unnest(['relator', 'orgao_julgador']) as label, unnest(['Ana ' || page_id, '1&2']) as value from pages")(lambda t: t.pages.select("page_id", F.explode(H.label_values(CARD)).alias("c")).select("page_id", "c.*"))
# --- nested JSON answers --------------------------------------------------------------------------------------------------
query("src_julia_json", "select doc_id, coalesce(nullif(case when doc_id % 3 = 0 then '' else text end, ''), nullif(lang, ''), '') as body from documents")(lambda t: t.documents.select("doc_id", F.coalesce(F.nullif(F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("text")), F.lit("")), F.nullif("lang", F.lit("")), F.lit("")).alias("body")))

# --- segmentation -------------------------------------------------------------------------------------------------------
query("seg_list_strict", "select doc_id, unnest([1, 2]) as ordem, unnest(['0800307-06.2025.4.05.8103', '0007508-25.2015.4.05.8300']) as numero, unnest(['APELAÇÃO CÍVEL', 'REMESSA']) as tipo, unnest(['Texto um ' || doc_id || chr(10) || 'segue', 'Texto dois']) as ementa from documents")(
    lambda t: t.documents.select("doc_id", F.explode(G.cases_strict(LIST)).alias("c")).select("doc_id", "c.*")
)
query("seg_list_lenient", "select doc_id, unnest([1, 2]) as ordem, unnest(['0800307-06.2025.4.05.8103', '0007508-25.2015.4.05.8300']) as numero, unnest(['APELAÇÃO CÍVEL', 'REMESSA']) as tipo from documents")(
    lambda t: t.documents.select("doc_id", F.explode(G.cases_lenient(F.replace(LIST, F.lit("25.2015.4.05.8300 - "), F.lit("25.2015.4.05.8300 – ")))).alias("c")).select("doc_id", "c.ordem", "c.numero", "c.tipo")
)
query("win_monotone_segment")(lambda t: G.paragraphs(t.documents.select("doc_id", NUMBERED.alias("text"))).groupBy("id").agg(F.max("number").alias("paragraphs"), F.sum(F.length("body")).alias("chars")))

# --- streams ---------------------------------------------------------------------------------------------------------------
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _landed(t: Tables) -> str:
    path = S.scratch(t.spark, "events")
    t.events.write.parquet(path)
    return path


query("str_log_summary", "select cast(ts as date) as day, event_type, count(*) as calls, count_if(event_type = 'error') as errors, round(avg(value), 6) as mean_ms from events group by 1, 2")(
    lambda t: L.drained(L.windowed_summary(L.event_stream(t.spark, _landed(t), EVENTS), late="3650 days"), "str_log_summary", "complete", S.scratch(t.spark, "checkpoint"))
)
query("str_hits_counter", "select user_id, count(*) as hits from events group by user_id")(lambda t: L.drained(L.event_stream(t.spark, _landed(t), EVENTS).groupBy("user_id").agg(F.count(F.lit(1)).alias("hits")), "str_hits_counter", "complete", S.scratch(t.spark, "checkpoint")))


def _resumed(t: Tables) -> DataFrame:
    path, target = _landed(t), S.scratch(t.spark, "target")
    for _ in range(2):  # the second run, with a checkpoint of its own, finds everything known
        L.ingest_new(L.event_stream(t.spark, path, EVENTS).select("event_id", "event_type"), target, ["event_id"], S.scratch(t.spark, "checkpoint"))
    return t.spark.read.parquet(target)


query("str_resumable_crawl", "select distinct event_id, event_type from events")(_resumed)

# --- checked parameters ------------------------------------------------------------------------------------------------
query("fn_normalise_params", "select n_nationkey from nation where n_nationkey in (1, 4)")(lambda t: t.nation.where(F.concat(F.lit("TRF"), "n_nationkey").isin(P.normalise("trf1, 4, 1ª REGIAO".replace("ª", "a"), P.COURTS))).select("n_nationkey"))
query("flt_text_types_guard", "select doc_id from documents where lang = 'en'")(lambda t: t.documents.where(F.when(F.col("lang") == "en", "CC").otherwise("SS").isin(P.with_text(P.normalise("sentença", P.KINDS)))).select("doc_id"))
