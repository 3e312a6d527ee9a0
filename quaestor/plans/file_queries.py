"""Files in their own formats: made from whole tables, written and read back by tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources import files as S
from ..sources import result_files as X
from .registry import Tables, query

#: Non-blank lines of a text, without blanks around.
LINES = "list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x)), lambda x: x <> '')"


def _made(rows: DataFrame, make) -> DataFrame:
    """(path, content): a file of each row, by a function of the row's values."""

    return S.by_row(rows, lambda path, *values: (path, make(*values)), "path string, content binary")


# --- word-processor archives ----------------------------------------------------------------------------------------
def _docx(t: Tables) -> DataFrame:
    rows = t.documents.select(F.concat("doc_id", F.lit(".docx")).alias("path"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"))
    return _made(rows, lambda text, lang, source: S.make_docx(text.split("\n"), [lang, " " + source + "\n" + lang]))


def _docx_sql(lines: str) -> str:
    return f"with p as (select doc_id || '.docx' as path, {lines} as l from documents) select path, cast(unnest(range(len(l))) as integer) as part, unnest(l) as body from p"


query("src_docx_paragraphs", _docx_sql(LINES))(lambda t: S.docx_texts(_docx(t)))
CELLS = "list_filter([coalesce(lang, ''), trim(trim(coalesce(source, '')) || chr(10) || coalesce(lang, ''), ' ' || chr(10))], lambda x: x <> '')"
query("src_docx_with_tables", _docx_sql(f"list_concat({LINES}, {CELLS})"))(lambda t: S.docx_texts(_docx(t), tables=True))

# --- old word-processor files and pages -----------------------------------------------------------------


def _word97(t: Tables) -> DataFrame:
    rows = t.documents.select(F.concat("doc_id", F.lit(".doc")).alias("path"), F.coalesce("text", F.lit("")).alias("text"), (F.col("doc_id") % 2 == 0).alias("wide"))
    return _made(rows, lambda text, wide: S.make_word97(text, wide=bool(wide), notes="nota de rodapé"))


query("src_word97", "select doc_id || '.doc' as path, coalesce(text, '') as body, cast(null as varchar) as error from documents")(lambda t: S.word97_texts(_word97(t)))


def _pdfs(t: Tables) -> DataFrame:
    """A page for each line; a blank line is a page without a text layer."""
    rows = t.documents.select(F.concat("doc_id", F.lit(".pdf")).alias("path"), F.coalesce("text", F.lit("")).alias("text"))
    return _made(rows, lambda text: S.make_pdf([x.strip() for x in text.split("\n")]))


query("src_pdf_text", f"select doc_id || '.pdf' as path, array_to_string({LINES}, chr(10)) as body from documents")(lambda t: S.pages_with_gaps(_pdfs(t)).select("path", "body"))
query(
    "src_pdf_text_with_gaps",
    "with p as (select doc_id || '.pdf' as path, list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x)) as l from documents) "
    "select path, array_to_string(list_filter(range(1, len(l) + 1), lambda i: l[i] = ''), ',') as gaps, case when len(list_filter(l, lambda x: x <> '')) = 0 then 'no text layer' end as error from p",
)(lambda t: S.pages_with_gaps(_pdfs(t)).select("path", F.array_join("gaps", ",").alias("gaps"), "error"))


# --- folders of cases -----------------------------------------------------------------------------------------------
def _folders(t: Tables) -> str:
    """A tree of a case for each supplier, names with signs that addresses write by codes; every fifth case has broken metadata."""
    path = S.scratch(t.spark, "cases")
    case = F.concat(F.when(F.col("s_nationkey") < 10, "em análise").otherwise("feitos+revistos"), F.lit("/"), "s_name", F.lit("/"))
    meta = F.to_json(F.struct(F.concat("s_name", F.lit("/"), "s_nationkey").alias("numero"), F.lit("T").alias("tipo"), F.lit("verde").alias("risco"), F.col("s_suppkey").cast("int").alias("ordem")))
    files = F.array(
        F.struct(F.lit("meta.json").alias("name"), F.when(F.col("s_suppkey") % 5 == 0, "{broken").otherwise(meta).alias("body")),
        F.struct(F.lit("ementa.md").alias("name"), F.when(F.col("s_suppkey") % 3 > 0, F.concat(F.lit("Ementa\n\n"), "s_nationkey")).alias("body")),
        F.struct(F.lit("analise.md").alias("name"), F.when(F.col("s_suppkey") % 2 == 0, "ok").alias("body")),
    )
    rows = t.supplier.select(case.alias("case"), F.explode(F.filter(files, lambda x: x["body"].isNotNull())).alias("f"))
    S.write_files(rows.select(F.concat("case", "f.name").alias("path"), F.encode("f.body", "UTF-8").alias("content")), path)
    return path


query(
    "src_folder_table",
    "select case when s_nationkey < 10 then 'em análise' else 'feitos+revistos' end as estado, s_name as caso, case when s_suppkey % 5 > 0 then s_name || chr(47) || s_nationkey end as numero, "
    "case when s_suppkey % 5 > 0 then cast(s_suppkey as integer) end as ordem, case when s_suppkey % 3 > 0 then 'Ementa' || chr(10) || chr(10) || s_nationkey end as ementa, "
    "s_suppkey % 2 = 0 as has_analysis from supplier",
)(lambda t: S.case_folders(t.spark, _folders(t)).select("estado", "caso", "numero", "ordem", "ementa", "has_analysis"))


# --- several tables in one file -------------------------------------------------------------------------------------
def _metadata(t: Tables) -> str:
    path = S.scratch(t.spark, "metadata")
    tables = {"customer": t.customer.select("c_custkey", "c_name"), "supplier": t.supplier.select("s_suppkey", "s_name")}
    S.join_tables(tables, {"customer": ["c_custkey"], "supplier": ["s_suppkey"]}).write.text(path)
    return path


def _tables(t: Tables) -> dict[str, DataFrame]:
    return S.split_tables(t.spark, _metadata(t), {"customer": "c_custkey bigint, c_name string", "supplier": "s_suppkey bigint, s_name string"})


query("src_metadata_jsonl", "select c_custkey as id, c_name as name from customer union all select s_suppkey, s_name from supplier")(
    lambda t: (m := _tables(t))["customer"].toDF("id", "name").unionByName(m["supplier"].toDF("id", "name"))
)
query(
    "snk_metadata_jsonl",
    """select '{"_tabela":"customer","c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' as line from customer
    union all select '{"_tabela":"supplier","s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '"}' from supplier""",
)(lambda t: t.spark.read.text(_metadata(t)).toDF("line"))


# --- result lists ---------------------------------------------------------------------------------------------------
def _xml(t: Tables) -> DataFrame:
    """The lists of all sources, written as XML texts and read back element by element."""
    path = S.scratch(t.spark, "xml")
    X.write_xml(X.xml_rows(t.documents.select("source", "doc_id", "lang", "text"), "source", "doc_id", ["doc_id", "lang", "text"]), "source", path)
    return X.read_xml(t.spark, path, "source", ["doc_id", "lang", "text"])


query(
    "snk_xml_results",
    "select source, row_number() over (partition by source order by doc_id) as indice, doc_id, nullif(lang, '') as lang, nullif(text, '') as text from documents",
)(lambda t: _xml(t).withColumn("doc_id", F.col("doc_id").cast("bigint")))


def _reports(t: Tables) -> DataFrame:
    """A report of the first three documents of each language, whole; tasks keep three before rows are dealt."""
    place = F.row_number().over(Window.partitionBy("lang").orderBy("doc_id"))
    first = t.documents.select("lang", "doc_id", "text", place.alias("place")).where("place <= 3")
    parts = F.array_sort(F.collect_list(F.struct("place", F.concat(F.lit("## "), "doc_id", F.lit("\n"), F.coalesce("text", F.lit(""))).alias("part"))))
    return first.groupBy("lang").agg(F.array_join(F.transform(parts, lambda x: x["part"]), "\n").alias("report"))


query(
    "snk_search_reports",
    "select lang, string_agg('## ' || doc_id || chr(10) || coalesce(text, ''), chr(10) order by doc_id) as report from (select *, row_number() over (partition by lang order by doc_id) as rn from documents) where rn <= 3 group by lang",
)(_reports)
