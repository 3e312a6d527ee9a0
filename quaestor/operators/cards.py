"""Search that returns cards: filters, one hit for a passage that stands in several languages, its best language, and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .search import Index


def cards(index: Index, versions: DataFrame, query: str, preferred: str, order: list[str], filters: Column | None = None, articles: DataFrame | None = None, dialect: str = "fts5", limit: int = 10) -> DataFrame:
    """(place, work, part, found, lang, text, score, translate, suspect) of the best passages.

    versions: (row, work, part, lang, text, ...) of every indexed row; ``filters`` is a condition on it, ``articles`` holds the works (work)
    that may be returned. Both choose before rows are ranked, frequencies stay those of the whole index. Of the versions of a passage the best
    match counts, once; what is shown is the preferred language's, or else the first of ``order`` that there is. Reads the texts
    of the passages that are returned, no others.
    """
    among = versions if filters is None else versions.where(filters)
    among = among if articles is None else among.join(articles.select("work").distinct(), "work", "left_semi")
    narrowed = filters is not None or articles is not None
    # each passage may be matched in every language
    hits = index.search(query, dialect, limit * len(order), among=among if narrowed else None)
    told = hits.join(versions.select("row", "work", "part", F.col("lang").alias("found")), "row")
    once = told.withColumn("n", F.row_number().over(Window.partitionBy("work", "part").orderBy("score", "row"))).where("n = 1").orderBy("score", "row").limit(limit)
    # the rows of one search: a few
    placed = once.withColumn("place", F.row_number().over(Window.orderBy("score", "row"))).select("place", "work", "part", "found", "score")
    rank = F.array_position(F.array(*map(F.lit, [preferred, *[x for x in order if x != preferred]])), F.col("lang"))
    shown = versions.where(rank > 0).select("work", "part", "lang", "text", rank.alias("rank"), F.col("row").alias("version"))
    best = placed.join(shown, ["work", "part"], "left").groupBy("place", "work", "part", "found", "score").agg(F.min_by(F.struct("lang", "text"), F.struct("rank", "version")).alias("v"))
    lang = F.coalesce("v.lang", "found")
    return best.select("place", "work", "part", "found", lang.alias("lang"), F.col("v.text").alias("text"), "score", (lang != preferred).alias("translate"), F.coalesce(T.suspect(F.col("v.text")), F.lit(False)).alias("suspect"))


def case_card(cases: DataFrame, articles: DataFrame, reparations: DataFrame, versions: DataFrame, asked: str) -> DataFrame:
    """(case, others, articles, reparations, langs) of the case of the shortest name that holds what is asked; the other candidates are told.

    cases (case), articles (case, article), reparations (case, place, text), versions (case, lang). No row if no case is found. Only the chosen
    case's rows are gathered; names fold as far as ASCII goes.
    """
    named = cases.where(F.contains(F.lower("case"), F.lit(asked.strip().lower()))).select("case").distinct()
    order = Window.orderBy(F.length("case"), "case")  # the candidates of one request
    ranked = named.withColumn("n", F.row_number().over(order))
    others = ranked.agg(F.array_sort(F.collect_list(F.when(F.col("n") > 1, F.struct("n", "case")))).alias("o")).select(F.transform("o", lambda x: x["case"]).alias("others"))
    chosen = ranked.where("n = 1").select("case")
    numbered = articles.join(F.broadcast(chosen), "case").select("article").distinct().agg(F.array_sort(F.collect_list(F.struct(F.coalesce(F.col("article").try_cast("bigint"), F.lit(0)).alias("k"), "article"))).alias("a")).select(F.transform("a", lambda x: x["article"]).alias("articles"))
    listed = reparations.join(F.broadcast(chosen), "case").agg(F.array_sort(F.collect_list(F.struct("place", "text"))).alias("r")).select(F.transform("r", lambda x: x["text"]).alias("reparations"))
    langs = versions.join(F.broadcast(chosen), "case").agg(F.array_sort(F.collect_set("lang")).alias("langs"))
    # one row each
    return chosen.crossJoin(F.broadcast(others)).crossJoin(F.broadcast(numbered)).crossJoin(F.broadcast(listed)).crossJoin(F.broadcast(langs))
