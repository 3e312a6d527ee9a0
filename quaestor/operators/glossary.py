"""Entries of a glossary in running text: leftmost, longest, none within another."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

WORD = r"([\p{L}\p{N}]+)"


def entries(glossary: DataFrame, term_col: str) -> DataFrame:
    """(gram, size, term): the folded words of each term, the least term of those that fold to the same."""
    words = F.regexp_extract_all(T.fold(F.col(term_col)), F.lit(WORD), F.lit(1))
    cut = glossary.select(F.array_join(words, " ").alias("gram"), F.size(words).alias("size"), F.col(term_col).alias("term"))
    return cut.where("size > 0").groupBy("gram", "size").agg(F.min("term").alias("term"))


def matches(docs: DataFrame, glossary: DataFrame, id_col: str = "doc_id", text_col: str = "text", term_col: str = "term") -> DataFrame:
    """(row, pos, size, term): what a reader from left to right marks, at each place the longest entry, going on after it.

    Runs of words of the entries' lengths are joined with the entries by equality, one row for a hit. Hits that overlap form clusters, parted
    by a running maximum of their ends; within a cluster, a few hits, a fold picks them. Rows of an equal key are one text each.
    """
    known = entries(glossary, term_col)
    sizes = [r.size for r in known.select("size").distinct().collect()]  # as many as there are lengths of entries
    if not sizes:
        return docs.select(F.col(id_col).alias("row"), F.lit(0).alias("pos"), F.lit(0).alias("size"), F.lit("").alias("term")).limit(0)
    words = docs.select(F.monotonically_increasing_id().alias("_n"), F.col(id_col).alias("row"), F.regexp_extract_all(T.fold(F.col(text_col)), F.lit(WORD), F.lit(1)).alias("words"))
    grams = words.select("_n", "row", F.explode(F.array(*map(F.lit, sorted(sizes)))).alias("size"), "words")
    runs = F.transform(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1), lambda k: F.struct(k.alias("pos"), F.array_join(F.slice("words", k, F.col("size")), " ").alias("gram")))
    grams = grams.where(F.size("words") >= F.col("size")).select("_n", "row", "size", F.explode(runs).alias("g")).select("_n", "row", "size", "g.pos", "g.gram")
    met = grams.join(known, ["gram", "size"]).select("_n", "row", "pos", "size", "term")
    longest = met.groupBy("_n", "row", "pos").agg(F.max(F.struct("size", "term")).alias("m")).select("_n", "row", "pos", "m.size", "m.term")
    before = Window.partitionBy("_n").orderBy("pos")
    reach = F.max(F.col("pos") + F.col("size")).over(before.rowsBetween(Window.unboundedPreceding, -1))
    parted = longest.withColumn("cluster", F.sum(F.when(F.col("pos") >= F.coalesce(reach, F.lit(0)), 1).otherwise(0)).over(before.rowsBetween(Window.unboundedPreceding, 0)))
    hits = parted.groupBy("_n", "row", "cluster").agg(F.array_sort(F.collect_list(F.struct("pos", "size", "term"))).alias("hits"))
    start = F.struct(F.lit(0).alias("free"), F.array().cast("array<struct<pos:int,size:int,term:string>>").alias("out"))
    step = lambda acc, x: F.when(x["pos"] >= acc["free"], F.struct((x["pos"] + x["size"]).alias("free"), F.concat(acc["out"], F.array(x)).alias("out"))).otherwise(acc)
    picked = hits.select("row", F.explode(F.aggregate("hits", start, step, lambda acc: acc["out"])).alias("h"))
    return picked.select("row", (F.col("h.pos") - 1).alias("pos"), "h.size", "h.term")
