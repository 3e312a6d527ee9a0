"""Result lists as XML texts of any length, written by many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.relational import positions


def xml_rows(rows: DataFrame, group: str, order: str, fields: list[str], root: str = "resultados") -> DataFrame:
    """(group, place, xml): a group's XML text as rows: at place 0 its head with the total, then an element a row, at last its foot.

    Empty fields are left out. Places are dealt over ranges of (group, order), so a group of any size is no task of its own; the value
    of ``order`` may stand once in a group.
    """
    keyed = rows.withColumn("_k", F.struct(group, order))
    totals = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first"))
    places = positions(keyed, "_k")
    firsts = places.join(totals.select(F.struct(group, F.col("_first").alias(order)).alias("_k"), "_n"), "_k").select(F.col(f"_k.{group}").alias("_g"), F.col("pos").alias("_start"), "_n")

    def field(name: str) -> Column:
        value = F.col(name).cast("string")
        return F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"    <{name}>"), T.xml_escape(value), F.lit(f"</{name}>")))

    place = (F.col("pos") - F.col("_start") + 1).alias("place")
    lines = F.concat_ws("\n", F.concat(F.lit('  <resultado indice="'), F.col("place"), F.lit('">')), *map(field, fields), F.lit("  </resultado>"))
    numbered = places.join(firsts, F.col(f"_k.{group}").eqNullSafe(F.col("_g"))).select("_k", place)
    elements = keyed.join(numbered, "_k").select(group, "place", lines.alias("xml"))
    ends = F.array(F.struct(F.lit(0).cast("bigint").alias("place"), F.concat(F.lit(f'<{root} total="'), "_n", F.lit('">')).alias("xml")), F.struct((F.col("_n") + 1).alias("place"), F.lit(f"</{root}>").alias("xml")))
    return elements.unionByName(totals.select(group, F.explode(ends).alias("e")).select(group, "e.place", "e.xml"))


def write_xml(rows: DataFrame, group: str, path: str) -> None:
    """Rows of xml_rows() as one folder a group; its part files in the order of their names are the text."""
    rows.repartitionByRange(group, "place").sortWithinPartitions(group, "place").select(group, F.col("xml").alias("value")).write.partitionBy(group).text(path)


def read_xml(spark: SparkSession, path: str, group: str, fields: list[str]) -> DataFrame:
    """(group, indice, fields as text) of what write_xml() wrote: the text source cuts at the end of each element, fields left out are null.

    The XML source isn't used: over whole texts it was measured to leave rows out.
    """
    elements = spark.read.option("lineSep", "  </resultado>\n").text(path).where(F.contains("value", F.lit('<resultado indice="')))

    def field(name: str) -> Column:
        value = F.nullif(F.regexp_extract("value", f"<{name}>([^<]*)</{name}>", 1), F.lit(""))
        for code, sign in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
            value = F.replace(value, F.lit(code), F.lit(sign))
        return value.alias(name)

    return elements.select(group, F.regexp_extract("value", r'<resultado indice="(\d+)"', 1).cast("bigint").alias("indice"), *map(field, fields))
