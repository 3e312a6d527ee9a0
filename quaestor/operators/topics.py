"""Documents of a topic by citations, anchors in names, and a log of calls."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def topic_documents(citations: DataFrame) -> DataFrame:
    """(topic, doc, cited, paragraphs) of citations (topic, doc, paragraph): all cited paragraphs, most cited first, as '3, 5(2x)'.

    Counted before anything is gathered; what is gathered is the different paragraphs of one document in one topic. A citation
    without a paragraph counts for its document only.
    """
    by = citations.groupBy("topic", "doc", "paragraph").agg(F.count(F.lit(1)).alias("n"))
    spelt = lambda x: F.concat(x["paragraph"].cast("string"), F.when(-x["n"] > 1, F.concat(F.lit("("), -x["n"], F.lit("x)"))).otherwise(""))
    known = F.array_sort(F.collect_list(F.when(F.col("paragraph").isNotNull(), F.struct((-F.col("n")).alias("n"), "paragraph"))))
    return by.groupBy("topic", "doc").agg(F.sum("n").alias("cited"), known.alias("p")).select("topic", "doc", "cited", F.array_join(F.transform("p", spelt), ", ").alias("paragraphs"))


def topic_map(citations: DataFrame, topic: str, limit: int = 20) -> DataFrame:
    """The ``limit`` documents most cited in a topic, spelt with or without accents. ValueError with the topics that there are if there is
    none of this name: an empty answer would read as not judged."""
    of = citations.where(T.fold(F.col("topic")) == T.fold(F.lit(topic)))
    if of.isEmpty():
        names = [r.topic for r in citations.select("topic").distinct().orderBy("topic").limit(50).collect()]
        raise ValueError(f"no topic {topic!r}; the first that there are: {names}")
    return topic_documents(of).orderBy(F.desc("cited"), "doc").limit(limit)


def first_anchor(name: Column, anchors: list[tuple[str, str]]) -> Column:
    """Value of the first anchor (needle, value) whose folded needle stands in the folded name; null if none does."""
    folded = T.fold(name)
    return F.coalesce(*[F.when(F.contains(folded, T.fold(F.lit(needle))), F.lit(value)) for needle, value in anchors], F.lit(None).cast("string"))


def curated(table: DataFrame, needle: str, value: str, order: str, most: int = 1000) -> list[tuple[str, str]]:
    """A curated list of anchors from a table, in its order. ValueError for a table of more than ``most`` rows: that is no curated list."""
    rows = table.where(F.col(needle).isNotNull()).orderBy(order).select(needle, value).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} anchors")
    return [(r[0], r[1]) for r in rows]


def append_log(calls: DataFrame, path: str, texts: list[str]) -> bool:
    """Append a JSON line for each call, without the columns that hold texts of documents; whether it could be written.

    A log that can't be written doesn't fail the search that it tells of.
    """
    try:
        kept = calls.drop(*texts)
        kept.select(F.to_json(F.struct(*kept.columns)).alias("value")).write.mode("append").text(path)
    except (PySparkException, Py4JJavaError):  # the latter: a file that cannot be made
        return False
    return True
