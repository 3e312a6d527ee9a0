"""Checks that are taken in the pass that makes a result, and that fail it: no second scan, and no answer that looks like one and isn't."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.files import scratch


class Refused(Exception):
    """A result that must not be used, and why."""


def rows_within(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The rows, if all keep the rules that were asked of the source; reading one that doesn't fails the job, with the rule's name.

    A null counts as kept: a source may leave a field out. The check is part of the rows' own expression, so pruning can't drop it.
    """
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(rule, F.lit(True)), F.lit(name)) for name, rule in rules.items()]))
    found = F.when(F.size(broken) > 0, F.raise_error(F.concat(F.lit("the source ignored a filter: "), F.array_join(broken, ", ")))).otherwise(F.lit(True))
    return rows.where(found.cast("boolean"))


def settled(rows: DataFrame, checks: dict[str, tuple[Column, str]], name: str = "settled") -> tuple[DataFrame, dict]:
    """(rows as written, metrics): ``checks`` name an aggregate that must be 0 or false, and what is wrong if it isn't; Refused then.

    The aggregates are observed while the rows are written. A task that runs twice may count twice, so checks ask whether, not how many.
    """
    seen = Observation(name)
    path = scratch(rows.sparkSession, name)
    rows.observe(seen, *[agg.alias(k) for k, (agg, _) in checks.items()]).write.parquet(path)
    told = seen.get
    wrong = [why for k, (_, why) in checks.items() if told[k]]
    if wrong:
        gone = rows.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        gone.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration()).delete(gone, True)
        raise Refused("; ".join(wrong))
    return rows.sparkSession.read.schema(rows.schema).parquet(path), told


def answers(pages: DataFrame, body: str, hit: str) -> DataFrame:
    """(told, hits, ...) of JSON answers {"total": n, "hits": [...]}: one row each. An answer without either field fails the job: the contract has changed."""
    kept = [c for c in pages.columns if c != body]
    read = F.from_json(F.col(body), f"total bigint, hits array<struct<{hit}>>")
    whole = read["total"].isNotNull() & read["hits"].isNotNull()
    return pages.select(*kept, F.when(whole, read).otherwise(F.raise_error(F.concat(F.lit("an answer without total or hits: "), F.left(F.coalesce(F.col(body), F.lit("null")), F.lit(60)))).cast(f"struct<total:bigint,hits:array<struct<{hit}>>>")).alias("r")).select(*kept, F.col("r.total").alias("told"), F.col("r.hits").alias("hits"))


def hits_of(read: DataFrame) -> tuple[DataFrame, dict]:
    """The hits of ``answers``, a row each; Refused if an answer tells of hits and brings none. A zero that the source tells is a zero."""
    flat = read.withColumn("silent", (F.col("told") > 0) & (F.size("hits") == 0)).select("*", F.explode_outer("hits").alias("hit")).drop("hits")
    rows, told = settled(flat, {"silent": (F.max(F.coalesce("silent", F.lit(False)).cast("int")), "an answer tells of hits and brings none")}, "hits")
    return rows.where("hit is not null").drop("silent", "told"), told


