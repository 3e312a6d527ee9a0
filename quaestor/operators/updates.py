"""Updates with their rules: what may be left out, what may not, and what is refused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import relational as R


def put_topics(old: DataFrame, new: DataFrame, keys: list[str], source: str) -> DataFrame:
    """Topics of documents after an update; reading a new row without provenance fails the job: it would be a guess that looks like a finding."""
    told = F.length(F.trim(F.coalesce(F.col(source), F.lit("")))) > 0
    checked = F.when(told, F.col(source)).otherwise(F.raise_error(F.concat(F.lit("a topic without provenance: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))).cast("string"))
    return R.upsert(old, new.withColumn(source, checked), keys)


def seeded(entries: DataFrame, provenance: DataFrame, key: str, source: str, default: str = "curadoria") -> DataFrame:
    """Entries of a glossary with their provenance; one that isn't known is the curators', never invented."""
    return entries.join(provenance.select(key, source).dropDuplicates([key]), key, "left").withColumn(source, F.coalesce(F.nullif(F.trim(source), F.lit("")), F.lit(default)))


def migrated(rows: DataFrame, columns: dict[str, Column], refused: list[str]) -> DataFrame:
    """Rows with the columns that later versions have, by their defaults where they are missing. ValueError for a layout that can't be read on."""
    if old := [c for c in refused if c in rows.columns]:
        raise ValueError(f"an index of an older layout ({', '.join(old)}): build it anew")
    return rows.withColumns({c: d for c, d in columns.items() if c not in rows.columns})


def put_cache(cache: DataFrame, entries: DataFrame, now: int) -> DataFrame:
    """A cache (mcp, key, body, fetched_at, ttl_s, hits) after entries (mcp, key, body, ttl_s) are put and what has expired is purged.

    The last entry of a key by ``seq`` counts, without a body it is none; a put starts the count of hits anew.
    """
    fresh = entries.where(F.length("body") > 0).groupBy("mcp", "key").agg(F.max_by(F.struct("body", "ttl_s"), "seq").alias("e"))
    fresh = fresh.select("mcp", "key", "e.body", F.lit(now).cast("bigint").alias("fetched_at"), F.col("e.ttl_s").cast("bigint").alias("ttl_s"), F.lit(0).cast("bigint").alias("hits"))
    kept = cache.join(fresh, ["mcp", "key"], "left_anti").select(*fresh.columns)
    return kept.unionByName(fresh).where(F.col("fetched_at") + F.col("ttl_s") >= now)
