"""Joins, merges, windows and reports of the retrieval library, over DataFrames of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.files import scratch

RISKS = ["vermelho", "amarelo", "verde"]


def first_non_empty(*columns: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def route_key(text: Column, judge: Column) -> Column:
    """Match key of a ruling; null for short texts, which never match."""
    key = T.ementa_key(text)
    return F.when(key.isNotNull(), F.concat_ws("|", key, T.alnum_key(judge)))


def two_routes(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer match of two ranked result lists (pos, key, and any other columns).

    Keys match only if they stand once on either side; a null key never matches. Columns come back as structs l and r with
    origin and the rank of the merged list, which interleaves both sides beginning with the left one; a pair takes the
    earlier place. Counting is a partial aggregation, so a key that half of the rows share is one row before the join.
    """

    def unique(df: DataFrame) -> DataFrame:
        once = df.where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("pos")).where("n = 1")
        return once.select("key", "pos")

    pairs = unique(left).withColumnRenamed("pos", "lpos").join(unique(right).withColumnRenamed("pos", "rpos"), "key").select("lpos", "rpos")
    one = left.select(F.struct(*left.columns).alias("l"), F.col("pos").alias("lpos")).join(pairs, "lpos", "left")
    two = right.select(F.struct(*right.columns).alias("r"), F.col("pos").alias("rpos"))
    both = one.join(two, "rpos", "full_outer")
    place = F.least(2 * F.col("l.pos"), 2 * F.col("r.pos") + 1)
    origin = F.when(F.col("l").isNotNull() & F.col("r").isNotNull(), "ambas").when(F.col("l").isNotNull(), "api-nova").otherwise("portal-antigo")
    return both.select("l", "r", origin.alias("origin"), place.alias("place"))


def quota_round_robin(rows: DataFrame, source: str, order: str, key: list[str], n: int, sources: int) -> DataFrame:
    """ceil(n / sources) first rows of each source, dealt in turns, first of each key, n at most."""
    quota = -(-n // sources)
    turn = F.row_number().over(Window.partitionBy(source).orderBy(order))
    dealt = rows.withColumn("turn", turn).where(F.col("turn") <= quota)
    best = dealt.withColumn("rn", F.row_number().over(Window.partitionBy(*key).orderBy("turn", source))).where("rn = 1").drop("rn")
    return best.orderBy("turn", source).limit(n)


def cascade(rows: DataFrame, keys: list[str], language: str, order: list[str]) -> DataFrame:
    """Per key the row of the first language in ``order`` that there is; other languages come last, by name."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col(language))
    rest = [c for c in rows.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(F.when(rank > 0, rank).otherwise(99), F.col(language))).alias("b")
    return rows.groupBy(*keys).agg(best).select(*keys, "b.*")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows win column by column where they aren't null; keys match null-safely."""
    on = None
    for k in keys:
        eq = F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}"))
        on = eq if on is None else on & eq
    return old.alias("o").join(new.alias("n"), on, "full_outer").select(*[F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in old.columns])


def outliers(rows: DataFrame, doc: str, size: Column, factor: int = 10, least: int = 3) -> DataFrame:
    """Rows at least ``factor`` times their document's median size; documents of fewer than ``least`` rows have none."""
    sized = rows.withColumn("_size", size)
    mid = sized.groupBy(doc).agg(F.median("_size").alias("median"), F.count(F.lit(1)).alias("n")).where((F.col("n") >= least) & (F.col("median") > 0))
    return sized.join(mid, doc).where(F.col("_size") >= factor * F.col("median")).drop("n")


def gaps(rows: DataFrame, key: str, number: str) -> DataFrame:
    """Per key the whole numbers that are missing between least and greatest."""
    got = rows.groupBy(key).agg(F.min(number).alias("lo"), F.max(number).alias("hi"), F.collect_set(number).alias("has"))
    return got.select(key, F.array_except(F.sequence("lo", "hi"), "has").alias("missing"))


def route_summary(calls: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Calls, availability, latency of those that ran (median, nearest-rank p90), share with a number; null where nothing counts.

    calls: ok, ms, n, with_cnj, not_called.
    """
    ran = F.when(F.col("ok") & ~F.col("not_called"), F.col("ms"))
    return calls.withColumn("_ran", ran).groupBy(*(key or [])).agg(
        F.count(F.lit(1)).alias("calls"),
        (F.count_if("ok") / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("availability"),
        F.median("_ran").alias("ms_median"),
        F.expr("percentile_disc(0.9) within group (order by _ran)").alias("ms_p90"),
        (F.sum("with_cnj") / F.nullif(F.sum("n"), F.lit(0))).alias("cnj_rate"),
    )


def risk_rank(c: Column) -> Column:
    return F.when(c == "vermelho", 0).when(c == "amarelo", 1).when(c == "verde", 2).otherwise(3)


def anti_known(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    on = None
    for k in keys:
        eq = F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        on = eq if on is None else on & eq
    return rows.alias("a").join(known.alias("b"), on, "left_anti")


def page(rows: DataFrame, order: list, start: int, size: int) -> DataFrame:
    """Rows start to start + size of an order; beyond the end is a mistake of the caller, not an empty page."""
    out = rows.orderBy(*order).offset(start).limit(size)
    if start and out.isEmpty():
        raise ValueError(f"page starts at {start}, beyond the last row")
    return out


def after_cursor(rows: DataFrame, cursor: str, last, size: int) -> DataFrame:
    """Keyset page: the next rows below the last one's cursor."""
    return (rows.where(F.col(cursor) < F.lit(last)) if last is not None else rows).orderBy(F.desc(cursor)).limit(size)


def interleave(rows: DataFrame, side: str, order: list, n: int) -> DataFrame:
    """Two lists told apart by a boolean column dealt in turns, true first."""
    rn = F.row_number().over(Window.partitionBy(side).orderBy(*order))
    # no more than n of a side can be shown: a task keeps n before they are dealt
    first = rows.withColumn("_rn", rn).where(F.col("_rn") <= n)
    return first.withColumn("place", F.when(F.col(side), 2 * F.col("_rn") - 2).otherwise(2 * F.col("_rn") - 1)).drop("_rn").orderBy("place").limit(n)


def positions(keys: DataFrame, order: str, out: str = "pos") -> DataFrame:
    """Places 0, 1, ... of the values of one column: the place within a range, after the ranges before. Deal only what is needed: a key."""
    path = scratch(keys.sparkSession, "positions")
    keys.select(order).repartitionByRange(order).select(order, F.spark_partition_id().alias("_p")).write.parquet(path)  # the deal is sampled: it is read twice, not made twice
    placed = keys.sparkSession.read.parquet(path).withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(order)))
    # a row for each range
    before = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).select("_p", "_before")
    return placed.join(before, "_p").select(order, (F.col("_before") + F.col("_r") - 1).alias(out))
