"""Quality rules: robust multivariate outliers (operator 7).

Word statistics of each whole text become a vector; per language and source a minimum-covariance-determinant (MCD)
estimate gives centre and scatter, and a Mahalanobis distance beyond a cut-off rejects the document.

Distribution: the texts are read once (map only). Everything after works on one small row per document. A C-step of
the MCD is: squared distance by a native expression, the h-quantile of the distances from counts per (group, bin),
sums and cross products of the nearest h by a partially aggregated groupBy. No group is ever gathered, so a source
with a third of all rows costs what any other rows cost.

Defined results: null text = no word; null lang or source = the group of the empty name; a group with fewer than
``min_group`` usable documents uses the estimate of its language, a language with fewer the estimate over all, and
if even these are fewer nothing is rejected by distance. Ties at the h-quantile are all taken in. Repeated rows are
separate documents.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, binned_quantile, spread, written

SYMBOLS = "#*$%&|<>"
_HAS_WORD = re.compile(f"[^{SPACES}]")
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
DIMS = ["x0", "x1", "x2", "x3", "x4"]
#: Groups up to which their estimates (some 400 bytes each) are broadcast.
SMALL = 20_000
#: Scatter below which a coordinate is not estimated (most texts have no symbol and no repeated line) but set to this.
FLOORS = np.array([0.1, 0.02, 0.8, 0.8, 0.6])
#: Units in which the starts measure how far a text is from the medians.
UNITS = np.array([0.6, 0.05, 0.8, 0.8, 0.6])


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found twice or more in the list."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
    pairs = ids[:-1] * len(seen) + ids[1:]
    _, pairs = np.unique(pairs, return_inverse=True)
    _, code, times = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
    twice = times[code] > 1
    cover = np.zeros(len(ids), dtype=bool)
    for k in range(3):
        cover[k : k + len(twice)] |= twice
    return int(cover.sum())


def text_stats(text: str | None) -> tuple[int, ...]:
    """Values of STATS for one text."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.encode().split()
    lines = [x for x in text.split("\n") if _HAS_WORD.search(x)]
    return (
        len(words),
        len(text) - sum(text.count(c) for c in SPACES),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


def with_stats(docs: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """``keep`` columns and STATS of each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_stats(x.as_py()) for x in batch.column("_text")]
            cols = np.array(rows, dtype=np.int64).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in keep] + [pa.array(cols[:, i]) for i in range(len(STATS))], names=[*keep, *STATS]
            )

    few = docs.select(*keep, F.col(text_col).alias("_text"))
    kinds = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in few.schema.fields[:-1]] + [f"{s} bigint" for s in STATS])
    return spread(few).mapInArrow(run, kinds)


def _vector() -> list[Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log(words).alias("x0"),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words).alias("x1"),
        F.log1p(100.0 * F.col("n_symbols") / words).alias("x2"),
        F.log1p(100.0 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("x3"),
        F.log1p(100.0 * F.col("n_repeat_words") / words).alias("x4"),
    ]


def _distance() -> Column:
    """Squared Mahalanobis distance of x0.. to the columns centre and inverse (row major)."""
    p = len(DIMS)
    diff = [F.col(d) - F.col("centre")[i] for i, d in enumerate(DIMS)]
    terms = [diff[i] * diff[j] * F.col("inverse")[i * p + j] * (1.0 if i == j else 2.0) for i in range(p) for j in range(i, p)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def _moments(df: DataFrame, keys: list[str]) -> DataFrame:
    p = len(DIMS)
    sums = [F.sum(d).alias(f"s{i}") for i, d in enumerate(DIMS)]
    cross = [F.sum(F.col(DIMS[i]) * F.col(DIMS[j])).alias(f"c{i}_{j}") for i in range(p) for j in range(i, p)]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums, *cross)


def chi_square(x: float, p: int) -> float:
    """Distribution function of a chi-square variable of p degrees of freedom."""
    term = total = 2 / p
    n = 1
    while term > 1e-16 * total:
        term *= x / 2 / (p / 2 + n)
        total += term
        n += 1
    return total * math.exp(p / 2 * math.log(x / 2) - x / 2 - math.lgamma(p / 2))


def consistency(share: float, p: int) -> float:
    """Factor that makes the scatter of the nearest ``share`` of p normal coordinates that of all."""
    if p == 0 or share >= 1:
        return 1.0
    low, high = 1e-9, 1e3
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, p) < share else (low, mid)
    return share / chi_square(high, p + 2)


def _fit(moments: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Centre, inverse scatter and log determinant per row of moments."""
    p = len(DIMS)
    factor = [consistency(share, k) for k in range(p + 1)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.to_dict("records"):
                centre = np.array([r[f"s{i}"] for i in range(p)]) / r["n"]
                cov = np.empty((p, p))
                for i in range(p):
                    for j in range(i, p):
                        cov[i, j] = cov[j, i] = r[f"c{i}_{j}"] / r["n"] - centre[i] * centre[j]
                cov = np.round(cov, 9)
                cov *= factor[int((np.diag(cov) >= FLOORS**2).sum())]
                cov += np.diag(np.maximum(FLOORS**2 - np.diag(cov), 0.0))
                out.append({k: r[k] for k in keys} | {"centre": np.round(centre, 9).tolist(), "inverse": np.linalg.inv(cov).ravel().tolist(), "logdet": round(float(np.linalg.slogdet(cov)[1]), 6), "n": r["n"]})
            yield pd.DataFrame(out, columns=[*keys, "centre", "inverse", "logdet", "n"])

    kinds = ", ".join(f"{k} {moments.schema[k].dataType.simpleString()}" for k in keys)
    return moments.mapInPandas(run, f"{kinds}, centre array<double>, inverse array<double>, logdet double, n bigint")


def mcd(points: DataFrame, share: float = 0.75, steps: int = 4) -> DataFrame:
    """MCD per group ``g`` of points (g, x0..): centre, inverse, logdet, n.

    Two deterministic starts per group (medians with scaled deviations; spatial signs around the medians), ``steps``
    C-steps of each, the lower determinant wins. The scatter is corrected for consistency; a coordinate whose own is below
    FLOORS is raised to it, so one that is constant in a group doesn't make the scatter singular.
    """
    wide = points.select("g", F.explode(F.array(*[F.struct(F.lit(i).alias("dim"), F.col(d).alias("v")) for i, d in enumerate(DIMS)])).alias("e")).select("g", "e.dim", "e.v")
    grid = 512.0
    medians = binned_quantile(wide.withColumn("bin", F.round(F.col("v") * grid).cast("int")), ["g", "dim"], "bin", 0.5, "med")
    medians = medians.groupBy("g").pivot("dim", list(range(len(DIMS)))).agg(F.first("med") / grid)
    medians = written(medians.select("g", *[F.col(str(i)).alias(f"m{i}") for i in range(len(DIMS))]), "medians")
    # a row per group: sent to all tasks where that is small, so that a hot group isn't dealt by its name
    small = F.broadcast if medians.count() <= SMALL else (lambda df: df)
    away = points.join(small(medians), "g")
    unit = [(F.col(d) - F.col(f"m{i}")) / F.lit(float(UNITS[i])) for i, d in enumerate(DIMS)]
    length = F.sqrt(sum((u * u for u in unit[1:]), unit[0] * unit[0]))
    # start 0: nearest to the medians in UNITS; start 1: drawn in to unit length first
    first = away.select("g", F.explode(F.array(F.lit(0), F.lit(1))).alias("start"), *DIMS, *[f"m{i}" for i in range(len(DIMS))], length.alias("_far"))
    pull = F.when((F.col("start") == 1) & (F.col("_far") > 1), 1 / F.col("_far")).otherwise(F.lit(1.0))
    near = first.withColumn("bin", F.floor(F.least(F.col("_far"), F.lit(1e6)) * 64).cast("int"))
    half = binned_quantile(near.where("start = 0").withColumnRenamed("g", "hg"), ["hg"], "bin", 0.5, "cut")
    kept = near.join(small(half), F.col("g") == F.col("hg")).where((F.col("start") == 1) | (F.col("bin") <= F.col("cut")))
    pulled = kept.select("g", "start", *[(F.col(f"m{i}") + (F.col(d) - F.col(f"m{i}")) * pull).alias(d) for i, d in enumerate(DIMS)])
    model = written(_fit(_moments(pulled, ["g", "start"]), ["g", "start"], share), "mcd")
    for _ in range(steps):
        far = points.join(small(model.select("g", "start", "centre", "inverse")), "g").withColumn("bin", F.floor(F.log2(1 + F.greatest(_distance(), F.lit(0.0))) * 64).cast("int"))
        cut = binned_quantile(far, ["g", "start"], "bin", share, "cut")
        kept = far.drop("centre", "inverse").join(small(cut), ["g", "start"]).where("bin <= cut")
        model = written(_fit(_moments(kept, ["g", "start"]), ["g", "start"], share), "mcd")
    best = F.min_by(F.struct("centre", "inverse", "logdet", "n"), F.struct("logdet", "start")).alias("m")
    return model.groupBy("g").agg(best).select("g", "m.*")


def judge(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", lang_col: str = "lang", source_col: str = "source", min_words: int = 50, repeat_share: int = 50, cutoff: float = 25.74, min_group: int = 200) -> DataFrame:
    """One row per document: id, STATS, base_failed, distance (squared, null where no estimate applies), kept.

    ``cutoff`` is on the squared distance: the 0.9999 point of a chi-square variable of five degrees of freedom. Each
    statistic alone can pass it.
    """
    few = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("_lang"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("_source"), F.col(text_col).alias("_body"))
    stats = with_stats(few, ["_id", "_lang", "_source"], "_body")
    failed = (F.col("n_words") < min_words) | (F.lit(100) * F.col("n_repeat_words") > F.lit(repeat_share) * F.col("n_words"))
    stats = written(stats.withColumn("base_failed", failed), "stats")
    levels = F.array(F.struct("_lang", "_source").cast("struct<l:string,s:string>"), F.struct(F.col("_lang"), F.lit(None).cast("string")).cast("struct<l:string,s:string>"), F.struct(F.lit(None).cast("string"), F.lit(None).cast("string")).cast("struct<l:string,s:string>"))
    usable = stats.where(~F.col("base_failed")).select(levels.alias("_levels"), *_vector())
    points = usable.select(F.explode("_levels").alias("level"), *DIMS).select(F.to_json("level").alias("g"), *DIMS)
    big = points.groupBy("g").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_group).select("g")
    models = mcd(points.join(big, "g", "left_semi")).select("g", "centre", "inverse")
    models = written(models, "models")
    names = [f"g{i}" for i in range(3)]
    out = stats.select("*", levels.alias("_levels"), *_vector()).select("*", *[F.to_json(F.col("_levels")[i]).alias(n) for i, n in enumerate(names)])
    # the finest level with an estimate, found on the few distinct groups
    pick = out.select(*names).distinct()
    for i, n in enumerate(names):
        pick = pick.join(models.select(F.col("g").alias(n), F.struct("centre", "inverse").alias(f"e{i}")), n, "left")
    pick = written(pick.select(F.col("g0"), F.coalesce("e0", "e1", "e2").alias("e")).where("e is not null").select("g0", "e.centre", "e.inverse"), "pick")
    far = F.when(~F.col("base_failed") & F.col("centre").isNotNull(), F.round(_distance(), 6))
    out = out.join(pick, "g0", "left").withColumn("distance", far)
    return out.select(F.col("_id").alias(id_col), *STATS, "base_failed", "distance", (~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))).alias("kept"))
