"""Language identification by Bayesian evidence fusion (operator 9).

posterior(l) ~ prior(l | host) * P(text | l) * P(declared | l) * P(address suffix | l)

* P(text | l): hashed byte 3-grams over letters, counted over every text by declared language (one map pass that sums per
  task, one small aggregation), add-one smoothed. A text counts as at most ``weight`` independent grams.
* prior(l | host): counts by grouped aggregation, smoothed towards the host's domain, that towards the whole table.
* P(declared | l), P(suffix | l): counts of what rows of a clear text language declare, add-one smoothed.

The driver holds the gram table only: 2^14 numbers a declared language, whatever the input. Scoring is a map pass;
fusion is native expressions over one small row per document, joined to the host table by host (a hot host is a
skew-splittable or broadcast join).

Defined results: languages are all codes that at least ``min_docs`` rows declare, most frequent first; missing evidence
(null or empty declaration, host, suffix) counts for nothing; a text without a gram has only the other evidence. Not kept
are a text without a letter, one whose best posterior is under ``least``, and one of 50 grams or more that fits its best
language worse than chance; but a text with a letter that declares a code of fewer than ``rare`` rows has that code and is kept
where it would not be. If no language is declared often enough, lang and prob are null and every text with a letter is
kept. Ties go to the language that is more frequent, then first in the alphabet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_batches, release, spread, utf8_parts, written

BUCKETS = 1 << 14
#: Languages whose grams a task holds at a time.
HELD = 256
#: Bytes as classes: ASCII letters lower-cased, bytes of other characters themselves, all else one space.
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], dtype=np.uint32)


def grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of the 3-gram from each byte, whether it counts, text of each byte); a gram lies in one text and has a letter."""
    folded = np.concatenate([_FOLD[data], np.full(2, 32, np.uint32)])
    whole = folded[:-2] << 16 | folded[1:-1] << 8 | folded[2:]
    bucket = (whole * np.uint32(2654435761)) >> np.uint32(18)
    text = np.repeat(np.arange(len(off) - 1), np.diff(off))
    counts = (folded[:-2] != 32) | (folded[1:-1] != 32)
    counts &= np.arange(len(data)) + 3 <= off[1:][text]
    return bucket.astype(np.int64), counts, text


def _languages(rows: DataFrame) -> list[tuple[str, int]]:
    """All declared codes with their rows, most frequent first."""
    found = rows.where("declared is not null").groupBy("declared").agg(F.count(F.lit(1)).alias("n"))
    return [(r.declared, r.n) for r in found.orderBy(F.desc("n"), "declared").collect()]


def _gram_counts(rows: DataFrame, langs: list[str]) -> np.ndarray:
    """Counts (language, bucket) over all rows that declare one of langs."""
    place = {x: i for i, x in enumerate(langs)}

    def packed(total: dict[int, np.ndarray]) -> pa.RecordBatch:
        at = {k: np.flatnonzero(v) for k, v in total.items()}
        lang = np.repeat(np.array(list(total), np.int32), [len(x) for x in at.values()])
        bucket = np.concatenate([*at.values(), np.zeros(0, np.int64)]).astype(np.int32)
        n = np.concatenate([*(total[k][x] for k, x in at.items()), np.zeros(0, np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(lang), pa.array(bucket), pa.array(n)], names=["lang", "bucket", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            own = np.array([place.get(x, -1) for x in batch.column("declared").to_pylist()], dtype=np.int64)
            for a, b in byte_batches(batch, "text"):
                data, off = utf8_parts(batch.column("text").slice(a, b - a))
                bucket, counts, text = grams(data, off)
                met, lang = np.unique(own[a:b], return_inverse=True)
                lang = lang[text]
                sums = np.bincount(lang[counts] * BUCKETS + bucket[counts], minlength=len(met) * BUCKETS).reshape(-1, BUCKETS)
                for k, row in zip(met.tolist(), sums, strict=True):
                    if k >= 0:
                        total[k] = total[k] + row if k in total else row.copy()
                if len(total) > HELD:
                    yield packed(total)
                    total = {}
        yield packed(total)

    summed = rows.select("declared", "text").mapInArrow(run, "lang int, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    out = np.zeros((len(langs), BUCKETS), np.int64)
    for r in summed.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("p")).toLocalIterator():
        for bucket, n in r.p:
            out[r.lang, bucket] = n
    return out


def _scored(rows: DataFrame, table: np.ndarray) -> DataFrame:
    """rows without text, with ll (mean log-likelihood of a gram per language) and n_grams."""
    keep = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for a, b in byte_batches(batch, "text"):
                data, off = utf8_parts(batch.column("text").slice(a, b - a))
                bucket, counts, text = grams(data, off)
                letters = np.bincount(text[_FOLD[data] != 32], minlength=b - a)
                bucket, text = bucket[counts], text[counts]
                n = np.bincount(text, minlength=b - a)
                ll = np.stack([np.bincount(text, weights=row[bucket], minlength=b - a) for row in table], axis=1) if len(table) else np.zeros((b - a, 0))
                ll = np.round(ll / np.maximum(n, 1)[:, None], 9)
                lists = pa.ListArray.from_arrays((np.arange(b - a + 1) * ll.shape[1]).astype(np.int32), pa.array(ll.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(k).slice(a, b - a) for k in keep] + [lists, pa.array(n, pa.int64()), pa.array(letters, pa.int64())], names=[*keep, "ll", "n_grams", "n_letters"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    return rows.mapInArrow(run, f"{kinds}, ll array<double>, n_grams bigint, n_letters bigint")


def _per_language(df: DataFrame, key: list[str], n: int) -> DataFrame:
    """Per key the array of rows per clear text language."""
    return df.groupBy(*key).agg(F.array(*[F.sum(F.when(F.col("best") == i, 1).otherwise(0)) for i in range(n)]).alias("seen"))


def _log(values: Column) -> Column:
    return F.transform(values, lambda x: F.log(x))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared_col: str = "lang", host_col: str = "source", min_docs: int = 1, rare: int = 20, weight: float = 40.0, least: float = 0.5, trust: float = 10.0) -> DataFrame:
    """One row per document: id, lang, prob, declared, n_grams, kept."""
    host = F.nullif(F.lower(F.col(host_col).cast("string")), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.col(text_col).alias("text"),
        F.nullif(F.lower(F.split(F.trim(F.col(declared_col).cast("string")), "[-_]")[0]), F.lit("")).alias("declared"),
        host.alias("host"),
        F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit("")).alias("domain"),
        F.nullif(F.regexp_extract(host, r"\.([^.]+)$", 1), F.lit("")).alias("suffix"),
    )
    rows = spread(rows)
    codes = _languages(rows)
    langs = [x for x, n in codes if n >= min_docs]
    few = {x for x, n in codes if n < rare}
    counts = _gram_counts(rows, langs)
    table = np.log((counts + 1) / (counts.sum(axis=1, keepdims=True) + BUCKETS)) if langs else np.zeros((0, BUCKETS))
    scored = written(_scored(rows, table), "scored")
    out = [F.col("_id").alias(id_col)]
    if not langs:
        return scored.select(*out, F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("prob"), "declared", "n_grams", (F.col("n_letters") > 0).alias("kept"))
    n = len(langs)
    # a clear text language: at least 20 grams; its best beats chance
    best = F.when((F.col("n_grams") >= 20) & (F.array_max("ll") > float(np.log(1 / BUCKETS))), F.array_position("ll", F.array_max("ll")).cast("int") - 1)
    clear = scored.withColumn("best", best)
    known = clear.where("best is not null")
    zeros = F.array_repeat(F.lit(0).cast("bigint"), n)
    total = known.agg(F.array(*[F.sum(F.when(F.col("best") == i, 1).otherwise(0)) for i in range(n)]).alias("seen")).first().seen
    total = np.array([x or 0 for x in total], dtype=float)
    share = F.array(*[F.lit(float(x)) for x in (total + 1) / (total.sum() + n)])

    def towards(seen: Column, parent: Column) -> Column:
        """Rows per language, smoothed by ``trust`` rows of the parent's shares."""
        rows_of = F.aggregate(seen, F.lit(0).cast("bigint"), lambda a, x: a + x)
        return F.zip_with(seen, parent, lambda s, p: (s + trust * p) / (rows_of + trust))

    domains = _per_language(known.where("domain is not null"), ["domain"], n).select("domain", towards(F.col("seen"), share).alias("domain_share"))
    hosts = _per_language(known.where("host is not null"), ["host", "domain"], n).join(domains, "domain", "left")
    hosts = hosts.select("host", _log(towards(F.col("seen"), F.coalesce("domain_share", share))).alias("host_log"))

    def given(column: str) -> DataFrame:
        """log P(value | language) for each value of a column."""
        by = _per_language(known.where(F.col(column).isNotNull()), [column], n)
        sums = by.agg(F.array(*[F.sum(F.col("seen")[i]) for i in range(n)]).alias("sums"), F.count(F.lit(1)).alias("kinds")).first()
        if not sums.kinds:
            return by.select(column, zeros.cast("array<double>").alias(f"{column}_log"))
        norm = F.array(*[F.lit(float(s + sums.kinds)) for s in sums.sums])
        return by.select(column, F.zip_with("seen", norm, lambda s, t: F.log((s + 1) / t)).alias(f"{column}_log"))

    near = scored.join(written(hosts, "hosts"), "host", "left")
    for column in ("declared", "suffix"):
        near = near.join(written(given(column), column), column, "left")
    flat = F.array_repeat(F.lit(0.0), n)
    scale = F.least(F.col("n_grams").cast("double"), F.lit(weight))
    prior = F.coalesce("host_log", _log(share))
    fused = F.zip_with(F.transform("ll", lambda x: x * scale), prior, lambda a, b: a + b)
    fused = F.zip_with(fused, F.coalesce("declared_log", flat), lambda a, b: a + b)
    fused = F.zip_with(fused, F.coalesce("suffix_log", flat), lambda a, b: a + b)
    near = near.withColumn("score", fused).withColumn("top", F.array_max("score"))
    prob = 1 / F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    at = F.array_position("score", F.col("top")).cast("int")
    lang = F.element_at(F.array(*[F.lit(x) for x in langs]), at)
    unlike = (F.col("n_grams") >= 50) & (F.element_at("ll", at) < float(np.log(1 / BUCKETS)))
    told = (F.col("prob") >= least) & ~unlike
    trusted = ~told & F.coalesce(F.col("declared").isin(*few), F.lit(False)) if few else F.lit(False)
    kept = (F.col("n_letters") > 0) & (told | trusted)
    return near.withColumn("prob", F.round(prob, 6)).select(*out, F.when(trusted, F.col("declared")).otherwise(lang).alias("lang"), "prob", "declared", "n_grams", kept.alias("kept"))
