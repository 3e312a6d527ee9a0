"""URL filters by path rules and a Bloom filter cascade (operator 10); DataFrame functions only.

The cascade encodes a list of keys exactly over a known universe, the keys of the corpus itself. Level 1 is a Bloom
filter of the listed keys; level 2 holds the unlisted keys of the universe that pass level 1; level 3 the listed keys
that pass level 2; and so on until nothing wrong passes. A key's answer is the parity of the first level that it fails,
so the lookup is a few bit tests in an expression: no join, no shuffle of the pages.

Building: the universe is the distinct hosts of the corpus; listed are those with a listed host or parent domain, found
on the distinct hosts only, and marked by one aggregation over the union of both sets.
A level is a groupBy that ORs bits into 64-bit words; it comes to each task as a scalar. Its size follows the list,
not the corpus: about ``bits`` bits a listed key. Beyond ``MOST_BYTES`` the lookup is an ordinary join instead, equally exact.

Defined results: null url, or one without "://": empty host and path, no rule, no key, allow. Repeated urls are judged
alike. An empty list blocks nothing by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MOST_BYTES = 64 << 20

#: Fixed rules of the contract: (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Listed names and the domains under which each is listed.
LISTED_NAMES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
LISTED_UNDER = ["example.com", "example.net", "example.org"]


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host_col: Column, path_col: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as struct(verdict, rule); null if none does."""
    tests = []
    for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host_col == h) | host_col.endswith("." + h)) & path_col.startswith(p)
        tests.append(F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))))
    return F.coalesce(*tests) if tests else F.lit(None).cast("struct<verdict:string,rule:string>")


def host_keys(host_col: Column) -> Column:
    """The host and its parent domains."""
    labels = F.split(host_col, r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.when(host_col != "", ends).otherwise(F.array().cast("array<string>"))


def _spots(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level * 16 + i)), F.lit(bits).cast("bigint")) for i in range(hashes)]


def filter_row(holds: DataFrame, level: int, size: int, hashes: int) -> DataFrame:
    """One row with the words, 64 bits each, of a Bloom filter of the column ``key``; bits are ORed before they are gathered."""
    spot = F.explode(F.array(*_spots(F.col("key"), level, size, hashes)))
    words = holds.select(spot.alias("at")).groupBy(F.expr("at div 64").alias("id")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("set"))
    every = holds.sparkSession.range(size // 64).join(words, "id", "left").select("id", F.coalesce("set", F.lit(0).cast("bigint")).alias("set"))
    dense = F.transform(F.array_sort(F.collect_list(F.struct("id", "set"))), lambda x: x["set"])
    return every.agg(dense.alias("words"))


def filter_words(holds: DataFrame, level: int, size: int, hashes: int) -> DataFrame:
    """filter_row as a written table."""
    return written(filter_row(holds, level, size, hashes), f"level{level}")


def passes(key: Column, words: DataFrame, level: int, size: int, hashes: int) -> Column:
    """Whether a key passes a filter of filter_row or filter_words."""
    test = F.lit(True)
    for at in _spots(key, level, size, hashes):
        word = F.get(words.scalar(), F.floor(at / 64).cast("int"))
        test = test & (F.expr("0L") != word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % 64).cast("int"))))
    return test


class Cascade:
    """Levels of (bits, hashes, one-row DataFrame with the filter's words)."""

    def __init__(self, listed: DataFrame, universe: DataFrame, bits: int = 10):
        """Both have one string column ``key``."""
        both = listed.select("key", F.lit(1).alias("l"), F.lit(0).alias("u")).unionByName(universe.select("key", F.lit(0).alias("l"), F.lit(1).alias("u")))
        marked = both.where("key is not null").groupBy("key").agg(F.max("l").alias("l"), F.max("u").alias("u"))
        marked = written(marked, "universe")
        self.levels: list[tuple[int, int, DataFrame]] = []
        self.exact = listed.select("key").distinct()
        holds, others = marked.where("l = 1").select("key"), marked.where("l = 0").select("key")
        left = holds.count()
        while left:
            level = len(self.levels)
            per_key, hashes = (bits, 3) if level == 0 else (3, 2)
            size = max(64, -(-left * per_key // 64) * 64)
            self.levels.append((size, hashes, self._filter(holds, level, size, hashes) if size // 8 <= MOST_BYTES else None))
            if self.levels[-1][2] is None:
                return
            wrong = written(others.where(self._passes(F.col("key"), level)), "passed")
            left = wrong.count()
            holds, others = wrong, holds

    @staticmethod
    def _filter(holds: DataFrame, level: int, size: int, hashes: int) -> DataFrame:
        return filter_words(holds, level, size, hashes)

    def _passes(self, key: Column, level: int) -> Column:
        size, hashes, words = self.levels[level]
        return passes(key, words, level, size, hashes)

    def holds(self, key: Column) -> Column:
        """Whether a key of the universe, or a listed key, is listed."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            answer = F.when(self._passes(key, level), answer).otherwise(F.lit(level % 2 == 1))
        return answer


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, listed, verdict (allow or block)."""
    parts = pages.select(F.col(id_col).alias("_id"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))
    universe = written(parts.select(F.col("host").alias("key")).distinct(), "hosts")
    under = universe.select("key", F.explode(host_keys(F.col("key"))).alias("end"))
    hit = under.join(listed.select(F.col("key").alias("end")).distinct(), "end", "left_semi").select("key").distinct()
    cascade = Cascade(written(hit, "listed"), universe)
    if any(x[2] is None for x in cascade.levels):  # the list is beyond the bound
        marked = cascade.exact.select(F.col("key").alias("host"), F.lit(True).alias("listed"))
        parts = parts.join(marked, "host", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    else:
        parts = parts.withColumn("listed", cascade.holds(F.col("host")))
    found = parts.withColumn("_rule", rule_for(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return found.select(F.col("_id").alias(id_col), "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce(F.col("_rule.verdict"), own).alias("verdict"), "listed")


def listed_keys(spark: SparkSession, names: list[str] = LISTED_NAMES, under: list[str] = LISTED_UNDER) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*[F.lit(f"{n}.{d}") for n in names for d in under])).alias("key"))


def oracle() -> str:
    """DuckDB SQL of judge() on pages with RULES and the listed names."""
    fits = "(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')"
    longest = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    rule = " ".join(f"when {fits.format(h=h, p=p)} then '{h + p}'" for _, h, p in longest)
    verdict = " ".join(f"when {fits.format(h=h, p=p)} then '{v}'" for v, h, p in longest)
    keys = [f"{n}.{d}" for n in LISTED_NAMES for d in LISTED_UNDER]
    listed = " or ".join(f"host = '{k}' or ends_with(host, '.{k}')" for k in keys)
    return f"""
with parts as (
  select page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages
), marked as (select *, ({listed}) as listed from parts)
select page_id, host, path, case {rule} end as rule,
       case {verdict} when listed then 'block' else 'allow' end as verdict, listed
from marked"""
