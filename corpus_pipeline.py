"""Corpus pipeline: language ID, near-dedup, repeated passages, benchmark decontamination, SentencePiece ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents.

Defined results: a stage judges rows, not ids: what tells rows apart is the id with a hash of the other columns (KEY), so
rows of an equal or null id are judged each by itself. Rows equal in every column are copies of each other, of which
near_dedup leaves one. Null or empty text has no letter, so language_id drops it; a stage that is given one keeps it, all
such rows but one being copies for near_dedup. Columns beyond those of documents are carried; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaestor.llm import langid, leaks, pieces, repeats, simhash
from quaestor.llm.common import discard, scratch, table, written
from quaestor.llm.queries import tokenizer
from quaestor.llm.urlfilter import filter_row, passes

#: Shorter than the contract of the query on whole texts: a passage of fifty words has some 250 bytes.
REPEAT_BYTES = 200
KEY = "_row_key"


def row_key(docs: DataFrame) -> Column:
    return F.struct(F.col("doc_id"), F.xxhash64(*[F.col(c) for c in docs.columns if c != "doc_id"]).alias("h"))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(KEY, row_key(docs))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs but for the rows whose keys are in gone, a written table.

    Rows outside a bounded filter of those keys stay where they are: only the rows that go, and few others, are joined, so texts
    that are kept aren't shuffled. Beyond some millions of keys the filter fills up, and more and more rows are joined, equally exact.
    """
    size = max(64, min(simhash.SIEVE, -(-gone.count() * 12 // 64) * 64))
    sieve = filter_row(gone.select(F.col(KEY).alias("key")), 0, size, 3)
    rows, met = keyed(docs), passes(F.col(KEY), sieve, 0, size, 3)
    left = rows.where(met).join(gone, KEY, "left_anti")
    return rows.where(~met).unionByName(left.select(*rows.columns)).select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; the others go."""
    with scratch():
        gone = written(langid.identify(keyed(docs), KEY).where("not kept").select(KEY).distinct(), "gone", lasting=True)
    return without(docs, gone)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each near-duplicate component."""
    with scratch():
        placed = written(simhash.duplicates(keyed(docs), KEY), "placed")
        gone = written(placed.where(f"{KEY} != component_id").select(KEY).distinct(), "gone", lasting=True)
        again = written(placed.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(KEY), "again", lasting=True)
    left = without(docs, gone)
    if again.isEmpty():
        discard(again)
        return left
    # rows equal in every column have one key
    twice = keyed(left).join(again, KEY, "left_semi").dropDuplicates([KEY])
    return without(left, again).unionByName(twice.select(*docs.columns))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of REPEAT_BYTES or more that also stand elsewhere; lengths follow."""
    carried = docs.withColumn("_blank", F.col("text").isNull())
    left = repeats.remove_repeats(carried, length=REPEAT_BYTES, carry=carried.columns)
    text = F.when(~F.col("_blank"), F.col("kept_text"))
    size = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("bigint")).otherwise(F.col("n_chars"))
    return left.select(*[(text if c == "text" else size if c == "n_chars" else F.col(c)).alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    with scratch():
        found = leaks.find_leaks(keyed(docs), table(spark, sf_dir, "benchmark"), KEY)
        gone = written(found.select(KEY).distinct(), "gone", lasting=True)
    return without(docs, gone)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each remaining text, their number and digests."""
    return pieces.encode_decode(docs, tokenizer("piece_bpe_32k.model")).select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("piece_ids", piece_ids),
]

#: Languages, fingerprints, index and segmentation are beyond SQL; tests hold the stages against plain restatements.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; a stage's output is deleted once the next one's is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = docs
        docs = written(stage(spark, docs, sf_dir), name)
        discard(before)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
