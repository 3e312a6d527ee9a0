"""Queries of this package and their SQL; ``__spark_entry__`` adds them if the package can be imported."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import classlm, cotrain, idcoder, langid, leaks, lexical, negatives, outliers, pieces, repeats, simhash, urlfilter, warc
from .common import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back, segments reassembled."""
    return warc.roundtrip(table(spark, sf_dir, "pages"), min_revisit=0)


def op2_sentencepiece_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every whole text with begin and end ids, and the text decoded from them, as digests."""
    return pieces.encode_decode(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), outputs=False)


def op3_run_length_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that a 400-byte string standing elsewhere covers, a digest of the rest, and the rest as text."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), length=400).withColumnRenamed("kept_text", "text")


def op4_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that each document is good, from text and metadata views trained on each other."""
    return cotrain.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_context_mixing_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text written to range-coded files and read back: place, count and checksum of each document's."""
    return idcoder.roundtrip(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=1)


def op6_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 4-word shingles, links at 4 or fewer differing bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word statistics, base rules and MCD verdict of every document."""
    out = outliers.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op8_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or a close paraphrase of one: a row per document and item."""
    return leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_language_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document from text, declaration and host evidence; kept false where none is clear."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page; hosts without a rule are judged by the cascade of listed names."""
    return urlfilter.judge(table(spark, sf_dir, "pages"), urlfilter.listed_keys(spark), urlfilter.RULES)


def op11_bit_sliced_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of each anchor and positive: rows of other labels that score half to nineteen twentieths of the positive."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("id") % 50 == 0)


def op12_brown_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and class-based log10 probability of every document; the model is fitted on four fifths of them."""
    return classlm.score(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 5 == 1)


def op13_windowed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item by their terms."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_warc_segments": op1_warc_segments, "op2_sentencepiece_chunks": op2_sentencepiece_chunks, "op3_run_length_repeats": op3_run_length_repeats, "op4_cotrained_quality": op4_cotrained_quality, "op5_context_mixing_coder": op5_context_mixing_coder, "op6_simhash_anchors": op6_simhash_anchors, "op7_quality_outliers": op7_quality_outliers, "op8_latent_leaks": op8_latent_leaks, "op9_language_evidence": op9_language_evidence, "op10_bloom_cascade": op10_bloom_cascade, "op11_bit_sliced_negatives": op11_bit_sliced_negatives, "op12_brown_perplexity": op12_brown_perplexity, "op13_windowed_search": op13_windowed_search}


def oracle_sql() -> dict[str, str]:
    return {"op1_warc_segments": warc.oracle(), "op10_bloom_cascade": urlfilter.oracle(), "op11_bit_sliced_negatives": negatives.oracle(), "op13_windowed_search": lexical.oracle()}
