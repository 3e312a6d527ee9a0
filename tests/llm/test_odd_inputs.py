"""Every operator on nulls, empty and very long texts, ties, repeated rows, clashing columns and empty tables."""

import pytest
from pyspark.sql import functions as F

from quaestor.llm import cotrain, idcoder, langid, leaks, outliers, pieces, repeats, simhash, urlfilter, warc
from quaestor.llm.queries import tokenizer

BENCH = "item_id bigint, text string"


def bench(spark, rows=((1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, None), (3, ""), (4, "short"))):
    return spark.createDataFrame(list(rows), BENCH)


OPERATORS = {
    "op1": lambda s, d: warc.roundtrip(d, "doc_id", "source", "text"),
    "op2": lambda s, d: pieces.encode_decode(d, tokenizer("piece_bpe_32k.model")),
    "op3": lambda s, d: repeats.remove_repeats(d),
    "op4": lambda s, d: cotrain.quality(d, d.where("doc_id < 50").select("doc_id", (F.col("doc_id") % 2).alias("quality"), F.lit(None).cast("int").alias("toxic"))),
    "op5": lambda s, d: idcoder.roundtrip(d, tokenizer("word_bpe_49k.json")),
    "op6": lambda s, d: simhash.near_duplicates(d),
    "op6_similarity": lambda s, d: simhash.duplicates(d),
    "op7": lambda s, d: outliers.judge(d, min_group=10),
    "op9": lambda s, d: langid.identify(d, min_docs=5),
    "op10": lambda s, d: urlfilter.judge(d, urlfilter.listed_keys(s), urlfilter.RULES, "doc_id", "text"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_every_row(spark, odd, name):
    out = OPERATORS[name](spark, odd).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r.doc_id) for r in odd.select("doc_id").collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, empty, name):
    assert OPERATORS[name](spark, empty).count() == 0


def test_leaks(spark, odd, empty):
    assert leaks.find_leaks(odd, bench(spark)).count() == 0
    assert leaks.find_leaks(empty, bench(spark)).count() == 0
    assert leaks.find_leaks(odd, bench(spark, [])).count() == 0
    hit = spark.createDataFrame([(5, "x y z ALPHA beta, gamma delta epsilon zeta eta theta iota kappa tail")], "doc_id bigint, text string")
    got = leaks.find_leaks(odd.select("doc_id", "text").unionByName(hit), bench(spark)).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(5, 1)]


def test_labels_of_one_class_keep_all(spark, odd):
    out = cotrain.quality(odd, odd.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")))
    assert out.where("not kept or prob is not null").count() == 0


def test_no_declared_language(spark, odd):
    out = langid.identify(odd.withColumn("lang", F.lit(None).cast("string")))
    assert out.where("lang is not null").count() == 0 and out.where("kept").count() > 60


def test_word_ids_are_the_librarys_whatever_the_batch_and_the_table():
    """A batch of texts goes in as one Arrow array; a table of few parts is renewed again and again."""
    import numpy as np
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    own, lib = idcoder.WordIds(path, most=50), Tokenizer.from_file(path)
    odd = ["", "  ", "don't we'll 's''s x've", "A_b __ 12 3.5,,;", "Été ÀÇ ß ÿŸ ǅ Ⱥ", "<|endoftext|> hi", "<| x", "tab\there\r\nline\x0b\x0cx", "日本 語", "İstanbul", "a\x00b", "a\xa0b a\x85b", "²³ ¼ µ ª º", "é", "x" * 5000, "\n\n"]
    odd += [f"{chr(c)}a{chr(c)}{chr(c + 1)} {chr(c)}" for c in range(32, 0x250)]
    for size in (1, 7, len(odd)):
        for a in range(0, len(odd), size):
            part = odd[a : a + size]
            for text, raw in zip(part, own.encode(pa.array(part)), strict=True):
                assert np.frombuffer(raw, "<u2").tolist() == lib.encode(text, add_special_tokens=False).ids, text
    assert own.encode(pa.array([], pa.string())) == []
