"""Each stage of the pipeline on awkward rows, and against a plain restatement of what it decides."""

import random
from collections import Counter

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def awkward(odd):
    return odd.withColumn("n_chars", F.length("text").cast("bigint"))


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stage_on_awkward_rows(spark, awkward, data, name):
    stage = dict(P.STAGES)[name]
    out = stage(spark, awkward, data)
    before, after = Counter(r.doc_id for r in awkward.select("doc_id").collect()), Counter(r.doc_id for r in out.collect())
    assert not after - before
    if name in ("repeated_passages", "piece_ids"):
        assert after == before
    if name != "piece_ids":
        assert out.columns == awkward.columns
        assert stage(spark, awkward.where("1 = 0"), data).count() == 0
    if name == "language_id":
        assert not {100, 101, 102} & set(after)
    if name == "near_dedup":  # 105 and 106 are copies; 100, 101 and 102 have no word
        assert 105 in after and 106 not in after and 100 in after and not {101, 102} & set(after)


def rows_of_equal_ids(spark):
    rng = random.Random(41)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(400)]

    def prose(n=120):
        return " ".join(rng.choice(words) for _ in range(n))

    lone, copied = [prose() for _ in range(6)], prose()
    rows = [(1, lone[0], "en"), (1, lone[1], "en"), (None, lone[2], "en"), (None, lone[3], "en"), (2, copied, "en"), (1, copied, "en"), (1, copied, "en"), (3, "12 34 !!", "en"), (3, lone[4], "en")]
    return spark.createDataFrame([(i, t, la, "src0", len(t)) for i, t, la in rows], COLUMNS), lone, copied


def test_rows_of_equal_and_null_ids_are_judged_by_themselves(spark, data):
    docs, lone, copied = rows_of_equal_ids(spark)
    got = Counter((r.doc_id, r.text) for r in P.near_dedup(spark, docs, data).collect())
    assert got == Counter([(1, lone[0]), (1, lone[1]), (None, lone[2]), (None, lone[3]), (1, copied), (3, "12 34 !!"), (3, lone[4])])
    got = [r.text for r in P.language_id(spark, docs, data).collect()]
    assert "12 34 !!" not in got and lone[4] in got
    item = spark.read.parquet(f"{data}/benchmark.parquet").where("length(text) > 60").first().text
    leaked = docs.unionByName(spark.createDataFrame([(1, f"{lone[0]} {item} {lone[1]}", "en", "src0", 9), (None, f"x {item}", "en", "src0", 9)], COLUMNS))
    got = Counter((r.doc_id, r.text) for r in P.decontamination(spark, leaked, data).collect())
    assert got == Counter((r.doc_id, r.text) for r in docs.collect())


def test_nothing_but_small_tables_is_left_in_the_shared_folder(spark, data):
    import os

    from quaestor.llm.common import shared_dir

    docs = spark.read.parquet(f"{data}/documents.parquet")
    where = shared_dir(spark).removeprefix("file://").removeprefix("file:")
    before = set(os.listdir(where))
    for _, stage in P.STAGES:
        stage(spark, docs, data)
    kinds = {x.rsplit("-", 1)[0] for x in set(os.listdir(where)) - before}
    assert kinds <= {"gone", "again", "spans"}
