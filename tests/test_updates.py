import pytest
from pyspark.sql import functions as F

from quaestor.operators import updates as U
from quaestor.sources import cards as P


def test_a_topic_needs_its_provenance(spark):
    old = spark.createDataFrame([("saúde", 1, "Caderno 1", 3)], "tema string, documento int, fonte string, citacoes int")
    new = spark.createDataFrame([("saúde", 1, "Caderno 2", None), ("terra", 2, "Caderno 2", 1)], old.schema)
    assert sorted(tuple(r) for r in U.put_topics(old, new, ["tema", "documento"], "fonte").collect()) == [("saúde", 1, "Caderno 2", 3), ("terra", 2, "Caderno 2", 1)]
    for blank in (None, " "):
        with pytest.raises(Exception, match="without provenance: x, 3"):
            U.put_topics(old, spark.createDataFrame([("x", 3, blank, 1)], old.schema), ["tema", "documento"], "fonte").collect()


def test_older_layouts_get_what_is_missing_or_are_refused(spark):
    rows = spark.createDataFrame([(1,)], "id int")
    out = U.migrated(rows, {"suspeito": F.lit(False), "id": F.lit(9)}, ["paragrafo_id"])
    assert out.columns == ["id", "suspeito"] and tuple(out.first()) == (1, False)
    with pytest.raises(ValueError, match="build it anew"):
        U.migrated(rows.withColumn("paragrafo_id", F.lit(1)), {}, ["paragrafo_id"])


def test_a_put_replaces_and_what_has_expired_goes(spark):
    cache = spark.createDataFrame([("m", "a", "x", 0, 10, 4), ("m", "b", "y", 95, 10, 4), ("m", "c", "z", 95, 10, 4)], "mcp string, key string, body string, fetched_at bigint, ttl_s bigint, hits bigint")
    puts = spark.createDataFrame([("m", "b", "1", 60, 1), ("m", "b", "2", 60, 2), ("m", "c", "", 60, 3), ("m", "d", None, 60, 4)], "mcp string, key string, body string, ttl_s int, seq int")
    assert sorted(tuple(r) for r in U.put_cache(cache, puts, 100).collect()) == [("m", "b", "2", 100, 60, 0), ("m", "c", "z", 95, 10, 4)]


def test_a_page_that_tells_of_an_error_is_no_answer(spark):
    page = '<li class="ui-messages-error-detail">Sess&amp;o\\n  expirada</li>'
    one = lambda h, f: spark.createDataFrame([(h,)], "h string").select(f(F.col("h")).alias("x")).first().x
    assert one(page, P.portal_error) == "Sess&o expirada" and one("<p>ui-messages</p>", P.portal_error) is None
    assert one("<p>fine</p>", P.answered) == "<p>fine</p>"
    with pytest.raises(Exception, match="told of an error: Sess&o expirada"):
        one(page, P.answered)
