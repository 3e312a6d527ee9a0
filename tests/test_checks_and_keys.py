import itertools
import json
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from quaestor.functions import text as T
from quaestor.operators import checks as C
from quaestor.operators.glossary import matches


def key(spark, **request):
    return spark.createDataFrame([(json.dumps(request, ensure_ascii=False),)], "r string").select(T.request_key(F.col("r")).alias("k")).first().k


def of(spark, text, **more):
    return key(spark, **{"mcp": "x", "query": text, "base": "ACOR", "tamanho": 10} | more)


def test_requests_that_ask_the_same_have_one_key(spark):
    same = [("CPAP apneia sono", "apneia sono CPAP"), ("PRESCRIÇÃO execução fiscal", "prescricao Execucao Fiscal"), ("prescrição, execução fiscal", "prescrição   execução  fiscal"), ("consignado consignado fraude", "consignado fraude"), ("Medicamento E União", "medicamento E uniao")]
    for a, b in same:
        assert of(spark, a) == of(spark, b)
    assert key(spark, mcp="b", filtro={"buscaGeral": "CPAP sono"}) == key(spark, filtro={"buscaGeral": "sono CPAP"}, mcp="b")
    assert key(spark, a=[{"b": {"termo": "x y", "n": 1}}]) == key(spark, a=[{"b": {"n": 1, "termo": "y  x"}}])


def test_requests_that_differ_keep_their_keys(spark):
    apart = [("aposentadoria nao militar", "militar nao aposentadoria"), ("assistencia adj5 social", "social adj5 assistencia"), ('"prestação continuada" beneficio', 'beneficio "continuada prestação"'), ("BPC e assistencia", "BPC ou assistencia"), ("medicamento E uniao", "medicamento e uniao"), ("a E b OU c", "a OU b E c"), ("x AND y", "x and y")]
    for a, b in apart:
        assert of(spark, a) != of(spark, b)
    assert of(spark, "x", tamanho=3) != of(spark, "x") and of(spark, "x", base="SUMU") != of(spark, "x")
    # what isn't a search stays as it is, also where it looks like one inside a value
    assert key(spark, nota='"query":"b a"') != key(spark, nota='"query":"a b"')
    assert spark.range(1).select(T.request_key(F.lit("{broken"))).first()[0] is None


def test_signs_and_blank_searches_stay(spark):
    v = lambda x: spark.range(1).select(T.canonical_request(F.lit(json.dumps({"query": x})))).first()[0]
    assert v("assist$ social") == '{"query":"assist$ social"}' and v("+apneia +sono") == '{"query":"+apneia +sono"}'
    assert v("") == '{"query":""}' and v(" \n") == '{"query":" \\n"}'
    assert v('a\\b "c" ' * 3000).count(" ") == 3 * 3000 - 1


def test_a_source_that_ignores_a_filter_fails_the_result(spark):
    rows = spark.createDataFrame([(1, "TSE", 2020), (2, "TSE", None)], "id int, court string, year int")
    rules = {"court": F.col("court") == "TSE", "year": F.col("year") == 2020}
    assert C.rows_within(rows, rules).count() == 2
    with pytest.raises(Exception, match="ignored a filter: court, year"):
        C.rows_within(rows.unionByName(spark.createDataFrame([(3, "TRE-RJ", 2022)], rows.schema)), rules).select("id").collect()


def page(total, hits):
    return json.dumps({k: v for k, v in (("total", total), ("hits", hits)) if v is not None})


def test_an_answer_that_tells_of_hits_and_brings_none_is_refused(spark):
    def run(*bodies):
        return C.hits_of(C.answers(spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "page int, body string"), "body", "id bigint"))

    rows, _ = run(page(2, [{"id": 1}, {"id": 2}]), page(0, []))
    assert sorted((r.page, r.hit.id) for r in rows.collect()) == [(0, 1), (0, 2)]
    with pytest.raises(C.Refused):
        run(page(2, [{"id": 1}]), page(5, []))
    with pytest.raises(Exception, match="without total or hits"):
        run(page(2, None))


def test_a_check_takes_no_second_scan(spark):
    rows = spark.range(5).withColumn("x", F.col("id") > 3)
    out, told = C.settled(rows, {"none": (F.count_if(F.col("id") > 9), "never")})
    assert out.count() == 5 and told == {"none": 0}
    assert "Range" not in out._jdf.queryExecution().executedPlan().toString()


def folded(text):
    return re.findall(r"[^\W_]+", "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c)).lower())


def marked(text, terms):
    words, out, i = folded(text), [], 0
    known = {}
    for t in sorted(terms, reverse=True):
        known[tuple(folded(t))] = t
    while i < len(words):
        size = next((n for n in range(7, 0, -1) if i + n <= len(words) and tuple(words[i : i + n]) in known), 0)
        if size:
            out.append((i, size, known[tuple(words[i : i + size])]))
        i += size or 1
    return out


def test_glossary_matches_are_leftmost_and_longest(spark):
    rng = random.Random(2)
    base = ["a", "b", "c", "É", "ação"]
    terms = {" ".join(rng.choices(base, k=rng.randrange(1, 6))) for _ in range(25)} - {"a"} | {"acesso à justiça", "Justiça", "justica", "  ", "!"}
    texts = {k: " ".join(rng.choices([*base, "x", "acesso", "a justica,", "JUSTIÇA"], k=rng.randrange(0, 60))) for k in range(80)} | {90: None, 91: "", 92: "acesso à Justiça acesso à"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    got = {}
    for r in matches(docs, spark.createDataFrame([(t,) for t in terms], "term string")).collect():
        got.setdefault(r.row, []).append((r.pos, r.size, r.term))
    for k, text in texts.items():
        assert sorted(got.get(k, [])) == marked(text or "", terms), text
    assert matches(docs, spark.createDataFrame([], "term string")).count() == 0
    assert matches(docs.unionByName(docs), spark.createDataFrame([("a b",)], "term string")).count() == 2 * sum(len(marked(t or "", ["a b"])) for t in texts.values())
    assert list(itertools.chain(*got.values()))


def test_metadata_lines_come_back_as_text_and_as_fields(spark, tmp_path):
    from quaestor.plans import catalog

    rows = [(1, 'a "b" \\ é', "O"), (2, None, "F"), (3, "5-LOW", None), (4, "x\ny", "")]
    spark.createDataFrame(rows, "o_orderkey bigint, o_orderpriority string, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    got = {r.numero: r for r in catalog.queries()["snk_meta_json"](spark, str(tmp_path)).collect()}
    assert {k: (r.o_orderkey, r.risco, r.estado) for k, r in got.items()} == {k: (k, risco, estado) for k, risco, estado in rows}
    assert {k: json.loads(r.meta) for k, r in got.items()} == {k: {"numero": k, "risco": risco, "estado": estado} for k, risco, estado in rows}
