import sqlite3

import pytest

from quaestor.operators import querylang as Q
from quaestor.operators.search import Index


@pytest.mark.parametrize(("ours", "theirs"), [("the OR eau", "the OR eau"), ("the AND tion", "the AND tion"), ('"of the"', '"of the"'), ("thinsh*", "thinsh*")])
def test_matches_and_ranks_like_fts5(spark, data, ours, theirs):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    con = sqlite3.connect(":memory:")
    con.execute("create virtual table t using fts5(x, tokenize='unicode61 remove_diacritics 2')")
    con.executemany("insert into t(rowid, x) values (?, ?)", [(r.doc_id + 1, r.text) for r in docs.select("doc_id", "text").collect()])
    want = {i - 1: s for i, s in con.execute("select rowid, bm25(t) from t where t match ?", (theirs,))}
    tree = Q.parse(ours)
    index = Index(docs)
    assert {r.row for r in index.rows(tree).collect()} == set(want)
    if "*" not in ours:
        got = {r.row: r.score for r in index.rows(tree).join(index.bm25(Q.positive(tree)), "row").collect()}
        assert got == pytest.approx(want, abs=1e-9)


def test_empty_query_and_no_hit(spark, data):
    index = Index(spark.read.parquet(f"{data}/documents.parquet"))
    assert index.search("-- ,").count() == 0
    found, wider = index.search_or_relax("the E zzzzz", "cjf", 3)
    assert wider == "the OU zzzzz" and found.count() == 3


def test_a_search_reads_the_index_only(spark, data):
    index = Index(spark.read.parquet(f"{data}/documents.parquet"))
    plan = index.search('"of the" OR thinsh*')._jdf.queryExecution().executedPlan().toString()
    assert "documents.parquet" not in plan and "PushedFilters: [IsNotNull(term), EqualTo(term" in plan


def test_texts_that_hold_an_item(spark):
    docs = spark.createDataFrame([(1, "one two three four"), (2, "xone two threey"), (3, None), (4, "Twó"), (5, "")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "one two three"), (2, "ne two thr"), (3, "two"), (4, ""), (5, None), (6, "one absent three")], "item_id bigint, text string")
    index = Index(docs)

    def found(fold):
        return {tuple(r) for r in index.holding(docs, items, "doc_id", "text", "item_id", "text", fold).collect()}

    want = {(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 2)} | {(4, k) for k in (1, 2, 4, 5)}
    assert found(False) == want and found(True) == want | {(3, 4)}


@pytest.fixture
def small_bands(monkeypatch):
    from quaestor.operators import index

    monkeypatch.setattr(index, "BAND", 3)


def put(spark, store, rows, key="doc_id"):
    from pyspark.sql import functions as F

    store.put(spark.createDataFrame(rows, f"{key} bigint, text string"), {"text": F.col("text")}, key)


def found(index, words):
    return {r.row: round(r.score, 9) for r in index.bm25([Q.Term(w) for w in words]).collect()}


def test_an_updated_index_equals_one_built_anew(spark, tmp_path, small_bands):
    import random

    from quaestor.operators.index import Segments

    rng = random.Random(4)
    words = ["um", "dois", "três", "quatro", "cinco", "seis"]
    state = {k: " ".join(rng.choices(words, k=rng.randrange(0, 9))) for k in range(60)}
    store = Segments(spark, str(tmp_path / "index"), most=3)
    put(spark, store, list(state.items()))
    for step in range(5):
        new = {k: " ".join(rng.choices([*words, f"novo{step}"], k=6)) for k in rng.sample(range(80), 12)}
        state |= new
        put(spark, store, list(new.items()))
        put(spark, store, list(new.items()))  # the same again changes nothing
        gone = rng.sample(sorted(state), 3)
        store.delete(spark.createDataFrame([(k,) for k in gone], "row bigint"))
        state = {k: v for k, v in state.items() if k not in gone}
    fresh = Index(spark.createDataFrame(list(state.items()), "doc_id bigint, text string"))
    again = Index.of(Segments(spark, str(tmp_path / "index")))
    assert again.sizes == fresh.sizes and len(again.store.held["segments"]) <= 4
    assert {tuple(r) for r in again.dictionary.collect()} == {tuple(r) for r in fresh.dictionary.collect()}
    assert found(again, [*words[1:], "novo4", "novo1"]) == found(fresh, [*words[1:], "novo4", "novo1"])
    for q in ("dois tres", "novo4 OR quatro", "dois NOT novo3"):
        assert [tuple(r) for r in again.search(q, limit=7).collect()] == [tuple(r) for r in fresh.search(q, limit=7, bounded=False).collect()]


def test_an_update_leaves_the_rest_and_refuses_a_late_writer(spark, tmp_path):
    from quaestor.operators.index import Segments
    from quaestor.sources.snapshots import Conflict

    path = str(tmp_path / "index")
    store = Segments(spark, path)
    put(spark, store, [(1, "antigo texto"), (2, "outro"), (3, None), (4, "")])
    first, late = store.held["segments"][0], Segments(spark, path)
    put(spark, store, [(1, "novo texto")])
    assert store.held["segments"][0] == first
    held = Index.of(store)
    assert held.sizes == {"text": [4, 3]} and found(held, ["antigo"]) == {} and set(found(held, ["texto"])) == {1} and set(found(held, ["outro"])) == {2}
    with pytest.raises(Conflict):
        put(spark, late, [(2, "perdido")])
    with pytest.raises(ValueError):
        put(spark, Segments(spark, path), [(5, "a"), (5, "b")])
    assert Index.of(Segments(spark, path)).sizes == {"text": [4, 3]}
    assert Index.of(Segments(spark, path)).search("perdido").count() == 0


def test_the_best_few_are_found_in_part_of_the_bands(spark, small_bands):
    rows = [(k, "comum " * (1 + k % 3) + ("raro raro" if k in (13, 200) else "outro " * (k % 5))) for k in range(400)]
    index = Index(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    for q in ("raro comum", "raro OR outro", "(raro OR outro) comum", "comum NOT raro", "raro[text] OR comum"):
        every = index.search(q, "fts5" if "[" not in q else "cjf", 5, bounded=False)
        assert [tuple(r) for r in index.search(q, "fts5" if "[" not in q else "cjf", 5).collect()] == [tuple(r) for r in every.collect()]
    index.search("raro OR comum", limit=2)
    bands = index.postings.select("band").distinct().count()
    read = index.postings.where(index.postings.band.isin(index.read_bands) & index.postings.term.isin("raro", "comum")).count()
    assert bands == 50 and len(index.read_bands) < 20 and read < index.postings.where("term in ('raro', 'comum')").count() / 2


def test_similar_words_are_those_within_the_distance(spark):
    import random

    from pyspark.sql import functions as F

    from quaestor.operators.index import alike

    rng = random.Random(9)
    terms = {"".join(rng.choices("abc", k=rng.randrange(1, 14))) for _ in range(900)} | {"", "ação", "acao"}
    words = rng.sample(sorted(terms), 40) + ["zzz", "abcabcabcabcx"]
    dictionary = spark.createDataFrame([(t,) for t in sorted(terms)], "term string")
    asked = spark.createDataFrame([(w, k % 3) for k, w in enumerate(words)], "word string, distance int")
    got = alike(asked, dictionary)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    want = asked.crossJoin(dictionary).where(F.levenshtein("word", "term") <= F.col("distance")).select("word", "term")
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()} and want.count() > 100


def test_sentences_paragraphs_and_groups(spark):
    docs = spark.createDataFrame([(1, "Dano moral. Pensão e dependente! Fim\nNovo dano"), (2, "Pensão. Dependente aqui"), (3, "pensão\ndependente"), (4, "nada")], "doc_id bigint, text string")
    index = Index(docs)

    def rows(q):
        return sorted(r.row for r in index.rows(Q.parse(q, "cjf")).collect())

    assert rows("pensão COM dependente") == [1] and rows("pensão MESMO dependente") == [1, 2]
    assert rows("pensão NAO COM dependente") == [2, 3] and rows("pensão NAO MESMO dependente") == [3]
    assert rows("(pensão OU fim) COM dependente") == [1] and rows("(dano OU moral) ADJ1 pensão") == [1]
    assert rows('"dano moral" MESMO fim') == [1] and rows('"dano moral" COM fim') == [] and rows("dano COM novo") == [1]


def test_similar_words_count_bytes(spark):
    docs = spark.createDataFrame([(1, "onthe onte onße oßte onthé onth")], "doc_id bigint, text string")
    assert {r.term for r in Index(docs).similar_words("onthe", 2).collect()} == {"onthe", "onte", "onße", "onth"}  # oßte: two letters, three bytes


def test_words_are_counted_where_their_row_stands(spark):
    from quaestor.operators.index import postings_of

    rows = [(1, "b a b. A\nb"), (1, "c"), (2, None), (3, "--"), (4, "x " * 3000 + "y")]
    made = postings_of(spark.createDataFrame(rows, "row bigint, f_text string"), ["text"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan and "Sort" not in plan
    got = sorted((r.row, r.term or "", r.tf, r.dl, r.positions, [(p >> 32, p & 0xFFFFFFFF) for p in r.places or []]) for r in made.where("row < 4").collect())
    assert got == [(1, "a", 2, 5, [1, 3], [(0, 0), (0, 1)]), (1, "b", 3, 5, [0, 2, 4], [(0, 0), (0, 0), (1, 0)]), (1, "c", 1, 1, [0], [(0, 0)]), (2, "", 0, 0, None, []), (3, "", 0, 0, None, [])]
    assert {(r.term, r.tf, r.dl, r.positions[-1]) for r in made.where("row = 4").collect()} == {("x", 3000, 3001, 2999), ("y", 1, 3001, 3000)}


def test_words_are_cut_outside_interpreted_functions_and_as_queries_cut_them(spark):
    from pyspark.sql import functions as F

    from quaestor.functions import text as T
    from quaestor.operators.index import postings_of

    letters = ["".join(f"{chr(c)}a{chr(c)} " for c in range(a, a + 2048) if not 0xD800 <= c < 0xE000) for a in range(1, 0x20000, 2048)]
    texts = [*letters, "", None, ". x", "a.\n\nb. c!? d\n", "a_b __ _c", "one.\t two.\x0b three.\xa0 four. \r\nfive", "İ ẞ Σας ΟΔΟΣ", "y " * 5000]
    rows = spark.createDataFrame([(k, t, (t or "")[::-1]) for k, t in enumerate(texts)], "row bigint, f_a string, f_b string")
    made = postings_of(rows, ["a", "b"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "lambda" not in plan
    for name in ("a", "b"):
        words = F.regexp_extract_all(T.fold(F.coalesce(F.col(f"f_{name}"), F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
        told = rows.select("row", F.posexplode(words).alias("pos", "term"))
        ours = made.where(F.col("field") == name).select("row", F.explode("positions").alias("pos"), "term")
        assert told.exceptAll(ours).isEmpty() and ours.exceptAll(told).isEmpty() and ours.count() > 1000


def test_postings_come_in_runs_by_term_and_a_segment_is_written_without_sorting(spark, tmp_path):
    from pyspark.sql import functions as F

    from quaestor.operators.index import Segments, postings_of

    rows = spark.createDataFrame([(k, f"w{k * 7919 % 1000:03d} {'b' if k % 2 else 'a'} ç{k % 3}") for k in range(900)] + [(900, "--")], "row bigint, f_text string").coalesce(1)
    made = [(r.term, r.row, r.head) for r in postings_of(rows, ["text"]).collect()]
    words = [(t, k) for t, k, _ in made if t]
    assert words == sorted(words) and made[-1] == (None, 900, True)
    assert sorted(k for _, k, head in made if head) == list(range(901))
    store = Segments(spark, str(tmp_path / "ix"))
    store.put(rows.withColumnRenamed("f_text", "text"), {"text": F.col("text")}, "row")
    assert store.sizes == {"text": [901, 2700]}
    assert store.postings().columns == ["term", "field", "band", "row", "tf", "dl", "positions", "places"]


def test_words_of_one_sentence_are_met_by_what_their_units_share(spark):
    held = Index(spark.createDataFrame([(1, "a b. c"), (2, "a. b"), (3, "a.\nb"), (4, "c"), (5, "b c. a b")], "doc_id bigint, text string"))
    for query, want in (("a COM b", {1, 5}), ("a MESMO b", {1, 2, 5}), ("a NAO COM b", {2, 3}), ("a NAO MESMO b", {3}), ("c NAO COM a", {1, 4, 5}), ("a ADJ1 b", {1, 2, 3, 5}), ("b PROX2 a", {1, 2, 3, 5}), ("a NAO ADJ5 b", set())):
        found = held.rows(Q.parse(query, "cjf"))
        assert {r.row for r in found.collect()} == want, query
        if "COM" in query or "MESMO" in query:
            assert "exists(" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_runs_tell_the_sums_that_dictionary_and_bounds_are_made_from(spark, tmp_path, small_bands):
    from pyspark.sql import functions as F

    from quaestor.operators.index import Segments, postings_of

    texts = [(None if k == 5 else k // 2 * 2, f"{'comum ' * (1 + k % 4)}w{k % 9} {'x ' * (k % 5)}", None if k % 3 else "comum") for k in range(300)]
    rows = spark.createDataFrame(texts, "row bigint, f_a string, f_b string").coalesce(2)
    made = postings_of(rows, ["a", "b"])
    by = [F.col("term"), F.col("field"), F.col("band")]
    told = made.where("df is not null").groupBy(*by).agg(F.sum("df"), F.sum(F.coalesce("n", "tf")), F.max(F.coalesce("most", "tf")), F.min(F.coalesce("least", "dl")))
    want = made.where("term is not null").groupBy(*by).agg(F.count(F.lit(1)), F.sum("tf"), F.max("tf"), F.min("dl"))
    assert sorted(map(str, told.collect())) != [] and told.exceptAll(want.toDF(*told.columns)).isEmpty() and want.exceptAll(told.toDF(*want.columns)).isEmpty()
    assert made.where("df is not null").count() < made.where("term is not null").count() / 2
    store = Segments(spark, str(tmp_path / "ix"))
    store.put(rows, {"a": F.col("f_a"), "b": F.col("f_b")}, "row")
    plain = store.postings().groupBy("term", "field").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("n"))
    assert store.dictionary().exceptAll(plain).isEmpty() and plain.exceptAll(store.dictionary()).isEmpty()
    highest = store.postings().where("term in ('comum', 'x', 'w1')").groupBy("term", "field", "band").agg(F.max("tf").alias("tf"), F.min("dl").alias("dl"))
    bounds = store.bounds(["comum", "x", "w1"])
    assert bounds.exceptAll(highest).isEmpty() and highest.exceptAll(bounds).isEmpty()


def test_rows_of_one_key_do_not_make_every_word_a_frequent_one(spark, tmp_path, small_bands):
    from pyspark.sql import functions as F

    from quaestor.operators.index import Segments

    for key in ("7", "null"):
        store = Segments(spark, str(tmp_path / key))
        store.put(spark.range(400).select(F.expr(f"cast({key} as bigint) as doc_id"), F.concat(F.lit("comum w"), "id").alias("text")), {"text": F.col("text")}, "doc_id")
        at = f"{store.files.path}/{store.held['segments'][0]['folder']}/bounds"
        assert {r.term for r in spark.read.parquet(at).collect()} == {"comum"}
        assert store.bounds(["w3", "comum"]).count() == 2
