import math

import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if type(v).__name__ == "Decimal":
        return round(float(v), 6)
    if isinstance(v, list | tuple):
        return tuple(map(plain, v))
    return v


@pytest.fixture(scope="session")
def duck(data):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{data}/{t}.parquet')")
    return con


def own():
    from quaestor.plans import catalog

    return catalog.queries(), catalog.oracle_sql()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 200


@pytest.mark.parametrize("name", sorted(own()[0]))
def test_query_matches_sql(spark, duck, data, name):
    queries, sql = own()
    df = queries[name](spark, data)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name in sql:
        want = duck.sql(sql[name])
        assert sorted(want.columns) == cols
        at = [want.columns.index(c) for c in cols]
        assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
    else:
        assert got


def test_state_of_case_reads_whole_texts(spark, tmp_path):
    texts = [(1, "Caso " + "nome " * 50 + "Vs. Chile"), (2, "Caso curto"), (3, "palavra\n" * 5000)]
    spark.createDataFrame([(3 * i + 2, t) for i, t in texts], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.value for r in own()[0]["fn_state_of_case"](spark, str(tmp_path)).collect()}
    assert got == {5: "Chile", 8: None, 11: None}


def test_the_rest_works_without_the_pipeline_operators(tmp_path):
    """In a copy without the two llm folders everything else is there, and names none of theirs."""
    import os
    import shutil
    import subprocess
    import sys

    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(top, tmp_path / "copy", ignore=shutil.ignore_patterns("llm", ".git", "__pycache__"))
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), 'pipeline' in q, any(n.startswith('op') for n in q), 'fts_search' in o)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", env=os.environ | {"PYTHONPATH": str(tmp_path / "copy")}, capture_output=True, text=True, check=True)
    assert out.stdout.split()[1:] == ["False", "False", "True"] and int(out.stdout.split()[0]) > 200
