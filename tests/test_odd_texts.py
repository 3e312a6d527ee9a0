"""Queries on portals' inputs against their SQL, over texts that the given tables lack: null, blank, with other blanks, with words of the markup."""

import duckdb
import pytest

import __spark_entry__ as entry

TEXTS = [
    None, "", " ", "\n", " \n\t", "\t", "\r\n", "\x0b", "\x0b \x0c", " ", " x　", "a b", "\tx", "x\t", "\x0bx", " ", "a\rb", "a\u0085b c d", "a\r",
    "x Apelado: y ADVOGADO z", "advogado", "APELADO", "apelante: q", "A\\pelado \\ \\\\ APELADO\\", "$1 \\1",
    "EMENTA", "EMENTA x", "EMENTA : EMENTA : z", ": x", "ementa", '<span data-id="ementa">y</span>', '<div class="panel">', "&lt;&amp;nbsp;", '"\\u0041"', "\x01", "Exibindo 1 a 10 de 1.234", "1 - 2 de 3", "texto simples.",
]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Each text under twelve ids, so that it meets every kind of answer; some rows lack a language, a source or an id."""
    folder = str(tmp_path_factory.mktemp("odd"))
    rows = [(12 * i + k, t, ["en", "de", None][(i + k) % 3], "s" if k % 5 else None) for i, t in enumerate(TEXTS) for k in range(12)]
    rows += [(None, t, lang, "s") for t in (None, "", "x") for lang in ("en", None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    return folder


def both(spark, folder, name):
    """Rows of a query and of its SQL."""
    found = entry.queries()[name](spark, folder)
    cols = ", ".join(f'"{c}"' for c in found.columns)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{folder}/documents.parquet/*.parquet')")
    return sorted(map(tuple, found.collect()), key=repr), sorted(con.sql(f"select {cols} from ({entry.oracle_sql()[name]})").fetchall(), key=repr)


def test_parties_of_odd_texts(spark, odd):
    got, want = both(spark, odd, "fn_parties_lib")
    assert len(got) == 12 * len(TEXTS) + 6 and got == want


def test_a_party_ends_at_the_first_word_that_ends_it(spark):
    from pyspark.sql import functions as F

    from quaestor.functions import text as T

    def told(c):
        row = spark.range(1).select(T.party(F.lit(c), "APELANTE", ["APELADO", "ADVOGADO"]).alias("a"), T.party(F.lit(c), "APELADO", ["ADVOGADO"]).alias("b")).first()
        return row.a, row.b

    assert told("Apelante: A B Advogado: X apelado: C") == ("A B", "C")
    assert told("APELANTE: APELADO: B") == ("", "B") and told("APELANTE: A") == ("A", None) and told("outro") == (None, None)


def test_federal_records_of_odd_texts(spark, odd):
    got, want = both(spark, odd, "src_elastic_json")
    assert len(got) == 12 * len(TEXTS) + 6 and got == want


def test_panels_of_odd_texts(spark, odd):
    got, want = both(spark, odd, "src_html_panels")
    assert len(got) == 12 * len(TEXTS) + 6 and got == want
