import pytest

PROSE = {
    "en": "the quick brown fox jumps over the lazy dog and runs into the deep forest where nobody had ever been before ",
    "de": "der schnelle braune fuchs springt über den faulen hund und läuft in den tiefen wald wo noch niemand gewesen war ",
}


def odd_rows():
    """Nulls, empty, blank, very long, tied and repeated rows."""
    rows = [(k, f"{PROSE['en' if k % 2 else 'de']} number {k * 7919} stands here {k}\nAnother line of words {k}", "en" if k % 2 else "de", f"src{k % 3}") for k in range(60)]
    rows += [(100, None, None, None), (101, "", "en", "src0"), (102, " \n\t ", "de", ""), (103, "x" * 300_000, "en", "src1"), (104, PROSE["en"] * 3000, "en", "src1")]
    rows += [(105, "same text twice here\n" * 30, "en", "src0"), (106, "same text twice here\n" * 30, "en", "src0"), (107, "ünïcödé ▁ 😀 ﬁ \u3000 end", "de", "src2"), (None, "a row without id", "en", "src1")]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with awkward rows and extra columns whose names operators use inside."""
    schema = "doc_id bigint, text string, lang string, source string, id bigint, key string, fp string, n int, _id int, spans string, start int, declared string"
    rows = [(i, t, la, s, 1, "k", "f", 2, 3, "s", 4, "xx") for i, t, la, s in odd_rows()]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("1 = 0")
