import pytest

from quaestor.sources.snapshots import Conflict, Manifests, Store


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, str(tmp_path / "cases"), "caso string, risco string, analise string", "estado", "caso")
    s.append(spark.createDataFrame([("a", "verde", "x", "pendentes"), ("b", "", None, "pendentes"), ("c", "amarelo", "y", "feitos")], "caso string, risco string, analise string, estado string"))
    return s


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_versions_stay_readable(spark, store):
    assert rows(store.read().select("caso", "estado")) == [("a", "pendentes"), ("b", "pendentes"), ("c", "feitos")]
    assert store.purge("pendentes") == 2 and store.purge("pendentes") == 2
    assert rows(store.read().select("caso")) == [("c",)] and store.read(1).count() == 3
    with pytest.raises(ValueError):
        store.read(9)


def test_archive_moves_all_or_nothing(spark, store):
    assert store.archive("2026-01-01") == 2
    assert store.read().count() == 0 and rows(store.read(archived=True).select("caso", "estado", "archive"))[0] == ("a", "pendentes", "2026-01-01")
    assert store.archive("2026-01-02") == 2  # nothing to move
    assert store.read(archived=True).select("archive").distinct().count() == 1


def test_patches_keep_what_is_left_out(spark, store):
    store.patch(spark.createDataFrame([("a", "", "new"), ("c", "vermelho", None)], "caso string, risco string, analise string"))
    assert rows(store.read().select("caso", "risco", "analise").where("caso <> 'b'")) == [("a", "verde", "new"), ("c", "vermelho", "y")]
    with pytest.raises(ValueError):
        store.patch(spark.createDataFrame([("z", "verde")], "caso string, risco string"))


def test_moves_touch_the_parts_of_their_rows_only(spark, store):
    before = {p["folder"] for p in store.files.read()[1]["parts"] if p["state"] == "feitos"}
    store.move(spark.createDataFrame([("a",)], "caso string"), "revisao")
    assert rows(store.read().select("caso", "estado")) == [("a", "revisao"), ("b", "pendentes"), ("c", "feitos")]
    assert before <= {p["folder"] for p in store.files.read()[1]["parts"]}


def test_of_two_writers_one_is_refused(spark, store, tmp_path):
    files = Manifests(spark, str(tmp_path / "cases"))
    base, held = files.read()
    store.purge("feitos")
    with pytest.raises(Conflict):
        files.commit(base, held)
    assert files.versions() == [1, 2] and rows(store.read().select("caso")) == [("a",), ("b",)]


def test_before_the_first_commit(spark, tmp_path):
    empty = Store(spark, str(tmp_path / "none"), "caso string", "estado", "caso")
    assert empty.read().count() == 0 and empty.archive("x") == 0 and empty.files.versions() == []
