"""Hard negatives, the class-based model and the lexical search against plain restatements."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaestor.llm import classlm, lexical, negatives, queries

WORD = re.compile("[^\x20\x09-\x0d]+")
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def mined(rows, scale=256):
    """Every pair, sorted."""
    rows = [(i, la, [math.floor(float(x) * scale) for x in v]) for i, la, v in rows if None not in (i, la, v) and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for a, la, v in rows:
        if a % 50:
            continue
        scored = {(-sum(x * y for x, y in zip(v, w)), b, lb == la) for b, lb, w in rows if b != a}
        for p, pos in sorted((s, b) for s, b, same in scored if same)[:5]:
            fits = sorted((s, b) for s, b, same in scored if not same and 50 * -p <= 100 * -s <= 95 * -p)[:3]
            out |= {(a, pos, k + 1, b, -p, -s) for k, (s, b) in enumerate(fits)}
    return out


@pytest.mark.parametrize(("width", "spread", "block"), [(5, 1.0, 16 << 20), (3, 0.02, 700), (1, 40.0, 300), (70, 0.3, 5000)])
def test_negatives_equal_all_pairs(spark, width, spread, block):
    rng = random.Random(width)
    rows = [(k, rng.randrange(4), [rng.gauss(0.3, spread) for _ in range(width)]) for k in range(-60, 400)]
    rows += [(k + 1000, la, v) for k, la, v in rows[:90]]  # ties
    rows += rows[5:25]  # repeated rows
    rows += [(2000, None, [0.1] * width), (2050, 1, None), (None, 1, [0.2] * width), (2100, 1, [0.1, None]), (2150, 2, [float("nan")] * width), (2200, 2, [float("inf")]), (2250, 3, []), (2300, 3, [0.5])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, label int, embedding array<float>, key int, q string").repartition(3)
    held = [(r.vec_id, r.label, r.embedding) for r in df.collect()]
    got = [tuple(r) for r in negatives.mine(df, F.col("id") % 50 == 0, block_bytes=block).collect()]
    assert len(got) == len(set(got)) and set(got) == mined(held) and got


def test_negatives_of_nothing_and_of_too_much(spark):
    df = spark.createDataFrame([(50, 1, [1e12, 1e12])], "vec_id bigint, label int, embedding array<double>")
    with pytest.raises(ValueError):
        negatives.mine(df, F.col("id") % 50 == 0)
    assert negatives.mine(df.limit(0), F.col("id") % 50 == 0).count() == 0
    assert negatives.mine(df.withColumn("embedding", F.array(F.lit(0.5))), F.col("id") % 7 == 0).count() == 0


def test_survivors_are_those_within_bounds():
    rng = np.random.default_rng(3)
    a, q = rng.integers(-90, 90, (40, 12)), rng.integers(-100, 120, (300, 12))
    want = a @ q.T
    least, most = np.sort(rng.integers(-40_000, 40_000, (2, 40)), axis=0)
    i, r, s = negatives.survivors(a, negatives.Planes(q, -100, 8, np.float32), least, most)
    held = (want >= least[:, None]) & (want <= most[:, None])
    assert set(zip(i, r, s)) == {(x, y, want[x, y]) for x, y in zip(*np.nonzero(held))}


def ranked(docs, items, limit=10):
    own = [(i, Counter(TERM.findall((t or "").translate(UPPER)))) for i, t in docs]
    own = [(i, c) for i, c in own if c]
    n_docs, n_terms = len(own), sum(c.total() for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in set(items):
        asked = TERM.findall((text or "").translate(UPPER))
        scored = []
        for i, c in own:
            m = 25 + 75 * c.total() * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if missing else i, -s) for k, (s, missing, i) in enumerate(sorted(scored)[:limit])]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("terms", "places"), [(1 << 18, 1 << 16), (60, 25)])
def test_lexical_search_equals_plain_scoring(spark, odd, monkeypatch, terms, places):
    rng = random.Random(7)
    words = [f"w{k}" for k in range(200)] + ["Ünï", "x1", "ÀB"]
    more = [(rng.choice([k, k * 70_000 - 900_000, 5]), " ".join(rng.choices(words, k=rng.randrange(1, 90)))) for k in range(300)]
    docs = [(r.doc_id, r.text) for r in odd.collect()] + more
    items = [(k, " ".join(rng.choices(words, k=20))) for k in range(12)] + [(1, "w3 W3 w5"), (1, "w3 W3 w5"), (None, "same text, TEXT"), (20, None), (21, ""), (22, "absent"), (23, "ünï ÀB àb")]
    df = spark.createDataFrame([(i, t, "n", 1) for i, t in docs], "doc_id bigint, text string, window string, terms int").repartition(3)
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id bigint, text string, item int")
    got = lexical.search(df, asked, most_terms=terms, most_places=places)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == ranked(docs, items)
    assert lexical.search(df.limit(0), asked).count() == 0 and lexical.search(df, asked.limit(0)).count() == 0


def test_a_window_of_many_repeated_ids_is_parted(spark, monkeypatch):
    monkeypatch.setattr(lexical, "WINDOW", 128)
    docs = [(7, f"a b c{k % 9}") for k in range(700)] + [(None, "a c1")] * 300
    df = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    items = [(1, "a c3"), (2, "b c1 c1")]
    batches = lexical._windows
    sizes = []
    assert [len(x) for x in batches(iter([_batch(docs[:300])]))] == [128, 128, 44] and not sizes
    got = lexical.search(df, spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == ranked(docs, items)


def _batch(docs):
    import pyarrow as pa

    n = len(docs)
    return pa.record_batch([pa.array([0] * n), pa.array([7] * n), pa.array([3] * n), pa.array([[0]] * n, pa.list_(pa.int32())), pa.array([[1]] * n, pa.list_(pa.int64()))], names=["window", "id", "n", "terms", "counts"])


def held_out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1


def test_base_scores_equal_plain_counts(spark, odd):
    got = {(r.doc_id, r.n_tokens): r for r in classlm.score(odd, F.crc32(F.col("doc_id").cast("string")) % 5 == 1, own_words=20, held_words=45, forms=16, classes=6, rounds=2).collect()}
    texts = [(i, [*WORD.findall((t or "").translate(UPPER)), ""]) for i, t in odd.select("doc_id", "text").collect()]
    counts = Counter(w for i, ws in texts if not held_out(i) for w in ws)
    total, distinct = counts.total(), len(counts)
    assert len(got) == len(texts)
    for i, ws in texts:
        r = got[i, len(ws)]
        assert r.held_out == held_out(i) and r.train_tokens == total and r.n_known == sum(w in counts for w in ws)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws), rel=1e-9)
        assert r.score < 0


def test_model_scores_equal_a_restatement(spark, data, monkeypatch):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    kept, fit = {}, classlm.fit

    def keep(*a, **b):
        kept["m"], counts = fit(*a, **b)
        return kept["m"], counts

    monkeypatch.setattr(classlm, "fit", keep)
    got = {r.doc_id: r for r in classlm.score(docs, F.crc32(F.col("doc_id").cast("string")) % 5 == 1, own_words=500, held_words=1500, forms=64, classes=12, rounds=6).collect()}
    m = kept["m"]
    texts = {r.doc_id: [w.encode() for w in WORD.findall(r.text.translate(UPPER))] for r in docs.collect()}
    line = {i: [0, *(int(m.class_of[m.numbers[w]]) for w in ws), 0] for i, ws in texts.items()}
    counts = Counter(w for i, ws in texts.items() if not held_out(i) for w in [*ws, b""])
    k = 12
    pairs = Counter((a, b) for i, cs in line.items() if not held_out(i) for a, b in zip(cs, cs[1:]))
    out_of, into, kinds = Counter(), Counter(), Counter()
    for (a, b), n in pairs.items():
        out_of[a] += n
        into[b] += n
        kinds[a] += 1
    once = Counter(int(m.class_of[m.numbers[w]]) for w, n in counts.items() if n == 1)

    def step(a, b):
        trust = out_of[a] / max(1, out_of[a] + kinds[a])
        return trust * pairs[a, b] / max(1, out_of[a]) + (1 - trust) * (into[b] + 0.5) / (sum(into.values()) + 0.5 * k)

    def emitted(w, c):
        if w == b"":
            return 1.0
        new = (once[c] + 0.5) / (into[c] + 1)
        return (1 - new) * counts[w] / into[c] if counts[w] else new

    for i, ws in texts.items():
        cs = line[i]
        want = sum(math.log10(step(a, b)) + math.log10(emitted(w, b)) for a, b, w in zip(cs, cs[1:], [*ws, b""]))
        assert got[i].score == pytest.approx(want, rel=1e-9)
    # all words, and a word never seen of each class, after any class
    for a in range(k):
        every = sum(step(a, int(m.class_of[m.numbers[w]])) * emitted(w, int(m.class_of[m.numbers[w]])) for w in counts) + sum(step(a, c) * emitted(b"\xff never", c) for c in range(1, k))
        assert every == pytest.approx(1, abs=1e-6) or any(into[c] == 0 for c in range(k))
    unseen = [got[i] for i in texts if held_out(i)]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_moves_gain_what_the_likelihood_gains():
    rng = np.random.default_rng(5)
    n, k = 14, 5
    pairs = rng.integers(0, 9, (n, n))
    classes = rng.integers(1, k, n)
    classes[0] = 0

    def table(cs):
        t = np.zeros((k, k))
        for a in range(n):
            for b in range(n):
                t[cs[a], cs[b]] += pairs[a, b]
        return t

    before = np.array([[pairs[classes == c, u].sum() for c in range(k)] for u in range(n)])
    after = np.array([[pairs[u, classes == c].sum() for c in range(k)] for u in range(n)])
    to, gain = classlm.best_moves(np.arange(n), before, after, np.diag(pairs), classes, table(classes))
    for u in range(1, n):
        tried = []
        for c in range(1, k):
            other = classes.copy()
            other[u] = c
            tried.append(classlm.likelihood(table(other)) - classlm.likelihood(table(classes)))
        assert gain[u] == pytest.approx(max(tried), abs=1e-6) and tried[to[u] - 1] == pytest.approx(max(tried), abs=1e-6)


def test_no_training_text(spark, odd):
    rows = classlm.score(odd, F.lit(True), own_words=5, held_words=9, forms=4, classes=3, rounds=1).collect()
    assert len(rows) == odd.count() and all(r.train_tokens == 0 and r.base_score == pytest.approx(0, abs=1e-6) and r.n_known == 0 for r in rows)
    assert classlm.score(odd.limit(0), F.lit(False), own_words=5, held_words=9, forms=4, classes=3, rounds=1).count() == 0


def test_queries_are_registered():
    assert {"op11_bit_sliced_negatives", "op12_brown_perplexity", "op13_windowed_search"} <= set(queries.queries())


def test_words_above_the_cut_off_are_at_most_as_many(spark):
    counts = spark.createDataFrame([(f"w{k}", n) for k, n in enumerate([9, 7, 7, 7, 3, 1, 1])], "word string, n bigint")
    assert [classlm.cut_off(counts, m) for m in (0, 1, 3, 4, 5, 6, 7, 9)] == [9, 7, 7, 3, 1, 1, 0, 0]
