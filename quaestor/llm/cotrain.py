"""Quality classifier by co-training (operator 4).

Two views of a document: its text (hashed words and punctuation runs, shape statistics) and its metadata (language, source,
size). A logistic model per view starts from labelled rows; over rounds each scores all documents, and its most confident
ones, by class, are added with their pseudo-labels to the other's training rows. Calibrated by Platt scaling on labelled rows
kept apart, the views are combined by a logistic model on their log-odds and score every document.

Bounds, all parameters: ``sample`` labelled rows and ``grow`` pseudo-labels per class, view and round reach the driver;
a model is 2^16 weights. Everything else is map passes and top-k reports over all documents: the text is hashed once, into
one written row per document, which every round reads.

Defined results: null text is empty; null metadata is a value of its own; a document is good if its quality label is 1 and
its toxic label isn't; rows without a quality label are unlabelled; several labels of a document are several rows. Without
labelled rows of both classes prob is null and everything is kept. Ties in confidence go to the smaller hash of the id.
"""

from __future__ import annotations

import string
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread, written

WORDS = 1 << 16
META = 1 << 12
SHAPE = 8
_PUNCT = string.punctuation.encode()
_UPPER = string.ascii_uppercase.encode()
_DIGITS = string.digits.encode()
_ONLY_WORDS = bytes.maketrans(_PUNCT + b"\t\n\r\x0b\x0c", b" " * (len(_PUNCT) + 5))
_ONLY_PUNCT = bytes(c if bytes([c]) in [bytes([p]) for p in _PUNCT] else 32 for c in range(256))


class _Buckets(dict):
    """Bucket of a token; emptied when it has grown large."""

    def __missing__(self, token: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[token] = out = zlib.crc32(token) % WORDS
        return out


def text_features(text: str, buckets: _Buckets) -> tuple[np.ndarray, list[float]]:
    """(sorted distinct buckets, shape statistics)."""
    raw = text.encode()
    words = text.lower().encode().translate(_ONLY_WORDS).split()
    different = Counter(words)
    lone = different.most_common(1)[0][1] if words else 0
    runs = {b"!" + x for x in raw.translate(_ONLY_PUNCT).split()}
    idx = np.unique(np.fromiter(map(buckets.__getitem__, different.keys() | runs), dtype=np.int32))
    n, size = max(1, len(words)), max(1, len(raw))
    shape = [(len(raw) - len(raw.translate(None, _UPPER))) / size, (len(raw) - len(raw.translate(None, _PUNCT))) / size, (len(raw) - len(raw.translate(None, _DIGITS))) / size, len(different) / n, np.log1p(len(words)) / 10, sum(map(len, different)) / max(1, len(different)) / 10, lone / n, raw.count(b" | ") / n]
    return idx, shape


def features(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(id, words, shape, meta) of every document."""
    few = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _Buckets()
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                words, shapes, metas = [], [], []
                for text, lang, source in zip(part.column("text"), part.column("lang").to_pylist(), part.column("source").to_pylist(), strict=True):
                    t = text.as_py() or ""
                    idx, shape = text_features(t, buckets)
                    words.append(idx)
                    shapes += shape
                    size = int(np.log2(1 + len(t)) * 2)
                    metas += [zlib.crc32(repr(k).encode()) % META for k in (("lang", lang), ("source", source), ("both", lang, source), ("size", size))]
                n = part.num_rows
                off = np.r_[0, np.cumsum([len(w) for w in words])].astype(np.int32)
                cols = [part.column("id"), pa.ListArray.from_arrays(off, pa.array(np.concatenate(words) if words else np.zeros(0, np.int32))), pa.ListArray.from_arrays(np.arange(0, n * SHAPE + 1, SHAPE, dtype=np.int32), pa.array(np.array(shapes, np.float32))), pa.ListArray.from_arrays(np.arange(0, n * 4 + 1, 4, dtype=np.int32), pa.array(np.array(metas, np.int32)))]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "words", "shape", "meta"])

    return spread(few).mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, words array<int>, shape array<float>, meta array<int>")


class Linear:
    """Logistic model on sparse 0/1 features, each row scaled to unit length, and dense ones."""

    def __init__(self, size: int, dense: int):
        self.w, self.v, self.b = np.zeros(size), np.zeros(dense), 0.0

    def score(self, flat: np.ndarray, off: np.ndarray, dense: np.ndarray) -> np.ndarray:
        n = np.diff(off)
        own = np.repeat(np.arange(len(n)), n)
        return np.bincount(own, weights=self.w[flat], minlength=len(n)) / np.sqrt(np.maximum(n, 1)) + dense @ self.v + self.b

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, weights: np.ndarray, steps: int = 200, ridge: float = 1e-5) -> Linear:
        n = np.array([len(r[0]) for r in rows])
        off, flat = np.r_[0, np.cumsum(n)], np.concatenate([r[0] for r in rows])
        own = np.repeat(np.arange(len(n)), n)
        scale = 1 / np.sqrt(np.maximum(n, 1))
        dense = np.array([r[1] for r in rows], dtype=float).reshape(len(rows), len(self.v))
        weights = weights * np.where(labels == 1, 0.5 / max(weights[labels == 1].sum(), 1e-9), 0.5 / max(weights[labels == 0].sum(), 1e-9))
        gw, gv, gb = np.full(len(self.w), 1e-8), np.full(len(self.v), 1e-8), 1e-8
        for _ in range(steps):  # Adagrad on the whole set
            p = 1 / (1 + np.exp(-np.clip(self.score(flat, off, dense), -30, 30)))
            err = (p - labels) * weights
            dw = np.bincount(flat, weights=(err * scale)[own], minlength=len(self.w)) + ridge * self.w
            dv, db = err @ dense + ridge * self.v, err.sum()
            gw, gv, gb = gw + dw * dw, gv + dv * dv, gb + db * db
            self.w, self.v, self.b = self.w - 0.5 * dw / np.sqrt(gw), self.v - 0.5 * dv / np.sqrt(gv), self.b - 0.5 * db / np.sqrt(gb)
        return self


def _platt(score: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """(a, b) of log-odds a * score + b, by Newton steps on smoothed targets."""
    pos, neg = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x, theta = np.stack([score, np.ones_like(score)], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1.0, 1e-3])
        step = np.linalg.solve(hess, x.T @ (p - target) + [theta[0] - 0.5, 1e-3 * theta[1]])
        theta = theta - step
        theta[0] = min(max(theta[0], 0.0), 5.0)  # a view's score never counts against itself
    return float(theta[0]), float(theta[1])


def _scores(found: DataFrame, text: Linear, meta: Linear) -> DataFrame:
    kind = found.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                lists = []
                for c in ("words", "meta"):
                    col = part.column(c)
                    off = np.asarray(col.offsets)
                    lists.append((np.asarray(col.flatten()), off - off[0]))
                shape = np.asarray(part.column("shape").flatten()).reshape(part.num_rows, SHAPE)
                s = text.score(*lists[0], shape)
                m = meta.score(*lists[1], np.zeros((part.num_rows, 0)))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.round(s, 9)), pa.array(np.round(m, 9))], names=["id", "text_score", "meta_score"])

    return found.select("id", "words", "shape", "meta").mapInArrow(run, f"id {kind}, text_score double, meta_score double")


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", sample: int = 6000, grow: int = 150, rounds: int = 3, sure: float = 0.9, threshold: float = 0.2) -> DataFrame:
    """One row per document: id, text_prob, meta_prob, prob (of being good), kept."""
    found = written(features(docs, id_col, text_col, lang_col, source_col), "features")
    good = F.when(F.col("quality").isNotNull(), ((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) != 1)).cast("int"))
    told = labels.select(F.col(id_col).alias("id"), good.alias("good")).where("good is not null and id is not null")
    half = sample // 2
    picked = told.where("good = 1").orderBy(F.xxhash64("id"), "id").limit(half).unionByName(told.where("good = 0").orderBy(F.xxhash64("id"), "id").limit(half))
    rows = found.join(F.broadcast(picked), "id").select("id", "words", "shape", "meta", "good", F.pmod(F.xxhash64("id", F.lit(4)), F.lit(4)).alias("fold")).orderBy(F.xxhash64("id"), "id", "good").collect()
    known = {r.id for r in rows}
    taken: tuple[set, set] = (set(), set())  # what each view has handed to the other

    def sparse(r, view: int):
        return (np.array(r.words, np.int64), np.array(r.shape)) if view == 0 else (np.array(r.meta, np.int64), np.zeros(0))

    train, held = [r for r in rows if r.fold], [r for r in rows if not r.fold]
    if len({r.good for r in train}) < 2 or len({r.good for r in held}) < 2:
        none = F.lit(None).cast("double")
        return found.select(F.col("id").alias(id_col), none.alias("text_prob"), none.alias("meta_prob"), none.alias("prob"), F.lit(True).alias("kept"))
    sets = [[(sparse(r, v), r.good, 1.0) for r in train] for v in (0, 1)]

    def fitted() -> list[Linear]:
        out = []
        for v, (size, dense, ridge) in enumerate(((WORDS, SHAPE, 1e-5), (META, 0, 1e-2))):  # a few metadata values are learned by heart otherwise
            out.append(Linear(size, dense).fit([x[0] for x in sets[v]], np.array([x[1] for x in sets[v]], float), np.array([x[2] for x in sets[v]]), ridge=ridge))
        return out

    def held_scores(models: list[Linear]) -> tuple[list[np.ndarray], np.ndarray]:
        y = np.array([r.good for r in held], float)
        out = []
        for v, m in enumerate(models):
            x = [sparse(r, v) for r in held]
            out.append(m.score(np.concatenate([a for a, _ in x]), np.r_[0, np.cumsum([len(a) for a, _ in x])], np.array([b for _, b in x]).reshape(len(x), -1)))
        return out, y

    models = fitted()
    for _ in range(rounds):
        scored = written(_scores(found, *models), "scores")
        scores, y = held_scores(models)
        scales = [_platt(s, y) for s in scores]
        for v, column in enumerate(("text_score", "meta_score")):
            a, b = scales[v]
            odds = F.lit(a) * F.col(column) + F.lit(b)
            edge = float(np.log(sure / (1 - sure)))
            fresh = []
            for label, order in ((1, F.desc("odds")), (0, F.asc("odds"))):
                near = scored.select("id", odds.alias("odds")).where(F.col("odds") >= edge if label else F.col("odds") <= -edge)
                top = near.orderBy(order, F.xxhash64("id"), "id").limit(grow + len(known | taken[v])).collect()
                fresh += [(r.id, label) for r in top if r.id is not None and r.id not in known and r.id not in taken[v]][:grow]
            if fresh:
                label_of = dict(fresh)
                taken[v].update(label_of)
                got = found.where(F.col("id").isin(list(label_of))).orderBy(F.xxhash64("id"), "id").collect()
                sets[1 - v] += [(sparse(r, 1 - v), label_of[r.id], 0.3) for r in got]
        models = fitted()
    scores, y = held_scores(models)
    (ta, tb), (ma, mb) = (_platt(s, y) for s in scores)
    views = np.stack([ta * scores[0] + tb, ma * scores[1] + mb], axis=1)
    theta = np.array([1.0, 0.2, 0.0])  # of text, metadata, constant
    x = np.c_[views, np.ones(len(views))]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        theta = theta - np.linalg.solve(hess, x.T @ (p - y) + 0.1 * (theta - [1.0, 0.2, 0.0]))
    final = _scores(found, *models)

    def chance(odds):
        return 1 / (1 + F.exp(-odds))

    t, m = F.lit(ta) * F.col("text_score") + F.lit(tb), F.lit(ma) * F.col("meta_score") + F.lit(mb)
    prob = F.round(chance(F.lit(float(theta[0])) * t + F.lit(float(theta[1])) * m + F.lit(float(theta[2]))), 6)
    return final.select(F.col("id").alias(id_col), F.round(chance(t), 6).alias("text_prob"), F.round(chance(m), 6).alias("meta_prob"), prob.alias("prob"), (prob >= threshold).alias("kept"))
