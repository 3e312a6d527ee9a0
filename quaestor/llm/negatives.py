"""Hard-negative mining by bit-sliced integer products.

Vectors become integers. A row's integers less the least one of all are cut to bit planes; a block of anchors is multiplied by one
plane after the other, the most significant first. What the planes not yet seen can add to a product lies in a known interval,
so a pair goes as soon as its interval misses what its anchor still takes: the bounds of the score, and the last place of the
best rows held so far. Most pairs go within the first planes; only the few left are multiplied out.

Anchors are a stated query set against all rows, in blocks of bounded bytes: each block is sent to the tasks once for positives and once for
negatives. A task gives back a few rows an anchor, and a window takes the best of all tasks.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, spread, written

#: Bytes of anchors that go to the tasks at once, and cells of a tile of products.
BLOCK_BYTES, TILE = 16 << 20, 1 << 21
#: Bounds beyond all products, which have under 2 ** 56; what is left of an interval may be added to them.
NONE, ALL = -(1 << 62), 1 << 62


def integers(vectors: DataFrame, id_col: str, label_col: str, vector_col: str, scale: float) -> DataFrame:
    """(id, label, q): floor(scale * x) of the rows that take part."""
    whole = F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    taken = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & whole)
    q = F.transform(vector_col, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("bigint"))
    return taken.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"), q.alias("q"))


def matrix(lists: list, width: int) -> np.ndarray:
    """Rows of integers; a shorter vector is followed by zeros."""
    out = np.zeros((len(lists), width), np.int64)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


class Planes:
    """Bit planes of a block of rows, the most significant first."""

    def __init__(self, q: np.ndarray, low: int, bits: int, kind: type):
        self.low, self.bits, self.kind, self.u = low, bits, kind, q - low

    def plane(self, b: int, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        return ((self.u[rows] >> b) & 1).astype(self.kind)


def survivors(a: np.ndarray, planes: Planes, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, product) of all pairs with least <= product <= most of the anchor, planes from the most significant on."""
    more, less, own = np.maximum(a, 0).sum(1), np.minimum(a, 0).sum(1), a.astype(planes.kind)
    product = np.repeat((a.sum(1) * planes.low)[:, None], len(planes.u), axis=1)
    at, b = None, planes.bits
    while b > 0:
        b -= 1
        rest = (1 << b) - 1
        if at is None:
            product += (own @ planes.plane(b).T).astype(np.int64) << b
            alive = (product >= (least - rest * more)[:, None]) & (product <= (most - rest * less)[:, None])
            if b == 0 or np.count_nonzero(alive) * 16 < alive.size:
                at = np.nonzero(alive)
                product = product[at]
        else:
            i, r = at
            product = product + (np.einsum("ij,ij->i", own[i], planes.plane(b, r)).astype(np.int64) << b)
            alive = (product >= least[i] - rest * more[i]) & (product <= most[i] - rest * less[i])
            at, product = (i[alive], r[alive]), product[alive]
    if at is None:  # no plane: all integers are equal
        at = np.nonzero((product >= least[:, None]) & (product <= most[:, None]))
        product = product[at]
    return at[0], at[1], product


class Best:
    """The ``k`` best (product, id) of each slot; equal ones count once."""

    def __init__(self, slots: int, k: int):
        self.k, self.last = k, np.full(slots, NONE)
        self.slot = self.score = self.ids = np.zeros(0, np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = np.concatenate([self.slot, slot]), np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        new = np.ones(len(slot), bool)
        new[1:] = (slot[1:] != slot[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        slot, score, ids = slot[new], score[new], ids[new]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        held = rank < self.k
        self.slot, self.score, self.ids = slot[held], score[held], ids[held]
        full = rank[held] == self.k - 1
        self.last[self.slot[full]] = self.score[full]


def tiles(n_rows: int, n_anchors: int) -> Iterator[tuple[slice, slice]]:
    """Blocks of rows and anchors; the first rows are few, so that later ones meet filled lists."""
    wide = min(2048, max(1, n_anchors))
    deep, at = max(16, TILE // wide), 0
    while at < n_rows:
        end = min(n_rows, at + (min(64, deep) if at == 0 else deep))
        for i in range(0, n_anchors, wide):
            yield slice(at, end), slice(i, min(n_anchors, i + wide))
        at = end


def positives_of(batches: Iterator[pd.DataFrame], sent, shape: tuple, k: int) -> Iterator[pd.DataFrame]:
    """(key, score, id): the k best rows of each anchor's label in this partition, the anchor's own id left out."""
    held = sent.value
    keys, ids, labels, a = held["key"], held["id"], held["label"], held["a"]
    width, low, bits, kind = shape
    best = Best(len(keys), k)
    for batch in batches:
        q, row_ids, row_labels = matrix(batch["q"].tolist(), width), batch["id"].to_numpy(), batch["label"].to_numpy()
        for label in np.intersect1d(row_labels, labels):
            own, rows = np.flatnonzero(labels == label), np.flatnonzero(row_labels == label)
            for r, i in tiles(len(rows), len(own)):
                mine, theirs = own[i], rows[r]
                x, y, score = survivors(a[mine], Planes(q[theirs], low, bits, kind), best.last[mine], np.full(len(mine), ALL))
                other = ids[mine[x]] != row_ids[theirs[y]]
                best.add(mine[x][other], score[other], row_ids[theirs[y]][other])
    yield pd.DataFrame({"key": keys[best.slot], "score": best.score, "id": best.ids})


def negatives_of(batches: Iterator[pd.DataFrame], sent, shape: tuple, k: int, low_share: int, high_share: int) -> Iterator[pd.DataFrame]:
    """(key, place, score, id): the k best rows of other labels within the shares of each positive's score, in this partition."""
    held = sent.value
    keys, ids, labels, a = held["key"], held["id"], held["label"], held["a"]
    anchor, place, score_of = held["of"], held["place"], held["score"]  # a row for each anchor and positive, by anchor
    floor, cap = -(-low_share * score_of // 100), high_share * score_of // 100
    starts = np.searchsorted(anchor, np.arange(len(keys) + 1))
    asked = starts[:-1] < starts[1:]
    width, low, bits, kind = shape
    best = Best(len(anchor), k)
    for batch in batches if asked.any() else ():
        q, row_ids, row_labels = matrix(batch["q"].tolist(), width), batch["id"].to_numpy(), batch["label"].to_numpy()
        who = np.flatnonzero(asked)
        for r, i in tiles(len(row_ids), len(who)):
            mine = who[i]
            # an anchor takes what any of its positives still takes
            least = np.minimum.reduceat(np.maximum(floor, best.last), starts[:-1][who])[i]
            most = np.maximum.reduceat(cap, starts[:-1][who])[i]
            x, y, score = survivors(a[mine], Planes(q[r], low, bits, kind), least, most)
            x, other = mine[x], row_ids[r][y]
            differ = (labels[x] != row_labels[r][y]) & (ids[x] != other)
            x, other, score = x[differ], other[differ], score[differ]
            n = starts[x + 1] - starts[x]
            pair = np.repeat(starts[x], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
            other, score = np.repeat(other, n), np.repeat(score, n)
            fits = (score >= floor[pair]) & (score <= cap[pair])
            best.add(pair[fits], score[fits], other[fits])
    yield pd.DataFrame({"key": keys[anchor[best.slot]], "place": place[best.slot], "score": best.score, "id": best.ids})


def mine(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", positives: int = 5, negatives: int = 3, low_share: int = 50, high_share: int = 95, scale: float = 256, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows for which ``anchors``, a condition
    on ``id``, ``label`` and ``q``, holds.

    Positives are the best ``positives`` rows of the anchor's label, negatives the best ``negatives`` of other labels whose score is between
    the two shares, in hundredths, of the positive's; ties by smaller id.

    Defined results: rows with a null id, label, vector or component, or one that isn't finite, take no part. A row of the anchor's id
    is neither its positive nor its negative. Rows equal in id and score count once in a list; anchors equal in id, label and
    vector are one, and those that share an id only are each asked for. A shorter vector is followed by zeros; an empty one has
    a score of 0. An empty table, or one without anchors, gives no row. Products that could leave 64 bits raise ValueError.
    Columns beyond the three are not read.
    """
    rows = written(spread(integers(vectors, id_col, label_col, vector_col, scale)), "integers")
    top = rows.agg(F.min(F.array_min("q")).alias("low"), F.max(F.array_max("q")).alias("high"), F.max(F.size("q")).alias("width")).first()
    low, high, width = top.low or 0, top.high or 0, top.width or 0
    low, high = min(low, 0), max(high, 0)  # shorter vectors are filled with zeros
    if width * max(-low, high) ** 2 * 100 >= 1 << 62 or width * max(-low, high) >= 1 << 53:
        raise ValueError("products of these vectors don't fit 64 bits")
    shape = (width, low, (high - low).bit_length(), np.float32 if width * max(-low, high) < 1 << 24 else np.float64)
    asked = rows.where(anchors).dropDuplicates(["id", "label", "q"]).withColumn("key", F.xxhash64("id", "label", "q"))
    asked = written(asked, "anchors")
    blocks = max(1, -(-asked.count() * (8 * width + 64) // block_bytes))
    asked = asked.withColumn("block", F.pmod(F.xxhash64(F.lit(7), "key"), F.lit(blocks)))
    out = []
    for n in range(blocks):
        own = asked.where(F.col("block") == n).select("key", "id", "label", "q").orderBy("id", "key").toPandas()
        out.append(_block(rows, own, shape, positives, negatives, low_share, high_share))
    discard(rows, asked)
    return functools.reduce(DataFrame.unionByName, out)


def _best(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """Rows of place 1 to k by score and id, equal ones once. A partition keeps k places before it is dealt."""
    place = F.dense_rank().over(Window.partitionBy(*by).orderBy(F.desc("score"), "id"))
    return rows.withColumn("rank", place).where(F.col("rank") <= k).dropDuplicates([*by, "rank"])


def _block(rows: DataFrame, own: pd.DataFrame, shape: tuple, positives: int, negatives: int, low_share: int, high_share: int) -> DataFrame:
    sc = rows.sparkSession.sparkContext
    block = {"key": own["key"].to_numpy(np.int64), "id": own["id"].to_numpy(np.int64), "label": own["label"].to_numpy(np.int64), "a": matrix(own["q"].tolist(), shape[0])}
    sent = sc.broadcast(block)
    near = rows.mapInPandas(lambda it: positives_of(it, sent, shape, positives), "key bigint, score bigint, id bigint")
    near = written(_best(near, ["key"], positives), "positives", lasting=True)
    found = near.toPandas()  # a few rows for each anchor of the block
    at = {k: i for i, k in enumerate(block["key"].tolist())}
    of = np.array([at[k] for k in found["key"].tolist()], np.int64)
    order = np.lexsort((found["rank"].to_numpy(), of))
    more = sc.broadcast(block | {"of": of[order], "place": found["rank"].to_numpy(np.int32)[order], "score": found["score"].to_numpy(np.int64)[order]})
    hard = rows.mapInPandas(lambda it: negatives_of(it, more, shape, negatives, low_share, high_share), "key bigint, place int, score bigint, id bigint")
    hard = written(_best(hard, ["key", "place"], negatives), "negatives", lasting=True)
    sent.destroy()
    more.destroy()
    ids = rows.sparkSession.createDataFrame(own[["key", "id"]].rename(columns={"id": "anchor_id"}), "key bigint, anchor_id bigint")
    told = near.select("key", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    hard = hard.select("key", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = hard.join(told, ["key", "place"]).join(ids, "key").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    out = written(out, "mined", lasting=True)
    discard(near, hard)
    return out


def oracle() -> str:
    return """with v as (
  select vec_id, case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
  from embeddings where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same, cast(list_dot_product(a.q, b.q) as bigint) as score from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
pos as (select anchor_id, other as positive_id, score as positive_score from p where same qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
select pos.anchor_id, positive_id, cast(row_number() over (partition by pos.anchor_id, positive_id order by p.score desc, p.other) as integer) as rank, p.other as negative_id, positive_score, p.score as negative_score
from pos join p on p.anchor_id = pos.anchor_id and not p.same and 50 * positive_score <= 100 * p.score and 100 * p.score <= 95 * positive_score
qualify row_number() over (partition by pos.anchor_id, positive_id order by p.score desc, p.other) <= 3"""
