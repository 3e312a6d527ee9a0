"""Ranked lexical search by windowed bucket scoring.

Documents are cut to terms once: each leaves its place, its size and the counts of the terms that the items ask for. Rows are dealt by
windows of ``WINDOW`` consecutive ids and sorted, so a task meets a window's rows together and turns them to postings: for each term the
slots of the window that hold it, what it adds there, and a bitset of the 64-slot buckets it touches. For an item the lists of its terms
are scatter-added to an array of the window's size, the union of the bitsets tells which buckets to harvest, and slots that
reach the last of the item's ten go into its heap. The heaps of all tasks meet in a window function.

Items are a stated query set: they pass the driver in blocks of bounded size, each block is asked of all documents.
"""

from __future__ import annotations

import functools
import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, spread, written

#: Ids of a window, slots of a bucket.
WINDOW, BUCKET = 1 << 15, 64
#: Most different terms of the items that share a pass over the texts, and most term places of a block of items.
TERMS, PLACES = 1 << 18, 1 << 16
#: Bytes of terms (A-Z folded, UTF-8 beyond ASCII as it is); all others part terms.
FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def counted(text: bytes | None) -> tuple[int, Counter]:
    """Number of terms of a UTF-8 text, and each term's."""
    found = Counter((text or b"").translate(FOLDED).split())
    return found.total(), found


def _entries(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """(id, n, terms, counts) of each document with a term; terms by number, those of the items only."""
    number = sent.value
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])
    for batch in batches:
        ids, sizes, own, counts = [], [], [], []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            n, found = counted(text.as_py())
            if n:
                met = sorted((number[t], c) for t, c in found.items() if t in number)
                ids.append(doc)
                sizes.append(n)
                own.append([t for t, _ in met])
                counts.append([c for _, c in met])
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(own, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))], schema=schema)


class Lists:
    """Postings of one window."""

    def __init__(self, docs: list[tuple], weight: np.ndarray, n_docs: int, n_terms: int):
        lens = [len(t) for _, _, t, _ in docs]
        slot = np.repeat(np.arange(len(docs)), lens)
        term = np.concatenate([t for _, _, t, _ in docs])
        tf = np.concatenate([c for _, _, _, c in docs])
        # Python's integers: 75 * n * N may leave 64 bits
        m = np.array([25 + 75 * n * n_docs // n_terms for _, n, _, _ in docs], np.int64)
        asked = weight[term] != 0
        slot, term, tf = slot[asked], term[asked], tf[asked]
        order = np.argsort(term, kind="stable")
        slot, term, tf = slot[order], term[order], tf[order]
        self.slot, self.adds = slot, weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[slot]))
        self.terms, self.starts = np.unique(term, return_index=True)
        self.ends = np.append(self.starts[1:], len(term))
        touched = np.zeros((len(self.terms), WINDOW // BUCKET), bool)
        touched[np.repeat(np.arange(len(self.terms)), self.ends - self.starts), slot // BUCKET] = True
        self.buckets = np.packbits(touched, axis=1)


def harvest(lists: Lists, wanted: np.ndarray, times: np.ndarray, scores: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(slots, scores) of at least ``least``, above 0, for one item's terms; ``scores`` is left at zero."""
    at = np.searchsorted(lists.terms, wanted)
    held = at < len(lists.terms)
    held[held] = lists.terms[at[held]] == wanted[held]
    at, times = at[held], times[held]
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    for k, n in zip(at.tolist(), times.tolist()):
        own = slice(lists.starts[k], lists.ends[k])
        scores[lists.slot[own]] += lists.adds[own] * n
    buckets = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(lists.buckets[at], axis=0)))
    met = scores.reshape(-1, BUCKET)[buckets]
    i, j = np.nonzero(met >= max(1, least))
    found = met[i, j]
    scores.reshape(-1, BUCKET)[buckets] = 0
    return buckets[i] * BUCKET + j, found


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of one window together, at most WINDOW of them: ids that repeat may fill more than one."""
    held, last = [], None
    for batch in batches:
        window, ids, n = (batch.column(k).to_pylist() for k in range(3))
        lists = [batch.column(k) for k in (3, 4)]
        for r in range(batch.num_rows):
            if held and (window[r] != last or len(held) == WINDOW):
                yield held
                held = []
            last = window[r]
            held.append((ids[r], n[r], lists[0][r].values.to_numpy(), lists[1][r].values.to_numpy()))
    if held:
        yield held


def _ranked(batches: Iterator[pa.RecordBatch], sent, limit: int) -> Iterator[pa.RecordBatch]:
    """(item, score, id): the ``limit`` best documents of this partition for each item of the block."""
    block = sent.value
    heaps: list[list] = [[] for _ in block["wanted"]]
    scores = np.zeros(WINDOW, np.int64)
    for docs in _windows(batches):
        lists = Lists(docs, block["weight"], block["docs"], block["terms"])
        for heap, wanted, times in zip(heaps, block["wanted"], block["times"]):
            slots, found = harvest(lists, wanted, times, scores, heap[0][0] if len(heap) == limit else 1)
            if len(slots) > limit:  # ties of the last place stay
                kept = found >= np.partition(found, -limit)[-limit]
                slots, found = slots[kept], found[kept]
            for s, score in zip(slots.tolist(), found.tolist()):
                # of equal scores the smaller id is better, a missing id the worst
                doc = docs[s][0]
                entry = (score, doc is not None, -doc if doc is not None else 0, doc)
                heapq.heappush(heap, entry) if len(heap) < limit else heapq.heappushpop(heap, entry)
    flat = [(block["number"][k], e[0], e[3]) for k, heap in enumerate(heaps) for e in heap]
    yield pa.record_batch([pa.array([x[k] for x in flat], pa.int64()) for k in range(3)], names=["item", "score", "doc_id"])


def _blocks(items: DataFrame, most_terms: int, most_places: int) -> Iterator[list[list[tuple]]]:
    """Passes of blocks of (number, Counter): a pass has at most ``most_terms`` different terms, a block ``most_places`` places."""
    blocks, block, vocabulary, places = [], [], set(), 0
    for number, text in items.toLocalIterator(prefetchPartitions=True):
        _, own = counted(text and text.encode())
        if not own:
            continue
        if (blocks or block) and len(vocabulary | own.keys()) > most_terms:
            yield [*blocks, block]
            blocks, block, vocabulary, places = [], [], set(), 0
        if block and places + len(own) > most_places:
            blocks.append(block)
            block, places = [], 0
        block.append((number, own))
        vocabulary |= own.keys()
        places += len(own)
    if block:
        yield [*blocks, block]


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", limit: int = 10, most_terms: int = TERMS, most_places: int = PLACES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``limit`` best documents of each item with a score above 0, ties by smaller id.

    Defined results: null and empty texts have no term; such documents aren't counted and such items find nothing. Rows of a null id
    are documents like others, after all ids at equal scores; rows of one id are documents each, also if they are equal. Items equal in
    id and text are one; those that share an id only, or have none, are ranked each. Empty tables give no row. Other columns aren't read.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("body")).dropDuplicates()
    asked = written(asked.withColumn("item", F.monotonically_increasing_id()), "items", lasting=True)
    texts = spread(docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("body")))
    out = [spark.createDataFrame([], "item bigint, score bigint, doc_id bigint")]
    for blocks in _blocks(asked.select("item", "body"), most_terms, most_places):
        number = {t: i for i, t in enumerate(sorted(set().union(*(own for b in blocks for _, own in b))))}
        out.append(_pass(texts, blocks, number, limit))
    every = functools.reduce(DataFrame.unionByName, out)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= limit)
    found = written(ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score"), "ranked", lasting=True)
    discard(asked, *out)
    return found


def _pass(texts: DataFrame, blocks: list[list[tuple]], number: dict[bytes, int], limit: int) -> DataFrame:
    """(item, score, doc_id) of the best of each task, for the blocks that share one pass over the texts."""
    spark = texts.sparkSession
    sent = spark.sparkContext.broadcast(number)
    cut = texts.mapInArrow(lambda it: _entries(it, sent), "id bigint, n bigint, terms array<int>, counts array<bigint>")
    dealt = cut.select(F.shiftright("id", WINDOW.bit_length() - 1).alias("window"), "id", "n", "terms", "counts")
    # a window that repeated or missing ids fill beyond measure is split
    postings = written(dealt.hint("rebalance", F.col("window")).sortWithinPartitions("window", "id"), "postings", lasting=True)
    sent.destroy()
    size = postings.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    weight = np.zeros(len(number), np.int64)
    for term, df in postings.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        weight[term] = math.floor(1000 * math.log((2 * size.docs + 2) / (2 * df + 1)))
    found = []
    for block in blocks:
        wanted = [np.array(sorted(number[t] for t in own), np.int32) for _, own in block]
        times = [np.array([c for _, c in sorted((number[t], c) for t, c in own.items())], np.int64) for _, own in block]
        needed = np.zeros(len(number), bool)
        for w in wanted:
            needed[w] = True
        held = spark.sparkContext.broadcast({"number": [n for n, _ in block], "wanted": wanted, "times": times, "weight": np.where(needed, weight, 0), "docs": size.docs, "terms": size.terms})
        best = postings.mapInArrow(lambda it: _ranked(it, held, limit), "item bigint, score bigint, doc_id bigint")
        found.append(written(best, "heaps", lasting=True))
        held.destroy()
    discard(postings)
    return functools.reduce(DataFrame.unionByName, found)


def oracle() -> str:
    return r"""with t as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
p as (select doc_id, term, count(*) as tf from t group by all),
d as (select doc_id, cast(sum(tf) as bigint) as n from p group by doc_id),
s as (select count(*) as docs, cast(sum(n) as bigint) as terms from d),
w as (select term, cast(floor(1000 * ln((2 * docs + 2) / cast(2 * count(*) + 1 as double))) as bigint) as weight from p, s group by term, docs),
q as (select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
r as (select item_id, doc_id, cast(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) as bigint) as score
  from q join w using (term) join p using (term) join d using (doc_id) cross join s group by item_id, doc_id)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score from r where score > 0
qualify row_number() over (partition by item_id order by score desc, doc_id) <= 10"""
