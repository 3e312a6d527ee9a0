"""Benchmark decontamination by latent semantic retrieval (operator 8).

The terms are the words of the benchmark: no other term can add to the inner product of a passage with an item. Texts are
split into words once; every later pass reads the written occurrences, a term's number and its place. Passages of PASSAGE
words of all documents give document frequencies; a term in most passages has a small weight, none is left out.

1. Randomised SVD: the unit TF-IDF rows A of all passages, and the items' rows weighted to the same total energy, are
   never gathered. Z = A'(A Omega) is summed per task, then per term; two rounds and a QR give the latent axes. The driver
   holds terms x axes numbers, bounded by ``block`` items at a time, whatever the corpus. A task multiplies the DENSE most
   frequent terms as a dense matrix and sums the others row by row.
2. Cosine candidates: windows of 2 x STEP words, every STEP words, of every document against all items of the block, a
   matrix product in each task; the window's length along the item must also reach ``along`` of the item's. No cap on the candidates of a document or an item.
3. Checks on the whole words of candidate documents around the window: longest common subsequence with the item at least
   ``lcs`` of its words; or at least ``loose`` of them with the answer, the item's last quarter, found to at least ``lcs``
   of its own words (paraphrase). Texts and candidates are sorted rows that a task streams, one text at a time.

Items of two to ``least_words`` - 1 words are too short for a cosine; they are found where their words stand in a row.
Benchmarks of any size go in blocks of items.

Defined results: words are runs of characters other than ASCII punctuation and white space, lower-cased. A null or empty
text has none. Items of one word or none can't be told from chance and are not searched. Rows are told apart by id and
text and answered by id, so rows of an equal or null id are one document's. An empty benchmark gives no rows.
"""

from __future__ import annotations

import itertools
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, release, spread, written

PASSAGE = 48
STEP = 24
DENSE = 512
_PLAIN = bytes.maketrans(string.punctuation.encode() + b"\t\n\r\x0b\x0c", b" " * (len(string.punctuation) + 5))


def words_of(text: str | None) -> list[bytes]:
    return text.lower().encode().translate(_PLAIN).split() if text else []


def common_subsequence(item: list, region: list) -> int:
    """Length of the longest common subsequence, bit-parallel over the item's positions."""
    where: dict = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in region:
        hit = row & where.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(item) - row.bit_count()


class Block:
    """Some items of the benchmark: their words and terms."""

    def __init__(self, items: list[tuple[int, str]], least_words: int):
        self.items = [(i, w) for i, t in sorted((x for x in items if x[0] is not None), key=lambda x: (x[0], x[1] or "")) if len(w := words_of(t)) >= 2]
        self.short = np.array([len(w) < least_words for _, w in self.items], bool)
        self.terms: dict[bytes, int] = {}
        for _, ws in self.items:
            for w in ws:
                if w not in self.terms:
                    self.terms[w] = len(self.terms)

    def flat(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        """(text, word position, term) of every occurrence of a term in the texts, and the words of each text."""
        get, none = self.terms.get, itertools.repeat(-1)
        found, sizes = [], []
        for t in texts:
            ws = words_of(t)
            sizes.append(len(ws))
            found.append(np.fromiter(map(get, ws, none), dtype=np.int32, count=len(ws)))
        term = np.concatenate(found) if found else np.zeros(0, np.int32)
        own = np.repeat(np.arange(len(texts)), sizes)
        start = np.cumsum([0, *sizes])[:-1]
        at = np.flatnonzero(term >= 0)
        return own[at], (at - start[own[at]]) if len(at) else at, term[at].astype(np.int64), sizes


def _parts(batch: pa.RecordBatch, most: int = 1 << 20) -> Iterator[tuple[int, list[str | None]]]:
    held, size, first = [], 0, 0
    for x in batch.column("text"):
        t = x.as_py()
        held.append(t)
        size += len(t or "")
        if size >= most:
            yield first, held
            first, held, size = first + len(held), [], 0
    if held:
        yield first, held


def _occurrences(docs: DataFrame, block: Block) -> DataFrame:
    """(id, h, words, terms, places) of every document: its number of words, and the benchmark's terms with their places, four bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for first, texts in _parts(batch):
                own, pos, term, words = block.flat(texts)
                off = np.r_[0, np.cumsum(np.bincount(own, minlength=len(texts)))] * 4
                cols = [batch.column(c).slice(first, len(texts)) for c in ("id", "h")]
                packed = [pa.BinaryArray.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(off.astype(np.int32).tobytes()), pa.py_buffer(x.astype("<i4").tobytes())]) for x in (term, pos)]
                cols += [pa.array(np.array(words, np.int64)), *packed]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "h", "words", "terms", "places"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, h bigint, words bigint, terms binary, places binary")


def _frequencies(found: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """Passages that hold each of n terms; number of passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        total = np.zeros(n, np.int64)
        for batch in batches:
            for own, place, term, _ in _flat_lists(batch):
                if len(own):
                    key = np.unique((own * (int(place.max()) // PASSAGE + 1) + place // PASSAGE) * n + term)
                    total += np.bincount(key % n, minlength=n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["term", "n"])

    passages = found.agg(F.sum(F.greatest(F.lit(1), F.ceil(F.col("words") / PASSAGE))).alias("n")).first().n
    out = np.zeros(n, np.int64)
    for r in found.select("id", "terms", "places").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r.term] = r.n
    return out, max(passages or 0, 1)


def _flat_lists(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """(row, place, term, rows) of some tens of thousands of occurrences at a time."""
    sizes = np.asarray(pc.binary_length(batch.column("terms"))) // 4
    cut = np.flatnonzero(np.diff(np.cumsum(sizes) // 25_000, prepend=0))
    for a, b in zip(np.r_[0, cut], np.r_[cut, len(sizes)], strict=True):
        if b > a:
            part = batch.slice(a, b - a)
            place, term = (np.frombuffer(b"".join(part.column(c).to_pylist()), "<i4").astype(np.int64) for c in ("places", "terms"))
            yield np.repeat(np.arange(b - a), sizes[a:b]), place, term, part


def _unit_rows(own: np.ndarray, term: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, value) of unit TF-IDF rows, sorted by row; rows are renumbered."""
    key, times = np.unique(own * len(weight) + term, return_counts=True)
    row, term = key // len(weight), key % len(weight)
    value = times * weight[term]
    row = np.cumsum(np.r_[False, row[1:] != row[:-1]])  # the keys are sorted
    return row, term, value / np.sqrt(np.bincount(row, weights=value * value))[row]


class _Split:
    """Sums of rows of a table by sparse (row, term, value): the most frequent terms as a dense product, the others row by row."""

    def __init__(self, frequent: np.ndarray, n: int):
        self.frequent = frequent
        self.place = np.full(n, -1, np.int64)
        self.place[frequent] = np.arange(len(frequent))

    def dense(self, rows: int, row: np.ndarray, term: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows x frequent terms, indices of the other entries)."""
        at = self.place[term]
        many = at >= 0
        k = len(self.frequent)
        out = np.zeros(rows * k, np.float32)
        np.add.at(out, row[many] * k + at[many], value[many].astype(np.float32))
        return out.reshape(rows, k), np.flatnonzero(~many)

    def image(self, rows: int, row: np.ndarray, term: np.ndarray, value: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The sums, row by row, of value * table[term]; and what dense() gives. Entries come by row."""
        front, rest = self.dense(rows, row, term, value)
        out = front @ table[self.frequent]
        if len(rest):
            r = row[rest]
            first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
            out[r[first]] += np.add.reduceat(table[term[rest]] * value[rest].astype(np.float32)[:, None], first, axis=0)
        return out, front, rest


def _gram(split: _Split, row: np.ndarray, term: np.ndarray, value: np.ndarray, omega: np.ndarray, total: np.ndarray) -> None:
    """Add A'(A omega) of the rows given to total."""
    if not len(row):
        return
    image, front, rest = split.image(int(row[-1]) + 1, row, term, value, omega)
    total[split.frequent] += front.T @ image
    if len(rest):
        order = rest[np.argsort(term[rest], kind="stable")]
        t = term[order]
        first = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
        total[t[first]] += np.add.reduceat(image[row[order]] * value[order].astype(np.float32)[:, None], first, axis=0)


def _normal_product(found: DataFrame, weight: np.ndarray, omega: np.ndarray, split: _Split) -> np.ndarray:
    """A'(A omega) over the passages of all documents."""
    shape = omega.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        total = np.zeros(shape, np.float32)
        for batch in batches:
            for own, place, term, _ in _flat_lists(batch):
                if len(own):
                    passage = own * (int(place.max()) // PASSAGE + 1) + place // PASSAGE
                    _gram(split, *_unit_rows(passage, term, weight), omega, total)
        at = np.flatnonzero(total.any(axis=1))
        yield _vectors(at, total[at])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for term, raw in zip(batch.column("term").to_pylist(), batch.column("vector").to_pylist(), strict=True):
                v = np.frombuffer(raw, np.float32).astype(np.float64)
                total[term] = total[term] + v if term in total else v
        yield _vectors(np.array(list(total), np.int64), np.array(list(total.values()), np.float32).reshape(-1, shape[1]))

    kinds = "term bigint, vector binary"
    out = np.zeros(shape, np.float64)
    summed = found.select("id", "terms", "places").mapInArrow(run, kinds).repartition("term").mapInArrow(add, kinds)
    for r in summed.toLocalIterator():
        out[r.term] = np.frombuffer(r.vector, np.float32)
    return out


def _vectors(terms: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(terms.astype(np.int64)), pa.array([r.astype(np.float32).tobytes() for r in rows], pa.binary())], names=["term", "vector"])


def latent_axes(found: DataFrame, block: Block, weight: np.ndarray, passages: int, axes: int, split: _Split) -> np.ndarray:
    """terms x axes: right singular vectors of the passages and items, by randomised subspace iteration."""
    n = len(weight)
    axes = min(axes, n)
    own = np.concatenate([np.full(len(ws), k) for k, (_, ws) in enumerate(block.items)])
    term = np.array([block.terms[w] for _, ws in block.items for w in ws], np.int64)
    row, term, value = _unit_rows(own, term, weight)
    share = passages / max(1, int(row.max(initial=0)) + 1)
    basis = np.random.default_rng(8).standard_normal((n, axes)).astype(np.float32)
    for _ in range(2):
        image = _normal_product(found, weight, basis, split)
        own_rows = np.zeros((n, axes), np.float32)
        _gram(split, row, term, value, basis, own_rows)
        basis = np.linalg.qr(image + share * own_rows)[0].astype(np.float32)
    return basis


def _candidates(found: DataFrame, block: Block, image: np.ndarray, items: np.ndarray, least: np.ndarray, cosine: float, split: _Split) -> DataFrame:
    """(id, h, item, at): windows whose latent cosine with an item reaches ``cosine`` and whose length along it ``least``.

    at is the window's first word. A window that holds a lone word of an item has a high cosine, but is short. Of a short
    item, every place where its words stand in a row.
    """
    long = np.flatnonzero(~block.short)
    short = [(k, [block.terms[w] for w in block.items[k][1]]) for k in np.flatnonzero(block.short).tolist()]

    def answer(part: pa.RecordBatch, row: np.ndarray, item: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
        rows = part.select(["id", "h"]).take(pa.array(row))
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(item.astype(np.int32)), pa.array(at.astype(np.int32))], names=["id", "h", "item", "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for own, place, term, part in _flat_lists(batch):
                if not len(own):
                    continue
                for k, terms in short:
                    hit = np.flatnonzero(term[: len(term) - len(terms) + 1] == terms[0])
                    for j, t in enumerate(terms[1:], 1):
                        hit = hit[(term[hit + j] == t) & (place[hit + j] == place[hit] + j) & (own[hit + j] == own[hit])]
                    if len(hit):
                        yield answer(part, own[hit], np.full(len(hit), k), place[hit])
                if not len(long):
                    continue
                span = int(place.max()) // STEP + 3
                step = own * span + place // STEP + 1  # from 1, so that the window that begins a step earlier has a key
                first = np.flatnonzero(np.r_[True, step[1:] != step[:-1]])  # occurrences come by document and place
                steps = step[first]
                row = np.cumsum(np.r_[False, step[1:] != step[:-1]])
                sums, _, _ = split.image(len(steps), row, term, np.ones(len(term)), image)
                keys = np.union1d(steps, steps - 1)
                vectors = np.zeros((len(keys), sums.shape[1]), np.float32)
                vectors[np.searchsorted(keys, steps)] = sums
                vectors[np.searchsorted(keys, steps - 1)] += sums
                size = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
                for a in range(0, len(keys), 2048):
                    along = vectors[a : a + 2048] @ items.T
                    some = np.flatnonzero(along.max(axis=1) >= cosine * size[a : a + 2048])
                    along = along[some]
                    w, item = np.nonzero((along >= cosine * size[a + some, None]) & (along >= least[None, :]))
                    if len(w):
                        key = keys[a + some[w]]
                        yield answer(part, key // span, long[item], (key % span - 1) * STEP)

    return found.mapInArrow(run, f"id {found.schema['id'].dataType.simpleString()}, h bigint, item int, at int")


def _checked(docs: DataFrame, candidates: DataFrame, block: Block, lcs: float, loose: float) -> DataFrame:
    items, short = block.items, block.short.tolist()

    def judged(words: list[bytes], found: list[tuple[int, int]]) -> dict[int, tuple]:
        best: dict[int, tuple] = {}
        for item, at in found:
            own = items[item][1]
            if short[item]:
                best[item] = max(best.get(item, (0.0, 0.0, 0)), (1.0, 1.0, -at))
                continue
            region = words[max(0, at - len(own)) : max(at, 0) + 2 * STEP + len(own)]
            shared = common_subsequence(own, region) / len(own)
            if shared < loose:
                continue
            tail = own[-max(4, len(own) // 4) :]
            answer = common_subsequence(tail, region) / len(tail)
            if shared >= lcs or answer >= lcs:
                best[item] = max(best.get(item, (0.0, 0.0, 0)), (shared, answer, -at))
        return best

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        """Over rows by id and h, a text before the candidates of it."""
        own, text, words = None, None, None
        for batch in batches:
            who = batch.select(["id", "h"]).to_pylist()
            found, ats, texts = batch.column("item").to_pylist(), batch.column("at").to_pylist(), batch.column("text")
            out = []
            for i, name in enumerate(who):
                if found[i] is None:
                    if name != own:
                        own, text, words = name, texts[i], None
                    continue
                if words is None:
                    words = words_of(text.as_py())
                out += [(i, items[k][0], round(s, 6), round(a, 6), max(0, -at)) for k, (s, a, at) in judged(words, [(found[i], ats[i])]).items()]
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32()]
            cols = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(cols[0]), *cols[1:]], names=["id", "item_id", "lcs", "answer", "at_word"])

    none = {c: F.lit(None).cast(t) for c, t in (("item", "int"), ("at", "int"))}
    rows = docs.where(F.length("text") > 0).withColumns(none).unionByName(candidates.distinct().withColumn("text", F.lit(None).cast("string")))
    rows = rows.repartition("id", "h").sortWithinPartitions("id", "h", F.col("item").asc_nulls_first())
    return rows.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, item_id bigint, lcs double, answer double, at_word int")


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", axes: int = 160, cosine: float = 0.5, along: float = 0.4, lcs: float = 0.8, loose: float = 0.6, least_words: int = 5, block: int = 512) -> DataFrame:
    """One row per contaminated document and item: id, item_id, lcs, answer, at_word."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    texts = spread(docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), text.alias("text")))
    items = benchmark.select(F.col(item_col).cast("bigint").alias("i"), F.col(item_text_col).alias("t")).distinct()
    blocks = -(-items.count() // block)
    kinds = {"id": texts.schema["id"].dataType.simpleString(), "item_id": "bigint", "lcs": "double", "answer": "double", "at_word": "int"}
    out = spark.range(0).select(*[F.lit(None).cast(t).alias(c) for c, t in kinds.items()])
    for k in range(blocks):
        own = Block([(r.i, r.t) for r in items.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == k).collect()], least_words)
        if not own.items:
            continue
        found = written(_occurrences(texts, own), "occurrences")
        seen, passages = _frequencies(found, len(own.terms))
        weight = np.log((passages + 1) / (np.minimum(seen, passages) + 0.5))
        weight = np.maximum(weight, 0.01)  # at any size of the table a term of the benchmark counts
        split = _Split(np.argsort(-seen, kind="stable")[:DENSE], len(seen))
        basis = latent_axes(found, own, weight, passages, axes, split)
        image = (weight[:, None] * basis).astype(np.float32)
        long = [ws for (_, ws), x in zip(own.items, own.short, strict=True) if not x]
        vectors = np.array([image[[own.terms[w] for w in ws]].sum(axis=0) for ws in long], np.float32).reshape(len(long), image.shape[1])
        norm = np.maximum(np.sqrt((vectors * vectors).sum(axis=1)), 1e-9)
        covered = np.minimum(1.0, (2 * STEP - STEP / 2) / np.array([len(ws) for ws in long], float))  # of a long item a window holds a part
        near = written(_candidates(found, own, image, vectors / norm[:, None], along * covered * norm, cosine, split), "candidates")
        discard(found)
        out = out.unionByName(written(_checked(texts, near, own, lcs, loose), "leaks"))
        discard(near)
    best = out.groupBy("id", "item_id").agg(F.max(F.struct("lcs", "answer", "at_word")).alias("b"))
    return best.select(F.col("id").alias(id_col), "item_id", "b.*")
