"""Suffix-array dedup with a run-length index (operator 3).

Every byte covered by a string of ``length`` bytes that also starts anywhere else is removed. Exact at any input size:

1. Cells. Each window of ``length`` bytes picks its least 32-byte gram (leftmost of ties). The consecutive windows that
   pick one gram are a cell; a cell's context is the bytes its windows cover. Equal windows pick equal grams at equal
   distances, so two occurrences of a string lie in cells of equal gram hash. Grams that stand once are dropped; equal
   contexts of a gram become one row with their number before anything is moved, however many copies there are.
2. Index. The contexts of some grams, half a megabyte at a time, go to a run-length index: suffix order, run-compressed
   Burrows-Wheeler transform, the two text positions at each run's end as samples and their common length. Matching statistics
   are streamed over the text from the samples alone (a position that is no run end has its predecessor's match, one
   shorter); an entry that stands for several copies matches itself to its end. Windows whose statistic reaches ``length``
   are marked, and every member of a context gets the context's marks. All removals come from here.
3. A gram with more than ``hot`` different contexts is split by its surroundings: a strip is the windows whose starts lie
   in one row of STRIP distances from the gram, and is keyed by all the bytes these windows share. Equal windows lie in
   strips of one key. What the strip has besides, at most STRIP - 1 bytes on either side, is indexed as above with the
   shared bytes as one symbol. A key of more than ``part`` different strips is split again, into single windows: those of
   one key are then equal, and their number says whether they are repeated.

Texts are gathered as sorted rows that a task streams, one text at a time; no list of a document or gram is built.

Defined results: null text is empty; a text shorter than ``length`` keeps all; rows are told apart by id and text, so rows
of an equal or null id don't mix (rows equal in both are copies of each other).
"""

from __future__ import annotations

import hashlib
import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_batches, discard, mix64, release, scratch, spread, utf8_parts, written

GRAM = 32
PIECE = 1 << 20  # a longer text is cut into pieces of so many window starts
STRIP = 16
INDEX_BYTES = 1 << 19
CELL = "key bigint, c bigint, id bigint, h bigint, start bigint, len int, anchor int"
_U = np.uint64


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the 32 bytes from each position (zeros beyond the end)."""
    n = len(data)
    padded = np.zeros(n + GRAM + 8, np.uint8)
    padded[:n] = data
    eight = np.ndarray((n + GRAM,), dtype="<u8", buffer=padded.data, strides=(1,)).astype(np.uint64)
    eight *= _U(0x9E3779B97F4A7C15)
    eight ^= eight >> _U(29)
    two = eight[:-8] * _U(0xC2B2AE3D27D4EB4F) + eight[8:]
    two ^= two >> _U(31)
    return mix64(two[:n] * _U(0x165667B19E3779F9) + two[16 : n + 16])


def least_grams(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each start the position of the least hash among ``width`` grams, leftmost of (40-bit) ties."""
    low = (hashes & ~_U(0xFFFFFF)) | np.arange(len(hashes), dtype=np.uint64)
    have = 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: len(low) - (width - have)], low[width - have :])
    return (low & _U(0xFFFFFF)).astype(np.int64)


def cells(data: np.ndarray, begins: np.ndarray, stops: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(gram hash, anchor, first start, last start) of the cells of the texts data[begins[i]:stops[i]]."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none, none, none
    hashes = gram_hashes(data)
    at = least_grams(hashes, length - GRAM + 1)[: len(data) - length + 1]
    change = np.zeros(len(data) + 1, np.int64)
    long = stops - begins >= length
    np.add.at(change, begins[long], 1)
    np.add.at(change, stops[long] - length + 1, -1)
    valid = np.cumsum(change)[: len(at)] > 0
    edge = np.ones(len(at), bool)
    edge[1:] = (at[1:] != at[:-1]) | ~valid[:-1]
    first = np.flatnonzero(edge & valid)
    if not len(first):
        return none.astype(np.uint64), none, none, none
    ends = np.ones(len(at), bool)
    ends[:-1] = (at[1:] != at[:-1]) | ~valid[1:]
    last = np.flatnonzero(ends & valid)
    return hashes[at[first]], at[first], first, last


def _pieces(batch: pa.RecordBatch, length: int):
    """(row of each text, its first byte in the row's text, bytes, begins, stops): texts of about a megabyte together."""
    for a, b in byte_batches(batch, "text"):
        data, off = utf8_parts(batch.column("text").slice(a, b - a))
        if len(data) <= PIECE + length:
            yield np.arange(a, b), np.zeros(b - a, np.int64), data, off[:-1], off[1:]
        else:  # one long text, after empty ones
            for s in range(0, len(data), PIECE):
                part = data[s : s + PIECE + length - 1]
                yield np.array([b - 1]), np.array([s]), part, np.array([0]), np.array([len(part)])


def _deal(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for rows, shift, data, begins, stops in _pieces(batch, length):
                key, anchor, first, last = cells(data, begins, stops, length)
                if not len(key):
                    continue
                raw = data.tobytes()
                digest = xxhash.xxh3_64_intdigest
                digests = np.array([digest(raw[s : e + length]) for s, e in zip(first.tolist(), last.tolist(), strict=True)], np.uint64)
                own = np.searchsorted(begins, first, side="right") - 1
                while (bad := stops[own] <= first).any():  # empty texts share a begin
                    own[bad] += 1
                who = pa.array(rows[own])
                cols = [pa.array(key.view(np.int64)), pa.array(digests.view(np.int64)), batch.column("id").take(who), batch.column("h").take(who), pa.array(first - begins[own] + shift[own])]
                cols += [pa.array(x.astype(np.int32)) for x in (last - first + length, anchor - first)]
                yield pa.RecordBatch.from_arrays(cols, names=["key", "c", "id", "h", "start", "len", "anchor"])

    return run


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array of small non-negative integers by prefix doubling; only what is still tied is sorted again."""
    n = len(text)
    packed = np.zeros(n, np.int64)
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(8, np.int64)])
    for j in range(7):
        packed = (packed << 9) | padded[j : j + n]
    order = np.argsort(packed, kind="stable")
    sorted_keys = packed[order]
    new = np.ones(n, bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    place = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = place
    have = 7
    while True:
        alone = new.copy()
        alone[:-1] &= new[1:]
        tied = np.flatnonzero(~alone)
        if not len(tied):
            return order
        who = order[tied]
        key = (rank[who] << 32) | (rank[np.minimum(who + have, n)] + 1)
        by = np.argsort(key, kind="stable")
        order[tied] = who = who[by]
        key = key[by]
        differs = np.ones(len(key), bool)
        differs[1:] = key[1:] != key[:-1]
        new[tied] = differs
        place = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[who] = place[tied]
        have *= 2


def common_length(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes at a and b (a != b)."""
    n = len(text)
    padded = np.zeros(2 * n + 16, np.uint8)  # a byte after the end differs: the ends are compared by position below
    padded[:n] = text
    eight = np.ndarray((n + 8,), dtype="<u8", buffer=padded.data, strides=(1,))
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    la, lb = a.copy(), b.copy()
    while len(live):
        x = eight[np.minimum(la, n)] ^ eight[np.minimum(lb, n)]
        same = x == 0
        low = np.bitwise_count((x & (~x + _U(1))) - _U(1)) // 8
        out[live] += np.where(same, 8, low)
        same &= np.maximum(la, lb) + 8 < n
        live, la, lb = live[same], la[same] + 8, lb[same] + 8
    return np.minimum(out, n - np.maximum(a, b))


class RunLengthIndex:
    """Run-length BWT of a text, with the text positions at both sides of each run boundary and their common length."""

    def __init__(self, text: np.ndarray):
        self.order = order = suffix_order(text)
        last = text[order - 1]  # the symbol before each suffix; before the first one, the last
        head = np.flatnonzero(last[1:] != last[:-1]) + 1
        wrap = np.flatnonzero(order == 0)
        head = np.union1d(head, np.concatenate([wrap, wrap + 1]))
        head = head[(head > 0) & (head < len(order))]
        self.size = len(text)
        self.runs = np.concatenate([last[:1], last[head]])
        self.run_starts = np.concatenate([np.zeros(1, np.int64), head])
        self.samples = order[head], order[head - 1]
        self.common = common_length(text, *self.samples)

    def matching_statistics(self) -> np.ndarray:
        """For each text position the length of its longest match that starts elsewhere in the text."""
        reach = np.zeros(self.size, np.int64)
        for side in self.samples:
            np.maximum.at(reach, side, side + self.common)
        reach = np.maximum.accumulate(reach)
        return np.maximum(reach - np.arange(self.size), 0)


def repeated_spans(contexts: list[bytes], copies: list[int], length: int) -> list[list[tuple[int, int]]]:
    """Per context the spans of bytes covered by a string of ``length`` bytes that starts elsewhere.

    ``copies`` is how many times each context stands in the corpus; the index holds it once.
    """
    sizes = np.array([len(c) for c in contexts])
    begin = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes + 1)])
    text = np.frombuffer(b"\xff".join(contexts) + b"\xff", dtype=np.uint8)  # 0xff is in no UTF-8 text
    own = np.repeat(np.arange(len(contexts)), sizes + 1)
    rest = (begin[:-1] + sizes)[own] - np.arange(len(text))  # bytes to the context's end
    match = RunLengthIndex(text).matching_statistics()
    match = np.where(np.array(copies)[own] > 1, np.maximum(match, rest), match)
    out: list[list[tuple[int, int]]] = [[] for _ in contexts]
    at = np.flatnonzero((match >= length) & (rest >= length))
    if len(at):
        cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(own[at]) > 0))
        for s, e in zip(at[np.r_[0, cut + 1]].tolist(), at[np.r_[cut, len(at) - 1]].tolist(), strict=True):
            k = own[s]
            out[k].append((s - int(begin[k]), e + length - int(begin[k])))
    return out


BODY = "key bigint, c bigint, n bigint, body binary, k bigint, a int, lead binary, tail binary"


def _fetch(length: int):
    """mapInArrow function over texts and contexts (id, h, text, key, c, n, start, len, anchor, hot), a text before its contexts.

    Gives the contexts as (key, c, n, body), those of hot grams as strips (key, c, n, k, a, lead, tail): k is the hash of the
    bytes that all windows of the strip share, a the strip's first window in the context.
    """
    names = [x.split()[0] for x in BODY.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]

    def strips(raw: bytes, start: int, size: int, anchor: int) -> Iterator[tuple[int, int, bytes, bytes]]:
        gram, last = start + anchor, start + size - length
        for q in range((gram - last) // STRIP, anchor // STRIP + 1):
            right = gram - q * STRIP  # the strip's last start; all of its windows reach from here to ...
            left = right - STRIP + 1
            a, b = max(start, left), min(last, right)
            k = struct.unpack("<q", xxhash.xxh3_64_digest(raw[right : left + length], q))[0]
            yield k, a - start, raw[a:right], raw[left + length : b + length]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        own, text, raw = None, None, b""
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            ids, texts = zip(batch.column("id").to_pylist(), batch.column("h").to_pylist(), strict=True), batch.column("text")
            cells = zip(*(batch.column(x).to_pylist() for x in ("key", "c", "n", "start", "len", "anchor", "hot")), strict=True)
            for i, (who, (key, c, n, start, length_, anchor, hot)) in enumerate(zip(ids, cells, strict=True)):
                if key is None:
                    if who != own:  # rows of an equal id and text are alike
                        own, text, raw = who, texts[i], None
                    continue
                if raw is None:
                    raw = text.as_py().encode()
                if hot:
                    rows += [(key, c, n, None, *x) for x in strips(raw, start, length_, anchor)]
                else:
                    rows.append((key, c, n, raw[start : start + length_], None, None, None, None))
                size += length_
                if size > 1 << 21 or len(rows) >= 8192:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return run


def _batches_of(batches: Iterator[pa.RecordBatch], names: list[str], size_of) -> Iterator[list[tuple]]:
    """Rows of batches sorted by their first column, some INDEX_BYTES at a time; the rows of a key stay together."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(x).to_pylist() for x in names), strict=True):
            if size >= INDEX_BYTES and row[0] != held[-1][0]:
                yield held
                held, size = [], 0
            held.append(row)
            size += size_of(row)
    if held:
        yield held


def _index(length: int):
    """mapInArrow function over contexts (key, c, n, body) by key: their repeated spans (key, c, a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for rows in _batches_of(batches, ["key", "c", "n", "body"], lambda r: len(r[3])):
            spans = repeated_spans([r[3] for r in rows], [r[2] for r in rows], length)
            flat = [(r[0], r[1], a, b) for r, own in zip(rows, spans, strict=True) for a, b in own]
            cols = list(zip(*flat, strict=True)) if flat else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["key", "c", "a", "b"])

    return run


def _index_strips(length: int):
    """mapInArrow function over strips (k, lead, tail, n) by k: the repeated windows x to y of each, as (k, lead, tail, x, y).

    The shared bytes are one symbol: 0xfe, which is in no UTF-8 text, and the number of the key.
    """
    names = ["k", "lead", "tail", "x", "y"]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for rows in _batches_of(batches, ["k", "lead", "tail", "n"], lambda r: 2 * STRIP):
            number = {k: bytes([0xFE, *(i >> s & 0x7F for s in (21, 14, 7, 0))]) for i, k in enumerate(dict.fromkeys(r[0] for r in rows))}
            width = STRIP - 1 + 5
            spans = repeated_spans([r[1] + number[r[0]] + r[2] for r in rows], [r[3] for r in rows], width)
            flat = [(*r[:3], a, b - width) for r, own in zip(rows, spans, strict=True) for a, b in own]
            cols = list(zip(*flat, strict=True)) if flat else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds, strict=True)], names=names)

    return run


def _marked_strips(strips: DataFrame, length: int, part: int) -> DataFrame:
    """(key, c, a, b): repeated spans of the contexts that were split to strips."""
    kinds = written(strips.groupBy("k", "lead", "tail").agg(F.sum("n").alias("n")), "kinds")
    large = written(kinds.groupBy("k").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > part).select("k"), "large")
    fits = kinds.join(large.hint("merge"), "k", "left_anti").select("k", "lead", "tail", "n")
    marks = fits.repartition("k").sortWithinPartitions("k").mapInArrow(_index_strips(length), "k bigint, lead binary, tail binary, x int, y int")
    if not large.isEmpty():
        # window x has the last bytes of the lead from x on, and as much of the tail as is wanting to STRIP - 1
        at = F.explode(F.sequence(F.lit(0), F.octet_length("lead") + F.octet_length("tail") - (STRIP - 1)))
        windows = kinds.join(large.hint("merge"), "k", "left_semi").select("k", "lead", "tail", "n", at.alias("x"))
        before = F.col("lead").substr(F.col("x") + 1, F.lit(STRIP))
        after = F.col("tail").substr(F.lit(1), F.lit(STRIP - 1) - F.octet_length("lead") + F.col("x"))
        windows = windows.withColumn("w", F.xxhash64("k", F.octet_length("lead") - F.col("x"), F.hex(before), F.hex(after)))
        twice = written(windows.groupBy("k", "w").agg(F.sum("n").alias("n")).where("n > 1").select("k", "w"), "twice")
        marks = marks.unionByName(windows.join(twice.hint("merge"), ["k", "w"]).select("k", "lead", "tail", "x", F.col("x").alias("y")))
    found = strips.join(marks.hint("merge"), ["k", "lead", "tail"])
    return found.select("key", "c", (F.col("a") + F.col("x")).alias("a"), (F.col("a") + F.col("y") + length).alias("b"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple:
    """(id, h, text): what tells rows apart, and the text."""
    text = F.col(text_col).cast("string")
    return F.coalesce(F.col(id_col).cast("bigint"), F.lit(0)).alias("id"), F.xxhash64(text).alias("h"), text.alias("text")


def spans(docs: DataFrame, id_col: str, text_col: str, length: int, hot: int = 250, part: int = 20_000) -> DataFrame:
    """(id, h, a, b): the repeated spans [a, b) in the UTF-8 bytes of the rows of docs; they may overlap.

    id is 0 where it is null, h the text's xxhash64.
    """
    texts = docs.select(*_keyed(docs, id_col, text_col))
    found = written(spread(texts).mapInArrow(_deal(length), CELL), "cells")
    # grams that stand once are most of all; counts are written, so that a join has two plain sides, of which a hot key's part can be split
    twice = written(found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "twice")
    live = written(found.join(twice.hint("merge"), "key", "left_semi"), "live")
    discard(found, twice)
    contexts = written(live.groupBy("key", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "h", "start", "len", "anchor")).alias("rep")), "contexts")
    crowded = written(contexts.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > hot).select("key", F.lit(True).alias("hot")), "crowded")
    cells = contexts.join(crowded.hint("merge"), "key", "left").select("rep.id", "rep.h", F.lit(None).cast("string").alias("text"), "key", "c", "n", "rep.start", "rep.len", "rep.anchor", F.coalesce("hot", F.lit(False)).alias("hot"))
    blank = {"key": "bigint", "c": "bigint", "n": "bigint", "start": "bigint", "len": "int", "anchor": "int", "hot": "boolean"}
    rows = texts.where(F.octet_length("text") >= length).select("id", "h", "text", *[F.lit(None).cast(t).alias(x) for x, t in blank.items()]).unionByName(cells)
    rows = rows.repartition("id", "h").sortWithinPartitions("id", "h", F.col("key").asc_nulls_first())
    fetched = written(rows.mapInArrow(_fetch(length), BODY), "fetched")
    discard(contexts, crowded)
    bodies = fetched.where("body is not null").select("key", "c", "n", "body")
    marks = written(bodies.repartition("key").sortWithinPartitions("key").mapInArrow(_index(length), "key bigint, c bigint, a int, b int"), "marks")
    strips = fetched.where("body is null").select("key", "c", "n", "k", "a", "lead", "tail")
    every = marks
    if not strips.isEmpty():
        with scratch():
            more = written(_marked_strips(strips, length, part), "more", lasting=True)
        every = marks.unionByName(more)
    else:
        more = marks
    discard(fetched)
    every = live.join(every.hint("merge"), ["key", "c"]).select("id", "h", (F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b")).alias("b"))
    out = written(every.distinct(), "spans")
    discard(live, marks, more)
    return out


def cut(raw: bytes, runs: list[list[int]]) -> bytes:
    """What is left of raw without the runs."""
    edges = [0, *itertools.chain.from_iterable(runs), len(raw)]
    return b"".join(raw[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, hot: int = 250, carry: list[str] | None = None, part: int = 20_000) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, kept_text, and the columns ``carry``.

    kept_text is the remaining bytes as text; a character that was cut into is left out.
    """
    carry = [c for c in (carry or []) if c not in (id_col, text_col)]
    found = spans(docs, id_col, text_col, length, hot, part)
    keep = ["_id", *[f"_c{k}" for k in range(len(carry))]]
    texts = docs.select(*_keyed(docs, id_col, text_col), F.col(id_col).alias("_id"), *[F.col(c).alias(f"_c{k}") for k, c in enumerate(carry)])
    texts = texts.withColumns({"a": F.lit(None).cast("bigint"), "b": F.lit(None).cast("bigint")})
    names = [*keep, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        """Over rows by id and h, spans by their start before the texts that they are of."""
        own, runs = None, []
        for batch in batches:
            starts, ends = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            at, rows, size, texts = [], [], 0, batch.column("text")
            for i, who in enumerate(zip(batch.column("id").to_pylist(), batch.column("h").to_pylist(), strict=True)):
                if who != own:
                    own, runs = who, []
                if starts[i] is not None:
                    if runs and starts[i] <= runs[-1][1]:  # touching spans are one run
                        runs[-1][1] = max(runs[-1][1], ends[i])
                    else:
                        runs.append([starts[i], ends[i]])
                    continue
                raw = (texts[i].as_py() or "").encode()
                kept = cut(raw, runs) if runs else raw
                at.append(i)
                rows.append((len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore")))
                size += len(kept)
                if size > 1 << 22 or i == batch.num_rows - 1:
                    yield answer(batch, at, rows)
                    at, rows, size = [], [], 0
            if rows:
                yield answer(batch, at, rows)

    def answer(batch: pa.RecordBatch, at: list[int], rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.string()] * 2
        told = batch.select(keep).take(pa.array(at, pa.int64()))
        return pa.RecordBatch.from_arrays([*told.columns, *[pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]], names=names)

    rows = texts.unionByName(found, allowMissingColumns=True).repartition("id", "h").sortWithinPartitions("id", "h", F.col("a").asc_nulls_last())
    told = ", ".join(f"{k} {texts.schema[k].dataType.simpleString()}" for k in keep)
    out = rows.mapInArrow(run, f"{told}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string")
    return out.select(F.col("_id").alias(id_col), *[F.col(f"_c{k}").alias(c) for k, c in enumerate(carry)], *names[len(keep) :])
