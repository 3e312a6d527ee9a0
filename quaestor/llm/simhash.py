"""SimHash near-duplicates by anchor-point covering (operator 6).

A document's fingerprint is made of 64-bit words; each word is cut into two 32-bit blocks. Anchors of a block are
the words of a covering code: the [31,26] Hamming code on bits 0-30, bit 31 free, covering radius 1. Two blocks that
differ in at most t bits have a midpoint at most ceil(t/2) from both, and an anchor at most 1 from that midpoint. So a
block copied to every anchor within 1 + ceil(t/2) meets each such partner at a common anchor, where pairs are compared
on the whole fingerprint. For one 64-bit word and 4 bits, one of two blocks differs in at most 2: t = 2, radius 2,
17 anchors a block at most, and no link is lost.

Distribution: equal fingerprints are one class before anything is copied, so a group of exact copies, however large,
costs one row. Copies are dealt by anchor and sorted; a task streams them and emits a spanning forest of the links at an
anchor, at most one link per class, never all pairs. Anchors with more than ``hot`` classes are dealt again by anchors of
the other block, radius 1 + ceil(4/2); such a bucket can hold at most 529 x 5489 different fingerprints. Components
come from alternating large-star and small-star rounds, each written to the shared folder.

``duplicates``, the pipeline's route, judges by Jaccard similarity: texts whose fingerprints meet at an anchor are compared
first; fingerprints lose pairs at a similarity of 0.8, so keys of shingle segments find the links between texts still apart.

Defined results: null or wordless text has fingerprint zero, and is linked like any other; ties in a bit's vote give 0.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import discard, mix64, release, spread, written
from .urlfilter import filter_words, passes

BLOCK = 32
SIEVE = 1 << 24
_U = np.uint64


def shingle_hashes(text: str | None, width: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each space-joined shingle of ``width`` lower-cased words; of the whole sequence if there are fewer."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    line = b" ".join(words)
    if len(words) <= width:
        return np.array([digest(line, seed)], dtype=np.uint64)
    ends = list(itertools.accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0, *(e + 1 for e in ends[:-width])]
    return np.array([digest(line[a:b], seed) for a, b in zip(starts, ends[width - 1 :], strict=True)], dtype=np.uint64)


def vote(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[a : a + (1 << 16)]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keep: list[str], text_col: str, width: int, words: int = 1) -> DataFrame:
    """``keep`` columns and fp, an array of ``words`` 64-bit words; word k votes on the hashes multiplied by a k-th odd constant."""
    odd = [1] + [int(x) | 1 for x in np.random.default_rng(6).integers(1 << 40, 1 << 63, words - 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            out = []
            for x in batch.column("_text"):
                h = shingle_hashes(x.as_py(), width)
                row = [vote(h)]
                for m in odd[1:]:
                    z = h * _U(m)
                    row.append(vote((z ^ (z >> _U(29))) * _U(0x9E3779B97F4A7C15)))
                out.append(row)
            flat = np.array(out, dtype=np.uint64).reshape(-1).view(np.int64)
            lists = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, words, dtype=np.int32), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in keep] + [lists], names=[*keep, "fp"])

    few = docs.select(*keep, F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in few.schema.fields[:-1])
    return spread(few).mapInArrow(run, f"{kinds}, fp array<bigint>")


def syndrome(x: np.ndarray) -> np.ndarray:
    """Of bits 0-30 under the Hamming code whose k-th position (1-31) has the column k."""
    s = np.zeros(len(x), np.uint64)
    for k in range(31):
        s ^= ((x >> _U(k)) & _U(1)) * _U(k + 1)
    return s


def _flips(s: int, radius: int) -> list[int]:
    """Masks of at most ``radius`` of 32 bits that turn a block of syndrome s into an anchor."""
    out = []
    for n in range(radius + 1):
        for own in itertools.combinations(range(1, 32), n):
            if int(np.bitwise_xor.reduce(own)) == s if own else s == 0:
                mask = sum(1 << (k - 1) for k in own)
                out.append(mask)
                if n < radius:
                    out.append(mask | 1 << 31)
    return out


def flip_table(radius: int) -> list[np.ndarray]:
    return [np.array(_flips(s, radius), dtype=np.uint64) for s in range(32)]


def anchors(block: np.ndarray, table: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) of every anchor within the table's radius of each 32-bit block."""
    s = syndrome(block)
    rows, found = [], []
    for k in range(32):
        at = np.flatnonzero(s == _U(k))
        if len(at):
            rows.append(np.repeat(at, len(table[k])))
            found.append((block[at][:, None] ^ table[k][None, :]).ravel())
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(rows), np.concatenate(found)


def forest(fps: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the rows of fps (n, words) that differ in at most ``limit`` bits.

    A reached row leaves the pool, so a dense group needs few comparisons and gives len(group) - 1 links.
    """
    pool = np.arange(len(fps))
    out = []
    while len(pool) > 1:
        queue, pool = [int(pool[0])], pool[1:]
        while queue and len(pool):
            x = queue.pop()
            near = np.bitwise_count(fps[pool] ^ fps[x]).sum(axis=1) <= limit
            if near.any():
                got = pool[near].tolist()
                out += [(x, y) for y in got]
                queue += got
                pool = pool[~near]
    return out


def _linker(words: int, limit: int):
    """mapInArrow function over rows (k0, k1, fp words) sorted by key: links between classes that share a key."""
    cols = [f"w{i}" for i in range(words)]

    def links(keys: np.ndarray, fps: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        a, b = [], []
        edge = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1), True])
        size = np.diff(edge)
        for k in range(1, min(int(size.max(initial=0)), 24)):  # short runs: all runs at once, neighbours k apart
            run = np.repeat(np.where(size <= 24, size, 0), size)
            pos = np.arange(len(keys)) - np.repeat(edge[:-1], size)
            at = np.flatnonzero(pos + k < run)
            at = at[np.bitwise_count(fps[at] ^ fps[at + k]).sum(axis=1) <= limit]
            a.append(fps[at])
            b.append(fps[at + k])
        for s, n in zip(edge[:-1][size > 24], size[size > 24], strict=True):
            pairs = np.array(forest(fps[s : s + n], limit), dtype=np.int64).reshape(-1, 2) + s
            a.append(fps[pairs[:, 0]])
            b.append(fps[pairs[:, 1]])
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        kept_k = np.zeros((0, 2), np.int64)
        kept_f = np.zeros((0, words), np.uint64)
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                kept_k = np.r_[kept_k, np.stack([np.asarray(batch.column("k0")), np.asarray(batch.column("k1"))], axis=1)]
                kept_f = np.r_[kept_f, np.stack([np.asarray(batch.column(c)).view(np.uint64) for c in cols], axis=1)]
                last = np.flatnonzero((kept_k != kept_k[-1]).any(axis=1)) if len(kept_k) else []
                upto = int(last[-1]) + 1 if len(last) else 0  # the last run may go on in the next batch
            else:
                upto = len(kept_k)
            if upto:
                a, b = links(kept_k[:upto], kept_f[:upto])
                kept_k, kept_f = kept_k[upto:], kept_f[upto:]
                if a and sum(map(len, a)):
                    a, b = np.concatenate(a), np.concatenate(b)
                    lists = [pa.ListArray.from_arrays(np.arange(0, x.size + 1, words, dtype=np.int32), pa.array(np.ascontiguousarray(x).ravel().view(np.int64))) for x in (a, b)]
                    yield pa.RecordBatch.from_arrays(lists, names=["a", "b"])

    return run


def links(classes: DataFrame, words: int = 1, limit: int = 4, block_limit: int = 2, hot: int = 50_000) -> DataFrame:
    """Links (a, b) between the different fingerprints ``fp`` of classes that differ in at most ``limit`` bits.

    Complete if limit <= (block_limit + 1) * 2 * words - 1; the links form a spanning forest per anchor. Beyond, a pair is
    found if any of its 2 * words blocks differs in at most block_limit bits (or happens to share an anchor).
    """
    near = flip_table(1 + (block_limit + 1) // 2)
    wide = flip_table(1 + (limit + 1) // 2)  # the other block may differ in all of the bits
    cols = [f"w{i}" for i in range(words)]
    kinds = "k0 bigint, k1 bigint, " + ", ".join(f"{c} bigint" for c in cols)

    def blocks(fps: np.ndarray) -> list[np.ndarray]:
        return [x for w in range(words) for x in (fps[:, w] & _U(0xFFFFFFFF), fps[:, w] >> _U(32))]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.asarray(batch.column("fp").flatten()).view(np.uint64).reshape(-1, words)
            for k, x in enumerate(blocks(fps)):
                for s in range(0, len(x), 1 << 14):
                    rows, anchor = anchors(x[s : s + (1 << 14)], near)
                    key = (anchor | _U(k << 32)).view(np.int64)
                    got = fps[s + rows]
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.zeros(len(key), np.int64))] + [pa.array(np.ascontiguousarray(got[:, w]).view(np.int64)) for w in range(words)], names=["k0", "k1", *cols])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.stack([np.asarray(batch.column(c)).view(np.uint64) for c in cols], axis=1)
            k0 = np.asarray(batch.column("k0"))
            other = blocks(fps)
            which = (k0 >> 32) ^ 1
            x = np.choose(which, other) if len(other) <= 32 else np.array([other[w][i] for i, w in enumerate(which)])
            for s in range(0, len(x), 1 << 12):
                rows, anchor = anchors(x[s : s + (1 << 12)], wide)
                got = fps[s + rows]
                yield pa.RecordBatch.from_arrays([pa.array(k0[s + rows]), pa.array((anchor | _U(1 << 40)).view(np.int64))] + [pa.array(np.ascontiguousarray(got[:, w]).view(np.int64)) for w in range(words)], names=["k0", "k1", *cols])

    # only the anchors with several classes are worth dealing
    dealt = classes.select("fp").mapInArrow(deal, kinds)
    size = dealt.groupBy("k0").agg(F.count(F.lit(1)).alias("size"))
    many = written(size.where(F.col("size") > hot).select("k0"), "hot")
    if not many.isEmpty():
        few = dealt.join(many, "k0", "left_anti").select(*dealt.columns)
        split = dealt.join(many, "k0", "left_semi").select(*dealt.columns).mapInArrow(again, kinds)
        dealt = few.unionByName(split)
    met = dealt.repartition("k0", "k1").sortWithinPartitions("k0", "k1")
    return met.mapInArrow(_linker(words, limit), "a array<bigint>, b array<bigint>")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the least node of the component. Any orderable node type."""

    def larger(e: DataFrame) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()

    def smaller(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(least, "u").where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()

    now = written(smaller(edges.select("a", "b")), "stars")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen, before = mark, now
        now = written(smaller(larger(now)), "stars")
        discard(before)


def size_classes(least: float, top: int = 1 << 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(largest set of each class, most differing shingles of a pair of the class or the one below, segments).

    Sets with a Jaccard similarity of ``least`` lie in one class or in neighbouring ones, and differ in at most
    (1 - least) / (1 + least) of their sizes' sum.
    """
    sizes = [1]
    while sizes[-1] < top:
        sizes.append(max(sizes[-1] + 1, int(sizes[-1] / least + 1e-9)))
    sizes = np.array(sizes, np.int64)
    differ = (2 * sizes * ((1 - least) / (1 + least)) + 1e-9).astype(np.int64)
    return sizes, differ, differ + differ // 8 + 4


def segment_keys(sets: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) such that two sets of Jaccard similarity ``least`` or more share a key.

    The hash space is cut into more segments than a pair can have differing shingles, so some segments hold the same
    shingles in both; a key is a segment with its shingles. Each set is cut for its own class and for the next larger.
    Equal segments may all be empty only where both sets have as many empty ones as there are segments to spare; such
    sets also get the shingles of their prefix in hash order as keys.
    """
    top, differ, segments = size_classes(least)
    sizes = np.array([len(x) for x in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, _U)
    own = np.repeat(np.arange(len(sets)), sizes)
    place, value = mix64(flat ^ _U(0x5851F42D4C957F2D)), mix64(flat * _U(0x9E3779B97F4A7C15))
    rows, keys, poor = [], [], np.zeros(len(sets), bool)
    for up in (0, 1):
        kind = np.searchsorted(top, sizes) + up
        m = np.where(sizes > 0, segments[kind], 0)
        first = np.cumsum(m) - m
        at = first[own] + (place % m[own].astype(_U)).astype(np.int64)
        held = np.bincount(at, minlength=int(m.sum()))
        total = np.zeros(len(held), _U)
        np.add.at(total, at, value)
        row = np.repeat(np.arange(len(sets)), m)
        name = (kind[row] << 40 | (np.arange(len(held)) - first[row])).astype(_U)
        full = held > 0
        rows.append(row[full])
        keys.append(mix64(total[full] + mix64(name[full] + _U(1))))
        poor |= np.bincount(row[~full], minlength=len(sets)) >= m - differ[kind]
    for r in np.flatnonzero(poor & (sizes > 0)).tolist():
        prefix = np.sort(place[own == r])[: sizes[r] - int(np.ceil(least * sizes[r] - 1e-9)) + 1]
        rows.append(np.full(len(prefix), r))
        keys.append(mix64(prefix ^ _U(0xD1342543DE82EF95)))
    # 48 bits: sets that share a key by chance are told apart by the check
    return np.concatenate(rows), np.concatenate(keys) >> _U(16)


def parity(shingles: np.ndarray) -> bytes:
    """At least two bits a shingle, each flipped by the shingles that fall on it: sets differ in at least as many shingles as their bits.

    Their number is a power of two; half as many are the two halves, one flipped by the other.
    """
    width = max(256, 1 << int(2 * max(len(shingles), 1) - 1).bit_length())
    bits = np.bincount((mix64(shingles ^ _U(0x2545F4914F6CDD1D)) & _U(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Parity bits, as 64-bit words, in the number that a smaller set has."""
    while len(bits) > words:
        half = len(bits) // 2
        bits = bits[:half] ^ bits[half:]
    return bits


def set_name(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def _sets_of(batch: pa.RecordBatch, width: int) -> list[np.ndarray]:
    return [np.unique(shingle_hashes(x.as_py(), width)) for x in batch.column("_body")]


def set_names(docs: DataFrame, width: int) -> DataFrame:
    """(_id, c, n, bits, fp) of docs (_id, _body): c names the set of different shingles, by 64 bits as the shingles themselves;
    n is their number, bits their parity bits, fp their fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                sets = _sets_of(part, width)
                cols = [part.column("_id"), pa.array([set_name(x) for x in sets], pa.int64()), pa.array([len(x) for x in sets], pa.int32()), pa.array([parity(x) for x in sets], pa.binary()), pa.array(np.array([vote(x) for x in sets], _U).view(np.int64))]
                yield pa.RecordBatch.from_arrays(cols, names=["_id", "c", "n", "bits", "fp"])

    return docs.mapInArrow(run, f"_id {docs.schema['_id'].dataType.simpleString()}, c bigint, n int, bits binary, fp bigint")


def dealt_sets(docs: DataFrame, width: int, least: float) -> DataFrame:
    """(key, c, n) of the different sets of docs; a task deals a set once, however many copies it reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        seen: set[int] = set()
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                named = {set_name(x): x for x in _sets_of(batch.slice(a, 256), width) if len(x)}
                new = {c: x for c, x in named.items() if c not in seen}
                seen.update(new)
                if new:
                    sets = list(new.values())
                    row, key = segment_keys(sets, least)
                    sizes = np.array([len(x) for x in sets], np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.array(list(new), np.int64)[row]), pa.array(sizes[row])], names=["key", "c", "n"])

    return docs.select("_body").mapInArrow(run, "key bigint, c bigint, n int")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """(columns, edges of the runs of equal keys) of batches sorted by key, c; a run is never divided, equal rows come once."""
    held: list[dict[str, np.ndarray]] = []

    def whole(parts: list[dict[str, np.ndarray]]) -> tuple[dict[str, np.ndarray], np.ndarray]:
        cols = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
        new = np.r_[True, (cols["key"][1:] != cols["key"][:-1]) | (cols["c"][1:] != cols["c"][:-1])]
        cols = {k: v[new] for k, v in cols.items()}
        return cols, np.flatnonzero(np.r_[True, cols["key"][1:] != cols["key"][:-1], True])

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = {k: np.asarray(batch.column(k)) if k != "bits" else np.array(batch.column(k).to_pylist(), object) for k in batch.schema.names}
        cut = int(np.searchsorted(cols["key"], cols["key"][-1]))  # the last run may go on in the next batch
        if held and (cut or held[-1]["key"][-1] != cols["key"][0]):
            yield whole([*held, {k: v[:cut] for k, v in cols.items()}])
            held = []
        elif cut:
            yield whole([{k: v[:cut] for k, v in cols.items()}])
        held.append({k: v[cut:] for k, v in cols.items()})
    if held:
        yield whole(held)


def _proposer(least: float, hot: int):
    """mapInArrow function over (key, c, n) by key, c: all pairs (a, b) of a key's sets up to ``hot``.

    Of a larger key the pairs with its first and last set, and its rows (a = key, b = c, big).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for cols, edge in _runs(batches):
            c, n, size = cols["c"], cols["n"], np.diff(edge)
            a, b = [], []
            for k in range(1, min(int(size.max(initial=0)), hot)):
                run_size = np.repeat(np.where(size <= hot, size, 0), size)
                at = np.flatnonzero(np.arange(len(c)) - np.repeat(edge[:-1], size) + k < run_size)
                a.append(at)
                b.append(at + k)
            large = np.repeat(size > hot, size)
            for end in (edge[:-1], edge[1:] - 1):
                pivot = np.repeat(end, size)
                at = np.flatnonzero(large & (pivot != np.arange(len(c))))
                a.append(pivot[at])
                b.append(at)
            a, b = np.concatenate(a), np.concatenate(b)
            fit = np.minimum(n[a], n[b]) >= least * np.maximum(n[a], n[b]) - 1e-9
            one, two = c[a[fit]], c[b[fit]]
            big = np.flatnonzero(large)
            out = np.r_[np.minimum(one, two), cols["key"][big]], np.r_[np.maximum(one, two), c[big]]
            if len(out[0]):
                yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1]), pa.array(np.arange(len(out[0])) >= len(one))], names=["a", "b", "big"])

    return run


def _between(least: float, few: bool):
    """mapInArrow function over (key, c, root, n, bits) by key, c: every pair of different roots that can be similar.

    The parity bits of a pair differ in no more bits than the sets in shingles, so no similar pair is left out. With ``few``
    only as many pairs of a key as would make its roots one if all of them were similar.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for cols, edge in _runs(batches):
            a, b = [], []
            for s, e in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                order = s + np.argsort(cols["root"][s:e], kind="stable")
                n, root, c = cols["n"][order].astype(np.int64), cols["root"][order], cols["c"][order]
                own = [np.frombuffer(x, _U) for x in cols["bits"][order]]
                words = min(map(len, own))  # a key's sets are of about one size
                own = np.stack([folded(x, words) for x in own])
                later = np.searchsorted(root, root, side="right")
                joined = root.copy()
                for i in range(len(n)):
                    j = int(later[i])
                    if j == len(n):
                        break
                    near = np.bitwise_count(own[j:] ^ own[i]).sum(axis=1) <= (n[j:] + n[i]) * ((1 - least) / (1 + least)) + 1e-9
                    near &= np.minimum(n[j:], n[i]) >= least * np.maximum(n[j:], n[i]) - 1e-9
                    got = j + np.flatnonzero(near & (joined[j:] != joined[i]) if few else near)
                    if few and len(got):
                        met, at = np.unique(joined[got], return_index=True)
                        got = got[at]
                        joined[np.isin(joined, met)] = joined[i]
                    if len(got):
                        a.append(np.minimum(c[i], c[got]))
                        b.append(np.maximum(c[i], c[got]))
            if a:
                pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    return run


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """(c, shingles) of docs (c, _body): 32 bits of each different shingle's hash, sorted, as bytes.

    Two sets of n shingles have n * n / 2^32 of them alike by chance: none in a page, a few thousandths of a per cent in a book.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                found = [(c, x) for c, x in zip(part.column("c").to_pylist(), _sets_of(part, width), strict=True) if set_name(x) == c]  # rows of an equal id may have other texts
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int64()), pa.array([np.unique(x.astype(np.uint32)).tobytes() for _, x in found], pa.binary())], names=["c", "shingles"])

    return docs.select("c", "_body").mapInArrow(run, "c bigint, shingles binary")


def possible(edges: DataFrame, kinds: DataFrame, least: float) -> DataFrame:
    """The edges (a, b) that the parity bits allow to be similar: no similar one is left out, and sets needn't be moved for the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            good = []
            for m, n, x, y in zip(batch.column("a_n").to_pylist(), batch.column("b_n").to_pylist(), batch.column("a_bits").to_pylist(), batch.column("b_bits").to_pylist(), strict=True):
                x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
                words = min(len(x), len(y))
                good.append(int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum()) <= (m + n) * ((1 - least) / (1 + least)) + 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    ends = [kinds.select(F.col("c").alias(e), *[F.col(x).alias(f"{e}_{x}") for x in ("n", "bits")]) for e in ("a", "b")]
    return edges.join(ends[0], "a").join(ends[1], "b").mapInArrow(run, "a bigint, b bigint")


def similar(edges: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The edges (a, b) whose shingle sets, of sets (c, shingles), have a Jaccard similarity of ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            good = []
            for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint32), np.frombuffer(y.as_py(), np.uint32)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both >= least * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    one = edges.join(sets.select(F.col("c").alias("a"), F.col("shingles").alias("sa")), "a")
    two = one.join(sets.select(F.col("c").alias("b"), F.col("shingles").alias("sb")), "b")
    return two.select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def _tree(edges: DataFrame) -> DataFrame:
    """(c, root) of every set in edges."""
    roots = components(edges)
    return roots.select(F.col("node").alias("c"), "root").unionByName(roots.select(F.col("root").alias("c"), "root").distinct())


def _ends(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("c")).unionByName(edges.select(F.col("b").alias("c"))).distinct()


def anchored(kinds: DataFrame, limit: int = 4) -> DataFrame:
    """Pairs (a, b), a < b, of the sets kinds (c, n, fp): those of one fingerprint with the least of them, and the least ones of
    fingerprints that differ in at most ``limit`` bits, by the links that anchors find."""
    sets = kinds.where("n > 0").select("fp", "c")
    heads = written(sets.groupBy("fp").agg(F.min("c").alias("head")), "heads")
    alike = sets.join(heads, "fp").where("c != head").select(F.col("head").alias("a"), F.col("c").alias("b"))
    met = written(links(heads.select(F.array("fp").alias("fp")), 1, limit, limit // 2).select(F.col("a")[0].alias("x"), F.col("b")[0].alias("y")).distinct(), "anchors")
    ends = [heads.select(F.col("fp").alias(e), F.col("head").alias(f"{e}_head")) for e in ("x", "y")]
    across = met.join(ends[0], "x").join(ends[1], "y").select(F.least("x_head", "y_head").alias("a"), F.greatest("x_head", "y_head").alias("b"))
    return alike.unionByName(across).distinct()


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, least: float = 0.8, hot: int = 8) -> DataFrame:
    """(id, component_id): components of the links between texts whose sets of shingles have a Jaccard similarity of ``least``.

    Sets whose fingerprints meet at an anchor are compared first. Complete: every such pair shares a key (segment_keys). Keys of
    up to ``hot`` sets propose all their pairs; a larger key proposes two stars. What the parity bits rule out is dropped. Sets
    that anchors have not joined are compared exactly, first each with its least partner, then as many pairs of the larger keys
    as could join their sets; at last, among sets that are not yet in one component, all other pairs, those of the larger keys
    included.
    Wordless texts are linked to each other only. A null id is a document like any other, but names no component of ids: one without
    an id is null.
    """
    # rows are told apart by id and text, so that those without an id are compared as well; a key of the caller's tells them apart itself
    own = not isinstance(docs.schema[id_col].dataType, StructType)
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h")) if own else F.col(id_col)
    few = spread(docs.select(key.alias("_id"), F.col(text_col).alias("_body")))
    marked = written(set_names(few, width), "marked")
    kinds = written(marked.groupBy("c").agg(F.min("_id").alias("_id"), *[F.first(x).alias(x) for x in ("n", "bits", "fp")]), "kinds")
    met = dealt_sets(few, width, least).repartition("key").sortWithinPartitions("key", "c")
    met = written(met.mapInArrow(_proposer(least, hot), "a bigint, b bigint, big boolean"), "met")
    near = written(possible(met.where("not big").select("a", "b").distinct(), kinds, least), "near")
    big = met.where("big").select(F.col("a").alias("key"), F.col("b").alias("c"))

    def compared(edges: DataFrame) -> DataFrame:
        """The similar ones of edges; only the texts at their ends are gathered."""
        chosen = written(_ends(edges).join(kinds, "c").where("_id is not null").select("c", "_id"), "chosen")
        # texts that no edge names stay where they are: a filter of at most SIEVE bits drops nearly all of them before the shuffle
        size = max(64, min(SIEVE, -(-chosen.count() * 12 // 64) * 64))
        sieve = filter_words(chosen.select(F.col("_id").alias("key")), 0, size, 3)
        named = few.where(passes(F.col("_id"), sieve, 0, size, 3))
        sets = written(shingle_sets(named.join(chosen, "_id"), width).dropDuplicates(["c"]), "sets")
        out = written(similar(edges, sets, least), "links")
        discard(chosen, sieve, sets)
        return out

    def of_large_keys(tree: DataFrame, few_pairs: bool) -> DataFrame:
        """Pairs of sets of different trees that share a larger key."""
        rows = written(big.join(tree, "c", "left").withColumn("root", F.coalesce("root", "c")), "rows")
        # of keys that the same sets share one is enough
        alike = [F.count(F.lit(1)).alias("m"), F.sum(F.xxhash64("c").cast("decimal(38,0)")).alias("total"), F.bit_xor(F.xxhash64("c", F.lit(1))).alias("mixed")]
        split = rows.groupBy("key").agg(*alike, F.min("root").alias("_x"), F.max("root").alias("_y")).where("_x < _y")
        split = written(split.groupBy("m", "total", "mixed").agg(F.min("key").alias("key")).select("key"), "split")
        rows = rows.join(split, "key", "left_semi").join(kinds.drop("_id", "fp"), "c")
        rows = rows.select("key", "c", "root", "n", "bits").repartition("key").sortWithinPartitions("key", "c")
        return rows.mapInArrow(_between(least, few_pairs), "a bigint, b bigint").distinct()

    def apart(edges: DataFrame, tree: DataFrame) -> DataFrame:
        """The edges between different trees."""
        ends = [tree.select(F.col("c").alias(e), F.col("root").alias(f"{e}_root")) for e in ("a", "b")]
        return edges.join(ends[0], "a", "left").join(ends[1], "b", "left").where("coalesce(a_root, a) != coalesce(b_root, b)").select("a", "b")

    done = written(possible(anchored(kinds), kinds, least), "anchored")
    edges = compared(done)
    tree = written(_tree(edges), "tree")
    left = apart(near, tree)
    partner = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.min("b").alias("b"))
    first = partner.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    first = written(first.join(done, ["a", "b"], "left_anti"), "first")
    if not first.isEmpty():
        done, edges = done.unionByName(first), edges.unionByName(compared(first))
        tree = written(_tree(edges), "tree")
    hot_keys = not big.isEmpty()
    if hot_keys:
        more = written(of_large_keys(tree, True).join(done, ["a", "b"], "left_anti"), "more")
        if not more.isEmpty():
            done, edges = done.unionByName(more), edges.unionByName(compared(more))
            tree = written(_tree(edges), "tree")
    rest = apart(near, tree)
    if hot_keys:
        rest = rest.unionByName(of_large_keys(tree, False)).distinct()
    rest = written(rest.join(done, ["a", "b"], "left_anti"), "rest")
    discard(met, near)
    if not rest.isEmpty():
        tree = written(_tree(edges.unionByName(compared(rest))), "tree")
    placed = marked.select("_id", "c").join(tree, "c", "left").withColumn("root", F.coalesce("root", "c"))
    named = F.col("_id.id") if own else F.col("_id")
    least_id = placed.groupBy("root").agg(F.min(named).alias("component_id"))
    return placed.join(least_id, "root").select(named.alias(id_col), "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, limit: int = 4, hot: int = 50_000) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id (least id reachable by links of at most ``limit`` bits)."""
    few = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_body"))
    marked = written(fingerprints(few, ["_id"], "_body", width).select("_id", F.col("fp")[0].alias("fp")), "fingerprints")
    classes = written(marked.groupBy("fp").agg(F.min("_id").alias("first_id")), "classes")
    found = links(classes.select(F.array("fp").alias("fp")), 1, limit, limit // 2, hot)
    edges = written(found.select(F.col("a")[0].alias("a"), F.col("b")[0].alias("b")).distinct(), "links")
    roots = components(edges)
    tree = roots.select(F.col("node").alias("fp"), "root").unionByName(roots.select(F.col("root").alias("fp"), "root").distinct())
    placed = classes.join(tree, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = written(placed.join(least, "root").select("fp", "component_id"), "named")
    return marked.join(named, "fp").select(F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
