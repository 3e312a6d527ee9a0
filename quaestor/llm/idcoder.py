"""Token-id files: an adaptive context-mixing range coder in reset, checksummed blocks (operator 5).

Model. Each id is coded under a mixture of three predictions: the id that last followed the two ids before it (order 2),
the id that last followed the one before (order 1), and the frequencies of ids (order 0). The shares of order 2 and order 1
adapt to what has hit, per block and by which predictions agree; order 0 is the frame's frequency table, in its header.
A range coder (48-bit window, 24-bit digits, carries resolved at the end) codes which prediction holds, and where none
does the id under order 0.

Blocks of BLOCK ids reset every adaptive state and carry CRC-32 sums of their bytes and their ids, so each decodes by
itself. A frame is some whole documents with its table, document list and blocks. numpy codes all blocks of a frame
side by side, one id of each block a step; the work per id is a few dozen vector operations.

Files. Documents are sorted by id over range partitions; a task writes one file of frames in the shared folder, its name
holding the attempt, and reports its frames. Readers are dealt frames, not files. Tokenising uses a bounded table of
the parts of white-space separated words per Python worker: this tokenizer's splits never cross white space; texts with characters for which the
library's lower-casing, composition or special tokens could act otherwise go to the library whole.

Defined results: null text is empty; every document ends with ``end_id``; equal or null ids keep an unspecified order among
themselves; an id of 2^16 or more is refused.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import work_path, written
from .warc import _opened

BLOCK = 4096
FRAME = 1 << 23
LOT = 12 << 20  # bytes of texts that are cut to words at once
SLOTS = 8  # bits of a context table; small tables stay in the processor's caches
TOTAL0 = 18  # bits of order-0 frequencies
MAGIC = b"IDCM0001"
#: Characters, and a sign of special tokens, for which a text goes to the library whole.
_SAFE = "[^\t\n\r\x0b\x0c -~¡-¬®-±´-¸º»¿-įı-ɏ]|<\\|"
#: The tokenizer's split, for the characters that _SAFE lets through, and the ends of words in a list of them.
_PARTS = re.compile(r"[^\W\d_]+|\d|'s|'t|'re|'ve|'m|'ll|'d|(?:[^\w\s]|_)+|\n")
_LOW = (1 << 24) - 1
_EDGE = 1 << 24


class WordIds:
    """Ids of texts, as little-endian uint16, by a table of the parts of words.

    The library splits a word into runs of letters, single digits and runs of other signs, and codes each by itself with a
    token that ends a word last. Arrow cuts a batch of texts to words and finds the different ones; these are cut to parts, and parts
    that are not in the table go to the library in one line; the ending tokens tell them apart.
    """

    def __init__(self, path: str, most: int = 400_000):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        size = self.lib.get_vocab_size()
        if size > 1 << 16:
            raise ValueError("ids beyond 16 bits")
        self.ends = np.array([(self.lib.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # parts of the generation before; what is used again moves on
        self.most = most

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, "<u2")

    def _learn(self, new: list[str]) -> None:
        older = self.older
        self.parts.update((p, older[p]) for p in new if p in older)
        parts = [p for p in new if p not in older]
        for a in range(0, len(parts), 2000):
            some = parts[a : a + 2000]
            ids = self._ids(" ".join(some))
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) != len(some):
                raise ValueError("a part of a word without its ending token")
            raw = ids.tobytes()
            self.parts.update((p, raw[2 * s : 2 * e]) for p, s, e in zip(some, [0, *cut[:-1].tolist()], cut.tolist(), strict=True))

    def _of_words(self, words: pa.Array) -> pa.Array:
        """Ids of each of some different words."""
        cut = pa.array(_PARTS.findall("\n".join(_strings(words)) + "\n"), pa.large_string()).dictionary_encode()
        kinds = _strings(cut.dictionary)
        if len(self.parts) > self.most:
            self.older, self.parts = self.parts, {}
        known = self.parts
        new = [p for p in kinds if p not in known and p != "\n"]
        if new:
            self._learn(new)
        ids = pa.array([b"" if p == "\n" else known[p] for p in kinds], pa.large_binary()).take(cut.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[1 + np.flatnonzero(np.asarray(cut.indices) == kinds.index("\n"))]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(np.r_[0, ends]), ids.buffers()[2]])

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Ids of each text."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        whole = pc.match_substring_regex(texts, _SAFE)
        cut = pc.ascii_split_whitespace(pc.utf8_lower(pc.if_else(whole, "", texts)).cast(pa.large_string()))
        words = cut.values.dictionary_encode()
        if not len(words):
            raw, ends = b"", np.zeros(len(texts) + 1, np.int64)
        else:
            ids = self._of_words(words.dictionary).take(words.indices)
            raw, ends = memoryview(ids.buffers()[2]), np.frombuffer(ids.buffers()[1], np.int64)[np.asarray(cut.offsets)]
        out = [bytes(raw[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        for i in np.flatnonzero(np.asarray(whole)).tolist():
            out[i] = self._ids(texts[i].as_py()).tobytes()
        return out


def _strings(words: pa.Array) -> list[str]:
    """Words without white space as a list; faster than to_pylist."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.string())), "\0")[0].as_py().split("\0") if len(words) else []


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together to about LOT bytes, which have fewer different words than each by itself."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= LOT:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


_TABLES: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The table of this Python worker, which its later tasks go on using."""
    if path not in _TABLES:
        _TABLES[path] = WordIds(path)
    return _TABLES[path]


def frequency_table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids present, frequencies of at least 1 that sum to 2^TOTAL0)."""
    count = np.bincount(ids, minlength=1)
    present = np.flatnonzero(count)
    room = (1 << TOTAL0) - len(present)
    freq = 1 + (count[present] * room // max(1, len(ids)))
    freq[np.argmax(freq)] += (1 << TOTAL0) - freq.sum()
    return present, freq


class _Model:
    """Adaptive state of many blocks side by side; 64-bit integers throughout, so that nothing is converted a step."""

    def __init__(self, lanes: int):
        self.one = np.zeros(lanes << SLOTS, np.uint16)  # id + 1 that last followed, 0 for none; ids reach 65534
        self.two = np.zeros(lanes << SLOTS, np.uint16)
        self.hit = np.full(lanes << 4, 1 << 14, np.int64)
        self.second = np.full(lanes, 1 << 13, np.int64)
        self.base = np.arange(lanes, dtype=np.int64) << SLOTS
        self.base4 = np.arange(lanes, dtype=np.int64) << 4
        self.before = np.zeros(lanes, np.int64)
        self.last = np.zeros(lanes, np.int64)
        self.was = np.zeros(lanes, np.int64)

    def predict(self, n: int):
        """For the first n lanes: first choice, second choice (0: none) and their shares of 2^16.

        Shares move a sixteenth of the way to a bound within (0, 2^16) each time, so each of the three stays above 0.
        """
        mask = (1 << SLOTS) - 1
        mixed = self.last[:n] * 40503
        self.at1 = self.base[:n] + (mixed >> 3 & mask)
        self.at2 = self.base[:n] + ((mixed >> 2 ^ self.before[:n] * 30011 >> 4) & mask)
        p1, p2 = self.one[self.at1].astype(np.int64), self.two[self.at2].astype(np.int64)
        has2, same = p2 > 0, p1 == p2
        first = np.where(has2, p2, p1)
        second = p1 * (has2 & ~same)
        self.at3 = self.base4[:n] + self.was[:n] + has2 + ((p1 > 0) * 2 + same * 4)
        f1 = self.hit[self.at3]
        f2 = (second > 0) * (1 + ((65536 - f1) * self.second[:n] >> 16))
        self.share = f1
        return first, second, f1, f2

    def update(self, n: int, value: np.ndarray, hit1: np.ndarray, hit2: np.ndarray, second: np.ndarray) -> None:
        """value: id + 1."""
        self.hit[self.at3] = self.share + (hit1 * 64952 + 48 - self.share >> 4)
        old = self.second[:n]
        old += ((second > 0) & ~hit1) * (hit2 * 59952 + 48 - old >> 4)
        self.one[self.at1] = value
        self.two[self.at2] = value
        self.was[:n] = hit1 * 8
        self.before[:n] = self.last[:n]
        self.last[:n] = value


def encode_blocks(ids: np.ndarray, freq_of: np.ndarray, cum_of: np.ndarray) -> list[bytes]:
    """Bytes of each block of BLOCK ids; the last one may be short."""
    lanes = -(-len(ids) // BLOCK)
    if not lanes:
        return []
    grid = np.zeros((lanes, BLOCK), np.int32)
    grid.ravel()[: len(ids)] = ids + 1
    grid = np.ascontiguousarray(grid.T)
    tail = len(ids) - (lanes - 1) * BLOCK
    model = _Model(lanes)
    low, rng = np.zeros(lanes, np.int64), np.full(lanes, (1 << 48) - 1, np.int64)
    out = np.zeros((lanes, BLOCK * 3 // 2 + 8), np.uint32)
    flat, width = out.ravel(), out.shape[1]
    put = np.arange(lanes, dtype=np.int64) * width

    def shift(low, rng, which):
        """Emit a digit where the range has become narrow; which: the lanes' numbers, or None for the first ones."""
        at = np.flatnonzero(rng < _EDGE)
        if len(at):
            lane = at if which is None else which[at]
            flat[put[lane]] = low[at] >> 24
            put[lane] += 1
            low[at] = (low[at] & _LOW) << 24
            rng[at] <<= 24

    for step in range(BLOCK):
        n = lanes if step < tail else lanes - 1
        if not n:
            break
        value = grid[step, :n].astype(np.int64)
        first, second, f1, f2 = model.predict(n)
        hit1 = first == value
        hit2 = (second == value) & ~hit1
        lo, rg = low[:n], rng[:n]
        miss = ~(hit1 | hit2)
        r = rg >> 16
        lo += r * (f1 * ~hit1 + f2 * miss)
        rg[:] = r * (f1 * hit1 + f2 * hit2 + (65536 - f1 - f2) * miss)
        shift(lo, rg, None)
        other = np.flatnonzero(miss)
        if len(other):
            v = value[other] - 1
            lo2, r = lo[other], rg[other] >> TOTAL0
            lo2 += r * cum_of[v]
            rg2 = r * freq_of[v]
            shift(lo2, rg2, other)
            lo[other], rg[other] = lo2, rg2
        model.update(n, value, hit1, hit2, second)
    for _ in range(2):
        flat[put] = low >> 24
        put += 1
        low = (low & _LOW) << 24
    used = put - np.arange(lanes) * width
    carry = np.zeros(lanes, np.uint32)
    for k in range(int(used.max()) - 1, -1, -1):
        d = out[:, k] + np.where(k < used, carry, 0).astype(np.uint32)
        carry = np.where(k < used, d >> 24, carry).astype(np.uint32)
        out[:, k] = d & 0xFFFFFF
    return [np.ascontiguousarray(out[i, : used[i], None] >> np.array([16, 8, 0], np.uint32)).astype(np.uint8).tobytes() for i in range(lanes)]


def decode_blocks(blocks: list[bytes], total: int, freq_of: np.ndarray, cum_of: np.ndarray, id_at: np.ndarray) -> np.ndarray:
    """The ids of the blocks, ``total`` together."""
    lanes = len(blocks)
    if not lanes:
        return np.zeros(0, np.int32)
    width = max(map(len, blocks)) // 3 + 4
    digits = np.zeros((lanes, width), np.int64)
    for i, b in enumerate(blocks):
        d = np.frombuffer(b, np.uint8).reshape(-1, 3).astype(np.int64)
        digits[i, : len(d)] = d[:, 0] << 16 | d[:, 1] << 8 | d[:, 2]
    flat = digits.ravel()
    take = np.arange(lanes, dtype=np.int64) * width
    x = flat[take] << 24 | flat[take + 1]
    take += 2
    rng = np.full(lanes, (1 << 48) - 1, np.int64)
    grid = np.zeros((BLOCK, lanes), np.int32)
    tail = total - (lanes - 1) * BLOCK
    model = _Model(lanes)

    def shift(x, rng, which):
        at = np.flatnonzero(rng < _EDGE)
        if len(at):
            lane = at if which is None else which[at]
            x[at] = x[at] << 24 | flat[take[lane]]
            take[lane] += 1
            rng[at] <<= 24

    for step in range(BLOCK):
        n = lanes if step < tail else lanes - 1
        if not n:
            break
        first, second, f1, f2 = model.predict(n)
        xs, rg = x[:n], rng[:n]
        r = rg >> 16
        v = (xs / r).astype(np.int64)  # a quotient under 2^17 of numbers under 2^48: its floor is exact in double precision
        hit1 = v < f1
        miss = v >= f1 + f2
        hit2 = ~(hit1 | miss)
        xs -= r * (f1 * ~hit1 + f2 * miss)
        rg[:] = r * (f1 * hit1 + f2 * hit2 + (65536 - f1 - f2) * miss)
        shift(xs, rg, None)
        value = np.where(hit1, first, second)
        other = np.flatnonzero(miss)
        if len(other):
            x2, r = xs[other], rg[other] >> TOTAL0
            q = np.minimum((x2 / r).astype(np.int64), (1 << TOTAL0) - 1)
            got = id_at[q]
            x2 -= r * cum_of[got]
            rg2 = r * freq_of[got]
            shift(x2, rg2, other)
            xs[other], rg[other] = x2, rg2
            value[other] = got + 1
        grid[step, :n] = value
        model.update(n, value, hit1, hit2, second)
    return (grid.T.ravel()[:total] - 1).astype(np.int32)


def _tables(present: np.ndarray, freq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = int(present.max(initial=0)) + 1
    freq_of, cum_of = np.zeros(size, np.int64), np.zeros(size, np.int64)
    freq_of[present] = freq
    cum_of[present] = np.cumsum(freq) - freq
    return freq_of, cum_of, np.repeat(present, freq)


def pack_frame(doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> bytes:
    """One frame: head lengths, frequency table, document list, block list, blocks."""
    if len(ids) and ids.max() >= (1 << 16) - 1:
        raise ValueError("ids beyond 16 bits")
    present, freq = frequency_table(ids) if len(ids) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    freq_of, cum_of, _ = _tables(present, freq)
    blocks = encode_blocks(ids, freq_of, cum_of)
    sums = [(len(b), zlib.crc32(b), zlib.crc32(ids[k * BLOCK : (k + 1) * BLOCK].astype("<u4").tobytes())) for k, b in enumerate(blocks)]
    known = np.array([i is not None for i in doc_ids], np.uint8)
    parts = [
        zlib.compress(present.astype("<u2").tobytes() + freq.astype("<u4").tobytes(), 6),
        zlib.compress(known.tobytes() + np.array([i or 0 for i in doc_ids], "<i8").tobytes() + np.array(sizes, "<u4").tobytes(), 6),
        np.array(sums, "<u4").tobytes(),
    ]
    head = MAGIC + struct.pack("<QIIIII", len(ids), len(present), len(doc_ids), *map(len, parts))
    return b"".join([head, struct.pack("<I", zlib.crc32(head + b"".join(parts))), *parts, *blocks])


def unpack_frame(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, sizes, ids); ValueError if a checksum fails."""
    head_size = len(MAGIC) + struct.calcsize("<QIIIII")
    head = data[:head_size]
    if not head.startswith(MAGIC):
        raise ValueError("not a frame")
    total, kinds, docs, a, b, c = struct.unpack_from("<QIIIII", head, len(MAGIC))
    (told,) = struct.unpack_from("<I", data, head_size)
    at = head_size + 4
    parts = data[at : at + a + b + c]
    if zlib.crc32(head + parts) != told:
        raise ValueError("a frame's head fails its checksum")
    raw = zlib.decompress(parts[:a])
    present, freq = np.frombuffer(raw[: 2 * kinds], "<u2").astype(np.int64), np.frombuffer(raw[2 * kinds :], "<u4").astype(np.int64)
    raw = zlib.decompress(parts[a : a + b])
    known, names, sizes = np.frombuffer(raw[:docs], np.uint8), np.frombuffer(raw[docs : 9 * docs], "<i8"), np.frombuffer(raw[9 * docs :], "<u4").astype(np.int64)
    sums = np.frombuffer(parts[a + b :], "<u4").reshape(-1, 3)
    blocks, at = [], at + a + b + c
    for size, crc, _ in sums.tolist():
        blocks.append(data[at : at + size])
        at += size
        if zlib.crc32(blocks[-1]) != crc:
            raise ValueError("a block fails its checksum")
    ids = decode_blocks(blocks, total, *_tables(present, freq))
    for k, (_, _, crc) in enumerate(sums.tolist()):
        if zlib.crc32(ids[k * BLOCK : (k + 1) * BLOCK].astype("<u4").tobytes()) != crc:
            raise ValueError("a block's ids fail their checksum")
    return [i if k else None for i, k in zip(names.tolist(), known.tolist(), strict=True)], sizes, ids


def write_ids(docs: DataFrame, path: str, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """Write the files; returns the manifest (part, frame, file, start, length, n_ids)."""
    folder = work_path(docs.sparkSession, "ids")
    few = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = few.repartitionByRange("id").sortWithinPartitions("id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, coder, rows = TaskContext.get(), None, []
        end = np.array([end_id], "<u2").tobytes()
        sink, at = None, 0
        names, sizes, held, size = [], [], [], 0

        def flush():
            nonlocal sink, at, names, sizes, held, size
            if sink is None:
                store, top = _opened(folder)
                store.create_dir(top, recursive=True)
                name = f"{task.partitionId():06d}-{task.taskAttemptId()}.ids"
                sink = (store.open_output_stream(f"{top}/{name}", compression=None), f"{folder}/{name}")
            frame = pack_frame(names, sizes, np.frombuffer(b"".join(held), "<u2").astype(np.int32))
            sink[0].write(frame)
            rows.append((task.partitionId(), len(rows), sink[1], at, len(frame), size))
            at += len(frame)
            names, sizes, held, size = [], [], [], 0

        for part in _lots(batches):
            coder = coder or word_ids(path)
            for name, raw in zip(part.column("id").to_pylist(), coder.encode(part.column("text")), strict=True):
                names.append(name)
                sizes.append(len(raw) // 2 + 1)
                held += [raw, end]
                size += sizes[-1]
                if size >= FRAME:
                    flush()
        if names:
            flush()
        if sink:
            sink[0].close()
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["part", "frame", "file", "start", "length", "n_ids"])

    return written(ordered.mapInArrow(run, "part int, frame int, file string, start bigint, length bigint, n_ids bigint"), "frames")


def read_ids(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """One row per document: id, start, n_tokens, ids_crc32, and with ``with_ids`` ids."""
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row per file
    own = F.sum("n_ids").over(Window.partitionBy("part").orderBy("frame")) - F.col("n_ids")
    placed = manifest.withColumn("inside", own).join(parts, "part").select("file", "start", "length", (F.col("inside") + F.col("before")).alias("first"))
    slots = manifest.sparkSession.sparkContext.defaultParallelism

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start, length, first in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "length", "first")), strict=True):
                store, place = _opened(file)
                with store.open_input_file(place) as f:
                    names, sizes, ids = unpack_frame(f.read_at(length, start))
                off = np.r_[0, np.cumsum(sizes)]
                raw = memoryview(ids.astype("<u4").tobytes())
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                cols = [pa.array(names, pa.int64()), pa.array(first + off[:-1]), pa.array(sizes), pa.array(sums, pa.int64())]
                out = ["id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(off.astype(np.int32), pa.array(ids)))
                    out.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=out)

    more = ", ids array<int>" if with_ids else ""
    return written(placed, "placed").repartition(slots * 4).mapInArrow(run, f"id bigint, start bigint, n_tokens bigint, ids_crc32 bigint{more}")


def roundtrip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1) -> DataFrame:
    """Write every text's ids, read the files back: id, start, n_tokens, ids_crc32."""
    return read_ids(write_ids(docs, path, id_col, text_col, end_id), with_ids=False).withColumnRenamed("id", id_col)
