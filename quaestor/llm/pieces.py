"""SentencePiece encoding and decoding with a distinct-chunk table (operator 2).

White space is a marker character. If no piece of the vocabulary holds a marker after another character (checked when the
model is loaded), no merge crosses the start of a run of markers, so a text is a sequence of chunks, each a run of markers
and the characters up to the next run, that the library segments independently of each other. A task splits its texts into
chunks, has the library segment each chunk that its table lacks, once, and joins ids and decoded text back by position.

The table is each task's own: joining one table for the corpus would shuffle a row for every different chunk of every
batch, or the texts themselves, to save what is a few per cent of lookups. It is bounded: beyond ``most`` chunks it makes
way for a new one, to which the chunks that are met again move. A lost task is repeated from its input alone; there is no shuffle at all.

Defined results: null text is empty; an empty text has the begin and end ids only and decodes to the empty string.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, spread

MARK = "\u2581"
_RUNS = re.compile(r" *[^ ]+| +")


class ChunkTable:
    """chunk (without its first marker, markers as spaces) -> (number of ids, ids as little-endian uint32, decoded bytes)."""

    def __init__(self, model: str, most: int = 60_000, longest: int = 256):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.lib.id_to_piece(i) for i in range(self.lib.get_piece_size())]
        self.independent = not any(MARK in p.lstrip(MARK) for p in pieces) and self.lib.encode("a") == self.lib.encode("a", add_bos=False, add_eos=False)
        if not self.independent:
            raise ValueError("a piece crosses white space; chunks of this model depend on each other")
        self.lone = self.lib.piece_to_id(MARK)
        self.begin = np.array([self.lib.bos_id()], "<u4").tobytes()
        self.end = np.array([self.lib.eos_id()], "<u4").tobytes()
        self.most, self.longest = most, longest
        self.table: dict[str, tuple[int, bytes, bytes]] = {}
        self.older: dict[str, tuple[int, bytes, bytes]] = {}

    def _segmented(self, chunks: list[str]) -> list[tuple[int, bytes, bytes]]:
        ids = self.lib.encode(chunks, num_threads=1)
        ids = [x if c else [self.lone] for c, x in zip(chunks, ids, strict=True)]
        texts = self.lib.decode(ids, num_threads=1)
        return [(len(x), np.array(x, "<u4").tobytes(), t.encode()) for x, t in zip(ids, texts, strict=True)]

    @staticmethod
    def chunks(text: str) -> list[str]:
        text = text.replace(MARK, " ")
        parts = text.split(" ")
        if "" in parts:
            parts = [c[1:] for c in _RUNS.findall(" " + text)]
        return parts

    def look_up(self, texts: list[str]) -> list[list[tuple[int, bytes, bytes]]]:
        """The rows of each text's chunks, in order."""
        if len(self.table) > self.most:
            self.older, self.table = self.table, {}
        split = [self.chunks(t) if t else [] for t in texts]
        table, older = self.table, self.older
        new = list({c for own in split for c in own if c not in table})
        if older:
            table.update((c, older[c]) for c in new if c in older)
            new = [c for c in new if c not in older]
        fresh = dict(zip(new, self._segmented(new), strict=True)) if new else {}
        table.update((c, r) for c, r in fresh.items() if len(c) <= self.longest)
        long = {c: r for c, r in fresh.items() if len(c) > self.longest}
        if long:
            return [[table[c] if c in table else long[c] for c in own] for own in split]
        return [[table[c] for c in own] for own in split]

    def encode(self, text: str) -> np.ndarray:
        rows = self.look_up([text])[0]
        return np.frombuffer(self.begin + b"".join(r[1] for r in rows) + self.end, dtype="<u4")


def _slices(texts: pa.Array, most: int = 1 << 20) -> Iterator[list[str]]:
    held, size = [], 0
    for x in texts:
        t = x.as_py() or ""
        held.append(t)
        size += len(t)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode_decode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", outputs: bool = True) -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256, and with ``outputs`` ids and decoded."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        table = ChunkTable(model)
        for batch in batches:
            at = 0
            for texts in _slices(batch.column("_text")):
                counts, shas, decoded_shas, ids, decoded = [], [], [], [], []
                for rows in table.look_up(texts):
                    raw = table.begin + b"".join([r[1] for r in rows]) + table.end
                    text = b" ".join([r[2] for r in rows])
                    counts.append(len(raw) // 4)
                    shas.append(hashlib.sha256(raw).hexdigest())
                    decoded_shas.append(hashlib.sha256(text).hexdigest())
                    if outputs:
                        ids.append(np.frombuffer(raw, "<u4").astype(np.int32))
                        decoded.append(text.decode())
                cols = [batch.column("_id").slice(at, len(texts)), pa.array(counts, pa.int64()), pa.array(shas), pa.array(decoded_shas)]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if outputs:
                    flat = np.concatenate(ids)
                    cols += [pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), pa.array(flat)), pa.array(decoded, pa.string())]
                    names += ["ids", "decoded"]
                at += len(texts)
                yield pa.RecordBatch.from_arrays(cols, names=names)

    few = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    more = ", ids array<int>, decoded string" if outputs else ""
    out = spread(few).mapInArrow(run, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{more}")
    return out.withColumnRenamed("id", id_col)
