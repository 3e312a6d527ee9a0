"""The written index: segments of postings, updated by row and committed by manifests.

A segment holds (term, field, band, row, tf, dl, head, positions, places), in runs sorted by term, so that a search reads the pages of its
terms: a place is the number of the sentence, with that of the paragraph in its upper half. Beside it lie its rows' lengths, a dictionary, and for each (term, band of rows) the largest tf and the
least dl, from which a search bounds what a band can score before it reads it. Terms of fewer rows than there are bands have no bounds of
their own: their postings are as short.

An update writes its rows as a new segment and the keys they replace as tombstones, which hide rows of older segments; every ``most`` segments
they are merged to one. What isn't updated isn't touched. Frequencies are counted on live postings, so an updated index ranks as one that was
built anew.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as T
from ..sources.files import bound_batches
from ..sources.snapshots import Manifests

#: Bytes of bodies that are cut to words and sorted by term at once, and postings that are handed over at once.
RUN, ROWS = 4 << 20, 50_000
#: Ids of a band, as a power of two.
BAND = 9
#: Bytes of files for each task.
PART = 128 << 20
#: What the first posting of a term, field and band tells of a run's: rows and, where these are more, words, largest tf, least length.
SUMS = ("df", "n", "most", "least")
#: Letters of a word's beginning that its deletion neighbours are made from, and most deletions.
HEAD, DELETIONS = 8, 2


def band(row: Column, kind: str) -> Column:
    """Number of a row's band: neighbours in a band where rows are integers."""
    return F.shiftright(row, BAND) if kind in ("tinyint", "smallint", "int", "bigint") else F.pmod(F.xxhash64(row), F.lit(1 << 16))


def paragraph(place: Column) -> Column:
    return F.shiftright(place, 32)


def near_forms(word: Column, deletions: int = DELETIONS) -> Column:
    """A word's first letters and what is left of them after up to ``deletions`` deletions.

    Words within an edit distance of k share a form of k deletions, whatever follows the first letters: an alignment leaves at most k
    letters of either beginning without a partner in the other.
    """
    def less(forms: Column) -> Column:
        shorter = F.flatten(F.transform(forms, lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))), lambda k: F.concat(F.substring(w, F.lit(1), k - 1), F.substring(w, k + 1, F.length(w))))))
        return F.array_distinct(F.concat(forms, shorter))

    forms = F.array(F.left(word, F.lit(HEAD)))
    for _ in range(deletions):
        forms = less(forms)
    return forms


def alike(words: DataFrame, dictionary: DataFrame, distance: str = "distance") -> DataFrame:
    """(word, term) for each word of (word, distance) and the terms within that edit distance, of 2 at most: an equi-join on forms, then a check."""
    asked = words.select("word", distance, F.explode(near_forms(F.col("word"))).alias("form"))
    known = dictionary.select("term", F.explode(near_forms(F.col("term"))).alias("form")) if "form" not in dictionary.columns else dictionary
    met = asked.join(known, "form").where(F.abs(F.length("word") - F.length("term")) <= F.col(distance)).select("word", distance, "term").distinct()
    return met.where(F.levenshtein("word", "term") <= F.col(distance)).select("word", "term")


def dealt(rows: DataFrame) -> DataFrame:
    """Rows dealt out where their files make fewer tasks than there are cores, or tasks of more than PART bytes; otherwise as they are."""
    spark = rows.sparkSession
    paths = [spark._jvm.org.apache.hadoop.fs.Path(f) for f in rows.inputFiles()]
    size = sum(p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getLen() for p in paths)
    wanted = max(spark.sparkContext.defaultParallelism, -(-size // PART))
    return rows.repartition(2 * wanted) if rows.rdd.getNumPartitions() < wanted else rows


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of batches whose bodies have about RUN bytes together; a longer body is a run of its own."""
    kept, held = [], 0
    for batch in batches:
        start = 0
        for i, n in enumerate(pc.binary_length(batch.column("body")).to_pylist()):
            if held and held + n > RUN:
                yield pa.concat_batches([*kept, batch.slice(start, i - start)])
                kept, start, held = [], i, 0
            held += n
        kept.append(batch.slice(start))
    if kept:
        yield pa.concat_batches(kept)


_MARKS: dict[str, frozenset[str]] = {}


def marks(spark: SparkSession) -> frozenset[str]:
    """Letters and digits that Python knows and the JVM's regular expressions, by an older Unicode, take for marks, as WORD does in queries."""
    if "marks" not in _MARKS:
        every = "".join(c for c in map(chr, range(128, 0x110000)) if c.isalnum())
        left = spark.range(1).select(F.regexp_replace(F.lit(every), r"[\p{L}\p{N}]", "").alias("left")).first().left
        _MARKS["marks"] = frozenset(left)
    return _MARKS["marks"]


def _tables(marks: frozenset[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each code point what it is folded to, and its kind: 1 of a word, 2 a line's end, 3 white space in a line, 4 a sentence's last sign."""
    if marks not in _KINDS:
        points = np.arange(0x110000, dtype=np.uint32)
        points[[ord(c) for c in T.ACCENTED]] = [ord(c) for c in T.PLAIN]
        kinds = np.array([c.isalnum() and c not in marks for c in map(chr, range(0x110000))], np.uint8)[points]
        for signs, kind in (("\n", 2), (" \t\x0b\f\r", 3), (".!?", 4)):
            kinds[[ord(c) for c in signs]] = kind
        _KINDS[marks] = points, kinds
    return _KINDS[marks]


_KINDS: dict[frozenset[str], tuple[np.ndarray, np.ndarray]] = {}


def _words(points: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Strings of code points, up to each end."""
    if points.max(initial=0) < 0x80:
        raw = points.astype(np.uint8)
    else:
        wide = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        ends = np.r_[0, np.cumsum(wide)][ends]
        raw = points.tobytes().decode("utf-32-le").encode()
    return pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(np.r_[0, ends].astype(np.int64)), pa.py_buffer(raw))


def _counted(batch: pa.RecordBatch, marks: frozenset[str]) -> pa.RecordBatch:
    """Postings of rows (row, band, field, body) by term, those of rows without a word last: each body's words, placed and cut to runs of equal
    ones. Bodies are in lower case already. Lines are paragraphs; a sentence ends with . ! or ? before white space, or its paragraph."""
    folded, kinds = _tables(marks)
    bodies = batch.column("body").to_pylist()
    points = np.frombuffer("".join([x + "\0" for x in bodies]).encode("utf-32-le"), np.uint32)  # a zero after each body parts it from the next
    first = np.cumsum([0, *[len(x) + 1 for x in bodies]])
    kind = kinds[points]
    inner = np.r_[False, kind == 1, False]
    starts, ends = np.flatnonzero(inner[1:-1] & ~inner[:-2]), np.flatnonzero(inner[1:-1] & ~inner[2:]) + 1
    lines, stops = np.flatnonzero(kind == 2), np.flatnonzero((kind[1:] == 3) & (kind[:-1] == 4)) + 1
    own = np.searchsorted(first, starts, "right") - 1
    # lines before a word in its body, and sentences that ended since its line or body began
    line = np.searchsorted(lines, starts)
    par = line - np.searchsorted(lines, first)[own]
    since = np.maximum(first[own], np.r_[0, lines][line])
    place = par << 32 | np.searchsorted(stops, starts) - np.searchsorted(stops, since)
    tokens = _words(folded[points[inner[1:-1]]], np.cumsum(ends - starts)).dictionary_encode()
    terms = tokens.dictionary.cast(pa.string())
    rank = np.empty(len(terms), np.int64)
    by = pc.array_sort_indices(terms)
    rank[np.asarray(by)] = np.arange(len(terms))
    terms, code = terms.take(by), rank[np.asarray(tokens.indices)]
    dl = np.bincount(own, minlength=len(bodies))
    pos = np.arange(len(own)) - np.repeat(np.cumsum(dl) - dl, dl)
    key = code * len(bodies) + own
    order = np.argsort(key, kind="stable")
    edge = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0, True]) if len(key) else np.zeros(1, np.int64)
    run, off = order[edge[:-1]], pa.array(edge, pa.int32())
    bare = np.flatnonzero(dl == 0)  # rows without a word
    of, none = np.r_[own[run], bare], len(bare)
    # the first posting of each (term, field, band) tells how many there are; where there are more, also their words, largest tf and least length
    tf, lengths = np.diff(edge), dl[own[run]]
    fields, bands = (np.asarray(pc.fill_null(batch.column(c).dictionary_encode().indices, -1), np.int64) for c in ("field", "band"))
    cells, cell = np.unique(fields * (len(bodies) + 1) + bands, return_inverse=True)
    group = code[run] * len(cells) + cell[own[run]]
    told = np.argsort(group, kind="stable")
    begin = np.flatnonzero(np.diff(group[told], prepend=-1))
    df = np.diff(np.r_[begin, len(told)])
    sums = [df, *[f.reduceat(v[told], begin) for f, v in ((np.add, tf), (np.maximum, tf), (np.minimum, lengths))]]

    def summed(values: np.ndarray, least: int) -> pa.Array:
        out, hidden = np.zeros(len(of), np.int64), np.ones(len(of), bool)
        at = told[begin[df >= least]]
        out[at], hidden[at] = values[df >= least], False
        return pa.array(out, mask=hidden)

    cols = [
        pa.concat_arrays([terms.take(pa.array(code[run])), pa.nulls(none, pa.string())]),
        *[batch.column(c).take(pa.array(of)) for c in ("field", "band", "row")],
        pa.array(np.r_[tf, np.zeros(none, np.int64)]),
        pa.array(dl[of]),
        pa.array(np.r_[pos[run] == 0, np.ones(none, bool)]),
        *[pa.concat_arrays([pa.ListArray.from_arrays(off, pa.array(v[order], kind)), pa.nulls(none, pa.list_(kind))]) for v, kind in ((pos, pa.int32()), (place, pa.int64()))],
        *[summed(v, 2 if k else 1) for k, v in enumerate(sums)],
    ]
    return pa.RecordBatch.from_arrays(cols, names=["term", "field", "band", "row", "tf", "dl", "head", "positions", "places", *SUMS])


def postings_of(rows: DataFrame, fields: list[str]) -> DataFrame:
    """Postings of (row, f_<field>...); those without a term tell rows without a word.

    A row's words are counted where it stands: nothing is grouped or shuffled to count them, so a task holds a run of rows, or one row
    that is longer, and rows of an equal key stay apart. ``head`` marks one posting of each row and field. Each run is sorted by term; SUMS
    are of a run's postings of a term, field and band, and stand beside the first of them.
    """
    kind = rows.schema["row"].dataType.simpleString()
    bodies = F.array(*[F.struct(F.lit(n).alias("field"), F.lower(F.coalesce(F.col(f"f_{n}"), F.lit(""))).alias("body")) for n in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _runs(batches):
            made = _counted(part, unknown)
            for a in range(0, made.num_rows, ROWS):
                yield made.slice(a, ROWS)

    unknown = marks(rows.sparkSession)
    bound_batches(rows.sparkSession)
    placed = band(F.col("row"), kind).alias("band")
    number = dict(rows.select(placed).dtypes)["band"]
    told = f"term string, field string, band {number}, row {kind}, tf bigint, dl bigint, head boolean, positions array<int>, places array<bigint>"
    bodied = rows.select("row", placed, F.explode(bodies).alias("f")).select("row", "band", "f.field", "f.body")
    return bodied.mapInArrow(run, ", ".join([told, *[f"{n} bigint" for n in SUMS]]))


class Segments:
    """An index in a folder."""

    def __init__(self, spark: SparkSession, path: str, most: int = 8):
        self.spark, self.files, self.most = spark, Manifests(spark, path), most
        self.version, self.held = self.files.read()

    # --- what is written -------------------------------------------------------------------------------------------------
    def put(self, docs: DataFrame, fields: dict[str, Column], id_col: str) -> int:
        """Index rows; those of a key that is there already replace it. Rows of an equal key within one call raise ValueError."""
        rows = docs.select(F.col(id_col).alias("row"), *[c.alias(f"f_{n}") for n, c in fields.items()])
        segments, tombs = self.held.get("segments", []), self.held.get("tombs", [])
        gen = self.version + 1
        top = self._segment(rows, list(fields), gen)
        new = self._docs([top]).select("row")
        if segments and not new.groupBy("row").count().where("count > 1").isEmpty():
            raise ValueError("rows of an equal key in one update")
        if segments:
            gone = self._live_docs().join(new.distinct(), "row", "left_semi").select("row").distinct()
            tombs = self._bury(gone, gen, tombs)
        return self._commit(segments + [top], tombs, list(dict.fromkeys([*self.held.get("fields", []), *fields])))

    def delete(self, keys: DataFrame) -> int:
        """Rows of the keys (row) go."""
        gone = self._live_docs().join(keys.select("row").distinct(), "row", "left_semi").select("row").distinct()
        tombs = self._bury(gone, self.version + 1, self.held.get("tombs", []))
        return self._commit(self.held.get("segments", []), tombs, self.held.get("fields", []))

    def _bury(self, gone: DataFrame, gen: int, tombs: list[dict]) -> list[dict]:
        name = f"tombs/{uuid.uuid4().hex}"
        gone.write.parquet(f"{self.files.path}/{name}")
        n = self.spark.read.parquet(f"{self.files.path}/{name}").count()
        return tombs + [{"folder": name, "gen": gen, "rows": n}] if n else tombs

    def _segment(self, rows: DataFrame, fields: list[str], gen: int) -> dict:
        """Write the segment of (row, f_<field>...)."""
        return self._lay(postings_of(dealt(rows), fields), gen)

    def _lay(self, postings: DataFrame, gen: int, merged: bool = False) -> dict:
        """Write postings, those without a term telling rows without a word, as a segment. They come in runs sorted by term; none are shuffled.
        ``merged``: each posting stands for itself, so bounds are grouped."""
        top = f"segments/{uuid.uuid4().hex}"
        at = f"{self.files.path}/{top}"
        kind = dict(postings.dtypes)["row"]
        postings.write.option("parquet.block.size", 8 << 20).parquet(f"{at}/postings")
        laid = self.spark.read.schema(postings.schema).parquet(f"{at}/postings")
        run = laid.where("df is not null").select("term", "field", "band", "df", F.coalesce("n", "tf").alias("n"), F.coalesce("most", "tf").alias("tf"), F.coalesce("least", "dl").alias("dl"))
        # one row for each row and field: from its first word, or from the missing one
        laid.where("head").select("row", "field", "dl").write.parquet(f"{at}/docs")
        run.groupBy("term", "field").agg(F.sum("df").alias("df"), F.sum("n").alias("n")).sortWithinPartitions("term").write.parquet(f"{at}/dictionary")
        # as many as full bands would be, at least: rows of few different keys don't make every word a frequent one
        bands = self.spark.read.parquet(f"{at}/docs").agg(F.greatest(F.approx_count_distinct(band(F.col("row"), kind)), F.shiftright(F.count(F.lit(1)), BAND))).first()[0]
        often = self.spark.read.parquet(f"{at}/dictionary").where(F.col("df") >= bands).select("term", "field")
        # at most 1 << BAND times the mean of a row's different words, however many rows there are
        held = run.join(F.broadcast(often), ["term", "field"], "left_semi").select("term", "field", "band", "tf", "dl")
        # a run's bounds stay beside those of other runs, nothing is shuffled: who reads them takes the highest
        held = held.groupBy("term", "field", "band").agg(F.max("tf").alias("tf"), F.min("dl").alias("dl")) if merged else held
        held.sortWithinPartitions("term", "field").write.parquet(f"{at}/bounds")
        return {"folder": top, "gen": gen, "bands": bands, "schema": postings.schema.jsonValue()}

    def _commit(self, segments: list[dict], tombs: list[dict], fields: list[str]) -> int:
        """Put the next version in place, merging segments where they are many; what it counts is told in the manifest."""
        before = self.held
        self.held = {"segments": segments, "tombs": tombs, "fields": fields}
        old: list[dict] = []
        if len(segments) > self.most:
            old = segments
            docs = self._live_docs()
            empty = docs.where("dl = 0").select(F.lit(None).cast("string").alias("term"), "field", F.lit(0).cast("bigint").alias("band"), "row", F.lit(0).cast("bigint").alias("tf"), "dl", F.lit(True).alias("head"), F.array().cast("array<int>").alias("positions"), F.array().cast("array<bigint>").alias("places"))
            every = self.postings().withColumn("head", F.get("positions", F.lit(0)) == 0).unionByName(empty)
            none = F.lit(None).cast("bigint")
            every = every.withColumns({n: F.when(F.col("term").isNotNull(), F.lit(1).cast("bigint")) if n == "df" else none for n in SUMS})
            self.held = {"segments": [self._lay(every.sortWithinPartitions("term", "field", "band", "row"), self.version + 1, merged=True)], "tombs": [], "fields": fields}
        sizes = {r.field: [r.rows, r.words or 0] for r in self._live_docs().groupBy("field").agg(F.count(F.lit(1)).alias("rows"), F.sum("dl").alias("words")).collect()} if segments else {}
        self.held["sizes"] = sizes
        try:
            self.version = self.files.commit(self.version, self.held)
        except Exception:
            self.held = before
            raise
        self.replaced = [s["folder"] for s in old]
        return self.version

    def vacuum(self) -> None:
        """Delete the segments that the last commit merged, once nobody reads an older version."""
        self.files.drop(*self.replaced)

    # --- what is read ------------------------------------------------------------------------------------------------------
    def _live(self, name: str) -> DataFrame:
        """Rows of a table of all segments that no later tombstone hides."""
        parts = []
        for s in self.held["segments"]:
            reader = self.spark.read.schema(StructType.fromJson(s["schema"])) if name == "postings" else self.spark.read
            rows = reader.parquet(f"{self.files.path}/{s['folder']}/{name}")
            rows = rows.where("term is not null").drop("head", *SUMS) if name == "postings" else rows
            later = [t["folder"] for t in self.held["tombs"] if t["gen"] > s["gen"]]
            if later:
                rows = rows.join(self.spark.read.parquet(*[f"{self.files.path}/{x}" for x in later]).distinct(), "row", "left_anti")
            parts.append(rows)
        return functools.reduce(DataFrame.unionByName, parts)

    def postings(self) -> DataFrame:
        return self._live("postings")

    def _live_docs(self) -> DataFrame:
        return self._live("docs")

    def _docs(self, segments: list[dict]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.files.path}/{s['folder']}/docs" for s in segments]).select("row", "field").where(F.col("field") == self._first(segments))

    def _first(self, segments: list[dict]) -> str:
        return self.spark.read.parquet(f"{self.files.path}/{segments[0]['folder']}/docs").select(F.min("field")).first()[0] or ""

    def dictionary(self) -> DataFrame:
        """(term, field, df, n) of live postings; read as it was written unless tombstones or several segments make it stale."""
        if len(self.held["segments"]) == 1 and not self.held["tombs"]:
            return self.spark.read.parquet(f"{self.files.path}/{self.held['segments'][0]['folder']}/dictionary")
        return self.postings().groupBy("term", "field").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("n"))

    def bounds(self, terms: list[str]) -> DataFrame:
        """(term, field, band, tf, dl) of some terms. Of hidden rows, too: a bound may be too high, never too low."""
        parts = []
        for s in self.held["segments"]:
            at = f"{self.files.path}/{s['folder']}"
            asked = F.col("term").isin(terms)
            parts.append(self.spark.read.parquet(f"{at}/bounds").where(asked).select("term", "field", "band", "tf", "dl"))
            rare = self.spark.read.parquet(f"{at}/dictionary").where(asked & (F.col("df") < s["bands"])).select("term", "field").collect()
            if rare:
                own = functools.reduce(lambda a, b: a | b, [(F.col("term") == r.term) & (F.col("field") == r.field) for r in rare])
                parts.append(self.spark.read.schema(StructType.fromJson(s["schema"])).parquet(f"{at}/postings").where(own).select("term", "field", "band", "tf", "dl"))
        return functools.reduce(DataFrame.unionByName, parts).groupBy("term", "field", "band").agg(F.max("tf").alias("tf"), F.min("dl").alias("dl"))

    @property
    def sizes(self) -> dict[str, list[int]]:
        """Rows and words of each field."""
        return self.held.get("sizes", {})
