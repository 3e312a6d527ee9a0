"""Language model on Brown classes: exchange clustering, class transitions and word emissions.

What is clustered are units: the ``own_words`` most frequent words of the training texts are units of their own, all other words,
also those that training never saw, belong to the unit of their form (ending, length, digits). So every word has a class, a task finds it without
a join, and what the tasks hold is bounded by parameters, not by the corpus. Counts are of all training texts; those of up to ``held_words`` of the most
frequent words are sent to the tasks, those of all others are joined.

Exchange: with all other units where they are, moving a unit to another class changes the mutual information of neighbouring classes by what
its counts before and after each class tell. Each round sums those counts from the table of neighbouring units, finds every unit's best class
in tasks, and moves half of the units, dealt anew each round, so that neighbours don't swap at once. Rounds end with ``rounds`` or when
no unit gains; the assignment of the highest likelihood is kept.

P(word | word before) = T(class before, class) * E(word | class). T is the share of transitions, mixed with the class's own share as much as the
class before has successors for its count (Witten-Bell). E of a class keeps the share of words seen once for words never seen. A text begins
after, and ends with, an end token that is a unit and class of its own.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, scratch, spread, written

#: Longest word, in bytes, that is a unit of its own: with ``own_words`` it bounds what the tasks hold.
LONGEST = 128
#: Different words, and pairs of units, that a task counts before it hands them on.
HELD_WORDS, HELD_PAIRS = 1 << 19, 1 << 22
#: Other words whose form a task remembers.
REMEMBERED = 1 << 18
END = 0


def words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text with A-Z folded; parted by the six white spaces of ASCII, as bytes.split() does."""
    return (text or b"").lower().split()


_DIGIT = re.compile(rb"[0-9]")


def form(word: bytes) -> int:
    """A hash of what words of one unit share: ending, length and whether a digit is in it."""
    return zlib.crc32(word[-3:], (min(len(word), 24) // 3) * 2 + (_DIGIT.search(word) is not None))


class Numbers(dict):
    """Number of a word: 0 the end (the empty word), then the words whose counts are held, then the forms of all others."""

    def __init__(self, held: dict[bytes, int], forms: int):
        super().__init__(held)
        self.first, self.forms = len(held), forms

    def __reduce__(self) -> tuple:
        return Numbers, ({w: n for w, n in self.items() if n < self.first}, self.forms)

    def __missing__(self, word: bytes) -> int:
        found = self.first + form(word) % self.forms
        if len(self) < self.first + REMEMBERED and len(word) <= LONGEST:
            self[word] = found
        return found

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))


def units_of(held: int, own: int, forms: int, words: list[bytes]) -> np.ndarray:
    """Unit of each number: the end and the ``own`` most frequent words their own, other held words and the forms by form."""
    rest = [own + 1 + form(w) % forms for w in words[own + 1 :]]
    return np.concatenate([np.arange(own + 1), np.array(rest, np.int64), own + 1 + np.arange(forms)])


def _binary(column: pa.Array) -> Iterator[bytes | None]:
    return (x.as_py() for x in column.cast(pa.binary()))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of the texts; the end token is the empty word."""

    def out() -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    held: Counter = Counter()
    for batch in batches:
        for text in _binary(batch.column(0)):
            held.update(words(text))
            held[b""] += 1
            if len(held) > HELD_WORDS:
                yield out()
                held = Counter()
    yield out()


def _pair_counts(batches: Iterator[pa.RecordBatch], sent, total: int) -> Iterator[pa.RecordBatch]:
    """(a, b, n): unit a before unit b, the end before the first; once for each run of HELD_PAIRS words."""
    numbers, unit = sent.value
    parts: list[np.ndarray] = []
    waiting = 0

    def out() -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(parts or [np.zeros(0, np.int64)]), return_counts=True)
        return pa.record_batch([pa.array(keys // total, pa.int32()), pa.array(keys % total, pa.int32()), pa.array(n, pa.int64())], names=["a", "b", "n"])

    for batch in batches:
        for text in _binary(batch.column(0)):
            line = np.concatenate([[END], unit[numbers.of(words(text))], [END]])
            parts.append(line[:-1] * total + line[1:])
            waiting += len(line)
            if waiting > HELD_PAIRS:
                yield out()
                parts, waiting = [], 0
    yield out()


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(table: np.ndarray) -> float:
    """Mutual information of neighbouring classes, times the tokens."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(1)).sum() - _xlogx(table.sum(0)).sum())


def best_moves(units: np.ndarray, before: np.ndarray, after: np.ndarray, loops: np.ndarray, classes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class, gain) of each unit's best move, all others where they are; the end's class, 0, takes and gives none.

    before[u, c]: tokens of class c before u; after[u, c]: after it; loops[u]: u after itself.
    """
    k = len(table)
    best, gains = np.empty(len(units), np.int64), np.empty(len(units))
    for i in range(len(units)):
        c, p, s, loop = classes[i], before[i].astype(float), after[i].astype(float), float(loops[i])
        # the table without this unit; what it has with itself stands apart
        t = table.astype(float)
        t[:, c] -= p
        t[c, :] -= s
        t[c, c] += loop
        p[c] -= loop
        s[c] -= loop
        rows, cols = t.sum(1), t.sum(0)
        f = _xlogx(t)
        # with it in d: column d grows by p, row d by s, the corner by both and the loop
        column = (_xlogx(t + p[:, None]) - f).sum(0)
        row = (_xlogx(t + s[None, :]) - f).sum(1)
        own = np.diag(t)
        corner = _xlogx(own + p + s + loop) - _xlogx(own + p) - _xlogx(own + s) + _xlogx(own)
        # margins: those of d take all tokens of the unit; other classes' margins are the same for every d
        n_out, n_in = s.sum() + loop, p.sum() + loop
        gain = column + row + corner - (_xlogx(rows + p + n_out) - _xlogx(rows + p)) - (_xlogx(cols + s + n_in) - _xlogx(cols + s))
        gain[0] = -np.inf
        best[i] = int(gain.argmax())
        gains[i] = gain[best[i]] - gain[c]
    return best, gains


def _moves(batches: Iterator[pd.DataFrame], sent) -> Iterator[pd.DataFrame]:
    classes, table = sent.value
    k = len(table)
    for batch in batches:
        units = batch["unit"].to_numpy()
        sides, loops = np.zeros((2, len(units), k)), batch["loops"].to_numpy()
        for i, found in enumerate(batch["found"]):
            for x in found:
                sides[x["side"], i, x["c"]] = x["n"]
        to, gain = best_moves(units, sides[0], sides[1], loops, classes[units], table)
        yield pd.DataFrame({"unit": units, "to": to, "gain": gain})


def both_sides(pairs: DataFrame) -> DataFrame:
    """(unit, side, other, n): each pair seen from either unit, side 0 what stands before it; dealt by unit, so that a round adds up where it reads."""
    ends = F.array(F.struct(F.col("b").alias("unit"), F.lit(0).alias("side"), F.col("a").alias("other")), F.struct(F.col("a").alias("unit"), F.lit(1).alias("side"), F.col("b").alias("other")))
    seen = pairs.select(F.explode(ends).alias("e"), "n").select("e.unit", "e.side", "e.other", "n")
    return seen.repartition("unit").sortWithinPartitions("unit", "side", "other")


def exchange(sides: DataFrame, sizes: np.ndarray, k: int, rounds: int) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(class of each unit, table of transitions, likelihood of each round) from a written table of ``both_sides``.

    sizes: tokens of each unit. At first the k - 1 most frequent units have a class each and the others follow by their number.
    """
    spark = sides.sparkSession
    classes = np.zeros(len(sizes), np.int64)
    order = np.argsort(-sizes[1:], kind="stable") + 1
    classes[order] = np.arange(len(order)) % max(1, k - 1) + 1
    best, told = (classes, np.zeros((k, k)), -np.inf), []
    for n in range(rounds + 1):
        # bounded: a row for each unit
        class_of = F.broadcast(spark.createDataFrame(pd.DataFrame({"other": np.arange(len(classes), dtype=np.int32), "c": classes.astype(np.int32)}), "other int, c int"))
        loops = F.sum(F.when((F.col("unit") == F.col("other")) & (F.col("side") == 0), F.col("n")).otherwise(0))
        sums = written(sides.join(class_of, "other").groupBy("unit", "side", "c").agg(F.sum("n").alias("n"), loops.alias("loops")), "sums")
        own = class_of.select(F.col("other").alias("unit"), F.col("c").alias("own"))
        table = np.zeros((k, k))
        for r in sums.where("side = 1").join(F.broadcast(own), "unit").groupBy("own", "c").agg(F.sum("n").alias("n")).collect():  # k * k rows at most
            table[r.own, r.c] = r.n
        told.append(likelihood(table))
        if told[-1] > best[2]:
            best = (classes, table, told[-1])
        moves = pd.DataFrame()
        if n < rounds:
            turn = (F.col("unit") != END) & (F.pmod(F.xxhash64("unit", F.lit(n)), F.lit(2)) == 0)
            sent = spark.sparkContext.broadcast((classes, table))
            # a unit has at most 2 * k rows
            rows = sums.where(turn).groupBy("unit").agg(F.sum("loops").alias("loops"), F.collect_list(F.struct("side", "c", "n")).alias("found"))
            moves = rows.mapInPandas(lambda it, s=sent: _moves(it, s), "unit int, to int, gain double").where("gain > 1e-6").toPandas()
            sent.destroy()
        discard(sums)
        if n == rounds or moves.empty and n:
            break
        classes = classes.copy()
        if len(moves):
            classes[moves["unit"].to_numpy()] = moves["to"].to_numpy()
    return best[0], best[1], told


class Model:
    """What scoring needs: bounded by the parameters. counts: of each held word, by number; unit: of each number; classes: of each unit."""

    def __init__(self, numbers: Numbers, unit: np.ndarray, counts: np.ndarray, classes: np.ndarray, table: np.ndarray, once: np.ndarray, total: int, distinct: int):
        self.numbers, self.unit, self.classes, self.counts, self.total, self.distinct = numbers, unit, classes, counts, total, distinct
        k, size = len(table), table.sum(0)
        kinds = (table > 0).sum(1)
        share = (size + 0.5) / (size.sum() + 0.5 * k)
        trust = table.sum(1) / np.maximum(table.sum(1) + kinds, 1)
        seen = table / np.maximum(table.sum(1), 1)[:, None]
        self.transitions = np.log10(trust[:, None] * seen + (1 - trust)[:, None] * share[None, :])
        new = (once + 0.5) / (size + 1)
        #: log10 of what is left for a word never seen, and of what a known word's count is multiplied by.
        self.unseen, self.scale = np.log10(new), np.log10((1 - new) / np.maximum(size, 1))
        self.class_of = classes[unit]
        #: log10 of a held word's numerators, base and model; the end is certain in its class.
        self.base_log = np.log10(counts + 0.5)
        self.word_log = np.log10(np.maximum(counts, 1)) + self.scale[self.class_of[: len(counts)]]
        self.word_log[END] = 0.0
        #: log10 of the base's denominator.
        self.base_rest = float(np.log10(total + 0.5 * (distinct + 1)))


SCORED = "key bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, model double, tail array<struct<word:binary,c:int,n:bigint>>"


def _score(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """A row for each document: sums over what is known here, and the words whose counts are elsewhere."""
    from pyspark import TaskContext

    m: Model = sent.value
    held = len(m.counts)
    key = TaskContext.get().partitionId() << 40
    for batch in batches:
        sums: list[tuple] = []
        tail_words, tail_numbers, tail_n, ends = [], [], [], [0]
        for text in _binary(batch.column(2)):
            found = words(text)
            line = np.concatenate([[END], m.numbers.of(found), [END]])
            cls = m.class_of[line]
            known = line[1:][line[1:] < held]
            sums.append((len(found) + 1, int((m.counts[known] > 0).sum()), m.base_log[known].sum() - (len(found) + 1) * m.base_rest, m.transitions[cls[:-1], cls[1:]].sum() + m.word_log[known].sum()))
            if len(known) <= len(found):
                rare = Counter([found[i] for i in np.flatnonzero(line[1:-1] >= held).tolist()])
                tail_words += rare
                tail_numbers += map(m.numbers.__getitem__, rare)
                tail_n += rare.values()
            ends.append(len(tail_words))
        rows = pa.StructArray.from_arrays([pa.array(tail_words, pa.binary()), pa.array(m.class_of[np.array(tail_numbers, np.int64)], pa.int32()), pa.array(tail_n, pa.int64())], names=["word", "c", "n"])
        tokens, n_known, base, model = (list(x) for x in zip(*sums)) if sums else ([], [], [], [])
        columns = [pa.array(np.arange(key, key + len(sums))), batch.column(0), batch.column(1), pa.array(tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(model, pa.float64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)]
        key += len(sums)
        yield pa.record_batch(columns, names=[x.split()[0] for x in SCORED.split(", ")[:8]])


def cut_off(counts: DataFrame, most: int) -> int:
    """The count above which there are at most ``most`` words: no task sends more of them than there are."""
    seen = 0
    for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).toLocalIterator():
        seen += r.words
        if seen > most:
            return r.n
    return 0


def fit(train: DataFrame, text_col: str = "text", own_words: int = 16_384, held_words: int = 131_072, forms: int = 4_096, classes: int = 64, rounds: int = 8) -> tuple[Model, DataFrame]:
    """The model, and the written table of (word, n) of all training words, the end as the empty word."""
    spark = train.sparkSession
    texts = train.select(F.col(text_col).alias("text"))
    counts = texts.mapInArrow(_word_counts, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = written(counts, "words", lasting=True)
    size = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct")).first()
    short = counts.where((F.length("word") <= LONGEST) & (F.length("word") > 0))
    top = short.where(F.col("n") > cut_off(short, max(own_words, held_words))).toPandas()
    end = counts.where(F.length("word") == 0).first()
    ranked = sorted(zip(map(bytes, top["word"]), top["n"].tolist()), key=lambda x: (-x[1], x[0]))
    known = [b"", *(w for w, _ in ranked)]
    own = min(own_words, len(ranked))
    numbers, unit = Numbers({w: i for i, w in enumerate(known)}, forms), units_of(len(known), own, forms, known)
    total = own + 1 + forms
    sent = spark.sparkContext.broadcast((numbers, unit))
    pairs = texts.mapInArrow(lambda it: _pair_counts(it, sent, total), "a int, b int, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))
    sides = written(both_sides(pairs), "sides")
    sizes = np.zeros(total, np.int64)
    for r in sides.where("side = 0").groupBy("unit").agg(F.sum("n").alias("n")).toLocalIterator():
        sizes[r.unit] = r.n
    found, table, _ = exchange(sides, sizes, classes, rounds)
    once = _once(counts, sent, found, classes)
    sent.destroy()
    held = np.array([end.n if end else 0, *(n for _, n in ranked)], np.int64)
    return Model(numbers, unit, held, found, table, once, size.total or 0, size.distinct), counts


def _once(counts: DataFrame, sent, classes: np.ndarray, k: int) -> np.ndarray:
    """Words seen once, by class."""
    spark = counts.sparkSession
    held = spark.sparkContext.broadcast(classes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, unit = sent.value
        n = np.zeros(k, np.int64)
        for batch in batches:
            n += np.bincount(held.value[unit[numbers.of(batch.column(0).to_pylist())]], minlength=k)
        yield pa.record_batch([pa.array(np.arange(k), pa.int32()), pa.array(n)], names=["c", "n"])

    out = np.zeros(k)
    for r in counts.where("n = 1").select("word").mapInArrow(count, "c int, n bigint").groupBy("c").agg(F.sum("n").alias("n")).collect():
        out[r.c] = r.n
    held.destroy()
    return out


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", **parameters: int) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row, the model fitted on rows not held out.

    ``parameters``: own_words, held_words, forms, classes, rounds of ``fit``.

    Defined results: a null or empty text is its end token only. Rows are judged each, also equal ones and those of a null or equal id;
    a null ``held_out`` counts as false. An empty table gives no row; if nothing is left to train on, all counts are 0, the base has one outcome
    and the model falls back to even shares. Other columns aren't read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    rows = spread(rows)
    with scratch():
        model, counts = fit(rows.where(~F.col("held_out")), **parameters)
        sent = spark.sparkContext.broadcast(model)
        found = written(rows.mapInArrow(lambda it: _score(it, sent), SCORED), "scored")
        tail = found.select("key", F.explode("tail").alias("t")).select("key", "t.word", "t.c", "t.n").join(counts.select("word", F.col("n").alias("count")), "word", "left")
        # bounded: a row for each class
        told = F.broadcast(spark.createDataFrame(pd.DataFrame({"c": np.arange(len(model.scale), dtype=np.int32), "scale": model.scale, "unseen": model.unseen}), "c int, scale double, unseen double"))
        known = F.col("count").isNotNull()
        sums = tail.join(told, "c").groupBy("key").agg(
            F.sum(F.when(known, F.col("n")).otherwise(0)).alias("more_known"),
            F.sum(F.col("n") * F.log10(F.coalesce("count", F.lit(0)) + 0.5)).alias("more_base"),
            F.sum(F.col("n") * F.when(known, F.log10("count") + F.col("scale")).otherwise(F.col("unseen"))).alias("more_model"),
        )
        every = found.drop("tail").join(sums, "key", "left")
        zero = F.lit(0)
        out = every.select(
            "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", zero)).alias("n_known"), F.lit(model.total).cast("bigint").alias("train_tokens"),
            (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"), (F.col("model") + F.coalesce("more_model", zero)).alias("score"),
        )
        out = written(out, "perplexity", lasting=True)
        sent.destroy()
    discard(counts)
    return out
