"""Class-based bigram scoring: exchange clustering of words, smoothed by word frequencies."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from masterline.llm.common import scope, stage, text_of

CLASSES = 64
#: Words that the sequential exchange moves one after another, on the driver: the most frequent ones.
EXCHANGED = 2048
#: Words by which contexts are told apart: the most frequent ones, with END. All others are one context. Then a
#: context fits 16 bits. Every word of the training texts, known or not, gets its class from its own contexts.
KNOWN = 32_767
SWEEPS = 6
#: Words with at least 1/HEAD of all occurrences are broadcast with their counts: at most HEAD of them, of
#: at most HEAD_BYTES bytes. All others are joined by shuffling.
HEAD = 500_000
HEAD_BYTES = 64
#: Distinct words (half as many where their contexts are held too) and tokens that a task holds before it hands
#: them on, and parts into which the rows of a most frequent word are dealt.
FLUSH = 1_000_000
FLUSH_TOKENS = 1_000_000
SALTS = 4
END = b""
SUMS = ["n_tokens", "n_known", "base_score", "score"]


def words_in(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text with A-Z lowered; bytes.split() splits at ASCII white space alone."""
    return text.lower().split()


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of each unit: exchange clustering of a square table of pair counts.

    Units start by frequency, dealt in turn. Then each unit, the most frequent first, moves to the class
    that gives the class bigram model the greatest likelihood, until a sweep moves none or `sweeps` are
    over. A class's counts as first and as second of a pair are margins of their own: they differ where the
    table lacks pairs. Ties stay with the least class, so a rerun agrees.
    """
    first, second = pairs.sum(1), pairs.sum(0)
    order = np.argsort(-(first + second), kind="stable")
    of = np.zeros(len(pairs), dtype=np.int64)
    of[order] = np.arange(len(pairs)) % classes
    one = np.zeros((len(pairs), classes))
    one[np.arange(len(pairs)), of] = 1
    table = pairs.astype(np.float64)
    after, before = table @ one, table.T @ one
    between = one.T @ after
    firsts, seconds = between.sum(1), between.sum(0)
    every = np.arange(classes)
    for _ in range(sweeps):
        moved = 0
        for u in order:
            if not first[u] + second[u]:
                break
            a, own = of[u], table[u, u]
            right, left = after[u].copy(), before[u].copy()
            right[a] -= own
            left[a] -= own
            between[a] -= right
            between[:, a] -= left
            between[a, a] -= own
            firsts[a] -= first[u]
            seconds[a] -= second[u]
            gain = (xlogx(between + right) - xlogx(between)).sum(1) + (xlogx(between.T + left) - xlogx(between.T)).sum(1)
            diagonal = between[every, every]
            gain += xlogx(diagonal + right + left + own) + xlogx(diagonal) - xlogx(diagonal + right) - xlogx(diagonal + left)
            gain -= xlogx(firsts + first[u]) - xlogx(firsts) + xlogx(seconds + second[u]) - xlogx(seconds)
            b = int(np.argmax(gain)) if gain.max() > gain[a] + 1e-6 else a
            between[b] += right
            between[:, b] += left
            between[b, b] += own
            firsts[b] += first[u]
            seconds[b] += second[u]
            if b != a:
                of[u] = b
                for sums, row in ((after, table[:, u]), (before, table[u])):
                    sums[:, a] -= row
                    sums[:, b] += row
                moved += 1
        if not moved:
            break
    return of


def word_counts(texts: DataFrame) -> DataFrame:
    """word (binary; END once a text) and n of texts(text binary): counted per task, then summed."""

    def rows(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(words_in(text.as_py()))
                seen[END] += 1
                if len(seen) > FLUSH:
                    yield rows(seen)
                    seen = Counter()
        yield rows(seen)

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Numbers(dict):
    """word -> number in order of first sight; codes holds what known says of each, other where it says nothing."""

    def __init__(self, known: dict[bytes, int]) -> None:
        super().__init__()
        self.known, self.codes = known, []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.codes.append(self.known.get(word, len(self.known)))
        return n


def flat(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The uint32 numbers in an array of binaries, end to end, and how many each holds."""
    if not len(a) or a.buffers()[2] is None:
        return np.zeros(0, dtype="<u4"), np.zeros(len(a), dtype=np.int64)
    ends = np.frombuffer(a.buffers()[1], dtype="<i4")[a.offset : a.offset + len(a) + 1]
    return np.frombuffer(a.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]].view("<u4"), np.diff(ends).astype(np.int64) // 4


def binaries(numbers: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """What flat() takes apart."""
    ends = np.concatenate([[0], np.cumsum(sizes) * 4]).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(numbers, dtype="<u4"))])


def in_parts(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """keys and counts, with a count above 65,535 over several entries."""
    if not len(n) or n.max() <= 0xFFFF:
        return keys, n
    times = -(-n // 0xFFFF)
    parts = np.full(times.sum(), 0xFFFF)
    parts[np.cumsum(times) - 1] = n - (times - 1) * 0xFFFF
    return np.repeat(keys, times), parts


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, sorted, and how often each comes, in parts of at most 65,535; keys are sorted in place."""
    keys.sort()
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return in_parts(keys[heads], np.diff(np.append(heads, len(keys))))


def contexts(texts: DataFrame, known, first: int) -> DataFrame:
    """word, salt, entries (binary of uint32) of texts(text binary): what stands beside a word, counted per task.

    An entry is how often (low 16 bits) a context (high 16 bits) stands beside the word: a known word's code, or
    len(known) for any other, where it is before; those plus len(known) + 1 where it is after. Of the `first`
    most frequent words only each other's codes after them are entries, since other pairs are entries of the
    other word; their rows are salted. Texts have END before the first and after the last word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, before, after, waiting = Numbers(known.value), [], [], 0
        ids[END]  # number 0
        for batch in batches:
            for text in batch.column(0):
                words = words_in(text.as_py())
                seq = np.zeros(len(words) + 2, dtype=np.int32)
                seq[1:-1] = np.fromiter(map(ids.__getitem__, words), dtype=np.int32, count=len(words))
                before.append(seq[:-1])
                after.append(seq[1:])
                waiting += len(seq)
                if waiting > FLUSH_TOKENS or 2 * len(ids) > FLUSH:
                    yield from rows(ids, before, after)
                    ids, before, after, waiting = Numbers(known.value), [], [], 0
                    ids[END]
        if before:
            yield from rows(ids, before, after)

    def rows(ids: Numbers, before: list[np.ndarray], after: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        a, b, codes, k = np.concatenate(before), np.concatenate(after), np.array(ids.codes, dtype=np.int32), len(known.value)
        before.clear(), after.clear()
        own, other = codes[a], codes[b]
        here, there = (own >= first) | (other < first), other >= first
        keys = np.concatenate([b[there].astype(np.int64) << 16 | own[there], a[here].astype(np.int64) << 16 | (other[here] + k + 1)])
        del a, b, own, other, here, there
        keys, n = counted(keys)
        of, salt = keys >> 16, int(keys.sum()) % SALTS
        starts = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1, [len(of)]])
        packed, words = ((keys & 0xFFFF) << 16 | n).astype("<u4"), list(ids)
        for i in range(0, len(starts) - 1, 1 << 16):
            at = starts[i : i + (1 << 16) + 1]
            mine = of[at[:-1]]
            salts = np.where(codes[mine] < first, salt, 0).astype("int32")
            yield pa.RecordBatch.from_arrays([pa.array([words[w] for w in mine.tolist()], pa.binary()), pa.array(salts), binaries(packed[at[0] : at[-1]], np.diff(at))], names=["word", "salt", "entries"])

    return texts.mapInArrow(run, "word binary, salt int, entries binary")


def merged(rows: DataFrame, known) -> DataFrame:
    """word, code (len(known) if it has none), n, entries of rows as contexts() gives them: one row for each word
    and salt. Rows of a word come together, sorted, and are merged as they pass: a task holds a batch and one
    word's entries, of which there are at most 65,536. n sums the entries before the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.concat_batches([held, batch]) if held is not None else batch
            word, salt = rows.column(0), rows.column(1).to_numpy(zero_copy_only=False)
            new = pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False) | (salt[1:] != salt[:-1])
            starts = np.concatenate([[0], np.flatnonzero(new) + 1])
            last = int(starts[-1])  # the last group may go on in the next batch
            if last:
                yield made(rows.slice(0, last), starts[:-1])
            tail = rows.slice(last)
            held = rejoined(tail) if tail.num_rows > 64 else tail
        if held is not None:
            yield made(held, np.zeros(1, dtype=np.int64))

    def rejoined(rows: pa.RecordBatch) -> pa.RecordBatch:
        entries, _ = joined(rows.column(2), np.zeros(1, dtype=np.int64))
        return pa.RecordBatch.from_arrays([rows.column(0)[:1], rows.column(1)[:1], entries], schema=rows.schema)

    def joined(entries: pa.Array, starts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The entries of each group of rows as one, and how often something stands before its word."""
        k = len(known.value)
        numbers, sizes = flat(entries)
        group = np.repeat(np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(sizes)))), sizes)
        found = numbers.astype(np.int64)
        n = np.bincount(group, np.where(found >> 16 <= k, found & 0xFFFF, 0), minlength=len(starts)).astype(np.int64)
        if len(starts) < len(sizes):
            order = np.argsort(keys := group << 16 | found >> 16, kind="stable")
            keys, counts = keys[order], (found & 0xFFFF)[order]
            heads = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
            keys, counts = in_parts(keys[heads], np.add.reduceat(counts, heads))
            numbers, sizes = (keys & 0xFFFF) << 16 | counts, np.bincount(keys >> 16, minlength=len(starts))
        return binaries(numbers, sizes), n

    def made(rows: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        entries, n = joined(rows.column(2), starts)
        words = rows.column(0).take(pa.array(starts))
        code, k = known.value.get, len(known.value)
        codes = np.fromiter(map(code, words.to_pylist(), repeat(k)), dtype="int32", count=len(words))
        return pa.RecordBatch.from_arrays([words, pa.array(codes), pa.array(n), entries], names=["word", "code", "n", "entries"])

    dealt = rows.repartition("word", "salt").sortWithinPartitions("word", "salt")
    return dealt.mapInArrow(run, "word binary, code int, n long, entries binary")


def pair_table(rows: DataFrame, first: int, k: int) -> np.ndarray:
    """first x first counts of which of the most frequent words follows which: at most SALTS rows a word come."""
    out = np.zeros((first, first), dtype=np.int64)
    for r in rows.filter(F.col("code") < first).select("code", "entries").toLocalIterator():
        e = np.frombuffer(r["entries"], dtype="<u4").astype(np.int64)
        np.add.at(out[r["code"]], (e >> 16) - k - 1, e & 0xFFFF)
    return out


class Gain:
    """What a class adds to the likelihood of the class bigrams for words of given contexts, class counts held.

    between: classes x classes counts (rows come first). A word's contexts count 2 x (classes + 1): by the class
    before it, then by the class after it, each with one column for words of no class yet, which tell nothing.
    """

    def __init__(self, between: np.ndarray) -> None:
        k = len(between)
        first, second, total = between.sum(1), between.sum(0), max(between.sum(), 1)
        ahead = np.log((between + first[:, None] * second / total + 1e-9) / ((first[:, None] + 1) * (second + 1) / total))
        self.table = np.zeros((2 * (k + 1), k))
        self.table[:k] = ahead
        self.table[k + 1 : -1] = ahead.T
        self.empty = first + second == 0
        self.most = int(np.argmax(first))

    def best(self, found: np.ndarray) -> np.ndarray:
        """The class of each row of contexts; the least of equal ones; without any context of a class the largest."""
        gain = found @ self.table
        gain[:, self.empty] = -np.inf
        out = np.argmax(gain, axis=1)
        k = len(self.empty)
        out[(found[:, :k].sum(1) + found[:, k + 1 : -1].sum(1)) == 0] = self.most
        return out


def judged(rows: DataFrame, of, gain, first: int, k: int, classes: int) -> DataFrame:
    """word, code, n, class of every word of rows(word, code, n, entries) but the `first` most frequent, and, where
    word is null, sums for the class bigrams: class is then the place in a table of class pairs, with one more row
    and column for words that aren't known, and n what it gains.

    of: class by code, `classes` where a code has none yet; a word whose code has one keeps it. Each pair of words
    is summed once: with the second word if the first one is known, else with the first; pairs of two words that
    aren't known are in the last column by the first and in the last row by the second.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, side = 3 * classes + 2, classes + 1
        sums = np.zeros((side, side), dtype=np.int64)
        ahead = np.where(np.arange(k + 1) < first, of.value, np.where(of.value < classes, of.value + classes, 2 * classes))
        by_code = np.concatenate([of.value, ahead + side])
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers, sizes = flat(batch.column(3))
            found = np.bincount(np.repeat(np.arange(len(sizes)), sizes) * width + by_code[numbers >> 16], numbers & 0xFFFF, minlength=len(sizes) * width).reshape(-1, width)
            code = batch.column(1).to_numpy()
            both = np.concatenate([found[:, :side], found[:, side : side + classes] + found[:, side + classes : -1], found[:, -1:]], axis=1)
            own = np.where(of.value[code] < classes, of.value[code], gain.value.best(both))
            rare = code == k
            for c in np.unique(own).tolist():
                mine = own == c
                sums[:classes, c] += found[mine, :classes].sum(0).astype(np.int64)
                sums[c, :classes] += found[mine, side : side + classes].sum(0).astype(np.int64)
                mine &= rare
                sums[classes, c] += int(found[mine, classes].sum())
                sums[c, :classes] += found[mine, side + classes : -1].sum(0).astype(np.int64)
                sums[c, classes] += int(found[mine, -1].sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(own)], names=["word", "code", "n", "class"])
        place = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array([None] * len(place), pa.binary()), pa.array(np.zeros(len(place), dtype="int32")), pa.array(sums.ravel()[place]), pa.array(place)], names=["word", "code", "n", "class"])

    return rows.filter(F.col("code") >= first).mapInArrow(run, "word binary, code int, n long, class long")


def spread(table: np.ndarray) -> np.ndarray:
    """Class pairs, with those of two words that aren't known dealt out. Their number, and how many have which
    class first or second, are counted; which second goes with which first is not, and is taken as independent.

    table: as assigned sums it. In the last row (before) and column (after) are pairs of two words not known:
    (rest, c) came c second, (c, rest) came c first.
    """
    inside, first, second = table[:-1, :-1].astype(np.float64), table[:-1, -1].astype(np.float64), table[-1, :-1].astype(np.float64)
    return inside + (np.outer(first, second) / first.sum() if first.sum() else 0)


class Model:
    """What scoring needs besides words' counts and classes: transitions, class sizes and weights.

    between: counts of class pairs. Its last row of step is for a word before that training has not seen.
    """

    def __init__(self, between: np.ndarray, sizes: np.ndarray, tokens: int, types: int, singles: int) -> None:
        classes = len(between)
        self.sizes, self.tokens, self.types, self.floor = sizes.astype(np.float64), tokens, types, tokens + types + 1
        if not tokens:
            self.factor, self.rest = np.zeros((classes + 1, classes)), 1.0
            return
        share = self.sizes / tokens
        self.step = np.vstack([(between + share) / (between.sum(1)[:, None] + 1), share])
        self.rest = max(self.weight(between, share), singles / tokens, 1 / (tokens + 1))
        with np.errstate(divide="ignore", invalid="ignore"):
            self.factor = np.where(self.sizes > 0, (1 - self.rest) * self.step / self.sizes, 0.0)

    def weight(self, between: np.ndarray, share: np.ndarray, rounds: int = 20) -> float:
        """Weight of word frequency beside the class bigram, by expectation maximisation over all pairs."""
        u, v = np.nonzero(between)
        n, rest = between[u, v], 0.5
        ratio = self.step[u, v] / share[v]
        for _ in range(rounds):
            rest = float((n * (rest / (rest + (1 - rest) * ratio))).sum() / n.sum())
        return rest

    def logs(self, previous: np.ndarray, own: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the frequency estimate and of the model's probability, for tokens counted n times; the class
        of a word not seen, n = 0, is the number of classes before, and any after."""
        base = (n + 1) / self.floor
        return np.log10(base), np.log10(self.factor[previous, np.minimum(own, len(self.sizes) - 1)] * n + self.rest * base)


def fit(texts: DataFrame, classes: int = CLASSES, known: int = KNOWN, exchanged: int = EXCHANGED) -> tuple[DataFrame, Model]:
    """word, n, class of every word of texts(text binary) (written), and the model.

    The most frequent words are exchanged one after another until the class bigrams' likelihood rests. Then, as
    in distributed exchange, every other word moves to the class of the greatest gain with class counts held:
    first the other known words, by the classes beside them, then, in one pass over their merged contexts, all
    words of the texts, however rare. P(w | v) = (1 - r) P(class w | class v) P(w | class w) + r (c(w) + 1) /
    (N + V + 1): its sum over the known words and one unknown is 1. r comes from expectation maximisation, and
    is no less than the share of words seen once, which estimates how often new ones come. Null texts must be
    made empty before; an empty text is a pair of ENDs; without texts all counts are 0. Ties go to the more
    frequent word, then by its bytes, and to the least class, so a rerun agrees. Tables on the way are deleted.
    """
    with scope(texts.sparkSession):
        return _fitted(texts, classes, known, exchanged)


def _fitted(texts: DataFrame, classes: int, known: int, exchanged: int) -> tuple[DataFrame, Model]:
    spark = texts.sparkSession
    counts = stage(word_counts(texts), "words")
    tokens, types, singles = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum((F.col("n") == 1).cast("long")), F.lit(0))).first()
    often = counts.filter((F.length("word") <= HEAD_BYTES) & (F.length("word") > 0)).orderBy(F.col("n").desc(), "word").limit(known - 1).collect()
    codes = {word: i for i, word in enumerate([END, *(bytes(r["word"]) for r in often)])}
    k, first = len(codes), min(exchanged, len(codes))
    shared = spark.sparkContext.broadcast(codes)
    rows = stage(merged(contexts(texts, shared, first), shared), "contexts")
    pairs = pair_table(rows, first, k)
    of = np.full(k + 1, classes, dtype=np.int64)
    of[:first] = exchange(pairs, classes)
    one = np.zeros((first, classes))
    one[np.arange(first), of[:first]] = 1
    between = one.T @ pairs @ one
    judge = lambda part: judged(part, spark.sparkContext.broadcast(of.copy()), spark.sparkContext.broadcast(Gain(between)), first, k, classes)
    early = judge(rows.filter(F.col("code") < k)).filter("word IS NOT NULL")
    for r in early.select("code", "class").toLocalIterator():
        of[r["code"]] = r["class"]
    table = np.zeros((classes + 1, classes + 1))
    table[:classes, :classes] = between
    found = stage(judge(rows), "classes-of-words")
    for r in found.filter("word IS NULL").groupBy("class").agg(F.sum("n").alias("n")).collect():
        table[divmod(r["class"], classes + 1)] += r["n"]
    totals = [counts.filter(F.length("word") == 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], *(r["n"] for r in often)]
    head = spark.createDataFrame([(bytearray(w), totals[i], int(of[i])) for w, i in codes.items() if i < first and totals[i]], "word binary, n long, class long")
    vocabulary = stage(found.filter("word IS NOT NULL").select("word", "n", "class").unionByName(head), "vocabulary", outer=True)
    sizes = np.zeros(classes)
    for r in vocabulary.groupBy("class").agg(F.sum("n").alias("n")).collect():
        sizes[r["class"]] = r["n"]
    return vocabulary, Model(spread(table), sizes, tokens, types, singles)


def score(docs: DataFrame, vocabulary: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[Column, ...] = (), head: int = HEAD) -> DataFrame:
    """id, keep, n_tokens, n_known, base_score, score of every document of docs, whole.

    Frequent words (a bounded number, see HEAD) meet a broadcast table where the texts are, and the terms of
    pairs of them are summed there. The other different words of a document go to the full vocabulary and come
    back with their counts and classes, for the terms that were left open. Null and empty texts are one END; a
    training set without texts gives scores of 0 for every token; repeated rows are scored each; an empty table
    gives an empty result. keep passes as k0, k1, ...: extra columns of docs can't clash.
    """
    spark = docs.sparkSession
    classes = len(model.sizes)
    frequent = vocabulary.filter(((F.col("n") * head >= model.tokens) & (F.length("word") <= HEAD_BYTES)) | (F.length("word") == 0))
    table = [(bytes(r[0]), r[1], r[2]) for r in frequent.select("word", "n", "class").toLocalIterator()]
    shared = spark.sparkContext.broadcast((model, {w: i for i, (w, _, _) in enumerate(table)}, np.array([x[1] for x in table], dtype=np.int64), np.array([x[2] for x in table], dtype=np.int64)))
    del table
    kept = [c.alias(f"k{i}") for i, c in enumerate(keep)]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(F.col(id_col).alias("id"), *kept).alias("kept"), text_of(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, number, counts, of = shared.value
        at_end = number.get(END)
        end = classes if at_end is None else of[at_end]
        for batch in batches:
            sums, words_of, opens = [[], [], [], []], [], []
            for text in batch.column(2):
                words = words_in(text.as_py())
                words.append(END)
                at = np.fromiter(map(number.get, words, repeat(-1)), dtype=np.int64, count=len(words))
                far = at < 0
                n, own = (np.where(far, 0, x[at]) for x in (counts, of)) if len(counts) else (np.zeros_like(at), np.zeros_like(at))
                slots: dict[bytes, int] = {}
                for i in np.flatnonzero(far).tolist():
                    own[i] = -1 - slots.setdefault(words[i], len(slots))
                previous = np.concatenate([[end], own[:-1]])
                here = (own >= 0) & (previous >= 0)
                base, full = model.logs(previous[here], own[here], n[here])
                first = ~far & ~here
                for column, value in zip(sums, (len(words), int((n[~far] > 0).sum()), base.sum() + np.log10((n[first] + 1) / model.floor).sum(), full.sum()), strict=True):
                    column.append(value)
                words_of.append(list(slots))
                opens.append(np.stack([previous[~here], own[~here], n[~here]]).astype("<i8").tobytes())
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip([*sums, words_of, opens], kinds, strict=True))], names=["row", "kept", "n_tokens", "n_known", "base_score", "score", "words", "open"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value[0]
        for batch in batches:
            added = np.zeros((3, batch.num_rows))
            for i, (given, opened) in enumerate(zip(batch.column("given"), batch.column("open"), strict=True)):
                if not given.is_valid:
                    continue
                previous, own, n = np.frombuffer(opened.as_py(), dtype="<i8").reshape(3, -1).copy()
                order, count, kind = (given.values.field(c).to_numpy(zero_copy_only=False) for c in range(3))
                counts, of = np.zeros(len(order), dtype=np.int64), np.zeros(len(order), dtype=np.int64)
                counts[order], of[order] = count, kind
                far, before = own < 0, previous < 0
                n[far], own[far], previous[before] = counts[-1 - own[far]], of[-1 - own[far]], of[-1 - previous[before]]
                base, full = model.logs(previous, own, n)
                added[:, i] = (n[far] > 0).sum(), base[far].sum(), full.sum()
            known, base, full = (batch.column(c).to_numpy() for c in ("n_known", "base_score", "score"))
            sums = [batch.column("n_tokens"), pa.array(known + added[0].astype(np.int64)), pa.array(base + added[1]), pa.array(full + added[2])]
            yield pa.RecordBatch.from_arrays([batch.column("kept"), *sums], names=["kept", *SUMS])

    kind = rows.schema["kept"].dataType.simpleString()
    numbers = "n_tokens long, n_known long, base_score double, score double"
    measured = stage(rows.mapInArrow(run, f"row long, kept {kind}, {numbers}, words array<binary>, open binary"), "scored")
    asked = measured.select("row", F.posexplode("words").alias("slot", "word")).join(vocabulary, "word", "left")
    answered = asked.groupBy("row").agg(F.collect_list(F.struct("slot", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("class", F.lit(classes)).cast("long").alias("class"))).alias("given"))
    out = measured.select("row", "kept", *SUMS, "open").join(answered, "row", "left").select("kept", *SUMS, "given", "open").mapInArrow(finish, f"kept {kind}, {numbers}")
    return out.select(F.col("kept.id").alias(id_col), *(F.col(f"kept.k{i}") for i in range(len(keep))), *SUMS)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text, mod 7, is 2; a null id's text is empty."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def op5_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's scores by a model of those not held out: see fit and score for edge cases."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    vocabulary, model = fit(docs.filter(~held_out()).select(text_of().cast("binary").alias("text")))
    scored = score(docs, vocabulary, model, keep=(held_out(),))
    return scored.select("doc_id", F.col("k0").alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
