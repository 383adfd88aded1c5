"""Spelling variants: words one edit apart, through a positional q-gram index with a count filter."""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from masterline.llm.common import join_skewed, once, stage, text_of
from masterline.llm.words import CRC_TABLE, LOWER, UPPER, crc32_sql

#: Latin-1 bytes to bytes: A-Z lowered, À to ÿ as they are, all else to a space. So 90 letters are left.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
LEAST_CHARS = 6
LEAST_N = 5
RATIO = 5
SPOILED = 199
#: Words whose counts a task holds.
HELD = 200_000
GRAM = 3
#: Rows of a posting list that one task compares; a longer list is dealt out as pairs of parts.
LIST_ROWS = 4_096
LIST = ["gram", "len", "pos"]


def text_words(id_: str, text: str, least_chars: int = LEAST_CHARS, one_in: int = SPOILED) -> Counter[bytes]:
    """How often each long enough word stands in a text, in Latin-1. Where one_in divides the CRC-32 of id and word, a
    letter of the word is left out: misspellings planted by rule."""
    found, seed = Counter(), zlib.crc32(f"{id_}:".encode())
    for word, n in Counter(w for w in text.encode("latin-1", "replace").translate(LETTERS).split() if len(w) >= least_chars).items():
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
        if h % one_in == 0:
            word = word[: h % len(word)] + word[h % len(word) + 1 :]
        if len(word) >= least_chars:
            found[word] += n
    return found


def corpus_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_n: int = LEAST_N, held: int = HELD) -> DataFrame:
    """word, n of the words of all texts, spoiled ones included, that are long and frequent enough.

    Null texts have no words; a null id counts as an empty one. A task adds words up, and hands its sums on whenever
    it holds `held` words.
    """

    def rows(counts: Counter[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array((w.decode("latin-1") for w in counts), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for id_, text in zip(batch.column(0), batch.column(1), strict=True):
                counts.update(text_words(id_.as_py(), text.as_py(), least_chars))
                if len(counts) >= held:
                    yield rows(counts)
                    counts.clear()
        yield rows(counts)

    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_of(text_col))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n)


def grams(word: Column, q: int = GRAM) -> Column:
    """The q-grams of a word in order, in time linear in its length; an empty array if it is shorter."""
    of = lambda chars: F.transform(F.slice(chars, q, F.size(chars)), lambda last, i: F.concat(*(F.get(chars, i + j) for j in range(q - 1)), last))
    return once(F.split(word, ""), of)


def postings(words: DataFrame, q: int = GRAM) -> DataFrame:
    """gram, len, pos, role, word, n: the posting lists that words(word, n) enter and those that they probe.

    One edit spoils at most q of a word's q-grams, so of its q + 1 rarest at least one is left, and among those left
    the rarest is, for both words, within their q + 1 (equal grams go by place, which an edit leaves in order). A word
    is entered under these, with its length and the gram's place (role 0). It probes the lists of its own length at
    that place (role 1: a letter replaced), and those of words shorter by one there and one place before (role 2: one
    letter more). There are at most 90 ** q grams, whose frequencies are broadcast.
    """
    keyed = words.select("word", "n", F.xxhash64("word").alias("w1"), F.xxhash64(F.lit("2"), "word").alias("w2"))
    found = keyed.select("w1", "w2", F.posexplode(grams(F.col("word"), q)).alias("pos", "gram"))
    often = stage(found.groupBy("gram").agg(F.count(F.lit(1)).alias("df")), "grams")
    ordered = F.array_sort(F.collect_list(F.struct("df", "gram", "pos")))
    rare = found.join(F.broadcast(often), "gram").groupBy("w1", "w2").agg(F.slice(ordered, 1, q + 1).alias("rare"))
    own = keyed.join(rare, ["w1", "w2"]).select("word", "n", F.length("word").alias("len"), F.explode("rare").alias("_g")).select("word", "n", "len", "_g.gram", "_g.pos")
    entry = lambda role, shorter, before: F.struct(F.lit(role).alias("role"), (F.col("len") - shorter).alias("len"), (F.col("pos") - before).alias("pos"))
    return own.select("word", "n", "gram", F.explode(F.array(entry(0, 0, 0), entry(1, 0, 0), entry(2, 1, 0), entry(2, 1, 1))).alias("_e")).select("word", "n", "gram", "_e.*").filter("pos >= 0")


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced character makes b of a."""
    if len(a) < len(b):
        a, b = b, a
    longer = len(a) - len(b)
    if longer > 1 or a == b:
        return False
    low, high = 0, len(b)
    while low < high:  # the least place from which on they may differ
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return a[low + 1 :] == b[low + 1 - longer :]


def holds(numbers: list[int], k: int) -> bool:
    """Whether k is among ascending numbers."""
    at = bisect_left(numbers, k)
    return at < len(numbers) and numbers[at] == k


def near_in_list(index: list[str], probes: list[str], q: int = GRAM) -> Iterator[tuple[int, int]]:
    """(place in probes, place in index) of the pairs one edit apart; the index's words have one length, which the
    probes' have or exceed by one. Of two words of one length, the probe is the greater.

    A probe's posting lists hold places in ascending order, by gram and place in the word. A word that shares `least`
    grams stands in one list at least besides the least - 1 longest: the other lists are merged, and what comes out of
    them is counted in the longest by bisection.
    """
    lists = defaultdict(list)
    for k, word in enumerate(index):
        for i in range(len(word) - q + 1):
            lists[word[i : i + q], i].append(k)
    for p, word in enumerate(probes):
        longer = len(word) - len(index[0])
        least = len(word) - 2 * q + 1
        found = [lists[key] for i in range(len(word) - q + 1) for key in ((word[i : i + q], i - d) for d in range(longer + 1)) if key in lists]
        found.sort(key=len)
        cut = max(0, len(found) - least + 1)
        short, long_ = found[:cut], found[cut:]
        for k, shared in groupby(heapq.merge(*short)):
            if longer or index[k] < word:
                more = least - sum(1 for _ in shared)
                if (more <= 0 or sum(holds(x, k) for x in long_) >= more) and one_edit(word, index[k]):
                    yield p, k


def near_pairs(words: DataFrame, q: int = GRAM, list_rows: int = LIST_ROWS) -> DataFrame:
    """a, a_n, b, b_n: all pairs of different words(word, n) that are one edit apart, each once.

    Words must have 2 * q characters or more: then two that are one edit apart share a gram. Posting lists are grouped
    by gram, length and place; in each, every probe's lists are merged under the limits of length and place, words
    that share too few grams go, and the rest are compared. A list of more than list_rows rows is dealt out so that a
    task compares a part of its entries with a part of its probes; all parts meet.
    """
    rows = stage(postings(words, q), "postings")
    sizes = rows.groupBy(*LIST).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("role") == 0).alias("_own")).filter("_own > 0 AND rows > 2 * _own OR _own > 1")
    sizes = stage(sizes.select(*LIST, "rows", F.ceil(F.col("rows") / list_rows).cast("int").alias("parts")), "lists")
    total = sizes.agg(F.sum("rows")).first()[0] or 0
    dealt = join_skewed(rows, sizes.withColumn("_rows", F.col("rows")), LIST, "_rows", total)
    part, every = F.pmod(F.xxhash64("word"), F.col("parts")), F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    blocks = dealt.withColumn("_own", part.cast("int")).withColumn("_all", every)
    entered = F.col("role") == 0
    blocks = blocks.withColumn("_i", F.when(entered, F.col("_own")).otherwise(F.col("_all"))).withColumn("_p", F.when(entered, F.col("_all")).otherwise(F.col("_own")))
    word = F.struct("word", "n")
    lists = blocks.groupBy(*LIST, "_i", "_p").agg(F.collect_list(F.when(entered, word)).alias("index"), F.collect_list(F.when(~entered, word)).alias("probes"))
    lists = lists.filter("size(index) > 0 AND size(probes) > 0").select("index", "probes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                index, probes = row["index"], row["probes"]
                for p, k in near_in_list([x["word"] for x in index], [x["word"] for x in probes], q):
                    out.append((probes[p]["word"], probes[p]["n"], index[k]["word"], index[k]["n"]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [()] * 4, kinds, strict=True)], names=["a", "a_n", "b", "b_n"])

    kinds = [pa.string(), pa.int64()] * 2
    return lists.mapInArrow(run, "a string, a_n long, b string, b_n long").distinct()


def chain_ends(links: DataFrame) -> DataFrame:
    """word, root: where each chain of links(word, form) ends. A word has one link at most, and no chain is a ring.

    Every round doubles the links' reach, so a chain of n links takes about log2(n) rounds.
    """
    reach = stage(links.select("word", F.col("form").alias("root")), "links")
    while True:
        on = reach.select(F.col("word").alias("root"), F.col("root").alias("_on"))
        jumped = stage(reach.join(on, "root", "left").select("word", F.coalesce("_on", "root").alias("root"), F.col("_on").isNotNull().alias("_moved")), "links")
        reach = jumped.select("word", "root")
        if jumped.filter("_moved").limit(1).count() == 0:
            return reach


def spelling_variants(words: DataFrame, ratio: int = RATIO, q: int = GRAM) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of words(word, n).

    n_near words are one edit from it; the most frequent of these, or the first in code-point order of several, is its
    form if it is `ratio` times as frequent, else form and form_n are null. root is where the forms of forms end, the
    word itself without a form; as counts rise by `ratio` from form to form, chains end, and soon. Words have 2 * q
    characters or more and are different; n is positive. Without words the result is empty.
    """
    words = stage(words.select("word", "n"), "words")
    pairs = stage(near_pairs(words, q), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("other"), F.col("b_n").alias("other_n"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    best = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), F.min_by(F.struct("other", "other_n"), F.struct(-F.col("other_n"), F.col("other"))).alias("_best"))
    large = F.col("_best.other_n") >= F.col("n") * ratio
    known = stage(best.select("word", "n_near", F.when(large, F.col("_best.other")).alias("form"), F.when(large, F.col("_best.other_n")).alias("form_n")), "forms")
    roots = chain_ends(known.filter("form IS NOT NULL"))
    out = words.join(known, "word", "left").join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its form and root, misspellings planted by rule among them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return spelling_variants(corpus_words(docs))


SQL = rf"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
), lowered AS (
  SELECT doc_id, translate(run, '{UPPER}', '{LOWER}') AS run, count(*) AS n FROM runs GROUP BY ALL
), hashed AS (
  SELECT run, n, {crc32_sql("doc_id || ':' || run")} AS h FROM lowered, crc_table
), typed AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), one_way AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(DISTINCT other) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM one_way GROUP BY word
), forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * words.n THEN other END AS form, CASE WHEN other_n >= 5 * words.n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), chains AS (
  SELECT word, word AS root, 0 AS depth FROM forms UNION ALL SELECT c.word, f.form, depth + 1 FROM chains c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL
), ends AS (
  SELECT word, arg_max(root, depth) AS root FROM chains GROUP BY word
)
SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n FROM forms JOIN ends USING (word)
"""
