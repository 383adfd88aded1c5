"""Document fingerprints by winnowing, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from masterline.llm.common import SPACE_CHARS, once, stage, text_of, words_of

#: Tokens in a gram, and grams in a window: any passage of GRAM + WINDOW - 1 tokens that two texts share
#: gives them a fingerprint in common.
GRAM = 3
WINDOW = 4
#: Base and modulus (a prime below 2^30) of the rolling hash, and how a token's hash is cut to fit.
BASE = 716_145_463
MODULUS = 1_073_741_789
TOKEN_BITS = (1 << 30) - 1
#: Tokens are words; but of a text with fewer words than a passage, or with more characters a word than this
#: (unspaced scripts, code), they are its runs of three characters, at every place.
LONG_WORDS = 24
LAST = (1 << 31) - 1
ROWS_PER_RANGE = 200_000


def tokens(text: Column) -> Column:
    """Words of a text, or its character trigrams where words are too few or too long to tell passages."""
    chars = F.split(F.translate(text, SPACE_CHARS, ""), "")
    runs = once(chars, lambda c: F.when(F.size(c) < 3, F.array(F.array_join(c, ""))).otherwise(F.transform(F.slice(c, F.lit(1), F.greatest(F.size(c) - 2, F.lit(0))), lambda x, i: F.concat(x, F.get(c, i + 1), F.get(c, i + 2)))))
    choose = lambda w: F.when((F.size(w) > 0) & ((F.size(w) < GRAM + WINDOW - 1) | (F.length(text) > LONG_WORDS * F.size(w))), runs).otherwise(w)
    return once(words_of(text), choose)


def rolling(t: Column, gram: int = GRAM) -> Column:
    """Hashes of all grams of tokens t, at least `gram` of them.

    Each token is hashed once, to h; a gram's hash is h[i] B^(k-1) + ... + h[i+k-1] modulo a prime. It rolls:
    the next one is this times B, less h[i] B^k, plus h[i+k]. Arrays have no running state without copying, so
    the sum is taken of its k terms.
    """
    powers = [pow(BASE, gram - 1 - k, MODULUS) for k in range(gram)]
    sums = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - gram), lambda i: F.pmod(sum((F.get(h, i + k) * F.lit(p) for k, p in enumerate(powers)), F.lit(0).cast("long")), F.lit(MODULUS)))
    return once(F.transform(t, lambda w: F.xxhash64(w).bitwiseAND(F.lit(TOKEN_BITS))), sums)


def winnow(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """array<long> of the selected grams of a text, in order: its hash above the place it starts at.

    Of each window of grams the one with the least hash is selected, of equal ones the rightmost: the low
    bits hold LAST - place, so the least long is that gram. A text with fewer tokens than a gram is one gram;
    one with fewer grams than a window is one window; a text without words has none.
    """

    def packed(h: Column, place: Column) -> Column:
        return F.shiftleft(h, 31) + (F.lit(LAST) - place)

    def least(g: Column) -> Column:
        head = F.slice(g, F.lit(1), F.size(g) - (window - 1))
        slid = F.transform(head, lambda x, i: F.least(x, *(F.get(g, i + k) for k in range(1, window))))
        return F.when(F.size(g) >= window, F.array_distinct(slid)).otherwise(F.array(F.array_min(g)))

    def grams(t: Column) -> Column:
        many = F.transform(rolling(t, gram), packed)
        few = F.array(packed(F.xxhash64(t).bitwiseAND(F.lit(TOKEN_BITS)), F.lit(0)))
        return F.when(F.size(t) >= gram, once(many, least)).when(F.size(t) > 0, few).otherwise(F.array().cast("array<bigint>"))

    return once(tokens(text), grams)


def shown(selected: Column) -> Column:
    """The selected grams as hash:place, hex and decimal, by place."""
    return F.array_join(F.transform(selected, lambda x: F.concat_ws(":", F.lower(F.hex(F.shiftright(x, 31))), (F.lit(LAST) - x.bitwiseAND(F.lit(LAST))).cast("string"))), " ")


def hashes(selected: Column) -> Column:
    return F.array_distinct(F.transform(selected, lambda x: F.shiftright(x, 31).cast("int")))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two sets of hashes; two empty ones are alike."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both / (F.size(a) + F.size(b) - both))


def followers(keys: DataFrame) -> DataFrame:
    """keys(doc_id, _id, _h, n_chars), all different, with the _id and _h of the next by doc_id, _h (_nid, _nh).

    After the last comes the first. Keys are dealt into ranges; inside a range the next is a window away,
    and the last of a range takes the head of the next range, from a table with one row per range.
    """
    n = keys.count()
    ranges = max(8, -(-n // ROWS_PER_RANGE))
    dealt = stage(keys.repartitionByRange(ranges, F.col("doc_id").asc_nulls_first(), F.col("_h")).withColumn("_range", F.spark_partition_id()), "ranges")
    order = [F.col("doc_id").asc_nulls_first(), F.col("_h")]
    inside = dealt.withColumn("_next", F.lead(F.struct("_id", "_h")).over(Window.partitionBy("_range").orderBy(*order)))
    heads = dealt.groupBy("_range").agg(F.min(F.struct("doc_id", "_h", "_id")).alias("_head"))
    every = Window.partitionBy().orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("_range", F.coalesce(F.lead("_head").over(Window.orderBy("_range")), F.first("_head").over(every)).alias("_head"))
    next_ = F.coalesce("_next", F.struct("_head._id", "_head._h"))
    return inside.join(heads, "_range").withColumn("_next", next_).select("doc_id", "_id", "_h", "n_chars", F.col("_next._id").alias("_nid"), F.col("_next._h").alias("_nh"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses, as op10 returns them.

    Texts are dealt once, by key: both uses of a text, as the document and as the next of another, read the
    same exchange (their columns must stay alike for that). Of the next document only the start that
    replaces the end and the set of hashes travel to the one before. Null text is empty; null ids come first; rows that
    repeat (equal id and text) are one document in the order and give equal rows; a lone document is its
    own next; an empty table gives an empty result.
    """
    text = text_of(text_col)
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("_id"), F.xxhash64(text).alias("_h"), text.alias("_text"))
    keys = keyed.select("doc_id", "_id", "_h", F.length("_text").cast("long").alias("n_chars")).distinct()
    order = stage(followers(keys), "followers")
    dealt = keyed.repartition("_id", "_h")
    own = dealt.join(order.select("_id", "_h", "n_chars", "_nid", "_nh"), ["_id", "_h"])
    selected = own.withColumn("_selected", winnow(F.col("_text")))
    before = order.select(F.col("_nid").alias("_id"), F.col("_nh").alias("_h"), F.col("_id").alias("_pid"), F.col("_h").alias("_ph"), F.floor(F.col("n_chars") / 4).cast("int").alias("_m"))
    first = dealt.withColumn("_n", F.row_number().over(Window.partitionBy("_id", "_h").orderBy("doc_id"))).filter("_n = 1")
    given = first.join(before, ["_id", "_h"]).select(
        F.col("_pid").alias("_id"), F.col("_ph").alias("_h"), F.substring("_text", F.lit(1), F.col("_m")).alias("_start"), hashes(winnow(F.col("_text"))).alias("_next")
    )
    edited = F.concat(F.substring("_text", F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int")), "_start")
    both = selected.join(given, ["_id", "_h"]).withColumn("_edited", edited).withColumn("_changed", winnow(F.col("_edited"))).withColumn("_own", hashes(F.col("_selected")))
    return both.select(
        F.col("doc_id").alias(id_col),
        "n_chars",
        F.sha2("_edited", 256).alias("edited_sha256"),
        shown(F.col("_selected")).alias("fingerprint"),
        shown(F.col("_changed")).alias("edited_fingerprint"),
        likeness(F.col("_own"), hashes(F.col("_changed"))).alias("near_edited"),
        likeness(F.col("_own"), F.col("_next")).alias("near_next"),
    )


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and its edited text's: see fingerprint_edits for edge cases."""
    return fingerprint_edits(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
