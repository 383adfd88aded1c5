"""Leader clusters of names: a similarity join that scores only pairs which can qualify, and a numbered pointer forest."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from masterline.functions import text as T
from masterline.functions.udfs import similarity
from masterline.operators.ids import row_numbers
from masterline.operators.tables import lookup
from masterline.sources.scratch import kept

#: Weights and boosts of masterline.functions.udfs.similarity, from which the bounds below follow.
OVERLAP, RATIOS, SHORT = 0.35, 0.5, 0.15
SUBSET, LONGEST = 0.85, 0.80
#: Longest comparison form that an abbreviation can be of, and longest that such a pair can reach 0.65 with.
SHORT_CHARS, SHORT_PAIR_CHARS = 6, 9
#: Least threshold for which every qualifying pair of different comparison forms shares a token.
LEAST_THRESHOLD = 0.65
#: Room for rounding in comparisons of bounds with scores.
ROOM = 1e-9


def classes(names: DataFrame) -> DataFrame:
    """id, block, name, clean, first of names(block, name): ids are dense, in order of block and name; first is the least
    id of those in the block with the same comparison form."""
    numbered = kept(row_numbers(kept(names.distinct(), "distinct"), [F.col("block"), F.col("name")], "id").withColumn("clean", T.comparison_name(F.col("name"))), "names")
    first = numbered.groupBy("block", "clean").agg(F.min("id").alias("first"))
    key = F.struct("block", "clean")
    return kept(lookup(numbered.withColumn("_key", key), "_key", first.select(key.alias("_key"), "first"), rows=numbered.count()).drop("_key"), "classes")


def representatives(members: DataFrame) -> DataFrame:
    """Of every class its first name and, where an abbreviation can count, the first of each spelling that is read alike
    by it; with the tokens, rarest first, the longest token, and `floor`: what a likeness must reach to matter.

    A name whose longest token stands in an earlier name of the block is as like as LONGEST to it at least.
    """
    spelling = F.when(F.length("clean") <= SHORT_PAIR_CHARS, T.squeeze(F.lower(F.regexp_replace("name", r"(?U)[^\w\s]", " ")))).otherwise("")
    some = members.filter("clean != ''").groupBy("block", "clean", spelling.alias("_spelling")).agg(F.min(F.struct("id", "name", "first")).alias("_r"))
    tokens = F.array_distinct(F.filter(F.split("clean", " "), lambda t: F.length(t) > 1))
    rows = kept(some.select("block", "clean", "_r.*", tokens.alias("tokens"), F.length("clean").alias("len")), "reps")
    each = rows.filter("id = first").select("block", "id", F.explode("tokens").alias("token"))
    df = each.groupBy("block", "token").agg(F.count(F.lit(1)).alias("df"))
    key = F.struct("block", "token")
    counted = lookup(rows.select("block", "id", F.explode("tokens").alias("token")).withColumn("_key", key), "_key", df.select(key.alias("_key"), "df"))
    ordered = counted.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "token"))), lambda x: x["token"]).alias("tokens"))
    longest = F.array_max(F.transform("tokens", lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))))["t"]
    return rows.drop("tokens").join(ordered, "id").withColumn("longest", longest)


def pairs_of(tokens: Column, upto: Column) -> Column:
    """All pairs of the first `upto` tokens, each in alphabetical order."""
    first = F.slice(tokens, 1, upto)
    return F.flatten(F.transform(first, lambda a, i: F.transform(F.slice(first, i + 2, F.size(first)), lambda b: F.struct(F.least(a, b).alias("k1"), F.greatest(a, b).alias("k2")))))


def candidates(reps: DataFrame, threshold: float) -> DataFrame:
    """x, p, floor: pairs of representatives, p before x and x first of its class, that can reach x's floor.

    Different comparison forms can be as like as 0.65 or more in these ways only, so they meet under one of these keys:
    the tokens of one are among the other's (its one token, or its two rarest, are among the other's); the overlap of
    tokens is (threshold - RATIOS) / OVERLAP or more, hence of two tokens or more, and two of them are among the rarest
    n - a + 2 of both, a being the least overlap of a name of n tokens; a short form counts as an abbreviation, and
    then both forms have at most nine letters and share a token. The longest token alone makes no pair: it is a tie of
    a whole group, see leaders(). Pairs are then held to a bound by overlap and lengths.
    """
    n = F.size("tokens")
    least = F.greatest(F.lit(2), F.ceil(n * ((threshold - RATIOS) / OVERLAP) - ROOM).cast("int"))
    prefix = pairs_of(F.col("tokens"), n - least + 2)
    keyed = lambda kind, keys: F.transform(keys, lambda k: F.struct(F.lit(kind).alias("kind"), k["k1"].alias("k1"), k["k2"].alias("k2")))
    single = F.transform("tokens", lambda t: F.struct(t.alias("k1"), F.lit("").alias("k2")))
    none = F.slice(single, 1, 0)
    short = F.when((F.col("len") <= SHORT_PAIR_CHARS) & (n > 1), single).otherwise(none)
    both = F.concat(keyed("overlap", F.when(n > 1, prefix).otherwise(none)), keyed("short", short))
    left = F.concat(both, keyed("one", F.when(n == 1, single).otherwise(none)), keyed("two", F.when(n > 1, pairs_of(F.col("tokens"), F.lit(2))).otherwise(none)))
    right = F.concat(both, keyed("one", single), keyed("two", F.when(n > 1, pairs_of(F.col("tokens"), n)).otherwise(none)))
    groups = reps.filter("id = first").groupBy("block", "longest").agg(F.min("id").alias("_before"))
    key = F.struct("block", "longest")
    floored = lookup(reps.withColumn("_key", key), "_key", groups.select(key.alias("_key"), "_before"), rows=reps.count())
    floored = floored.withColumn("floor", F.when(F.col("_before") < F.col("first"), F.greatest(F.lit(LONGEST), F.lit(threshold))).otherwise(F.lit(threshold)))
    side = lambda s, keys: floored.select("block", *(F.col(c).alias(f"{c}_{s}") for c in ("id", "first", "tokens", "len", "floor")), F.explode(keys).alias("_k")).select("*", "_k.*").drop("_k")
    met = side("a", left).join(side("b", right), ["block", "kind", "k1", "k2"]).filter("first_a != first_b AND (kind IN ('one', 'two') OR id_a > id_b)")
    later = F.col("id_a") > F.col("id_b")
    pick = lambda c, of: F.when(of, F.col(f"{c}_a")).otherwise(F.col(f"{c}_b"))
    shared = F.size(F.array_intersect("tokens_a", "tokens_b"))
    fewer, all_ = F.least(F.size("tokens_a"), F.size("tokens_b")), F.size("tokens_a") + F.size("tokens_b") - shared
    shorter = F.least("len_a", "len_b")
    bound = OVERLAP * shared / all_ + RATIOS * 2 * shorter / (F.col("len_a") + F.col("len_b")) + F.when(shorter <= SHORT_CHARS, SHORT).otherwise(0.0)
    out = met.select(pick("id", later).alias("x"), pick("id", ~later).alias("p"), pick("first", later).alias("_first"), pick("floor", later).alias("floor"), (shared == fewer).alias("_subset"), bound.alias("_bound"))
    return out.filter("_first = x").filter(F.col("_subset") | (F.col("_bound") + ROOM >= F.col("floor"))).select("x", "p", "floor").distinct()


def bounded_similarity(name1: str, name2: str, clean1: str, clean2: str, floor: float) -> tuple[float, bool]:
    """The likeness of two names with different, non-empty comparison forms, or 0 if it is below floor; and whether the
    two ratios had to be measured: where letters in common bound them, a boost or nothing is the answer."""
    a, b = ({t for t in c.split() if len(t) > 1} for c in (clean1, clean2))
    boost = 0.0
    if a and b:
        boost = SUBSET if a <= b or b <= a else LONGEST if max(a, key=lambda t: (len(t), t)) == max(b, key=lambda t: (len(t), t)) else 0.0
    common = sum((Counter(clean1) & Counter(clean2)).values())
    overlap = len(a & b) / len(a | b) if a and b else 0.0
    most = OVERLAP * overlap + RATIOS * 2 * common / (len(clean1) + len(clean2)) + SHORT * (min(len(clean1), len(clean2)) <= SHORT_CHARS)
    if most + ROOM < max(boost, floor):
        return (boost if boost >= floor else 0.0), False
    score = similarity(name1, name2, clean1, clean2)
    return (score if score >= floor else 0.0), True


def scored_pairs(reps: DataFrame, threshold: float) -> DataFrame:
    """x, p, score, measured of the candidate pairs that reach x's floor or have been measured."""
    pairs = candidates(reps, threshold)
    of = lambda s: reps.select(F.col("id").alias(s), F.col("name").alias(f"name_{s}"), F.col("clean").alias(f"clean_{s}"), F.col("first").alias(f"first_{s}"))

    @F.pandas_udf("score double, measured boolean")
    def measure(n1: pd.Series, n2: pd.Series, c1: pd.Series, c2: pd.Series, floor: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([bounded_similarity(*r) for r in zip(n1, n2, c1, c2, floor, strict=True)], columns=["score", "measured"])

    named = pairs.join(of("x"), "x").join(of("p"), "p")
    return named.select("x", F.col("first_p").alias("p"), measure("name_x", "name_p", "clean_x", "clean_p", "floor").alias("_s")).select("x", "p", "_s.*").filter("score > 0 OR measured")


def leaders(reps: DataFrame, scored: DataFrame, part: int, tie_threshold: float) -> DataFrame:
    """first, leader (least name that the chain of nearest earlier names ends in) of each class.

    A class points to the classes of the names most like its first one, all of them if tied; where that likeness is no
    more than LONGEST and its longest token stands in earlier names, to all of those as well. Its leader is the least
    class that can be reached, for leaders get their numbers in order of name. Every round a class takes the least of
    what its pointers, and its own end so far, have reached: so reach doubles along chains. The least over an earlier
    part of a group is put together from ranges of `part` names, so that a group, too, is many tasks' work.
    """
    best = kept(scored.filter("score > 0").groupBy("x", "p").agg(F.max("score").alias("score")), "scored")
    most = best.groupBy("x").agg(F.max("score").alias("most"))
    edges = kept(best.join(most, "x").filter("score = most").select(F.col("x").alias("first"), F.col("p").alias("to")), "edges")
    start = reps.filter("id = first").select("first", "block", "longest", F.floor(F.col("first") / part).alias("range"))
    tied = F.coalesce(F.col("most") <= LONGEST, F.lit(tie_threshold <= LONGEST)) & F.col("longest").isNotNull()
    state = kept(start.join(most.withColumnRenamed("x", "first"), "first", "left").select("first", "block", "longest", "range", tied.alias("tied"), F.col("first").alias("leader")), "leaders")
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    rows = state.count()
    while True:
        ends = state.select(F.col("first").alias("to"), F.col("leader").alias("_end"))
        by_edges = lookup(edges, "to", ends, rows=rows).groupBy("first").agg(F.min("_end").alias("_edges"))
        ranges = state.filter("longest IS NOT NULL").groupBy("block", "longest", "range").agg(F.min("leader").alias("_least"))
        ranges = ranges.select("block", "longest", "range", F.min("_least").over(earlier(Window.partitionBy("block", "longest").orderBy("range"))).alias("_ranges"))
        inside = F.min("leader").over(earlier(Window.partitionBy("block", "longest", "range").orderBy("first")))
        own = state.filter("longest IS NOT NULL").select("first", "block", "longest", "range", "tied", inside.alias("_inside")).filter("tied")
        by_group = own.join(ranges, ["block", "longest", "range"]).select("first", F.least("_ranges", "_inside").alias("_group"))
        jumped = lookup(state.withColumnRenamed("leader", "to"), "to", ends, rows=rows).withColumnRenamed("to", "leader")
        reached = F.least("leader", "_end", "_edges", "_group")
        moved = jumped.join(by_edges, "first", "left").join(by_group, "first", "left").select("first", "block", "longest", "range", "tied", reached.alias("leader"), (reached < F.col("leader")).alias("_moved"))
        seen = Observation()
        state = kept(moved.observe(seen, F.count_if("_moved").alias("moved")).drop("_moved"), "leaders")
        if not seen.get["moved"]:
            return state.select("first", "leader")


def cluster_numbers(names: DataFrame, threshold: float, part: int) -> DataFrame:
    """block, cluster, name of names(block, name): numbers from 0 in each block, by the first name of each cluster."""
    if threshold < LEAST_THRESHOLD:
        raise ValueError(f"threshold must be {LEAST_THRESHOLD} or more: below, names without a common word could qualify")
    members = classes(names)
    reps = kept(representatives(members), "reps")
    found = leaders(reps, scored_pairs(reps, threshold), part, threshold)
    rows = members.count()
    led = lookup(members, "first", found, rows=rows).withColumn("leader", F.coalesce("leader", "first"))
    roots = kept(row_numbers(led.select("block", "leader").distinct(), [F.col("leader")], "_number"), "roots")
    starts = roots.groupBy("block").agg(F.min("_number").alias("_start"))
    numbers = roots.join(starts, "block").select("leader", (F.col("_number") - F.col("_start")).cast("int").alias("cluster"))
    return lookup(led, "leader", numbers, rows=rows).select("block", "cluster", "name")
