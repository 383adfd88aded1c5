"""Category candidates, routing and consolidation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from masterline.functions import text as T
from masterline.operators.tables import lookup
from masterline.sources.scratch import kept

CANDIDATES = 25

def _grams(token: Column) -> Column:
    """The distinct trigrams of a token of three letters or more."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(token) - 2), lambda i: F.substring(token, i, F.lit(3))))


def contained(inner: DataFrame, outer: DataFrame) -> DataFrame:
    """inner, outer: pairs of different tokens of the tables inner(token) and outer(token), the former inside the latter.

    The trigrams of outer's tokens are posting lists; a token of inner probes the shortest list of its own trigrams, or
    none if one of them has no list, and only what stands there is compared.
    """
    lists = outer.select(F.col("token").alias("outer"), F.explode(_grams(F.col("token"))).alias("gram"))
    sizes = lists.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    probes = inner.select("token", F.explode(_grams(F.col("token"))).alias("gram")).join(sizes, "gram", "left")
    rarest = probes.groupBy(F.col("token").alias("inner")).agg(F.min(F.struct("n", "gram"))["gram"].alias("gram"), F.count_if(F.col("n").isNull()).alias("_lost")).filter("_lost = 0")
    return rarest.join(lists, "gram").filter((F.col("inner") != F.col("outer")) & F.col("outer").contains(F.col("inner"))).select("inner", "outer")


def token_hits(asked: DataFrame, known: DataFrame) -> DataFrame:
    """asked, known, weight of the tokens that score together: 1.5 if equal, 0.5 if one contains the other."""
    equal = asked.join(known, "token").select(F.col("token").alias("asked"), F.col("token").alias("known"), F.lit(1.5).alias("weight"))
    inside = contained(asked, known).select(F.col("inner").alias("asked"), F.col("outer").alias("known"), F.lit(0.5).alias("weight"))
    around = contained(known, asked).select(F.col("outer").alias("asked"), F.col("inner").alias("known"), F.lit(0.5).alias("weight"))
    return equal.unionByName(inside).unionByName(around)


def top_categories(descriptions: DataFrame, description: str, taxonomy: DataFrame, k: int = CANDIDATES) -> DataFrame:
    """description, l1, l2, l3, score, rank: the k best categories of each distinct description, ties by path.

    Scores are those of functions.text.overlap_score, summed over an inverted index: tokens of descriptions and of
    categories that score together are found once for each two tokens; the tokens of a description that score at all
    are its signature; the categories under each signature's tokens are added up and cut to k, and descriptions look
    up what their signature has. Where fewer than k categories score, the first others by path follow with 0.
    """
    paths = taxonomy.select("l1", "l2", "l3").distinct()
    words = lambda c: F.filter(T.word_tokens(c), lambda t: F.length(t) > 2)
    path = F.struct("l1", "l2", "l3")
    listed = kept(paths.select(path.alias("path"), F.explode(words(F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in ("l1", "l2", "l3"))))).alias("known")), "categories")
    distinct = kept(descriptions.select(F.col(description).alias("description")).filter("description IS NOT NULL").distinct(), "descriptions")
    asked = kept(distinct.select("description", F.explode(words(F.col("description"))).alias("asked")), "asked")
    hits = kept(token_hits(asked.select(F.col("asked").alias("token")).distinct(), listed.select(F.col("known").alias("token")).distinct()), "hits")
    scoring = lookup(asked, "asked", hits.select("asked").distinct().withColumn("_hit", F.lit(True))).filter("_hit")
    signed = distinct.join(scoring.groupBy("description").agg(F.array_sort(F.collect_set("asked")).alias("signature")), "description", "left")
    signed = kept(signed.withColumn("signature", F.coalesce("signature", F.array().cast("array<string>"))), "signed")
    signatures = signed.select("signature").distinct()
    scored = signatures.select("signature", F.explode("signature").alias("asked")).join(hits, "asked").join(listed, "known").groupBy("signature", "path").agg(F.sum("weight").alias("score"))
    best = Window.partitionBy("signature").orderBy(F.desc("score"), "path")
    top = kept(scored.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k).drop("_n"), "scored")
    arrays = top.groupBy("signature").agg(F.collect_list(F.struct((-F.col("score")).alias("s"), "path.l1", "path.l2", "path.l3")).alias("_top"))
    first = [r["path"] for r in paths.select(path.alias("path")).orderBy("path").limit(k).collect()]
    entry = "struct<s:double,l1:string,l2:string,l3:string>"
    others = F.array(*(F.struct(F.lit(0.0), *(F.lit(x).cast("string") for x in p)).cast(entry) for p in first)).cast(f"array<{entry}>")
    found = lookup(signed, "signature", arrays).withColumn("_top", F.coalesce("_top", F.array().cast(f"array<{entry}>")))
    scored_paths = F.transform("_top", lambda c: F.struct(c["l1"], c["l2"], c["l3"]))
    more = F.filter(others, lambda c: ~F.exists(scored_paths, lambda x: x.eqNullSafe(F.struct(c["l1"], c["l2"], c["l3"]))))
    ranked = found.select("description", F.posexplode(F.slice(F.array_sort(F.concat("_top", more)), 1, k)).alias("_pos", "c"))
    return ranked.select("description", "c.l1", "c.l2", "c.l3", (0.0 - F.col("c.s")).alias("score"), (F.col("_pos") + 1).alias("rank"))


def category_groups(lines: DataFrame, supplier: str, limit: int = 5) -> DataFrame:
    """Per supplier and category path: lines, mean confidences, up to `limit` different reasons in order.

    Lines are added up by their reason first, so that only different ones are collected.
    """
    mean = lambda c: (F.sum(f"_{c}") / F.nullif(F.sum(f"_n_{c}"), F.lit(0))).alias(f"avg_{c}")
    part = lambda c: (F.sum(c).alias(f"_{c}"), F.count(c).alias(f"_n_{c}"))
    sums = lines.groupBy(supplier, "l1", "l2", "l3", "reasoning").agg(F.count(F.lit(1)).alias("_n"), *part("confidence"), *part("l3_probability"))
    reasons = F.array_sort(F.collect_set(F.when(F.trim("reasoning") != "", F.col("reasoning"))))
    return sums.groupBy(supplier, "l1", "l2", "l3").agg(F.sum("_n").alias("n_lines"), mean("confidence"), mean("l3_probability"), F.array_join(F.slice(reasons, 1, limit), " | ").alias("reasoning"))


def consolidation_split(lines: DataFrame, confidence: str = "confidence", least: float = 0.6) -> DataFrame:
    """lines with part: high, or low where a consolidating model gets to see them; null confidence is low."""
    return lines.withColumn("part", F.when(F.col(confidence) >= least, "high").otherwise("low"))


def category_samples(lines: DataFrame, supplier: str, description: str, order: str, n: int = 5) -> DataFrame:
    """Per supplier and category: mean confidence, the first n descriptions in order, and the least order as `first`.

    No more than n lines of a category and task are shuffled, so a category of any size is many tasks' work.
    """
    group = [supplier, "l1", "l2", "l3"]
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(order, description))
    ranked = lines.select(*group, order, description).withColumn("_rank", rank).filter(F.col("_rank") <= n)
    samples = F.transform(F.array_sort(F.collect_list(F.struct("_rank", description))), lambda x: x[description])
    first = ranked.groupBy(F.struct(*group).alias("_key")).agg(samples.alias("samples"))
    means = lines.groupBy(*group).agg(F.avg("confidence").alias("avg_confidence"), F.min(order).alias("first"))
    return means.withColumn("_key", F.struct(*group)).join(first, "_key").select(*group, "avg_confidence", "samples", "first")


def reassign(lines: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """lines with the category path of the first answer that names them; others keep theirs.

    Answers are written first, so that the join knows that they are few and leaves the lines where they are.
    """
    first = kept(answers.groupBy(key).agg(F.min(F.struct("answer", "l1", "l2", "l3")).alias("_to")), "answers")
    joined = lines.join(first, key, "left")
    return joined.select(*(F.coalesce(F.col(f"_to.{c}"), F.col(c)).alias(c) if c in ("l1", "l2", "l3") else F.col(c) for c in lines.columns))


def classification_counts(lines: DataFrame, supplier: str, least: float = 0.6) -> DataFrame:
    """Per supplier: different category paths, and lines below the least confidence; null confidence is low."""
    low = F.coalesce(F.col("confidence") < least, F.lit(True))
    return lines.groupBy(supplier).agg(F.countDistinct(F.struct("l1", "l2", "l3")).alias("n_categories"), F.count_if(low).alias("n_low"))
