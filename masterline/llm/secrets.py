"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from masterline.llm.common import join_skewed, once, stage, text_of

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Greedy runs, so a least length inside the pattern keeps and drops the same matches as one applied after.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: What the method adds: bare tokens in which letters follow digits twice or more and no run of letters is as
#: long as a word, reported where ownership makes them live.
BARE = r"[A-Za-z0-9+/_-]{20,}"
MIXED = r"[0-9][A-Za-z].*[0-9][A-Za-z]"
WORDLIKE = r"[a-z]{6}|[A-Z]{8}|[A-Z][a-z]{5}"
KINDS = ("assign", "access", "hex", "bare")
ASSIGN_LEAST = 12
#: A value is a copied example if its owners are more than this share of those it would have were its
#: repositories dealt to owners at random. A rate, so it means the same in a corpus of any size.
OWNER_SHARE = 0.5
#: Elements that one step of a running aggregate appends.
CHUNK = 512
#: A live-looking value holds at least this many different characters, and no word of an example.
LEAST_DISTINCT = 8
EXAMPLE = r"example|sample|changeme|dummy|placeholder|xxxx|your_|redacted"
MASK = "[SECRET]"

LAST = (1 << 31) - 1

SPAN = "array<struct<start:int,kind:int,stop:int,value:string>>"


def running(values: Column, zero: int, combine) -> Column:
    """array<int>: before each of values, all earlier ones combined (zero before the first).

    Arrays grow by CHUNK elements at a time, so long ones cost n * (CHUNK + n / CHUNK), not n squared.
    """
    start = F.struct(F.lit(zero).alias("now"), F.array().cast("array<int>").alias("out"))
    step = lambda acc, v: F.struct(combine(acc["now"], v).alias("now"), F.concat(acc["out"], F.array(acc["now"])).alias("out"))

    def chunk(acc: Column, k: Column) -> Column:
        part = F.aggregate(F.slice(values, k * CHUNK + 1, F.lit(CHUNK)), F.struct(acc["now"].alias("now"), F.array().cast("array<int>").alias("out")), step)
        return once(part, lambda p: F.struct(p["now"].alias("now"), F.concat(acc["out"], p["out"]).alias("out")))

    chunks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int"))
    return F.when(F.size(values) > 0, F.aggregate(chunks, start, chunk)["out"]).otherwise(F.array().cast("array<int>"))


def spans_of(text: Column, pattern: str, kind: int, value=None) -> Column:
    """Spans of all leftmost non-overlapping matches, in code points.

    The pieces between matches and the matches alternate, so running sums of their lengths are positions.
    A text without a match is settled by one search.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    pieces = F.transform(F.arrays_zip(found.alias("m"), F.slice(gaps, F.lit(1), F.size(found)).alias("g")), lambda p: F.struct(p["m"].alias("m"), p["g"].alias("g"), F.length(p["m"]).alias("n")))

    def placed(p: Column) -> Column:
        before = running(F.transform(p, lambda x: x["g"] + x["n"]), 0, lambda a, v: a + v)
        span = lambda x: F.struct((x["b"] + x["p"]["g"]).alias("start"), F.lit(kind).alias("kind"), (x["b"] + x["p"]["g"] + x["p"]["n"]).alias("stop"), (value(x["p"]["m"]) if value else x["p"]["m"]).alias("value"))
        return F.transform(F.arrays_zip(before.alias("b"), p.alias("p")), span)

    return F.when(text.rlike(pattern), once(pieces, placed)).otherwise(F.array()).cast(SPAN)


def base_spans(text: Column) -> Column:
    assign = F.filter(spans_of(text, ASSIGN, 0, lambda m: F.regexp_extract(m, ASSIGN, 2)), lambda s: F.length(s["value"]) >= ASSIGN_LEAST)
    return F.array_sort(F.concat(assign, spans_of(text, ACCESS, 1), spans_of(text, HEX, 2)))


def bare_spans(text: Column, base: Column) -> Column:
    """Bare tokens of letters and digits, not of words, that touch no span of base.

    Among all spans in order, a token touches one before it if the greatest earlier end is past its start,
    and one after it if the least later start is before its end.
    """
    mixed = lambda s: s["value"].rlike(MIXED) & ~s["value"].rlike(WORDLIKE)
    tokens = F.filter(spans_of(text, BARE, 3), mixed)

    def free(every: Column) -> Column:
        ends = running(F.transform(every, lambda s: F.when(s["kind"] < 3, s["stop"]).otherwise(0)), 0, F.greatest)
        starts = F.reverse(running(F.transform(F.reverse(every), lambda s: F.when(s["kind"] < 3, s["start"]).otherwise(LAST)), LAST, F.least))
        zipped = F.arrays_zip(every.alias("s"), ends.alias("e"), starts.alias("a"))
        return F.transform(F.filter(zipped, lambda z: (z["s"]["kind"] == 3) & (z["e"] <= z["s"]["start"]) & (z["a"] >= z["s"]["stop"])), lambda z: z["s"])

    return once(tokens, lambda t: F.when((F.size(t) == 0) | (F.size(base) == 0), t).otherwise(once(F.array_sort(F.concat(base, t)), free)))


def joined(spans: Column) -> Column:
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def live_looking(value: Column, kind: Column) -> Column:
    """Varied, without a word of an example, and of letters and digits; an access key's form says enough."""
    varied = F.size(F.array_distinct(F.split(value, ""))) >= LEAST_DISTINCT
    return varied & ((kind == 1) | (value.rlike("[A-Za-z]") & value.rlike("[0-9]"))) & ~F.lower(value).rlike(EXAMPLE)


def effective(docs: DataFrame, owner: Column) -> float:
    """How many owners of equal size the corpus's owners are worth: 1 / sum of squared shares; at least 1."""
    n, squares = docs.groupBy(owner.alias("o")).agg(F.count(F.lit(1)).cast("double").alias("n")).agg(F.sum("n"), F.sum(F.col("n") * F.col("n"))).first()
    return max(1.0, n * n / squares) if n else 1.0


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str | None = None, keep: tuple[str, ...] = (), owner_share: float = OWNER_SHARE) -> DataFrame:
    """id, the columns in keep, and spans: array<struct<start, kind, stop, value_sha, owners, repositories, live>>.

    Candidates are hashed where they are found; distinct (value, owner, repository) rows are counted per
    value over the whole corpus. A value that looks like a credential is live if one repository alone holds
    it, or if its owners are few for its repositories: at most one, or owner_share of the
    k (1 - (1 - 1/k)^repositories) that chance would give, k being effective(owners). Any other is a copied
    example. Base spans (kinds 0 to 2) all stay; of bare tokens (3) the live ones. Only rows of candidates
    are shuffled, and documents that have some, never the texts of others; a value that much of the corpus
    copies is reduced before each exchange, and its rows meet its one count where they are.
    Null text is empty; a null owner or repository counts as one; repeated rows are scanned each; without
    repository_col a repository is a distinct text, so copies of a document are one. Ties in start go by
    kind. An empty table gives an empty result. keep may not name spans.
    """
    text = text_of(text_col)
    repository = F.col(repository_col) if repository_col else F.xxhash64(text)
    found = (
        docs.select(F.col(id_col).alias("_id"), F.col(owner_col).alias("_owner"), repository.alias("_repository"), F.struct(*(keep or (id_col,))).alias("_kept"), text.alias("_text"))
        .withColumn("_base", base_spans(F.col("_text")))
        .withColumn("_all", F.array_sort(F.concat("_base", bare_spans(F.col("_text"), F.col("_base")))))
        .withColumn("_row", F.monotonically_increasing_id())
        .drop("_text", "_base")
    )
    rows = stage(found, "secret-rows")
    each = rows.filter(F.size("_all") > 0).select("_row", "_owner", "_repository", F.explode("_all").alias("s")).select(
        "_row", "_owner", "_repository", F.sha2(F.col("s.value"), 256).alias("value_sha"), live_looking(F.col("s.value"), F.col("s.kind")).alias("_looks"), "s.start", "s.kind", "s.stop"
    )
    owned = each.groupBy("value_sha", "_owner", "_repository").agg(F.count(F.lit(1)).alias("_n"))
    owners = stage(owned.groupBy("value_sha").agg(F.countDistinct("_owner").alias("_o"), F.max(F.col("_owner").isNull().cast("int")).alias("_null"), (F.countDistinct("_repository") + F.max(F.col("_repository").isNull().cast("int"))).alias("repositories"), F.sum("_n").alias("_rows")), "secret-values")
    k = F.lit(effective(rows, F.col("_owner")))
    chance = k * (1 - F.pow(1 - 1 / k, F.col("repositories")))
    owners = owners.withColumn("owners", F.col("_o") + F.col("_null"))
    specific = (F.col("repositories") == 1) | (F.col("owners") <= F.greatest(F.lit(1.0), F.lit(owner_share) * chance))
    verdicts = owners.select("value_sha", "_rows", "owners", "repositories", specific.alias("_specific"))
    total = verdicts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    live = F.col("_looks") & F.col("_specific")
    judged = join_skewed(each, verdicts, ["value_sha"], "_rows", total).select("_row", F.struct("start", "kind", "stop", "value_sha", "owners", "repositories", live.alias("live")).alias("s")).filter("s.kind < 3 OR s.live")
    spans = judged.groupBy("_row").agg(F.array_sort(F.collect_list("s")).alias("spans"))
    none = F.array().cast("array<struct<start:int,kind:int,stop:int,value_sha:string,owners:bigint,repositories:bigint,live:boolean>>")
    have = F.size("_all") > 0
    with_spans = rows.filter(have).select("_id", "_row", "_kept").join(spans, "_row", "left").select("_id", "_kept", F.coalesce("spans", none).alias("spans"))
    out = rows.filter(~have).select("_id", "_kept", none.alias("spans")).unionByName(with_spans)
    return out.select(F.col("_id").alias(id_col), *(F.col(f"_kept.{c}").alias(c) for c in keep if c != id_col), "spans")


def redact(text: Column, spans: Column, mask: str = MASK) -> Column:
    """text with every live span replaced; overlapping spans are one."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        gap = F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), gap.alias("out"))

    done = F.aggregate(F.filter(spans, lambda s: s["live"]), zero, add)
    return F.when(F.exists(spans, lambda s: s["live"]), F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))).otherwise(text)


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its spans, joined, and how many are live or copied: see scan for edge cases."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    found = scan(docs)
    base = F.filter("spans", lambda s: s["kind"] < 3)
    n = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *(n(k).alias(f"n_{KINDS[k]}") for k in range(3)),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: ~s["live"])).cast("long").alias("n_copied"),
    )


def _sql_spans(kind: int, pattern: str, value: str) -> str:
    return f"""
  SELECT rid, doc_id, source, {kind} AS kind, start, start + len(m) AS stop, {value} AS v FROM (
    SELECT rid, doc_id, source, ms[i] AS m, (list_sum(list_transform(gaps[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: len(x))), 0))::BIGINT AS start
    FROM (SELECT rid, doc_id, source, ms, gaps, unnest(range(1, len(ms) + 1)) AS i FROM (
      SELECT rid, doc_id, source, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gaps FROM docs WHERE regexp_matches(t, '{pattern}'))))"""


_SQL_ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""

SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
assigned AS (SELECT * FROM ({_sql_spans(0, _SQL_ASSIGN, f"regexp_extract(m, '{_SQL_ASSIGN}', 2)")}) WHERE len(v) >= 12),
base AS (SELECT * FROM assigned UNION ALL {_sql_spans(1, ACCESS, "m")} UNION ALL {_sql_spans(2, HEX, "m")}),
bare AS (
  SELECT * FROM ({_sql_spans(3, BARE, "m")}) b WHERE regexp_matches(v, '{MIXED}') AND NOT regexp_matches(v, '{WORDLIKE}')
  AND NOT EXISTS (SELECT 1 FROM base x WHERE x.rid = b.rid AND x.start < b.stop AND b.start < x.stop)),
cand AS (SELECT * FROM base UNION ALL SELECT * FROM bare),
sizes AS (SELECT count(*)::DOUBLE AS n FROM docs GROUP BY source),
worth AS (SELECT greatest(1.0::DOUBLE, sum(n) * sum(n) / sum(n * n)) AS k FROM sizes),
owned AS (SELECT v, count(DISTINCT coalesce(docs.source, chr(1))) AS owners, count(DISTINCT t) AS repositories FROM cand JOIN docs USING (rid) GROUP BY v),
judged AS (
  SELECT cand.*, (repositories = 1 OR owners <= greatest(1.0::DOUBLE, {OWNER_SHARE}::DOUBLE * k * (1 - pow(1 - 1 / k, repositories)))) AND len(list_distinct(string_split(cand.v, ''))) >= {LEAST_DISTINCT} AND (kind = 1 OR regexp_matches(cand.v, '[A-Za-z]') AND regexp_matches(cand.v, '[0-9]'))
    AND NOT regexp_matches(lower(cand.v), '{EXAMPLE}') AS live
  FROM cand JOIN owned ON cand.v = owned.v, worth),
kept AS (SELECT *, (CASE kind WHEN 0 THEN 'assign' WHEN 1 THEN 'access' WHEN 2 THEN 'hex' ELSE 'bare' END) || ':' || start || ':' || stop AS s FROM judged WHERE kind < 3 OR live),
per AS (
  SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         string_agg(s, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(s, ',' ORDER BY start, kind) AS spans,
         count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied
  FROM kept GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_copied, 0)::BIGINT AS n_copied
FROM docs LEFT JOIN per USING (rid)
"""
