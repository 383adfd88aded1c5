"""Name cleaning, keys and merges as Column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from masterline.functions import wordlists as W

SPACES = r"(?U)\s+"
MARKERS = ("dba", "d/b/a", "aka", "a/k/a", "fka", "c/o", "attn")
NULL_MARKS = ("", "nan", "none", "n/a")


def once(value: Column, f) -> Column:
    """f(value) with value computed once, however often f names it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def strip(c: Column) -> Column:
    """Trim all Unicode white space, not only spaces."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACES, " "))


@lru_cache(1)
def _folds() -> tuple[str, str, dict[str, str]]:
    """Characters whose compatibility decomposition, without combining marks, is one character or a few letters."""
    single, to, several = [], [], {}
    for code in range(0x80, 0x3000):
        c = chr(code)
        d = "".join(x for x in unicodedata.normalize("NFKD", c) if not "̀" <= x <= "ͯ")
        if d == c:
            continue
        if len(d) == 1:
            single.append(c)
            to.append(d)
        elif not d:
            single.append(c)
    gone = [c for c in single if not "".join(x for x in unicodedata.normalize("NFKD", c) if not "̀" <= x <= "ͯ")]
    single = [c for c in single if c not in gone] + gone
    for code in (*range(0x132, 0x134), *range(0x1C4, 0x1CD), *range(0x1F1, 0x1F4), *range(0xFB00, 0xFB07)):
        d = "".join(x for x in unicodedata.normalize("NFKD", chr(code)) if not "̀" <= x <= "ͯ")
        if len(d) > 1:
            several[chr(code)] = d
    return "".join(single), "".join(to), several


def fold(c: Column) -> Column:
    """Compatibility decomposition without combining marks, inside codegen.

    Covers every character below U+3000 that becomes one character, and Latin ligatures. For scripts whose
    characters decompose into several (Hangul syllables, for one) use masterline.functions.udfs.nfkd.
    """
    single, to, several = _folds()
    plain = F.translate(c, single, to)
    for a, b in several.items():
        plain = F.replace(plain, F.lit(a), F.lit(b))
    return F.when(c.rlike(r"[^\x00-\x7F]"), plain).otherwise(c)


def clean_value(c: Column) -> Column:
    """Trimmed value; blank and the usual null words, in any case, are null."""
    s = strip(c.cast("string"))
    return F.when(~F.lower(s).isin(*NULL_MARKS), s)


def clean_loaded(c: Column) -> Column:
    """Variant for bulk files: exact null words are null, and one NaN is cut off the end."""
    s = strip(c.cast("string"))
    cut = strip(F.regexp_replace(s, "NaN$", ""))
    return F.when(~s.isin("", "Unknown", "NaN", "None") & (cut != ""), cut)


def _any(words: Iterable[str]) -> str:
    return "|".join(words)


def clean_name(raw: Column) -> Column:
    """Grouping form of a name: folded, lower, without markers, punctuation, short numbers, suffixes and prefixes."""
    s = strip(F.coalesce(raw.cast("string"), F.lit("")))
    t = F.replace(F.lower(fold(s)), F.lit("&"), F.lit(" and "))
    t = F.regexp_replace(t, rf"(?U)\b(?:{_any(MARKERS)})\b", "")
    t = F.regexp_replace(t, r"[^\p{L}\p{N}_\s-]", " ")
    t = squeeze(F.regexp_replace(t, r"(?U)\b\d{1,3}\b", " "))
    t = F.regexp_replace(t, rf"(?: (?:{_any(W.CLEAN_SUFFIXES)}))+$", "")
    t = F.trim(F.regexp_replace(t, rf"^(?:(?:{_any(W.PREFIX_WORDS)}) )+", ""))
    return F.when(s.rlike(r"^\p{Nd}+$") | (F.length(s) < 2), "").otherwise(t)


def clean_name_lenient(raw: Column) -> Column:
    """Variant of the transaction load: punctuation and suffixes stay."""
    s = strip(F.coalesce(raw.cast("string"), F.lit("")))
    t = F.replace(F.lower(fold(s)), F.lit("&"), F.lit(" and "))
    t = F.regexp_replace(t, rf"(?U)\b(?:{_any(MARKERS)})\b", "")
    t = F.regexp_replace(t, r"(?U)^\W+\s-", "")
    t = squeeze(F.regexp_replace(t, r"(?U)\b\d{1,3}\b", ""))
    t = F.trim(F.regexp_replace(t, rf"^(?:(?:{_any(W.PREFIX_WORDS)}) )+", ""))
    return F.when(s.rlike(r"(?U)^\W+\d+$") | (F.length(s) < 2), "").otherwise(t)


def name_key(c: Column) -> Column:
    """Exact-match key: lower, trimmed, single spaces; null is empty."""
    return squeeze(F.lower(F.coalesce(c, F.lit(""))))


def block_key(cleaned: Column, common: Iterable[str] = W.COMMON_FIRST_WORDS) -> Column:
    """Blocking key: the first token; with the second if short or common; then with the third if still short."""
    t = F.split(cleaned, " ")
    first = F.get(t, F.lit(0))
    two = (F.size(t) > 1) & ((F.length(first) <= 2) | first.isin(*common))
    key = F.when(two, F.concat_ws("_", first, F.get(t, F.lit(1)))).otherwise(first)
    return F.when(F.coalesce(cleaned, F.lit("")) == "", "_empty_").otherwise(
        F.when((F.size(t) > 2) & (F.length(key) <= 5), F.concat_ws("_", key, F.get(t, F.lit(2)))).otherwise(key)
    )


def _words(c: Column) -> Column:
    return F.filter(F.split(c, SPACES), lambda t: t != "")


def comparison_name(c: Column) -> Column:
    """Comparison form: without suffixes, locations and single letters; less is dropped if nothing would stay."""
    s = F.regexp_replace(strip(F.lower(F.coalesce(c, F.lit("")))), r"\([^)]*\)", "")
    s = F.regexp_replace(F.regexp_replace(s, r"[^\p{L}\p{N}_\s&]", " "), r"(?U)\s+&\s+", " and ")
    t = _words(s)
    some = F.filter(t, lambda x: ~x.isin(*W.COMPARE_SUFFIXES))
    most = F.filter(some, lambda x: ~x.isin(*W.LOCATION_WORDS) & ((F.length(x) != 1) | (x == "&")))
    return F.array_join(F.when(F.size(most) > 0, most).when(F.size(some) > 0, some).otherwise(t), " ")


def name_tokens(c: Column) -> Column:
    """Distinct tokens of the comparison form that are longer than a letter."""
    return F.array_distinct(F.filter(F.split(comparison_name(c), " "), lambda t: F.length(t) > 1))


def _without_suffixes(c: Column) -> Column:
    s = F.regexp_replace(c, r"(?U)\s*\([^)]*\)\s*", " ")
    for p in W.OUTPUT_SUFFIX_PATTERNS:
        s = F.regexp_replace(s, f"(?iU){p}", " ")
    return s


def canonical_name(name: Column) -> Column:
    """Output form of a name: without legal suffixes and locations, in mixed case."""
    own = strip(F.coalesce(name, F.lit("")))
    bare = _without_suffixes(own)
    word = lambda w: F.lower(F.regexp_replace(w, r"[^\p{L}\p{N}_]", ""))
    kept = F.filter(_words(bare), lambda w: (word(w) != "") & ~word(w).isin(*W.LOCATION_WORDS))
    first = squeeze(F.regexp_replace(F.regexp_replace(F.array_join(kept, " "), r"[\s,-]+$", ""), r"^[\s,-]+", ""))
    second = F.regexp_replace(squeeze(bare), r"[\s,-]+$", "")
    best = F.when(F.length(first) >= 2, first).when(F.length(second) >= 2, second).otherwise(own)
    cased = lambda w: F.when(w.rlike("^[A-Z0-9&]{1,4}$") | w.contains("&"), F.upper(w)).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, F.lit(2), F.length(w)))))
    return F.when((best == F.upper(best)) | (best == F.lower(best)), F.array_join(F.transform(_words(best), cased), " ")).otherwise(best)


def canonical_score(name: Column) -> Column:
    """How well a name serves as canonical: regional marks, length and flat case cost, a plain legal form gains."""
    lower, score = F.lower(name), F.lit(100.0)
    for p in W.REGIONAL_PATTERNS:
        score = score - F.when(lower.rlike(f"(?U){p}"), 30.0).otherwise(0.0)
    n = F.length(name)
    score = score - F.when(n > 40, 15.0).when(n > 30, 10.0).when(n > 25, 5.0).otherwise(0.0)
    score = score + F.when((name != F.upper(name)) & (name != lower), 10.0).otherwise(0.0)
    score = score + F.when(name.rlike(r"(?iU)\b(?:Inc|Corp|Corporation)\b"), 5.0).otherwise(0.0)
    score = score - F.when(lower.rlike(r"(?U)\bpvt\s*ltd\b") | lower.rlike(r"(?U)\bprivate\s*limited\b"), 25.0).otherwise(0.0)
    return score - n * F.lit(0.5)


def good_description(c: Column) -> Column:
    """Whether an item description can be classified: 5 characters or more, and not only digits and separators."""
    d = strip(F.coalesce(c, F.lit("")))
    return (F.length(d) >= 5) & ~F.regexp_replace(d, r"[\s.\-/\\,()]+", "").rlike(r"^\p{Nd}+$")


def merge_tags(existing: Column, new: Column) -> Column:
    """existing (', ' text) with those of new (array) that it lacks in any case, in order."""
    parts = lambda a: F.filter(F.transform(a, strip), lambda t: t != "")
    old = parts(F.split(F.coalesce(existing, F.lit("")), ","))
    add = lambda acc, t: F.when(F.exists(acc, lambda z: F.lower(z) == F.lower(t)), acc).otherwise(F.concat(acc, F.array(t)))
    return F.array_join(F.aggregate(parts(F.coalesce(new, F.array().cast("array<string>"))), old, add), ", ")


def merge_locations(existing: Column, new: Column) -> Column:
    """Sorted union of two sets of locations; Unknown only if there is none."""
    parts = lambda a: F.filter(F.transform(a, strip), lambda t: (t != "") & (t != "Unknown"))
    both = F.array_union(parts(F.split(F.coalesce(existing, F.lit("")), ",")), parts(F.coalesce(new, F.array().cast("array<string>"))))
    return F.when(F.size(both) > 0, F.array_join(F.array_sort(both), ", ")).otherwise("Unknown")


def source_text(*parts: Column) -> Column:
    """Parts that aren't blank, joined by spaces."""
    return F.concat_ws(" ", *(F.nullif(strip(p), F.lit("")) for p in parts))


def percent(x: Column) -> Column:
    """Whole percent, halves to even."""
    return F.concat(F.bround(x * 100, 0).cast("int").cast("string"), F.lit("%"))


def parse_count(c: Column) -> Column:
    """A count with thousands separators; 0 if it isn't one."""
    plain = F.replace(F.coalesce(c, F.lit("")), F.lit(","), F.lit(""))
    return F.when(plain.rlike(r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)\s*$"), F.trim(plain).cast("double").cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def parse_amount(c: Column, kind: str = "decimal(18,4)") -> Column:
    """An amount; what isn't a plain number is null."""
    s = F.trim(c)
    return F.when(s.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"), s.try_cast("double").cast(kind))


def yes_no(c: Column) -> Column:
    return F.when(c, "Yes").otherwise("No")


def word_tokens(c: Column) -> Column:
    """Distinct lower-case tokens between non-word characters."""
    return F.array_distinct(F.split(F.lower(c), r"[^\p{L}\p{N}_]+"))


def overlap_score(description: Column, category: Column) -> Column:
    """Score of two token arrays: 1 for each description token in the category, and 0.5 for each pair of
    which one contains the other; tokens of up to two letters don't count."""
    long_ = F.filter(category, lambda y: F.length(y) > 2)
    hit = lambda x: F.when(F.array_contains(category, x), 1.0).otherwise(0.0) + 0.5 * F.size(F.filter(long_, lambda y: y.contains(x) | x.contains(y)))
    return F.aggregate(F.filter(description, lambda x: F.length(x) > 2), F.lit(0.0), lambda acc, x: acc + hit(x))
