"""Person or organisation: layered rules in one CASE expression."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from masterline.functions import wordlists as W
from masterline.functions.text import once, squeeze, strip


def _verdict(kind: str, confidence: str, reason: str) -> Column:
    return F.struct(F.lit(kind).alias("type"), F.lit(confidence).alias("confidence"), F.lit(reason).alias("reason"))


def classify_entity(name: Column, first_names: Iterable[str] = W.FIRST_NAMES, short: bool = False) -> Column:
    """struct(type, confidence, reason). short: the smaller rule set, without 'last, first' and with its own order.

    first_names: lists of several hundred names are the caller's, see sources.files.read_word_list. The trimmed
    name and its tokens are computed once each.
    """
    first_names = list(first_names)
    given = F.coalesce(name, F.lit(""))
    split = lambda s: F.split(squeeze(F.regexp_replace(F.lower(s), r"[^\p{L}\p{N}_\s&]", " ")), " ")
    prepared = once(strip(given), lambda s: F.struct(s.alias("s"), split(s).alias("tokens")))
    return F.when(given == "", _verdict("unknown", "low", "empty")).otherwise(once(prepared, lambda p: _rules(p["s"], p["tokens"], first_names, short)))


def _rules(s: Column, tokens: Column, first_names: list[str], short: bool) -> Column:
    n, first, last = F.size(tokens), F.get(tokens, F.lit(0)), F.element_at(tokens, -1)
    has = lambda words: F.exists(tokens, lambda t: t.isin(*words))
    corporate = W.CORPORATE_WORDS_SHORT if short else W.CORPORATE_WORDS
    v = F.when(has(W.STRONG_SUFFIXES), _verdict("organization", "high", "legal_suffix"))
    v = v.when(first.isin(*W.PERSON_TITLES), _verdict("individual", "high", "title_prefix"))
    v = v.when(last.isin(*W.PERSON_TITLE_SUFFIXES), _verdict("individual", "high", "title_suffix"))
    v = v.when(has(corporate), _verdict("organization", "high", "corp_keyword"))
    v = v.when(s.rlike("[&+]") & (n >= 3), _verdict("organization", "medium", "ampersand"))
    v = v.when(s.rlike(r"\p{Nd}"), _verdict("organization", "medium", "has_numbers"))
    person = (n >= 2) & (n <= 3) & first.isin(*first_names)
    if not short:
        after = F.get(F.split(F.lower(strip(F.get(F.split(s, ","), F.lit(1)))), " "), F.lit(0))
        comma = F.regexp_replace(s, r"[^\p{L}\p{N}_\s,]", "").rlike(r"(?i)^[a-z]+\s*,\s*[a-z]+")
        v = v.when(comma & after.isin(*first_names), _verdict("individual", "high", "last_comma_first"))
        v = v.when(person & (F.length(first) >= 2) & ~last.isin(*W.CORPORATE_WORDS, *W.CLEAN_SUFFIXES), _verdict("individual", "medium", "firstname_match"))
    v = v.when(n == 1, _verdict("organization", "low", "single_word")).when(n >= 4, _verdict("organization", "low", "long_name"))
    if short:
        v = v.when(person, _verdict("individual", "medium", "firstname_match"))
    return v.otherwise(_verdict("unknown", "low", "no_signal"))
