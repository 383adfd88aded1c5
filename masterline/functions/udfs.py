"""Vectorised functions for what Catalyst has no expression for."""

from __future__ import annotations

import json
import re
import unicodedata
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, FloatType, StringType


@F.pandas_udf(StringType())
def nfkd(s: pd.Series) -> pd.Series:
    """Full compatibility decomposition without combining marks."""
    return s.map(lambda x: None if x is None else re.sub("[̀-ͯ]", "", unicodedata.normalize("NFKD", x)))


def ratio(a: str, b: str) -> float:
    """Ratcliff/Obershelp ratio; it depends on the order of its arguments."""
    return SequenceMatcher(None, a, b).ratio()


def initials_match(short: str, long: str) -> bool:
    """Whether short abbreviates long: initials, a start of them, a start of the first word, or of two words."""
    s = re.sub(r"\W", "", short).lower()
    t = re.sub(r"\b(?:inc|corp|ltd|llc|plc|pvt|limited|corporation)\b", "", long.lower())
    t = [w for w in re.sub(r"[^\w\s]", " ", t).split() if len(w) > 1]
    if not s or not t:
        return False
    initials = "".join(w[0] for w in t)
    if s == initials or len(s) >= 2 and len(t) >= 2 and s.startswith(initials[:2]):
        return True
    if len(s) >= 3 and t[0].startswith(s[:3]):
        return True
    return len(s) >= 4 and len(t) >= 2 and any(t[0].startswith(s[:i]) and t[1].startswith(s[i:]) for i in range(2, len(s) - 1))


def similarity(name1: str, name2: str, clean1: str, clean2: str) -> float:
    """Likeness of two names, with their comparison forms given: token overlap, two ratios, abbreviation."""
    if not name1 or not name2 or not clean1 or not clean2:
        return 1.0 if name1 and name2 and clean1 == clean2 else 0.0
    if clean1 == clean2:
        return 1.0
    a, b = ({t for t in c.split() if len(t) > 1} for c in (clean1, clean2))
    overlap = len(a & b) / len(a | b) if a and b else 0.0
    by_token = ratio(" ".join(sorted(clean1.split())), " ".join(sorted(clean2.split())))
    short = min(len(clean1), len(clean2)) <= 6 and (initials_match(name1, name2) or initials_match(name2, name1))
    score = 0.35 * overlap + 0.25 * ratio(clean1, clean2) + 0.25 * by_token + 0.15 * short
    if a and b:
        if a <= b or b <= a:
            score = max(score, 0.85)
        if max(a, key=lambda t: (len(t), t)) == max(b, key=lambda t: (len(t), t)):
            score = max(score, 0.80)
    return min(score, 1.0)


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([0.0 if not x or not y else ratio(x.lower(), y.lower()) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def name_similarity(n1: pd.Series, n2: pd.Series, c1: pd.Series, c2: pd.Series) -> pd.Series:
    return pd.Series([similarity(*x) for x in zip(n1, n2, c1, c2, strict=True)], dtype="float64")


@F.pandas_udf(BooleanType())
def is_abbreviation(short: pd.Series, long: pd.Series) -> pd.Series:
    return pd.Series([initials_match(a or "", b or "") for a, b in zip(short, long, strict=True)])


#: A complete cluster of a resolver's answer, with its fields in the order that was asked for; confidence may lack.
WHOLE_CLUSTER = re.compile(r'\{\s*"canonical"\s*:\s*"[^"]*"\s*,\s*"members"\s*:\s*\[[^\]]*\]\s*(?:,\s*"confidence"\s*:\s*"[^"]*"\s*)?\}')


def _object(text: str) -> dict | None:
    """The JSON object that text is, or the first one in the array that it is."""
    try:
        found = json.loads(text)
    except ValueError:
        return None
    if isinstance(found, list):
        found = next((x for x in found if isinstance(x, dict)), None)
    return found if isinstance(found, dict) else None


def _closed(text: str) -> list[str]:
    """text from its first brace on, with open strings and brackets closed and trailing commas dropped; and, where it
    has no double quotes, with single ones taken for them."""
    start = text.find("{")
    if start < 0:
        return []
    body, stack, quoted, escaped = text[start:].rstrip().rstrip("`").rstrip(), [], False, False
    for c in body:
        if quoted:
            quoted, escaped = escaped or c != '"', c == "\\" and not escaped
        elif c == '"':
            quoted = True
        elif c in "{[":
            stack.append("}" if c == "{" else "]")
        elif c in "}]" and stack:
            stack.pop()
    out = [re.sub(r",\s*$", "", body + '"' * quoted) + "".join(reversed(stack))]
    if "'" in body and '"' not in body:
        out += _closed(body.replace("'", '"'))
    return [re.sub(r",\s*([}\]])", r"\1", t) for t in out]


def repair(text: str | None) -> str | None:
    """The JSON object in a text: as it is, fenced, or between the outer braces; else the complete clusters of an
    answer that was cut off; else with brackets closed; null if none parses."""
    if not text:
        return None
    fenced = re.search(r"```(?:json)?\s*(.*?)\s*```", text, re.S)
    outer = re.search(r"\{.*\}", text, re.S)
    found = next((x for t in (text.strip(), fenced and fenced.group(1), outer and outer.group(0)) if t and (x := _object(t)) is not None), None)
    if found is None and (whole := [x for t in WHOLE_CLUSTER.findall(text) if (x := _object(t)) is not None]):
        found = {"clusters": whole}
    if found is None:
        found = next((x for t in _closed(text) if (x := _object(t)) is not None), None)
    return None if found is None else json.dumps(found, separators=(",", ":"))


@F.pandas_udf(StringType())
def repair_json(s: pd.Series) -> pd.Series:
    return s.map(repair)


def repaired_json(text: Column) -> Column:
    """The JSON object in a text, as repair finds it; texts that are an object as they stand aren't repaired."""
    whole = F.try_parse_json(text)
    plain = whole.isNotNull() & F.schema_of_variant(whole).startswith("OBJECT")
    return F.when(plain, text).otherwise(repair_json(F.when(~F.coalesce(plain, F.lit(False)), text)))


@F.pandas_udf(ArrayType(FloatType()))
def hash_embedding(s: pd.Series) -> pd.Series:
    """Deterministic stand-in for an embedding model: signed hashed words, 64 wide, of unit length; blank is zero.
    Words that all cancel each other are counted without signs."""
    import zlib

    def one(text: str | None) -> np.ndarray:
        v, hashes = np.zeros(64, dtype=np.float32), [zlib.crc32(w.encode()) for w in (text or "").lower().split()]
        for h in hashes:
            v[h % 64] += 1 if h >> 16 & 1 else -1
        if not v.any():
            for h in hashes:
                v[h % 64] += 1
        n = float(np.sqrt((v * v).sum()))
        return v / n if n else v

    return s.map(one)


@F.pandas_udf(BinaryType())
def packed(v: pd.Series) -> pd.Series:
    """A vector as little-endian float32, four bytes a number."""
    return v.map(lambda x: None if x is None else np.asarray(x, dtype="<f4").tobytes())


@F.pandas_udf(ArrayType(FloatType()))
def unpacked(b: pd.Series) -> pd.Series:
    return b.map(lambda x: None if x is None else np.frombuffer(x, dtype="<f4"))


@F.pandas_udf(StringType())
def vector_literal(v: pd.Series) -> pd.Series:
    """A vector as text, [a,b,...], each number as its shortest form in double precision."""
    return v.map(lambda x: None if x is None else "[" + ",".join(str(float(y)) for y in x) + "]")
