"""Column resolution, renames and conforming to a schema."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def find_column(columns: Iterable[str], candidates: Iterable[str]) -> str | None:
    """First candidate that is a header, trimmed and in any case; of headers that fold alike the last."""
    folded = {c.strip().lower(): c for c in columns if c}
    return next((folded[k] for c in candidates if (k := c.strip().lower()) in folded), None)


def named_column(columns: list[str], name: str) -> str:
    """The header equal to name, trimmed; else in any case; else an error."""
    exact = next((c for c in columns if c.strip() == name.strip()), None)
    found = exact or next((c for c in columns if c.strip().lower() == name.strip().lower()), None)
    if found is None:
        raise ValueError(f"no column {name!r} among {columns}")
    return found


def name_like_column(columns: list[str]) -> str:
    """The first header that speaks of a supplier, vendor or name; else the first."""
    return next((c for c in columns if re.search("supplier|vendor|name", c, re.I)), columns[0])


def containing_index(columns: list[str], keywords: Iterable[str]) -> int:
    """Place of the first header that contains any keyword; else 0."""
    words = [k.lower() for k in keywords]
    return next((i for i, c in enumerate(columns) if any(k in c.lower() for k in words)), 0)


def rename_by_map(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Columns renamed by mapping (header in any case -> target); sources of one target are coalesced in order."""
    folded = {k.strip().lower(): v for k, v in mapping.items()}
    targets: dict[str, list[str]] = {}
    for c in df.columns:
        targets.setdefault(folded.get(c.strip().lower(), c), []).append(c)
    return df.select(*(F.coalesce(*map(quoted, sources)).alias(t) for t, sources in targets.items()))


def conform(df: DataFrame, schema: StructType, fill: Column | None = None) -> DataFrame:
    """Exactly the schema's columns, in its order and types: missing ones filled, others dropped."""
    fill = F.lit(None) if fill is None else fill
    return df.select(*((quoted(f.name) if f.name in df.columns else fill).cast(f.dataType).alias(f.name) for f in schema))


def missing_columns(required: Iterable[str]) -> Column:
    """Names of the required columns that are null or blank in a row."""
    marks = [F.when(F.trim(F.coalesce(quoted(c).cast("string"), F.lit(""))) == "", F.lit(c)) for c in required]
    return F.filter(F.array(*marks), lambda x: x.isNotNull())
