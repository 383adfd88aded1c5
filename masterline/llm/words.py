"""Pieces that word-level operators share: ASCII case, and CRC-32 in SQL."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


def lower_ascii(word: Column) -> Column:
    """A-Z lowered, every other character as it is; quick where a word is all ASCII."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def crc32_sql(text: str) -> str:
    """DuckDB expression for the unsigned CRC-32 of a text's UTF-8; needs crc_table, with the list t, in FROM."""
    byte = f"('0x' || substr(hex(encode({text})), (2 * i + 1)::BIGINT, 2))::BIGINT"
    bytes_ = f"list_transform(range(strlen({text})), lambda i: {byte})"
    step = "xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), lambda c, b: {step}), 4294967295::BIGINT)"


#: WITH item of the 256 remainders of CRC-32, made by its rule.
CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda k: list_reduce([k, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384::BIGINT))) AS t
)"""
