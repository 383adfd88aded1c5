"""Cosine search over embeddings, and loading them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masterline.functions.text import source_text
from masterline.functions.udfs import hash_embedding
from masterline.operators.tables import upsert

EMBED_CHARS = 8_000
STORED_CHARS = 10_000


def dot(a: Column, b: Column) -> Column:
    product = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(product, F.lit(0.0), lambda acc, x: acc + x)


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine, in double precision; null where a vector is null or zero."""
    return F.lit(1.0) - F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def top_k(vectors: DataFrame, query: Sequence[float], k: int, key: str, vector: str = "embedding") -> DataFrame:
    """The k rows nearest to the query, exactly, ties by key: each task keeps k."""
    q = F.array(*(F.lit(float(x)) for x in query))
    found = vectors.withColumn("distance", cosine_distance(F.col(vector), q)).filter("distance IS NOT NULL")
    return found.withColumn("similarity", 1 - F.col("distance")).orderBy("distance", key).limit(k)


def embed_suppliers(master: DataFrame, attributes: DataFrame, existing: DataFrame, client_id: str = "global", limit: int | None = None, embed=hash_embedding) -> DataFrame:
    """Vector rows of suppliers that have none yet, in id order: text of name and attributes, embedded."""
    rows = master.join(attributes, "global_supplier_id", "left").withColumn("client_id", F.lit(client_id)).withColumn("chunk_id", F.lit("0"))
    todo = rows.join(existing.select("client_id", "global_supplier_id", "chunk_id"), ["client_id", "global_supplier_id", "chunk_id"], "left_anti")
    if limit is not None:
        todo = todo.orderBy("global_supplier_id").limit(limit)
    text = source_text(*(F.col(c) for c in ("normalized_supplier_name", "supplier_description", "l1_category", "l2_category", "l3_category", "product_service_tags")))
    texts = todo.select("client_id", "global_supplier_id", "chunk_id", text.alias("_text"))
    return texts.select("client_id", "global_supplier_id", "chunk_id", embed(F.substring("_text", 1, EMBED_CHARS)).alias("embedding"), F.substring("_text", 1, STORED_CHARS).alias("source_text"), F.current_timestamp().alias("indexed_at"))


def checked(vectors: DataFrame, width: int, vector: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """Rows whose vector has width numbers, and the others as global_supplier_id, error_message."""
    good = F.coalesce(F.size(vector) == width, F.lit(False))
    message = F.concat(F.lit("embedding length "), F.coalesce(F.size(vector), F.lit(0)).cast("string"), F.lit(f", expected {width}"))
    return vectors.filter(good), vectors.filter(~good).select("global_supplier_id", message.alias("error_message"))


def load_vectors(table: DataFrame, vectors: DataFrame) -> DataFrame:
    """The table of vectors after an upsert: embedding, text and time of a known chunk are replaced, new chunks come in."""
    return upsert(table, vectors, ["client_id", "global_supplier_id", "chunk_id"], ["embedding", "source_text", "indexed_at"])


def search(vectors: DataFrame, query_vector: Sequence[float], k: int = 5, client_id: str = "global") -> DataFrame:
    """The nearest suppliers of a client, with a preview of their text."""
    own = vectors.filter((F.col("client_id") == client_id) & F.col("embedding").isNotNull())
    return top_k(own, query_vector, k, "global_supplier_id").select("global_supplier_id", "similarity", F.substring("source_text", 1, 100).alias("preview"))
