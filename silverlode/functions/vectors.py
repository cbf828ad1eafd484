"""Embedding vectors (P19): parsing, length normalisation, dot product."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_embedding(chunk: Column, key: str = "embed_vector") -> Column:
    """The vector of a JSON chunk: a list, or the JSON text of a list; missing or broken → NULL."""
    as_list = F.from_json(chunk, f"`{key}` array<double>")[key]
    as_text = F.from_json(F.get_json_object(chunk, f"$.{key}"), "array<double>")
    return F.coalesce(as_list, as_text)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector.cast("array<double>"), F.lit(0.0), lambda acc, x: acc + x * x))


def unit(vector: Column) -> Column:
    """The vector scaled to length 1; a zero vector → NULL. The length is an array next to the vector and not a
    term inside the lambda, where it would be computed again for every element."""
    wide, length = vector.cast("array<double>"), norm(vector)
    return F.when(length > 0, F.zip_with(wide, F.array_repeat(length, F.size(vector)), lambda x, n: x / n))


def cosine(a: Column, b: Column) -> Column:
    """NULL when one of the vectors is zero."""
    return F.try_divide(dot(a.cast("array<double>"), b.cast("array<double>")), norm(a) * norm(b))
