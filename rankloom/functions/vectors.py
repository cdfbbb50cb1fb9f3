"""Column expressions on ``array<float>`` vectors; arithmetic is in double."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where a lambda reads it many times."""
    return F.element_at(F.transform(F.array(value), use), 1)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; NULL when either vector has no length."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - cosine(a, b)


def similarity_from_distance(distance: Column) -> Column:
    return F.lit(1.0) - distance


def l2_distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2)))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, s: acc + s))


def negative_inner_product(a: Column, b: Column) -> Column:
    return -dot(a, b)


def normalised(a: Column) -> Column:
    """Unit vector; a zero vector is returned as it is."""
    def scaled(v: Column) -> Column:
        return bound(F.greatest(norm(v), F.lit(1e-300)), lambda length: F.transform(v, lambda x: x / length))

    return bound(a.cast("array<double>"), scaled)


def as_float32(a: Column) -> Column:
    return a.cast("array<float>")


def shortened(a: Column, dim: int) -> Column:
    """First ``dim`` components, scaled back to unit length."""
    return normalised(F.slice(a, 1, dim))


def term_bucket(term: Column, dim: int) -> Column:
    """Bucket of a term: first 8 hex digits of its SHA-256, modulo ``dim``."""
    digits = F.substring(F.sha2(term.cast("binary"), 256), 1, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(dim)).cast("int")


def bucket_counts(terms: Column, dim: int) -> Column:
    numbers = F.sequence(F.lit(0), F.lit(dim - 1))

    def counted(buckets: Column) -> Column:
        return F.transform(numbers, lambda b: F.size(F.filter(buckets, lambda x: x == b)).cast("double"))

    return bound(F.transform(terms, lambda t: term_bucket(t, dim)), counted)


def hashed_vector(terms: Column, dim: int) -> Column:
    """Unit vector of bucketed term counts, computed by built-in expressions."""
    return as_float32(normalised(bucket_counts(terms, dim)))
