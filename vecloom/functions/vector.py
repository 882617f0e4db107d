"""Arithmetic on array columns, inside the JVM but for sums of wide vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.functions.vector_sums import sum_wide_vectors

#: Vectors of up to so many elements are added up element by element.
NARROW = 64

def to_double(vector: Column) -> Column:
    """The same vector with double elements."""
    return vector.cast("array<double>")


def dot(left: Column, right: Column) -> Column:
    """The sum of products; zero for two empty vectors."""
    products = F.zip_with(to_double(left), to_double(right), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    """The Euclidean length."""
    return F.sqrt(dot(vector, vector))


def reshape(vector: Column, width: int) -> Column:
    """The same elements as rows of ``width``, the last one maybe short; an empty vector has no row."""
    rows = F.ceil(F.size(vector) / F.lit(width)).cast("int")
    places = F.when(rows > 0, F.sequence(F.lit(0), F.greatest(rows - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.slice(vector, i * F.lit(width) + F.lit(1), F.lit(width)))


def cosine(left: Column, right: Column, left_norm: Column | None = None, right_norm: Column | None = None) -> Column:
    """Cosine similarity; NULL where a vector is empty or zero. Give the norms if they are columns already."""
    lengths = (norm(left) if left_norm is None else left_norm) * (norm(right) if right_norm is None else right_norm)
    return F.try_divide(dot(left, right), lengths)


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def scale(vector: Column, factor: Column) -> Column:
    return F.transform(to_double(vector), lambda x: x * factor)


def tidy(value: Column, digits: int = 6) -> Column:
    """Rounded, and never minus zero, so results compare by value."""
    return F.round(value, digits) + F.lit(0.0)


def half_even(x: Column, digits: int) -> Column:
    """``x``, rounded to ``digits`` decimals where it lies about half way between two: as its binary value has it, ties to even.

    ``format_string`` rounds the shortest decimal form half up, so without this 1/128 would read 0.007813. With ``x`` in two
    short parts, the products by which its side of the tie is found are exact.
    """
    size, unit = F.abs(x), 10.0**digits
    part = (size * unit) % 1.0
    below = size * unit - part
    head = size.cast("float").cast("double")
    past = (head * (2 * unit) - (below * 2 + 1)) + (size - head) * (2 * unit)
    nearest = (below + F.when((past > 0) | ((past == 0) & (below % 2 == 1)), 1.0).otherwise(0.0)) / unit
    return F.when((part > 0.25) & (part < 0.75) & (below < 2.0**50), F.when(x < 0, -nearest).otherwise(nearest)).otherwise(x)


def fixed_text(vector: Column, digits: int = 6) -> Column:
    """``[0.100000,0.200000]``: every float with the same number of digits, rounded as :func:`half_even` says."""
    numbers = F.transform(to_double(vector), lambda x: F.format_string(f"%.{digits}f", half_even(x, digits)))
    return F.concat(F.lit("["), F.array_join(numbers, ","), F.lit("]"))


def exact_text(vector: Column) -> Column:
    """``[0.1,0.2]`` with as many digits as give the same float back."""
    return F.concat(F.lit("["), F.array_join(vector.cast("array<string>"), ","), F.lit("]"))


def combine_vectors(df: DataFrame, keys: Sequence[str], vector: str, width: int, how: str = "sum", weight: str | None = None) -> DataFrame:
    """Add or average vectors per key: ``(keys..., vector)`` with double elements.

    All is combined before the shuffle, so a key that holds a third of all rows sends one partial row per task. Up to
    ``NARROW`` elements are a sum each, inside generated code; wider vectors are added up whole, see
    :func:`vecloom.functions.vector_sums.sum_wide_vectors`, so that the plan does not grow with them. A vector of another
    length than ``width`` fails the job rather than bending the mean; a missing vector does not count.
    """
    load = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.where(F.col(vector).isNotNull()).select(*keys, load.alias("_w"), to_double(F.col(vector)).alias("_v"))
    if width > NARROW:
        named = rows.where(F.col("_w").isNotNull()).select(*keys, F.col("_v").alias("vector"), F.col("_w").alias("weight"))
        summed = sum_wide_vectors(named, keys, width)
        mean = F.transform("total", lambda x: F.try_divide(x, F.col("weight")))
        return summed.select(*keys, (F.col("total") if how == "sum" else mean).alias(vector))
    sums = [F.sum(F.get("_v", F.lit(i)) * F.col("_w")).alias(f"_{i}") for i in range(width)]
    whole = rows.groupBy(*keys).agg(*sums, F.sum("_w").alias("_weight"), F.min(F.size("_v")).alias("_least"), F.max(F.size("_v")).alias("_most"))
    total = F.array(*[F.col(f"_{i}") for i in range(width)])
    value = total if how == "sum" else F.transform(total, lambda x: F.try_divide(x, F.col("_weight")))
    uneven = (F.col("_least") != width) | (F.col("_most") != width)
    checked = F.when(uneven, F.raise_error(F.lit(f"vectors of another length than {width}")).cast("array<double>"))
    return whole.select(*keys, checked.otherwise(value).alias(vector))
