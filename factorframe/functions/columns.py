"""Column expressions: everything here stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schema import (
    DATE,
    KL_EPSILON,
    MONTH,
    RATING_VALUES,
    YEAR,
)


def int_field(text: Column) -> tuple[Column, Column]:
    """``(value, ok)`` of an optional integer field.

    An empty field is a good null; anything else that is no int32 is bad.
    """
    value = text.try_cast("int")
    return value, (text == "") | value.isNotNull()


def blank_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def evaluated_once(value: Column) -> Column:
    """A column for ``select`` whose value is computed once per row.

    Spark moves filters below projections and repeats the expression of a column
    for every mention of it there. It does not move them below an explode.
    """
    return F.explode(F.array(value))


def date_parts(date_col: str = DATE) -> dict[str, Column]:
    """The month partition of a rating, by partition column name."""
    return {YEAR: F.year(date_col), MONTH: F.month(date_col)}


def key_fraction(*keys: str, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the key values only.

    28 bits of an md5 digest: the same on every engine and on every re-run, so a
    lost task that runs again puts each row where it was.
    """
    text = F.concat_ws("|", F.lit(seed).cast("string"), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long") / F.lit(float(16**7))


def bin_rating(prediction: Column) -> Column:
    """Nearest rating of the domain: half rounds up, outliers are clipped."""
    low, high = F.lit(RATING_VALUES[0]), F.lit(RATING_VALUES[-1])
    return F.when(
        prediction.isNotNull(), F.least(F.greatest(F.round(prediction), low), high).cast("int")
    )


def histogram(rating: Column) -> Column:
    """Aggregate: count of each rating of the domain, in order, zeros included."""
    return F.array(*[F.count_if(rating == v) for v in RATING_VALUES])


def kl_divergence(p: Column, q: Column, epsilon: float = KL_EPSILON) -> Column:
    """KL(P || Q) of two count arrays of equal length, smoothed by ``epsilon``."""

    def shares(counts: Column) -> Column:
        total = F.aggregate(counts, F.lit(0.0), lambda acc, x: acc + x) + F.lit(epsilon)
        return F.transform(counts, lambda x: x / total + F.lit(epsilon))

    terms = F.zip_with(shares(p), shares(q), lambda a, b: a * F.log(a / b))
    return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)


def dot(left: Column, right: Column) -> Column:
    """Inner product in double precision; null when either side is null."""
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)
