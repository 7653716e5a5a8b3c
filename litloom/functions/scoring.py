"""Scores as native expressions, and harmonic sums over groups of any size."""

from __future__ import annotations

from math import fsum, pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: From here on the tails of sums over 1/k and 1/k**2 are taken from their series, which are exact to a double by then.
SERIES_FROM = 64
_TAILS = [pi**2 / 6 - fsum(1 / k**2 for k in range(1, n + 1)) for n in range(SERIES_FROM)]
_HARMONIC = [fsum(1 / k for k in range(1, n + 1)) for n in range(SERIES_FROM)]
#: Euler's constant.
_GAMMA = 0.57721566490153286


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _entry(values: list[float], at: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), at.cast("int"))


def square_tail(n: Column) -> Column:
    """The sum of 1 / k**2 over all k > n, n a whole number of any size: a table, then the series around n + 1/2."""
    x = n.cast("double") + 0.5
    y = 1 / (x * x)
    series = (1 - y / 12 * (1 - y * 7 / 20 * (1 - y * 155 / 196))) / x
    return F.when(n < SERIES_FROM, _entry(_TAILS, n)).otherwise(series)


def rank_discounted(values: Column) -> Column:
    """The sum of v[k] / k**2 over an array in its own order, k from 1; null for a null or empty array."""
    terms = F.transform(values, lambda v, i: v / F.pow((i + 1).cast("double"), F.lit(2.0)))
    return F.when(F.size(values) > 0, _total(terms))


def harmonic(values: Column) -> Column:
    """rank_discounted of the values from the largest down."""
    return rank_discounted(F.sort_array(values, asc=False))


def harmonic_repeat(value: Column, times: Column) -> Column:
    """harmonic of value repeated so many times, 0 for none, without the array of it."""
    return value * (square_tail(F.lit(0)) - square_tail(times))


def harmonic_sums(rows: DataFrame, keys: list[str], score: str, times: str, name: str) -> DataFrame:
    """keys and, as name, the harmonic sum of each group's scores, each of which stands in a row `times` times over; null
    for a group whose scores are all null.

    Equal scores of a group are a run, whose length is summed before it is shuffled, and which adds its score times the
    difference of two tails; runs are ordered by a window, from the largest score down. No group is ever an array, and what
    is sorted of it is a row for each of its distinct scores.
    """
    runs = rows.groupBy(*keys, F.col(score).alias("__score")).agg(F.sum(F.when(F.col(score).isNotNull(), F.col(times)).otherwise(0)).alias("__n"))
    upto = F.sum("__n").over(W.partitionBy(*keys).orderBy(F.desc_nulls_last("__score")).rowsBetween(W.unboundedPreceding, 0))
    share = square_tail(F.col("__upto") - F.col("__n")) - square_tail(F.col("__upto"))
    return runs.withColumn("__upto", upto).groupBy(*keys).agg(F.sum(F.when(F.col("__n") > 0, F.col("__score") * share)).alias(name))


def max_harmonic(times: Column) -> Column:
    """The sum of k / k**2 for k up to times: a table, then logarithm and series."""
    n = times.cast("double")
    y = 1 / (n * n)
    series = F.log(n) + _GAMMA + 1 / (2 * n) - y / 12 * (1 - y / 10 * (1 - y * 10 / 21))
    return F.when(n < SERIES_FROM, _entry(_HARMONIC, times)).otherwise(series)


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def l2_norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """The cosine of two arrays of one length; 0 where either has no length."""
    norms = l2_norm(a) * l2_norm(b)
    return F.when(norms == 0, F.lit(0.0)).otherwise(dot(a, b) / norms)
