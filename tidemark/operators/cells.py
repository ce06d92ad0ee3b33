"""Placing values among ascending bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_place(df: DataFrame, bounds: str, value: str, most: int, name: str, own: bool) -> DataFrame:
    """Rows with how many of their ``bounds``, an ascending array, lie below ``value``, in ``name``.

    With ``own`` a bound that equals the value counts as well. Looks among every n-th bound
    first and then between two of those: of at most ``most`` bounds a row is compared with
    about twice their root.
    """
    wide = max(1, round(most**0.5))
    passed = (lambda bound: bound <= F.col(value)) if own else (lambda bound: bound < F.col(value))
    leads = F.transform(F.sequence(F.lit(0), F.lit(max(0, most - 1)), F.lit(wide)), lambda k: F.get(bounds, k))
    known = df.withColumn("_first", F.size(F.filter(leads, passed)))
    near = F.slice(bounds, F.greatest(F.lit(1), (F.col("_first") - 1) * wide + 1), F.lit(wide))
    fine = F.size(F.filter(near, passed))
    return known.withColumn(name, F.when(F.col("_first") == 0, F.lit(0)).otherwise((F.col("_first") - 1) * wide + fine)).drop("_first")
