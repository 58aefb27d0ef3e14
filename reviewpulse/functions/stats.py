"""Statistics that need a correction or a fixed convention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fixed_values import PSI_FLOOR


def sample_skewness(value: Column) -> Column:
    """Bias-corrected skewness; null below three values, 0 for constant values."""
    n = F.count(value).cast("double")
    corrected = F.skewness(value) * F.sqrt(n * (n - 1)) / (n - 2)
    return F.when(n >= 3, F.coalesce(corrected, F.lit(0.0)))


def population_stability_index(current: list[Column], baseline: list[Column]) -> Column:
    """PSI of two share vectors, floored and renormalised before comparing."""
    def shares(cols: list[Column]) -> list[Column]:
        floored = [F.greatest(F.least(c, F.lit(1.0)), F.lit(PSI_FLOOR)) for c in cols]
        total = sum(floored[1:], floored[0])
        return [c / total for c in floored]

    terms = [(p - q) * F.ln(p / q) for p, q in zip(shares(current), shares(baseline))]
    return sum(terms[1:], terms[0])


def frequencies(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Value counts per group, nulls left out: the map-side combined input of every exact quantile here.

    A quantile over this table sees one row per distinct value, not one per review.
    """
    by = by or []
    return df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("value")).agg(
        F.count("*").alias("n")
    )


def quantiles(probabilities: list[float]) -> Column:
    """Exact linear-interpolated quantiles of a frequency table."""
    return F.percentile("value", F.array(*[F.lit(p) for p in probabilities]), F.col("n"))


def quantile(probability: float) -> Column:
    return F.percentile("value", F.lit(probability), F.col("n"))


def weighted_mean() -> Column:
    """Mean of a frequency table; null when it is empty."""
    return F.sum(F.col("value") * F.col("n")).cast("double") / F.sum("n")
