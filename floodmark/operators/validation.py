"""Validation operators: coverage against ground truth, error metrics and discrepancies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def coverage(pred: DataFrame, truth: DataFrame, keys: Sequence[str] = ("event", "state", "county_fips5")) -> DataFrame:
    """Ground-truth areas with a flag telling whether any prediction falls in them."""
    keys = list(keys)
    seen = pred.select(*keys).distinct().withColumn("_hit", F.lit(1))
    wanted = truth.select(*keys).distinct()
    return wanted.join(seen, keys, "left").withColumn("matched", F.col("_hit").isNotNull()).drop("_hit")


def coverage_rate(cov: DataFrame, by: Sequence[str] = ("event", "state")) -> DataFrame:
    """Matched share of ground-truth areas per group."""
    matched, total = F.count_if("matched"), F.count("*")
    return cov.groupBy(*by).agg(
        matched.alias("matched"), total.alias("gt_total"), F.try_divide(matched, total).alias("coverage_rate"),
    )


def join_truth(est: DataFrame, truth: DataFrame, keys: Sequence[str] = ("event", "county_fips5")) -> DataFrame:
    """Estimates with their truth (actual, else planned) and signed error; rows without truth are dropped."""
    joined = est.join(truth, list(keys), "inner").withColumn("shelter_pop", F.coalesce("actual_shelter", "planned_shelter"))
    return joined.where(F.col("shelter_pop").isNotNull()).withColumn(
        "error", F.col("total_shelter_est") - F.col("shelter_pop")
    )


def error_metrics(df: DataFrame, by: Sequence[str] = (), est: str = "total_shelter_est",
                  truth: str = "shelter_pop") -> DataFrame:
    """Row count, RMSE, MAE, R-squared and both means, overall or per group."""
    e = F.col(est) - F.col(truth)
    n = F.count(e)
    return df.groupBy(*by).agg(
        n.alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (1 - F.try_divide(F.sum(e * e), F.var_pop(truth) * n)).alias("r2"),
        F.avg(truth).alias("mean_truth"), F.avg(est).alias("mean_est"),
    )


def top_discrepancies(df: DataFrame, n: int = 10, fips: str = "county_fips5") -> DataFrame:
    """The ``n`` largest absolute errors with their direction."""
    sized = df.withColumn("abs_error", F.abs("error")).withColumn(
        "direction", F.when(F.col("error") > 0, "OVER").when(F.col("error") < 0, "UNDER").otherwise("EXACT")
    )
    return sized.orderBy(F.col("abs_error").desc(), fips, *[c for c in ("event",) if c in df.columns]).limit(n)
