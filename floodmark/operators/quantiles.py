"""Exact quantiles per group, without holding a group in one task.

The values are first counted, so the shuffle is keyed by (group, value) and a hot group is
spread over all partitions.  A fixed monotone bucket of the value then narrows the search:
bucket totals give the bucket that holds each wanted rank, and only the values of those
buckets are ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .joins import as_lookup

# A bucket spans about 0.01 % of the value: a key has at most some 10^5 buckets, and a bucket
# about that share of a large key's values, so both windows below stay small.
BUCKETS_PER_E_FOLD = 8192


def _bucket(value):
    v = F.col(value)
    return F.floor(F.signum(v) * F.log1p(F.abs(v)) * BUCKETS_PER_E_FOLD).cast("bigint")


def quantiles_of_counts(counts: DataFrame, keys: Sequence[str], probs: dict[str, float],
                        value: str = "value", n: str = "n") -> DataFrame:
    """Linear-interpolation quantiles of a (keys, value, n) frequency table: one row per key.

    ``probs`` maps output column to probability.  NULL and NaN values are ignored.
    """
    keys = list(keys)
    rows = counts.where(F.col(value).isNotNull() & ~F.isnan(value)).withColumn("_b", _bucket(value))

    in_key = Window.partitionBy(*keys)
    upto = in_key.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    buckets = (
        rows.groupBy(*keys, "_b").agg(F.sum(n).alias("_bn"))
        .withColumn("_end", F.sum("_bn").over(upto))
        .withColumn("_total", F.sum("_bn").over(in_key))
        .withColumn("_start", F.col("_end") - F.col("_bn"))
    )

    def position(p):
        return (F.col("_total") - 1) * F.lit(float(p))

    wanted = None
    for p in set(probs.values()):
        for rank in (F.floor(position(p)), F.ceil(position(p))):
            test = (rank >= F.col("_start")) & (rank < F.col("_end"))
            wanted = test if wanted is None else wanted | test
    hit = buckets.where(wanted).select(*keys, "_b", "_start", "_total")

    in_bucket = Window.partitionBy(*keys, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    # A key has two ranks for each probability at most, so this table is small beside the values.
    ranked = (
        as_lookup(hit).join(rows, [*keys, "_b"], "inner")
        .withColumn("_last", F.col("_start") + F.sum(n).over(in_bucket) - 1)
        .withColumn("_first", F.col("_last") - F.col(n) + 1)
    )

    aggs = []
    for name, p in probs.items():
        for side, rank in (("lo", F.floor(position(p))), ("hi", F.ceil(position(p)))):
            at = F.when((rank >= F.col("_first")) & (rank <= F.col("_last")), F.col(value))
            aggs.append(F.max(at).alias(f"_{side}_{name}"))
        aggs.append(F.max(position(p) - F.floor(position(p))).alias(f"_frac_{name}"))
    picked = ranked.groupBy(*keys).agg(*aggs)
    return picked.select(
        *keys,
        *[
            (F.col(f"_lo_{q}") + (F.col(f"_hi_{q}") - F.col(f"_lo_{q}")) * F.col(f"_frac_{q}")).alias(q)
            for q in probs
        ],
    )
