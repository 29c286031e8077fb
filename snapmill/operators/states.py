"""Numeric profiles as mergeable states: one scan per snapshot, merged over dates without the data.

A state is one row per column: counts, moments around the mean, extremes and a KLL sketch of the values. All
columns share one aggregation. States of snapshots, or of parts of one, merge exactly in counts, moments and
extremes; quantiles of a sketch with parameter k are off by at most RANK_ERROR[k] of the rows in rank
(with 99 % confidence), also after merging. Exact quantiles stay with profile.eda_numeric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmill.operators.profile import PROBS

K = 1_600
# fixed values: normalised rank error of a KLL sketch at its parameter
RANK_ERROR = {200: 0.0133, 400: 0.0070, 800: 0.0037, 1_600: 0.0020}
STATE = ("COLUMN string, TOTAL bigint, MISSING bigint, ZEROS bigint, INFS_POS bigint, INFS_NEG bigint, N bigint, "
         "MEAN double, M2 double, M3 double, M4 double, MIN double, MAX double, SKETCH binary")


def profile_states(df: DataFrame, cols: list[str], k: int = K, by: list[str] | None = None) -> DataFrame:
    """(by..., state) rows of numeric columns, from one aggregation.

    A value that is not a number counts as missing; infinities are counted and take no part in moments and
    quantiles. A column without finite values has null moments and no sketch.
    """
    def of(c: str) -> Column:
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        ok = F.when(F.abs(x) < float("inf"), x)
        n, sd = F.count(ok), F.stddev_pop(ok)
        return F.struct(
            F.lit(c).alias("COLUMN"), F.count(F.lit(1)).alias("TOTAL"), F.count_if(x.isNull()).alias("MISSING"), F.count_if(x == 0).alias("ZEROS"),
            F.count_if(x == float("inf")).alias("INFS_POS"), F.count_if(x == float("-inf")).alias("INFS_NEG"), n.alias("N"),
            F.avg(ok).alias("MEAN"), (F.var_pop(ok) * n).alias("M2"),
            # skewness and kurtosis are undefined without spread, their moments are zero
            F.when(n > 0, F.coalesce(F.nanvl(F.skewness(ok), F.lit(0.0)) * n * sd * sd * sd, F.lit(0.0))).alias("M3"),
            F.when(n > 0, F.coalesce((F.nanvl(F.kurtosis(ok), F.lit(0.0)) + 3) * n * F.pow(sd, F.lit(4.0)), F.lit(0.0))).alias("M4"),
            F.min(ok).alias("MIN"), F.max(ok).alias("MAX"), F.when(n > 0, F.kll_sketch_agg_double(ok, k)).alias("SKETCH"))

    rows = df.groupBy(*(by or [])).agg(F.array(*[of(c) for c in cols]).alias("_S"))
    return rows.select(*(by or []), F.inline("_S"))


def merge_states(states: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One state per (by..., column) of many: the state of all their rows together."""
    groups = [*(by or []), "COLUMN"]
    n, mean = F.col("N"), F.col("MEAN")
    # the merged mean first; the parts' moments are then moved to it
    totals = states.groupBy(*groups).agg(
        *[F.sum(c).alias(c) for c in ("TOTAL", "MISSING", "ZEROS", "INFS_POS", "INFS_NEG", "N")],
        F.try_divide(F.sum(n * mean), F.sum("N")).alias("MEAN"), F.min("MIN").alias("MIN"), F.max("MAX").alias("MAX"),
        F.kll_merge_agg_double("SKETCH").alias("_SKETCH"),
        F.collect_list(F.when(n > 0, F.struct(*[F.col(c) for c in ("N", "MEAN", "M2", "M3", "M4")]))).alias("_PARTS"))

    def moved(order: int) -> Column:
        def of(p: Column) -> Column:
            d, m = p["MEAN"] - F.col("MEAN"), p["N"].cast("double")
            if order == 2:
                return p["M2"] + m * d * d
            if order == 3:
                return p["M3"] + 3 * d * p["M2"] + m * d * d * d
            return p["M4"] + 4 * d * p["M3"] + 6 * d * d * p["M2"] + m * d * d * d * d

        return F.when(F.col("N") > 0, F.aggregate("_PARTS", F.lit(0.0), lambda a, p: a + of(p)))

    return totals.select(*(by or []), "COLUMN", "TOTAL", "MISSING", "ZEROS", "INFS_POS", "INFS_NEG", "N", "MEAN",
                         moved(2).alias("M2"), moved(3).alias("M3"), moved(4).alias("M4"), "MIN", "MAX",
                         F.when(F.col("N") > 0, F.col("_SKETCH")).alias("SKETCH"))


def state_profile(states: DataFrame, by: list[str] | None = None, probs: list[float] = PROBS) -> DataFrame:
    """(by..., COLUMN, STAT, VALUE) rows with the names of profile.eda_numeric, without histogram and far values."""
    n, m2 = F.col("N").cast("double"), F.col("M2")
    stats = {c: F.col(c).cast("double") for c in ("TOTAL", "MISSING", "ZEROS", "INFS_POS", "INFS_NEG", "MEAN", "MIN", "MAX")}
    stats["STD"] = F.when(F.col("N") > 1, F.sqrt(m2 / (n - 1)))
    stats["SKEW"] = F.when(m2 > 0, F.sqrt(n) * F.col("M3") / F.pow(m2, F.lit(1.5)))
    stats["KURT"] = F.when(m2 > 0, n * F.col("M4") / (m2 * m2) - 3)
    for p in probs:
        stats[f"P{round(p * 100):02d}"] = F.when(F.col("N") > 0, F.kll_sketch_get_quantile_double("SKETCH", F.lit(p)))
    rows = F.array(*[F.struct(F.lit(k).alias("STAT"), v.alias("VALUE")) for k, v in stats.items()])
    return states.select(*(by or []), "COLUMN", F.inline(rows))
