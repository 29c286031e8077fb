"""Down-sampling and train/test splitting by a reproducible hash of the row key.

A row's position depends on nothing but its key and the seed, so a recomputed task makes the
same choice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmill.config import DEFAULT, EntityConfig
from snapmill.functions.exprs import hash32, hash_uniform, row_key
from snapmill.runtime import collect_bounded, lookup_join

PICK = "IS_PICKED"


def mark_simple(df: DataFrame, frac: float, seed: int = 0, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """IS_PICKED for rows whose hash falls below frac."""
    return df.withColumn(PICK, hash_uniform(row_key(cfg.pk), seed) < F.lit(frac))


def mark_group(df: DataFrame, frac: float, seed: int = 0, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """As mark_simple, hashed on the entity alone: all its rows fall on one side.

    Rows without an entity are one entity.
    """
    place = F.coalesce(hash_uniform(F.col(cfg.entity_key), seed), hash_uniform(F.lit(""), seed))
    return df.withColumn(PICK, place < F.lit(frac))


def mark_stratify(df: DataFrame, frac: float, stratum: str, seed: int = 0,
                  cfg: EntityConfig = DEFAULT) -> DataFrame:
    """IS_PICKED for exactly round(frac * n) rows of each stratum: those with the smallest
    (hash, key).

    The upper 16 bits of the hash give a histogram of at most 65536 rows per stratum. It names
    the bucket in which a stratum reaches its quota; only that bucket, 1/65536 of the stratum,
    is ranked to find the last row taken. Its (hash, key) is the stratum's cutoff, and marking
    is a comparison. Keys are unique, as in any snapshot table. df is read three times.
    """
    key = row_key(cfg.pk)
    hashed = df.withColumns({
        "_KEY": key,
        "_H": hash32(key, seed),
        # null is a stratum of its own; the join must find it
        "_S": F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("null")),
    })
    bucket = F.shiftrightunsigned("_H", 16)
    hist = hashed.groupBy("_S", bucket.alias("_B")).agg(F.count(F.lit(1)).alias("_N"))
    per = Window.partitionBy("_S")
    # the fraction is decimal, so a half rounds up exactly
    quota = F.round(F.lit(str(frac)).cast("decimal(18,9)") * F.sum("_N").over(per), 0).cast("bigint")
    before = F.sum("_N").over(per.orderBy("_B")) - F.col("_N")
    at_quota = (hist.select("_S", "_B", "_N", quota.alias("_Q"), before.alias("_BEFORE"))
                .where((F.col("_BEFORE") < F.col("_Q")) & (F.col("_BEFORE") + F.col("_N") >= F.col("_Q")))
                .select("_S", "_B", (F.col("_Q") - F.col("_BEFORE")).alias("_NEED")))
    in_bucket = lookup_join(hashed.select("_S", "_H", "_KEY", bucket.alias("_B")), at_quota, ["_S", "_B"], "inner")
    rank = F.row_number().over(per.orderBy("_H", "_KEY"))
    cutoff = (in_bucket.withColumn("_R", rank).where(F.col("_R") == F.col("_NEED"))
              .select("_S", F.col("_H").alias("_CUT_H"), F.col("_KEY").alias("_CUT_KEY")))
    picked = (F.col("_H") < F.col("_CUT_H")) | ((F.col("_H") == F.col("_CUT_H")) & (F.col("_KEY") <= F.col("_CUT_KEY")))
    # a stratum without a cutoff has quota 0
    return lookup_join(hashed, cutoff, ["_S"]).select(*df.columns, F.coalesce(picked, F.lit(False)).alias(PICK))


def mark_timeseries(df: DataFrame, frac: float, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """IS_PICKED for the earliest dates that together hold at least frac of the rows.

    The per-date counts are one row per snapshot date; the cutoff becomes a literal.
    """
    counts = collect_bounded(df.groupBy(cfg.dt_key).count(), 100_000, "snapshot dates")
    total, seen, cutoff = sum(r["count"] for r in counts), 0, None
    for r in sorted(counts, key=lambda r: r[cfg.dt_key]):
        seen += r["count"]
        cutoff = r[cfg.dt_key]
        if seen >= frac * total:
            break
    return df.withColumn(PICK, F.col(cfg.dt_key) <= F.lit(cutoff))


def _picked(marked: DataFrame) -> DataFrame:
    return marked.where(PICK).drop(PICK)


def sample_simple(df: DataFrame, frac: float, seed: int = 0, cfg: EntityConfig = DEFAULT) -> DataFrame:
    return _picked(mark_simple(df, frac, seed, cfg))


def sample_stratify(df: DataFrame, frac: float, stratum: str, seed: int = 0,
                    cfg: EntityConfig = DEFAULT) -> DataFrame:
    return _picked(mark_stratify(df, frac, stratum, seed, cfg))


def split(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, test) of a marked table."""
    return _picked(marked), marked.where(~F.col(PICK)).drop(PICK)
