"""Column profiles for exploratory analysis, as (COLUMN, STAT, VALUE) rows."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmill.operators.ranked import long_form, quantiles
from snapmill.runtime import collect_bounded

# fixed values: what counts as positive, the reported quantiles, the histogram and the extremes
POSITIVES = ["1", "true", "Y"]
PROBS = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
N_BINS = 20
N_SIGMA = 3.0
ORDINAL_BELOW = 5


def binarized(c: str | Column, positives: list[str] = POSITIVES) -> Column:
    """1 for a positive value, 0 for any other, null for null. Numbers are compared as numbers."""
    source = F.col(c) if isinstance(c, str) else c
    value, hit = source.cast("string"), source.cast("string").isin(positives)
    numbers = [x for x in map(_number, positives) if x is not None]
    if numbers:
        numeric = F.typeof(source).rlike("^(tinyint|smallint|int|bigint|float|double|decimal)")
        hit = F.when(numeric, value.try_cast("double").isin(numbers)).otherwise(hit)
    return F.when(value.isNull(), F.lit(None)).when(hit, 1).otherwise(0)


def _number(text: str) -> float | None:
    try:
        return float(text)
    except ValueError:
        return None


def _counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """TOTAL and MISSING of every column, in one aggregation."""
    agg = df.agg(F.count(F.lit(1)).alias("_N"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    rows = [F.struct(F.lit(c).alias("COLUMN"), F.lit(stat).alias("STAT"), value.cast("double").alias("VALUE"))
            for c in cols for stat, value in (("TOTAL", F.col("_N")), ("MISSING", F.col(c)))]
    return agg.select(F.inline(F.array(*rows)))


def _value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    counts = (long_form(df, cols, "string").where(F.col("VALUE").isNotNull())
              .groupBy("COLUMN", "VALUE").agg(F.count(F.lit(1)).alias("N")))
    return counts.select("COLUMN", F.concat(F.lit("COUNT:"), "VALUE").alias("STAT"),
                         F.col("N").cast("double").alias("VALUE"))


def eda_binary(df: DataFrame, cols: list[str], positives: list[str] = POSITIVES) -> DataFrame:
    """TOTAL, MISSING and the counts of 0 and 1 after binarisation."""
    binary = df.select(*[binarized(c, positives).alias(c) for c in cols])
    return _counts(binary, cols).unionByName(_value_counts(binary, cols))


def eda_nominal(df: DataFrame, cols: list[str]) -> DataFrame:
    """TOTAL, MISSING and a COUNT:<value> row per category."""
    return _counts(df.select(*cols), cols).unionByName(_value_counts(df, cols))


def eda_ordinal(df: DataFrame, column: str, categories: list[str]) -> DataFrame:
    """As eda_nominal for one column, with each category's position; -1 for an undeclared one."""
    position = F.lit(-1)
    for i, c in enumerate(categories):
        position = F.when(F.col("STAT") == f"COUNT:{c}", i).otherwise(position)
    return eda_nominal(df, [column]).withColumn(
        "POSITION", F.when(F.col("STAT").startswith("COUNT:"), position))


@dataclass(frozen=True)
class NumericAttr:
    log_scale: bool = False
    n_sigma: float | None = N_SIGMA
    n_bins: int = N_BINS
    exact: bool = True
    # also FIT_MEAN and FIT_STD: moments of the values clipped at P01 and P99 and filled with P50
    fit: bool = False


def _is_finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def eda_numeric(df: DataFrame, cols: list[str], attr: NumericAttr = NumericAttr()) -> DataFrame:
    """Counts, moments, quantiles, extremes and an equal-width histogram of numeric columns.

    All columns share each pass: one aggregation for counts and moments, one distributed
    quantile pass, and one counting pass for bins and extremes, whose edges come from the first.
    """
    # a column that is not a number counts as missing, like null
    data = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    if attr.log_scale:
        data = data.withColumns({f"LOG:{c}": F.when(F.col(c) > 0, F.log(F.col(c))) for c in cols})
    names = data.columns
    finite = data.select(*[F.when(_is_finite(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) for c in names])

    def per_column(c: str) -> list[Column]:
        x, ok = F.col(f"`{c}`"), F.col(f"`OK:{c}`")
        return [F.struct(
            F.count(F.lit(1)).cast("double").alias("TOTAL"),
            F.count_if(x.isNull()).cast("double").alias("MISSING"),
            F.count_if(x == 0).cast("double").alias("ZEROS"),
            F.count_if(x == float("inf")).cast("double").alias("INFS_POS"),
            F.count_if(x == float("-inf")).cast("double").alias("INFS_NEG"),
            F.avg(ok).alias("MEAN"), F.stddev_samp(ok).alias("STD"),
            F.skewness(ok).alias("SKEW"), F.kurtosis(ok).alias("KURT"),
            F.min(ok).alias("MIN"), F.max(ok).alias("MAX")).alias(c)]

    both = data.withColumns({f"OK:{c}": F.when(_is_finite(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in names})
    moments = {c: v.asDict() for c, v in both.agg(*[s for c in names for s in per_column(c)]).first().asDict().items()}
    fitted = quantiles(finite.toDF(*names), names, PROBS, attr.exact)

    def bin_of(c: str) -> Column:
        x, lo, hi = F.col(f"`{c}`"), moments[c]["MIN"], moments[c]["MAX"]
        if lo is None or lo == hi:
            return F.when(x.isNotNull(), 0)
        raw = F.floor((x - lo) / F.lit((hi - lo) / attr.n_bins)).cast("int")
        return F.when(x.isNotNull(), F.least(raw, F.lit(attr.n_bins - 1)))

    def side_of(c: str) -> Column:
        m, s = moments[c]["MEAN"], moments[c]["STD"]
        x = F.col(f"`{c}`")
        if attr.n_sigma is None or m is None or s is None:
            return F.lit(0)
        return F.when(x < m - attr.n_sigma * s, -1).when(x > m + attr.n_sigma * s, 1).otherwise(0)

    def shifted(c: str) -> Column:
        """The clipped value, less the median."""
        lo, mid, hi = (fitted[c][p] for p in (0.01, 0.5, 0.99))
        if not attr.fit or mid is None:
            return F.lit(0.0)
        return F.least(F.greatest(F.col(f"`{c}`"), F.lit(lo)), F.lit(hi)) - F.lit(mid)

    cells = F.array(*[F.struct(F.lit(c).alias("COLUMN"), bin_of(c).alias("BIN"), side_of(c).alias("SIDE"),
                               F.col(f"`{c}`").alias("X"), shifted(c).alias("C")) for c in names])
    counted = (finite.select(F.inline(cells)).where(F.col("BIN").isNotNull())
               .groupBy("COLUMN", "BIN", "SIDE").agg(F.count(F.lit(1)).alias("N"), F.sum("X").alias("S"),
                                                     F.sum("C").alias("C1"), F.sum(F.col("C") * F.col("C")).alias("C2")))
    bins = collect_bounded(counted, 3 * attr.n_bins * len(names), "histogram")

    rows: list[tuple[str, str, float | None]] = []
    for c in names:
        stats = dict(moments[c])
        stats |= {f"P{round(p * 100):02d}": fitted[c][p] for p in PROBS}
        mine = [b for b in bins if b.COLUMN == c]
        if attr.fit:
            stats |= _fit_moments(stats, mine)
        if attr.n_sigma is not None:
            low = [b for b in mine if b.SIDE == -1]
            high = [b for b in mine if b.SIDE == 1]
            stats["XTREME"] = float(sum(b.N for b in low + high))
            for tag, part in (("LOW", low), ("HIGH", high)):
                n = sum(b.N for b in part)
                stats[f"XTREME_{tag}"] = float(n)
                stats[f"XTREME_{tag}_MEAN"] = sum(b.S for b in part) / n if n else None
        lo, hi = moments[c]["MIN"], moments[c]["MAX"]
        for i in range(attr.n_bins):
            stats[f"HIST_{i:02d}"] = float(sum(b.N for b in mine if b.BIN == i))
            stats[f"EDGE_{i:02d}"] = None if lo is None else lo + i * (hi - lo) / attr.n_bins
        rows += [(c, k, None if v is None else float(v)) for k, v in stats.items()]
    return df.sparkSession.createDataFrame(rows, "COLUMN string, STAT string, VALUE double")


def _fit_moments(stats: dict, cells: list) -> dict[str, float | None]:
    """Mean and population deviation after clipping and filling; a filled value lies at the median."""
    lo, mid, hi, n = stats["P01"], stats["P50"], stats["P99"], stats["TOTAL"]
    if mid is None or not n:
        return {"FIT_MEAN": 0.0, "FIT_STD": 0.0}
    high, low = stats["INFS_POS"], stats["INFS_NEG"]
    first = (sum(b.C1 for b in cells) + high * (hi - mid) + low * (lo - mid)) / n
    second = (sum(b.C2 for b in cells) + high * (hi - mid) ** 2 + low * (lo - mid) ** 2) / n
    return {"FIT_MEAN": mid + first, "FIT_STD": math.sqrt(max(second - first * first, 0.0))}


def guess_dtype(df: DataFrame) -> DataFrame:
    """(COLUMN, DTYPE, N_DISTINCT) with DTYPE Binary, Nominal, Ordinal or Numeric.

    Nulls are ignored. N_DISTINCT stops at 5, which is all the decision needs: columns whose
    sketch shows far more values are not counted exactly.
    """
    sketch = df.agg(*[F.approx_count_distinct(F.col(c).cast("string")).alias(c) for c in df.columns]).first()
    few = [c for c in df.columns if sketch[c] <= 4 * ORDINAL_BELOW]
    exact = {}
    if few:
        distinct = (long_form(df, few, "string").where(F.col("VALUE").isNotNull())
                    .groupBy("COLUMN", "VALUE").count().groupBy("COLUMN").count())
        exact = {r.COLUMN: r["count"] for r in collect_bounded(distinct, len(few), "distinct counts")}
    rows = []
    for f in df.schema:
        n = min(exact.get(f.name, 0), ORDINAL_BELOW) if f.name in few else ORDINAL_BELOW
        if isinstance(f.dataType, T.BooleanType) or n == 2:
            kind = "Binary"
        elif isinstance(f.dataType, T.NumericType):
            kind = "Ordinal" if n < ORDINAL_BELOW else "Numeric"
        else:
            kind = "Nominal"
        rows.append((f.name, kind, n))
    return df.sparkSession.createDataFrame(rows, "COLUMN string, DTYPE string, N_DISTINCT int")


def value_list(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of a column."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def profile_table(df: DataFrame, config: dict[str, dict]) -> DataFrame:
    """Profile of every configured column: {column: {"dtype": ..., "attr": {...}, "preproc": {...}}}.

    Columns of the same type share their passes. Rows also carry the DTYPE, and the CONF of their column,
    its attr and preproc as JSON text, from which prep_from_profile compiles the column's chain.
    """
    def of(dtype: str) -> list[str]:
        return [c for c, conf in config.items() if conf["dtype"] == dtype]

    unknown = [c for c, conf in config.items() if conf["dtype"] not in ("Binary", "Nominal", "Ordinal", "Numeric")]
    if unknown:
        raise ValueError(f"unknown dtype for {unknown}")
    parts = []
    binary: dict[tuple, list[str]] = {}
    for c in of("Binary"):
        binary.setdefault(tuple(config[c].get("attr", {}).get("positives", POSITIVES)), []).append(c)
    for positives, cols in binary.items():
        parts.append(eda_binary(df, cols, list(positives)).withColumn("DTYPE", F.lit("Binary")))
    if of("Nominal"):
        parts.append(eda_nominal(df, of("Nominal")).withColumn("DTYPE", F.lit("Nominal")))
    for c in of("Ordinal"):
        categories = config[c].get("attr", {}).get("categories", [])
        parts.append(eda_ordinal(df, c, categories).drop("POSITION").withColumn("DTYPE", F.lit("Ordinal")))
    numeric: dict[NumericAttr, list[str]] = {}
    for c in of("Numeric"):
        numeric.setdefault(NumericAttr(**{"fit": True, **config[c].get("attr", {})}), []).append(c)
    for attr, cols in numeric.items():
        parts.append(eda_numeric(df, cols, attr).withColumn("DTYPE", F.lit("Numeric")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    conf = F.lit("{}")
    for c, found in config.items():
        text = json.dumps({k: found.get(k, {}) for k in ("attr", "preproc")}, sort_keys=True)
        conf = F.when(F.col("COLUMN").isin(c, f"LOG:{c}"), F.lit(text)).otherwise(conf)
    return out.withColumn("CONF", conf)


def save_profile(profile: DataFrame, root: str, profile_id: str) -> None:
    """Keep a profile under an id; an earlier one of that id is replaced."""
    (profile.withColumn("PROFILE_ID", F.lit(profile_id)).hint("rebalance")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("PROFILE_ID").parquet(root))


def load_profile(spark, root: str, profile_id: str) -> DataFrame:
    found = spark.read.parquet(root).schema
    # ids are text even when they look like numbers
    text = T.StructType([T.StructField(f.name, T.StringType() if f.name == "PROFILE_ID" else f.dataType) for f in found])
    return spark.read.schema(text).parquet(root).where(F.col("PROFILE_ID") == profile_id).drop("PROFILE_ID")
