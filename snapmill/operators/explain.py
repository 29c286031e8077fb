"""Attributions of model scores to features, and checks of scoring input."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmill.functions.exprs import hash32, row_key
from snapmill.operators.compiled import compile_model
from snapmill.operators.evaluate import eval_auc
from snapmill.runtime import materialize

TOP_FEATURES = 50


def explain_linear(df: DataFrame, weights: dict[str, float], keep: list[str],
                   means: dict[str, float] | None = None) -> DataFrame:
    """Per row and feature w * (x - mean); the means come from df unless given."""
    cols = list(weights)
    if means is None:
        row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
        means = {c: row[f"m{i}"] or 0.0 for i, c in enumerate(cols)}
    return df.select(*keep, *[((F.col(c).cast("double") - F.lit(means[c])) * F.lit(float(w))).alias(c)
                              for c, w in weights.items()])


def explain_global(attributions: DataFrame, cols: list[str], top: int = TOP_FEATURES) -> DataFrame:
    """(COLUMN, MEAN_ABS) of the strongest features, from one aggregation."""
    agg = attributions.agg(*[F.avg(F.abs(F.col(c))).alias(c) for c in cols])
    rows = agg.select(F.inline(F.array(*[F.struct(F.lit(c).alias("COLUMN"), F.col(c).alias("MEAN_ABS")) for c in cols])))
    return rows.orderBy(F.col("MEAN_ABS").desc_nulls_last(), "COLUMN").limit(top)


def permuted(df: DataFrame, cols: list[str], keys: list[str], seed: int = 0) -> DataFrame:
    """df with <c>_PERM: each column's values moved by one place in one random cycle of all rows.

    Rows are ordered by a hash of their keys in range partitions, written once so that a partition's number
    stays valid. Inside a partition a row takes the next row's values, a partition's last row takes those of
    the next partition's first row, and the very last row those of the very first.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)])
    ordered = df.withColumns({"_O": F.struct(hash32(row_key(keys), seed).alias("h"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]),
                              "_V": values})
    ranged = materialize(ordered.repartitionByRange(n, "_O").withColumn("_PART", F.spark_partition_id()))
    # one row per partition
    firsts = ranged.groupBy("_PART").agg(F.min_by("_V", "_O").alias("_FIRST"))
    parts = Window.partitionBy(F.lit(0)).orderBy("_PART")
    whole = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    onward = firsts.select("_PART", F.coalesce(F.lead("_FIRST").over(parts), F.first("_FIRST").over(whole)).alias("_ON"))
    inside = Window.partitionBy("_PART").orderBy("_O")
    moved = ranged.join(F.broadcast(onward), "_PART").withColumn("_N", F.coalesce(F.lead("_V").over(inside), "_ON"))
    return moved.select(*df.columns, *[F.col(f"_N.v{i}").alias(f"{c}_PERM") for i, c in enumerate(cols)])


def explain_tree(model: Model, df: DataFrame, features: list[str], label: str, keys: list[str],
                 seed: int = 0) -> DataFrame:
    """(COLUMN, AUC_DROP): loss of ROC-AUC when a feature's values are permuted.

    A row is repeated once per feature with that feature replaced, and once unchanged, but only while it
    streams through the model's expression; what is shuffled is the column's number, the label and the score.
    """
    compiled = compile_model(model, features)
    wide = permuted(df.select(*keys, label, *features), features, keys, seed)
    turn = wide.withColumn("_I", F.explode(F.sequence(F.lit(0), F.lit(len(features)))))
    rows = turn.select("_I", F.col(label).cast("int").alias("Y"), *[
        F.when(F.col("_I") == i + 1, F.col(f"{c}_PERM")).otherwise(F.col(c)).cast("double").alias(c) for i, c in enumerate(features)])
    scored = compiled.score(rows, ["_I", "Y"]).select("_I", "Y", F.col("PROB_CLS1").alias("SCORE"))
    auc = eval_auc(scored, ["_I"])
    # one row per feature and one for the unchanged rows
    base = F.max(F.when(F.col("_I") == 0, F.col("ROC_AUC"))).over(Window.partitionBy(F.lit(0)))
    names = F.array(*[F.lit(c) for c in features])
    return (auc.select("_I", (base - F.col("ROC_AUC")).alias("AUC_DROP")).where("_I > 0")
            .select(F.element_at(names, F.col("_I")).alias("COLUMN"), "AUC_DROP"))


def input_validate(df: DataFrame, required: T.StructType) -> DataFrame:
    """Scoring input cut to the required columns and types.

    Raises ValueError for missing columns and TypeError when a value cannot be cast; one
    aggregation checks all columns.
    """
    missing = [f.name for f in required if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    bad = df.agg(*[F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name)
                   for f in required]).first()
    failed = [f.name for f in required if bad[f.name]]
    if failed:
        raise TypeError(f"values do not fit the required types: {failed}")
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in required])
