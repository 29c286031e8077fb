"""Classifier evaluation by distributed threshold curves.

Input is a long table: group columns (model, class, part, ...), Y in {0, 1} and SCORE. Rows are
reduced to counts per distinct score before anything is ordered, so a score shared by very many
rows is one row, and every curve and metric is read from the running counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.functions.exprs import ratio_or_null
from snapmill.operators.ranked import running_sums

GRID = 100
EPS = 1e-15


def class_scores(scored: DataFrame, n_classes: int, keep: list[str], label: str, prefix: str,
                 kind: str | None = None) -> DataFrame:
    """One row per record and class: keep..., CLS, Y (is this the class?), SCORE."""
    entries = F.array(*[F.struct(F.lit(i).alias("CLS"), (F.col(label) == i).cast("int").alias("Y"),
                                 F.col(f"{prefix}{i}").cast("double").alias("SCORE")) for i in range(n_classes)])
    out = scored.select(*keep, F.inline(entries))
    return out if kind is None else out.withColumn("KIND", F.lit(kind))


def cumulated(long: DataFrame, groups: list[str]) -> DataFrame:
    """Per group and distinct score: P, N and their running and total counts, highest score first."""
    counts = (long.where(F.col("SCORE").isNotNull() & F.col("Y").isNotNull())
              .groupBy(*groups, "SCORE")
              .agg(F.sum(F.col("Y").cast("bigint")).alias("P"), F.sum((1 - F.col("Y")).cast("bigint")).alias("N")))
    return running_sums(counts, groups, "SCORE", ["P", "N"], descending=True)


def eval_threshold(long: DataFrame, groups: list[str]) -> DataFrame:
    """Confusion counts and rates when everything scored at least THRESHOLD is called positive."""
    tp, fp = F.col("CUM_P"), F.col("CUM_N")
    return cumulated(long, groups).select(
        *groups, F.col("SCORE").alias("THRESHOLD"),
        tp.alias("TP"), fp.alias("FP"),
        (F.col("TOTAL_N") - fp).alias("TN"), (F.col("TOTAL_P") - tp).alias("FN"),
        ratio_or_null(tp, F.col("TOTAL_P")).alias("TPR"),
        ratio_or_null(fp, F.col("TOTAL_N")).alias("FPR"),
        ratio_or_null(tp, tp + fp).alias("PRECISION"),
        ratio_or_null(tp, F.col("TOTAL_P")).alias("RECALL"))


def eval_roc(long: DataFrame, groups: list[str]) -> DataFrame:
    """ROC points, one per distinct score, and the origin at an infinite threshold."""
    points = eval_threshold(long, groups).select(*groups, "THRESHOLD", "TPR", "FPR")
    start = long.select(*groups).distinct().select(
        *groups, F.lit(float("inf")).alias("THRESHOLD"), F.lit(0.0).alias("TPR"), F.lit(0.0).alias("FPR"))
    return points.unionByName(start)


def eval_pr(long: DataFrame, groups: list[str]) -> DataFrame:
    """Precision-recall points, one per distinct score."""
    return eval_threshold(long, groups).select(*groups, "THRESHOLD", "PRECISION", "RECALL")


def eval_auc(long: DataFrame, groups: list[str]) -> DataFrame:
    """Area under the ROC curve; pairs with equal scores count one half."""
    return cumulated(long, groups).groupBy(*groups).agg(_auc().alias("ROC_AUC"))


def _auc():
    beaten = (F.col("TOTAL_N") - F.col("CUM_N")).cast("double") + F.col("N") / 2.0
    return F.try_divide(F.sum(F.col("P") * beaten), F.max(F.col("TOTAL_P").cast("double") * F.col("TOTAL_N")))


def eval_scores(long: DataFrame, groups: list[str], cut: float = 0.5) -> DataFrame:
    """Eight metrics per group, all from the counts per distinct score."""
    p, n, s = F.col("P"), F.col("N"), F.col("SCORE")
    hit = s >= cut
    total = F.max(F.col("TOTAL_P") + F.col("TOTAL_N")).cast("double")
    clipped = F.least(F.greatest(s, F.lit(EPS)), F.lit(1.0 - EPS))
    tp, fp = F.sum(F.when(hit, p).otherwise(0)), F.sum(F.when(hit, n).otherwise(0))
    tn = F.sum(F.when(~hit, n).otherwise(0))
    stats = cumulated(long, groups).groupBy(*groups).agg(
        _auc().alias("ROC_AUC"),
        F.try_divide(F.sum(p * F.col("CUM_P") / (F.col("CUM_P") + F.col("CUM_N"))),
                     F.max("TOTAL_P").cast("double")).alias("PR_AUC"),
        F.try_divide((tp + tn).cast("double"), total).alias("ACCURACY"),
        F.try_divide(tp.cast("double"), tp + fp).alias("PRECISION"),
        F.try_divide(tp.cast("double"), F.max("TOTAL_P")).alias("RECALL"),
        F.try_divide(2.0 * tp, tp + fp + F.max("TOTAL_P")).alias("F1"),
        F.try_divide(-F.sum(p * F.log(clipped) + n * F.log(1.0 - clipped)), total).alias("LOG_LOSS"),
        F.try_divide(F.sum(p * (1.0 - s) * (1.0 - s) + n * s * s), total).alias("BRIER"),
    )
    return stats


METRICS = ["ROC_AUC", "PR_AUC", "ACCURACY", "PRECISION", "RECALL", "F1", "LOG_LOSS", "BRIER"]


def score_table(stats: DataFrame, models: str = "MODEL", kinds: str = "KIND") -> DataFrame:
    """(METRIC, MODEL, CALIBRATED, RAW) rows from eval_scores grouped by model and kind."""
    long = stats.select(models, kinds, F.inline(F.array(*[
        F.struct(F.lit(m).alias("METRIC"), F.col(m).alias("VALUE")) for m in METRICS])))
    return long.groupBy("METRIC", models).agg(
        F.max(F.when(F.col(kinds) == "CALIB", F.col("VALUE"))).alias("CALIBRATED"),
        F.max(F.when(F.col(kinds) == "PROB", F.col("VALUE"))).alias("RAW"))


def eval_roc_micro(long: DataFrame, groups: list[str]) -> DataFrame:
    """One ROC curve over the rows of all classes."""
    return eval_roc(long, groups)


def eval_pr_micro(long: DataFrame, groups: list[str]) -> DataFrame:
    return eval_pr(long, groups)


def eval_roc_macro(long: DataFrame, groups: list[str], cls: str = "CLS") -> DataFrame:
    """Mean over the classes of the TPR at the FPRs 0.00, 0.01, ..., 1.00.

    A counts row is itself the curve segment from its previous to its own point, so it yields
    the grid points it covers; only 101 rows per class are aggregated. At a vertical step the
    upper end counts.
    """
    n, total = F.col("N"), F.col("TOTAL_N")
    before = F.col("CUM_N") - n
    first = F.ceil(before * GRID / total).cast("int")
    last = F.ceil(F.col("CUM_N") * GRID / total).cast("int") - 1
    tp_before = F.col("CUM_P") - F.col("P")
    reach = F.when(n > 0, (F.col("K") * total / float(GRID) - before) / n).otherwise(0.0)
    segments = cumulated(long, [*groups, cls]).where((n > 0) & (total > 0) & (F.col("TOTAL_P") > 0))
    inner = (segments.where(first <= last)
             .withColumn("K", F.explode(F.sequence(first, last)))
             .select(*groups, cls, "K", ((tp_before + F.col("P") * reach) / F.col("TOTAL_P")).alias("TPR")))
    end = (segments.select(*groups, cls).distinct()
           .select(*groups, cls, F.lit(GRID).alias("K"), F.lit(1.0).alias("TPR")))
    return (inner.unionByName(end).groupBy(*groups, "K")
            .agg(F.avg("TPR").alias("TPR")).select(*groups, (F.col("K") / float(GRID)).alias("FPR"), "TPR"))


def eval_pr_macro(long: DataFrame, groups: list[str], cls: str = "CLS") -> DataFrame:
    """Mean over the classes of the precision at the first threshold that reaches each recall
    0.01, ..., 1.00; precision 1 at recall 0."""
    total = F.col("TOTAL_P")
    first = F.floor((F.col("CUM_P") - F.col("P")) * GRID / total).cast("int") + 1
    last = F.floor(F.col("CUM_P") * GRID / total).cast("int")
    steps = cumulated(long, [*groups, cls]).where(total > 0)
    inner = (steps.where(first <= last)
             .withColumn("K", F.explode(F.sequence(first, last)))
             .select(*groups, cls, "K", (F.col("CUM_P") / (F.col("CUM_P") + F.col("CUM_N"))).alias("PRECISION")))
    start = (steps.select(*groups, cls).distinct()
             .select(*groups, cls, F.lit(0).alias("K"), F.lit(1.0).alias("PRECISION")))
    return (inner.unionByName(start).groupBy(*groups, "K")
            .agg(F.avg("PRECISION").alias("PRECISION"))
            .select(*groups, (F.col("K") / float(GRID)).alias("RECALL"), "PRECISION"))
