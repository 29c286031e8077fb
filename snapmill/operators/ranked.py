"""Running sums over a total order, and exact quantiles, without a single-task window."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from snapmill.runtime import materialize

PART = "_PART"


def running_sums(df: DataFrame, groups: list[str], order: str, sums: list[str], descending: bool = False) -> DataFrame:
    """df with CUM_<c> (running sum up to and including the row) and TOTAL_<c> for each c of sums.

    df has one row per (groups, order) and no nulls in them. It is range-partitioned by that
    order and written once, so the partition number is a stored value and stays valid when a
    task is repeated. Each part is summed on its own and shifted by the total of the parts
    before it; the table of parts has at most (partitions + groups) rows.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.col(order).desc() if descending else F.col(order).asc()
    ranged = materialize(df.repartitionByRange(n, *[F.col(g) for g in groups], key)
                         .withColumn(PART, F.spark_partition_id()))
    parts = ranged.groupBy(*groups, PART).agg(*[F.sum(c).alias(f"_P_{c}") for c in sums])
    whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *groups, PART,
        *[F.coalesce(F.sum(f"_P_{c}").over(earlier), F.lit(0)).alias(f"_B_{c}") for c in sums],
        *[F.sum(f"_P_{c}").over(whole).alias(f"TOTAL_{c}") for c in sums])
    inside = Window.partitionBy(*groups, PART).orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    # join and window share the key (groups, part): one shuffle serves both
    return ranged.join(offsets, [*groups, PART]).select(
        *df.columns,
        *[(F.col(f"_B_{c}") + F.sum(c).over(inside)).alias(f"CUM_{c}") for c in sums],
        *[f"TOTAL_{c}" for c in sums])


def long_form(df: DataFrame, cols: list[str], value_type: str = "double", keep: list[str] | None = None) -> DataFrame:
    """(keep..., COLUMN, VALUE) rows of the given columns. The unpivot is a narrow step."""
    entries = F.array(*[F.struct(F.lit(c).alias("COLUMN"), F.col(c).cast(value_type).alias("VALUE")) for c in cols])
    return df.select(*(keep or []), F.inline(entries))


# at most this many distinct values inside all brackets are counted out; above, brackets are narrowed
BRACKET_VALUES = 200_000
SKETCH_ACCURACY = 10_000


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    bracket_values: int = BRACKET_VALUES, accuracy: int = SKETCH_ACCURACY) -> dict[str, dict[float, float]]:
    """Linearly interpolated quantiles of the non-null values of each column.

    A sketch brackets every quantile; one counting job then gives the exact number of values
    between the brackets and each distinct value inside them. Only those are shuffled and
    collected, about a thousandth of the rows; where they are too many, a second sketch narrows
    the brackets. The counts prove that the wanted ranks lie inside their bracket, otherwise it
    is widened, so the result does not depend on the sketch.
    """
    names = {c: f"q{i}" for i, c in enumerate(cols)}
    data = df.select(*[F.col(f"`{c}`").cast("double").alias(q) for c, q in names.items()])
    around = [min(max(p + side * 2.0 / accuracy, 0.0), 1.0) for p in probs for side in (-1, 1)]
    sketch = data.agg(*[x for q in names.values() for x in (
        F.count(q).alias(f"{q}_n"), F.percentile_approx(q, around, accuracy).alias(f"{q}_s"))]).first()
    ranks: dict[tuple[str, int], tuple[int, int, float]] = {}
    brackets: dict[tuple[str, int], tuple[float, float]] = {}
    for q in names.values():
        for i, p in enumerate(probs if sketch[f"{q}_n"] else []):
            pos = p * (sketch[f"{q}_n"] - 1)
            ranks[q, i] = (math.floor(pos), math.ceil(pos), pos - math.floor(pos))
            brackets[q, i] = (sketch[f"{q}_s"][2 * i], sketch[f"{q}_s"][2 * i + 1])
    found: dict[tuple[str, int], tuple[float, float]] = {}
    # every bracket needs a few values; the doubling below ends the narrowing in any case
    limit = max(bracket_values, 16 * len(brackets))
    while len(found) < len(ranks):
        open_ = {k: b for k, b in brackets.items() if k not in found}
        cells = _bracket_cells(data, open_, True, limit)
        too_many = cells is None
        if too_many:
            cells = _bracket_cells(data, open_, False, limit)
        crowded = {}
        by_column: dict[str, list] = {}
        for c in cells:
            by_column.setdefault(c.Q, []).append(c)
        for key, (lo, hi) in open_.items():
            mine = by_column[key[0]]
            below = sum(c.N for c in mine if c.FIRST < lo or (math.isnan(lo) and not math.isnan(c.FIRST)))
            n_in = sum(c.N for c in mine if not (c.FIRST < lo) and not (c.FIRST > hi) and
                       (math.isnan(hi) or not math.isnan(c.FIRST)) and (not math.isnan(lo) or math.isnan(c.FIRST)))
            lo_rank, hi_rank, _ = ranks[key]
            if lo_rank < below:
                brackets[key] = (-math.inf, hi)
            elif hi_rank >= below + n_in:
                brackets[key] = (lo, math.nan)
            elif too_many:
                crowded[key] = (below, n_in)
            else:
                values = sorted((c.VALUE, c.N) for c in mine if c.VALUE is not None and not (c.VALUE < lo))
                nans = sum(c.N for c in mine if math.isnan(c.FIRST))
                found[key] = (_value_at(values, nans, lo_rank - below), _value_at(values, nans, hi_rank - below))
        if crowded:
            _narrow(data, brackets, ranks, crowded, accuracy)
            limit *= 2
    out: dict[str, dict[float, float]] = {}
    for c, q in names.items():
        out[c] = {p: None for p in probs}
        for i, p in enumerate(probs):
            if (q, i) in found:
                lo, hi = found[q, i]
                out[c][p] = lo if lo == hi else lo + (hi - lo) * ranks[q, i][2]
    return out


def _value_at(values: list[tuple[float, int]], nans: int, rank: int) -> float:
    for v, n in values:
        if rank < n:
            return v
        rank -= n
    return math.nan


def _bracket_cells(data: DataFrame, brackets: dict, with_values: bool, limit: int) -> list | None:
    """Counts per column and cell, the cells being cut at the bracket ends; inside brackets also per
    distinct value. None when there are more than limit of these. FIRST is the cell's lower end.

    Cells are found by binary search. A closed end b is the cut at the next double above b, so
    that counts of values < lo and <= hi are sums of whole cells.
    """
    cuts: dict[str, list[float]] = {}
    for (q, _), (lo, hi) in brackets.items():
        ends = [x for x in (lo, math.nextafter(hi, math.inf)) if math.isfinite(x)]
        cuts.setdefault(q, []).extend(ends)
    # without a finite end any cut will do
    splits = {q: [-math.inf, *sorted(set(ends) or {0.0}), math.inf] for q, ends in cuts.items()}
    cols = list(splits)
    binned = Bucketizer(inputCols=cols, outputCols=[f"{q}_b" for q in cols], splitsArray=[splits[q] for q in cols],
                        handleInvalid="keep").transform(data)
    entries = []
    for q in cols:
        inside = [i for i, first in enumerate(splits[q][:-1]) if any(
            k == q and not (first < lo) and (math.isnan(hi) or first <= hi) for (k, _), (lo, hi) in brackets.items())]
        cell = F.col(f"{q}_b").cast("int")
        value = F.when(cell.isin(inside), F.col(q)) if with_values and inside else F.lit(None).cast("double")
        entries.append(F.struct(F.lit(q).alias("Q"), cell.alias("CELL"), value.alias("VALUE")))
    counts = (binned.select(F.inline(F.array(*entries))).where(F.col("CELL").isNotNull())
              .groupBy("Q", "CELL", "VALUE").agg(F.count(F.lit(1)).alias("N")))
    n_cells = sum(len(s) + 1 for s in splits.values())
    rows = counts.limit(limit + n_cells + 1).collect()
    if len(rows) > limit + n_cells:
        return None
    # the cell after the last one holds NaN
    return [Row(Q=r.Q, VALUE=r.VALUE, N=r.N,
                FIRST=math.nan if r.CELL >= len(splits[r.Q]) - 1 else splits[r.Q][r.CELL]) for r in rows]


def _narrow(data: DataFrame, brackets: dict, ranks: dict, crowded: dict, accuracy: int) -> None:
    """Replace each crowded bracket by the part of it around its ranks."""
    aggs = {}
    for (q, i), (below, n_in) in crowded.items():
        lo, hi = brackets[q, i]
        inside = F.col(q) >= F.lit(lo)
        inside = inside if math.isnan(hi) else inside & (F.col(q) <= F.lit(hi))
        shares = [min(max((r - below) / n_in + side * 2.0 / accuracy, 0.0), 1.0)
                  for r, side in ((ranks[q, i][0], -1), (ranks[q, i][1], 1))]
        aggs[q, i] = F.percentile_approx(F.when(inside, F.col(q)), shares, accuracy).alias(f"{q}_{i}")
    row = data.agg(*aggs.values()).first()
    for q, i in aggs:
        brackets[q, i] = tuple(row[f"{q}_{i}"])


def approx_quantiles(df: DataFrame, cols: list[str], probs: list[float], accuracy: int = 10_000) -> dict[str, dict[float, float]]:
    """The same by one pass with bounded sketches; the rank error is at most n / accuracy."""
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(c) for c in cols]).first()
    return {c: dict(zip(probs, row[c] or [None] * len(probs), strict=True)) for c in cols}


def quantiles(df: DataFrame, cols: list[str], probs: list[float], exact: bool = True) -> dict[str, dict[float, float]]:
    if not cols:
        return {}
    return exact_quantiles(df, cols, probs) if exact else approx_quantiles(df, cols, probs)
