"""Preprocessing. A fit computes a few numbers per column; a transform is one select.

Fitted values are O(columns) and become literals of the select, so applying them needs neither
a join nor a Python function.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmill.config import DEFAULT, EntityConfig
from snapmill.functions.exprs import hash_uniform, row_key
from snapmill.operators.profile import POSITIVES, binarized
from snapmill.operators.ranked import long_form, quantiles, running_sums
from snapmill.runtime import collect_bounded, lookup_join

# fixed values: fills for missing values, clipping quantiles, and the number of categories kept
BINARY_FILL = -1
TEXT_FILL = "Missing"
OTHER = "Other"
CLIP = (0.01, 0.99)
MAX_CATEGORIES = 10


def prep_binarize(df: DataFrame, cols: list[str], positives: list[str] = POSITIVES) -> DataFrame:
    """1 for the positive values, 0 for others, null stays null."""
    return df.withColumns({c: binarized(c, positives) for c in cols})


def prep_impute_const(df: DataFrame, fills: dict[str, object], indicator: bool = False) -> DataFrame:
    """Fill nulls with a constant; optionally add <column>_MISSING as 0/1."""
    marks = {f"{c}_MISSING": F.col(c).isNull().cast("int") for c in fills} if indicator else {}
    out = df.withColumns(marks) if marks else df
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})


def fit_clip(df: DataFrame, cols: list[str], bounds: tuple[float, float] = CLIP,
             exact: bool = True) -> dict[str, tuple[float, float]]:
    fitted = quantiles(df, cols, list(bounds), exact)
    return {c: (fitted[c][bounds[0]], fitted[c][bounds[1]]) for c in cols}


def _clipped(c: Column, lo: float | None, hi: float | None) -> Column:
    value = c.cast("double")
    if lo is None:
        return value
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(lo)), F.lit(hi)))


def prep_clip(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    """Cap at the fitted bounds; null stays null."""
    return df.withColumns({c: _clipped(F.col(c), lo, hi) for c, (lo, hi) in fitted.items()})


def fit_median(df: DataFrame, cols: list[str], exact: bool = True) -> dict[str, float]:
    return {c: v[0.5] for c, v in quantiles(df, cols, [0.5], exact).items()}


def prep_impute_median(df: DataFrame, fitted: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in fitted.items()})


def fit_standardize(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """(mean, scale) per column; a constant column has scale 1."""
    row = df.agg(*[s for i, c in enumerate(cols) for s in (
        F.avg(F.col(c).cast("double")).alias(f"m{i}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}"))]).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(cols)}


def prep_standardize(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in fitted.items()})


def fit_categories(df: DataFrame, cols: list[str], limit: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """The categories each column keeps: all of them up to limit, else the limit - 1 most frequent
    (ties by value), which leaves one place for the rest."""
    counts = (long_form(df, cols, "string").where(F.col("VALUE").isNotNull())
              .groupBy("COLUMN", "VALUE").agg(F.count(F.lit(1)).alias("N")))
    # the rank filter is pushed below the shuffle as a per-partition limit, so a column with very
    # many categories sends at most limit + 1 rows per task
    rank = F.row_number().over(Window.partitionBy("COLUMN").orderBy(F.col("N").desc(), "VALUE"))
    top = counts.withColumn("RANK", rank).where(F.col("RANK") <= limit + 1)
    rows = collect_bounded(top, (limit + 1) * len(cols), "categories")
    out = {}
    for c in cols:
        ranked = [r.VALUE for r in sorted(rows, key=lambda r: r.RANK) if r.COLUMN == c]
        out[c] = ranked if len(ranked) <= limit else ranked[:limit - 1]
    return out


def _bucketed(c: Column, kept: list[str]) -> Column:
    text = c.cast("string")
    return F.when(text.isNull() | text.isin(kept), text).otherwise(F.lit(OTHER))


def prep_bucket_rare(df: DataFrame, fitted: dict[str, list[str]]) -> DataFrame:
    """Categories that are not kept become 'Other'; null stays null."""
    return df.withColumns({c: _bucketed(F.col(c), kept) for c, kept in fitted.items()})


def _onehot(c: Column, name: str, categories: list[str]) -> list[Column]:
    return [F.coalesce((c == v).cast("double"), F.lit(0.0)).alias(f"{name}_{v}") for v in categories]


def prep_onehot(df: DataFrame, fitted: dict[str, list[str]]) -> DataFrame:
    """A 0/1 column per category in place of the source column; an unknown one is all zeros."""
    rest = [F.col(c) for c in df.columns if c not in fitted]
    return df.select(*rest, *[o for c, cats in fitted.items() for o in _onehot(F.col(c).cast("string"), c, cats)])


def prep_float(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """All columns as double, except those to keep (the group column)."""
    return df.select(*[F.col(c) if c in (keep or []) else F.col(c).cast("double").alias(c) for c in df.columns])


# --- encoders with one row per category; the number of categories is not bounded -------------

UNKNOWN_CODE = -1
MISSING_CODE = -2


def fit_ordinal(df: DataFrame, column: str) -> DataFrame:
    """(column, CODE) dictionary: position of each category in value order, from 1."""
    values = (df.select(F.col(column).cast("string").alias(column)).where(F.col(column).isNotNull())
              .groupBy(column).agg(F.lit(1).cast("bigint").alias("ONE")))
    return running_sums(values, [], column, ["ONE"]).select(column, F.col("CUM_ONE").alias("CODE"))


def enc_ordinal(df: DataFrame, column: str, dictionary: DataFrame, out: str | None = None) -> DataFrame:
    """Category codes; unknown and missing have codes of their own."""
    joined = lookup_join(df.withColumn(column, F.col(column).cast("string")), dictionary, [column])
    code = F.when(F.col(column).isNull(), MISSING_CODE).otherwise(F.coalesce("CODE", F.lit(UNKNOWN_CODE)))
    return joined.withColumn(out or f"{column}_CODE", code.cast("bigint")).drop("CODE")


def fit_woe(df: DataFrame, column: str, label: str, a: float = 1.0) -> DataFrame:
    """(CATEGORY, WOE): log ratio of a category's share of positives and of negatives, smoothed by a.

    A null category is one of its own; rows without a label do not count.
    """
    y = F.col(label).cast("bigint")
    df = df.where(y.isNotNull())
    counts = df.groupBy(F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null")).alias("CATEGORY")).agg(
        F.sum(y).alias("P"), F.sum(1 - y).alias("N"))
    total = df.agg(F.sum(y).alias("P"), F.sum(1 - y).alias("N")).first()
    pos = (F.col("P") + a) / F.lit(float((total.P or 0) + 2 * a))
    neg = (F.col("N") + a) / F.lit(float((total.N or 0) + 2 * a))
    return counts.select("CATEGORY", F.log(pos / neg).alias("WOE"))


def enc_woe(df: DataFrame, column: str, fitted: DataFrame, out: str | None = None, sigma: float = 0.0,
            seed: int = 0, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Weight of evidence per row; 0 for an unseen category. sigma adds normal noise drawn from
    the row key, for training rows only."""
    keyed = df.withColumn("CATEGORY", F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null")))
    woe = F.coalesce("WOE", F.lit(0.0))
    if sigma:
        u1 = F.greatest(hash_uniform(row_key(cfg.pk), seed), F.lit(1e-12))
        u2 = hash_uniform(row_key(cfg.pk), seed + 1)
        woe = woe * (1.0 + F.lit(sigma) * F.sqrt(-2.0 * F.log(u1)) * F.cos(u2 * 6.283185307179586))
    return lookup_join(keyed, fitted, ["CATEGORY"]).withColumn(out or f"{column}_WOE", woe).drop("CATEGORY", "WOE")


# --- whole-table chains ----------------------------------------------------------------------

@dataclass
class ColumnPrep:
    """Fitted chain of one column."""

    kind: str                                   # binary, numeric or text
    clip: tuple[float, float] | None = None
    fill: float | str | None = None
    center: tuple[float, float] = (0.0, 1.0)
    kept: list[str] = field(default_factory=list)
    categories: list[str] = field(default_factory=list)
    positives: list[str] = field(default_factory=lambda: list(POSITIVES))

    def select(self, name: str) -> list[Column]:
        c = F.col(name)
        if self.kind == "binary":
            flag = binarized(name, self.positives)
            return [F.coalesce(flag, F.lit(self.fill)).cast("double").alias(name),
                    c.isNull().cast("double").alias(f"{name}_MISSING")]
        if self.kind == "numeric":
            lo, hi = self.clip or (None, None)
            mean, scale = self.center
            value = F.coalesce(_clipped(c, lo, hi), F.lit(self.fill).cast("double"))
            return [((value - F.lit(mean)) / F.lit(scale)).alias(name)]
        text = _bucketed(F.coalesce(c.cast("string"), F.lit(self.fill)), self.kept)
        return _onehot(text, name, self.categories)

    def outputs(self, name: str) -> list[str]:
        if self.kind == "binary":
            return [name, f"{name}_MISSING"]
        return [name] if self.kind == "numeric" else [f"{name}_{v}" for v in self.categories]


@dataclass
class TablePrep:
    """Fitted chains of a table. Columns outside it are dropped, except those to keep."""

    columns: dict[str, ColumnPrep]

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        return df.select(*(keep or []), *[e for c, p in self.columns.items() for e in p.select(c)])

    def outputs(self) -> list[str]:
        return [o for c, p in self.columns.items() for o in p.outputs(c)]

    def to_json(self) -> str:
        return json.dumps({c: asdict(p) for c, p in self.columns.items()})

    @classmethod
    def from_json(cls, text: str) -> TablePrep:
        return cls({c: ColumnPrep(**p) for c, p in json.loads(text).items()})


def column_kind(dtype: T.DataType) -> str | None:
    """binary, numeric or text; None for dates, timestamps and nested types, which are dropped."""
    if isinstance(dtype, T.BooleanType):
        return "binary"
    if isinstance(dtype, T.NumericType):
        return "numeric"
    if isinstance(dtype, T.StringType):
        return "text"
    return None


def fit_by_kind(df: DataFrame, kinds: dict[str, str], exact: bool = True,
                positives: dict[str, list[str]] | None = None) -> TablePrep:
    """Fit the chain of each column: one quantile pass, one moments pass, one category pass."""
    numeric = [c for c, k in kinds.items() if k == "numeric"]
    text = [c for c, k in kinds.items() if k == "text"]
    fitted: dict[str, ColumnPrep] = {}
    q = quantiles(df, numeric, [CLIP[0], 0.5, CLIP[1]], exact)
    # clipping keeps the order, so the median of the clipped values is the clipped median
    chains = {c: ColumnPrep("numeric", (q[c][CLIP[0]], q[c][CLIP[1]]), 0.0 if q[c][0.5] is None else q[c][0.5])
              if q[c][0.5] is not None else ColumnPrep("numeric", None, 0.0) for c in numeric}
    if numeric:
        center = fit_standardize(df.select(*[p.select(c)[0] for c, p in chains.items()]), numeric)
        for c in numeric:
            chains[c].center = center[c]
    filled = df.select(*[F.coalesce(F.col(c), F.lit(TEXT_FILL)).alias(c) for c in text]) if text else None
    kept = fit_categories(filled, text) if text else {}
    merged = {}
    if text:
        seen = prep_bucket_rare(filled, kept)
        merged = fit_categories(seen, text)
    for c, k in kinds.items():
        if k == "binary":
            fitted[c] = ColumnPrep("binary", fill=BINARY_FILL, positives=(positives or {}).get(c, list(POSITIVES)))
        elif k == "numeric":
            fitted[c] = chains[c]
        elif k == "text":
            fitted[c] = ColumnPrep("text", fill=TEXT_FILL, kept=kept[c], categories=sorted(merged[c]))
    return TablePrep(fitted)


def fit_by_dtype(df: DataFrame, cfg: EntityConfig = DEFAULT, exact: bool = True,
                 skip: list[str] | None = None) -> TablePrep:
    """Chains chosen by column type; the keys, the target and dates are left out."""
    left_out = {cfg.entity_key, cfg.dt_key, cfg.target_key, *(skip or [])}
    kinds = {f.name: column_kind(f.dataType) for f in df.schema if f.name not in left_out}
    return fit_by_kind(df, {c: k for c, k in kinds.items() if k}, exact)


# fixed values: what a column's preproc may set, and its default
PREPROC = {"binarize": True, "clip": True, "impute": True, "standardize": True, "max_categories": MAX_CATEGORIES}


def prep_from_profile(profile: DataFrame) -> TablePrep:
    """Chains built from a saved table profile alone, without the data.

    A column's chain follows its dtype and the attr and preproc kept with the profile: positives of a
    flag; for a number whether to clip at P01 and P99, fill with P50, and standardise by the moments of
    the clipped and filled values; for a category how many to keep. Without impute a missing number
    becomes 0 after standardising, the mean; a missing flag stays a code of its own.
    """
    per_category = F.col("STAT").startswith("COUNT:")
    rank = F.row_number().over(Window.partitionBy("COLUMN").orderBy(F.col("VALUE").desc(), "STAT"))
    stats_used = ["P01", "P50", "P99", "MEAN", "STD", "FIT_MEAN", "FIT_STD", "TOTAL", "MISSING"]
    if "CONF" not in profile.columns:
        profile = profile.withColumn("CONF", F.lit("{}"))
    named = profile.where(~per_category & F.col("STAT").isin(stats_used))
    n_cols = profile.select("COLUMN").distinct().count()
    stats: dict[str, dict] = {}
    for r in collect_bounded(named, len(stats_used) * n_cols, "profile"):
        conf = json.loads(r.CONF)
        preproc = {**PREPROC, **conf.get("preproc", {})}
        if unknown := set(preproc) - set(PREPROC):
            raise ValueError(f"unknown preproc of {r.COLUMN}: {sorted(unknown)}")
        stats.setdefault(r.COLUMN, {"DTYPE": r.DTYPE, "ATTR": conf.get("attr", {}), "PREPROC": preproc})[r.STAT] = r.VALUE
    most = max([s["PREPROC"]["max_categories"] for s in stats.values()], default=MAX_CATEGORIES)
    top = profile.where(per_category).withColumn("RANK", rank).where(F.col("RANK") <= most + 1)
    for r in sorted(collect_bounded(top, (most + 1) * n_cols, "profile"), key=lambda r: r.RANK):
        stats[r.COLUMN].setdefault("CATEGORIES", []).append((r.STAT.removeprefix("COUNT:"), r.VALUE))
    fitted = {}
    for c, s in sorted(stats.items()):
        if c.startswith("LOG:"):
            continue
        how = s["PREPROC"]
        if s["DTYPE"] == "Binary":
            positives = list(s["ATTR"].get("positives", POSITIVES)) if how["binarize"] else list(POSITIVES)
            fitted[c] = ColumnPrep("binary", fill=BINARY_FILL, positives=positives)
        elif s["DTYPE"] == "Numeric":
            mean, scale = (s["FIT_MEAN"], s["FIT_STD"]) if "FIT_MEAN" in s and how["clip"] else (s["MEAN"], s["STD"])
            center = (mean or 0.0, scale or 1.0) if how["standardize"] else (0.0, 1.0)
            middle = s["P50"] if s["P50"] is not None else 0.0
            fitted[c] = ColumnPrep("numeric", (s["P01"], s["P99"]) if s["P01"] is not None and how["clip"] else None,
                                   middle if how["impute"] else center[0], center)
        else:
            counts = list(s.get("CATEGORIES", []))
            if s["MISSING"]:
                counts.append((TEXT_FILL, s["MISSING"]))
            counts.sort(key=lambda v: (-v[1], v[0]))
            names, limit = [v for v, _ in counts], how["max_categories"]
            kept = names if len(names) <= limit else names[:limit - 1]
            cats = kept if len(names) <= limit else [*kept, OTHER]
            fitted[c] = ColumnPrep("text", fill=TEXT_FILL, kept=kept, categories=sorted(cats))
    return TablePrep(fitted)
