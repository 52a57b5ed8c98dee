"""Customer segmentation: cleaning, scaling, PCA, k-means, elbow, profiles
and box statistics (Q12, Q13; B1, B8, I2-I6, D8, D16-D18).

Fitted parameters (means, deviations, loadings, centres) are model metadata:
small, bounded by the number of features or clusters, and held on the driver
as Spark ML does. The data itself never leaves the executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavolo.operators.kmeans import GRID, assign, kmeans, on_grid
from tavolo.operators.ranking import group_quantiles
from tavolo.session import ensure_checkpoint_dir

# fixed values: the eight card features used for segmentation
FEATURES = ("BALANCE", "PURCHASES", "ONEOFF_PURCHASES", "INSTALLMENTS_PURCHASES",
            "CASH_ADVANCE", "CREDIT_LIMIT", "PAYMENTS", "MINIMUM_PAYMENTS")
REQUIRED = ("MINIMUM_PAYMENTS", "CREDIT_LIMIT")

# fixed values: the statistics of the segment profile, per column
PROFILE = (
    ("BALANCE", ("mean", "median", "std", "min", "max")),
    ("PURCHASES", ("mean", "median", "std")),
    ("CREDIT_LIMIT", ("mean", "std")),
    ("CASH_ADVANCE", ("mean", "sum")),
    ("TENURE", ("mean", "std")),
)


def drop_incomplete(df: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """Rows with a null in any required column are dropped."""
    return df.na.drop(subset=list(required))


def card_clean(customers: DataFrame, features: Sequence[str] = FEATURES,
               id_col: str = "CUST_ID") -> DataFrame:
    """B8 then B1: the id plus the feature columns."""
    return drop_incomplete(customers).select(id_col, *features)


# ---------------------------------------------------------------- scaling

def fit_scaler(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column in one aggregate."""
    aggs = []
    for c in features:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in features}


def standardize(df: DataFrame, features: Sequence[str] = FEATURES, id_col: str = "CUST_ID",
                scaler: dict[str, tuple[float, float]] | None = None,
                places: int | None = None) -> DataFrame:
    """``(x - mean) / std``; a constant column divides by 1.

    Without a given ``scaler`` the input is read twice (fit, then transform),
    so it is checkpointed first: the feature table (one row per customer) is
    written once instead of being rebuilt from the line items for each pass,
    and the lineage is cut for every model job downstream.
    """
    if scaler is None:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
        scaler = fit_scaler(df, features)
    cols = []
    for c in features:
        m, s = scaler[c]
        v = (F.col(c) - F.lit(m)) / F.lit(s if s else 1.0)
        if places is not None:
            v = F.round(v, places) + F.lit(0.0)
        cols.append(v.alias(c))
    keep = [c for c in df.columns if c not in features]
    return df.select(*keep, *cols)


def total_sse(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Elbow point k = 1: squared distances to the overall mean."""
    sse = sum((F.var_pop(c) * F.count(c) for c in features), F.lit(0.0))
    return df.agg(F.lit(1).alias("k"), sse.alias("sse"))


# ---------------------------------------------------------------- PCA and k-means

# squarings of a matrix until only its largest axis is left: powers up to 2 ** 40
SQUARINGS = 40


def covariance(scaled: DataFrame, features: Sequence[str] = FEATURES) -> np.ndarray:
    """Population covariances of the columns, in one aggregate of exact decimal
    sums over the grid of k-means, so no order of rows changes a digit."""
    grid = scaled.select(*[F.round(F.col(c) * GRID).cast("long").alias(f"x{i}") for i, c in enumerate(features)])
    exact = lambda e: F.sum(e.cast("decimal(38,0)"))
    d = len(features)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    row = grid.agg(F.count(F.lit(1)).alias("n"), *[exact(F.col(f"x{i}")).alias(f"s{i}") for i in range(d)],
                   *[F.sum(F.col(f"x{i}").cast("decimal(19,0)") * F.col(f"x{j}")).alias(f"p{i}_{j}") for i, j in pairs]).first()
    cov, n = np.zeros((d, d)), row["n"]
    for i, j in pairs if n else []:
        cov[i, j] = cov[j, i] = float(Fraction(n * int(row[f"p{i}_{j}"]) - int(row[f"s{i}"]) * int(row[f"s{j}"]), n * n))
    return cov


def principal_axes(cov: np.ndarray, k: int) -> tuple[list[float], list[np.ndarray]]:
    """The ``k`` largest variances and their axes, by power iteration with deflation: a
    matrix squared again and again, with its trace brought back to 1, becomes the projection
    on its largest axis; that one is taken out and the rest goes on. The largest loading of an axis is
    positive (the first of equal ones)."""
    variances, axes, rest = [], [], cov.copy()
    for _ in range(k):
        power = rest / np.trace(rest) if np.trace(rest) > 0 else rest
        for _ in range(SQUARINGS):
            power = power @ power
            power = power / np.trace(power) if np.trace(power) > 0 else power
        i = int(np.argmax(np.diag(power)))
        axis = power[:, i] / np.sqrt(power[i, i]) if power[i, i] > 0 else np.zeros(len(cov))
        variance = float((rest * power).sum())
        rest = rest - variance * power
        big = int(np.argmax(np.abs(np.round(axis, 9))))
        variances.append(variance)
        axes.append(-axis if axis[big] < 0 else axis)
    return variances, axes


def pca_variance(scaled: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Explained variance ratio of every component, largest first (I4)."""
    cov = covariance(scaled, features)
    variances, _ = principal_axes(cov, len(features))
    total = float(np.trace(cov)) or 1.0
    rows = [(i, v / total) for i, v in enumerate(variances, start=1)]
    return scaled.sparkSession.createDataFrame(rows, "component int, explained_variance_ratio double")


def pca_scores(scaled: DataFrame, features: Sequence[str] = FEATURES, k: int = 2,
               id_col: str = "CUST_ID") -> DataFrame:
    """First ``k`` principal scores ``pc1..pck`` of standardized columns."""
    _, axes = principal_axes(covariance(scaled, features), k)
    return scaled.select(id_col, *[sum((F.col(c) * F.lit(float(a)) for c, a in zip(features, axis)), F.lit(0.0)).alias(f"pc{j + 1}")
                                   for j, axis in enumerate(axes)])


def elbow(scaled: DataFrame, features: Sequence[str] = FEATURES, ks: Sequence[int] = range(1, 10),
          max_iter: int = 1000, id_col: str = "CUST_ID") -> DataFrame:
    """(k, sse) for each k, to 4 places; all k step together over the same points."""
    _, sse = kmeans(on_grid(scaled, features, id_col), list(ks), max_iter)
    rows = [(k, round(float(Fraction(sse[k], GRID * GRID)), 4)) for k in ks if k in sse]
    return scaled.sparkSession.createDataFrame(rows, "k int, sse double")


def segments(scaled: DataFrame, features: Sequence[str] = FEATURES, k: int = 7,
             n_components: int = 2, max_iter: int = 1000, id_col: str = "CUST_ID") -> DataFrame:
    """K-means on the principal scores (I3, I5): (id, pc1.., Cluster), scores to 6 places.
    Clusters are numbered by the order of their centres (arbitrary in any engine)."""
    points = on_grid(pca_scores(scaled, features, n_components, id_col), [f"pc{j + 1}" for j in range(n_components)], id_col)
    centres, _ = kmeans(points, [k], max_iter)
    ordered = sorted(centres.get(k, [])) or [(0,) * n_components]
    return assign(points, ordered).select(
        F.col("id").alias(id_col), *[(F.get("x", F.lit(j)) / GRID).alias(f"pc{j + 1}") for j in range(n_components)], "Cluster")


# ---------------------------------------------------------------- profiles

_STAT = {
    "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "sum": F.sum,
}


def segment_profile(df: DataFrame, group: str = "Cluster",
                    profile: Sequence[tuple[str, Sequence[str]]] = PROFILE,
                    places: int = 6) -> DataFrame:
    """Several statistics of several columns per group, flat names
    ``BALANCE_mean`` ... (D8). Medians are exact and distributed
    (``group_quantiles``); the rest is one partial-aggregated pass. A one-row
    group has a null std (N32)."""
    aggs = []
    medians = []
    for col, stats in profile:
        for s in stats:
            if s == "median":
                medians.append(col)
            else:
                aggs.append(F.round(_STAT[s](F.col(col).cast("double")), places).alias(f"{col}_{s}"))
    out = df.groupBy(group).agg(*aggs)
    if medians:
        # all median columns in one distributed rank: stack them as (group, column, value)
        stacked = df.select(group, F.explode(F.array(*[
            F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_val")) for c in medians
        ])).alias("_s")).select(group, "_s._col", "_s._val")
        med = group_quantiles(stacked, [group, "_col"], "_val", [0.5])
        wide = med.groupBy(group).agg(*[
            F.round(F.max(F.when(F.col("_col") == c, F.col("q"))), places).alias(f"{c}_median") for c in medians])
        out = out.join(wide, group, "left")
    names = [f"{c}_{s}" for c, stats in profile for s in stats]
    return out.select(group, *names)


def transpose_profile(profile: DataFrame, group: str = "Cluster") -> DataFrame:
    """Statistics as rows, groups as columns (the heatmap input): unpivot then
    pivot on the group values, which are few (clusters)."""
    profile = profile.checkpoint(eager=True)  # one row per group; read twice below
    stats = [c for c in profile.columns if c != group]
    long = profile.unpivot([group], stats, "stat", "value")
    values = sorted(r[0] for r in profile.select(group).distinct().collect())
    return (long.groupBy("stat").pivot(group, values).agg(F.first("value"))
            .toDF("stat", *[str(v) for v in values]))


def _fences(df: DataFrame, group: str, value: str, whisker: float) -> DataFrame:
    """Quartiles and fences, one row per group; quartiles are exact and distributed."""
    q = group_quantiles(df, [group], value, [0.25, 0.5, 0.75])
    wide = q.groupBy(group).agg(
        F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q3"))
    return wide.select(group, "q1", "median", "q3",
                       (F.col("q3") - F.col("q1")).alias("iqr"),
                       (F.col("q1") - whisker * (F.col("q3") - F.col("q1"))).alias("lo"),
                       (F.col("q3") + whisker * (F.col("q3") - F.col("q1"))).alias("hi"))


def outliers(df: DataFrame, group: str, value: str, whisker: float = 1.5) -> DataFrame:
    """The rows of ``df`` beyond their group's fences, with the fences ``lo`` and ``hi``."""
    fences = _fences(df, group, value, whisker).select(group, "lo", "hi")
    v = F.col(value).cast("double")
    return df.join(fences, group).where((v < F.col("lo")) | (v > F.col("hi")))


def box_stats(df: DataFrame, group: str, value: str, whisker: float = 1.5,
              places: int = 6) -> DataFrame:
    """Box-plot numbers per group: quartiles, whiskers at ``whisker`` IQR and
    the count of outliers beyond them (D17). Quartiles are exact and
    distributed; the fences are one row per group, joined back by key."""
    fences = _fences(df, group, value, whisker)
    v = F.col(value).cast("double")
    per = (df.select(group, v.alias("_v")).filter(F.col("_v").isNotNull())
           .join(fences.select(group, "lo", "hi"), group)
           .groupBy(group).agg(
               F.min(F.when(F.col("_v") >= F.col("lo"), F.col("_v"))).alias("lower_whisker"),
               F.max(F.when(F.col("_v") <= F.col("hi"), F.col("_v"))).alias("upper_whisker"),
               F.count_if((F.col("_v") < F.col("lo")) | (F.col("_v") > F.col("hi"))).alias("n_outliers"),
               F.count(F.lit(1)).alias("n")))
    r = lambda c: F.round(F.col(c), places).alias(c)
    return fences.join(per, group).select(
        group, r("q1"), r("median"), r("q3"), r("iqr"), r("lower_whisker"), r("upper_whisker"),
        "n_outliers", "n")
