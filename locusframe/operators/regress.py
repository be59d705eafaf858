"""Residualising a score on covariates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusframe.session import broadcast_checked


def residualize(df: DataFrame, y: str, x: str, by: list[str] | None = None, out: str = "residual") -> DataFrame:
    """Residual of ``y`` after an ordinary least-squares fit on one
    covariate ``x``, fitted separately per ``by`` group with the SQL
    regression aggregates (one pass, map-side combined)."""
    by = by or []
    fit = df.groupBy(*by).agg(F.regr_slope(y, x).alias("_b"), F.regr_intercept(y, x).alias("_a")) if by else \
        df.agg(F.regr_slope(y, x).alias("_b"), F.regr_intercept(y, x).alias("_a"))
    if by:
        j = df.join(broadcast_checked(fit), by)
    else:  # one fitted row: broadcast it (proven size 1) on a constant key
        j = df.withColumn("_k", F.lit(1)).join(F.broadcast(fit.withColumn("_k", F.lit(1))), "_k").drop("_k")
    return j.withColumn(out, F.col(y) - (F.col("_a") + F.col("_b") * F.col(x))).drop("_a", "_b")


FIT = T.StructType([T.StructField("b", T.ArrayType(T.DoubleType())), T.StructField("a", T.DoubleType())])


@F.pandas_udf(FIT)
def _solved(cxx: pd.Series, cxy: pd.Series, mx: pd.Series, my: pd.Series) -> pd.DataFrame:
    """Slopes and intercept of each group from its covariances and means."""
    out = []
    for xx, xy, m, y in zip(cxx, cxy, mx, my, strict=True):
        xy, m = np.asarray(xy, float), np.asarray(m, float)
        xx = np.asarray(xx, float).reshape(len(xy), len(xy))
        scale = np.sqrt(np.where(np.diag(xx) > 0, np.diag(xx), 1.0))
        r = xx / np.outer(scale, scale)
        try:
            low = np.linalg.cholesky(r)
            if len(low) and np.diag(low).min() < 1e-7:
                raise np.linalg.LinAlgError
            b = np.linalg.solve(low.T, np.linalg.solve(low, xy / scale))
        except np.linalg.LinAlgError:  # covariates that depend on each other: the shortest solution
            b = np.linalg.lstsq(r, xy / scale, rcond=1e-10)[0]
        b = b / scale
        out.append((b.tolist(), float(y - m @ b)))
    return pd.DataFrame(out, columns=["b", "a"])


def fit_groups(df: DataFrame, y: str, xs: list[str], by: list[str] | None = None) -> DataFrame:
    """Least-squares fit of ``y`` on all of ``xs`` per ``by`` group: slopes
    (array in the order of ``xs``), intercept and n. Covariances are added up
    map-side, so what is shuffled is one row per task and group; rows with a
    missing value do not take part."""
    by = by or []
    whole = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [y, *xs]))
    upper = [(i, j) for i in range(len(xs)) for j in range(i, len(xs))]
    aggs = [F.covar_pop(xs[i], xs[j]).alias(f"_c{i}_{j}") for i, j in upper]
    aggs += [F.covar_pop(x, y).alias(f"_y{i}") for i, x in enumerate(xs)] + [F.avg(x).alias(f"_m{i}") for i, x in enumerate(xs)]
    g = whole.groupBy(*by).agg(*aggs, F.avg(y).alias("_my"), F.count(F.lit(1)).alias("n")).where("n > 0")
    full = F.array(*[F.col(f"_c{min(i, j)}_{max(i, j)}") for i in range(len(xs)) for j in range(len(xs))])
    f = g.withColumn("_f", _solved(full, F.array(*[F.col(f"_y{i}") for i in range(len(xs))]),
                                   F.array(*[F.col(f"_m{i}") for i in range(len(xs))]), F.col("_my")))
    return f.select(*by, F.col("_f.b").alias("slopes"), F.col("_f.a").alias("intercept"), "n")


def residualize_groups(df: DataFrame, y: str, xs: list[str], by: list[str] | None = None, out: str = "residual") -> DataFrame:
    """Residual of ``y`` on all of ``xs``, one fit per ``by`` group (scores on
    all principal components); null where a value is missing."""
    by = by or []
    fit = fit_groups(df, y, xs, by).select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("slopes").alias("_b"), F.col("intercept").alias("_a"))
    on = [df[c].eqNullSafe(fit[f"_by_{c}"]) for c in by]
    # without groups there is one fitted row
    j = df.join(fit, on, "left") if by else df.join(F.broadcast(fit), F.lit(True), "left")
    said = F.col("_a")
    for i, x in enumerate(xs):
        said = said + F.get("_b", F.lit(i)) * F.col(x)
    return j.withColumn(out, F.col(y) - said).drop("_a", "_b", *[f"_by_{c}" for c in by])
