"""Vector scores over Arrow batches; Spark 4.1 has no cosine over arrays."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def cosine(u: Column, v: Column) -> Column:
    """VEC1 of two columns, 0 when a norm is 0; built-in functions only."""
    def norm(x: Column) -> Column:
        return F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, a: s + a.cast("double") * a.cast("double")))
    dot = F.aggregate(F.zip_with(u, v, lambda a, b: a.cast("double") * b.cast("double")),
                      F.lit(0.0), lambda s, a: s + a)
    n = norm(u) * norm(v)
    return F.when(n == 0, F.lit(0.0)).otherwise(dot / n)


def best_cosine(u: Column, blocks: Sequence[Sequence[float]]) -> Column:
    """JOI6 and AGG12: best cosine against a bounded list of block vectors, never below 0.

    One matrix product per Arrow batch; null stays null, and so does a vector of another length.
    """
    b = np.asarray(blocks, dtype="float64")
    norms = np.linalg.norm(b, axis=1)
    unit = np.divide(b, norms[:, None], out=np.zeros_like(b), where=norms[:, None] > 0)
    dim = unit.shape[1]

    @F.pandas_udf(T.DoubleType())
    def score(s: pd.Series) -> pd.Series:
        ok = s.map(lambda x: x is not None and len(x) == dim).to_numpy(dtype=bool)
        out = np.full(len(s), np.nan)
        if ok.any():
            m = np.stack(s[ok].to_numpy()).astype("float64")
            n = np.linalg.norm(m, axis=1)
            sims = (m @ unit.T).max(axis=1)
            out[ok] = np.maximum(0.0, np.divide(sims, n, out=np.zeros_like(sims), where=n > 0))
        return pd.Series(out).astype("Float64").where(pd.Series(ok), None)

    return score(u)


def percent(c: Column) -> Column:
    """SIM2: 0..100, halves to even."""
    return F.bround(c * 100).cast("int")
