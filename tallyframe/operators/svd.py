"""Truncated SVD with a variance target.

MLlib's row matrix gives singular values and right singular vectors (it forms
the Gram matrix of narrow inputs and multiplies by the rows of wide ones), its
summarizer the column means and variances; the explained-variance ratio is
    ratio_i = (s_i^2 / N - (mu . v_i)^2) / sum_j var_j
What reaches the driver is ``max_components`` vectors of the width.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.stat import Summarizer
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.joins import join_rows


@dataclass
class SVDResult:
    singular_values: np.ndarray  # [r]
    components: np.ndarray       # [r, D]  rows = right singular vectors
    ratio: np.ndarray            # [r]
    n: int

    def choose_k(self, share: float) -> int:
        """Smallest k whose cumulative ratio reaches ``share``, clamped
        to the component count (K12)."""
        cum = np.cumsum(self.ratio)
        hit = np.nonzero(cum >= share)[0]
        return int(hit[0] + 1) if hit.size else int(len(self.ratio))


def fit_svd(vectors: DataFrame, width: int, max_components: int = 500, col: str = "features") -> SVDResult:
    """Right singular vectors and explained-variance ratios (no centring)."""
    rows = vectors.select(F.col(col).alias("x")).persist()
    n, mean, var = rows.agg(Summarizer.count(F.col("x")).alias("n"), Summarizer.mean(F.col("x")).alias("mean"),
                            Summarizer.variance(F.col("x")).alias("var")).first()
    svd = RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "x"), n, width).computeSVD(min(max_components, width, n))
    rows.unpersist()
    s, v = svd.s.toArray(), svd.V.toArray().T
    # sign convention: largest-magnitude entry of each vector positive
    idx = np.argmax(np.abs(v), axis=1)
    v = v * np.sign(v[np.arange(v.shape[0]), idx])[:, None]
    total = float(var.toArray().sum()) * (n - 1) / n
    ratio = (s ** 2 / n - (v @ mean.toArray()) ** 2) / total if total > 0 else np.zeros_like(s)
    return SVDResult(s, v, ratio, int(n))


def component_table(spark, components: np.ndarray) -> DataFrame:
    """(feature, v array[k]) for the projection join (k x D values)."""
    k, d = components.shape
    rows = [(int(j), [float(components[i, j]) for i in range(k)]) for j in range(d)]
    return spark.createDataFrame(rows, "feature bigint, v array<double>")


def project(features: DataFrame, comps: DataFrame, k: int, ids: DataFrame | None = None) -> DataFrame:
    """X @ components.T in long form -> (id, component, value).

    ``ids`` (id): rows to project; one without a known feature is all zero."""
    j = features.join(comps, "feature")
    agg = j.groupBy("id").agg(*[F.sum(F.col("value") * F.get(F.col("v"), i)).alias(f"c{i}") for i in range(k)])
    if ids is not None:
        agg = join_rows(ids.select("id"), agg)
    st = F.explode(F.array(*[F.struct(F.lit(i).alias("component"), F.coalesce(f"c{i}", F.lit(0.0)).alias("value")) for i in range(k)]))
    return agg.select("id", st.alias("s")).select("id", "s.*")
