"""Stored scoring pipeline (S5, M17, M18): features -> projection -> softmax.

All fitted state is parameter tables (feature model tables, component table,
weight table) plus a one-row meta table, so a scorer restores it on any
cluster and scores a whole table with joins on small tables and sums by id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators import linear, svd
from tallyframe.operators.features import FeatureModel
from tallyframe.operators.labels import name_of


@dataclass
class ScoringPipeline:
    features: FeatureModel
    components: DataFrame   # (feature bigint, v array<double>[k])
    weights: DataFrame      # (feature bigint = component, w array<double>[K])
    bias: list[float]
    classes: list[str]
    k: int

    def scores(self, df: DataFrame) -> DataFrame:
        """(id, z array[K]) for every row of ``df``; a row without a known feature scores as the bias."""
        feats = self.features.transform(df)
        proj = svd.project(feats, self.components, self.k, df.select("id")).withColumnRenamed("component", "feature")
        return linear.linear_scores(proj, self.weights, self.bias, df.select("id"))

    def predict(self, df: DataFrame) -> DataFrame:
        """(id, pred, pred_label) for every row of ``df``."""
        z = self.scores(df)
        idx = linear.predict_index(F.col("z"))
        return z.select("id", idx.alias("pred"), name_of(idx, self.classes).alias("pred_label"))

    def save(self, path: str) -> None:
        spark = self.components.sparkSession
        self.features.save(f"{path}/features")
        self.components.write.mode("overwrite").parquet(f"{path}/components")
        self.weights.write.mode("overwrite").parquet(f"{path}/weights")
        spark.createDataFrame([(self.classes, self.bias, self.k)], "classes array<string>, bias array<double>, k int") \
            .write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "ScoringPipeline":
        meta = spark.read.parquet(f"{path}/meta").first()
        return ScoringPipeline(FeatureModel.load(spark, f"{path}/features"),
                               spark.read.parquet(f"{path}/components"), spark.read.parquet(f"{path}/weights"),
                               list(meta["bias"]), list(meta["classes"]), int(meta["k"]))


def from_mllib(features: FeatureModel, components: DataFrame, k: int, model, classes: list[str]) -> ScoringPipeline:
    """Export a fitted MLlib multinomial model over the projected features."""
    spark = components.sparkSession
    coef = model.coefficientMatrix.toArray()
    w = spark.createDataFrame([(j, [float(coef[i, j]) for i in range(coef.shape[0])]) for j in range(coef.shape[1])],
                              "feature bigint, w array<double>")
    return ScoringPipeline(features, components, w, [float(x) for x in model.interceptVector.toArray()], classes, k)
