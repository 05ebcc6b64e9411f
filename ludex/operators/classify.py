"""Behaviour classifier: what a row is (purchase or play), from its hours and
what its user did before."""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludex.functions.columns import PLAY, PURCHASE, in_train
from ludex.operators.features import with_previous
from ludex.session import stage_table

FEATURES = ["hours", "prev_purchase", "prev2_purchase", "prev_hours", "gap_hours"]
DEPTH = 5
# Value of a feature that is not known (the first rows of a user, NULL hours).
MISSING = -1.0


def sequence_features(log: DataFrame) -> DataFrame:
    """Per row of the log: event_id, rkey, behaviour and ``FEATURES``: its hours,
    whether the rows before and before that are purchases (1 or 0), the hours of
    the row before and the time since it. Unknown values are ``MISSING``."""
    seen = log.withColumn("_v", F.struct("behaviour", "hours", "ts"))
    seen = with_previous(seen, "_v", "_p1").drop("_v")
    seen = seen.withColumn("_b1", F.col("_p1.behaviour"))
    seen = with_previous(seen, "_b1", "_b2")
    micros = [F.unix_micros(F.col(c).cast("timestamp")) for c in ("ts", "_p1.ts")]
    gap = (micros[0] - micros[1]) / F.lit(3_600_000_000.0)

    def bought(behaviour):
        return F.when(behaviour.isNull(), MISSING).when(behaviour == PURCHASE, 1.0).otherwise(0.0)

    def known(value):
        return F.coalesce(value.cast("double"), F.lit(MISSING))

    return seen.select("event_id", "rkey", "behaviour", known(F.col("hours")).alias("hours"),
                       bought(F.col("_b1")).alias("prev_purchase"),
                       bought(F.col("_b2")).alias("prev2_purchase"),
                       known(F.col("_p1.hours")).alias("prev_hours"), known(gap).alias("gap_hours"))


def fit_behaviour(features: DataFrame, depth: int = DEPTH) -> DecisionTreeClassificationModel:
    """A decision tree on the train rows (md5 of the row key)."""
    rows = _vectors(features.where(in_train(F.col("rkey")))).withColumn(
        "label", F.when(F.col("behaviour") == PURCHASE, 1.0).otherwise(0.0))
    return DecisionTreeClassifier(maxDepth=depth, seed=0).fit(rows)


def _vectors(features: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features)


def predict_behaviour(model: DecisionTreeClassificationModel, features: DataFrame) -> DataFrame:
    """``features`` + ``predicted``."""
    return (model.transform(_vectors(features))
            .withColumn("predicted", F.when(F.col("prediction") == 1.0, PURCHASE).otherwise(PLAY))
            .drop("features", "rawPrediction", "probability", "prediction"))


def confusion(log: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Rows per (behaviour, predicted) on the held-out side. Eager: the features
    are written, the tree is fitted."""
    features = stage_table(sequence_features(log), "features")
    held = predict_behaviour(fit_behaviour(features, depth), features.where(~in_train(F.col("rkey"))))
    return held.groupBy("behaviour", "predicted").agg(F.count(F.lit(1)).alias("n"))
