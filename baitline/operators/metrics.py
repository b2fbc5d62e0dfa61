"""Binary classification metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def binary_metrics(df: DataFrame, truth: str = "y_true", predicted: str = "y_pred",
                   digits: int | None = 4) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1, from one aggregation.

    A zero division counts as 0. ``digits=None`` keeps the raw values.
    """
    t, p = F.col(truth), F.col(predicted)
    counts = df.agg(F.count_if((t == 1) & (p == 1)).alias("tp"),
                    F.count_if((t != 1) & (p == 1)).alias("fp"),
                    F.count_if((t == 1) & (p != 1)).alias("fn"),
                    F.count_if(t == p).alias("right"), F.count(F.lit(1)).alias("n"))

    def ratio(top, bottom):
        value = F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))
        return value if digits is None else F.round(value.cast("decimal(18,9)"), digits).cast(
            "double")

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        ratio(F.col("right"), F.col("n")).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))
