"""Classification evaluation (M7, M8, M12) as aggregates over (label, prediction).

One pass with conditional counts; zero denominators give 0.0 (the
reference library's convention), not an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """M7: one row (tn, fp, fn, tp); rows are truth, columns prediction, class 1 positive."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    return df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def confusion_long(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """M7 long form: (label, prediction, n) for every observed pair."""
    return df.groupBy(F.col(label).cast("double").alias("label"),
                      F.col(prediction).cast("double").alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def metrics_from_confusion(cm: DataFrame) -> DataFrame:
    """M8: accuracy, precision, recall and F1 of class 1 from a (tn, fp, fn, tp) row."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    precision = ratio(tp, tp + fp)
    recall = ratio(tp, tp + fn)
    return cm.select(
        "tn", "fp", "fn", "tp",
        ratio(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        ratio(F.lit(2.0) * precision * recall, precision + recall).alias("f1"),
    )


def metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """M8 over scored rows."""
    return metrics_from_confusion(confusion(df, label, prediction))


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """``y_test.value_counts()``."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), label)
