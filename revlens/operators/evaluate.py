"""Prediction quality.

The reference runs two evaluators and three counts (five jobs); here all
numbers come from one aggregate over the prediction table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.numbers import safe_ratio

# Fixed value: a rating (actual or predicted) at or above this is "relevant".
RELEVANT_RATING = 4.0


def quality_metrics(pred: DataFrame, label: str = "rating", prediction: str = "prediction",
                    threshold: float = RELEVANT_RATING) -> DataFrame:
    """One row: rmse, mae, precision, recall, f1 (the last three x100), tp, fp, fn, n."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    d = p - y
    rel_y, rel_p = F.col(label) >= threshold, F.col(prediction) >= threshold
    base = pred.agg(
        F.sqrt(F.avg(d * d)).alias("rmse"),
        F.avg(F.abs(d)).alias("mae"),
        F.count_if(rel_y & rel_p).alias("tp"),
        F.count_if(~rel_y & rel_p).alias("fp"),
        F.count_if(rel_y & ~rel_p).alias("fn"),
        F.count(F.lit(1)).alias("n"),
    )
    prec = safe_ratio("tp", F.col("tp") + F.col("fp"))
    rec = safe_ratio("tp", F.col("tp") + F.col("fn"))
    with_pr = base.select("*", prec.alias("_p"), rec.alias("_r"))
    f1 = safe_ratio(F.col("_p") * F.col("_r") * 2, F.col("_p") + F.col("_r"))
    return with_pr.select(
        "rmse", "mae",
        (F.col("_p") * 100).alias("precision"),
        (F.col("_r") * 100).alias("recall"),
        (f1 * 100).alias("f1"),
        "tp", "fp", "fn", "n",
    )


def radar_scores(metrics: DataFrame) -> DataFrame:
    """the five metrics on a 0..1 scale (1 - RMSE/5, 1 - MAE/5, P, R, F1 / 100)."""
    return metrics.select(
        (1 - F.col("rmse") / 5).alias("rmse_score"),
        (1 - F.col("mae") / 5).alias("mae_score"),
        (F.col("precision") / 100).alias("precision_score"),
        (F.col("recall") / 100).alias("recall_score"),
        (F.col("f1") / 100).alias("f1_score"),
    )


def item_average_predictions(train: DataFrame, test: DataFrame) -> DataFrame:
    """A deterministic baseline predictor: a test pair gets its product's train average.

    Pairs whose user or product is absent from ``train`` are dropped, like the
    collaborative filter's ``coldStartStrategy="drop"``.
    """
    item_avg = train.groupBy("product_id").agg(F.avg("rating").alias("prediction"))
    users = train.select("user_id").distinct()
    return test.join(users, "user_id", "left_semi").join(item_avg, "product_id")
