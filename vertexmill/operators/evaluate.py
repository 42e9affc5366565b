"""Accuracy and macro F1 over any split, as aggregates over a prediction table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def accuracy(predictions: DataFrame, mask: Column) -> DataFrame:
    """One row; 0 where the mask is empty."""
    hit = (F.col("pred") == F.col("label")).cast("double")
    return predictions.filter(mask).agg(F.coalesce(F.avg(hit), F.lit(0.0)).alias("accuracy"))


def class_counts(
    predictions: DataFrame, masks: dict[str, Column], total: Column | None = None
) -> DataFrame:
    """Per class and mask: true rows, predicted rows, hits; ``total`` summed by true class.

    Rows are first counted per (label, pred), so a label with most of the rows
    is combined inside every task, and what is shuffled is class-sized.
    """
    counts = [F.count_if(mask).alias(f"n_{name}") for name, mask in masks.items()]
    summed = F.sum(F.lit(0.0) if total is None else total).alias("total")
    pairs = predictions.groupBy("label", "pred").agg(*counts, summed)
    hit = F.col("label") == F.col("pred")
    as_true = [F.col("label").alias("cls"), F.col("total")]
    as_pred = [F.col("pred").alias("cls"), F.lit(0.0).alias("total")]
    for name in masks:
        n, none = F.col(f"n_{name}"), F.lit(0).cast("bigint")
        as_true += [n.alias(f"true_{name}"), none.alias(f"pred_{name}"),
                    F.when(hit, n).otherwise(none).alias(f"hit_{name}")]
        as_pred += [none.alias(f"true_{name}"), n.alias(f"pred_{name}"),
                    none.alias(f"hit_{name}")]
    sides = pairs.select(F.inline(F.array(F.struct(*as_true), F.struct(*as_pred))))
    return sides.groupBy("cls").agg(*[F.sum(c).alias(c) for c in sides.columns if c != "cls"])


def macro_f1_of(name: str) -> Column:
    """Macro F1 over the classes seen as label or prediction inside the mask; 0 if none is."""
    seen = F.col(f"true_{name}") + F.col(f"pred_{name}")
    f1 = F.when(seen > 0, F.try_divide(2.0 * F.col(f"hit_{name}"), seen))
    return F.coalesce(F.avg(f1), F.lit(0.0))


def accuracy_of(name: str) -> Column:
    share = F.try_divide(F.sum(f"hit_{name}"), F.sum(f"true_{name}"))
    return F.coalesce(share, F.lit(0.0))


def macro_f1(predictions: DataFrame, mask: Column) -> DataFrame:
    """One row; 0 where the mask is empty."""
    return class_counts(predictions, {"m": mask}).agg(macro_f1_of("m").alias("macro_f1"))


def evaluate_splits(predictions: DataFrame, loss: str | None = None) -> DataFrame:
    """One row ``(train_acc, val_f1, test_f1)`` from one pass over the predictions.

    With ``loss``, the name of a per-row loss, also its mean over training rows.
    """
    masks = {"train": F.col("is_train"), "val": F.col("is_val"), "test": F.col("is_test")}
    total = None if loss is None else F.when(F.col("is_train"), F.col(loss)).otherwise(0.0)
    found = [
        accuracy_of("train").alias("train_acc"),
        macro_f1_of("val").alias("val_f1"),
        macro_f1_of("test").alias("test_f1"),
    ]
    if loss is not None:
        mean = F.try_divide(F.sum("total"), F.sum("true_train"))
        found.append(F.coalesce(mean, F.lit(0.0)).alias("loss"))
    return class_counts(predictions, masks, total).agg(*found)
