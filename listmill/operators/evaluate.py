"""Evaluation of routing and search predictions against expected cases."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARAMETERS = ["estate_type", "district", "square", "no_bedrooms", "no_bathrooms", "price", "price_per_square"]


def join_predictions(expected: DataFrame, predicted: DataFrame, key: str = "id") -> DataFrame:
    """Every expected case with its prediction, if any."""
    return expected.join(predicted, key, "left")


def same_set(a: Column, b: Column) -> Column:
    """Equal as sets; a missing side is an empty set."""
    x, y = (F.coalesce(c, F.array().cast("array<string>")) for c in (a, b))
    return (F.size(F.array_except(x, y)) == 0) & (F.size(F.array_except(y, x)) == 0)


def tool_accuracy(cases: DataFrame, expected: str, selected: str) -> DataFrame:
    """Share of cases whose selected tools equal the expected set, in percent."""
    right = same_set(F.col(expected), F.col(selected))
    return cases.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(right).alias("correct"),
        F.coalesce(F.try_divide(F.count_if(right) * 100.0, F.count(F.lit(1)).cast("double")), F.lit(0.0)).alias("accuracy"),
    )


def confusion_metrics(cases: DataFrame, expected: str, predicted: str, positive, negative) -> DataFrame:
    """Confusion counts with accuracy and per-class precision, recall and F1; zero where undefined."""
    is_p, is_n = F.col(expected) == positive, F.col(expected) == negative
    right = F.coalesce(F.col(predicted) == F.col(expected), F.lit(False))
    counts = cases.agg(
        F.count_if(is_p & right).alias("tp"), F.count_if(is_n & right).alias("tn"),
        F.count_if(is_n & ~right).alias("fp"), F.count_if(is_p & ~right).alias("fn"),
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    out = counts.withColumns(
        {
            "accuracy": ratio(tp + tn, tp + tn + fp + fn),
            "precision_positive": ratio(tp, tp + fp),
            "recall_positive": ratio(tp, tp + fn),
            "precision_negative": ratio(tn, tn + fn),
            "recall_negative": ratio(tn, tn + fp),
        }
    )
    for side in ("positive", "negative"):
        p, r = F.col(f"precision_{side}"), F.col(f"recall_{side}")
        out = out.withColumn(f"f1_{side}", ratio(2 * p * r, p + r))
    return out


def param_accuracy(cases: DataFrame, expected: str, predicted: str, fields: list[str] | None = None) -> DataFrame:
    """Share of cases in which all fields of two structs agree; null agrees with null."""
    names = PARAMETERS if fields is None else fields
    right = reduce(and_, [F.col(f"{expected}.{n}").eqNullSafe(F.col(f"{predicted}.{n}")) for n in names])
    return cases.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(right).alias("correct"),
        F.coalesce(F.avg(right.cast("int")), F.lit(0.0)).alias("param_accuracy"),
    )


def quality_gate(results: DataFrame, key: str, meets: Column, share: float = 0.3) -> DataFrame:
    """Per request, whether at least ``share`` of its results meet the criteria."""
    rate = F.avg(F.coalesce(meets, F.lit(False)).cast("int"))
    return results.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), rate.alias("rate"), (rate >= share).alias("passed")
    )


def extend_cases(cases: DataFrame, paraphrases: DataFrame) -> DataFrame:
    """Cases and their paraphrases, the latter with the id they come from."""
    originals = cases.withColumn("is_paraphrased", F.lit(False))
    added = paraphrases.withColumn("is_paraphrased", F.lit(True))
    return originals.unionByName(added, allowMissingColumns=True)
