"""Classification report and balanced accuracy.

One partial-aggregated pass reduces the scored rows to the confusion counts
(one row per (label, prediction) pair); everything after works on that tiny
table. Divisions by zero give 0, as the report does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ratio(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction",
                          places: int = 6) -> DataFrame:
    """Rows (label, precision, recall, f1_score, support): one per class (the
    union of true and predicted classes), then ``accuracy`` (in f1_score),
    ``macro avg``, ``weighted avg`` and ``balanced accuracy`` (in recall:
    mean recall over the classes that occur as true labels)."""
    pairs = (df.select(F.col(label).cast("string").alias("t"), F.col(prediction).cast("string").alias("p"))
             .groupBy("t", "p").agg(F.count(F.lit(1)).alias("n")))
    by_true = pairs.groupBy(F.col("t").alias("label")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("t") == F.col("p"), F.col("n"))).alias("tp"))
    by_pred = pairs.groupBy(F.col("p").alias("label")).agg(F.sum("n").alias("predicted"))
    cls = (by_true.join(by_pred, "label", "full")
           .select("label",
                   F.coalesce("support", F.lit(0)).cast("bigint").alias("support"),
                   F.coalesce("tp", F.lit(0)).alias("tp"),
                   F.coalesce("predicted", F.lit(0)).alias("predicted")))
    prec = _ratio(F.col("tp"), F.col("predicted"))
    rec = _ratio(F.col("tp"), F.col("support"))
    per = cls.select("label", prec.alias("precision"), rec.alias("recall"),
                     _ratio(2 * prec * rec, prec + rec).alias("f1_score"), "support", "tp")
    total = F.sum("support")
    acc = per.agg(
        F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"), _ratio(F.sum("tp"), total).alias("f1_score"),
        total.cast("bigint").alias("support"))
    macro = per.agg(
        F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"), F.avg("f1_score").alias("f1_score"),
        total.cast("bigint").alias("support"))
    weighted = per.agg(
        F.lit("weighted avg").alias("label"),
        _ratio(F.sum(F.col("precision") * F.col("support")), total).alias("precision"),
        _ratio(F.sum(F.col("recall") * F.col("support")), total).alias("recall"),
        _ratio(F.sum(F.col("f1_score") * F.col("support")), total).alias("f1_score"),
        total.cast("bigint").alias("support"))
    balanced = per.filter(F.col("support") > 0).agg(
        F.lit("balanced accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
        F.avg("recall").alias("recall"), F.lit(None).cast("double").alias("f1_score"),
        F.sum("support").cast("bigint").alias("support"))
    out = (per.drop("tp").unionByName(acc).unionByName(macro).unionByName(weighted)
           .unionByName(balanced))
    r = lambda c: (F.round(F.col(c), places) + F.lit(0.0)).alias(c)
    return out.select("label", r("precision"), r("recall"), r("f1_score"), "support")


def balanced_accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    """The report's balanced accuracy alone, to 12 places."""
    t, p = F.col(label).cast("string"), F.col(prediction).cast("string")
    per = df.groupBy(t.alias("t")).agg(F.count(F.lit(1)).alias("support"), F.count_if(t == p).alias("tp"))
    return float(per.agg(F.round(F.avg(_ratio(F.col("tp"), F.col("support"))), 12) + F.lit(0.0)).first()[0])
