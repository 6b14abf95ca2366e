"""Classification metrics as grouped queries over rows (task, y, p): class ids of truth and prediction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pairs(df: DataFrame, tasks: Sequence[str], truth: str = "{}_id", predicted: str = "{}_pred") -> DataFrame:
    """Rows (task, y, p) out of one column pair a task."""
    each = F.array(*(F.struct(F.lit(t).alias("task"), F.col(truth.format(t)).cast("int").alias("y"), F.col(predicted.format(t)).cast("int").alias("p")) for t in tasks))
    return df.select(F.explode(each).alias("x")).select("x.*")


def dimension(df: DataFrame, classes: Mapping[str, Sequence[str]]) -> DataFrame:
    return df.sparkSession.createDataFrame([(t, i, c) for t, cs in classes.items() for i, c in enumerate(cs)], "task string, k int, label string")


def confusion_counts(yp: DataFrame) -> DataFrame:
    """Rows (task, y, p, n): at most classes squared a task; every metric is made of them."""
    return yp.groupBy("task", "y", "p").agg(F.count("*").alias("n"))


def confusion_matrix(yp: DataFrame, classes: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows (task, y, p, n) for every pair of classes, zero where there is none."""
    frame = yp.sparkSession.createDataFrame([(t, i, j) for t, cs in classes.items() for i in range(len(cs)) for j in range(len(cs))], "task string, y int, p int")
    return frame.join(confusion_counts(yp), ["task", "y", "p"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def wide_confusion(matrix: DataFrame, size: int) -> DataFrame:
    """Rows (task, y, p0, p1, ...)."""
    return matrix.groupBy("task", "y").pivot("p", list(range(size))).agg(F.first("n")).select("task", "y", *(F.col(str(i)).alias(f"p{i}") for i in range(size)))


def per_class(yp: DataFrame, classes: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows (task, k, label, support, predicted, precision, recall, f1) for every class; a zero divisor gives 0."""
    each = F.explode(F.array(F.struct(F.col("y").alias("k"), F.col("n").alias("s"), F.lit(0).alias("q")), F.struct(F.col("p").alias("k"), F.lit(0).alias("s"), F.col("n").alias("q"))))
    counts = confusion_counts(yp)
    hits = counts.where("y = p").select("task", F.col("y").alias("k"), F.col("n").alias("hit"))
    sums = counts.select("task", each.alias("x")).groupBy("task", "x.k").agg(F.sum("x.s").alias("support"), F.sum("x.q").alias("predicted"))
    rows = dimension(yp, classes).join(sums, ["task", "k"], "left").join(hits, ["task", "k"], "left").na.fill(0, ["support", "predicted", "hit"])
    over = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    hit, support, predicted = (F.col(c).cast("double") for c in ("hit", "support", "predicted"))
    return rows.select("task", "k", "label", "support", "predicted", over(hit, predicted).alias("precision"), over(hit, support).alias("recall"), over(2 * hit, support + predicted).alias("f1"))


def macro_fixed(classes_: DataFrame) -> DataFrame:
    """Rows (task, macro_precision, macro_recall, macro_f1) over all classes."""
    return classes_.groupBy("task").agg(*(F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")))


def macro_f1_observed(classes_: DataFrame) -> DataFrame:
    """Rows (task, macro_f1) over the classes that truth or prediction has."""
    return classes_.where("support + predicted > 0").groupBy("task").agg(F.avg("f1").alias("macro_f1"))


def ranked(scores: DataFrame, column: str = "macro_f1") -> DataFrame:
    """scores(task, ...) best first, ties by task; as many rows as tasks."""
    return scores.orderBy(F.desc(column), "task")


def weighted_f1(classes_: DataFrame) -> DataFrame:
    return classes_.groupBy("task").agg(F.coalesce(F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support")), F.lit(0.0)).alias("weighted_f1"))


def accuracy(yp: DataFrame) -> DataFrame:
    return yp.groupBy("task").agg(F.avg((F.col("y") == F.col("p")).cast("double")).alias("accuracy"))


def metrics_table(yp: DataFrame, classes: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows (task, macro_precision, macro_recall, macro_f1, weighted_f1, accuracy)."""
    c = per_class(yp, classes)
    return macro_fixed(c).join(weighted_f1(c), "task").join(accuracy(yp), "task")


def mean_macro_f1(yp: DataFrame, classes: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row: the mean over tasks of the macro-F1 of observed classes."""
    return macro_f1_observed(per_class(yp, classes)).agg(F.avg("macro_f1").alias("mean_macro_f1"))


def report(yp: DataFrame, classes: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows (task, label, precision, recall, f1, support): every class, then accuracy, macro avg and weighted avg."""
    c = per_class(yp, classes)
    own = c.select("task", "label", "precision", "recall", "f1", "support")
    n = F.sum("support").alias("support")
    macro = c.groupBy("task").agg(*(F.avg(x).alias(x) for x in ("precision", "recall", "f1")), n).withColumn("label", F.lit("macro avg"))
    mean = lambda x: F.coalesce(F.try_divide(F.sum(F.col(x) * F.col("support")), F.sum("support")), F.lit(0.0)).alias(x)
    weighted = c.groupBy("task").agg(*(mean(x) for x in ("precision", "recall", "f1")), n).withColumn("label", F.lit("weighted avg"))
    right = yp.groupBy("task").agg(F.avg((F.col("y") == F.col("p")).cast("double")).alias("f1"), F.count("*").alias("support"))
    right = right.select("task", F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"), F.lit(None).cast("double").alias("recall"), "f1", "support")
    return own.unionByName(macro.select(*own.columns)).unionByName(weighted.select(*own.columns)).unionByName(right)
