"""Confusion matrix and classification report for a binary classifier.

One global aggregate of four conditional counts; the per-class figures
are arithmetic on that single row.  Zero denominators give 0.0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundstop.schemas import TARGET_NAMES


def confusion_matrix(df: DataFrame, label: str = "final_label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n)`` for every pair that occurs."""
    return df.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def _div(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return F.when((p + r) > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def classification_report(
    df: DataFrame,
    label: str = "final_label",
    prediction: str = "prediction",
    target_names: Sequence[str] = TARGET_NAMES,
) -> DataFrame:
    """Rows: one per class, ``accuracy``, ``macro avg``, ``weighted avg``.

    Columns ``class_name, precision, recall, f1_score, support``; the
    accuracy row carries the accuracy in ``f1_score`` and no precision or
    recall, as the usual text report prints it.
    """
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    c = df.agg(
        F.count(F.when((y == 0) & (p == 0), 1)).alias("c00"),
        F.count(F.when((y == 0) & (p == 1), 1)).alias("c01"),
        F.count(F.when((y == 1) & (p == 0), 1)).alias("c10"),
        F.count(F.when((y == 1) & (p == 1), 1)).alias("c11"),
    )
    c00, c01, c10, c11 = (F.col(x) for x in ("c00", "c01", "c10", "c11"))
    m = c.select(
        _div(c00, c00 + c10).alias("p0"), _div(c00, c00 + c01).alias("r0"), (c00 + c01).alias("s0"),
        _div(c11, c11 + c01).alias("p1"), _div(c11, c11 + c10).alias("r1"), (c10 + c11).alias("s1"),
        _div(c00 + c11, c00 + c01 + c10 + c11).alias("acc"),
    ).withColumns({"f0": _f1(F.col("p0"), F.col("r0")), "f1": _f1(F.col("p1"), F.col("r1"))})
    n = F.col("s0") + F.col("s1")

    def row(name, prec, rec, f1, support):
        return F.struct(
            F.lit(name).alias("class_name"),
            prec.alias("precision"),
            rec.alias("recall"),
            f1.alias("f1_score"),
            support.cast("long").alias("support"),
        )

    def weighted(a, b):
        return _div(a * F.col("s0") + b * F.col("s1"), n)

    rows = F.array(
        row(target_names[0], F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        row(target_names[1], F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), F.col("acc"), n),
        row("macro avg", (F.col("p0") + F.col("p1")) / 2, (F.col("r0") + F.col("r1")) / 2,
            (F.col("f0") + F.col("f1")) / 2, n),
        row("weighted avg", weighted(F.col("p0"), F.col("p1")), weighted(F.col("r0"), F.col("r1")),
            weighted(F.col("f0"), F.col("f1")), n),
    )
    return m.select(F.inline(rows))


def sideways(df: DataFrame, order: Sequence[Column], fields: Sequence[str], rows: int) -> DataFrame:
    """The first ``rows`` rows in ``order`` turned sideways: one row per field, columns ``row_1`` to ``row_n`` as text."""
    kept = F.collect_list(F.struct(*[F.col(c).cast("string").alias(c) for c in fields]))
    few = df.orderBy(*order).limit(rows).coalesce(1).agg(kept.alias("rows"))
    lines = F.array(*[
        F.struct(F.lit(c).alias("field"), *[F.get(F.col("rows"), F.lit(i))[c].alias(f"row_{i + 1}") for i in range(rows)]) for c in fields
    ])
    return few.select(F.inline(lines))
