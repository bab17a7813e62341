"""Binary-target normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings of a missing label.
MISSING_LABELS = ["nan", "NaN", "None", "Nan", ""]


def normalise_target(df: DataFrame, target: str, label_0: str | None = None,
                     label_1: str | None = None, drop_unmatched: bool = True) -> DataFrame:
    """Make ``target`` an integer 0/1 column, dispatching on its type.

    Strings map ``label_0`` to 0 and ``label_1`` to 1 (or '0' / '1' when no labels are given);
    unmatched strings are dropped, or kept as NULL. Integers must be 0 or 1. Floats and decimals are
    truncated first.
    """
    kind, c = df.schema[target].dataType, F.col(target)
    if isinstance(kind, T.StringType):
        zero, one = ("0", "1") if label_0 is None or label_1 is None else (label_0, label_1)
        mapped = F.when(c == zero, 0).when(c == one, 1)
        out = df.withColumn(target, mapped)
        return out.where(F.col(target).isNotNull()) if drop_unmatched else out
    whole = c if isinstance(kind, T.IntegralType) else c.try_cast("int")
    return df.where(whole.isin(0, 1)).withColumn(target, whole.cast("int"))


def coerce_target(df: DataFrame, target: str, label_0: str | None = None,
                  label_1: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Keep the rows with a usable binary target; also return the (lazy) count of removed rows.

    Without labels the column is parsed as a number; with labels it is trimmed, missing spellings are
    dropped and the two labels become 0 / 1.
    """
    code = _coerced(F.col(target), label_0, label_1)
    kept = df.withColumn(target, code).where(F.col(target).isNotNull())
    removed = df.agg(F.count_if(code.isNull()).alias("n_rows_removed"))
    return kept, removed


def _coerced(c: Column, label_0, label_1) -> Column:
    if label_0 is None and label_1 is None:
        number = c.try_cast("double")
        return F.when(number.isin(0.0, 1.0), number.cast("int"))
    text = F.trim(c.cast("string"))
    valid = ~text.isin(MISSING_LABELS)
    return F.when(valid & (text == str(label_1)), 1).when(valid & (text == str(label_0)), 0)


def select_binary(df: DataFrame, target: str) -> DataFrame:
    """Rows whose target parses as 0 or 1."""
    return df.where(F.col(target).try_cast("double").isin(0.0, 1.0))
